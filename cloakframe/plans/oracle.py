"""SQL for DuckDB that states each registered query's result independently of the Spark code.

Texts are assembled from small builders, each taking and giving SQL expressions. The regular
expressions are written for RE2: word boundaries are spelled out with Unicode classes, and ``$`` becomes
``\\n?$`` where a final line feed may follow.
"""

from __future__ import annotations

from cloakframe.plans import registry
from cloakframe.plans.derived import with_derived
from cloakframe.plans.passthrough import CAPPED, PASSTHROUGH, SQL_SCALARS_DUCKDB
from cloakframe.sources.tables import TABLES

# Fixed values, stated here once more, so that a slip in the lists of the code shows.
SENSITIVE_NAMES = (
    "email emailaddress email_address e_mail phone phonenumber phone_number mobile cellphone telephone ssn "
    "socialsecuritynumber social_security_number creditcard credit_card cardnumber card_number password pwd "
    "passcode pin dob dateofbirth date_of_birth birthdate address street streetaddress street_address zipcode "
    "zip_code postalcode postal_code driverlicense driver_license license_number accountnumber account_number "
    "bankaccount bank_account routingnumber routing_number aba aba_number iban swift sortcode sort_code bsb "
    "accountno acct_number acct_no bank_acc"
).split()
BENIGN_WAITS = (
    "CLR_SEMAPHORE LAZYWRITER_SLEEP RESOURCE_QUEUE SLEEP_TASK SLEEP_SYSTEMTASK SQLTRACE_BUFFER_FLUSH WAITFOR "
    "LOGMGR_QUEUE CHECKPOINT_QUEUE REQUEST_FOR_DEADLOCK_SEARCH XE_TIMER_EVENT BROKER_TO_FLUSH "
    "BROKER_TASK_STOP CLR_MANUAL_EVENT CLR_AUTO_EVENT DISPATCHER_QUEUE_SEMAPHORE FT_IFTS_SCHEDULER_IDLE_WAIT "
    "XE_DISPATCHER_WAIT XE_DISPATCHER_JOIN SQLTRACE_INCREMENTAL_FLUSH_SLEEP"
).split()
WAIT_ADVICE = {
    "CXPACKET": "Parallelism overhead - consider adjusting MAXDOP or Cost Threshold",
    "ASYNC_NETWORK_IO": "Client not consuming data fast enough - check network or client processing",
    "PAGEIOLATCH_SH": "Data page reads from disk - consider more memory or faster storage",
    "PAGEIOLATCH_EX": "Data page writes to disk - check storage performance",
    "WRITELOG": "Log file writes - consider faster storage for log files",
    "LCK_M_S": "Shared lock waits - potential blocking or long transactions",
    "LCK_M_X": "Exclusive lock waits - potential blocking or deadlocks",
    "RESOURCE_SEMAPHORE": "Memory pressure - queries waiting for memory grants",
    "THREADPOOL": "Thread pool exhaustion - too many concurrent requests",
}
OTHER_ADVICE = "Review wait type documentation for specific recommendations"
OTHER_DESCRIPTION = "Various SQL Server operations"
AGGREGATES = "COUNT SUM AVG MIN MAX GROUP_CONCAT".split()
WRITE_OPERATIONS = "INSERT UPDATE DELETE DROP CREATE ALTER TRUNCATE MERGE".split()
DANGEROUS_FUNCTIONS = "xp_cmdshell sp_configure OPENROWSET OPENDATASOURCE".split()
INJECTION_PATTERNS = (
    r";\s*(DROP|DELETE|INSERT|UPDATE)",
    r"UNION\s+SELECT",
    r"--\s*$",
    r"\/\*.*\*\/",
)

# -- RE2 patterns --------------------------------------------------------------------------------

_W = r"\p{L}\p{Mn}\p{Nd}\p{Pc}"
_BEFORE = rf"(?:^|[^{_W}])"
_AFTER = rf"(?:$|[^{_W}])"
_SP = r"\s\x0b\x{85}\p{Z}"
_D = r"\p{Nd}"

RE_EMAIL = (
    rf"(?:{_BEFORE}[A-Za-z0-9_]|[{_W}][.%+-])[A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+\."
    rf"(?:[A-Za-z|]+[A-Za-z]{_AFTER}|[A-Za-z|]+\|[{_W}])"
)
RE_PHONE = rf"(\+?1[-.{_SP}]?)?\(?([0-9]{{3}})\)?[-.{_SP}]?([0-9]{{3}})[-.{_SP}]?([0-9]{{4}})"
RE_SSN = rf"{_BEFORE}(?:{_D}{{3}}-{_D}{{2}}-{_D}{{4}}|{_D}{{9}}){_AFTER}"
RE_CARD = rf"{_BEFORE}(?:{_D}{{4}}[-{_SP}]?){{3}}{_D}{{4}}{_AFTER}"
RE_IBAN = rf"{_BEFORE}[A-Za-z]{{2}}{_D}{{2}}[A-Za-z0-9]{{4,30}}{_AFTER}"
RE_NINE = rf"{_BEFORE}{_D}{{9}}{_AFTER}"
RE_ACCOUNT = rf"{_BEFORE}{_D}{{8,17}}{_AFTER}"
RE_GROUPS = rf"{_BEFORE}{_D}{{2,4}}[-.{_SP}]{_D}{{2,8}}(?:[-.{_SP}]{_D}{{1,8}})*{_AFTER}"
RE_DASHES = rf"{_BEFORE}(?:{_D}{{3}}-{_D}{{5,8}}|{_D}{{2}}(?:-{_D}{{2}}){{2,5}}-{_D}{{4,10}}){_AFTER}"
RE_SHAPE_1 = rf"^{_D}{{3}}-{_D}{{5,8}}\n?$"
RE_SHAPE_2 = rf"^{_D}{{2}}(?:-{_D}{{2}}){{2,5}}-{_D}{{4,10}}\n?$"
RE_SHAPE_3 = rf"^{_D}{{2,4}}(?:[-.{_SP}]{_D}{{2,8}}){{1,6}}\n?$"
RE_MONEY = rf"^\$?{_D}{{1,3}}(?:,{_D}{{3}})*(?:\.{_D}{{2}})?\n?$|^{_D}+\.{_D}{{2}}\n?$|^{_D}+\n?$"
RE_NUMBER = r"^[\t-\r ]*[+-]?(?:[0-9][0-9,]*(?:\.[0-9]*)?|\.[0-9]+)[\t-\r ]*(?:[+-][\t-\r ]*)?$"
RE_TWO_SIGNS = r"[+-].*[+-]"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _hit(v: str, pattern: str) -> str:
    return f"regexp_matches({v}, {_q(pattern)})"


def _digits(v: str) -> str:
    return rf"regexp_replace({v}, '[^\p{{Nd}}]', '', 'g')"


def _blank(v: str) -> str:
    return _hit(v, rf"^[{_SP}]*$")


# -- name rules ----------------------------------------------------------------------------------


def _has(name: str, *parts: str) -> str:
    return "(" + " OR ".join(f"contains({name}, '{p}')" for p in parts) + ")"


def is_balance(name: str) -> str:
    n = f"lower({name})"
    parts = "balance amount total price cost value worth fee charge payment deposit withdrawal".split()
    word = r"(?:^|[^a-z0-9_])(sum|net|gross|min|max|avg|average)(_|$)"
    return f"({_has(n, *parts)} OR {n} LIKE '%amt' OR {n} LIKE 'amt!_%' ESCAPE '!' OR {_hit(n, word)})"


def is_sensitive(name: str) -> str:
    n = f"lower({name})"
    exact = ", ".join(_q(s) for s in SENSITIVE_NAMES)
    parts = "email phone ssn password address routing iban bank".split()
    account = f"({_has(n, 'account')} AND NOT {_has(n, 'name', 'type')})"
    return f"(NOT {is_balance(name)} AND ({n} IN ({exact}) OR {_has(n, *parts)} OR {account}))"


def mask_kind(name: str) -> str:
    n = f"lower({name})"
    return f"""CASE WHEN {_has(n, 'email')} THEN 'email' WHEN {_has(n, 'phone', 'mobile')} THEN 'phone'
  WHEN {_has(n, 'ssn', 'social')} THEN 'ssn' WHEN {_has(n, 'card', 'credit')} THEN 'card'
  WHEN {_has(n, 'password', 'pwd')} THEN 'password' WHEN {_has(n, 'iban')} THEN 'iban'
  WHEN {_has(n, 'routing', 'aba')} THEN 'routing' WHEN {_has(n, 'account', 'bank', 'acct')} THEN 'bank_account'
  ELSE 'generic' END"""


# -- value rules ---------------------------------------------------------------------------------


def aba(nine: str) -> str:
    terms = " + ".join(
        f"coalesce(TRY_CAST(substr({nine}, {i + 1}, 1) AS INTEGER), 0) * {(3, 7, 1)[i % 3]}" for i in range(9)
    )
    return f"({_hit(nine, '^[0-9]{9}$')} AND ({terms}) % 10 = 0)"


def is_routing(v: str) -> str:
    return f"({_hit(v, RE_NINE)} AND {aba(_digits(v))})"


def is_bank_account(v: str, name: str | None = None) -> str:
    n = f"length({_digits(v)})"
    plain = f"({n} >= 10 AND {n} NOT IN (9, 15, 16))"
    if name is None:
        return f"({_hit(v, RE_ACCOUNT)} AND {n} BETWEEN 8 AND 17 AND {plain})"
    named = _has(f"lower({name})", "account", "bank", "acct")
    return (
        f"(NOT {is_balance(name)} AND {_hit(v, RE_ACCOUNT)} AND {n} BETWEEN 8 AND 17 AND ({named} OR {plain}))"
    )


def is_formatted(v: str) -> str:
    parts = f"len([p for p in regexp_split_to_array({v}, '[-. ]') if p <> ''])"
    return (
        f"(({_hit(v, RE_GROUPS)} OR {_hit(v, RE_DASHES)}) AND length({_digits(v)}) BETWEEN 6 AND 20 AND "
        f"({_hit(v, RE_SHAPE_1)} OR {_hit(v, RE_SHAPE_2)} OR ({_hit(v, RE_SHAPE_3)} AND {parts} BETWEEN 2 AND 7)))"
    )


def is_money(v: str) -> str:
    number = f"({_hit(v, RE_NUMBER)} AND NOT {_hit(v, RE_TWO_SIGNS)})"
    whole = f"length(ltrim(regexp_replace(split_part({v}, '.', 1), '[^0-9]', '', 'g'), '0')) <= 9"
    eleven = f"rpad(substr(regexp_extract({v}, '[.]([0-9]*)', 1), 1, 11), 11, '0')"
    # Fraction in units of 1e-10, rounded half up.
    ten = f"((CAST({eleven} AS BIGINT) + 5) // 10)"
    text = f"rtrim(lpad(CAST({ten} % 10000000000 AS VARCHAR), 10, '0'), '0')"
    places = f"length({text}) + CASE WHEN contains({v}, '-') AND {ten} <> 0 THEN 1 ELSE 0 END"
    return f"({_hit(v, RE_MONEY)} OR CASE WHEN {number} THEN {whole} AND {places} <= 2 ELSE FALSE END)"


def contains_pii(v: str) -> str:
    rules = [_hit(v, p) for p in (RE_EMAIL, RE_PHONE, RE_SSN, RE_CARD, RE_IBAN)]
    rules += [is_routing(v), is_bank_account(v), is_formatted(v)]
    return f"coalesce(NOT {_blank(v)} AND ({' OR '.join(rules)}), FALSE)"


# -- maskers -------------------------------------------------------------------------------------


def _stars(n: str) -> str:
    return f"repeat('*', {n})"


def m_email(v: str) -> str:
    at = f"strpos({v}, '@')"
    domain = f"substr({v}, {at})"
    return f"""CASE WHEN {v} IS NULL THEN NULL WHEN {at} <= 1 THEN '[MASKED_EMAIL]' WHEN {at} <= 3 THEN '**' || {domain}
  ELSE substr({v}, 1, 1) || {_stars(f'{at} - 3')} || substr({v}, {at} - 1, 1) || {domain} END"""


def m_phone(v: str) -> str:
    d = _digits(v)
    return f"""CASE WHEN {v} IS NULL THEN NULL WHEN length({d}) >= 10
  THEN '(' || substr({d}, 1, 3) || ') ***-**' || substr({d}, -2) ELSE '[MASKED_PHONE]' END"""


def _m_tail(condition: str, shown: str, otherwise: str, v: str) -> str:
    return f"CASE WHEN {v} IS NULL THEN NULL WHEN {condition} THEN {shown} ELSE '{otherwise}' END"


def m_ssn(v: str) -> str:
    d = _digits(v)
    return _m_tail(f"length({d}) = 9", f"'***-**-' || substr({d}, 6)", "[MASKED_SSN]", v)


def m_card(v: str) -> str:
    d = _digits(v)
    return _m_tail(f"length({d}) >= 13", f"'****-****-****-' || substr({d}, -4)", "[MASKED_CARD]", v)


def m_bank(v: str) -> str:
    d = _digits(v)
    return _m_tail(f"length({d}) >= 8", f"'****' || substr({d}, -4)", "[MASKED_ACCOUNT]", v)


def m_routing(v: str) -> str:
    d = _digits(v)
    return _m_tail(f"length({d}) = 9", f"substr({d}, 1, 4) || '*****'", "[MASKED_ROUTING]", v)


def m_iban(v: str) -> str:
    shown = f"substr({v}, 1, 4) || {_stars(f'length({v}) - 8')} || substr({v}, -4)"
    return _m_tail(f"length({v}) >= 8", shown, "[MASKED_IBAN]", v)


def m_generic(v: str) -> str:
    return f"""CASE WHEN {v} IS NULL THEN NULL WHEN length({v}) <= 4 THEN {_stars(f'length({v})')}
  ELSE substr({v}, 1, 1) || {_stars(f'length({v}) - 2')} || substr({v}, -1) END"""


def m_formatted(v: str) -> str:
    parts = f"[p for p in regexp_split_to_array({v}, '[-. ]') if p <> '']"
    last = f"({parts})[-1]"
    n = f"length({last})"
    keep = f"CASE WHEN {n} > 4 THEN 4 WHEN {n} > 2 THEN 2 ELSE 0 END"
    tail = f"{_stars(f'{n} - {keep}')} || substr({last}, {n} - {keep} + 1)"
    middle = f"[repeat('*', length(p)) for p in ({parts})[2:len({parts}) - 1]]"
    joint = f"CASE WHEN contains({v}, '-') THEN '-' WHEN contains({v}, '.') THEN '.' ELSE ' ' END"
    joined = f"replace(array_to_string(list_concat(list_concat([({parts})[1]], {middle}), [{tail}]), '-'), '-', {joint})"
    return f"CASE WHEN {v} IS NULL THEN NULL WHEN len({parts}) < 2 THEN '[MASKED_ACCOUNT]' ELSE {joined} END"


MASKERS = {
    "email": m_email, "phone": m_phone, "ssn": m_ssn, "card": m_card, "iban": m_iban, "routing": m_routing,
    "bank_account": m_bank, "generic": m_generic, "formatted_account": m_formatted,
}


def by_kind(v: str, kind: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN {m(v)}" for k, m in MASKERS.items() if k != "generic")
    redacted = f"WHEN 'password' THEN CASE WHEN {v} IS NOT NULL THEN '[REDACTED]' END"
    return f"CASE {kind} {arms} {redacted} ELSE {m_generic(v)} END"


def _ladder(v: str, name: str | None = None) -> list[tuple[str, str]]:
    return [
        (_hit(v, RE_EMAIL), "email"), (_hit(v, RE_PHONE), "phone"), (_hit(v, RE_SSN), "ssn"),
        (_hit(v, RE_CARD), "card"), (_hit(v, RE_IBAN), "iban"), (is_routing(v), "routing"),
        (is_bank_account(v, name), "bank_account"), (is_formatted(v), "formatted_account"),
    ]


def masked(v: str) -> str:
    """A value in a column whose name says nothing."""
    arms = " ".join(f"WHEN {c} THEN {MASKERS[k](v)}" for c, k in _ladder(v))
    return f"CASE WHEN {v} IS NULL OR {_blank(v)} OR {is_money(v)} THEN {v} {arms} ELSE {v} END"


def masked_as(v: str, kind: str) -> str:
    """A value in a column with a sensitive name of a known kind."""
    shown = "'[REDACTED]'" if kind == "password" else MASKERS[kind](v)
    return f"CASE WHEN {v} IS NULL OR {_blank(v)} OR {is_money(v)} THEN {v} ELSE {shown} END"


def masked_named(v: str, name: str) -> str:
    arms = " ".join(f"WHEN {c} THEN {MASKERS[k](v)}" for c, k in _ladder(v, name))
    stays = f"{v} IS NULL OR {_blank(v)} OR {is_balance(name)} OR {is_money(v)}"
    named = f"WHEN {is_sensitive(name)} THEN {by_kind(v, f'({mask_kind(name)})')}"
    return f"CASE WHEN {stays} THEN {v} {named} {arms} ELSE {v} END"


def pii_class(v: str) -> str:
    arms = " ".join(f"WHEN {c} THEN '{k}'" for c, k in _ladder(v))
    return f"CASE WHEN {v} IS NULL OR {_blank(v)} THEN 'blank' WHEN {is_money(v)} THEN 'monetary' {arms} ELSE 'none' END"


# -- helpers for exact decimals ------------------------------------------------------------------


def _half_up(numerator: str, denominator: str, scale: int, precision: int = 18) -> str:
    """Quotient of two whole numbers as a decimal, rounded half up in whole-number arithmetic."""
    a, b = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)"
    units = f"((2 * {a} * {10**scale} + {b}) // (2 * {b}))"
    return _scaled(units, scale, precision)


def _scaled(units: str, scale: int, precision: int = 18) -> str:
    step = "0." + "0" * (scale - 1) + "1"
    return f"CAST(CAST({units} AS DECIMAL({precision},0)) * {step} AS DECIMAL({precision},{scale}))"


def _ms(micros: str) -> str:
    return _scaled(micros, 3)


def _from(name: str, select: str, tail: str = "") -> str:
    return with_derived((name,), f"SELECT {select} FROM {name} {tail}")


# -- PII -----------------------------------------------------------------------------------------

_SENSITIVE = is_sensitive("column_name")


def _pii() -> dict[str, str]:
    out = {
        "classify_columns": _from(
            "column_names",
            f"*, {is_balance('column_name')} AS is_balance, {_SENSITIVE} AS is_sensitive, "
            f"CASE WHEN {_SENSITIVE} THEN {mask_kind('column_name')} END AS masking_type",
        ),
        "is_balance_column": _from("column_names", f"*, {is_balance('column_name')} AS is_balance"),
        "masking_type": _from("column_names", f"*, {mask_kind('column_name')} AS masking_type"),
        "check_column_sensitivity": _from(
            "column_names",
            f"*, {_SENSITIVE} AS is_sensitive, CASE WHEN {_SENSITIVE} THEN 'This column is flagged as potentially "
            "containing PII' ELSE 'This column is not flagged as sensitive' END AS message",
        ),
        "sensitive_column_counts": _from(
            "column_names",
            f"table_name, count(*) AS column_count, count(*) FILTER (WHERE {_SENSITIVE}) AS sensitive_count",
            "GROUP BY table_name",
        ),
        "contains_pii": _from("field_values", f"source, row_id, {contains_pii('v')} AS contains_pii"),
        "value_detectors": _from(
            "value_shapes",
            "*, "
            + ", ".join(
                f"{c} AS {n}"
                for n, c in {
                    "email": _hit("v", RE_EMAIL),
                    "phone": _hit("v", RE_PHONE),
                    "ssn": _hit("v", RE_SSN),
                    "card": _hit("v", RE_CARD),
                    "iban": _hit("v", RE_IBAN),
                    "routing": is_routing("v"),
                    "bank_account": is_bank_account("v"),
                }.items()
            ),
        ),
        "bank_account_by_name": _from("named_values", f"*, {is_bank_account('v', 'column_name')} AS bank_account"),
        "pii_class_counts": _from(
            "field_values", f"source, {pii_class('v')} AS pii_class, count(*) AS value_count", "GROUP BY 1, 2"
        ),
        "is_monetary": _from("value_shapes", f"*, CASE WHEN v IS NOT NULL THEN {is_money('v')} END AS is_monetary"),
        "is_formatted_account": _from("value_shapes", f"*, {is_formatted('v')} AS is_formatted_account"),
        "aba_checksum": _from("nine_digits", f"*, {aba('v')} AS is_aba"),
        "pii_detection_report": with_derived(
            ("value_shapes",),
            f"SELECT *, v IS DISTINCT FROM masked_value AS was_masked FROM "
            f"(SELECT *, {contains_pii('v')} AS contains_pii, {masked('v')} AS masked_value FROM value_shapes) r",
        ),
        "mask_by_type": _from("named_values", f"*, {by_kind('v', '(' + mask_kind('column_name') + ')')} AS masked"),
        "mask_value": _from("named_values", f"*, {masked_named('v', 'column_name')} AS masked"),
    }
    queries = {
        "mask_email": m_email, "mask_phone": m_phone, "mask_ssn": m_ssn, "mask_card": m_card,
        "mask_formatted_account": m_formatted, "mask_bank_account": m_bank, "mask_routing": m_routing,
        "mask_iban": m_iban, "mask_generic": m_generic,
    }
    for name, masker in queries.items():
        out[name] = _from("value_shapes", f"*, {masker('v')} AS masked")
    return out


# What each column of the derived people table asks for, decided by hand.
_PEOPLE = {
    "person_id": "person_id",
    "full_name": masked("full_name"),
    "email": masked_as("email", "email"),
    "mobile_phone": masked_as("mobile_phone", "phone"),
    "ssn": masked_as("ssn", "ssn"),
    "credit_card": masked_as("credit_card", "card"),
    "iban": masked_as("iban", "iban"),
    "routing_number": masked_as("routing_number", "routing"),
    "bank_acc": masked_as("bank_acc", "bank_account"),
    "password": masked_as("password", "password"),
    "dob": masked_as("dob", "generic"),
    "street_address": masked_as("street_address", "generic"),
    "account_type": masked("account_type"),
    "account_balance": "account_balance",
    "remark": masked("remark"),
}


_KEY = "coalesce(email, 'none')"


def _tables() -> dict[str, str]:
    changed = " OR ".join(f"{c} IS DISTINCT FROM ({m})" for c, m in _PEOPLE.items())
    documents = f"doc_id, {masked('text')} AS text, {masked('lang')} AS lang, {masked('source')} AS source, n_chars"
    return {
        "mask_table": _from("people", ", ".join(f"{m} AS {c}" for c, m in _PEOPLE.items())),
        "mask_nested": _from(
            "people",
            f"person_id, {_PEOPLE['email']} AS email, {_PEOPLE['mobile_phone']} AS mobile_phone, {_PEOPLE['remark']} AS remark, "
            f"{_PEOPLE['remark']} AS note_1, {_PEOPLE['full_name']} AS note_2, {masked(_KEY)} AS link_key, "
            f"{_PEOPLE['remark']} AS link_value, {_PEOPLE['dob']} AS dob",
        ),
        "masking_report": _from("people", f"count(*) AS total_rows, count(*) FILTER (WHERE {changed}) AS masked_rows"),
        "mask_documents": f"SELECT {documents} FROM documents",
        "mask_stream": f"SELECT {documents} FROM documents",
        "mask_stream_counts": "SELECT count(*) AS total_rows, count(*) FILTER (WHERE "
        + " OR ".join(f"{masked(c)} IS DISTINCT FROM {c}" for c in ("text", "lang", "source"))
        + ") AS masked_rows FROM documents",
        "mask_pages": f"SELECT page_id, {masked('url')} AS url, {masked('html')} AS html FROM pages",
    }


# -- query ---------------------------------------------------------------------------------------


def _query() -> dict[str, str]:
    return {
        "bounded_query": f"SELECT c_custkey, {masked('c_name')} AS c_name, c_acctbal FROM ({registry.FLAGSHIP_SQL}) q",
        "result_json": f"""SELECT '{{"c_custkey":' || c_custkey || ',"c_name":"' || ({masked('c_name')}) ||
  '","c_mktsegment":"' || c_mktsegment || '","c_nationkey":' || c_nationkey || '}}' AS json FROM customer""",
        "query_stats": f"""SELECT count(*) AS row_count, count(*) FILTER (WHERE c_name IS DISTINCT FROM ({masked('c_name')}))
  AS masked_rows, (SELECT count(*) FROM ({registry.STATS_SQL} LIMIT 1001) r) > 1000 AS was_truncated
  FROM ({registry.STATS_SQL} LIMIT 1000) q""",
        **PASSTHROUGH,
        **{
            name: f"SELECT {', '.join(rest)}, {', '.join(f'{masked(c)} AS {c}' for c in hidden)} FROM ({sql} LIMIT {cap}) q"
            for name, (sql, cap, hidden, rest) in CAPPED.items()
        },
        "sql_scalars": SQL_SCALARS_DUCKDB,
    }


# -- catalog -------------------------------------------------------------------------------------

# Columns and types of the given tables.
COLUMNS: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def _fields(table: str) -> list[list[str]]:
    return [c.split() for c in COLUMNS[table].split(", ")]


def _column_profile() -> str:
    selects = []
    digits = {"int": "10", "bigint": "19"}
    for table in TABLES:
        for i, (name, kind) in enumerate(_fields(table)):
            longest = f"CAST(max(length({name})) AS INTEGER)" if kind == "string" else "CAST(NULL AS INTEGER)"
            scale = "0" if kind in digits else "NULL"
            selects.append(
                f"SELECT '{table}' AS table_name, {i + 1} AS ordinal, '{name}' AS column_name, '{kind}' AS data_type, "
                f"TRUE AS is_nullable, {longest} AS max_length, "
                f"CAST({digits.get(kind, 'NULL')} AS INTEGER) AS numeric_precision, "
                f"CAST({scale} AS INTEGER) AS numeric_scale, FALSE AS is_sensitive, count(*) AS row_count, "
                f"count(*) - count({name}) AS null_count FROM {table}"
            )
    return " UNION ALL ".join(selects)


def _key_profile() -> str:
    selects = []
    for table, columns in registry.CANDIDATE_KEYS:
        keys = ", ".join(columns)
        complete = " AND ".join(f"{c} IS NOT NULL" for c in columns)
        selects.append(
            f"SELECT '{table}' AS table_name, '{','.join(columns)}' AS key_columns, "
            f"(SELECT count(*) FROM {table}) AS row_count, (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {table} "
            f"WHERE {complete}) d) AS distinct_keys, (SELECT count(*) FROM {table} WHERE NOT ({complete})) AS null_keys, "
            f"coalesce(max(n), 0) AS max_rows_per_key, coalesce(max(n), 0) <= 1 AND (SELECT count(*) FROM {table} "
            f"WHERE NOT ({complete})) = 0 AS is_unique FROM (SELECT count(*) AS n FROM {table} WHERE {complete} "
            f"GROUP BY {keys}) g"
        )
    return " UNION ALL ".join(selects)


def _relationship_check() -> str:
    return " UNION ALL ".join(
        f"SELECT '{parent}' AS parent_table, '{pk}' AS parent_column, '{child}' AS child_table, '{fk}' AS child_column, "
        f"count(DISTINCT c.{fk}) AS orphan_keys, count(*) AS orphan_rows, count(*) = 0 AS holds FROM {child} c "
        f"WHERE c.{fk} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pk} = c.{fk})"
        for child, fk, parent, pk in registry.FOREIGN_KEYS
    )


def _table_inventory(chosen: tuple[str, ...] = TABLES) -> str:
    children = {c for c, *_ in registry.FOREIGN_KEYS}
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, 'default' AS schema_name, 'BASE TABLE' AS table_type, count(*) AS row_count, "
        f"{_q('lines of orders') if t == 'lineitem' else 'CAST(NULL AS VARCHAR)'} AS description, "
        f"{t in registry.PRIMARY_KEYS} AS has_primary_key, {t in children} AS has_foreign_keys, "
        f"CAST({len(_fields(t))} AS BIGINT) AS column_count, '{'; '.join(f[0] for f in _fields(t))}' AS columns FROM {t}"
        for t in chosen
    )


def _search_catalog() -> str:
    """Names that hold "or", and an "e" somewhere after it."""
    low = "lower(object_name)"
    listed = " UNION ALL ".join(
        f"SELECT 'Table' AS object_type, '{t}' AS object_name, 'default' AS schema_name, CAST(NULL AS VARCHAR) AS table_name, "
        f"CAST(NULL AS VARCHAR) AS data_type, {_q('lines of orders') if t == 'lineitem' else 'CAST(NULL AS VARCHAR)'} AS description, "
        f"(SELECT count(*) FROM {t}) AS row_count"
        + "".join(
            f" UNION ALL SELECT 'Column', '{c}', 'default', '{t}', '{kind}', NULL, (SELECT count(*) FROM {t})"
            for c, kind in _fields(t)
        )
        for t in TABLES
    )
    score = f"CASE WHEN {low} LIKE 'or%e' THEN 100 WHEN {low} LIKE 'or%e%' THEN 90 WHEN {low} LIKE '%or%e%' THEN 70 ELSE 50 END"
    order = "match_score DESC, CASE object_type WHEN 'Table' THEN 1 ELSE 2 END, object_name, table_name NULLS FIRST"
    return f"""WITH listed AS ({listed}),
  hits AS (SELECT *, {score} AS match_score FROM listed WHERE {low} LIKE '%or%e%' OR lower(description) LIKE '%or%e%')
  SELECT *, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS rank FROM hits ORDER BY rank"""


def _distinct_counts() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(DISTINCT {c}) AS distinct_count FROM {t}"
        for t in TABLES
        for c, _ in _fields(t)
    )


def _profile_of_files() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, "
        + (f"CAST(max(length({c})) AS INTEGER)" if kind == "string" else "CAST(NULL AS INTEGER)")
        + f" AS max_length, CASE WHEN count(DISTINCT {c}) < 100 THEN count(DISTINCT {c}) END AS distinct_if_few FROM {t}"
        for t in TABLES
        for c, kind in _fields(t)
    )


def _relationships_found() -> str:
    columns = [(t, c, "n" if k in ("int", "bigint") else "s") for t in TABLES for c, k in _fields(t) if k in ("int", "bigint", "string")]
    values = " UNION ALL ".join(
        f"SELECT {i} AS col, '{kind}' AS kind, CAST({c} AS VARCHAR) AS v, count(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY {c}"
        for i, (t, c, kind) in enumerate(columns)
    )
    named = ", ".join(f"({i}, '{t}', '{c}')" for i, (t, c, _) in enumerate(columns))
    return f"""WITH held AS ({values}), named(col, t, c) AS (VALUES {named}),
own AS (SELECT col, count(*) AS n_values, max(n) AS most FROM held GROUP BY col),
shared AS (SELECT a.col AS child, b.col AS parent, count(*) AS n FROM held a JOIN held b ON a.kind = b.kind AND a.v = b.v AND a.col <> b.col
  GROUP BY a.col, b.col)
SELECT x.t AS child_table, x.c AS child_column, y.t AS parent_table, y.c AS parent_column, o.n_values
FROM shared s JOIN own o ON s.child = o.col AND s.n = o.n_values JOIN own p ON s.parent = p.col AND p.most = 1
  JOIN named x ON x.col = s.child JOIN named y ON y.col = s.parent"""


def _keys_found() -> str:
    """All sets of one or two columns without nulls and repeats, less those that hold a smaller one."""
    parts = []
    for t in TABLES:
        names = [c for c, k in _fields(t) if not k.startswith("array")]
        sets = [(c,) for c in names] + [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
        for chosen in sets:
            whole = " AND ".join(f"count({c}) = count(*)" for c in chosen)
            parts.append(
                f"SELECT '{t}' AS table_name, {list(chosen)!r} AS cols FROM {t} "
                f"HAVING count(*) > 0 AND {whole} AND count(DISTINCT ({', '.join(chosen)})) = count(*)"
            )
    union = " UNION ALL ".join(parts)
    return f"""WITH u AS ({union}) SELECT table_name, array_to_string(cols, ',') AS key_columns FROM u a
WHERE NOT EXISTS (SELECT 1 FROM u b WHERE b.table_name = a.table_name AND len(b.cols) < len(a.cols) AND list_has_all(a.cols, b.cols))"""


def _search(source: str, kind: str, term: str, described: bool) -> str:
    t = term.lower()
    name = "lower(object_name)"
    extra = {
        "Table": "schema_name, CAST(NULL AS VARCHAR) AS table_name, CAST(NULL AS VARCHAR) AS data_type, description",
        "Column": "CAST(NULL AS VARCHAR), table_name, data_type, CAST(NULL AS VARCHAR)",
        "Index": "CAST(NULL AS VARCHAR), table_name, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)",
    }[kind]
    where = f"strpos({name}, '{t}') > 0" + (f" OR strpos(lower(description), '{t}') > 0" if described else "")
    return (
        f"SELECT '{kind}' AS object_type, object_name, {extra}, {_score('object_name', t)} AS match_score "
        f"FROM {source} WHERE {where}"
    )


def _score(name: str, term: str) -> str:
    n, t = f"lower({name})", term.lower()
    return (
        f"CASE WHEN {n} = '{t}' THEN 100 WHEN {n} LIKE '{t}%' THEN 90 WHEN {n} LIKE '%{t}%' THEN 70 ELSE 50 END"
    )


def _catalog() -> dict[str, str]:
    term = registry.SEARCH_TERM
    search = " UNION ALL ".join(
        [
            _search("search_tables", "Table", term, True),
            _search("search_columns", "Column", term, False),
            _search("search_indexes", "Index", term, False),
        ]
    )
    key, word = registry.KEYWORD, registry.DOCUMENT_KEYWORD
    return {
        "column_profile": _column_profile(),
        "key_profile": _key_profile(),
        "relationship_check": _relationship_check(),
        "table_inventory": _table_inventory(),
        # LIKE "%e%nt%"
        "table_inventory_filtered": _table_inventory(("events", "documents")),
        "search_catalog": _search_catalog(),
        "column_distinct_counts": _distinct_counts(),
        "profile_of_files": _profile_of_files(),
        "relationships_found": _relationships_found(),
        "keys_found": _keys_found(),
        "table_stats": "SELECT 'lineitem' AS table_name, 'default' AS schema_name, count(*) AS row_count FROM lineitem",
        "database_info": f"""SELECT {len(TABLES)} AS table_count, '{'; '.join(sorted(TABLES))}' AS tables,
  CAST({' + '.join(f'(SELECT count(*) FROM {t})' for t in TABLES)} AS BIGINT) AS row_count,
  'Query results are automatically filtered for PII protection' AS note""",
        "schema_search": with_derived(("search_tables", "search_columns", "search_indexes"), search),
        "keyword_rank": f"SELECT p_partkey, p_name, p_type, {_score('p_name', key)} AS match_score FROM part "
        f"WHERE p_name ILIKE '%{key}%' OR p_type ILIKE '%{key}%'",
        "keyword_rank_documents": f"SELECT doc_id, source, {_score('source', word)} AS match_score FROM documents "
        f"WHERE source ILIKE '%{word}%' OR text ILIKE '%{word}%'",
        "exists_flags": """SELECT c_custkey, c_mktsegment,
  EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS has_orders,
  EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT') AS has_urgent_orders,
  EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey) AS has_events FROM customer""",
        "repeated_key_lookups": """SELECT o_orderkey, o_custkey,
  EXISTS (SELECT 1 FROM events WHERE user_id = o.o_custkey) AS has_events,
  (SELECT count(*) FROM orders u WHERE u.o_custkey = o.o_custkey AND u.o_orderpriority = '1-URGENT') AS urgent_orders
  FROM orders o""",
        "scalar_subquery_counts": """SELECT p_partkey, p_brand,
  (SELECT count(*) FROM lineitem WHERE l_partkey = p_partkey) AS line_count,
  (SELECT count(*) FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R') AS returned_count FROM part""",
    }


# -- workload ------------------------------------------------------------------------------------

_SLOW = f"""
, g AS (SELECT query_hash, count(*) AS execution_count, CAST(sum(elapsed_us) AS BIGINT) AS el,
    max(elapsed_us) AS mx, CAST(sum(cpu_us) AS BIGINT) AS cp, CAST(sum(logical_reads) AS BIGINT) AS total_logical_reads,
    CAST(sum(physical_reads) AS BIGINT) AS total_physical_reads, max(executed_at) AS last_execution_time,
    min(executed_at) AS creation_time FROM query_log GROUP BY query_hash),
texts AS (SELECT l.query_hash, min(l.query_text) AS query_text FROM query_log l JOIN g
  ON l.query_hash = g.query_hash AND l.executed_at = g.last_execution_time GROUP BY l.query_hash),
slow AS (SELECT query_hash,
    replace(replace(replace(query_text, chr(13), ' '), chr(10), ' '), chr(9), ' ') AS query_text,
    execution_count, {_ms('el')} AS total_elapsed_ms, {_ms('el // execution_count')} AS avg_elapsed_ms,
    {_ms('mx')} AS max_elapsed_ms, {_ms('cp')} AS total_cpu_ms, {_ms('cp // execution_count')} AS avg_cpu_ms,
    total_logical_reads, total_logical_reads // execution_count AS avg_logical_reads, total_physical_reads,
    total_physical_reads // execution_count AS avg_physical_reads, last_execution_time, creation_time,
    {_ms('cp')} AS total_worker_time_ms, el // execution_count AS avg_us, cp
  FROM g JOIN texts USING (query_hash) WHERE el // execution_count >= 1000000)"""
_SLOW_TOP = "ORDER BY avg_us DESC, query_hash LIMIT 50"

# A hash and a text are a statement.
_SLOW_TEXTS = f"""
, g AS (SELECT query_hash, query_text, count(*) AS execution_count, CAST(sum(elapsed_us) AS BIGINT) AS el,
    max(elapsed_us) AS mx, CAST(sum(cpu_us) AS BIGINT) AS cp, CAST(sum(logical_reads) AS BIGINT) AS total_logical_reads,
    CAST(sum(physical_reads) AS BIGINT) AS total_physical_reads, max(executed_at) AS last_execution_time,
    min(executed_at) AS creation_time FROM query_log GROUP BY query_hash, query_text),
slow AS (SELECT query_hash,
    replace(replace(replace(query_text, chr(13), ' '), chr(10), ' '), chr(9), ' ') AS query_text,
    execution_count, {_ms('el')} AS total_elapsed_ms, {_ms('el // execution_count')} AS avg_elapsed_ms,
    {_ms('mx')} AS max_elapsed_ms, {_ms('cp')} AS total_cpu_ms, {_ms('cp // execution_count')} AS avg_cpu_ms,
    total_logical_reads, total_logical_reads // execution_count AS avg_logical_reads, total_physical_reads,
    total_physical_reads // execution_count AS avg_physical_reads, last_execution_time, creation_time,
    {_ms('cp')} AS total_worker_time_ms, el // execution_count AS avg_us, cp
  FROM g WHERE el // execution_count >= 1000000)"""
_SLOW_TEXTS_TOP = "ORDER BY avg_us DESC, query_hash, query_text LIMIT 50"

# The lexer without nesting of comments, which the logs do not have.
_LEXED = r"""
, lexed AS (SELECT *, list_filter(list_transform(regexp_extract_all(query_text,
    '[nN]?''[^'']*(?:''''[^'']*)*(?:''|\z)|--[^\r\n]*|/\*(?:[^*]|\*+[^*/])*(?:\*+/|\**\z)|"[^"]*(?:""[^"]*)*(?:"|\z)|'
    || '\[[^\]]*(?:\]\][^\]]*)*(?:\]|\z)|[\p{L}_@#$][\p{L}\p{N}_@#$]*|0[xX][0-9A-Fa-f]*|'
    || '(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|[^\s]'),
    lambda t: CASE WHEN t[1:2] IN ('--', '/*') THEN NULL WHEN regexp_matches(t, '^(?:[nN]?''|[.]?[0-9])') THEN '?'
      WHEN t[1] IN ('"', '[') THEN t ELSE lower(t) END), lambda t: t IS NOT NULL) AS tokens FROM query_log),
hashed AS (SELECT * EXCLUDE (tokens), substr(sha256(regexp_replace(array_to_string(tokens, ' '),
    '(^| )in \( (?:[-+] )?\?(?: , (?:[-+] )?\?)* \)', '\1in ( ? )', 'g')), 1, 32) AS shape FROM lexed)"""

_USAGE = """
, u AS (SELECT schema_name, table_name, object_key, count(*) FILTER (WHERE access = 'R') AS user_seeks,
    count(*) FILTER (WHERE access = 'A') AS user_scans, count(*) FILTER (WHERE access = 'N') AS user_lookups,
    count(*) FILTER (WHERE status = 'F') AS user_updates,
    max(used_at) FILTER (WHERE access = 'R') AS last_user_seek, max(used_at) FILTER (WHERE access = 'A') AS last_user_scan,
    max(used_at) FILTER (WHERE access = 'N') AS last_user_lookup,
    max(used_at) FILTER (WHERE status = 'F') AS last_user_update FROM usage_log GROUP BY schema_name, table_name, object_key),
j AS (SELECT o.*, coalesce(user_seeks, 0) AS user_seeks, coalesce(user_scans, 0) AS user_scans,
    coalesce(user_lookups, 0) AS user_lookups, coalesce(user_updates, 0) AS user_updates, last_user_seek,
    last_user_scan, last_user_lookup, last_user_update,
    coalesce(user_seeks, 0) + coalesce(user_scans, 0) + coalesce(user_lookups, 0) AS uses
  FROM usage_objects o LEFT JOIN u ON o.schema_name = u.schema_name AND o.table_name = u.table_name AND o.object_key = u.object_key),
scores AS (SELECT schema_name, table_name, object_key, coalesce(object_name, 'HEAP') AS object_name,
    CASE type_code WHEN 0 THEN 'Heap' WHEN 1 THEN 'Clustered' WHEN 2 THEN 'Nonclustered'
      WHEN 5 THEN 'Clustered Columnstore' ELSE 'Unknown' END AS object_type, is_unique, is_primary_key,
    user_seeks, user_scans, user_lookups, user_updates, last_user_seek, last_user_scan, last_user_lookup,
    last_user_update, size_kb,
    CAST(CAST(least(uses, 10000) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(5,2)) AS usage_score,
    CASE WHEN uses = 0 THEN 'Unused' WHEN uses < 100 THEN 'Light' WHEN uses < 1000 THEN 'Moderate' ELSE 'Heavy' END
      AS usage_category FROM j)"""

_MICRO_COST = "((2 * CAST(cost AS HUGEINT) * 1000000 + n * 3000) // (2 * n * 3000))"
_MICRO_IMPACT = "((2 * CAST(impact AS HUGEINT) * 1000000 + n) // (2 * n))"
_IMPACT = f"""
, g AS (SELECT schema_name, table_name, equality_columns, inequality_columns, included_columns,
    count(*) FILTER (WHERE access = 'seek') AS user_seeks, count(*) FILTER (WHERE access = 'scan') AS user_scans,
    sum(cost_units) AS cost, sum(impact_pct) AS impact, count(*) AS n,
    max(used_at) FILTER (WHERE access = 'seek') AS last_user_seek,
    max(used_at) FILTER (WHERE access = 'scan') AS last_user_scan FROM candidate_log GROUP BY 1, 2, 3, 4, 5),
m AS (SELECT *, {_MICRO_COST} AS mc, {_MICRO_IMPACT} AS mi FROM g),
p AS (SELECT *, (mc * mi * (user_seeks + user_scans) + 5000000000) // 10000000000 AS cents,
    CASE WHEN equality_columns <> '' THEN replace(replace(equality_columns, '[', ''), ']', '')
      WHEN inequality_columns <> '' THEN replace(replace(inequality_columns, '[', ''), ']', '') ELSE 'Missing' END AS stem
  FROM m),
ranking AS (SELECT schema_name, table_name, equality_columns, inequality_columns, included_columns,
    {_scaled('cents', 2)} AS improvement_measure, user_seeks, user_scans, {_scaled('mc', 6)} AS avg_total_user_cost,
    {_scaled('mi', 6)} AS avg_user_impact, last_user_seek, last_user_scan,
    'IX_' || table_name || '_' || stem AS suggested_index_name,
    'CREATE NONCLUSTERED INDEX [IX_' || table_name || '_' || stem || '] ON [' || schema_name || '].[' || table_name || '] (' ||
      CASE WHEN equality_columns <> '' AND inequality_columns <> '' THEN equality_columns || ', ' || inequality_columns
        WHEN equality_columns <> '' THEN equality_columns WHEN inequality_columns <> '' THEN inequality_columns
        ELSE '[Unknown]' END || ')' ||
      CASE WHEN included_columns <> '' THEN ' INCLUDE (' || included_columns || ')' ELSE '' END AS create_index_statement,
    CASE WHEN cents > 10000000 THEN 'High' WHEN cents > 1000000 THEN 'Medium' ELSE 'Low' END AS priority, cents FROM p)"""
_IMPACT_TOP = "ORDER BY cents DESC, schema_name, table_name, equality_columns, inequality_columns, included_columns LIMIT 25"

_BENIGN = ", ".join(_q(w) for w in BENIGN_WAITS)
_ADVICE = " ".join(f"WHEN '{k}' THEN {_q(a)}" for k, a in WAIT_ADVICE.items())
_WAITS = f"""
, g AS (SELECT wait_type, count(*) AS n, CAST(sum(wait_ms) AS BIGINT) AS w, max(wait_ms) AS mx,
    CAST(sum(signal_ms) AS BIGINT) AS s FROM wait_log WHERE wait_type NOT IN ({_BENIGN}) GROUP BY wait_type
    HAVING sum(wait_ms) > 0),
t AS (SELECT *, CAST(sum(w) OVER () AS BIGINT) AS total FROM g),
c AS (SELECT *, (CAST(w AS HUGEINT) * 20000 + total) // (2 * CAST(total AS HUGEINT)) AS share FROM t),
waits AS (SELECT wait_type, n AS waiting_tasks_count, CAST(w AS DECIMAL(18,3)) AS wait_time_ms,
    mx AS max_wait_time_ms, s AS signal_wait_time_ms, w - s AS resource_wait_time_ms,
    {_scaled('share', 2, 5)} AS percentage_of_total, w // n AS avg_wait_time_ms,
    CASE WHEN starts_with(wait_type, 'LCK') THEN 'Locking'
      WHEN starts_with(wait_type, 'PAGEIO') OR starts_with(wait_type, 'WRITELOG') OR wait_type LIKE 'IO_%' THEN 'I/O'
      WHEN starts_with(wait_type, 'PAGELATCH') THEN 'Latching'
      WHEN wait_type LIKE 'RESOURCE_%' OR starts_with(wait_type, 'CMEMTHREAD') THEN 'Memory'
      WHEN starts_with(wait_type, 'CXPACKET') OR starts_with(wait_type, 'EXCHANGE') THEN 'Parallelism'
      WHEN wait_type LIKE 'ASYNC_%' OR wait_type LIKE 'NETWORK_%' THEN 'Network'
      WHEN wait_type LIKE 'SOS_%' OR starts_with(wait_type, 'THREADPOOL') THEN 'CPU' ELSE 'Other' END AS wait_category,
    CASE WHEN wait_type = 'CXPACKET' THEN 'Parallelism coordination waits'
      WHEN wait_type = 'ASYNC_NETWORK_IO' THEN 'Network I/O waits'
      WHEN starts_with(wait_type, 'PAGEIOLATCH') THEN 'Data page I/O waits'
      WHEN wait_type = 'WRITELOG' THEN 'Transaction log write waits'
      WHEN wait_type LIKE 'LCK_%' THEN 'Lock acquisition waits'
      WHEN wait_type = 'RESOURCE_SEMAPHORE' THEN 'Memory grant waits'
      WHEN wait_type = 'THREADPOOL' THEN 'Worker thread waits' ELSE {_q(OTHER_DESCRIPTION)} END AS description,
    CASE wait_type {_ADVICE} ELSE {_q(OTHER_ADVICE)} END AS recommendation, share, w FROM c)"""
_WAITS_TOP = "ORDER BY share DESC, w DESC, wait_type LIMIT 20"


def _one_decimal(hundredths: str) -> str:
    """A share in hundredths as text with one decimal, rounded half up."""
    tenths = f"(({hundredths} + 5) // 10)"
    return f"CAST({tenths} // 10 AS VARCHAR) || '.' || CAST({tenths} % 10 AS VARCHAR)"


def _workload() -> dict[str, str]:
    slow, usage = ("query_log",), ("usage_objects", "usage_log")
    return {
        "statement_shapes": with_derived(slow, f"{_LEXED} SELECT query_id, shape AS statement_hash FROM hashed"),
        "slow_shapes": with_derived(
            slow,
            f"{_LEXED}{_SLOW.replace('query_hash', 'shape').replace('query_log', 'hashed')} "
            f"SELECT shape AS query_hash, * EXCLUDE (avg_us, cp, shape) FROM slow {_SLOW_TOP.replace('query_hash', 'shape')}",
        ),
        "slow_groups": with_derived(slow, f"{_SLOW_TEXTS} SELECT * EXCLUDE (avg_us, cp) FROM slow {_SLOW_TEXTS_TOP}"),
        "slow_groups_rolled_up": with_derived(slow, f"{_SLOW} SELECT * EXCLUDE (avg_us, cp) FROM slow {_SLOW_TOP}"),
        "slow_groups_summary": with_derived(
            slow,
            f"""{_SLOW_TEXTS} SELECT count(*) AS total_queries, count(*) FILTER (WHERE avg_us >= 1000000) AS slow_queries,
  {_half_up('sum(avg_us)', '(1000 * count(*))', 6)} AS average_execution_ms,
  {_scaled('sum(cp)', 6)} AS total_cpu_seconds, CAST(sum(total_logical_reads) AS BIGINT) AS total_logical_reads,
  CAST(sum(total_physical_reads) AS BIGINT) AS total_physical_reads,
  'Found ' || count(*) || ' slow queries with average execution time >= 1000ms' AS message FROM slow""",
        ),
        "slow_groups_binary": with_derived(
            slow, f"{_SLOW_TEXTS} SELECT '0x' || hex(query_hash) AS query_hash, * EXCLUDE (avg_us, cp, query_hash) FROM slow {_SLOW_TEXTS_TOP}"
        ),
        "usage_scores": with_derived(usage, f"{_USAGE} SELECT * FROM scores"),
        "usage_scores_of_table": with_derived(usage, f"{_USAGE} SELECT * FROM scores WHERE table_name = 'supplier'"),
        "usage_summary": with_derived(
            usage,
            f"""{_USAGE} SELECT count(*) AS total_objects, count(*) FILTER (WHERE usage_category = 'Unused') AS unused_objects,
  count(*) FILTER (WHERE usage_category = 'Heavy') AS heavily_used_objects,
  count(*) FILTER (WHERE usage_category = 'Light') AS lightly_used_objects, CAST(sum(size_kb) AS BIGINT) AS total_size_kb,
  CAST(coalesce(sum(size_kb) FILTER (WHERE usage_category = 'Unused'), 0) AS BIGINT) AS unused_size_kb,
  format('Analyzed {{}} indexes. Found {{}} unused indexes consuming {{:,}} KB', count(*),
    count(*) FILTER (WHERE usage_category = 'Unused'),
    CAST(coalesce(sum(size_kb) FILTER (WHERE usage_category = 'Unused'), 0) AS BIGINT)) AS message FROM scores""",
        ),
        "impact_ranking": with_derived(("candidate_log",), f"{_IMPACT} SELECT * EXCLUDE (cents) FROM ranking {_IMPACT_TOP}"),
        "impact_summary": with_derived(
            ("candidate_log",),
            f"""{_IMPACT} SELECT count(*) AS total_suggestions, count(*) FILTER (WHERE priority = 'High') AS high_priority,
  count(*) FILTER (WHERE priority = 'Medium') AS medium_priority, count(*) FILTER (WHERE priority = 'Low') AS low_priority,
  {_scaled('sum(cents)', 2, 28)} AS total_potential_improvement,
  'Found ' || count(*) || ' missing index suggestions. ' || count(*) FILTER (WHERE priority = 'High') ||
  ' high priority, ' || count(*) FILTER (WHERE priority = 'Medium') || ' medium priority' AS message FROM ranking""",
        ),
        "wait_share": with_derived(("wait_log",), f"{_WAITS} SELECT * EXCLUDE (share, w) FROM waits {_WAITS_TOP}"),
        "wait_summary": with_derived(
            ("wait_log",),
            f"""{_WAITS}, top AS (SELECT * FROM waits ORDER BY share DESC, w DESC, wait_type LIMIT 1)
  SELECT CAST(sum(waits.w) AS DECIMAL(28,3)) AS total_wait_time_ms, count(*) AS unique_wait_types,
  (SELECT wait_type FROM top) AS top_wait_type, (SELECT percentage_of_total FROM top) AS top_wait_percentage,
  'Analyzed ' || count(*) || ' wait types. Top wait: ' || (SELECT wait_type FROM top) || ' (' ||
  (SELECT {_one_decimal('share')} FROM top) || '%)' AS message FROM waits""",
        ),
        "wait_bottlenecks": with_derived(
            ("wait_log",),
            f"""{_WAITS} SELECT wait_category, {_scaled('s', 2, 7)} AS total_percentage,
  wait_category || ' (' || {_one_decimal('s')} || '% of total waits)' AS bottleneck
  FROM (SELECT wait_category, CAST(sum(share) AS BIGINT) AS s FROM waits GROUP BY 1) b WHERE s > 500
  ORDER BY s DESC, wait_category LIMIT 3""",
        ),
    }


# -- audit ---------------------------------------------------------------------------------------


def _listed(*items: tuple[str, str]) -> str:
    """Texts whose condition holds, joined; items are (condition, SQL text)."""
    arms = ", ".join(f"CASE WHEN {c} THEN {t} END" for c, t in items)
    return f"array_to_string(list_filter([{arms}], lambda x: x IS NOT NULL), '; ')"


def _count(pattern: str) -> str:
    return f"CAST(len(regexp_extract_all(upper(query_text), {_q(pattern)})) AS INTEGER)"


_COMPLEX = f"""
, c AS (SELECT *, {_count(r'\bJOIN\b')} AS join_count, {_count(r'\(\s*SELECT\b')} AS subquery_count,
    {' + '.join(_count(rf'\b{fn}\s*\(') for fn in AGGREGATES)} AS aggregate_count,
    regexp_matches(upper(query_text), '\\bOVER\\s*\\(') AS has_window_functions,
    contains(upper(query_text), 'WITH') AND contains(upper(query_text), 'UNION') AS has_recursive_cte FROM query_log),
s AS (SELECT *, 2 * join_count + 3 * subquery_count + aggregate_count + CASE WHEN has_window_functions THEN 5 ELSE 0 END
    + CASE WHEN has_recursive_cte THEN 10 ELSE 0 END AS complexity_score FROM c),
l AS (SELECT *, CASE WHEN complexity_score <= 3 THEN 'Simple' WHEN complexity_score <= 8 THEN 'Medium'
    WHEN complexity_score <= 15 THEN 'Complex' ELSE 'VeryComplex' END AS complexity_level FROM s)"""

_COST = _scaled("cost_hundredths", 2)
_USAGE_OF_COST = """CASE WHEN coalesce(cost_hundredths, 0) < 100 THEN 'Low' WHEN cost_hundredths < 1000 THEN 'Medium'
  WHEN cost_hundredths < 10000 THEN 'High' ELSE 'Very High' END"""
_COST_ADVICE = "'Consider optimizing this query as it has a very high estimated cost'"


def _audit() -> dict[str, str]:
    t = "trim(upper(query_text))"
    writes = [
        (f"starts_with({t}, '{op} ') OR contains({t}, ' {op} ')", f"'Query contains write operation: {op}'")
        for op in WRITE_OPERATIONS
    ]
    dangers = [
        (f"contains({t}, '{fn.upper()}')", f"'Query contains dangerous function: {fn}'")
        for fn in DANGEROUS_FUNCTIONS
    ]
    hints = [
        (_hit(t, p), _q(f"Potential SQL injection pattern detected: {p}")) for p in INJECTION_PATTERNS
    ]
    any_write = " OR ".join(f"({c})" for c, _ in writes)
    any_danger = " OR ".join(f"({c})" for c, _ in dangers)
    any_hint = " OR ".join(c for c, _ in hints)
    log = ("query_log",)
    plan = ("plan_log",)
    unsafe = f"({any_write} OR {any_danger})"
    complexity = _listed(
        ("complexity_level = 'VeryComplex'", "'Query is very complex and may have performance implications'"),
        ("join_count > 5", "'Query contains ' || join_count || ' joins which may impact performance'"),
    )
    advice = _listed(
        ("cost_hundredths >= 10000", _COST_ADVICE),
        ("join_count > 3", "'Consider adding appropriate indexes for join operations'"),
        ("subquery_count > 2", "'Consider rewriting subqueries as CTEs or joins for better performance'"),
        ("contains(upper(query_text), 'SELECT *')", "'Avoid SELECT * and specify only required columns'"),
    )
    operators = """
, e AS (SELECT plan_id, regexp_extract_all(plan_text, '<RelOp\\b[^>]*>') AS found FROM plan_log),
x AS (SELECT plan_id, generate_subscripts(found, 1) AS operator_no, unnest(found) AS el FROM e),
o AS (SELECT plan_id, CAST(operator_no AS INTEGER) AS operator_no, regexp_extract(el, 'PhysicalOp="([^"]+)"', 1) AS operator_type,
  CAST(regexp_extract(el, 'EstimateCPU="([^"]+)"', 1) AS DECIMAL(38,12)) AS estimated_cost,
  CAST(regexp_extract(el, 'EstimateRows="([^"]+)"', 1) AS DECIMAL(38,12)) AS estimated_rows FROM x)"""
    return {
        "audit_safety": with_derived(
            log,
            f"""SELECT query_id, query_text, {_listed(*hints)} AS warnings, NOT ({any_write} OR {any_danger}) AS is_safe,
  ({any_write}) AS contains_write_operations, ({any_danger}) AS contains_dangerous_functions,
  {_listed(*writes, *dangers)} AS violations, CASE WHEN {any_write} OR {any_danger} THEN 'Query contains unsafe operations'
  WHEN {any_hint} THEN 'Query passed safety check but has warnings' ELSE 'Query is safe to execute' END AS message
  FROM query_log""",
        ),
        "audit_complexity": with_derived(
            log,
            f"""{_COMPLEX} SELECT query_id, query_text, join_count, subquery_count, aggregate_count, has_window_functions,
  has_recursive_cte, complexity_score, complexity_level FROM l""",
        ),
        "audit_warnings": with_derived(
            log,
            f"{_COMPLEX} SELECT query_id, complexity_level, {complexity} AS complexity_warnings FROM l",
        ),
        "audit_validation": with_derived(
            log,
            f"""{_COMPLEX} SELECT query_id, complexity_level, {complexity} AS complexity_warnings,
  {_listed(*writes, *dangers)} AS validation_errors, CASE WHEN {unsafe} THEN {_listed(*hints)} ELSE '' END
  AS validation_warnings FROM l""",
        ),
        "audit_cost_estimate": with_derived(
            log,
            f"""{_COMPLEX} SELECT query_id, {_COST} AS estimated_cost, NOT {unsafe} AS success,
  CASE WHEN NOT {unsafe} THEN {_USAGE_OF_COST} END AS resource_usage, CASE WHEN NOT {unsafe} THEN {advice} END AS recommendations,
  CASE WHEN {unsafe} THEN 'Query safety validation failed: Query contains unsafe operations'
    ELSE 'Cost estimation completed. Estimated cost: ' || coalesce(CAST({_COST} AS VARCHAR), '0') END AS message FROM l""",
        ),
        "cost_rating": with_derived(
            log,
            f"""SELECT query_id, {_COST} AS estimated_cost, {_USAGE_OF_COST} AS resource_usage,
  CASE WHEN cost_hundredths >= 10000 THEN {_COST_ADVICE} END AS cost_advice FROM query_log""",
        ),
        "audit_recommendations": with_derived(
            log,
            f"{_COMPLEX} SELECT query_id, {_USAGE_OF_COST} AS resource_usage, {advice} AS recommendations FROM l",
        ),
        "plan_costs": with_derived(
            plan,
            """, c AS (SELECT plan_id, coalesce(TRY_CAST(regexp_extract(plan_text, 'StatementSubTreeCost="([^"]+)"', 1)
  AS DECIMAL(38,12)), 0) AS estimated_cost FROM plan_log) SELECT plan_id, CAST(estimated_cost AS DECIMAL(38,12)) AS estimated_cost,
  CASE WHEN estimated_cost < 1 THEN 'Low' WHEN estimated_cost < 10 THEN 'Medium' WHEN estimated_cost < 100 THEN 'High'
  ELSE 'Very High' END AS resource_usage FROM c""",
        ),
        "plan_tree": with_derived(
            plan,
            """, marks AS (SELECT plan_id, unnest(m) AS mark, generate_subscripts(m, 1) AS pos
    FROM (SELECT plan_id, regexp_extract_all(plan_text, '<RelOp\\b[^>]*>|</RelOp\\s*>') AS m FROM plan_log)),
  levels AS (SELECT *, mark LIKE '<RelOp%' AS opens,
    sum(CASE WHEN mark LIKE '</%' THEN -1 WHEN mark LIKE '%/>' THEN 0 ELSE 1 END) OVER (PARTITION BY plan_id ORDER BY pos)
      - CASE WHEN mark LIKE '<RelOp%' AND mark NOT LIKE '%/>' THEN 1 ELSE 0 END AS depth FROM marks),
  numbered AS (SELECT *, row_number() OVER (PARTITION BY plan_id ORDER BY pos) AS no FROM levels WHERE opens),
  placed AS (SELECT c.*, (SELECT max(p.no) FROM numbered p WHERE p.plan_id = c.plan_id AND p.pos < c.pos AND p.depth = c.depth - 1) AS parent
    FROM numbered c)
SELECT plan_id, CAST(no AS INTEGER) AS operator_no, regexp_extract(mark, 'PhysicalOp="([^"]+)"', 1) AS operator_type,
  CAST(depth AS INTEGER) AS depth, CAST(parent AS INTEGER) AS parent_no,
  CAST((SELECT count(*) FROM placed d WHERE d.plan_id = c.plan_id AND d.parent = c.no) AS INTEGER) AS children,
  CAST(TRY_CAST(regexp_extract(mark, 'EstimateCPU="([^"]+)"', 1) AS DECIMAL(38,12)) AS DECIMAL(38,12)) AS own_cost FROM placed c""",
        ),
        "plan_operators": with_derived(plan, f"{operators} SELECT * FROM o"),
        "plan_operator_totals": with_derived(
            plan,
            f"""{operators} SELECT operator_type, count(*) AS operator_count, CAST(sum(estimated_cost) AS DECIMAL(38,12)) AS total_cost,
  CAST(sum(estimated_rows) AS DECIMAL(38,12)) AS total_rows FROM o GROUP BY operator_type""",
        ),
    }


# -- DML -----------------------------------------------------------------------------------------


def _dml() -> dict[str, str]:
    both = ("dml_target", "dml_source")
    merged = """SELECT t.o_orderkey, CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice
  FROM dml_target t LEFT JOIN dml_source s ON t.o_orderkey = s.o_orderkey
  UNION ALL SELECT * FROM dml_source s WHERE NOT EXISTS (SELECT 1 FROM dml_target t WHERE t.o_orderkey = s.o_orderkey)"""
    updated = """SELECT CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE o_orderkey END AS o_orderkey,
  CASE WHEN o_orderstatus = 'F' THEN o_orderkey ELSE o_custkey END AS o_custkey,
  CASE WHEN o_orderstatus = 'F' THEN 'U' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM dml_target"""
    deleted = "SELECT * FROM dml_target WHERE o_orderstatus IS DISTINCT FROM 'F'"
    failed = "(SELECT count(*) FROM dml_target WHERE o_orderstatus = 'F')"
    return {
        "insert_rows": with_derived(both, "SELECT * FROM dml_target UNION ALL SELECT * FROM dml_source"),
        "update_rows": with_derived(("dml_target",), updated),
        "delete_rows": with_derived(("dml_target",), deleted),
        "merge_rows": with_derived(both, merged),
        "table_after_insert": with_derived(both, "SELECT * FROM dml_target UNION ALL SELECT * FROM dml_source"),
        "table_after_update": with_derived(
            ("dml_target",),
            """SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 100 = 1 THEN 'U' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_custkey % 100 = 1 THEN CAST(o_custkey AS DOUBLE) ELSE o_totalprice END AS o_totalprice FROM dml_target""",
        ),
        "table_after_delete": with_derived(("dml_target",), deleted),
        "table_after_merge": with_derived(both, merged),
        "commands_affected": with_derived(
            both,
            f"""SELECT 'insert' AS operation, (SELECT count(*) FROM dml_source) AS affected_rows,
    (SELECT count(*) FROM dml_target) + (SELECT count(*) FROM dml_source) AS rows_after
  UNION ALL SELECT 'update', (SELECT count(*) FROM dml_target WHERE o_custkey % 100 = 1), (SELECT count(*) FROM dml_target)
  UNION ALL SELECT 'delete', {failed}, (SELECT count(*) FROM ({deleted}))
  UNION ALL SELECT 'merge', (SELECT count(*) FROM dml_source), (SELECT count(*) FROM ({merged}))""",
        ),
        # A merge touches each source row once here: keys are unique, and a row updates or inserts.
        "dml_affected": with_derived(
            both,
            f"""SELECT 'insert' AS operation, (SELECT count(*) FROM dml_source) AS affected_rows
  UNION ALL SELECT 'update', {failed} UNION ALL SELECT 'delete', {failed}
  UNION ALL SELECT 'merge', (SELECT count(*) FROM dml_source)""",
        ),
    }


def _rolled_up(found: dict[str, str]) -> dict[str, str]:
    """Merged batches give what one pass over the log gives."""
    return {f"{name}_rolled_up": found[name] for name in ("impact_ranking", "wait_share")}


def oracle_sql() -> dict[str, str]:
    return {**_rolled_up(_workload()), **_pii(), **_tables(), **_query(), **_catalog(), **_workload(), **_audit(), **_dml()}


# Queries whose result depends on the clock.
ROWS_ONLY = ("query_with_stats",)
