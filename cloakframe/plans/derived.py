"""Inputs derived from the given tables by SQL that reads the same in Spark and in DuckDB.

Each derivation covers every row of its tables. Remainders only pick which *form* a value takes.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from cloakframe.sources.tables import TABLES, register_tables

# Column names that exercise the name rules.
NAME_STEMS = (
    "Email", "customer_email", "e_mail", "mobile", "phone", "cellphone", "ssn", "social_security_number",
    "socialsecuritynumber", "card_number", "creditcard", "credit_card", "password", "pwd", "passcode", "pin",
    "dob", "date_of_birth", "birthdate", "street", "street_address", "zip_code", "postalcode", "driver_license",
    "license_number", "iban_code", "routing_no", "aba_number", "aba", "swift", "sort_code", "bsb", "account_no",
    "bank_name", "acct_no", "acct_number", "bank_acc", "account_name", "account_type", "ACCOUNT_ID", "email_value",
    "payment_card_number", "feedback_email", "account_balance", "bank_fee", "total_phone", "avg_x", "x_amt",
    "amt_x", "max", "max_ssn", "account_email", "bank_phone", "bank_card_no", "net", "gross_pay", "max1", "summary", "c_acctbal", "note", "remark", "ip",
    "user_name", "city", "country", "k", "created_at", "shipment", "withdrawal_iban", "unit_price",
)


def _text(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


def _pad(expression: str, width: int, fill: str = "0") -> str:
    return f"lpad({_text(expression)}, {width}, '{fill}')"


def value_forms(k: str) -> list[str]:
    """SQL texts for values of many forms around a whole number ``k``."""
    t = _text(k)
    return [
        "CAST(NULL AS STRING)",
        "''",
        "'   '",
        _pad(k, 9, "1"),
        f"'4111' || {_pad(k, 12)}",
        f"'$' || {_text(f'1 + {k} % 999')} || ',' || {_pad(f'{k} % 1000', 3)} || '.' || {_pad(f'{k} % 100', 2)}",
        f"{t} || '.5'",
        f"'-' || {t} || '.3'",
        f"'-' || {t} || '.34'",
        f"'-' || {_pad(k, 10, '1')}",
        f"'0.3333333333' || {t}",
        f"'bob.smith' || {t} || '@example.com'",
        f"'ab@x' || {t} || '.example.com'",
        f"'Contact bob' || {t} || '@example.com now'",
        f"'(212) 555-' || {_pad(f'{k} % 10000', 4)}",
        f"'+1 212.555.' || {_pad(f'{k} % 10000', 4)}",
        f"{_pad(f'{k} % 900', 3)} || '-' || {_pad(f'{k} % 90', 2)} || '-' || {_pad(f'{k} % 10000', 4)}",
        f"'Customer#' || {_pad(k, 9)}",
        f"{_pad(k, 9)} || ' ref'",
        f"'4111 1111 ' || {_pad(f'{k} % 10000', 4)} || ' 1111'",
        f"'4111111111' || {_pad(f'{k} % 1000000', 6)} || ' x'",
        f"'GB29 NWBK' || {_text(f'{k} % 10')}",
        f"'AB12CDEF' || {_text(f'{k} % 10')}",
        f"'GB29NWBK' || {_pad(k, 14)}",
        f"'ref ' || {_pad(k, 8, '1')} || ' part 99'",
        f"'014-' || {_pad(f'{k} % 100000', 5)}",
        f"'01-01-01-99-' || {_pad(k, 7, '1')}",
        f"'20' || {_text(f'10 + {k} % 20')} || '-0' || {_text(f'1 + {k} % 9')} || '-15'",
        f"'192.168.' || {_text(f'10 + {k} % 90')} || '.' || {_text(f'{k} % 250')}",
        f"'1234.' || {_pad(f'{k} % 1000', 3)}",
        f"'12.' || {_pad(f'{k} % 10000', 4)}",
        f"'1/' || {_text(f'1 + {k} % 28')} || '/2024 12:00:00 AM'",
        "'True'",
        f"' ' || {t} || ' '",
        f"{t} || '-'",
        f"{t} || ' - '",
        f"'1,2,' || {t}",
        f"'12 34 ' || {_pad(f'{k} % 10000', 4)}",
        f"'AC ' || {_pad(f'{k} * 7919 % 1000000000', 10)}",
        f"'@handle' || {t}",
        f"'0210-0002-' || {_text(f'{k} % 10')}",
        f"'014-' || {_pad(f'{k} % 100000', 5)} || chr(10)",
        f"{t} || '.120000000000'",
        f"{t} || '.999999999999'",
        f"'-' || {t} || '.00000000001'",
        f"'12345678901.55' || {_text(f'{k} % 10')}",
        f"'+' || {t} || '.5-'",
        f"'état' || {_pad(k, 9)}",
        f"'n°' || {_pad(k, 9)}",
        f"'ref 1234567890' || {_pad(f'{k} % 10', 1)} || 'a' || {_pad(f'{k} % 100', 2)}",
        f"'id 12345678' || {_text(f'{k} % 10')} || '.' || {_text(f'{k} % 10')}",
        f"'x|y' || {t} || '@mail.example.c|'",
    ]


def _pick(selector: str, options: list[str]) -> str:
    arms = " ".join(f"WHEN {i} THEN {o}" for i, o in enumerate(options))
    return f"CASE {selector} % {len(options)} {arms} END"


_STEMS = [f"'{s}'" for s in NAME_STEMS]

DERIVED: dict[str, str] = {
    "people": """
SELECT c_custkey AS person_id,
  c_name AS full_name,
  CASE WHEN c_custkey % 10 = 0 THEN 'n/a' WHEN c_custkey % 10 = 1 THEN 'ab@x.example.com'
       WHEN c_custkey % 10 = 2 THEN CAST(NULL AS STRING)
       ELSE 'user' || CAST(c_custkey AS STRING) || '@mail' || CAST(c_nationkey AS STRING) || '.example.com' END AS email,
  CASE WHEN c_custkey % 9 = 0 THEN '555-' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')
       ELSE '(' || CAST(200 + c_custkey % 700 AS STRING) || ') 555-' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')
       END AS mobile_phone,
  CASE WHEN c_custkey % 7 = 0 THEN lpad(CAST(c_custkey AS STRING), 9, '1')
       ELSE lpad(CAST(c_custkey % 900 AS STRING), 3, '0') || '-' || lpad(CAST(c_custkey % 90 AS STRING), 2, '0')
            || '-' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0') END AS ssn,
  '4111 1111 ' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0') || ' 1234' AS credit_card,
  'GB' || lpad(CAST(c_custkey % 100 AS STRING), 2, '0') || 'NWBK' || lpad(CAST(c_custkey AS STRING), 14, '0') AS iban,
  CASE WHEN c_custkey % 2 = 0 THEN '0210-0002-1' ELSE '021000021' END AS routing_number,
  'AC ' || lpad(CAST(c_custkey * 7919 % 1000000000 AS STRING), 10, '0') AS bank_acc,
  'pw' || CAST(c_custkey AS STRING) AS password,
  '19' || CAST(50 + c_custkey % 50 AS STRING) || '-0' || CAST(1 + c_custkey % 9 AS STRING) || '-15' AS dob,
  c_mktsegment || ' St ' || CAST(c_custkey % 90 AS STRING) AS street_address,
  c_mktsegment AS account_type,
  c_acctbal AS account_balance,
  'ship ' || CASE c_custkey % 6 WHEN 0 THEN 'to bob' || CAST(c_custkey AS STRING) || '@example.org today'
       WHEN 1 THEN 'call 212-555-0199' WHEN 2 THEN 'card 4111 1111 1111 1111' WHEN 3 THEN 'id 123-45-6789'
       WHEN 4 THEN 'ref 12345678 part 99' ELSE 'nothing' END AS remark
FROM customer""",
    "value_shapes": f"""
SELECT o_orderkey AS row_id, {_pick('o_custkey', value_forms('o_orderkey'))} AS v FROM orders""",
    "named_values": f"""
SELECT event_id AS row_id, {_pick('event_id', _STEMS)} AS column_name,
  {_pick('user_id', value_forms('event_id'))} AS v
FROM events""",
    "column_names": f"""
SELECT event_id, event_type AS table_name,
  CASE event_id % 4 WHEN 0 THEN event_type || '_' || stem WHEN 1 THEN stem || '_' || CAST(user_id AS STRING)
       ELSE stem END AS column_name
FROM (SELECT event_id, event_type, user_id, {_pick('event_id', _STEMS)} AS stem FROM events) s""",
    "field_values": f"""
SELECT 'orders' AS source, o_orderkey AS row_id, {_pick('o_custkey', value_forms('o_orderkey'))} AS v FROM orders
UNION ALL SELECT 'documents', doc_id, text FROM documents
UNION ALL SELECT 'pages', page_id, html FROM pages
UNION ALL SELECT 'urls', page_id, url FROM pages
UNION ALL SELECT 'conversations', conv_id * 1000 + turn, text FROM conversations
UNION ALL SELECT 'benchmark', item_id, text FROM benchmark
UNION ALL SELECT 'customer', c_custkey, c_name FROM customer
UNION ALL SELECT 'props', event_id, props FROM events""",
    "nine_digits": """
SELECT o_orderkey AS row_id, lpad(CAST(o_orderkey * 7919 % 1000000000 AS STRING), 9, '0') AS v FROM orders
UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN '0210-0002-1' ELSE '021000021' END FROM customer""",
    "query_log": """
SELECT event_id AS query_id,
  'q' || lpad(CAST(event_id % 16 AS STRING), 2, '0') || '-' || lpad(CAST(user_id % 30 AS STRING), 2, '0') AS query_hash,
  CASE event_id % 16
    WHEN 12 THEN 'SELECT a' || chr(10) || '/* ' || chr(9) || 'note */ FROM t --'
    WHEN 13 THEN 'SELECT ' || repeat('column_name, ', 120) || 'x FROM t -- ' || CAST(user_id AS STRING)
    WHEN 14 THEN 'drop table x /* over' || chr(10) || 'lines */ where é = 1'
    WHEN 15 THEN 'with' || chr(9) || 'r as (select count (*), max(a) over (order by b) from ( select 1) union' || chr(10) || 'select 2)'
    WHEN 0 THEN 'SELECT * FROM orders'
    WHEN 1 THEN 'select a, count(*) from t group by a'
    WHEN 2 THEN 'SELECT 1 UNION SELECT 2'
    WHEN 3 THEN 'DELETE FROM orders WHERE o_orderkey = 1'
    WHEN 4 THEN 'SELECT x FROM a JOIN b ON a.k = b.k JOIN c ON c.k = b.k JOIN d ON d.k = c.k JOIN e ON e.k = d.k'
    WHEN 5 THEN 'SELECT sum(v) OVER (PARTITION BY k) FROM t'
    WHEN 6 THEN 'WITH r AS (SELECT 1 AS n UNION ALL SELECT n + 1 FROM r) SELECT max(n) FROM r'
    WHEN 7 THEN 'SELECT 1; DROP TABLE t'
    WHEN 8 THEN 'SELECT a FROM t WHERE k IN (SELECT k FROM u) AND j IN ( SELECT j FROM v) AND i IN (SELECT i FROM w)'
    WHEN 9 THEN 'EXEC xp_cmdshell ''dir'' --'
    WHEN 10 THEN 'SELECT /* hint */ a FROM t JOIN u ON 1=1 JOIN v ON 1=1 JOIN w ON 1=1 JOIN x ON 1=1 JOIN y ON 1=1 JOIN z ON 1=1'
    ELSE '  update t set a = 1  ' END AS query_text,
  CAST(round(value * 20000) AS BIGINT) AS elapsed_us,
  CAST(round(value * 7000) AS BIGINT) AS cpu_us,
  user_id * 10 + event_id % 100 AS logical_reads,
  event_id % 17 AS physical_reads,
  CASE WHEN event_id % 31 = 0 THEN CAST(NULL AS BIGINT) ELSE CAST(round(value * 50) AS BIGINT) END AS cost_hundredths,
  ts AS executed_at
FROM events
UNION ALL SELECT 1000000000 + doc_id, 'd' || CAST(doc_id % 100 AS STRING), text, 900 * (doc_id % 1000), doc_id % 900, doc_id % 50,
  doc_id % 3, CAST(NULL AS BIGINT), TIMESTAMP '2024-01-01 00:00:00' FROM documents""",
    "usage_objects": """
SELECT *, type_code IN (1, 5) AS is_unique, type_code = 1 AS is_primary_key FROM (
SELECT 'main' AS schema_name, 'supplier' AS table_name, s_suppkey AS object_key, s_name AS object_name, 1 AS type_code,
  CAST(length(s_name) * 8 AS BIGINT) AS size_kb FROM supplier
UNION ALL SELECT 'main', 'part', p_partkey, CASE WHEN p_partkey % 50 = 0 THEN CAST(NULL AS STRING) ELSE p_name END,
  CASE WHEN p_partkey % 50 = 0 THEN 0 ELSE 2 END, CAST(length(p_name) * 8 AS BIGINT) FROM part
UNION ALL SELECT 'main', 'region', CAST(r_regionkey AS BIGINT), r_name, 1, CAST(length(r_name) * 8 AS BIGINT) FROM region
UNION ALL SELECT 'main', 'flag', CAST(0 AS BIGINT), 'all', 5, CAST(8 AS BIGINT)
UNION ALL SELECT 'archive', 'flag', CAST(0 AS BIGINT), 'all', 5, CAST(16 AS BIGINT)
UNION ALL SELECT 'archive', 'supplier', s_suppkey, s_name, 1, CAST(8 AS BIGINT) FROM supplier) o""",
    "usage_log": """
SELECT CASE WHEN l_linenumber = 1 THEN 'archive' ELSE 'main' END AS schema_name, 'supplier' AS table_name,
  l_suppkey AS object_key, l_returnflag AS access, l_linestatus AS status, l_shipdate AS used_at FROM lineitem
UNION ALL SELECT 'main', 'part', l_partkey * 2, l_returnflag, l_linestatus, l_shipdate FROM lineitem
UNION ALL SELECT 'main', 'region', CAST(n_regionkey AS BIGINT),
  CASE o_orderstatus WHEN 'F' THEN 'R' WHEN 'O' THEN 'A' ELSE 'N' END, o_orderstatus, o_orderdate
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT 'main', 'flag', CAST(0 AS BIGINT), l_returnflag, l_linestatus, l_shipdate FROM lineitem""",
    "candidate_log": """
SELECT CASE WHEN p_partkey % 3 = 0 THEN 'sales' ELSE 'dbo' END AS schema_name, 'lineitem' AS table_name,
  CASE WHEN p_type = 'ECONOMY' THEN '' ELSE '[' || p_brand || ']' END AS equality_columns,
  CASE WHEN p_brand LIKE '%7' THEN '' ELSE '[' || p_type || ']' END AS inequality_columns,
  CASE WHEN p_brand LIKE '%5' THEN '[l_tax]' ELSE '' END AS included_columns,
  CASE l_returnflag WHEN 'R' THEN 'seek' WHEN 'A' THEN 'scan' ELSE 'other' END AS access,
  CAST(round(l_extendedprice) AS BIGINT) AS cost_units,
  CAST(round(l_discount * 100) AS BIGINT) AS impact_pct,
  l_shipdate AS used_at
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "wait_log": """
SELECT w.wait_type, CAST(round(e.value * 10) AS BIGINT) * w.weight AS wait_ms, e.event_id % 7 AS signal_ms, e.ts
FROM events e JOIN (VALUES (0,'LCK_M_S',9),(1,'LCK_M_X',3),(2,'PAGEIOLATCH_SH',20),(3,'PAGEIOLATCH_EX',2),
  (4,'PAGELATCH_UP',4),(5,'WRITELOG',6),(6,'CXPACKET',15),(7,'ASYNC_NETWORK_IO',5),(8,'RESOURCE_SEMAPHORE',2),
  (9,'THREADPOOL',1),(10,'SOS_SCHEDULER_YIELD',7),(11,'SLEEP_TASK',50),(12,'LAZYWRITER_SLEEP',50),
  (13,'RESOURCE_QUEUE',50),(14,'IO_COMPLETION',2),(15,'EXCHANGE',1),(16,'CMEMTHREAD',1),(17,'BACKUPIO',1),
  (18,'NETWORK_X',1),(19,'PREEMPTIVE_X',0),(20,'LATCH_EX',3),(21,'BACKUPBUFFER',1),(22,'OLEDB',4),(23,'TRACEWRITE',2),
  (24,'MSQL_DQ',1),(25,'LCK_M_U',2),(26,'HADR_SYNC',5)) AS w(idx, wait_type, weight) ON e.user_id % 27 = w.idx""",
    "plan_log": """
SELECT event_id AS plan_id,
  CASE WHEN event_id % 11 = 0 THEN '<Empty/>' ELSE
  '<StmtSimple' || CASE event_id % 5 WHEN 0 THEN '' ELSE ' StatementSubTreeCost="' || CAST(event_id % 200 AS STRING) ||
    CASE event_id % 5 WHEN 1 THEN '.25' WHEN 2 THEN '.000000123' WHEN 3 THEN '56789012345678901234.5' ELSE ' units' END || '"' END
  || '>' || chr(10) || '<RelOp NodeId="0" PhysicalOp="Hash Match" EstimateRows="'
  || CAST(user_id AS STRING) || '" EstimateCPU="0.0000' || CAST(event_id % 97 AS STRING) || '"><RelOp NodeId="1" PhysicalOp="'
  || CASE WHEN event_id % 2 = 0 THEN 'Table Scan' ELSE 'Index Seek' END
  || '" EstimateRows="' || CAST(event_id % 1000 AS STRING) || '" EstimateCPU="0.25"></RelOp></RelOp></StmtSimple>'
  END AS plan_text
FROM events""",
    "dml_target": """
SELECT CASE WHEN o_orderkey % 17 = 0 THEN CAST(NULL AS BIGINT) ELSE o_orderkey END AS o_orderkey, o_custkey,
  CASE WHEN o_orderkey % 13 = 0 THEN CAST(NULL AS STRING) ELSE o_orderstatus END AS o_orderstatus, o_totalprice
FROM orders""",
    "dml_source": """
SELECT CASE WHEN o_orderkey % 19 = 0 THEN CAST(NULL AS BIGINT) ELSE o_orderkey * 2 END AS o_orderkey, o_custkey,
  'M' AS o_orderstatus, o_totalprice + 1 AS o_totalprice
FROM orders""",
    "search_tables": "SELECT p_name AS object_name, p_brand AS schema_name, p_type AS description FROM part",
    "search_columns": """
SELECT c_mktsegment || '_' || c_name AS object_name, 'customer' AS table_name, 'string' AS data_type FROM customer
UNION ALL SELECT event_type, 'events', 'bigint' FROM events
UNION ALL SELECT o_orderpriority, 'orders', 'string' FROM orders""",
    "search_indexes": """
SELECT s_name AS object_name, 'supplier' AS table_name FROM supplier
UNION ALL SELECT n_name, 'nation' FROM nation""",
}


def register_used(spark: SparkSession, directory: str, sql: str) -> None:
    """Views for the tables a text names; the others are not even opened."""
    named = set(re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", sql, re.IGNORECASE))
    used = tuple(t for t in TABLES if t in named)
    register_tables(spark, directory, used)


def derived(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """A derived table over a directory of tables."""
    register_used(spark, directory, DERIVED[name])
    return spark.sql(DERIVED[name])


def with_derived(names: tuple[str, ...], body: str) -> str:
    """A SELECT with derived tables as its first common table expressions."""
    parts = ", ".join(f"{n} AS ({DERIVED[n]})" for n in names)
    return f"WITH {parts}{body if body.lstrip().startswith(',') else ' ' + body}"

