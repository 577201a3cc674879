"""Value detectors as column expressions.

Patterns are searched in the whole text. Word boundaries, digits and white space are Unicode-aware
(``(?U)``), which also makes them independent of the Java version. Patterns that must cover the whole
value start with ``^`` outside any alternation, so they fail at the first character of a long text.

Rules that count digits take an optional ``digits`` column, so a caller can project the digits once and
share them among rules and maskers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cloakframe.functions.names import ACCOUNT_RULE, MONEY_RULE
from cloakframe.functions.text import digits_of, is_blank

# What each kind of personal datum looks like.
# An address may begin at any word boundary of a run of these characters. The run is entered at its start only, and
# one look along it tells whether there is a boundary, so the time is linear in the length of the text.
_LOCAL = "A-Za-z0-9._%+-"
EMAIL = (
    rf"(?U)(?<![{_LOCAL}])(?:\b|(?=[A-Za-z0-9_]++[.%+-]|[.%+-]++[A-Za-z0-9_]))[{_LOCAL}]++@"
    r"[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
)
# An optional country code and opening bracket may precede a phone number; they never decide a match.
PHONE = r"(?U)[0-9]{3}\)?[-.\s]?[0-9]{3}[-.\s]?[0-9]{4}"
# The rules below begin at a word boundary. They look for digits first and check the boundary looking
# back, because few places in a text hold digits while every word has a boundary.
SSN = r"(?U)\d{3}(?<!\w\d{3})(?:-\d{2}-\d{4}|\d{6})\b"
CARD = r"(?U)\d{4}(?<!\w\d{4})[-\s]?(?:\d{4}[-\s]?){2}\d{4}\b"
IBAN = r"(?U)\d{2}(?<=\b[A-Za-z]{2}\d{2})[A-Za-z0-9]{4,30}\b"
ROUTING = r"(?U)\d{9}(?<!\w\d{9})\b"
BANK_ACCOUNT = r"(?U)\d{8}(?<!\w\d{8})\d{0,9}\b"
# Groups may be split by any white space, but at least one "-", "." or " " must be among the splits.
FORMATTED_ACCOUNT = (
    r"(?Ud)^(?:\d{3}-\d{5,8}|\d{2}(?:-\d{2}){2,5}-\d{4,10}"
    r"|\d{2,4}(?=[^-. ]*[-. ])(?:[-.\s]\d{2,8}){1,6})$"
)
ABA_WEIGHTS = (3, 7, 1, 3, 7, 1, 3, 7, 1)

# Rules of names that allow short account numbers.
ACCOUNT_RULES = (ACCOUNT_RULE, "bank_account")

# Money by look, grouped or plain, with two decimals or none.
_MONEY_LOOK = r"\$?\d{1,3}(?:,\d{3})*(?:\.\d{2})?|\d+\.\d{2}|\d+"
# Money by value: a plain number below one billion that has at most two decimals once rounded to ten.
# A minus sign takes one of the two places. Commas may stand anywhere after the first digit.
_WHOLE = r"(?=[0-9])[0,]*(?:[1-9],*(?:[0-9],*){0,8})?"


def _decimals(places: int) -> str:
    zeros, nines = f"0{{{10 - places}}}", f"9{{{10 - places}}}"
    lead = f"[0-9]{{{places}}}"
    return (
        rf"(?:[0-9]{{0,{places}}}0{{0,{10 - places}}}|{lead}{zeros}[0-4][0-9]*|{lead}{nines}[5-9][0-9]*)"
    )


def _unsigned(places: int) -> str:
    return rf"(?:{_WHOLE}(?:\.{_decimals(places)})?|\.(?=[0-9]){_decimals(places)})"


_PAD = r"[\t-\r ]*"
_PLUS, _MINUS = _unsigned(2), _unsigned(1)
_MONEY_NUMBER = (
    rf"{_PAD}(?:\+?{_PLUS}{_PAD}|{_PLUS}{_PAD}\+{_PAD}|-{_MINUS}{_PAD}|{_MINUS}{_PAD}-{_PAD})"
)
MONEY = rf"(?Ud)^(?:{_MONEY_LOOK}|{_MONEY_NUMBER})$"
# Values that masking leaves alone whatever their column: blank or money.
BLANK_OR_MONEY = rf"(?Ud)^(?:\s*|{_MONEY_LOOK}|{_MONEY_NUMBER})$"


def is_email(v: Column) -> Column:
    return v.contains("@") & v.rlike(EMAIL)


def is_phone(v: Column) -> Column:
    return v.rlike(PHONE)


def is_ssn(v: Column) -> Column:
    return v.rlike(SSN)


def is_card(v: Column) -> Column:
    return v.rlike(CARD)


def is_iban(v: Column) -> Column:
    return v.rlike(IBAN)


def aba_checksum(nine_digits: Column) -> Column:
    """Weighted digit sum of a nine-digit text is a multiple of ten."""
    total = sum(
        (F.substring(nine_digits, i + 1, 1).try_cast("int") * w for i, w in enumerate(ABA_WEIGHTS)),
        F.lit(0),
    )
    valid = F.coalesce((F.length(nine_digits) == 9) & (total % 10 == 0), F.lit(False))
    return F.when(nine_digits.isNotNull(), valid)


def is_routing_number(v: Column, digits: Column | None = None) -> Column:
    return v.rlike(ROUTING) & aba_checksum(digits_of(v) if digits is None else digits)


def is_bank_account(
    v: Column, rule: str | Column = "plain", digits: Column | None = None, account_name: Column | None = None
) -> Column:
    """A run of 8-17 digits. Names that speak of accounts need no more; others need 10+ digits in all
    and not the length of a card. ``rule`` is ``names.name_rule`` of the column name; as that tells one meaning
    only, ``account_name`` (``names.names_an_account``) says so for names like ``account_email``."""
    n = F.length(digits_of(v) if digits is None else digits)
    by_name, by_length = n.between(8, 17), n.isin(10, 11, 12, 13, 14, 17)
    run = v.rlike(BANK_ACCOUNT)
    if isinstance(rule, str):
        if rule == MONEY_RULE:
            return F.when(v.isNotNull(), F.lit(False))
        return run & (by_name if rule in ACCOUNT_RULES else by_length)
    named = rule.isin(*ACCOUNT_RULES) if account_name is None else account_name
    return (rule != MONEY_RULE) & run & F.when(named, by_name).otherwise(by_length)


def is_formatted_account(v: Column, digits: Column | None = None) -> Column:
    """Digit groups joined by ``-``, ``.`` or white space over the whole value, 6-20 digits."""
    return v.rlike(FORMATTED_ACCOUNT) & F.length(digits_of(v) if digits is None else digits).between(6, 20)


def is_monetary(v: Column, rule: str | Column = "plain") -> Column:
    """The value reads as money, or the rule of its column name says so."""
    if isinstance(rule, str):
        return F.lit(True) if rule == MONEY_RULE else v.rlike(MONEY)
    return (rule == MONEY_RULE) | v.rlike(MONEY)


def has_digit_pair(v: Column) -> Column:
    """Every rule but e-mail needs two digits in a row; most long texts have none, so this one scan
    spares them the other patterns."""
    return v.rlike(r"\p{Nd}{2}")


def rule_digits(v: Column) -> Column:
    """Digits of a value that some digit rule might accept, else NULL."""
    return F.when(has_digit_pair(v), digits_of(v))


def contains_pii(v: Column, digits: Column | None = None) -> Column:
    """Any detector fires. Money is no exception here, unlike in masking.

    ``digits`` is ``rule_digits(v)``, projected by the caller.
    """
    d = rule_digits(v) if digits is None else digits
    # A routing number is nine digits between word boundaries, which the SSN rule already accepts.
    by_digits = (
        is_phone(v) | is_ssn(v) | is_card(v) | is_iban(v) | is_bank_account(v, digits=d) | is_formatted_account(v, d)
    )
    return F.coalesce(~is_blank(v) & (is_email(v) | (d.isNotNull() & by_digits)), F.lit(False))
