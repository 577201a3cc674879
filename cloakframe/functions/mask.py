"""Maskers and the ordered masking ladder as column expressions.

A masker replaces the whole value; "digits" are all digits of the value, not of the matched part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from cloakframe.functions import detect, names
from cloakframe.functions.text import digits_of, is_blank


def _last(text: Column, n: int) -> Column:
    return F.substring(text, -n, n)


def _stars(n: Column) -> Column:
    return F.repeat(F.lit("*"), n)


def _digits(v: Column, digits: Column | None) -> Column:
    return digits_of(v) if digits is None else digits


def mask_email(v: Column, digits: Column | None = None) -> Column:
    """``b*******h@example.com``; split at the first ``@`` of the value."""
    at = F.instr(v, "@")
    domain = F.substring(v, at, F.length(v))
    kept = F.concat(F.substring(v, 1, 1), _stars(at - 3), F.substring(v, at - 1, F.length(v)))
    return (
        F.when(at <= 1, F.lit("[MASKED_EMAIL]"))
        .when(at <= 3, F.concat(F.lit("**"), domain))
        .when(at.isNotNull(), kept)
    )


def mask_phone(v: Column, digits: Column | None = None) -> Column:
    """First three and last two digits."""
    d = _digits(v, digits)
    shown = F.concat(F.lit("("), F.substring(d, 1, 3), F.lit(") ***-**"), _last(d, 2))
    return F.when(F.length(d) >= 10, shown).when(d.isNotNull(), F.lit("[MASKED_PHONE]"))


def mask_ssn(v: Column, digits: Column | None = None) -> Column:
    d = _digits(v, digits)
    return F.when(F.length(d) == 9, F.concat(F.lit("***-**-"), _last(d, 4))).when(d.isNotNull(), F.lit("[MASKED_SSN]"))


def mask_card(v: Column, digits: Column | None = None) -> Column:
    d = _digits(v, digits)
    shown = F.concat(F.lit("****-****-****-"), _last(d, 4))
    return F.when(F.length(d) >= 13, shown).when(d.isNotNull(), F.lit("[MASKED_CARD]"))


# In "-bb-ccc-dddd": each character of a middle group, and of the last group those before its last four
# (before its last two if it has three or four, all if it has fewer).
_HIDDEN_IN_GROUPS = (
    r"[^-](?=[^-]*-|[^-]{4,}\z)|(?<=-)[^-](?=[^-]{0,3}\z)|(?<=-[^-])[^-](?=(?:[^-]{2})?\z)"
)


def mask_formatted_account(v: Column, digits: Column | None = None) -> Column:
    """First group kept, middle groups starred, the last shows four characters (two if short)."""
    groups = F.regexp_replace(F.btrim(v, F.lit("-. ")), r"[-. ]+", "-")
    first_dash = F.instr(groups, "-")
    rest = F.regexp_replace(F.substring(groups, first_dash, F.length(groups)), _HIDDEN_IN_GROUPS, "*")
    masked = F.concat(F.substring(groups, F.lit(1), first_dash - 1), rest)
    joint = F.when(v.contains("-"), F.lit("-")).when(v.contains("."), F.lit(".")).otherwise(F.lit(" "))
    return F.when(first_dash == 0, F.lit("[MASKED_ACCOUNT]")).otherwise(F.replace(masked, F.lit("-"), joint))


def mask_bank_account(v: Column, digits: Column | None = None) -> Column:
    d = _digits(v, digits)
    return F.when(F.length(d) >= 8, F.concat(F.lit("****"), _last(d, 4))).when(
        d.isNotNull(), F.lit("[MASKED_ACCOUNT]")
    )


def mask_routing(v: Column, digits: Column | None = None) -> Column:
    d = _digits(v, digits)
    return F.when(F.length(d) == 9, F.concat(F.substring(d, 1, 4), F.lit("*****"))).when(
        d.isNotNull(), F.lit("[MASKED_ROUTING]")
    )


def mask_iban(v: Column, digits: Column | None = None) -> Column:
    """First and last four characters of the value."""
    n = F.length(v)
    return F.when(n >= 8, F.concat(F.substring(v, 1, 4), _stars(n - 8), _last(v, 4))).when(
        n.isNotNull(), F.lit("[MASKED_IBAN]")
    )


def mask_generic(v: Column, digits: Column | None = None) -> Column:
    n = F.length(v)
    return F.when(n <= 4, _stars(n)).otherwise(F.concat(F.substring(v, 1, 1), _stars(n - 2), _last(v, 1)))


def mask_password(v: Column, digits: Column | None = None) -> Column:
    return F.when(v.isNotNull(), F.lit("[REDACTED]"))


MASKERS: dict[str, Callable[[Column, Column | None], Column]] = {
    "email": mask_email,
    "phone": mask_phone,
    "ssn": mask_ssn,
    "card": mask_card,
    "password": mask_password,
    "bank_account": mask_bank_account,
    "routing": mask_routing,
    "iban": mask_iban,
    "formatted_account": mask_formatted_account,
    "generic": mask_generic,
}
# Maskers that look at the digits only.
DIGIT_KINDS = ("phone", "ssn", "card", "bank_account", "routing")


def mask_by_type(v: Column, kind: str | Column, digits: Column | None = None) -> Column:
    """Apply the masker of a kind; a fixed kind costs no dispatch per row.

    ``digits`` is ``digits_of(v)``, projected by the caller.
    """
    if isinstance(kind, str):
        return MASKERS[kind](v, digits)
    ladder = None
    for name in names.KINDS[:-1]:
        masked = MASKERS[name](v, digits)
        ladder = F.when(kind == name, masked) if ladder is None else ladder.when(kind == name, masked)
    return ladder.otherwise(mask_generic(v))


def _branches(v: Column, rule: str | Column, d: Column) -> list[tuple[Column, str]]:
    """Value rules in order; the first that holds gives the class.

    The routing rule is absent: each value it accepts is an SSN match first.
    """
    return [
        (detect.is_email(v), "email"),
        (d.isNull(), "none"),
        (detect.is_phone(v), "phone"),
        (detect.is_ssn(v), "ssn"),
        (detect.is_card(v), "card"),
        (detect.is_iban(v), "iban"),
        (detect.is_bank_account(v, rule, d), "bank_account"),
        (detect.is_formatted_account(v, d), "formatted_account"),
    ]


def shares_digits(rule: str) -> bool:
    """Do the steps of ``mask_by_rule`` for a fixed rule have digits to share?"""
    return rule in DIGIT_KINDS or rule in (names.PLAIN_RULE, names.ACCOUNT_RULE)


def shared_digits(v: Column, rule: str | Column) -> Column:
    """The digits column those steps share."""
    if isinstance(rule, str):
        return digits_of(v) if rule in DIGIT_KINDS else detect.rule_digits(v)
    return F.when(rule.isin(*DIGIT_KINDS) | detect.has_digit_pair(v), digits_of(v))


def mask_by_rule(v: Column, rule: str | Column, digits: Column | None = None) -> Column:
    """Mask one value by the rule of its column name (``names.name_rule``).

    Order: null and blank stay; money by name or by value stays; sensitive names use their kind of
    mask; then the value rules, first hit wins. ``digits`` is ``shared_digits(v, rule)``, projected by the
    caller so that it is computed once; without it the expression stands alone.
    """
    unchanged = v.rlike(detect.BLANK_OR_MONEY)
    if isinstance(rule, str):
        if rule == names.MONEY_RULE:
            return v
        ladder = F.when(unchanged, v)
        if rule in names.KINDS:
            return ladder.otherwise(mask_by_type(v, rule, digits))
    else:
        ladder = F.when((rule == names.MONEY_RULE) | unchanged, v)
        ladder = ladder.when(rule.isin(*names.KINDS), mask_by_type(v, rule, digits))
    d = shared_digits(v, rule) if digits is None else digits
    for condition, kind in _branches(v, rule, d):
        ladder = ladder.when(condition, v if kind == "none" else MASKERS[kind](v, d))
    return ladder.otherwise(v)


def mask_value(v: Column, name: str | Column) -> Column:
    """Mask one value in the context of its column name, as one expression."""
    return mask_by_rule(v, names.name_rule(name))


def pii_class(v: Column, rule: str | Column = names.PLAIN_RULE, digits: Column | None = None) -> Column:
    """Label of the step a value takes: ``blank``, ``monetary``, ``sensitive_name``, a class or ``none``."""
    ladder = F.when(v.isNull() | is_blank(v), "blank").when(detect.is_monetary(v, rule), "monetary")
    if isinstance(rule, str):
        if rule in names.KINDS:
            return ladder.otherwise("sensitive_name")
    else:
        ladder = ladder.when(rule.isin(*names.KINDS), "sensitive_name")
    d = shared_digits(v, rule) if digits is None else digits
    for condition, kind in _branches(v, rule, d):
        ladder = ladder.when(condition, kind)
    return ladder.otherwise("none")
