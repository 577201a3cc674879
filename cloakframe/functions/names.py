"""Column-name rules: money names, sensitive names and the kind of mask a name asks for.

Each rule takes a ``str`` (decided once on the driver) or a ``Column`` (for catalogs of many names).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from cloakframe.functions.text import any_of, contains_any

# Parts of a name that mark a money column.
MONEY_PARTS = (
    "balance", "amount", "total", "price", "cost", "value", "worth", "fee", "charge", "payment",
    "deposit", "withdrawal",
)
# Fixed value: aggregate words that mark a money column when a word starts with them.
MONEY_WORD = r"\b(sum|net|gross|min|max|avg|average)(_|$)"

# Names that are sensitive as a whole.
SENSITIVE_NAMES = (
    "email", "emailaddress", "email_address", "e_mail",
    "phone", "phonenumber", "phone_number", "mobile", "cellphone", "telephone",
    "ssn", "socialsecuritynumber", "social_security_number",
    "creditcard", "credit_card", "cardnumber", "card_number",
    "password", "pwd", "passcode", "pin",
    "dob", "dateofbirth", "date_of_birth", "birthdate",
    "address", "street", "streetaddress", "street_address",
    "zipcode", "zip_code", "postalcode", "postal_code",
    "driverlicense", "driver_license", "license_number",
    "accountnumber", "account_number", "bankaccount", "bank_account",
    "routingnumber", "routing_number", "aba", "aba_number",
    "iban", "swift", "sortcode", "sort_code", "bsb",
    "accountno", "acct_number", "acct_no", "bank_acc",
)
# Parts of a name that make it sensitive.
SENSITIVE_PARTS = ("email", "phone", "ssn", "password", "address", "routing", "iban", "bank")

# Kind of mask by part of the name; the first hit decides, "generic" otherwise.
MASK_KINDS = (
    ("email", ("email",)),
    ("phone", ("phone", "mobile", "telephone")),
    ("ssn", ("ssn", "social")),
    ("card", ("card", "credit")),
    ("password", ("password", "pwd")),
    ("iban", ("iban",)),
    ("routing", ("routing", "aba")),
    ("bank_account", ("account", "bank", "acct")),
)
ACCOUNT_PARTS = ("account", "bank", "acct")

# What is said of a name.
SENSITIVE_MESSAGE = "This column is flagged as potentially containing PII"
NOT_SENSITIVE_MESSAGE = "This column is not flagged as sensitive"


def is_balance_column(name: str | Column):
    """Names that hold money are never treated as personal."""
    if isinstance(name, str):
        low = name.lower()
        return (
            any(p in low for p in MONEY_PARTS)
            or low.endswith("amt")
            or low.startswith("amt_")
            or re.search(MONEY_WORD, low) is not None
        )
    low = F.lower(name)
    return contains_any(low, MONEY_PARTS) | low.endswith("amt") | low.startswith("amt_") | low.rlike(MONEY_WORD)


def is_sensitive_column(name: str | Column):
    """Names that call for masking whatever the value looks like."""
    if isinstance(name, str):
        low = name.lower()
        plain_account = "account" in low and "name" not in low and "type" not in low
        return not is_balance_column(name) and (
            low in SENSITIVE_NAMES or any(p in low for p in SENSITIVE_PARTS) or plain_account
        )
    low = F.lower(name)
    plain_account = low.contains("account") & ~low.contains("name") & ~low.contains("type")
    return ~is_balance_column(name) & (
        low.isin(*SENSITIVE_NAMES) | contains_any(low, SENSITIVE_PARTS) | plain_account
    )


def masking_type(name: str | Column):
    """The kind of mask a sensitive name asks for."""
    if isinstance(name, str):
        low = name.lower()
        return next((kind for kind, parts in MASK_KINDS if any(p in low for p in parts)), "generic")
    low = F.lower(name)
    ladder = None
    for kind, parts in MASK_KINDS:
        hit = contains_any(low, parts)
        ladder = F.when(hit, kind) if ladder is None else ladder.when(hit, kind)
    return ladder.otherwise("generic")


def names_an_account(name: str | Column):
    """Names that allow shorter digit runs to count as bank accounts."""
    if isinstance(name, str):
        low = name.lower()
        return any(p in low for p in ACCOUNT_PARTS)
    return any_of([F.lower(name).contains(p) for p in ACCOUNT_PARTS])


# What a name means for masking: "money" (never masked), a kind of mask (sensitive), "account" (not
# sensitive, but short account numbers count) or "plain".
MONEY_RULE, ACCOUNT_RULE, PLAIN_RULE = "money", "account", "plain"
KINDS = tuple(kind for kind, _ in MASK_KINDS) + ("generic",)


def name_rule(name: str | Column):
    """All the name rules folded into one label."""
    if isinstance(name, str):
        if is_balance_column(name):
            return MONEY_RULE
        if is_sensitive_column(name):
            return masking_type(name)
        return ACCOUNT_RULE if names_an_account(name) else PLAIN_RULE
    return (
        F.when(is_balance_column(name), MONEY_RULE)
        .when(is_sensitive_column(name), masking_type(name))
        .when(names_an_account(name), ACCOUNT_RULE)
        .otherwise(PLAIN_RULE)
    )


def sensitivity_message(is_sensitive: Column) -> Column:
    return F.when(is_sensitive, SENSITIVE_MESSAGE).otherwise(NOT_SENSITIVE_MESSAGE)
