from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cloakframe.functions import names
from cloakframe.operators.masking import check_column_sensitivity, classify_columns, sensitive_column_counts
from cloakframe.plans.derived import NAME_STEMS

CASES = [
    # name, balance, sensitive, kind if sensitive
    ("Email", False, True, "email"),
    ("customer_email", False, True, "email"),
    ("e_mail", False, True, "generic"),
    ("mobile", False, True, "phone"),
    ("ssn", False, True, "ssn"),
    ("social_security_number", False, True, "ssn"),
    ("card_number", False, True, "card"),
    ("pwd", False, True, "password"),
    ("iban_code", False, True, "iban"),
    ("routing_no", False, True, "routing"),
    ("aba_number", False, True, "routing"),
    ("account_no", False, True, "bank_account"),
    ("bank_name", False, True, "bank_account"),
    ("acct_no", False, True, "bank_account"),
    ("dob", False, True, "generic"),
    ("zip_code", False, True, "generic"),
    ("street_address", False, True, "generic"),
    ("account_name", False, False, None),
    ("account_type", False, False, None),
    ("email_value", True, False, None),
    ("payment_card_number", True, False, None),
    ("feedback_email", True, False, None),
    ("account_balance", True, False, None),
    ("bank_fee", True, False, None),
    ("avg_x", True, False, None),
    ("x_amt", True, False, None),
    ("amt_x", True, False, None),
    ("max", True, False, None),
    ("max1", False, False, None),
    ("summary", False, False, None),
    ("c_acctbal", False, False, None),
]


@pytest.mark.parametrize("name,balance,sensitive,kind", CASES)
def test_rules_on_the_driver(name, balance, sensitive, kind):
    assert names.is_balance_column(name) is balance
    assert names.is_sensitive_column(name) is sensitive
    if sensitive:
        assert names.masking_type(name) == kind


def test_rules_as_columns_agree_with_the_driver(spark):
    variants = [v for n in NAME_STEMS + names.SENSITIVE_NAMES for v in (n, n.upper(), f"x_{n}", f"{n}_1", f"sum_{n}")]
    df = classify_columns(spark.createDataFrame([(v,) for v in variants], "column_name string"))
    for row in df.collect():
        name = row["column_name"]
        assert row["is_balance"] == names.is_balance_column(name), name
        assert row["is_sensitive"] == names.is_sensitive_column(name), name
        assert row["masking_type"] == (names.masking_type(name) if row["is_sensitive"] else None), name


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcdefghijklmnoprstuvwxyz_", max_size=20))
def test_a_money_name_is_never_sensitive(name):
    assert not (names.is_balance_column(name) and names.is_sensitive_column(name))


def test_counts_and_messages(spark):
    catalog = spark.createDataFrame(
        [("t", "email"), ("t", "city"), ("u", "ssn"), ("u", "pin"), ("v", "note")], "table_name string, column_name string"
    )
    counts = {r["table_name"]: (r["column_count"], r["sensitive_count"]) for r in sensitive_column_counts(catalog).collect()}
    assert counts == {"t": (2, 1), "u": (2, 2), "v": (1, 0)}
    shown = check_column_sensitivity(catalog).where(F.col("column_name").isin("email", "city"))
    assert {r["column_name"]: r["message"] for r in shown.collect()} == {
        "email": "This column is flagged as potentially containing PII",
        "city": "This column is not flagged as sensitive",
    }
