from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cloakframe.operators import audit
from cloakframe.plans.derived import derived


def one(spark, operator, text, **extra):
    df = spark.createDataFrame([(text, *extra.values())], ", ".join(["query_text string", *[f"{k} decimal(18,2)" for k in extra]]))
    return operator(df).first()


@pytest.mark.parametrize(
    "text,violations",
    [
        ("SELECT 1", []),
        ("  delete from t", ["Query contains write operation: DELETE"]),
        ("WITH x AS (SELECT 1) INSERT INTO t SELECT 1", ["Query contains write operation: INSERT"]),
        ("SELECT updated FROM t", []),
        ("SELECT 1\nDROP\nTABLE t", []),  # only spaces separate words here
        ("exec XP_CMDSHELL 'x'", ["Query contains dangerous function: xp_cmdshell"]),
        (" drop table t", ["Query contains write operation: DROP"]),
        (
            "insert into t select * from openrowset('x') ; drop table u",
            [
                "Query contains write operation: INSERT",
                "Query contains write operation: DROP",
                "Query contains dangerous function: OPENROWSET",
            ],
        ),
    ],
)
def test_violations(spark, text, violations):
    row = one(spark, audit.audit_safety, text)
    assert row["violations"] == violations
    assert row["is_safe"] is (not violations)
    if violations:
        assert row["message"] == "Query contains unsafe operations"


@pytest.mark.parametrize(
    "text,warnings",
    [
        ("SELECT 1; drop", [r";\s*(DROP|DELETE|INSERT|UPDATE)"]),
        ("SELECT 1 UNION\nSELECT 2", [r"UNION\s+SELECT"]),
        ("SELECT 1 --  ", [r"--\s*$"]),
        ("SELECT 1 -- x", []),
        ("SELECT /* a */ 1", [r"\/\*.*\*\/"]),
        ("SELECT /* a\n */ 1", []),
        ("SELECT /* a\r */ 1", [r"\/\*.*\*\/"]),
    ],
)
def test_warnings(spark, text, warnings):
    row = one(spark, audit.audit_safety, text)
    assert row["warnings"] == [f"Potential SQL injection pattern detected: {p}" for p in warnings]
    assert row["is_safe"] is True
    wanted = "Query passed safety check but has warnings" if warnings else "Query is safe to execute"
    assert row["message"] == wanted


@pytest.mark.parametrize(
    "text,score,level",
    [
        ("SELECT a FROM t", 0, "Simple"),
        ("SELECT a FROM t JOIN u ON 1=1", 2, "Simple"),
        ("SELECT count(*), sum (a), AVG(b), accountMAX(c) FROM t", 3, "Simple"),
        ("SELECT a FROM (SELECT 1) x JOIN y ON 1=1", 5, "Medium"),
        ("SELECT sum(a) OVER (ORDER BY b) FROM t", 6, "Medium"),
        ("SELECT max(n) FROM t with union", 11, "Complex"),
        ("with r as (select 1 union select 2) select min(a) over (order by b) from r", 19, "VeryComplex"),
        ("SELECT joined FROM joins", 0, "Simple"),
    ],
)
def test_complexity(spark, text, score, level):
    row = one(spark, audit.audit_complexity, text)
    assert (row["complexity_score"], row["complexity_level"]) == (score, level)


def test_complexity_warnings(spark):
    row = one(spark, audit.audit_warnings, "SELECT 1 FROM a " + "JOIN b ON 1=1 " * 8)
    assert row["complexity_warnings"] == [
        "Query is very complex and may have performance implications",
        "Query contains 8 joins which may impact performance",
    ]


@pytest.mark.parametrize("cost,bucket", [("0.99", "Low"), ("1", "Medium"), ("9.99", "Medium"), ("10", "High"), ("100", "Very High")])
def test_cost(spark, cost, bucket):
    row = one(spark, audit.cost_rating, "x", estimated_cost=Decimal(cost))
    assert row["resource_usage"] == bucket
    assert (row["cost_advice"] is not None) is (bucket == "Very High")


def test_recommendations(spark):
    text = "select * from a join b on 1=1 join c on 1=1 join d on 1=1 join e on 1=1 where x in (select 1) or y in (select 2) or z in ( select 3)"
    row = one(spark, lambda df: audit.audit_recommendations(df, cost="c"), text, c=Decimal(500))
    assert row["recommendations"] == [
        "Consider optimizing this query as it has a very high estimated cost",
        "Consider adding appropriate indexes for join operations",
        "Consider rewriting subqueries as CTEs or joins for better performance",
        "Avoid SELECT * and specify only required columns",
    ]
    assert one(spark, audit.audit_recommendations, "SELECT a FROM t")["recommendations"] == []


def test_plan_texts(spark):
    plans = spark.createDataFrame(
        [
            (1, '<S StatementSubTreeCost="12.5"><RelOp PhysicalOp="Scan" EstimateRows="1,000" EstimateCPU="0.5"><RelOp EstimateCPU="1e-5" '
                'PhysicalOp="Seek" EstimateRows="x"/></RelOp></S>'),
            (2, '<S StatementSubTreeCost="oops" StatementSubTreeCost="3">'),
            (3, None),
        ],
        "plan_id int, plan_text string",
    )
    costs = {r["plan_id"]: r["estimated_cost"] for r in audit.plan_costs(plans).collect()}
    assert costs == {1: Decimal("12.5"), 2: 0, 3: 0}
    found = audit.plan_operators(plans).orderBy("operator_no").collect()
    assert [(r["operator_type"], r["estimated_cost"], r["estimated_rows"]) for r in found] == [
        ("Scan", Decimal("0.5"), 1000), ("Seek", 0, 0),
    ]
    totals = {r["operator_type"]: r["total_rows"] for r in audit.plan_operator_totals(plans).collect()}
    assert totals == {"Scan": 1000, "Seek": 0}


def test_audits_are_narrow(spark):
    log = spark.createDataFrame([("SELECT 1",)], "query_text string")
    for operator in (audit.audit_safety, audit.audit_complexity, audit.audit_warnings, audit.audit_recommendations):
        text = operator(log).select(F.lit(1))._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text


@pytest.mark.parametrize("text", ["0.000000123", "123456789012345678901234.5", "0", "x"])
def test_plan_numbers_are_exact(spark, text):
    plan = f'<S StatementSubTreeCost="{text}"/>'
    cost = audit.plan_costs(spark.createDataFrame([(plan,)], "plan_text string")).first()["estimated_cost"]
    assert cost == (0 if text == "x" else Decimal(text))


def test_a_cost_that_is_not_set(spark):
    log = spark.createDataFrame([("SELECT 1", None)], "query_text string, estimated_cost decimal(18,2)")
    row = audit.audit_cost_estimate(log).first()
    assert (row["message"], row["resource_usage"]) == ("Cost estimation completed. Estimated cost: 0", "Low")


def test_plan_tree_against_an_xml_parser(spark, data_dir):
    """Depth, parent, children and own cost as an XML parser finds them, on plans of a log and on made ones."""
    import random
    import xml.etree.ElementTree as ET
    from decimal import Decimal

    chance = random.Random(3)

    def element(depth):
        attributes = f'PhysicalOp="Op{chance.randrange(9)}" EstimatedTotalSubtreeCost="{chance.randrange(100)}.5" EstimateCPU="0.25"'
        inner = "".join(element(depth + 1) for _ in range(chance.randrange(0, 4 if depth < 4 else 1)))
        if not inner and chance.random() < 0.5:
            return f"<RelOp {attributes} />"
        return f"<RelOp {attributes}><Other>{inner}</Other></RelOp>"

    texts = [f"<Plan>{element(0)}{element(0)}</Plan>" for _ in range(60)]
    texts += [r.plan_text for r in derived(spark, data_dir, "plan_log").limit(200).collect()]
    wanted = []
    for i, text in enumerate(texts):
        number = 0

        def walk(node, parent, depth):
            nonlocal number
            mine, children, below = (parent, depth, None), 0, Decimal(0)
            if node.tag == "RelOp":
                number += 1
                mine = (number, depth + 1, node)
            found = []
            for child in node:
                found += walk(child, mine[0], mine[1])
            if node.tag != "RelOp":
                return found
            children, below = len(found), sum((c for c in found), Decimal(0))
            cost = node.get("EstimatedTotalSubtreeCost")
            own = Decimal(cost) - below if cost else Decimal(node.get("EstimateCPU"))
            wanted.append((i, mine[0], node.get("PhysicalOp"), depth, parent, children, own))
            return [Decimal(cost or 0)]

        walk(ET.fromstring(text), None, 0)
    plans = spark.createDataFrame(list(enumerate(texts)), "i int, plan_text string")
    got = [tuple(r) for r in audit.plan_tree(plans).collect()]
    assert sorted(got) == sorted(wanted, key=lambda r: r[:2])


def test_plan_tree_of_broken_texts(spark):
    op = lambda n, end=">": f'<RelOp PhysicalOp="{n}" EstimateCPU="1"{end}'
    texts = [None, "", f"</RelOp>{op('a')}{op('b')}", f"{op('a', '/>')}{op('b')}</RelOp></RelOp>{op('c')}", "<RelOps><RelOp/>"]
    plans = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] * 2, "i int, plan_text string")
    got = sorted((r.i, r.operator_no, r.operator_type, r.depth, r.parent_no) for r in audit.plan_tree(plans).collect())
    assert got == sorted([(2, 1, "a", 0, None), (2, 2, "b", 1, 1), (3, 1, "a", 0, None), (3, 2, "b", 0, None), (3, 3, "c", 0, None), (4, 1, "", 0, None)] * 2)
