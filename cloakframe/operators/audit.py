"""Audit of query texts and plan texts in bulk: one narrow projection per rule set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloakframe.functions.text import parse_decimal, trimmed

# Statements that write.
WRITE_OPERATIONS = ("INSERT", "UPDATE", "DELETE", "DROP", "CREATE", "ALTER", "TRUNCATE", "MERGE")
# Functions that reach outside the database.
DANGEROUS_FUNCTIONS = ("xp_cmdshell", "sp_configure", "OPENROWSET", "OPENDATASOURCE")
# Patterns that hint at injection, as they are reported.
INJECTION_PATTERNS = (
    r";\s*(DROP|DELETE|INSERT|UPDATE)",
    r"UNION\s+SELECT",
    r"--\s*$",
    r"\/\*.*\*\/",
)
# A literal part of each pattern: texts without it are not searched.
INJECTION_PARTS = (";", "UN", "--", "/*")
# Aggregate functions that add to the score.
AGGREGATES = ("COUNT", "SUM", "AVG", "MIN", "MAX", "GROUP_CONCAT")


def _messages(*items: tuple[Column, str | Column]) -> Column:
    """The texts whose condition holds, in order."""
    none = F.array().cast("array<string>")
    return F.concat(*[F.when(c, F.array(F.lit(m) if isinstance(m, str) else m)).otherwise(none) for c, m in items])


def _safety_columns(text: Column) -> dict[str, Column]:
    writes = [
        (text.startswith(op + " ") | text.contains(f" {op} "), f"Query contains write operation: {op}")
        for op in WRITE_OPERATIONS
    ]
    dangers = [
        (text.contains(fn.upper()), f"Query contains dangerous function: {fn}") for fn in DANGEROUS_FUNCTIONS
    ]
    hints = [
        (text.contains(part) & text.rlike("(?Uid)" + p), f"Potential SQL injection pattern detected: {p}")
        for part, p in zip(INJECTION_PARTS, INJECTION_PATTERNS, strict=True)
    ]
    return {"__writes": _messages(*writes), "__dangers": _messages(*dangers), "warnings": _messages(*hints)}


def audit_safety(log: DataFrame, text: str = "query_text") -> DataFrame:
    """Write operations, dangerous functions and injection hints in the trimmed upper-case text."""
    upper = log.withColumn("__text", F.upper(trimmed(F.col(text))))
    found = upper.withColumns(_safety_columns(F.col("__text"))).drop("__text")
    writes, dangers = F.size("__writes") > 0, F.size("__dangers") > 0
    message = (
        F.when(writes | dangers, "Query contains unsafe operations")
        .when(F.size("warnings") > 0, "Query passed safety check but has warnings")
        .otherwise("Query is safe to execute")
    )
    return found.withColumns(
        {
            "is_safe": ~(writes | dangers),
            "contains_write_operations": writes,
            "contains_dangerous_functions": dangers,
            "violations": F.concat("__writes", "__dangers"),
            "message": message,
        }
    ).drop("__writes", "__dangers")


def audit_complexity(log: DataFrame, text: str = "query_text") -> DataFrame:
    """Joins, subqueries, aggregates, windows and recursion in the text, with score and level."""
    upper = log.withColumn("__text", F.upper(F.col(text)))
    t = F.col("__text")

    def hits(pattern: str, part: str) -> Column:
        """How often a pattern occurs; texts without its literal part are not searched."""
        return F.when(t.contains(part), F.regexp_count(t, F.lit("(?U)" + pattern))).otherwise(0)

    counted = upper.withColumns(
        {
            "join_count": hits(r"\bJOIN\b", "JOIN"),
            "subquery_count": hits(r"\(\s*SELECT\b", "SELECT"),
            "aggregate_count": hits(rf"\b(?:{'|'.join(AGGREGATES)})\s*\(", "("),
            "has_window_functions": t.contains("OVER") & t.rlike(r"(?U)\bOVER\s*\("),
            "has_recursive_cte": t.contains("WITH") & t.contains("UNION"),
        }
    ).drop("__text")
    score = (
        F.col("join_count") * 2
        + F.col("subquery_count") * 3
        + F.col("aggregate_count")
        + F.when(F.col("has_window_functions"), 5).otherwise(0)
        + F.when(F.col("has_recursive_cte"), 10).otherwise(0)
    )
    scored = counted.withColumn("complexity_score", score)
    s = F.col("complexity_score")
    level = F.when(s <= 3, "Simple").when(s <= 8, "Medium").when(s <= 15, "Complex").otherwise("VeryComplex")
    return scored.withColumn("complexity_level", level)


# The texts of warnings and advice in the functions below, as they are reported.


def audit_warnings(log: DataFrame, text: str = "query_text") -> DataFrame:
    """Warnings a validation adds for complex texts and many joins."""
    rated = audit_complexity(log, text)
    joins = F.col("join_count")
    warnings = _messages(
        (
            F.col("complexity_level") == "VeryComplex",
            "Query is very complex and may have performance implications",
        ),
        (
            joins > 5,
            F.concat(F.lit("Query contains "), joins.cast("string"), F.lit(" joins which may impact performance")),
        ),
    )
    return rated.withColumn("complexity_warnings", warnings)


def cost_bucket(cost: Column) -> Column:
    """A cost that is not set counts as 0."""
    cost = F.coalesce(cost, F.lit(0))
    return (
        F.when(cost < 1, "Low").when(cost < 10, "Medium").when(cost < 100, "High").when(cost >= 100, "Very High")
    )


def cost_rating(log: DataFrame, cost: str = "estimated_cost") -> DataFrame:
    """Resource usage bucket of an estimated cost, with advice for the highest."""
    advice = "Consider optimizing this query as it has a very high estimated cost"
    rated = log.withColumn("resource_usage", cost_bucket(F.col(cost)))
    return rated.withColumn("cost_advice", F.when(F.col("resource_usage") == "Very High", advice))


def audit_recommendations(log: DataFrame, text: str = "query_text", cost: str | None = None) -> DataFrame:
    """Advice drawn from the text, after the advice on the cost where a cost column is named."""
    rated = audit_complexity(log, text)
    items: list[tuple[Column, str | Column]] = []
    if cost is not None:
        rated = cost_rating(rated, cost)
        items.append((F.col("cost_advice").isNotNull(), F.col("cost_advice")))
    items += [
        (F.col("join_count") > 3, "Consider adding appropriate indexes for join operations"),
        (F.col("subquery_count") > 2, "Consider rewriting subqueries as CTEs or joins for better performance"),
        (F.upper(F.col(text)).contains("SELECT *"), "Avoid SELECT * and specify only required columns"),
    ]
    return rated.withColumn("recommendations", _messages(*items))


def audit_validation(log: DataFrame, text: str = "query_text") -> DataFrame:
    """What validation reports besides syntax: violations, the hints of unsafe texts and complexity warnings."""
    audited = audit_safety(audit_warnings(log, text), text)
    none = F.array().cast("array<string>")
    return audited.withColumns(
        {
            "validation_errors": F.col("violations"),
            "validation_warnings": F.when(F.col("is_safe"), none).otherwise(F.col("warnings")),
        }
    )


def audit_cost_estimate(log: DataFrame, text: str = "query_text", cost: str = "estimated_cost") -> DataFrame:
    """Cost report per text: unsafe texts are refused, others get a usage bucket and recommendations."""
    refusal = audit_safety(log, text).select("*", F.col("is_safe").alias("success"), F.col("message").alias("verdict"))
    rated = audit_recommendations(refusal, text, cost)
    safe = F.col("success")
    done = F.concat(F.lit("Cost estimation completed. Estimated cost: "), F.coalesce(F.col(cost).cast("string"), F.lit("0")))
    return rated.withColumns(
        {
            "resource_usage": F.when(safe, F.col("resource_usage")),
            "recommendations": F.when(safe, F.col("recommendations")),
            "message": F.when(safe, done).otherwise(F.concat(F.lit("Query safety validation failed: "), "verdict")),
        }
    ).select(*log.columns, "success", "resource_usage", "recommendations", "message")


# Plan numbers keep 26 digits before the point and twelve behind it.
PLAN_DIGITS, PLAN_DECIMALS = 38, 12


def _decimal_or_zero(text: Column) -> Column:
    number = parse_decimal(text, PLAN_DIGITS, PLAN_DECIMALS)
    return F.coalesce(number, F.lit(0).cast(f"decimal({PLAN_DIGITS},{PLAN_DECIMALS})"))


def plan_costs(plans: DataFrame, text: str = "plan_text") -> DataFrame:
    """Estimated cost of each plan text: its first statement cost, else 0."""
    found = plans.withColumn("__cost", F.regexp_extract(F.col(text), 'StatementSubTreeCost="([^"]+)"', 1))
    return found.withColumn("estimated_cost", _decimal_or_zero(F.col("__cost"))).drop("__cost")


def plan_operators(plans: DataFrame, text: str = "plan_text") -> DataFrame:
    """One row per operator element of each plan text, with its own CPU cost and row estimate."""
    keep = [c for c in plans.columns if c != text]
    element = F.lit(r'<RelOp\b[^>]*\bPhysicalOp="[^"]+"[^>]*>')
    elements = plans.select(*keep, F.posexplode(F.regexp_extract_all(F.col(text), element, F.lit(0))))

    def attribute(name: str) -> Column:
        return F.regexp_extract(F.col("col"), rf'\b{name}="([^"]+)"', 1)

    # The attributes are a projection of their own: parsing looks at each text several times.
    found = elements.select(
        *keep,
        (F.col("pos") + 1).alias("operator_no"),
        attribute("PhysicalOp").alias("operator_type"),
        attribute("EstimateCPU").alias("cpu"),
        attribute("EstimateRows").alias("rows"),
    )
    return found.select(
        *keep,
        "operator_no",
        "operator_type",
        _decimal_or_zero(F.col("cpu")).alias("estimated_cost"),
        _decimal_or_zero(F.col("rows")).alias("estimated_rows"),
    )


def plan_tree(plans: DataFrame, text: str = "plan_text") -> DataFrame:
    """The operator elements of each plan text with their nesting: depth, parent, children and own cost.

    Open and close marks are folded in order with a stack of open elements. A self-closing element holds nothing; a close
    mark without an open one is passed over; elements that are never closed end with the text. An element's own cost is
    its subtree's (``EstimatedTotalSubtreeCost``) less those of its children; where it states none, its ``EstimateCPU``.
    """
    keep = [c for c in plans.columns if c != text]
    marks = F.regexp_extract_all(F.col(text), F.lit(r"<RelOp\b[^>]*>|</RelOp\s*>"), F.lit(0))
    first = F.struct(
        F.lit(0).alias("count"), F.array().cast("array<int>").alias("open"),
        F.array().cast("array<struct<no:int,parent:int,depth:int,mark:string>>").alias("found"),
    )

    def step(state: Column, mark: Column) -> Column:
        open_, no = state["open"], state["count"] + 1
        inside = F.size(open_)
        closed = F.struct(
            state["count"].alias("count"), F.slice(open_, 1, F.greatest(inside - 1, F.lit(0))).alias("open"), state["found"].alias("found")
        )
        element = F.struct(
            no.alias("no"), F.when(inside > 0, F.get(open_, inside - 1)).alias("parent"), inside.alias("depth"), mark.alias("mark")
        )
        opened = F.struct(
            no.alias("count"), F.when(mark.endswith("/>"), open_).otherwise(F.concat(open_, F.array(no))).alias("open"),
            F.concat(state["found"], F.array(element)).alias("found"),
        )
        return F.when(mark.startswith("</"), closed).otherwise(opened)

    folded = F.aggregate(marks, first, step, lambda state: state["found"])

    def attribute(mark: Column, name: str) -> Column:
        return F.regexp_extract(mark, rf'\b{name}="([^"]+)"', 1)

    parsed = F.transform(
        folded,
        lambda e: F.struct(
            e["no"].alias("no"), e["parent"].alias("parent"), e["depth"].alias("depth"), attribute(e["mark"], "PhysicalOp").alias("type"),
            attribute(e["mark"], "EstimatedTotalSubtreeCost").alias("subtree"), attribute(e["mark"], "EstimateCPU").alias("cpu"),
        ),
    )
    costed = F.transform(
        "__parsed",
        lambda e: F.struct(
            e["no"].alias("no"), e["parent"].alias("parent"), e["depth"].alias("depth"), e["type"].alias("type"),
            F.when(e["subtree"] != "", _decimal_or_zero(e["subtree"])).alias("subtree"), _decimal_or_zero(e["cpu"]).alias("cpu"),
        ),
    )

    def with_children(e: Column) -> Column:
        below = F.filter("__costed", lambda c: c["parent"] == e["no"])
        cost = "decimal(38,12)"
        held = F.aggregate(below, F.lit(0).cast(cost), lambda a, c: (a + F.coalesce(c["subtree"], F.lit(0))).cast(cost))
        return F.struct(
            e["no"].alias("operator_no"), e["type"].alias("operator_type"), e["depth"].alias("depth"), e["parent"].alias("parent_no"),
            F.size(below).alias("children"), F.coalesce(e["subtree"].cast(cost) - held, e["cpu"]).cast(cost).alias("own_cost"),
        )

    steps = plans.select(*keep, parsed.alias("__parsed")).select(*keep, costed.alias("__costed"))
    return steps.select(*keep, F.inline(F.transform("__costed", with_children)))


def plan_operator_totals(plans: DataFrame, text: str = "plan_text") -> DataFrame:
    """Operators of all plans rolled up by type."""
    return plan_operators(plans, text).groupBy("operator_type").agg(
        F.count("*").alias("operator_count"),
        F.sum("estimated_cost").cast("decimal(38,12)").alias("total_cost"),
        F.sum("estimated_rows").cast("decimal(38,12)").alias("total_rows"),
    )
