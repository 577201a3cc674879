"""Running SQL over the registered tables with a row cap and masked results."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cloakframe.operators.audit import audit_safety
from cloakframe.operators.masking import mask_capped, mask_table

DEFAULT_MAX_ROWS = 1000

# Seconds above which a run is reported as slow or elevated.
SLOW_SECONDS = 5
ELEVATED_SECONDS = 1


class UnsafeQuery(ValueError):
    """The safety rules refuse the statement."""


def bounded_query(
    spark: SparkSession,
    sql: str,
    max_rows: int | None = DEFAULT_MAX_ROWS,
    args: dict | list | None = None,
    numeric: str = "keep",
) -> DataFrame:
    """Any SELECT, capped at ``max_rows`` and masked, so only rows that are returned pay for masking.

    ``max_rows=None`` masks the whole result, for results that are written rather than shown.
    """
    result = spark.sql(sql, args=args) if args else spark.sql(sql)
    return mask_table(result, numeric) if max_rows is None else mask_capped(result.limit(max_rows), numeric)


def result_message(row_count: int, max_rows: int) -> str:
    if row_count >= max_rows:
        return f"Results limited to {max_rows} rows (PII filtered)"
    return f"Retrieved {row_count} rows (PII filtered)"


@dataclass
class QueryResult:
    """Columns and masked rows of a capped query, as shown to a user."""

    columns: list[str]
    rows: list[T.Row]
    row_count: int
    message: str


def execute_query(spark: SparkSession, sql: str, max_rows: int = DEFAULT_MAX_ROWS) -> QueryResult:
    """Run a query for display: at most ``max_rows`` rows come to the driver, as the caller asked."""
    capped = bounded_query(spark, sql, max_rows)
    rows = capped.collect()
    return QueryResult(capped.columns, rows, len(rows), result_message(len(rows), max_rows))


@dataclass
class QueryRun:
    """Rows of a capped run and its one-row statistics."""

    rows: list[T.Row]
    stats: DataFrame


STATS_SCHEMA = T.StructType(
    [
        T.StructField("row_count", T.LongType()),
        T.StructField("masked_rows", T.LongType()),
        T.StructField("was_truncated", T.BooleanType()),
        T.StructField("execution_ms", T.LongType()),
        T.StructField("performance_warning", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)


def performance_warning(seconds: float) -> str | None:
    if seconds > SLOW_SECONDS:
        return "Query took longer than 5 seconds to execute"
    if seconds > ELEVATED_SECONDS:
        return "Query execution time is elevated"
    return None


def check_safety(spark: SparkSession, sql: str) -> str:
    """Raise on statements the safety rules refuse; otherwise their message."""
    log = spark.createDataFrame([(sql,)], "query_text string")
    verdict = audit_safety(log).first()
    if not verdict["is_safe"]:
        raise UnsafeQuery(f"Query safety validation failed: {verdict['message']}: {', '.join(verdict['violations'])}")
    return verdict["message"]


def query_with_stats(spark: SparkSession, sql: str, max_rows: int = DEFAULT_MAX_ROWS) -> QueryRun:
    """Check, run and time a query for display, like ``execute_query``."""
    check_safety(spark, sql)
    start = time.monotonic()
    # One row more than is shown tells whether the cap cut anything.
    capped = mask_capped(spark.sql(sql).limit(max_rows + 1), flag="__was_masked")
    fetched = capped.collect()
    seconds = time.monotonic() - start
    collected, truncated = fetched[:max_rows], len(fetched) > max_rows
    masked = sum(r["__was_masked"] for r in collected)
    n = len(collected)
    limited = f" (limited to {max_rows} rows)" if truncated else ""
    message = f"Retrieved {n} rows in {round(seconds * 1000)}ms{limited} (PII filtered)"
    stats = [(n, masked, truncated, int(seconds * 1000), performance_warning(seconds), message)]
    names = capped.columns[:-1]
    rows = [T.Row(**{c: r[c] for c in names}) for r in collected]
    return QueryRun(rows, spark.createDataFrame(stats, STATS_SCHEMA))


def query_stats(spark: SparkSession, sql: str, max_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    """The statistics that do not depend on the clock, as a lazy one-row DataFrame.

    Which rows a cap leaves is defined only if the text orders them uniquely.
    """
    capped = mask_capped(spark.sql(sql).limit(max_rows), flag="__was_masked")
    counted = capped.agg(
        F.count("*").alias("row_count"), F.count_if(F.col("__was_masked")).alias("masked_rows")
    )
    reached = spark.sql(sql).limit(max_rows + 1).agg(F.count("*")).scalar()
    return counted.withColumn("was_truncated", reached > max_rows)
