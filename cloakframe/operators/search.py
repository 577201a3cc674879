"""Keyword search over catalogs and over named rows.

The term is plain text unless ``wildcards`` is set: then ``%`` is any text and ``_`` any character.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cloakframe.operators import catalog
from cloakframe.sources.tables import TABLES, load_tables

# Score of an exact name, a prefix, a part of the name, and a hit in the description only.
EXACT, PREFIX, PART, DESCRIPTION = 100, 90, 70, 50
OBJECT_TYPES = ("Table", "Column", "Index")
HIT_COLUMNS = ("object_type", "object_name", "schema_name", "table_name", "data_type", "description")


def _holds(text: Column, term: str, wildcards: bool) -> Column:
    low, wanted = F.lower(text), term.lower()
    return low.like(f"%{wanted}%") if wildcards else low.contains(wanted)


def match_score(name: Column, term: str, wildcards: bool = False) -> Column:
    low, wanted = F.lower(name), term.lower()
    exact, start = (low.like(wanted), low.like(f"{wanted}%")) if wildcards else (low == wanted, low.startswith(wanted))
    return F.when(exact, EXACT).when(start, PREFIX).when(_holds(name, term, wildcards), PART).otherwise(DESCRIPTION)


def _hits(name: Column, description: Column | None, term: str, wildcards: bool) -> Column:
    in_name = F.coalesce(_holds(name, term, wildcards), F.lit(False))
    if description is None:
        return in_name
    return in_name | _holds(F.coalesce(description, F.lit("")), term, wildcards)


def keyword_rank(
    df: DataFrame, name: str, term: str, description: str | None = None, wildcards: bool = False
) -> DataFrame:
    """Rows whose name or description holds the term, with a score. A filter and a projection."""
    about = F.col(description) if description else None
    found = df.where(_hits(F.col(name), about, term, wildcards))
    return found.withColumn("match_score", match_score(F.col(name), term, wildcards))


def _hit_frame(df: DataFrame, object_type: str, term: str, described: bool, wildcards: bool = False) -> DataFrame:
    """``df`` holds object_name and any of schema_name, table_name, data_type, description."""
    have = set(df.columns)
    columns = [
        (F.col(c) if c in have else F.lit(None)).cast("string").alias(c) for c in HIT_COLUMNS if c != "object_type"
    ]
    shaped = df.select(F.lit(object_type).alias("object_type"), *columns)
    return keyword_rank(shaped, "object_name", term, "description" if described else None, wildcards)


def schema_search(
    term: str,
    tables: DataFrame,
    columns: DataFrame,
    indexes: DataFrame | None = None,
    object_type: str | None = None,
    wildcards: bool = False,
) -> DataFrame:
    """Tables (by name or description), columns and indexes (by name) that match a term."""
    wanted = (object_type or "").lower()
    found = []
    if wanted in ("", "table"):
        found.append(_hit_frame(tables, "Table", term, True, wildcards))
    if wanted in ("", "column"):
        found.append(_hit_frame(columns, "Column", term, False, wildcards))
    if wanted in ("", "index") and indexes is not None:
        found.append(_hit_frame(indexes, "Index", term, False, wildcards))
    if not found:
        return _hit_frame(tables, "Table", term, described=True).where(F.lit(False))
    return reduce(DataFrame.unionByName, found)


def _type_rank() -> Column:
    return F.array_position(F.array(*[F.lit(t) for t in OBJECT_TYPES]), F.col("object_type"))


def by_score(hits: DataFrame) -> DataFrame:
    """Report order: score, then tables before columns before indexes, then name."""
    return hits.orderBy(F.desc("match_score"), _type_rank(), "object_name", "table_name")


def search_catalog(
    spark: SparkSession,
    directory: str,
    term: str,
    object_type: str | None = None,
    wildcards: bool = False,
    descriptions: dict[str, str] | None = None,
    tables: tuple[str, ...] = TABLES,
) -> DataFrame:
    """The tables and columns of a directory that match a term, best first, with ``rank`` from 1 and the number of
    rows of their table. Files have no indexes. A catalog has as many rows as its tables have columns."""
    frames = load_tables(spark, directory, tables)
    about = [(t, catalog.SCHEMA_NAME, (descriptions or {}).get(t)) for t in tables]
    listed = spark.createDataFrame(about, "object_name string, schema_name string, description string")
    columns = catalog.column_catalog(spark, frames).withColumnRenamed("column_name", "object_name")
    hits = schema_search(term, listed, columns, None, object_type, wildcards)
    sizes = catalog.row_counts(frames).withColumnRenamed("table_name", "of_table")
    counted = hits.join(sizes, F.coalesce("table_name", "object_name") == F.col("of_table")).drop("of_table")
    best = F.desc("match_score"), _type_rank(), "object_name", F.asc_nulls_first("table_name")
    return counted.withColumn("rank", F.row_number().over(Window.orderBy(*best))).orderBy("rank")
