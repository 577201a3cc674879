"""Catalog operators: what tables and columns there are, how large, and which are sensitive.

Loops here run over table and column *names*; the rows are only ever seen by aggregations.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cloakframe.functions import names
from cloakframe.operators.hot_keys import all_present, hot_values, key_counts, left_lookup
from cloakframe.sources.tables import TABLES, load_table, table_path

SCHEMA_NAME = "default"
BASE_TABLE = "BASE TABLE"


@dataclass
class Constraints:
    """What Parquet cannot declare: keys and descriptions by table name."""

    primary_keys: dict[str, list[str]] = field(default_factory=dict)
    foreign_keys: dict[str, list[tuple[str, str, str]]] = field(default_factory=dict)
    descriptions: dict[str, str] = field(default_factory=dict)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def table_list(spark: SparkSession, tables: tuple[str, ...] = TABLES) -> DataFrame:
    """Base tables in name order."""
    rows = [(t, SCHEMA_NAME, BASE_TABLE) for t in sorted(tables)]
    return spark.createDataFrame(rows, "table_name string, schema_name string, table_type string")


def _files(spark: SparkSession, directory: str, table: str) -> DataFrame:
    """Path, length and modificationTime of each file of a table; no content is read."""
    return spark.read.format("binaryFile").load(table_path(directory, table)).select("path", "length", "modificationTime")


def _table_of(directory: str, path: Column) -> Column:
    base = re.escape(directory.rstrip("/").split("/")[-1])
    return F.regexp_extract(path, rf"/{base}/([^/]+)\.parquet(?:/.*)?$", 1)


def _recursive(spark: SparkSession, directory: str, source: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.format(source).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return (reader.schema(schema) if schema else reader).load(directory)


def file_facts(spark: SparkSession, directory: str) -> DataFrame:
    """(table_name, path, bytes, modified) of each file of all tables of a directory, from one listing of it."""
    listed = _recursive(spark, directory, "binaryFile")
    return listed.select(
        _table_of(directory, F.col("path")).alias("table_name"), "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")
    ).where("table_name <> ''")


def table_facts(spark: SparkSession, directory: str) -> DataFrame:
    """(table_name, row_count, file_count, bytes, modified) of all tables of a directory.

    One listing and one scan of all footers, whatever the number of tables: the schema names a column that no file
    has, so nothing but the numbers of rows is read.
    """
    sizes = file_facts(spark, directory).groupBy("table_name").agg(
        F.count("*").alias("file_count"), F.sum("bytes").alias("bytes"), F.max("modified").alias("modified")
    )
    rows = _recursive(spark, directory, "parquet", "`__no such column` int")
    counts = rows.groupBy(_table_of(directory, F.col("_metadata.file_path")).alias("table_name")).agg(F.count("*").alias("row_count"))
    return sizes.join(counts, "table_name", "left").select(
        "table_name", F.coalesce("row_count", F.lit(0)).alias("row_count"), "file_count", "bytes", "modified"
    )


def _row_count(df: DataFrame) -> Column:
    """The number of rows as a scalar subquery; counting needs no column, so only footers are read."""
    return df.agg(F.count("*")).scalar()


def _sql_text(value: str | None) -> str:
    """A text as a SQL literal."""
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _like(name: str, pattern: str) -> bool:
    """SQL LIKE without regard to case: ``%`` is any text, ``_`` any character."""
    wildcards = {"%": ".*", "_": "."}
    return re.fullmatch("".join(wildcards.get(c, re.escape(c)) for c in pattern), name, re.I | re.S) is not None


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of each table; only footers are read."""
    return _union([df.agg(F.lit(t).alias("table_name"), F.count("*").alias("row_count")) for t, df in frames.items()])


def table_inventory(
    spark: SparkSession,
    directory: str,
    name_pattern: str | None = None,
    schema_filter: str | None = None,
    constraints: Constraints | None = None,
    tables: tuple[str, ...] = TABLES,
    with_columns: bool = True,
) -> DataFrame:
    """Each table with row count, size, change time, key flags, description and columns.

    The facts come from one pass over the directory (``table_facts``); only the columns need a look at each table, which
    ``with_columns=False`` spares where there are thousands.
    ``name_pattern`` is looked for anywhere in the name, with the wildcards of LIKE.
    """
    declared = constraints or Constraints()
    chosen = [t for t in tables if schema_filter in (None, "", SCHEMA_NAME)]
    if name_pattern:
        chosen = [t for t in chosen if _like(t, f"%{name_pattern}%")]
    known = []
    for t in chosen:
        columns = load_table(spark, directory, t, tables).columns if with_columns else None
        known.append(
            (
                t, SCHEMA_NAME, BASE_TABLE, declared.descriptions.get(t), t in declared.primary_keys, t in declared.foreign_keys,
                len(columns) if with_columns else None, columns,
            )
        )
    names_of = spark.createDataFrame(
        known,
        "table_name string, schema_name string, table_type string, description string, has_primary_key boolean, "
        "has_foreign_keys boolean, column_count bigint, columns array<string>",
    )
    found = names_of.join(table_facts(spark, directory), "table_name").selectExpr(
        "table_name", "schema_name", "table_type", "modified AS modified_date", "row_count", "bytes div 1048576 AS data_size_mb",
        "description", "has_primary_key", "has_foreign_keys", "column_count", "columns",
    )
    return found.orderBy("schema_name", "table_name")


def table_stats(spark: SparkSession, directory: str, table: str, tables: tuple[str, ...] = TABLES) -> DataFrame:
    """Rows, files, kilobytes and last change of one table; raises when there is no such table."""
    df = load_table(spark, directory, table, tables)
    sizes = _files(spark, directory, table).agg(
        F.count("*").alias("file_count"),
        F.expr("coalesce(sum(length) div 1024, 0)").alias("data_space_kb"),
        F.max("modificationTime").alias("last_update"),
    )
    return sizes.withColumn("n", _row_count(df)).selectExpr(
        f"{_sql_text(table)} AS table_name",
        f"{_sql_text(SCHEMA_NAME)} AS schema_name",
        "n AS row_count",
        "file_count",
        "data_space_kb",
        "last_update",
    )


def database_info(spark: SparkSession, directory: str, tables: tuple[str, ...] = TABLES) -> DataFrame:
    """Table count, table names, total rows and total size of a directory of tables."""
    listed = ", ".join(_sql_text(t) for t in sorted(tables))
    facts = table_facts(spark, directory).where(F.col("table_name").isin(*tables))
    return facts.agg(F.sum("row_count").alias("n"), F.sum("bytes").alias("bytes")).selectExpr(
        f"{_sql_text(directory.rstrip('/').split('/')[-1])} AS database_name",
        f"{len(tables)} AS table_count",
        f"array({listed}) AS tables",
        "coalesce(n, 0L) AS row_count",
        "coalesce(bytes, 0) / 1048576D AS size_mb",
        "'Query results are automatically filtered for PII protection' AS note",
    )


def _numeric_shape(data_type: T.DataType) -> tuple[int | None, int | None]:
    if isinstance(data_type, T.DecimalType):
        return data_type.precision, data_type.scale
    digits = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}.get(type(data_type))
    return (digits, 0) if digits else (None, None)


COLUMN_SCHEMA = (
    "table_name string, schema_name string, ordinal int, column_name string, data_type string, is_nullable boolean, "
    "numeric_precision int, numeric_scale int, default_value string, is_sensitive boolean"
)


def column_catalog(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    """Columns of tables in order, from their schemas alone."""
    rows = [
        (
            t, SCHEMA_NAME, i + 1, f.name, f.dataType.simpleString(), f.nullable, *_numeric_shape(f.dataType),
            f.metadata.get("CURRENT_DEFAULT"), names.is_sensitive_column(f.name),
        )
        for t, df in frames.items()
        for i, f in enumerate(df.schema)
    ]
    return spark.createDataFrame(rows, COLUMN_SCHEMA)


def _profile(table: str, df: DataFrame) -> DataFrame:
    """One scan of a table: rows, and per column the values present and the longest text."""
    observed, items = ["count(*) AS rows"], []
    for i, f in enumerate(df.schema):
        is_text = isinstance(f.dataType, T.StringType)
        observed.append(f"count({_sql_name(f.name)}) AS n{i}")
        if is_text:
            observed.append(f"max(length({_sql_name(f.name)})) AS l{i}")
        precision, scale = ("NULL" if x is None else x for x in _numeric_shape(f.dataType))
        items.append(
            f"named_struct('table_name', {_sql_text(table)}, 'ordinal', {i + 1}, 'column_name', {_sql_text(f.name)}, "
            f"'data_type', {_sql_text(f.dataType.simpleString())}, 'is_nullable', {f.nullable}, "
            f"'max_length', {f'l{i}' if is_text else 'CAST(NULL AS INT)'}, "
            f"'numeric_precision', CAST({precision} AS INT), 'numeric_scale', CAST({scale} AS INT), "
            f"'is_sensitive', {names.is_sensitive_column(f.name)}, 'row_count', rows, 'null_count', rows - n{i})"
        )
    return df.selectExpr(*observed).selectExpr(f"inline(array({', '.join(items)}))")


def column_profile(frames: dict[str, DataFrame]) -> DataFrame:
    """Columns of tables in order, with sensitivity and what one scan of each table observes."""
    return _union([_profile(t, df) for t, df in frames.items()])


def column_distinct_counts(frames: dict[str, DataFrame], approximate: bool = False) -> DataFrame:
    """Different values per column, nulls not counted.

    Exact counts shuffle each column's different values once; the approximate ones need no shuffle of values, which is
    what very large tables call for.
    """
    frames_of = []
    for t, df in frames.items():
        counts = [
            (F.approx_count_distinct(F.col(_sql_name(c))) if approximate else F.count_distinct(F.col(_sql_name(c)))).alias(f"n{i}")
            for i, c in enumerate(df.columns)
        ]
        items = ", ".join(
            f"named_struct('table_name', {_sql_text(t)}, 'column_name', {_sql_text(c)}, 'distinct_count', n{i})"
            for i, c in enumerate(df.columns)
        )
        frames_of.append(df.agg(*counts).selectExpr(f"inline(array({items}))"))
    return _union(frames_of)


def key_profile(frames: dict[str, DataFrame], candidates: list[tuple[str, list[str]]]) -> DataFrame:
    """Which candidate keys identify rows: no null, no value twice.

    Grouping pre-aggregates in each task, so a value that fills a third of a table shuffles as few rows.
    """
    profiles = []
    for table, columns in candidates:
        per_key = frames[table].select(*columns, all_present(columns).alias("__complete")).groupBy(*columns, "__complete").agg(
            F.count("*").alias("n")
        )
        profiles.append(
            per_key.agg(
                F.lit(table).alias("table_name"),
                F.lit(",".join(columns)).alias("key_columns"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
                F.count_if(F.col("__complete")).alias("distinct_keys"),
                F.coalesce(F.sum(F.when(~F.col("__complete"), F.col("n"))), F.lit(0)).alias("null_keys"),
                F.coalesce(F.max(F.when(F.col("__complete"), F.col("n"))), F.lit(0)).alias("max_rows_per_key"),
            ).withColumn("is_unique", (F.col("max_rows_per_key") <= 1) & (F.col("null_keys") == 0))
        )
    return _union(profiles)


def relationship_check(
    frames: dict[str, DataFrame],
    pairs: list[tuple[str, str, str, str]],
    unique: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Child rows without a parent, per declared (child, column, parent, column).

    Parent columns that ``unique`` (table to key columns) declares to be keys by themselves are joined as they are;
    others are reduced to their different values first.
    """
    checks = []
    for child, child_column, parent, parent_column in pairs:
        # One row per value on both sides before the join: hot values never meet the shuffle in full.
        values = key_counts(frames[child].select(F.col(child_column).alias("k")), ["k"])
        parents = frames[parent].select(F.col(parent_column).alias("k")).where(F.col("k").isNotNull())
        if (unique or {}).get(parent) != [parent_column]:
            parents = parents.distinct()
        orphans = values.join(parents, "k", "left_anti")
        checks.append(
            orphans.agg(
                F.lit(parent).alias("parent_table"),
                F.lit(parent_column).alias("parent_column"),
                F.lit(child).alias("child_table"),
                F.lit(child_column).alias("child_column"),
                F.count("*").alias("orphan_keys"),
                F.coalesce(F.sum("__rows"), F.lit(0)).alias("orphan_rows"),
            ).withColumn("holds", F.col("orphan_rows") == 0)
        )
    return _union(checks)


# Per new column: facts, the key of the facts, the own key it is compared with.
Checks = dict[str, tuple[DataFrame, str, str]]


def with_counts(df: DataFrame, checks: Checks, unique: bool = False) -> DataFrame:
    """Correlated ``COUNT(*)`` as a column: facts grouped by key and looked up, 0 where there are none.

    ``unique=True`` says that the own keys do not repeat (see ``left_lookup``). Checks on one own key are one lookup,
    and its hot values are looked for once.
    """
    columns, by_key = df.columns, {}
    for name, (facts, fact_key, own_key) in checks.items():
        by_key.setdefault(own_key, []).append((name, facts.select(F.col(fact_key).alias("__key"))))
    hot = {own_key: None if unique else hot_values(df, own_key) for own_key in by_key}
    for own_key, wanted in by_key.items():
        rows = _union([facts.withColumn("__which", F.lit(i)) for i, (_, facts) in enumerate(wanted)])
        counts = rows.where(F.col("__key").isNotNull()).groupBy("__key").agg(
            *[F.count_if(F.col("__which") == i).alias(f"__n{i}") for i in range(len(wanted))]
        )
        df = left_lookup(df, counts, own_key, "__key", unique, hot[own_key])
        found = {name: F.coalesce(F.col(f"__n{i}"), F.lit(0)) for i, (name, _) in enumerate(wanted)}
        df = df.withColumns(found).drop(*[f"__n{i}" for i in range(len(wanted))])
    return df.select(*columns, *checks)


def with_exists_flags(df: DataFrame, checks: Checks, unique: bool = False) -> DataFrame:
    """``EXISTS`` as a flag: true where the facts hold the own key."""
    counted = with_counts(df, checks, unique)
    return counted.withColumns({flag: F.col(flag) > 0 for flag in checks})
