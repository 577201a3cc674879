"""Profiles of tables that grow: statistics per file and column are kept, and only new files are scanned.

For each file and column there are rows, nulls, the longest text and a HyperLogLog sketch of the values, all of which
merge. A refresh lists the files, scans those that the store does not have in this state (by path and change time), and
appends what it saw; a profile merges the rows of the files that exist now. So a file that was replaced counts with its
new state alone, and one that is gone no longer counts.

Estimates of distinct values are exact up to some hundred values and within a few per cent beyond (``PRECISION`` bits:
1.04 / 2**(bits / 2) is the standard error). Values are told apart by a 64-bit hash, whatever their type.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cloakframe.operators.catalog import file_facts
from cloakframe.sources.tables import TABLES, load_table

PRECISION = 13
SEEN = (
    "table_name string, path string, modified timestamp, ordinal int, column_name string, data_type string, "
    "row_count long, null_count long, max_length int, sketch binary"
)


def _stored(spark: SparkSession, store: str) -> DataFrame:
    try:
        return spark.read.schema(SEEN).parquet(store)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], SEEN)
        raise


def _scan(table: str, df: DataFrame) -> DataFrame:
    """One row per file and column, from one scan."""
    observed = [F.count("*").alias("rows")]
    items = []
    for i, f in enumerate(df.schema):
        value = F.col("`" + f.name.replace("`", "``") + "`")
        is_text = isinstance(f.dataType, T.StringType)
        hashed = F.xxhash64(value if not isinstance(f.dataType, T.MapType) else F.map_entries(value))
        observed += [
            F.count(value).alias(f"n{i}"),
            (F.max(F.length(value)) if is_text else F.lit(None).cast("int")).alias(f"l{i}"),
            F.hll_sketch_agg(F.when(value.isNotNull(), hashed), PRECISION).alias(f"s{i}"),
        ]
        items.append(
            F.struct(
                F.lit(i + 1).alias("ordinal"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col("rows").alias("row_count"), (F.col("rows") - F.col(f"n{i}")).alias("null_count"),
                F.col(f"l{i}").alias("max_length"), F.col(f"s{i}").alias("sketch"),
            )
        )
    per_file = df.groupBy("_metadata.file_path", "_metadata.file_modification_time").agg(*observed)
    return per_file.select(
        F.lit(table).alias("table_name"), F.col("file_path").alias("path"), F.col("file_modification_time").alias("modified"),
        F.inline(F.array(*items)),
    )


def refresh_profile(spark: SparkSession, directory: str, store: str, tables: tuple[str, ...] = TABLES) -> int:
    """Scans the files of the tables that the store does not know in their present state; returns their number."""
    known = _stored(spark, store).select("path", "modified").distinct()
    listed = file_facts(spark, directory).where(F.col("table_name").isin(*tables))
    new = listed.join(known, ["path", "modified"], "left_anti").select("table_name", "path").collect()
    scans = []
    for table in sorted({r["table_name"] for r in new}):
        schema = load_table(spark, directory, table, tables).schema
        scans.append(_scan(table, spark.read.schema(schema).parquet(*sorted(r["path"] for r in new if r["table_name"] == table))))
    if scans:
        reduce(DataFrame.unionByName, scans).write.mode("append").parquet(store)
    return len(new)


def stored_profile(spark: SparkSession, directory: str, store: str, tables: tuple[str, ...] = TABLES) -> DataFrame:
    """The columns of the tables with rows, nulls, longest text and estimated distinct values; reads no table."""
    live = file_facts(spark, directory).where(F.col("table_name").isin(*tables)).select("path", "modified")
    # A scan that was repeated after a failure may have left two equal rows for a file.
    seen = _stored(spark, store).join(live, ["path", "modified"], "left_semi").dropDuplicates(["path", "modified", "ordinal"])
    return seen.groupBy("table_name", "ordinal", "column_name", "data_type").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"), F.max("max_length").alias("max_length"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"),
    )
