"""Tables that commands change: files that are never rewritten in place, and manifests of those that count.

A table is a folder with ``data/<write>/part-*.parquet`` and ``manifests/version=<n>``, a Parquet table of the live files
that Spark commits with one rename. A command finds the files that hold rows it changes, writes new files for these alone
and then the next manifest; all other files stay untouched. Until the manifest is there, readers see the version before,
so a write that fails or is killed changes nothing, and a retry starts from the same state. Old versions stay readable.

Two commands at once would write the same version: the second one fails and can be repeated.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cloakframe.operators import dml
from cloakframe.operators.hot_keys import all_present
from cloakframe.sources.tables import TableNotFound

# One row per live file, and one without a path that carries the schema of the table.
MANIFEST = "path string, schema string"
_FILE = "__file"
_NAME = r"data/[^/]+/[^/]+$"


def _manifests(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(f"{MANIFEST}, version int").parquet(f"{path}/manifests")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise TableNotFound(f"No table in {path}") from error
        raise


def latest_version(spark: SparkSession, path: str) -> int:
    found = _manifests(spark, path).agg(F.max("version")).first()[0]
    if found is None:
        raise TableNotFound(f"No table in {path}")
    return found


def _live(spark: SparkSession, path: str, version: int) -> DataFrame:
    return _manifests(spark, path).where(F.col("version") == version).select("path", "schema")


def _open(spark: SparkSession, path: str, names: list[str], schema: T.StructType) -> DataFrame:
    """The rows of some files. Names are what Spark itself lists for a scan, so the driver holds no more than usual."""
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{n}" for n in names])


def _state(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, list[str], T.StructType]:
    version = latest_version(spark, path) if version is None else version
    rows = _live(spark, path, version).collect()
    schema = next((r["schema"] for r in rows if r["path"] is None), None)
    if schema is None:
        raise TableNotFound(f"No version {version} in {path}")
    return version, sorted(r["path"] for r in rows if r["path"] is not None), T.StructType.fromJson(json.loads(schema))


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of the newest version, or of an older one."""
    _, names, schema = _state(spark, path, version)
    return _open(spark, path, names, schema)


def live_files(spark: SparkSession, path: str, version: int | None = None) -> list[str]:
    return _state(spark, path, version)[1]


def _written(df: DataFrame, path: str) -> DataFrame:
    """Writes new files and lists those that have rows; listing reads footers only."""
    folder = f"{path}/data/{uuid4().hex}"
    df.write.parquet(folder)
    listed = df.sparkSession.read.schema(df.schema).parquet(folder)
    return listed.select(F.regexp_extract("_metadata.file_path", _NAME, 0).alias("path")).distinct()


def _publish(spark: SparkSession, path: str, version: int, live: DataFrame, schema: T.StructType) -> int:
    head = spark.createDataFrame([(None, schema.json())], MANIFEST)
    rows = head.unionByName(live.select("path", F.lit(None).cast("string").alias("schema")))
    rows.coalesce(1).write.parquet(f"{path}/manifests/version={version}")
    return version


def create_table(df: DataFrame, path: str) -> int:
    """Writes a new table, a file per partition of ``df``; returns its version, 0."""
    schema = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in df.schema])
    return _publish(df.sparkSession, path, 0, _written(df, path), schema)


def _touched(rows: DataFrame) -> list[str]:
    """The files that hold the given rows, which carry the name of theirs."""
    return sorted(r[0] for r in rows.select(_FILE).distinct().collect())


def _command(
    spark: SparkSession, path: str, holds: Callable[[DataFrame], DataFrame | None], rewrite: Callable[[DataFrame, Observation], DataFrame], always: bool
) -> int:
    """Rewrites the files with the rows that ``holds`` picks and publishes; returns the affected rows, which are counted
    by the write itself."""
    version, names, schema = _state(spark, path)
    named = _open(spark, path, names, schema)
    picked = holds(named.withColumn(_FILE, F.regexp_extract("_metadata.file_path", _NAME, 0))) if names else None
    touched = _touched(picked) if picked is not None else []
    if not touched and not always:
        return 0
    counted = Observation()
    new = _written(rewrite(_open(spark, path, touched, schema), counted).select(*schema.names), path)
    kept = spark.createDataFrame([(n,) for n in sorted(set(names) - set(touched))], "path string")
    _publish(spark, path, version + 1, kept.unionByName(new), schema)
    return counted.get[dml.AFFECTED]


def insert_into(path: str, source: DataFrame) -> int:
    """Appends rows as new files; no file of the table is read."""
    return _command(
        source.sparkSession, path, lambda df: None, lambda old, counted: dml.insert_rows(old, source, counted)[0], True
    )


def update_table(spark: SparkSession, path: str, predicate: Column, sets: Mapping[str, Column]) -> int:
    """Sets columns where the predicate holds; all new values come from the old row."""
    return _command(
        spark, path, lambda df: df.where(predicate), lambda old, counted: dml.update_rows(old, predicate, sets, counted)[0], False
    )


def delete_from(spark: SparkSession, path: str, predicate: Column) -> int:
    return _command(
        spark, path, lambda df: df.where(predicate), lambda old, counted: dml.delete_rows(old, predicate, counted)[0], False
    )


def merge_into(path: str, source: DataFrame, keys: list[str], **options) -> int:
    """``dml.merge_rows`` as a command. Keys that no touched file holds are in no file, so the files with matches are
    all that the merge has to read."""
    wanted = source.select(*keys).where(all_present(keys)).distinct()
    return _command(
        source.sparkSession, path,
        lambda df: df.join(wanted, keys, "left_semi"),
        lambda old, counted: dml.merge_rows(old, source, keys, observation=counted, **options)[0],
        options.get("insert", True),
    )
