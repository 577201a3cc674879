"""A directory of Parquet tables as a database of views."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The tables a data directory holds, each as "<name>.parquet" (a file or a folder of part files).
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


class TableNotFound(LookupError):
    """No table of that name in the database."""


def table_path(directory: str, table: str) -> str:
    return f"{directory.rstrip('/')}/{table}.parquet"


def load_table(spark: SparkSession, directory: str, table: str, known: tuple[str, ...] = TABLES) -> DataFrame:
    """One table of a directory; columns and filters prune at the scan."""
    if table not in known:
        raise TableNotFound(f"Table {table} not found")
    try:
        return spark.read.parquet(table_path(directory, table))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise TableNotFound(f"Table {table} not found in {directory}") from error
        raise


def load_tables(spark: SparkSession, directory: str, tables: tuple[str, ...] = TABLES) -> dict[str, DataFrame]:
    return {t: load_table(spark, directory, t, tables) for t in tables}


def register_tables(spark: SparkSession, directory: str, tables: tuple[str, ...] = TABLES) -> None:
    """Make the tables of a directory the current database: one temporary view each."""
    for t in tables:
        load_table(spark, directory, t, tables).createOrReplaceTempView(t)


def result_json(df: DataFrame, column: str = "json") -> DataFrame:
    """Each row as one JSON document."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(column))


def write_json(df: DataFrame, path: str) -> None:
    """Write the rows as JSON lines, in parallel."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
