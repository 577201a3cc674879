"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakframe.session import work_dir

# A word for the rules on white space; a token for the rules on letters and digits.
WHITE_SPACE = r"[\x20\x09-\x0D]+"
NOT_A_TOKEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body refers to it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The maximal runs without ASCII white space; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE_SPACE), "")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else.

    ``lower`` gives the same and is several times faster unless the text holds a letter outside ASCII that is
    not lower case.
    """
    other = text.rlike(r"[^\x00-\x7F\p{Ll}]")
    return F.when(other, F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def tokens(text: Column) -> Column:
    """Lower-cased runs of ASCII letters, digits and everything outside ASCII; a null text has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_A_TOKEN), "")


def new_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name in the shared work folder."""
    return f"{work_dir(spark)}/{label}-{uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared work folder and read again: the lineage ends there, so a lost executor
    costs only the reading task, and tasks with a random or changing outcome run once."""
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name the frame does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name
