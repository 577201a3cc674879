"""Files that tasks write to and read from a folder all of them reach, with a manifest of those that count.

Every attempt of a task writes a file of its own name; the manifest is a Parquet table that Spark commits, so it
lists exactly one finished file per partition, whatever was retried or lost on the way.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from types import ModuleType
from uuid import uuid4

import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MANIFEST = "part int, path string, records long, units long, bytes long"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def kept() -> dict:
    """A dictionary that outlives a task in a reused Python worker. Functions that travel with the plan get new
    globals in each task, so it lives in a module of its own."""
    return sys.modules.setdefault("_cloakframe_kept", ModuleType("_cloakframe_kept")).__dict__


def write_parts(df: DataFrame, folder: str, suffix: str, write: Callable[[Iterator[pd.DataFrame], object], tuple[int, int]]) -> DataFrame:
    """One file per partition that has rows; ``write(batches, stream)`` returns the numbers of records and units.
    Returns the manifest, read from where it was written."""

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        batches = (b for b in batches if len(b))
        first = next(batches, None)
        if first is None:
            return
        number = TaskContext.get().partitionId()
        fs, base = file_system(folder)
        fs.create_dir(base, recursive=True)
        name = f"part-{number:06d}-{uuid4().hex}{suffix}"

        def all_batches() -> Iterator[pd.DataFrame]:
            yield first
            yield from batches

        with fs.open_output_stream(f"{base}/{name}", compression=None) as stream:
            records, units = write(all_batches(), stream)
            size = stream.tell()
        yield pd.DataFrame([[number, f"{folder}/{name}", records, units, size]], columns=[c.split()[0] for c in MANIFEST.split(", ")])

    listed = f"{folder}-manifest"
    df.mapInPandas(part, MANIFEST).write.parquet(listed)
    return df.sparkSession.read.schema(MANIFEST).parquet(listed)


def read_parts(manifest: DataFrame, read: Callable[[dict], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """The rows that ``read`` yields for each row of the manifest, one file per partition."""

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                yield from read(row)

    spread = manifest.repartitionByRange(max(1, manifest.count()), "part")
    return spread.mapInPandas(part, schema)


def with_base(manifest: DataFrame) -> DataFrame:
    """The manifest with ``base``: the units of all files before. It has one row per file."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("units").over(before), F.lit(0)))
