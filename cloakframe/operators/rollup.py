"""Analyses of logs that grow: partial aggregates are stored per batch and merged, so no row is read twice.

A batch of a log becomes one row per key and day (counts, sums, least and greatest values) in a folder of its own, named by
the batch. Writing a batch again replaces its folder, so a replay changes nothing; a batch whose write failed is missing
until it is written again, and no other one is touched. Merging reads the small rows only, of some days or of all.

A stream is a second feeder: every micro-batch is a batch, named by the query's own number for it. A row that is late
counts for the day it belongs to, in the batch it comes with; none is dropped, so no watermark is needed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cloakframe.operators import workload

DAY, BATCH = "log_day", "log_batch"


@dataclass(frozen=True)
class Rollup:
    """How a log is aggregated: ``measure(log, *more keys)`` groups it; all columns that are neither keys nor named as
    least or greatest values add up."""

    keys: tuple[str, ...]
    time: str
    measure: Callable[..., DataFrame]
    least: tuple[str, ...] = ()
    greatest: tuple[str, ...] = ()

    def merge(self, rows: DataFrame) -> DataFrame:
        merged = []
        for c in rows.columns:
            if c in self.keys or c in (DAY, BATCH):
                continue
            by = F.min if c in self.least else F.max if c in self.greatest else F.sum
            merged.append(by(c).alias(c))
        return rows.groupBy(*self.keys).agg(*merged)


STATEMENTS = Rollup(
    ("query_hash",), "executed_at", workload.statement_stats, ("creation_time",), ("max_elapsed_us", "last_execution_time")
)
WAITS = Rollup(("wait_type",), "ts", workload.wait_totals, (), ("max_wait_time_ms",))
SUGGESTIONS = Rollup(
    tuple(workload.SUGGESTION_KEYS), "used_at", workload.suggestion_totals, (), ("last_user_seek", "last_user_scan")
)


def add_batch(rollup: Rollup, log: DataFrame, store: str, batch: str) -> None:
    """Stores the partial aggregates of a batch, or replaces those that it has."""
    if not batch or "/" in batch:
        raise ValueError("a batch has a name that can be a folder's")
    partial = rollup.measure(log.withColumn(DAY, F.to_date(rollup.time)), DAY)
    partial.write.mode("overwrite").parquet(f"{store}/{BATCH}={batch}")


def merged(rollup: Rollup, spark: SparkSession, store: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """One row per key over all stored batches; of the days from ``first`` to ``last`` where they are given."""
    rows = spark.read.parquet(store)
    if first is not None:
        rows = rows.where(F.col(DAY) >= F.lit(first))
    if last is not None:
        rows = rows.where(F.col(DAY) <= F.lit(last))
    return rollup.merge(rows)


def roll_up_stream(rollup: Rollup, stream: DataFrame, store: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Feeds the store from a stream. After a restart the checkpoint repeats at most the last micro-batch, under its old
    number."""
    writer = stream.writeStream.foreachBatch(lambda rows, number: add_batch(rollup, rows, store, f"stream-{number}")).option(
        "checkpointLocation", checkpoint
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
