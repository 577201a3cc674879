"""Masking needs no state, so the batch projection runs unchanged on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cloakframe.operators.masking import mask_table, with_change_flag

_FLAG, BATCH = "__masked", "batch_id"


def read_stream(spark: SparkSession, path: str, schema: StructType, max_files_per_trigger: int = 1000) -> DataFrame:
    """Parquet files that arrive under a path, a bounded number of files per micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)


def mask_stream(
    stream: DataFrame, sink: str, checkpoint: str, numeric: str = "keep", available_now: bool = True
) -> StreamingQuery:
    """Mask a stream into Parquet files. The checkpoint makes the sink exactly-once across restarts;
    both folders must be reachable by every executor."""
    writer = (
        mask_table(stream, numeric)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def mask_stream_counted(
    stream: DataFrame, sink: str, counts: str, checkpoint: str, numeric: str = "keep", available_now: bool = True
) -> StreamingQuery:
    """As ``mask_stream``, and per micro-batch the rows read and those with a masked cell, counted by the write itself.

    Rows and counts of a batch go to folders named by its number. A batch that is repeated after a failure has the same
    number and replaces both, so nothing is written or counted twice.
    """

    def write(rows: DataFrame, number: int) -> None:
        seen = Observation()
        flagged = with_change_flag(rows, numeric, _FLAG).observe(
            seen, F.count(F.lit(1)).alias("total_rows"), F.count_if(F.col(_FLAG)).alias("masked_rows")
        )
        flagged.drop(_FLAG).write.mode("overwrite").parquet(f"{sink}/{BATCH}={number}")
        found = seen.get
        row = rows.sparkSession.createDataFrame([(found["total_rows"], found["masked_rows"])], "total_rows long, masked_rows long")
        row.coalesce(1).write.mode("overwrite").parquet(f"{counts}/{BATCH}={number}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stream_counts(spark: SparkSession, counts: str) -> DataFrame:
    """Rows and masked rows over all batches so far, as ``masking_report`` has them for a table."""
    return spark.read.parquet(counts).agg(F.sum("total_rows").alias("total_rows"), F.sum("masked_rows").alias("masked_rows"))
