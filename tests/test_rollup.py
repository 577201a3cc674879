from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cloakframe.operators import rollup, workload
from cloakframe.plans.derived import derived

LOGS = [
    (rollup.STATEMENTS, "query_log", lambda log, t: workload.slow_groups(log, top_count=None, minimum_ms=0, texts=False, stats=t)),
    (rollup.WAITS, "wait_log", lambda log, t: workload.wait_share(log, top_count=None, totals=t)),
    (rollup.SUGGESTIONS, "candidate_log", lambda log, t: workload.impact_ranking(log, top_count=None, totals=t)),
]


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize(("kind", "source", "analysis"), LOGS)
def test_batches_equal_one_pass(spark, data_dir, tmp_path, kind, source, analysis):
    log = derived(spark, data_dir, source).cache()
    for batch in (2, 0, 1, 0):  # in any order, one of them twice
        rollup.add_batch(kind, log.where(F.pmod(F.xxhash64(*log.columns), F.lit(3)) == batch), str(tmp_path), str(batch))
    stored = rollup.merged(kind, spark, str(tmp_path))
    assert same(analysis(log, stored), analysis(log, None))
    assert "query_text" not in spark.read.parquet(str(tmp_path)).columns

    days = [r[0] for r in log.select(F.to_date(kind.time)).distinct().orderBy(F.to_date(kind.time)).collect()]
    first, last = days[len(days) // 3], days[2 * len(days) // 3]
    some = log.where(F.to_date(kind.time).between(first, last))
    assert same(analysis(some, rollup.merged(kind, spark, str(tmp_path), first, last)), analysis(some, None))


def test_failed_batch_leaves_the_others(spark, tmp_path):
    rows = [("q", 5, dt.datetime(2024, 1, d)) for d in (1, 2)]
    log = spark.createDataFrame(rows, "query_hash string, elapsed_us long, executed_at timestamp").withColumns(
        {c: F.lit(1).cast("long") for c in ("cpu_us", "logical_reads", "physical_reads")}
    )
    rollup.add_batch(rollup.STATEMENTS, log, str(tmp_path), "a")
    broken = log.withColumn("cpu_us", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(PySparkException, match="lost"):
        rollup.add_batch(rollup.STATEMENTS, broken, str(tmp_path), "b")
    assert rollup.merged(rollup.STATEMENTS, spark, str(tmp_path)).first()["execution_count"] == 2
    rollup.add_batch(rollup.STATEMENTS, log, str(tmp_path), "b")
    assert rollup.merged(rollup.STATEMENTS, spark, str(tmp_path)).first()["execution_count"] == 4
    with pytest.raises(ValueError):
        rollup.add_batch(rollup.STATEMENTS, log, str(tmp_path), "a/b")


def test_stream_and_late_rows(spark, data_dir, tmp_path):
    """Files come day by day, then one with rows of earlier days; a second run after a restart adds only what is new."""
    log = derived(spark, data_dir, "wait_log").cache()
    late = F.pmod(F.xxhash64(*log.columns), F.lit(10)) == 0
    source, store = f"{tmp_path}/in", f"{tmp_path}/store"

    def run():
        stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(source)
        rollup.roll_up_stream(rollup.WAITS, stream, store, f"{tmp_path}/check").awaitTermination()

    log.where(~late).repartition(2).write.parquet(source)
    run()
    assert same(rollup.merged(rollup.WAITS, spark, store), workload.wait_totals(log.where(~late)))
    log.where(late).repartition(1).write.mode("append").parquet(source)
    run()
    run()
    assert same(rollup.merged(rollup.WAITS, spark, store), workload.wait_totals(log))
