from __future__ import annotations

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from cloakframe.operators import dml, hot_keys

SCHEMA = "k bigint, v string, n int"


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a", 10), (2, None, 20), (3, "c", None), (None, "x", 1), (3, "d", 5)], SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def affected(df):
    return df.first()["affected_rows"]


def test_insert(spark, target):
    source = spark.createDataFrame([(7, 9, "z")], "n int, k bigint, v string")
    new, count = dml.insert_rows(target, source)
    assert rows(new) == sorted(rows(target) + [(9, "z", 7)], key=repr)
    assert affected(count) == 1


def test_update_reads_old_values_and_skips_null_predicates(target):
    new, count = dml.update_rows(target, F.col("v") != "c", {"v": F.col("n").cast("string"), "n": F.col("k")})
    assert rows(new) == sorted([(1, "10", 1), (2, None, 20), (3, "c", None), (None, "1", None), (3, "5", 3)], key=repr)
    assert affected(count) == 3
    assert new.schema == target.schema


def test_delete_keeps_null_predicates(target):
    new, count = dml.delete_rows(target, F.col("v") == "a")
    assert rows(new) == sorted([(2, None, 20), (3, "c", None), (None, "x", 1), (3, "d", 5)], key=repr)
    assert affected(count) == 1
    assert new.count() == target.count() - affected(count)


def test_merge(spark, target):
    source = spark.createDataFrame([(3, "m", 99), (4, "new", 1), (4, "twin", 2), (None, "lost", 3)], SCHEMA)
    new, count = dml.merge_rows(target, source, ["k"])
    assert rows(new) == sorted(
        [(1, "a", 10), (2, None, 20), (3, "m", 99), (3, "m", 99), (None, "x", 1), (4, "new", 1), (4, "twin", 2), (None, "lost", 3)],
        key=repr,
    )
    assert affected(count) == 5


def test_merge_options(spark, target):
    source = spark.createDataFrame([(1, "m", 99), (2, "q", 0), (9, "new", 1)], SCHEMA)
    new, count = dml.merge_rows(target, source, ["k"], update={"n": "n"}, insert=False, delete_matched=F.col("n") == 20)
    assert rows(new) == sorted([(1, "a", 99), (3, "c", None), (None, "x", 1), (3, "d", 5)], key=repr)
    assert affected(count) == 2


def test_merge_refuses_two_matches(spark, target):
    source = spark.createDataFrame([(1, "m", 1), (1, "n", 2)], SCHEMA)
    new, _ = dml.merge_rows(target, source, ["k"])
    with pytest.raises(Exception, match="matches more than one source row"):
        new.collect()


def test_merge_on_two_keys(spark, target):
    source = spark.createDataFrame([(3, "c", 1), (3, None, 2)], SCHEMA)
    new, count = dml.merge_rows(target, source, ["k", "v"])
    assert rows(new) == sorted(
        [(1, "a", 10), (2, None, 20), (3, "c", 1), (None, "x", 1), (3, "d", 5), (3, None, 2)], key=repr
    )
    assert affected(count) == 2


@pytest.mark.parametrize("kind", ["insert", "update", "delete", "merge"])
def test_affected_rows_without_a_second_pass(spark, target, kind):
    seen = Observation(kind)
    source = spark.createDataFrame([(1, "m", 99), (9, "new", 1)], SCHEMA)
    new, count = {
        "insert": lambda: dml.insert_rows(target, source, seen),
        "update": lambda: dml.update_rows(target, F.col("k") == 3, {"v": F.lit("u")}, seen),
        "delete": lambda: dml.delete_rows(target, F.col("k") == 3, seen),
        "merge": lambda: dml.merge_rows(target, source, ["k"], observation=seen),
    }[kind]()
    new.write.format("noop").mode("overwrite").save()
    assert seen.get["affected_rows"] == affected(count) == 2


def test_merge_inserts_hot_source_keys_without_a_join(spark, target, monkeypatch):
    monkeypatch.setattr(hot_keys, "HOT_ONE_IN", 3)
    source = spark.createDataFrame([(1, "m", 0)] + [(50, "hot", i) for i in range(20)], SCHEMA)
    new, count = dml.merge_rows(target, source, ["k"])
    assert new.where("k = 50").count() == 20 and new.count() == 25
    assert affected(count) == 21
    refused, _ = dml.merge_rows(target, source.unionByName(source.where("k = 50").withColumn("k", F.lit(3))), ["k"])
    with pytest.raises(Exception, match="matches more than one source row"):
        refused.collect()


def test_merge_with_a_third_of_all_rows_on_one_key(spark):
    u = "sha2(CAST(id AS STRING), 256) AS u"
    rows = spark.range(0, 60_000, 1, 16)
    own = rows.selectExpr("CASE WHEN id % 3 = 0 THEN 7L ELSE id + 100 END AS k", "'t' AS v", "1 AS n", u)
    source = rows.selectExpr("CASE WHEN id % 3 = 0 THEN NULL ELSE id * 2 END AS k", "'s' AS v", "2 AS n", u)
    source = source.unionByName(spark.createDataFrame([(7, "hot", 3, "")], "k bigint, v string, n int, u string"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        new, count = dml.merge_rows(own, source, ["k"])
        assert new.where("k = 7 AND v = 'hot'").count() == 20_000
        assert new.where("k IS NULL").count() == 20_000
        assert affected(count) == new.where("v IN ('s', 'hot')").count()
        new.collect()
        text = new._jdf.queryExecution().executedPlan().toString()
        assert "FullOuter" not in text and "Cartesian" not in text
        assert "SortMergeJoin(skew=true)" in text
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
