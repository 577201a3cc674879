from __future__ import annotations

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cloakframe.operators import dml
from cloakframe.plans.derived import derived
from cloakframe.sources import file_table as ft
from cloakframe.sources.tables import TableNotFound

FILES = 32


@pytest.fixture(scope="module")
def target(spark, data_dir):
    return derived(spark, data_dir, "dml_target").where("o_orderkey IS NOT NULL").cache()


@pytest.fixture
def table(target, tmp_path):
    path = f"file://{tmp_path}/t"
    assert ft.create_table(target.repartitionByRange(FILES, "o_orderkey"), path) == 0
    return path


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def stamps(path):
    root = path.removeprefix("file://")
    return {n: os.stat(f"{root}/{n}").st_mtime_ns for n in os.listdir(root) if os.path.isfile(f"{root}/{n}")} | {
        f"{d}/{n}": os.stat(f"{d}/{n}").st_mtime_ns for d, _, names in os.walk(f"{root}/data") for n in names
    }


def check(spark, path, before, wanted, new_version, at_most):
    """The table has the rows, few files changed, and the old version is still there."""
    old, new = set(ft.live_files(spark, path, new_version - 1)), set(ft.live_files(spark, path))
    after = stamps(path)
    assert {f: after[f] for f in before} == before
    assert len(old - new) <= at_most < FILES <= len(old) and old & new
    assert same(ft.read_table(spark, path), wanted)


def test_commands_touch_only_files_with_hits(spark, target, table):
    middle = target.agg(F.percentile_approx("o_orderkey", 0.5)).first()[0]
    few = (F.col("o_orderkey") >= middle) & (F.col("o_orderkey") < middle + 40)
    assert len(ft.live_files(spark, table)) == FILES

    before = stamps(table)
    new, count = dml.update_rows(target, few, {"o_orderstatus": F.lit("U"), "o_custkey": F.col("o_orderkey")})
    assert ft.update_table(spark, table, few, {"o_orderstatus": F.lit("U"), "o_custkey": F.col("o_orderkey")}) == count.first()[0] > 0
    check(spark, table, before, new, 1, 3)

    before = stamps(table)
    new, count = dml.delete_rows(new, F.col("o_orderstatus") == "U")
    assert ft.delete_from(spark, table, F.col("o_orderstatus") == "U") == count.first()[0] > 0
    check(spark, table, before, new, 2, 3)

    before = stamps(table)
    source = new.orderBy("o_orderkey").limit(5).withColumn("o_totalprice", F.lit(1.5))
    source = source.unionByName(source.withColumn("o_orderkey", -F.col("o_orderkey"))).unionByName(
        source.limit(1).withColumn("o_orderkey", F.lit(None).cast("long"))
    ).cache()
    assert ft.merge_into(table, source, ["o_orderkey"]) == 11
    check(spark, table, before, dml.merge_rows(new, source, ["o_orderkey"])[0], 3, 2)
    assert same(ft.read_table(spark, table, 0), target)


def test_insert_reads_nothing(spark, target, table):
    assert ft.insert_into(table, target.limit(7)) == 7
    assert set(ft.live_files(spark, table, 0)) < set(ft.live_files(spark, table))
    assert ft.read_table(spark, table).count() == target.count() + 7


def test_nothing_to_do_makes_no_version(spark, table):
    assert ft.update_table(spark, table, F.lit(False), {"o_custkey": F.lit(1)}) == 0
    assert ft.delete_from(spark, table, F.col("o_orderkey") < -5) == 0
    assert ft.latest_version(spark, table) == 0


def test_failed_write_changes_nothing(spark, target, table):
    last = target.agg(F.max("o_orderkey")).first()[0]
    broken = F.when(F.col("o_orderkey") == last, F.raise_error(F.lit("killed")).cast("long")).otherwise(F.lit(1))
    with pytest.raises(PySparkException, match="killed"):
        ft.update_table(spark, table, F.col("o_orderkey") > 0, {"o_custkey": broken})
    with pytest.raises(PySparkException, match="more than one source row"):
        ft.merge_into(table, target.limit(3).union(target.limit(3)), ["o_orderkey"])
    assert ft.latest_version(spark, table) == 0 and same(ft.read_table(spark, table), target)
    assert ft.delete_from(spark, table, F.col("o_orderkey") == last) == 1


def test_two_writers(spark, target, table):
    """Of two commands on one version the second fails; repeated, it works."""
    version, names, schema = ft._state(spark, table)
    ft.delete_from(spark, table, F.col("o_orderkey") < 100)
    with pytest.raises(PySparkException, match="(?i)already exists"):
        ft._publish(spark, table, version + 1, spark.createDataFrame([(n,) for n in names], "path string"), schema)
    assert ft.latest_version(spark, table) == 1


def test_empty_tables(spark, target, tmp_path):
    path = f"file://{tmp_path}/e"
    with pytest.raises(TableNotFound):
        ft.read_table(spark, path)
    ft.create_table(target.limit(0), path)
    assert ft.read_table(spark, path).schema == target.schema and ft.read_table(spark, path).isEmpty()
    assert ft.delete_from(spark, path, F.lit(True)) == 0
    assert ft.merge_into(path, target.limit(4), ["o_orderkey"]) == 4
    assert ft.merge_into(path, target.limit(4), ["o_orderkey"], insert=False) == 4
    assert ft.delete_from(spark, path, F.lit(True)) == 4 and ft.read_table(spark, path).isEmpty()
    with pytest.raises(TableNotFound):
        ft.read_table(spark, path, 77)
