from __future__ import annotations

import os
import shutil

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cloakframe.operators import catalog, profile
from cloakframe.sources.tables import TableNotFound


def plan_size(df):
    return len(df._jdf.queryExecution().optimizedPlan().toString())


def test_inventory_of_many_tables(spark, tmp_path):
    for name, n in (("few", 3), ("many", 1500)):
        os.makedirs(f"{tmp_path}/{name}")
        for i in range(n):
            table = pa.table({"id": list(range(i % 7)), f"c{i}": ["x"] * (i % 7)}, schema=pa.schema([("id", pa.int64()), (f"c{i}", pa.string())]))
            pq.write_table(table, f"{tmp_path}/{name}/t{i}.parquet")
    few, many = (f"file://{tmp_path}/{n}" for n in ("few", "many"))
    facts = catalog.table_facts(spark, many)
    assert plan_size(facts) <= plan_size(catalog.table_facts(spark, few)) + 200
    got = {r.table_name: r for r in facts.collect()}
    assert len(got) == 1500 and all(got[f"t{i}"].row_count == i % 7 and got[f"t{i}"].file_count == 1 for i in range(1500))
    tables = tuple(f"t{i}" for i in range(1500))
    listed = catalog.table_inventory(spark, many, "t1_", tables=tables, with_columns=False)
    assert {r.table_name for r in listed.collect()} == {t for t in tables if len(t) > 2 and "t1" in t}
    info = catalog.database_info(spark, many, tables).first()
    assert (info.table_count, info.row_count) == (1500, sum(i % 7 for i in range(1500)))


def test_inventory_of_folders_and_missing_tables(spark, tmp_path):
    spark.range(10).repartition(3).write.parquet(f"{tmp_path}/a.parquet")
    spark.range(5).write.parquet(f"{tmp_path}/b.parquet")
    rows = {r.table_name: r for r in catalog.table_inventory(spark, str(tmp_path), tables=("a", "b")).collect()}
    assert rows["a"].row_count == 10 and rows["b"].columns == ["id"]
    assert catalog.table_inventory(spark, str(tmp_path), "zz", tables=("a", "b")).collect() == []
    with pytest.raises(TableNotFound):
        catalog.table_inventory(spark, str(tmp_path), tables=("a", "c"))


@pytest.fixture
def database(spark, tmp_path):
    def write(name, low, high):
        rows = spark.range(low, high).select(
            "id", (F.col("id") % 7000).alias("some"), F.concat(F.lit("t"), F.col("id") % 90).alias("text"),
            F.when(F.col("id") % 3 > 0, F.array(F.col("id") % 500)).alias("list"), (F.col("id") / 7).alias("ratio"),
        )
        rows.repartition(3).write.mode("append").parquet(f"{tmp_path}/data/{name}.parquet")

    write("a", 0, 60_000)
    write("b", 0, 100)
    return f"{tmp_path}/data", f"{tmp_path}/store", write


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_estimates_and_refreshing(spark, database):
    directory, store, write = database
    assert profile.refresh_profile(spark, directory, store, ("a", "b")) == 6
    assert profile.refresh_profile(spark, directory, store, ("a", "b")) == 0
    frames = {t: spark.read.parquet(f"{directory}/{t}.parquet") for t in ("a", "b")}
    exact = {(r.table_name, r.column_name): r.distinct_count for r in catalog.column_distinct_counts(frames).collect()}
    first = profile.stored_profile(spark, directory, store, ("a", "b")).collect()
    assert len(first) == len(exact) == 10
    for r in first:
        wanted = exact[r.table_name, r.column_name]
        assert abs(r.distinct_estimate - wanted) <= 0.05 * wanted
        assert wanted >= 300 or r.distinct_estimate == wanted
    by_name = {(r.table_name, r.column_name): r for r in first}
    assert by_name["a", "list"].null_count == 20_000 and by_name["a", "text"].max_length == 3 and by_name["a", "id"].row_count == 60_000

    write("a", 60_000, 90_000)
    assert profile.refresh_profile(spark, directory, store, ("a", "b")) == 3  # the new files alone
    grown = profile.stored_profile(spark, directory, store, ("a", "b"))
    profile.refresh_profile(spark, directory, f"{store}-anew", ("a", "b"))
    assert collected(grown) == collected(profile.stored_profile(spark, directory, f"{store}-anew", ("a", "b")))


def test_files_that_change_or_go(spark, database):
    directory, store, write = database
    profile.refresh_profile(spark, directory, store, ("a", "b"))
    shutil.rmtree(f"{directory}/b.parquet")
    write("b", 500, 530)
    assert profile.refresh_profile(spark, directory, store, ("a", "b")) == 3
    rows = {r.column_name: r for r in profile.stored_profile(spark, directory, store, ("b",)).collect()}
    assert rows["id"].row_count == rows["id"].distinct_estimate == 30
    # Rows that a repeated refresh wrote twice count once.
    spark.read.parquet(store).limit(40).write.mode("append").parquet(store)
    again = {r.column_name: r.row_count for r in profile.stored_profile(spark, directory, store, ("b",)).collect()}
    assert again == {c: 30 for c in rows}
