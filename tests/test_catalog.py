from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cloakframe.operators import catalog, hot_keys, search
from cloakframe.sources.tables import TABLES, TableNotFound, load_table, load_tables


def test_inventory_against_counts_and_files(spark, data_dir):
    listed = {r["table_name"]: r for r in catalog.table_inventory(spark, data_dir).collect()}
    assert list(listed) == sorted(TABLES)
    for t in TABLES:
        df = load_table(spark, data_dir, t)
        assert listed[t]["row_count"] == df.count()
        assert listed[t]["columns"] == df.columns and listed[t]["column_count"] == len(df.columns)
        assert listed[t]["modified_date"] is not None


def test_inventory_filters(spark, data_dir):
    names = [r["table_name"] for r in catalog.table_inventory(spark, data_dir, "ITEM").collect()]
    assert names == ["lineitem"]
    names = [r["table_name"] for r in catalog.table_inventory(spark, data_dir, "%o_d").collect()]
    assert names == ["orders"]
    names = [r["table_name"] for r in catalog.table_inventory(spark, data_dir, "%o_um").collect()]
    assert names == ["documents"]
    assert catalog.table_inventory(spark, data_dir, schema_filter="other").count() == 0


def test_stats_of_a_table_in_many_files(spark, tmp_path):
    path = str(tmp_path / "big.parquet")
    spark.range(1000).repartition(4).write.parquet(path)
    row = catalog.table_stats(spark, str(tmp_path), "big", ("big",)).first()
    assert (row["row_count"], row["file_count"]) == (1000, 4)
    assert row["data_space_kb"] > 0 and row["last_update"] is not None
    with pytest.raises(TableNotFound, match="Table nope not found"):
        catalog.table_stats(spark, str(tmp_path), "nope")


def test_database_info(spark, data_dir):
    row = catalog.database_info(spark, data_dir).first()
    assert row["table_count"] == len(TABLES) and row["tables"] == sorted(TABLES)
    assert row["size_mb"] > 0.1
    assert [r["table_name"] for r in catalog.table_list(spark).collect()] == sorted(TABLES)


def test_columns(spark):
    df = spark.createDataFrame([(1, "ab", None), (2, None, 1.5)], "id int, email string, `odd'na``me` double")
    rows = catalog.column_catalog(spark, {"t": df}).collect()
    assert [(r["column_name"], r["data_type"], r["is_sensitive"], r["numeric_precision"]) for r in rows] == [
        ("id", "int", False, 10), ("email", "string", True, None), ("odd'na`me", "double", False, None),
    ]
    profiled = catalog.column_profile({"t": df}).collect()
    assert [(r["column_name"], r["row_count"], r["null_count"], r["max_length"]) for r in profiled] == [
        ("id", 2, 0, None), ("email", 2, 1, 2), ("odd'na`me", 2, 1, None),
    ]


def test_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (3, "c")], "k int, v string")
    rows = {r["key_columns"]: r for r in catalog.key_profile({"t": df}, [("t", ["k"]), ("t", ["k", "v"]), ("t", ["v"])]).collect()}
    assert (rows["k"]["distinct_keys"], rows["k"]["max_rows_per_key"], rows["k"]["is_unique"]) == (3, 2, False)
    assert (rows["k,v"]["null_keys"], rows["k,v"]["is_unique"]) == (1, False)
    assert (rows["v"]["distinct_keys"], rows["v"]["null_keys"], rows["v"]["row_count"]) == (3, 1, 4)


def test_relationships(spark):
    child = spark.createDataFrame([(1,), (1,), (9,), (9,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (1,), (None,)], "pk int")
    row = catalog.relationship_check({"c": child, "p": parent}, [("c", "fk", "p", "pk")]).first()
    assert (row["orphan_keys"], row["orphan_rows"], row["holds"]) == (1, 2, False)


def test_flags_and_counts(spark):
    own = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    facts = spark.createDataFrame([(1,), (1,), (None,)], "f int")
    flagged = catalog.with_exists_flags(own, {"has": (facts, "f", "k")})
    assert {r["k"]: r["has"] for r in flagged.collect()} == {1: True, 2: False, None: False}
    counted = catalog.with_counts(own, {"n": (facts, "f", "k")})
    assert {r["k"]: r["n"] for r in counted.collect()} == {1: 2, 2: 0, None: 0}


def test_lookups_with_hot_and_null_keys(spark, monkeypatch):
    monkeypatch.setattr(hot_keys, "HOT_ONE_IN", 10)  # hot above a tenth of the rows
    own = spark.range(0, 30_000, 1, 64).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 7L WHEN id % 3 = 1 THEN NULL WHEN id % 30 = 2 THEN 8L ELSE id END AS k"
    )
    facts = spark.range(30_000).selectExpr("CASE WHEN id < 5 THEN 7L ELSE id END AS f")
    expected = own.join(facts.groupBy("f").count(), own["k"] == F.col("f"), "left").selectExpr(
        "id", "k", "coalesce(count, 0L) AS n"
    )
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        counted = catalog.with_counts(own, {"n": (facts, "f", "k")})
        assert counted.exceptAll(expected).isEmpty() and expected.exceptAll(counted).isEmpty()
        hot = hot_keys.hot_among(hot_keys.key_counts(own, ["k"]))
        assert [r["k"] for r in hot.collect()] == [7]
        found = hot_keys.left_lookup(own, facts.groupBy("f").count(), "k", "f")
        assert "hashpartitioning(__own" in found._jdf.queryExecution().executedPlan().toString()
        # The sum keeps the join from being optimized away.
        spread = found.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.sum("count")).collect()
        largest = max(r["n"] for r in spread)
        assert sum(r["n"] for r in spread) == 30_000
        assert largest < 9_000  # 10,000 rows share a key and 10,000 have none
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.fixture
def catalogs(spark):
    tables = spark.createDataFrame(
        [("Order", "dbo", None), ("OrderLine", "dbo", None), ("Preorder", "dbo", "x"), ("Log", "dbo", "keeps each ORDER"), ("Misc", "dbo", None)],
        "object_name string, schema_name string, description string",
    )
    columns = spark.createDataFrame(
        [("order_id", "Order", "bigint"), ("note", "Order", "string")], "object_name string, table_name string, data_type string"
    )
    indexes = spark.createDataFrame([("IX_Order", "Order"), (None, "Order")], "object_name string, table_name string")
    return tables, columns, indexes


def test_search(catalogs):
    hits = search.by_score(search.schema_search("order", *catalogs)).collect()
    assert [(r["object_type"], r["object_name"], r["match_score"]) for r in hits] == [
        ("Table", "Order", 100), ("Table", "OrderLine", 90), ("Column", "order_id", 90), ("Table", "Preorder", 70),
        ("Index", "IX_Order", 70), ("Table", "Log", 50),
    ]


@pytest.mark.parametrize("kind,n", [("TABLE", 4), ("column", 1), ("Index", 1), ("view", 0)])
def test_search_by_type(catalogs, kind, n):
    assert search.schema_search("order", *catalogs, object_type=kind).count() == n


def test_a_term_is_text_not_a_pattern(spark):
    df = spark.createDataFrame([("a_b",), ("axb",), ("50%",)], "name string")
    assert [r["name"] for r in search.keyword_rank(df, "name", "a_b").collect()] == ["a_b"]
    assert [r["name"] for r in search.keyword_rank(df, "name", "%").collect()] == ["50%"]


def test_the_real_catalog_can_be_searched(spark, data_dir):
    frames = load_tables(spark, data_dir)
    columns = catalog.column_catalog(spark, frames).withColumnRenamed("column_name", "object_name")
    tables = catalog.table_list(spark).withColumnRenamed("table_name", "object_name")
    hits = search.schema_search("order", tables, columns)
    assert hits.where((F.col("object_type") == "Column") & (F.col("match_score") == 70)).count() == 5
