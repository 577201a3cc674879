from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cloakframe.operators import masking, query
from cloakframe.plans.derived import derived
from cloakframe.plans.registry import QUERIES
from cloakframe.session import work_dir
from cloakframe.sources.tables import TableNotFound, load_table, register_tables, result_json, write_json
from cloakframe.streaming.masking import mask_stream, read_stream


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_masking_keeps_rows_columns_and_money(spark, data_dir):
    people = derived(spark, data_dir, "people")
    masked = masking.mask_table(people)
    assert masked.columns == people.columns
    assert masked.count() == people.count()
    same = people.select("person_id", "account_balance", "account_type")
    assert same.exceptAll(masked.select(*same.columns)).isEmpty()
    assert not masked.where(F.col("password") != "[REDACTED]").count()


def test_masking_is_a_narrow_projection_over_the_columns_it_needs(spark, data_dir):
    masked = masking.mask_table(load_table(spark, data_dir, "orders")).select("o_orderkey")
    text = plan(masked)
    assert "Exchange" not in text and "Python" not in text
    assert "ReadSchema: struct<o_orderkey:bigint>" in text


def test_money_and_number_columns_cost_nothing(spark, data_dir):
    df = load_table(spark, data_dir, "lineitem").select("l_orderkey", "l_extendedprice", "l_shipdate")
    assert "RLIKE" not in plan(masking.mask_table(df))


def test_report_counts_rows_that_changed(spark, data_dir):
    people = derived(spark, data_dir, "people")
    masked = masking.mask_table(people)
    keyed = people.alias("a").join(masked.alias("b"), "person_id")
    differs = None
    for c in people.columns[1:]:
        d = ~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
        differs = d if differs is None else differs | d
    row = masking.masking_report(people).first()
    assert (row["total_rows"], row["masked_rows"]) == (people.count(), keyed.where(differs).count())


def test_typed_columns(spark):
    row = (
        -1234567890, 0.333333333333333, datetime.date(1990, 2, 3), datetime.datetime(2020, 1, 2, 3, 4, 5), True, Decimal("7.25"),
        datetime.date(1990, 2, 3), 123456789, ["bob@example.com", None, "x"], {"k": "123-45-6789"}, ("a b@example.com", 5),
        [1.5, 2.5], bytearray(b"1"),
    )
    df = spark.createDataFrame(
        [row],
        "n bigint, x double, day date, at timestamp, phone_ok boolean, dec decimal(10,2), dob date, ssn bigint, "
        "notes array<string>, tags map<string,string>, who struct<email:string,age:int>, vec array<double>, raw binary",
    )
    kept = masking.mask_table(df).first()
    assert (kept["n"], kept["x"], kept["day"], kept["at"], kept["dec"]) == (row[0], row[1], row[2], row[3], row[5])
    assert kept["phone_ok"] == "[MASKED_PHONE]"
    assert kept["dob"] == "1********3"
    assert kept["ssn"] == "123456789"
    assert kept["notes"] == ["b*b@example.com", None, "x"]
    assert kept["tags"] == {"k": "***-**-6789"}
    assert kept["who"]["email"] == "a*b@example.com" and kept["who"]["age"] == 5
    assert kept["vec"] == [1.5, 2.5] and kept["raw"] == bytearray(b"1")
    strict = masking.mask_table(df, numeric="strict").first()
    assert strict["n"] == "(123) ***-**90" and strict["x"] == "(033) ***-**33" and strict["dec"] == "7.25"
    assert masking.masking_report(df).first()["masked_rows"] == 1


def test_a_masked_map_counts_as_a_change(spark):
    df = spark.createDataFrame([({"k": "123-45-6789"}, 1), ({"k": "x"}, 2), (None, 3)], "tags map<string,string>, id int")
    flags = {r["id"]: r["was_masked"] for r in masking.with_change_flag(df).collect()}
    assert flags == {1: True, 2: False, 3: False}


def test_tables_kept_as_folders_of_files(spark, data_dir, tmp_path):
    for t in ("documents", "customer"):
        load_table(spark, data_dir, t).repartition(3).write.parquet(str(tmp_path / f"{t}.parquet"))
    for name in ("mask_stream", "mask_table", "masking_report", "bounded_query"):
        folders, single = (QUERIES[name](spark, d) for d in (str(tmp_path), data_dir))
        assert folders.count() == single.count()
        assert folders.exceptAll(single).isEmpty()


def test_refusals(spark):
    df = spark.range(1)
    with pytest.raises(ValueError, match="duplicate"):
        masking.mask_table(df.select("id", "id"))
    with pytest.raises(ValueError, match="numeric"):
        masking.mask_table(df, numeric="loose")
    with pytest.raises(TableNotFound):
        load_table(spark, "/nowhere", "no_such_table")
    with pytest.raises(TableNotFound, match="customer not found in /nowhere"):
        load_table(spark, "/nowhere", "customer")


def test_column_names_with_odd_characters(spark):
    df = spark.createDataFrame([("bob@example.com", "x")], "`a.b``c` string, `d e` string")
    assert tuple(masking.mask_table(df).first()) == ("b*b@example.com", "x")


def test_a_capped_query_masks_only_what_it_returns(spark, data_dir):
    register_tables(spark, data_dir)
    capped = query.bounded_query(spark, "SELECT c_name FROM customer", max_rows=7)
    assert len(capped.collect()) == 7 and capped.count() == 7
    assert "CollectLimit 7" in plan(capped)
    top = query.bounded_query(spark, "SELECT c_name, c_phase FROM (SELECT *, c_acctbal AS c_phase FROM customer) "
                              "ORDER BY c_custkey DESC", max_rows=7)
    text = plan(top)
    assert "TakeOrderedAndProject(limit=7" in text and "rangepartitioning" not in text
    assert query.result_message(7, 7) == "Results limited to 7 rows (PII filtered)"
    assert query.result_message(6, 7) == "Retrieved 6 rows (PII filtered)"


def test_capped_and_whole_masking_agree(spark, data_dir):
    people = derived(spark, data_dir, "people")
    whole, capped = masking.with_change_flag(people), masking.mask_capped(people, flag="was_masked")
    assert whole.exceptAll(capped).isEmpty() and capped.exceptAll(whole).isEmpty()


def test_execute_query(spark, data_dir):
    register_tables(spark, data_dir)
    shown = query.execute_query(spark, "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey", max_rows=3)
    assert (shown.columns, shown.row_count) == (["c_custkey", "c_name"], 3)
    assert shown.rows[2]["c_name"] == "***-**-0002"
    assert shown.message == "Results limited to 3 rows (PII filtered)"


def test_parameters(spark, data_dir):
    register_tables(spark, data_dir)
    one = query.bounded_query(spark, "SELECT c_custkey FROM customer WHERE c_custkey = :k", args={"k": 3})
    assert [r[0] for r in one.collect()] == [3]


def test_query_with_stats(spark, data_dir):
    register_tables(spark, data_dir)
    run = query.query_with_stats(spark, "SELECT c_custkey, c_name FROM customer", max_rows=5)
    stats = run.stats.first()
    assert (stats["row_count"], stats["masked_rows"], stats["was_truncated"]) == (5, 5, True)
    assert "(limited to 5 rows) (PII filtered)" in stats["message"]
    assert len(run.rows) == 5 and all(r["c_name"].startswith("***-**-") for r in run.rows)
    with pytest.raises(query.UnsafeQuery, match="DELETE"):
        query.query_with_stats(spark, "DELETE FROM customer WHERE 1 = 1")
    assert query.performance_warning(0.5) is None
    assert query.performance_warning(2) == "Query execution time is elevated"
    assert query.performance_warning(6) == "Query took longer than 5 seconds to execute"


def test_json(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert [r[0] for r in result_json(df).collect()] == ['{"a":1,"b":null}', '{"a":2,"b":"x"}']
    write_json(df, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 2


def test_stream_equals_batch_and_resumes(spark, data_dir, tmp_path):
    pages = load_table(spark, data_dir, "conversations")
    source, sink, checkpoint = (str(tmp_path / d) for d in ("in", "out", "ckpt"))
    half = pages.where(F.col("conv_id") < 40)
    half.write.parquet(source)
    mask_stream(read_stream(spark, source, pages.schema, 1), sink, checkpoint).awaitTermination()
    pages.where(F.col("conv_id") >= 40).write.mode("append").parquet(source)
    mask_stream(read_stream(spark, source, pages.schema, 1), sink, checkpoint).awaitTermination()
    streamed, batch = spark.read.parquet(sink), masking.mask_table(pages)
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).isEmpty()


class FakeSession:
    """A session of a cluster that names its shared folder, or does not."""

    def __init__(self, folder, master):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master})


def test_work_dir_follows_the_session(spark):
    assert work_dir(FakeSession("/shared/work/", "spark://host:7077")) == "/shared/work"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(FakeSession(None, "spark://host:7077"))
    assert work_dir(FakeSession(None, "local[2]"))


def test_nested_values(spark):
    df = spark.range(1).selectExpr(
        "map('bob.smith@example.com', 1, 'x', 2, 'bab.smith@example.com', 3) AS by_mail", "array(date'1990-02-03') AS dob",
        "struct(cast('secret' AS binary) AS password, 5 AS n) AS s", "array(-1234567890L, 7L) AS ids",
        "array(named_struct('phone', array(named_struct('email', 'ann.lee@example.com')))) AS deep", "array(1.5D) AS price",
    )
    kept, strict = masking.mask_table(df).first(), masking.mask_table(df, numeric="strict").first()
    assert len(kept["by_mail"]) == 2 and sorted(kept["by_mail"].values()) == [2, 3]  # equal keys: the last stays
    assert "bob.smith@example.com" not in kept["by_mail"] and kept["by_mail"]["x"] == 2
    assert kept["dob"] == ["1********3"] and kept["s"]["password"] == "[REDACTED]" and kept["s"]["n"] == 5
    assert kept["ids"] == [-1234567890, 7] and strict["ids"][0] != "-1234567890" and strict["price"] == [1.5]
    assert "ann.lee" not in str(kept["deep"])
    assert masking.with_change_flag(df).first()["was_masked"] is True
