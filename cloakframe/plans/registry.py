"""Every registered query: a function of (spark, directory) to a DataFrame over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakframe.functions import detect, mask, names
from cloakframe.functions.statements import statement_hash
from cloakframe.operators import audit, catalog, discovery, dml, masking, profile, query, rollup, search, workload
from cloakframe.plans.derived import derived, register_used
from cloakframe.plans.passthrough import CAPPED, PASSTHROUGH, SQL_SCALARS_SPARK
from cloakframe.session import work_dir
from cloakframe.sources import file_table
from cloakframe.sources.tables import load_table, load_tables, result_json, table_path
from cloakframe.streaming.masking import mask_stream, mask_stream_counted, read_stream, stream_counts

Query = Callable[[SparkSession, str], DataFrame]

FLAGSHIP_SQL = "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_custkey LIMIT 100"
RESULT_JSON_SQL = "SELECT c_custkey, c_name, c_mktsegment, c_nationkey FROM customer"
STATS_SQL = (
    "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'none' ELSE c_name END AS c_name, o_orderpriority "
    "FROM orders JOIN customer ON o_custkey = c_custkey ORDER BY o_orderkey"
)
SEARCH_TERM = "Ma"
KEYWORD = "ring"
DOCUMENT_KEYWORD = "that"
CATALOG_TERM = "or%e"

PRIMARY_KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"],
    "part": ["p_partkey"], "orders": ["o_orderkey"], "events": ["event_id"], "documents": ["doc_id"],
}
FOREIGN_KEYS = [
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("labels", "doc_id", "documents", "doc_id"),
    ("documents", "doc_id", "labels", "doc_id"),
    ("events", "user_id", "supplier", "s_suppkey"),
]
CANDIDATE_KEYS = [
    ("orders", ["o_orderkey"]),
    ("lineitem", ["l_orderkey", "l_linenumber"]),
    ("lineitem", ["l_orderkey"]),
    ("events", ["event_id"]),
    ("events", ["user_id"]),
    ("labels", ["doc_id"]),
    ("conversations", ["conv_id", "turn"]),
    ("pages", ["url"]),
]


def constraints() -> catalog.Constraints:
    foreign: dict[str, list[tuple[str, str, str]]] = {}
    for child, column, parent, parent_column in FOREIGN_KEYS:
        foreign.setdefault(child, []).append((column, parent, parent_column))
    return catalog.Constraints(PRIMARY_KEYS, foreign, {"lineitem": "lines of orders"})


def _column_query(source: str, **columns: Callable[[], Column]) -> Query:
    """The rows of a derived table with further columns."""

    def run(spark: SparkSession, directory: str) -> DataFrame:
        return derived(spark, directory, source).withColumns({n: c() for n, c in columns.items()})

    return run


def _mask_query(masker: Callable[[Column], Column]) -> Query:
    return _column_query("value_shapes", masked=lambda: masker(F.col("v")))


def _passthrough(sql: str, max_rows: int | None = None) -> Query:
    def run(spark: SparkSession, directory: str) -> DataFrame:
        register_used(spark, directory, sql)
        return query.bounded_query(spark, sql, max_rows)

    return run


def _table(operator: Callable[[DataFrame], DataFrame], source: str, base: bool = False) -> Query:
    def run(spark: SparkSession, directory: str) -> DataFrame:
        df = load_table(spark, directory, source) if base else derived(spark, directory, source)
        return operator(df)

    return run


def _joined(df: DataFrame, *arrays: str) -> DataFrame:
    """Array columns as one text each."""
    return df.withColumns({a: F.array_join(F.col(a), "; ") for a in arrays})


# -- PII ---------------------------------------------------------------------------------------


def _sensitivity(spark: SparkSession, directory: str) -> DataFrame:
    return masking.check_column_sensitivity(derived(spark, directory, "column_names"))


def _mask_by_type(spark: SparkSession, directory: str) -> DataFrame:
    typed = derived(spark, directory, "named_values").withColumn("kind", names.masking_type(F.col("column_name")))
    return typed.withColumn("masked", mask.mask_by_type(F.col("v"), F.col("kind"))).drop("kind")


def _mask_nested(spark: SparkSession, directory: str) -> DataFrame:
    """People as structs, arrays and maps, masked and laid flat again."""
    nested = derived(spark, directory, "people").select(
        "person_id",
        F.struct("email", F.struct("mobile_phone", "remark").alias("inner")).alias("contact"),
        F.array("remark", "full_name").alias("notes"),
        F.create_map(F.coalesce("email", F.lit("none")), "remark").alias("links"),
        F.array(F.to_date("dob")).alias("dob"),
    )
    return masking.mask_table(nested).select(
        "person_id", "contact.email", "contact.inner.mobile_phone", "contact.inner.remark",
        F.col("notes")[0].alias("note_1"), F.col("notes")[1].alias("note_2"), F.map_keys("links")[0].alias("link_key"),
        F.map_values("links")[0].alias("link_value"), F.col("dob")[0].alias("dob"),
    )


def _mask_stream(spark: SparkSession, directory: str) -> DataFrame:
    # Braces make the path a pattern, which lets a stream start from a single file as well as a folder.
    path = table_path(directory, "documents").removesuffix("parquet") + "{parquet}"
    schema = load_table(spark, directory, "documents").schema
    run = f"{work_dir(spark)}/mask-stream-{uuid4().hex}"
    stream = read_stream(spark, path, schema)
    mask_stream(stream, f"{run}/out", f"{run}/checkpoint").awaitTermination()
    return spark.read.schema(schema).parquet(f"{run}/out")


def _mask_stream_counts(spark: SparkSession, directory: str) -> DataFrame:
    path = table_path(directory, "documents").removesuffix("parquet") + "{parquet}"
    stream = read_stream(spark, path, load_table(spark, directory, "documents").schema)
    run = f"{work_dir(spark)}/mask-counts-{uuid4().hex}"
    mask_stream_counted(stream, f"{run}/out", f"{run}/counts", f"{run}/checkpoint").awaitTermination()
    return stream_counts(spark, f"{run}/counts")


# -- query -------------------------------------------------------------------------------------


def _result_json(spark: SparkSession, directory: str) -> DataFrame:
    register_used(spark, directory, RESULT_JSON_SQL)
    return result_json(query.bounded_query(spark, RESULT_JSON_SQL, None))


def _query_with_stats(spark: SparkSession, directory: str) -> DataFrame:
    register_used(spark, directory, STATS_SQL)
    return query.query_with_stats(spark, STATS_SQL, max_rows=1000).stats


def _query_stats(spark: SparkSession, directory: str) -> DataFrame:
    register_used(spark, directory, STATS_SQL)
    return query.query_stats(spark, STATS_SQL, max_rows=1000)


# -- catalog -----------------------------------------------------------------------------------


def _column_profile(spark: SparkSession, directory: str) -> DataFrame:
    return catalog.column_profile(load_tables(spark, directory))


def _key_profile(spark: SparkSession, directory: str) -> DataFrame:
    used = tuple({table for table, _ in CANDIDATE_KEYS})
    return catalog.key_profile(load_tables(spark, directory, used), CANDIDATE_KEYS)


def _relationship_check(spark: SparkSession, directory: str) -> DataFrame:
    used = tuple({table for child, _, parent, _ in FOREIGN_KEYS for table in (child, parent)})
    return catalog.relationship_check(load_tables(spark, directory, used), FOREIGN_KEYS, PRIMARY_KEYS)


def _table_inventory(spark: SparkSession, directory: str) -> DataFrame:
    listed = catalog.table_inventory(spark, directory, constraints=constraints())
    # Change time and size belong to the files, which SQL over views cannot see.
    return _joined(listed, "columns").drop("modified_date", "data_size_mb")


def _table_stats(spark: SparkSession, directory: str) -> DataFrame:
    stats = catalog.table_stats(spark, directory, "lineitem")
    # Files, sizes and times are not visible to SQL over views.
    return stats.drop("file_count", "data_space_kb", "last_update")


def _database_info(spark: SparkSession, directory: str) -> DataFrame:
    return _joined(catalog.database_info(spark, directory), "tables").drop("database_name", "size_mb")


def _table_inventory_filtered(spark: SparkSession, directory: str) -> DataFrame:
    listed = catalog.table_inventory(spark, directory, "e%nt", catalog.SCHEMA_NAME, constraints())
    return _joined(listed, "columns").drop("modified_date", "data_size_mb")


def _search_catalog(spark: SparkSession, directory: str) -> DataFrame:
    return search.search_catalog(spark, directory, CATALOG_TERM, wildcards=True, descriptions=constraints().descriptions)


def _profile_of_files(spark: SparkSession, directory: str) -> DataFrame:
    """The profile from statistics kept per file; of distinct values the numbers that a sketch gives exactly."""
    store = f"{work_dir(spark)}/profile-{uuid4().hex}"
    profile.refresh_profile(spark, directory, store)
    found = profile.stored_profile(spark, directory, store)
    few = F.when(F.col("distinct_estimate") < 100, F.col("distinct_estimate"))
    return found.withColumn("distinct_if_few", few).drop("ordinal", "data_type", "distinct_estimate")


def _relationships_found(spark: SparkSession, directory: str) -> DataFrame:
    return discovery.find_relationships(load_tables(spark, directory))


def _keys_found(spark: SparkSession, directory: str) -> DataFrame:
    return discovery.found_keys(load_tables(spark, directory))


def _column_distinct_counts(spark: SparkSession, directory: str) -> DataFrame:
    return catalog.column_distinct_counts(load_tables(spark, directory))


def _exists_flags(spark: SparkSession, directory: str) -> DataFrame:
    t = load_tables(spark, directory, ("customer", "orders", "events"))
    urgent = t["orders"].where(F.col("o_orderpriority") == "1-URGENT")
    return catalog.with_exists_flags(
        t["customer"].select("c_custkey", "c_mktsegment"),
        {
            "has_orders": (t["orders"], "o_custkey", "c_custkey"),
            "has_urgent_orders": (urgent, "o_custkey", "c_custkey"),
            "has_events": (t["events"], "user_id", "c_custkey"),
        },
        unique=True,
    )


def _customer_facts(spark: SparkSession, directory: str) -> DataFrame:
    """Flags and counts for rows whose keys repeat."""
    t = load_tables(spark, directory, ("orders", "events"))
    urgent = t["orders"].where(F.col("o_orderpriority") == "1-URGENT")
    orders = t["orders"].select("o_orderkey", "o_custkey")
    flagged = catalog.with_exists_flags(orders, {"has_events": (t["events"], "user_id", "o_custkey")})
    return catalog.with_counts(flagged, {"urgent_orders": (urgent, "o_custkey", "o_custkey")})


def _scalar_subquery_counts(spark: SparkSession, directory: str) -> DataFrame:
    t = load_tables(spark, directory, ("part", "lineitem"))
    return catalog.with_counts(
        t["part"].select("p_partkey", "p_brand"),
        {
            "line_count": (t["lineitem"], "l_partkey", "p_partkey"),
            "returned_count": (t["lineitem"].where(F.col("l_returnflag") == "R"), "l_partkey", "p_partkey"),
        },
        unique=True,
    )


def _schema_search(spark: SparkSession, directory: str) -> DataFrame:
    tables, columns, indexes = (derived(spark, directory, f"search_{k}") for k in ("tables", "columns", "indexes"))
    return search.schema_search(SEARCH_TERM, tables, columns, indexes)


def _keyword_rank(spark: SparkSession, directory: str) -> DataFrame:
    parts = load_table(spark, directory, "part").select("p_partkey", "p_name", "p_type")
    return search.keyword_rank(parts, "p_name", KEYWORD, "p_type")


def _keyword_rank_documents(spark: SparkSession, directory: str) -> DataFrame:
    documents = load_table(spark, directory, "documents")
    ranked = search.keyword_rank(documents, "source", DOCUMENT_KEYWORD, "text")
    return ranked.select("doc_id", "source", "match_score")


# -- workload ----------------------------------------------------------------------------------


def _slow_groups(spark: SparkSession, directory: str) -> DataFrame:
    return workload.slow_groups(derived(spark, directory, "query_log"), by_text=True).drop("database_name")


def _rolled_up(kind: rollup.Rollup, source: str, spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    """A log and its aggregates merged from four stored batches, of which the last comes twice."""
    log = derived(spark, directory, source)
    store = f"{work_dir(spark)}/rollup-{source}-{uuid4().hex}"
    for batch in (0, 1, 2, 3, 3):
        rollup.add_batch(kind, log.where(F.coalesce(F.dayofyear(kind.time), F.lit(0)) % 4 == batch), store, str(batch))
    return log, rollup.merged(kind, spark, store)


def _slow_groups_rolled_up(spark: SparkSession, directory: str) -> DataFrame:
    log, stats = _rolled_up(rollup.STATEMENTS, "query_log", spark, directory)
    return workload.slow_groups(log, stats=stats).drop("database_name")


def _impact_ranking_rolled_up(spark: SparkSession, directory: str) -> DataFrame:
    _, totals = _rolled_up(rollup.SUGGESTIONS, "candidate_log", spark, directory)
    return workload.impact_ranking(None, totals=totals).drop("database_name")


def _wait_share_rolled_up(spark: SparkSession, directory: str) -> DataFrame:
    _, totals = _rolled_up(rollup.WAITS, "wait_log", spark, directory)
    return workload.wait_share(None, totals=totals)


def _slow_shapes(spark: SparkSession, directory: str) -> DataFrame:
    log = derived(spark, directory, "query_log")
    return workload.slow_groups(workload.with_statement_hash(log), unhashed=log).drop("database_name")


def _statement_shapes(spark: SparkSession, directory: str) -> DataFrame:
    log = derived(spark, directory, "query_log")
    return log.select("query_id", statement_hash(F.col("query_text")).alias("statement_hash"))


def _slow_groups_summary(spark: SparkSession, directory: str) -> DataFrame:
    slow = workload.slow_groups(derived(spark, directory, "query_log"), top_count=None, texts=False, by_text=True)
    return workload.slow_groups_summary(slow).drop("analysis_timestamp")


def _scores(spark: SparkSession, directory: str) -> DataFrame:
    return workload.usage_scores(derived(spark, directory, "usage_objects"), derived(spark, directory, "usage_log"))


def _usage_scores(spark: SparkSession, directory: str) -> DataFrame:
    return workload.by_usage(_scores(spark, directory))


def _usage_scores_of_table(spark: SparkSession, directory: str) -> DataFrame:
    objects, log = derived(spark, directory, "usage_objects"), derived(spark, directory, "usage_log")
    return workload.usage_scores(objects, log, "supplier")


def _slow_groups_binary(spark: SparkSession, directory: str) -> DataFrame:
    log = derived(spark, directory, "query_log").withColumn("query_hash", F.col("query_hash").cast("binary"))
    return workload.slow_groups(log, by_text=True).drop("database_name")


def _usage_summary(spark: SparkSession, directory: str) -> DataFrame:
    return workload.usage_summary(_scores(spark, directory)).drop("analysis_timestamp")


def _impact_ranking(spark: SparkSession, directory: str) -> DataFrame:
    return workload.impact_ranking(derived(spark, directory, "candidate_log")).drop("database_name")


def _impact_summary(spark: SparkSession, directory: str) -> DataFrame:
    ranking = workload.impact_ranking(derived(spark, directory, "candidate_log"), top_count=None)
    return workload.impact_summary(ranking).drop("analysis_timestamp")


def _wait_summary(spark: SparkSession, directory: str) -> DataFrame:
    waits = workload.wait_share(derived(spark, directory, "wait_log"), top_count=None)
    return workload.wait_summary(waits).drop("analysis_timestamp")


def _wait_bottlenecks(spark: SparkSession, directory: str) -> DataFrame:
    return workload.wait_bottlenecks(workload.wait_share(derived(spark, directory, "wait_log"), top_count=None))


# -- audit -------------------------------------------------------------------------------------


def _log(spark: SparkSession, directory: str) -> DataFrame:
    cost = (F.col("cost_hundredths").cast("decimal(18,0)") / 100).cast("decimal(18,2)")
    return derived(spark, directory, "query_log").select("query_id", "query_text", cost.alias("estimated_cost"))


def _audit_safety(spark: SparkSession, directory: str) -> DataFrame:
    audited = audit.audit_safety(_log(spark, directory).drop("estimated_cost"))
    return _joined(audited, "violations", "warnings")


def _audit_complexity(spark: SparkSession, directory: str) -> DataFrame:
    return audit.audit_complexity(_log(spark, directory).drop("estimated_cost"))


def _audit_warnings(spark: SparkSession, directory: str) -> DataFrame:
    rated = audit.audit_warnings(_log(spark, directory))
    return _joined(rated, "complexity_warnings").select("query_id", "complexity_level", "complexity_warnings")


def _cost_rating(spark: SparkSession, directory: str) -> DataFrame:
    return audit.cost_rating(_log(spark, directory).drop("query_text"))


def _audit_recommendations(spark: SparkSession, directory: str) -> DataFrame:
    rated = audit.audit_recommendations(_log(spark, directory), cost="estimated_cost")
    return _joined(rated, "recommendations").select("query_id", "resource_usage", "recommendations")


def _audit_validation(spark: SparkSession, directory: str) -> DataFrame:
    lists = ("validation_errors", "validation_warnings", "complexity_warnings")
    audited = _joined(audit.audit_validation(_log(spark, directory)), *lists)
    return audited.select("query_id", "complexity_level", *lists)


def _audit_cost_estimate(spark: SparkSession, directory: str) -> DataFrame:
    return _joined(audit.audit_cost_estimate(_log(spark, directory)), "recommendations").drop("query_text")


def _plan_costs(spark: SparkSession, directory: str) -> DataFrame:
    costs = audit.plan_costs(derived(spark, directory, "plan_log"))
    return audit.cost_rating(costs).select("plan_id", "estimated_cost", "resource_usage")


# -- DML ---------------------------------------------------------------------------------------

def _rewrite(kind: str, spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    target = derived(spark, directory, "dml_target")
    if kind == "insert":
        return dml.insert_rows(target, derived(spark, directory, "dml_source"))
    if kind == "update":
        swap = {"o_custkey": F.col("o_orderkey"), "o_orderkey": F.col("o_custkey")}
        return dml.update_rows(target, F.col("o_orderstatus") == "F", {**swap, "o_orderstatus": F.lit("U")})
    if kind == "delete":
        return dml.delete_rows(target, F.col("o_orderstatus") == "F")
    return dml.merge_rows(target, derived(spark, directory, "dml_source"), ["o_orderkey"])


def _rewritten(kind: str) -> Query:
    return lambda spark, directory: _rewrite(kind, spark, directory)[0]


def _dml_affected(spark: SparkSession, directory: str) -> DataFrame:
    counts = [
        _rewrite(kind, spark, directory)[1].withColumn("operation", F.lit(kind))
        for kind in ("insert", "update", "delete", "merge")
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


def _commanded(kind: str, spark: SparkSession, directory: str) -> tuple[DataFrame, int]:
    """A table after a command on it, read back, and the rows the command affected."""
    path = f"{work_dir(spark)}/table-{kind}-{uuid4().hex}"
    file_table.create_table(derived(spark, directory, "dml_target").repartitionByRange(32, "o_custkey"), path)
    if kind == "insert":
        rows = file_table.insert_into(path, derived(spark, directory, "dml_source"))
    elif kind == "update":
        sets = {"o_orderstatus": F.lit("U"), "o_totalprice": F.col("o_custkey").cast("double")}
        rows = file_table.update_table(spark, path, F.col("o_custkey") % 100 == 1, sets)
    elif kind == "delete":
        rows = file_table.delete_from(spark, path, F.col("o_orderstatus") == "F")
    else:
        rows = file_table.merge_into(path, derived(spark, directory, "dml_source"), ["o_orderkey"])
    return file_table.read_table(spark, path), rows


def _after(kind: str) -> Query:
    return lambda spark, directory: _commanded(kind, spark, directory)[0]


def _commands_affected(spark: SparkSession, directory: str) -> DataFrame:
    """What each command counted while it wrote, beside the rows of the table it left."""
    results = []
    for kind in ("insert", "update", "delete", "merge"):
        table, rows = _commanded(kind, spark, directory)
        results.append(table.agg(F.lit(kind).alias("operation"), F.lit(rows).cast("long").alias("affected_rows"), F.count("*").alias("rows_after")))
    return results[0].unionByName(results[1]).unionByName(results[2]).unionByName(results[3])


QUERIES: dict[str, Query] = {
    # names
    "classify_columns": _table(masking.classify_columns, "column_names"),
    "is_balance_column": _column_query("column_names", is_balance=lambda: names.is_balance_column(F.col("column_name"))),
    "masking_type": _column_query("column_names", masking_type=lambda: names.masking_type(F.col("column_name"))),
    "check_column_sensitivity": _sensitivity,
    "sensitive_column_counts": _table(masking.sensitive_column_counts, "column_names"),
    # values
    "contains_pii": _table(
        lambda df: masking.contains_pii(df).select("source", "row_id", "contains_pii"), "field_values"
    ),
    "value_detectors": _column_query(
        "value_shapes",
        email=lambda: detect.is_email(F.col("v")),
        phone=lambda: detect.is_phone(F.col("v")),
        ssn=lambda: detect.is_ssn(F.col("v")),
        card=lambda: detect.is_card(F.col("v")),
        iban=lambda: detect.is_iban(F.col("v")),
        routing=lambda: detect.is_routing_number(F.col("v")),
        bank_account=lambda: detect.is_bank_account(F.col("v")),
    ),
    "bank_account_by_name": _column_query(
        "named_values", bank_account=lambda: detect.is_bank_account(
            F.col("v"), names.name_rule(F.col("column_name")), account_name=names.names_an_account(F.col("column_name"))
        ),

    ),
    "pii_class_counts": _table(partial(masking.pii_class_counts, group=["source"]), "field_values"),
    "is_monetary": _column_query("value_shapes", is_monetary=lambda: detect.is_monetary(F.col("v"))),
    "is_formatted_account": _column_query(
        "value_shapes", is_formatted_account=lambda: detect.is_formatted_account(F.col("v"))
    ),
    "aba_checksum": _column_query("nine_digits", is_aba=lambda: detect.aba_checksum(F.col("v"))),
    "pii_detection_report": _table(masking.pii_detection_report, "value_shapes"),
    # maskers
    "mask_email": _mask_query(mask.mask_email),
    "mask_phone": _mask_query(mask.mask_phone),
    "mask_ssn": _mask_query(mask.mask_ssn),
    "mask_card": _mask_query(mask.mask_card),
    "mask_formatted_account": _mask_query(mask.mask_formatted_account),
    "mask_bank_account": _mask_query(mask.mask_bank_account),
    "mask_routing": _mask_query(mask.mask_routing),
    "mask_iban": _mask_query(mask.mask_iban),
    "mask_generic": _mask_query(mask.mask_generic),
    "mask_by_type": _mask_by_type,
    "mask_value": _table(masking.mask_named_values, "named_values"),
    # tables
    "mask_table": _table(masking.mask_table, "people"),
    "mask_documents": _table(masking.mask_table, "documents", base=True),
    "mask_pages": _table(masking.mask_table, "pages", base=True),
    "masking_report": _table(masking.masking_report, "people"),
    "mask_nested": _mask_nested,
    "mask_stream": _mask_stream,
    "mask_stream_counts": _mask_stream_counts,
    # query
    "bounded_query": _passthrough(FLAGSHIP_SQL, query.DEFAULT_MAX_ROWS),
    "result_json": _result_json,
    "query_with_stats": _query_with_stats,
    "query_stats": _query_stats,
    **{name: _passthrough(sql) for name, sql in PASSTHROUGH.items()},
    **{name: _passthrough(sql, cap) for name, (sql, cap, *_) in CAPPED.items()},
    "sql_scalars": _passthrough(SQL_SCALARS_SPARK),
    # catalog
    "column_profile": _column_profile,
    "key_profile": _key_profile,
    "relationship_check": _relationship_check,
    "schema_search": _schema_search,
    "keyword_rank": _keyword_rank,
    "keyword_rank_documents": _keyword_rank_documents,
    "exists_flags": _exists_flags,
    "scalar_subquery_counts": _scalar_subquery_counts,
    "repeated_key_lookups": _customer_facts,
    "table_inventory": _table_inventory,
    "table_inventory_filtered": _table_inventory_filtered,
    "search_catalog": _search_catalog,
    "column_distinct_counts": _column_distinct_counts,
    "profile_of_files": _profile_of_files,
    "relationships_found": _relationships_found,
    "keys_found": _keys_found,
    "table_stats": _table_stats,
    "database_info": _database_info,
    # workload
    "slow_groups": _slow_groups,
    "slow_shapes": _slow_shapes,
    "slow_groups_rolled_up": _slow_groups_rolled_up,
    "impact_ranking_rolled_up": _impact_ranking_rolled_up,
    "wait_share_rolled_up": _wait_share_rolled_up,
    "statement_shapes": _statement_shapes,
    "slow_groups_binary": _slow_groups_binary,
    "slow_groups_summary": _slow_groups_summary,
    "usage_scores": _usage_scores,
    "usage_scores_of_table": _usage_scores_of_table,
    "usage_summary": _usage_summary,
    "impact_ranking": _impact_ranking,
    "impact_summary": _impact_summary,
    "wait_share": _table(workload.wait_share, "wait_log"),
    "wait_summary": _wait_summary,
    "wait_bottlenecks": _wait_bottlenecks,
    # audit
    "audit_safety": _audit_safety,
    "audit_complexity": _audit_complexity,
    "audit_warnings": _audit_warnings,
    "cost_rating": _cost_rating,
    "audit_recommendations": _audit_recommendations,
    "audit_validation": _audit_validation,
    "audit_cost_estimate": _audit_cost_estimate,
    "plan_costs": _plan_costs,
    "plan_tree": _table(audit.plan_tree, "plan_log"),
    "plan_operators": _table(audit.plan_operators, "plan_log"),
    "plan_operator_totals": _table(audit.plan_operator_totals, "plan_log"),
    # DML
    "insert_rows": _rewritten("insert"),
    "update_rows": _rewritten("update"),
    "delete_rows": _rewritten("delete"),
    "merge_rows": _rewritten("merge"),
    "dml_affected": _dml_affected,
    "table_after_insert": _after("insert"),
    "table_after_update": _after("update"),
    "table_after_delete": _after("delete"),
    "table_after_merge": _after("merge"),
    "commands_affected": _commands_affected,
}
