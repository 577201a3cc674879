"""Workload analytics over log tables: slow statements, object usage, suggestion impact and waits.

Each analysis is detail + summary. A log is pre-aggregated on its keys before anything else touches
it, so a hot statement, object or wait type costs one partial row per task, and what is joined, ranked
or shared afterwards is already one row per key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cloakframe.functions.statements import statement_hash
from cloakframe.functions.text import any_of, decimal_ratio, has_text, hash_text, one_line, or_zero

MS = "decimal(18,3)"


def _ms(micros: Column) -> Column:
    """Whole microseconds as milliseconds with three decimals."""
    return (micros.cast("decimal(20,0)") / F.lit(1000)).cast(MS)


def _div(total: str, count: str) -> Column:
    return F.expr(f"{total} div {count}")


def _stamped(summary: DataFrame) -> DataFrame:
    return summary.withColumn("analysis_timestamp", F.current_timestamp())


# -- slow statements ---------------------------------------------------------------------------


def with_statement_hash(log: DataFrame, text_col: str = "query_text") -> DataFrame:
    """The log with hashes that the texts give: runs whose texts differ in literals, comments or layout are one statement."""
    return log.withColumn("query_hash", statement_hash(F.col(text_col)))


def statement_stats(log: DataFrame, *more_keys: str) -> DataFrame:
    """Per statement hash: executions, times, reads, first and last run. No text takes part."""
    return log.groupBy("query_hash", *more_keys).agg(
        F.count("*").alias("execution_count"),
        F.sum("elapsed_us").alias("total_elapsed_us"),
        F.max("elapsed_us").alias("max_elapsed_us"),
        F.sum("cpu_us").alias("total_cpu_us"),
        F.sum("logical_reads").alias("total_logical_reads"),
        F.sum("physical_reads").alias("total_physical_reads"),
        F.max("executed_at").alias("last_execution_time"),
        F.min("executed_at").alias("creation_time"),
    )


# Statements up to this number are sent to all tasks for the lookup of their texts: hashes and times only.
SHIPPED_STATEMENTS = 10_000


def with_texts(statements: DataFrame, log: DataFrame, top_count: int | None, unhashed: DataFrame | None = None) -> DataFrame:
    """Statements with their text, looked up when only the wanted ones are left.

    Of several texts of one hash it is that of the last run, and of several last runs the one that sorts first; the
    rows of other runs are gone before any text moves. Hashes of shapes are dear: of ``unhashed``, the log before
    ``with_statement_hash``, only rows are hashed whose time is that of a wanted run.
    """
    wanted = statements.select(F.col("query_hash").alias("__hash"), F.col("last_execution_time").alias("__last"))
    if top_count is not None and top_count <= SHIPPED_STATEMENTS:
        wanted = F.broadcast(wanted)
    if unhashed is not None:
        times = wanted.select(F.col("__last").alias("__time"))
        log = with_statement_hash(unhashed.join(times, F.col("executed_at").eqNullSafe(F.col("__time")), "left_semi"))
    rows = log.select("query_hash", "query_text", "executed_at")
    last_runs = rows.join(
        wanted, F.col("query_hash").eqNullSafe(F.col("__hash")) & F.col("executed_at").eqNullSafe(F.col("__last"))
    )
    texts = last_runs.groupBy("__hash").agg(F.min("query_text").alias("query_text"))
    if top_count is not None and top_count <= SHIPPED_STATEMENTS:
        texts = F.broadcast(texts)
    return statements.join(texts, F.col("query_hash").eqNullSafe(F.col("__hash")), "left").drop("__hash")


def _listing(found: DataFrame, top_count: int | None, *order: Column | str) -> DataFrame:
    """The first rows in an order, or all of them in none."""
    return found if top_count is None else found.orderBy(*order).limit(top_count)


def _slow(stats: DataFrame, minimum_ms: int) -> DataFrame:
    averaged = stats.withColumns(
        {
            "avg_elapsed_us": _div("total_elapsed_us", "execution_count"),
            "avg_cpu_us": _div("total_cpu_us", "execution_count"),
        }
    )
    return averaged.where(F.col("avg_elapsed_us") >= minimum_ms * 1000)


TEXT_KEY = "__text"


def _with_text_key(log: DataFrame) -> DataFrame:
    """The log with a key that tells texts apart, so that no text crosses a shuffle."""
    return log.withColumn(TEXT_KEY, F.sha2("query_text", 256))


def _slow_texts(log: DataFrame, top_count: int | None, minimum_ms: int) -> DataFrame:
    """Slow statements by hash and text; of equal averages and hashes the texts that sort first, as they are shown.

    Which hashes the first ones have is found by keys of texts; then only the rows of these hashes are grouped by text.
    """
    order = [F.desc("avg_elapsed_us"), "query_hash"]
    if top_count is not None:
        first = _listing(_slow(statement_stats(_with_text_key(log), TEXT_KEY), minimum_ms), top_count, *order)
        wanted = first.select(F.col("query_hash").alias("__hash"))
        if top_count <= SHIPPED_STATEMENTS:
            wanted = F.broadcast(wanted)
        log = log.join(wanted, F.col("query_hash").eqNullSafe(F.col("__hash")), "left_semi")
    slow = _slow(statement_stats(log, "query_text"), minimum_ms)
    return _listing(slow, top_count, *order, one_line(F.col("query_text"), None), "query_text")


def slow_groups(
    log: DataFrame,
    top_count: int | None = 50,
    minimum_ms: int = 1000,
    database: str | None = None,
    text_chars: int | None = None,
    texts: bool = True,
    stats: DataFrame | None = None,
    by_text: bool = False,
    unhashed: DataFrame | None = None,
) -> DataFrame:
    """Statements whose average elapsed time reaches the threshold, slowest first, top k.

    Averages divide whole microseconds before they become milliseconds. ``top_count=None`` gives all statements,
    which is what summaries need (they need no ``texts``); texts are whole unless ``text_chars`` says how much to show.
    A statement is a hash; its text is looked up for the statements in the result (see ``with_texts``). ``stats`` are
    its ``statement_stats`` where they are known already, as from a rollup; then the log serves the texts alone.
    ``by_text`` takes a hash and a text for a statement, so that texts of one hash stay apart, slow ones beside fast ones.
    ``unhashed`` is the log before ``with_statement_hash``, where it has those hashes; the lookup then takes few of them.
    """
    if by_text and stats is not None:
        raise ValueError("known statistics are per hash")
    order = [F.desc("avg_elapsed_us"), "query_hash"]
    if by_text and texts:
        found = _slow_texts(log, top_count, minimum_ms)
    else:
        if by_text:
            stats = statement_stats(_with_text_key(log), TEXT_KEY)
        slow = _slow(statement_stats(log) if stats is None else stats, minimum_ms)
        # The other columns break no ties. As sort keys they stay in every use of these rows, so that all uses ask for
        # the same shuffle, which Spark runs once.
        slow = _listing(slow, top_count, *order, *slow.columns)
        found = with_texts(slow, log, top_count, unhashed) if texts else slow.withColumn("query_text", F.lit(None).cast("string"))
    is_binary = isinstance(log.schema["query_hash"].dataType, T.BinaryType)
    shown = found.select(
        (hash_text(F.col("query_hash")) if is_binary else F.col("query_hash")).alias("query_hash"),
        one_line(F.col("query_text"), text_chars).alias("query_text"),
        "execution_count",
        _ms(F.col("total_elapsed_us")).alias("total_elapsed_ms"),
        _ms(F.col("avg_elapsed_us")).alias("avg_elapsed_ms"),
        _ms(F.col("max_elapsed_us")).alias("max_elapsed_ms"),
        _ms(F.col("total_cpu_us")).alias("total_cpu_ms"),
        _ms(F.col("avg_cpu_us")).alias("avg_cpu_ms"),
        "total_logical_reads",
        _div("total_logical_reads", "execution_count").alias("avg_logical_reads"),
        "total_physical_reads",
        _div("total_physical_reads", "execution_count").alias("avg_physical_reads"),
        "last_execution_time",
        "creation_time",
        _ms(F.col("total_cpu_us")).alias("total_worker_time_ms"),
        F.lit(database).cast("string").alias("database_name"),
    )
    return shown if top_count is None else shown.orderBy(F.desc("avg_elapsed_ms"), "query_hash", "query_text")


def slow_groups_summary(slow: DataFrame, minimum_ms: int = 1000) -> DataFrame:
    """Totals over the given statements: give ``slow_groups`` without a cap."""
    found = slow.agg(
        F.count("*").alias("total_queries"),
        F.count_if(F.col("avg_elapsed_ms") >= minimum_ms).alias("slow_queries"),
        F.coalesce(F.avg("avg_elapsed_ms"), F.lit(0)).cast("decimal(18,6)").alias("average_execution_ms"),
        F.coalesce(F.sum("total_cpu_ms") / 1000, F.lit(0)).cast("decimal(18,6)").alias("total_cpu_seconds"),
        F.coalesce(F.sum("total_logical_reads"), F.lit(0)).alias("total_logical_reads"),
        F.coalesce(F.sum("total_physical_reads"), F.lit(0)).alias("total_physical_reads"),
    )
    text = F.concat(
        F.lit("Found "),
        F.col("total_queries").cast("string"),
        F.lit(f" slow queries with average execution time >= {minimum_ms}ms"),
    )
    return _stamped(found.withColumn("message", text))


# -- object usage ------------------------------------------------------------------------------

# Storage type of an object by its code.
OBJECT_TYPES = {
    0: "Heap",
    1: "Clustered",
    2: "Nonclustered",
    3: "XML",
    4: "Spatial",
    5: "Clustered Columnstore",
    6: "Nonclustered Columnstore",
    7: "Nonclustered Hash",
}
# Uses at which the score is full, and below which a category holds.
FULL_SCORE_USES = 10000
LIGHT_BELOW, MODERATE_BELOW = 100, 1000

# How the log names the accesses that are counted.
ACCESS_CODES = {"seek": "R", "scan": "A", "lookup": "N"}
UPDATE_STATUS = "F"


def object_type(code: Column) -> Column:
    ladder = F.when(code == 0, OBJECT_TYPES[0])
    for value, label in OBJECT_TYPES.items():
        if value:
            ladder = ladder.when(code == value, label)
    return ladder.otherwise("Unknown")


def usage_score(uses: Column) -> Column:
    """0 to 100: a hundredth of the uses."""
    partial = (uses.cast("decimal(20,0)") / 100).cast("decimal(5,2)")
    full = F.lit(100).cast("decimal(5,2)")
    return F.when(uses == 0, F.lit(0).cast("decimal(5,2)")).when(uses >= FULL_SCORE_USES, full).otherwise(partial)


def usage_category(uses: Column) -> Column:
    return (
        F.when(uses == 0, "Unused").when(uses < LIGHT_BELOW, "Light").when(uses < MODERATE_BELOW, "Moderate")
        .otherwise("Heavy")
    )


def usage_counts(log: DataFrame, keys: list[str]) -> DataFrame:
    """Seeks, scans, lookups and updates per object with the last time of each, in one pass."""
    used = F.col("used_at")
    aggregates = []
    for kind, code in ACCESS_CODES.items():
        hit = F.col("access") == code
        aggregates += [F.count_if(hit).alias(f"user_{kind}s"), F.max(F.when(hit, used)).alias(f"last_user_{kind}")]
    update = F.col("status") == UPDATE_STATUS
    aggregates += [F.count_if(update).alias("user_updates"), F.max(F.when(update, used)).alias("last_user_update")]
    return log.groupBy(*keys).agg(*aggregates)


def _places(*tables: DataFrame) -> list[str]:
    return [c for c in ("database_name", "schema_name") if all(c in t.columns for t in tables)]


def usage_scores(objects: DataFrame, log: DataFrame, table_name: str | None = None) -> DataFrame:
    """Every object with its use counts, score and category; objects without uses score 0.

    Objects of one name in several databases or schemas are told apart by ``database_name`` and ``schema_name``,
    where both tables have them. ``is_unique`` and ``is_primary_key`` are shown where the objects have them.
    """
    keys = [*_places(objects, log), "table_name", "object_key"]
    if table_name:
        objects = objects.where(F.col("table_name") == table_name)
        log = log.where(F.col("table_name") == table_name)
    joined = objects.where(F.col("type_code") >= 0).join(usage_counts(log, keys), keys, "left")
    counts = ["user_seeks", "user_scans", "user_lookups", "user_updates"]
    filled = joined.withColumns({c: or_zero(F.col(c), "bigint") for c in counts})
    uses = F.col("user_seeks") + F.col("user_scans") + F.col("user_lookups")
    scored = filled.withColumn("uses", uses)
    return scored.select(
        *_places(objects, log),
        "table_name",
        "object_key",
        F.coalesce("object_name", F.lit("HEAP")).alias("object_name"),
        object_type(F.col("type_code")).alias("object_type"),
        *[c for c in ("is_unique", "is_primary_key") if c in objects.columns],
        *counts,
        "last_user_seek",
        "last_user_scan",
        "last_user_lookup",
        "last_user_update",
        or_zero(F.col("size_kb"), "bigint").alias("size_kb"),
        usage_score(F.col("uses")).alias("usage_score"),
        usage_category(F.col("uses")).alias("usage_category"),
    )


def by_usage(scores: DataFrame) -> DataFrame:
    """Report order: score, table, object."""
    return scores.orderBy(F.desc("usage_score"), "table_name", F.asc_nulls_first("object_name"), "object_key")


def usage_summary(scores: DataFrame) -> DataFrame:
    """Objects and sizes by category."""
    category = F.col("usage_category")
    found = scores.agg(
        F.count("*").alias("total_objects"),
        F.count_if(category == "Unused").alias("unused_objects"),
        F.count_if(category == "Heavy").alias("heavily_used_objects"),
        F.count_if(category == "Light").alias("lightly_used_objects"),
        F.coalesce(F.sum("size_kb"), F.lit(0)).alias("total_size_kb"),
        F.coalesce(F.sum(F.when(category == "Unused", F.col("size_kb"))), F.lit(0)).alias("unused_size_kb"),
    )
    text = F.concat(
        F.lit("Analyzed "),
        F.col("total_objects").cast("string"),
        F.lit(" indexes. Found "),
        F.col("unused_objects").cast("string"),
        F.lit(" unused indexes consuming "),
        F.format_number("unused_size_kb", 0),
        F.lit(" KB"),
    )
    return _stamped(found.withColumn("message", text))


# -- suggestion impact -------------------------------------------------------------------------

# Improvement above which a suggestion has a priority.
HIGH_ABOVE, MEDIUM_ABOVE = 100000, 10000
COST_UNITS = 3000


def _bare(columns: Column) -> Column:
    return F.translate(columns, "[]", "")


def suggested_name(table: Column, equality: Column, inequality: Column) -> Column:
    chosen = (
        F.when(has_text(equality), _bare(equality)).when(has_text(inequality), _bare(inequality)).otherwise("Missing")
    )
    return F.concat(F.lit("IX_"), table, F.lit("_"), chosen)


def create_statement(
    schema: Column, table: Column, equality: Column, inequality: Column, included: Column
) -> Column:
    keys = (
        F.when(has_text(equality) & has_text(inequality), F.concat(equality, F.lit(", "), inequality))
        .when(has_text(equality), equality)
        .when(has_text(inequality), inequality)
        .otherwise("[Unknown]")
    )
    include = F.when(has_text(included), F.concat(F.lit(" INCLUDE ("), included, F.lit(")"))).otherwise("")
    return F.concat(
        F.lit("CREATE NONCLUSTERED INDEX ["), suggested_name(table, equality, inequality), F.lit("] ON ["),
        schema, F.lit("].["), table, F.lit("] ("), keys, F.lit(")"), include,
    )


def impact_priority(improvement: Column) -> Column:
    return F.when(improvement > HIGH_ABOVE, "High").when(improvement > MEDIUM_ABOVE, "Medium").otherwise("Low")


SUGGESTION_TEXTS = ("equality_columns", "inequality_columns", "included_columns")
SUGGESTION_KEYS = ("database_name", "schema_name", "table_name", *SUGGESTION_TEXTS)


def suggestion_totals(log: DataFrame, *more_keys: str, schema_name: str = "dbo", database: str | None = None) -> DataFrame:
    """Per suggestion: seeks, scans, sums of cost and impact, last uses."""
    if "schema_name" not in log.columns:
        log = log.withColumn("schema_name", F.lit(schema_name))
    if "database_name" not in log.columns:
        log = log.withColumn("database_name", F.lit(database).cast("string"))
    named = log.where(F.col("table_name").isNotNull()).withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in SUGGESTION_TEXTS})
    seek, scan = F.col("access") == "seek", F.col("access") == "scan"
    return named.groupBy(*SUGGESTION_KEYS, *more_keys).agg(
        F.count_if(seek).alias("user_seeks"),
        F.count_if(scan).alias("user_scans"),
        F.sum("cost_units").alias("cost_units"),
        F.sum("impact_pct").alias("impact_pct"),
        F.count("*").alias("n"),
        F.max(F.when(seek, F.col("used_at"))).alias("last_user_seek"),
        F.max(F.when(scan, F.col("used_at"))).alias("last_user_scan"),
    )


def impact_ranking(
    log: DataFrame | None,
    top_count: int | None = 25,
    schema_name: str = "dbo",
    database: str | None = None,
    totals: DataFrame | None = None,
) -> DataFrame:
    """Suggestions ranked by average cost x average impact x (seeks + scans), top k; all with ``top_count=None``.

    Schema and database come from the rows where the log has them (``schema_name``, ``database_name``), so equal
    names in two schemas stay apart; else they are the given ones. ``totals`` are the ``suggestion_totals`` where they
    are known already.
    """
    grouped = suggestion_totals(log, schema_name=schema_name, database=database) if totals is None else totals
    averaged = grouped.withColumns(
        {
            "avg_total_user_cost": decimal_ratio(F.col("cost_units"), F.col("n") * COST_UNITS, 6),
            "avg_user_impact": decimal_ratio(F.col("impact_pct"), F.col("n"), 6),
        }
    )
    per_use = (F.col("avg_total_user_cost") * F.col("avg_user_impact")).cast("decimal(26,12)")
    uses = (F.col("user_seeks") + F.col("user_scans")).cast("decimal(12,0)")
    measured = averaged.withColumn("improvement_measure", (per_use * uses).cast("decimal(18,2)"))
    table, equality = F.col("table_name"), F.col("equality_columns")
    inequality, included = F.col("inequality_columns"), F.col("included_columns")
    top = _listing(measured, top_count, F.desc("improvement_measure"), *SUGGESTION_KEYS)
    return top.select(
        "database_name",
        "schema_name",
        "table_name",
        *SUGGESTION_TEXTS,
        "improvement_measure",
        "user_seeks",
        "user_scans",
        "avg_total_user_cost",
        "avg_user_impact",
        "last_user_seek",
        "last_user_scan",
        suggested_name(table, equality, inequality).alias("suggested_index_name"),
        create_statement(F.col("schema_name"), table, equality, inequality, included).alias("create_index_statement"),
        impact_priority(F.col("improvement_measure")).alias("priority"),
    )


def impact_summary(ranking: DataFrame) -> DataFrame:
    """Counts by priority and summed improvement over the given suggestions: give ``impact_ranking`` without a cap."""
    priority = F.col("priority")
    found = ranking.agg(
        F.count("*").alias("total_suggestions"),
        F.count_if(priority == "High").alias("high_priority"),
        F.count_if(priority == "Medium").alias("medium_priority"),
        F.count_if(priority == "Low").alias("low_priority"),
        F.coalesce(F.sum("improvement_measure"), F.lit(0)).cast("decimal(28,2)").alias("total_potential_improvement"),
    )
    text = F.concat(
        F.lit("Found "),
        F.col("total_suggestions").cast("string"),
        F.lit(" missing index suggestions. "),
        F.col("high_priority").cast("string"),
        F.lit(" high priority, "),
        F.col("medium_priority").cast("string"),
        F.lit(" medium priority"),
    )
    return _stamped(found.withColumn("message", text))


# -- waits -------------------------------------------------------------------------------------

# Wait types that say nothing about load.
BENIGN_WAITS = (
    "CLR_SEMAPHORE", "LAZYWRITER_SLEEP", "RESOURCE_QUEUE", "SLEEP_TASK",
    "SLEEP_SYSTEMTASK", "SQLTRACE_BUFFER_FLUSH", "WAITFOR", "LOGMGR_QUEUE",
    "CHECKPOINT_QUEUE", "REQUEST_FOR_DEADLOCK_SEARCH", "XE_TIMER_EVENT",
    "BROKER_TO_FLUSH", "BROKER_TASK_STOP", "CLR_MANUAL_EVENT",
    "CLR_AUTO_EVENT", "DISPATCHER_QUEUE_SEMAPHORE", "FT_IFTS_SCHEDULER_IDLE_WAIT",
    "XE_DISPATCHER_WAIT", "XE_DISPATCHER_JOIN", "SQLTRACE_INCREMENTAL_FLUSH_SLEEP",
)
# Category by LIKE pattern, first hit decides.
WAIT_CATEGORIES = (
    ("Locking", ("LCK%",)),
    ("I/O", ("PAGEIO%", "WRITELOG%", "IO_%")),
    ("Latching", ("PAGELATCH%", "PAGEIOLATCH%")),
    ("Memory", ("RESOURCE_%", "CMEMTHREAD%")),
    ("Parallelism", ("CXPACKET%", "EXCHANGE%")),
    ("Network", ("ASYNC_%", "NETWORK_%")),
    ("CPU", ("SOS_%", "THREADPOOL%")),
)
# Advice by wait type.
WAIT_ADVICE = {
    "CXPACKET": "Parallelism overhead - consider adjusting MAXDOP or Cost Threshold",
    "ASYNC_NETWORK_IO": "Client not consuming data fast enough - check network or client processing",
    "PAGEIOLATCH_SH": "Data page reads from disk - consider more memory or faster storage",
    "PAGEIOLATCH_EX": "Data page writes to disk - check storage performance",
    "WRITELOG": "Log file writes - consider faster storage for log files",
    "LCK_M_S": "Shared lock waits - potential blocking or long transactions",
    "LCK_M_X": "Exclusive lock waits - potential blocking or deadlocks",
    "RESOURCE_SEMAPHORE": "Memory pressure - queries waiting for memory grants",
    "THREADPOOL": "Thread pool exhaustion - too many concurrent requests",
}
OTHER_ADVICE = "Review wait type documentation for specific recommendations"
# Description by wait type or LIKE pattern, first hit decides.
WAIT_DESCRIPTIONS = (
    ("CXPACKET", "Parallelism coordination waits"),
    ("ASYNC_NETWORK_IO", "Network I/O waits"),
    ("PAGEIOLATCH%", "Data page I/O waits"),
    ("WRITELOG", "Transaction log write waits"),
    ("LCK_%", "Lock acquisition waits"),
    ("RESOURCE_SEMAPHORE", "Memory grant waits"),
    ("THREADPOOL", "Worker thread waits"),
)
OTHER_DESCRIPTION = "Various SQL Server operations"
BOTTLENECK_ABOVE, BOTTLENECKS = 5, 3


def _first(pairs: list[tuple[Column, str]], other: str) -> Column:
    ladder = reduce(lambda acc, p: acc.when(*p), pairs[1:], F.when(*pairs[0]))
    return ladder.otherwise(other)


def wait_category(kind: Column) -> Column:
    return _first([(any_of([kind.like(p) for p in ps]), c) for c, ps in WAIT_CATEGORIES], "Other")


def wait_recommendation(kind: Column) -> Column:
    return _first([(kind == k, advice) for k, advice in WAIT_ADVICE.items()], OTHER_ADVICE)


def wait_description(kind: Column) -> Column:
    # A text without "%" stands for itself.
    hits = [(kind.like(p) if "%" in p else kind == p, d) for p, d in WAIT_DESCRIPTIONS]
    return _first(hits, OTHER_DESCRIPTION)


def wait_totals(log: DataFrame, *more_keys: str) -> DataFrame:
    """Waits per type, without benign types."""
    return log.where(~F.col("wait_type").isin(*BENIGN_WAITS)).groupBy("wait_type", *more_keys).agg(
        F.count("*").alias("waiting_tasks_count"),
        F.sum("wait_ms").alias("wait_time_ms"),
        F.max("wait_ms").alias("max_wait_time_ms"),
        F.sum("signal_ms").alias("signal_wait_time_ms"),
    )


def wait_share(log: DataFrame | None, top_count: int | None = 20, totals: DataFrame | None = None) -> DataFrame:
    """Wait types that ever waited by their share of all waits, top k; all with ``top_count=None``. ``totals`` are the
    ``wait_totals`` where they are known already.

    The total is a scalar subquery over the grouped rows, so nothing is windowed in one partition. It sums
    every column of the groups: then it asks for the same shuffle as the detail, which Spark runs once.
    """
    totals = (wait_totals(log) if totals is None else totals).where(F.col("wait_time_ms") > 0)
    sums = totals.agg(F.struct(*[F.sum(c).alias(c) for c in totals.columns if c != "wait_type"]).alias("sums"))
    total = sums.scalar().getField("wait_time_ms")
    kind = F.col("wait_type")
    shared = totals.withColumn("all_wait_ms", total).withColumns(
        {
            "percentage_of_total": decimal_ratio(F.col("wait_time_ms") * 100, F.col("all_wait_ms"), 2, 5),
            "avg_wait_time_ms": _div("wait_time_ms", "waiting_tasks_count"),
            "resource_wait_time_ms": F.col("wait_time_ms") - F.col("signal_wait_time_ms"),
        }
    )
    top = _listing(shared, top_count, F.desc("percentage_of_total"), F.desc("wait_time_ms"), "wait_type")
    return top.select(
        "wait_type",
        "waiting_tasks_count",
        F.col("wait_time_ms").cast(MS).alias("wait_time_ms"),
        "max_wait_time_ms",
        "signal_wait_time_ms",
        "resource_wait_time_ms",
        "percentage_of_total",
        "avg_wait_time_ms",
        wait_category(kind).alias("wait_category"),
        wait_description(kind).alias("description"),
        wait_recommendation(kind).alias("recommendation"),
    )


def wait_summary(waits: DataFrame) -> DataFrame:
    """Totals and the top type over the given types: give ``wait_share`` without a cap."""
    rank = F.struct(-F.col("percentage_of_total"), -F.col("wait_time_ms"), F.col("wait_type"))
    found = waits.agg(
        F.coalesce(F.sum("wait_time_ms"), F.lit(0)).cast("decimal(28,3)").alias("total_wait_time_ms"),
        F.count("*").alias("unique_wait_types"),
        F.coalesce(F.min_by("wait_type", rank), F.lit("None")).alias("top_wait_type"),
        F.coalesce(F.max("percentage_of_total"), F.lit(0)).cast("decimal(5,2)").alias("top_wait_percentage"),
    )
    text = F.concat(
        F.lit("Analyzed "),
        F.col("unique_wait_types").cast("string"),
        F.lit(" wait types. Top wait: "),
        F.col("top_wait_type"),
        F.lit(" ("),
        F.col("top_wait_percentage").cast("decimal(5,1)").cast("string"),
        F.lit("%)"),
    )
    return _stamped(found.withColumn("message", text))


def wait_bottlenecks(waits: DataFrame, above: float = BOTTLENECK_ABOVE, top: int = BOTTLENECKS) -> DataFrame:
    """The largest categories above a percentage, as text, over the given types: give ``wait_share`` without a cap."""
    grouped = waits.groupBy("wait_category").agg(F.sum("percentage_of_total").alias("total_percentage"))
    main = grouped.where(F.col("total_percentage") > above)
    largest = main.orderBy(F.desc("total_percentage"), "wait_category").limit(top)
    share = F.col("total_percentage").cast("decimal(6,1)").cast("string")
    label = F.concat(F.col("wait_category"), F.lit(" ("), share, F.lit("% of total waits)"))
    return largest.select("wait_category", F.col("total_percentage").cast("decimal(7,2)"), label.alias("bottleneck"))
