"""One SQL text per kind of query that passes straight through; the same text runs in Spark and DuckDB.

Amounts are whole cents so that sums are exact. Rows are grouped or made distinct before they are joined or
windowed, so that a key with a large share of the rows is a few rows by then.
"""

PASSTHROUGH: dict[str, str] = {
    "sql_topk": """
SELECT o_orderkey, o_custkey, o_orderpriority, CAST(round(o_totalprice * 100) AS BIGINT) AS price_cents
FROM orders WHERE o_orderstatus = 'F' ORDER BY price_cents DESC, o_orderkey LIMIT 100""",
    "sql_join": """
WITH per_customer AS (SELECT o_custkey, o_orderpriority, count(*) AS order_count,
    sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents FROM orders GROUP BY o_custkey, o_orderpriority)
SELECT r_name, n_name, o_orderpriority, count(DISTINCT c_custkey) AS customer_count,
  coalesce(sum(order_count), 0) AS order_count, sum(cents) AS revenue_cents
FROM region JOIN nation ON r_regionkey = n_regionkey JOIN customer ON n_nationkey = c_nationkey
  LEFT JOIN per_customer ON c_custkey = o_custkey
GROUP BY r_name, n_name, o_orderpriority""",
    "sql_semi_anti": """
WITH large AS (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 400000),
  urgent AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT 'with_large_order' AS kind, c_custkey, c_mktsegment FROM customer
WHERE EXISTS (SELECT 1 FROM large WHERE o_custkey = c_custkey)
UNION ALL
SELECT 'without_urgent_order', c_custkey, c_mktsegment FROM customer
WHERE NOT EXISTS (SELECT 1 FROM urgent WHERE o_custkey = c_custkey)""",
    "sql_range_join": """
SELECT b.band, count(*) AS part_count, min(p_size) AS min_size, max(p_size) AS max_size
FROM part JOIN (VALUES ('small', 1, 15), ('medium', 16, 35), ('large', 36, 50)) AS b(band, low, high)
  ON p_size BETWEEN b.low AND b.high
GROUP BY b.band""",
    "sql_aggregate": """
SELECT l_returnflag, l_linestatus, count(*) AS line_count, count(DISTINCT l_orderkey) AS order_count,
  sum(CAST(l_quantity AS BIGINT)) AS quantity, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS price_cents,
  min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
FROM lineitem GROUP BY l_returnflag, l_linestatus HAVING count(*) > 10""",
    "sql_rollup": """
SELECT o_orderstatus, o_orderpriority, grouping(o_orderstatus) AS all_status,
  grouping(o_orderpriority) AS all_priority, count(*) AS order_count
FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)""",
    "sql_window": """
WITH monthly AS (SELECT o_custkey, year(o_orderdate) * 100 + month(o_orderdate) AS month_no, count(*) AS order_count,
    sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents FROM orders
  GROUP BY o_custkey, year(o_orderdate) * 100 + month(o_orderdate))
SELECT o_custkey, month_no, order_count,
  row_number() OVER (PARTITION BY o_custkey ORDER BY month_no) AS active_month,
  rank() OVER (PARTITION BY o_custkey ORDER BY cents DESC) AS spend_rank,
  lag(month_no) OVER (PARTITION BY o_custkey ORDER BY month_no) AS previous_month,
  sum(cents) OVER (PARTITION BY o_custkey ORDER BY month_no ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS recent_cents
FROM monthly""",
    "sql_setops": """
WITH c AS (SELECT DISTINCT c_nationkey AS nationkey FROM customer),
  s AS (SELECT DISTINCT s_nationkey AS nationkey FROM supplier)
SELECT nationkey, 'either' AS side FROM (SELECT nationkey FROM c UNION SELECT nationkey FROM s) u
UNION ALL SELECT nationkey, 'both' FROM (SELECT nationkey FROM c INTERSECT SELECT nationkey FROM s) i
UNION ALL SELECT nationkey, 'customer_only' FROM (SELECT nationkey FROM c EXCEPT SELECT nationkey FROM s) e""",
    "sql_subquery": """
WITH spend AS (SELECT o_custkey, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents FROM orders GROUP BY o_custkey)
SELECT c_custkey, c_mktsegment, cents,
  (SELECT count(*) FROM nation WHERE n_nationkey = c_nationkey) AS nations
FROM customer JOIN spend ON o_custkey = c_custkey
WHERE cents > (SELECT max(cents) FROM spend) / 2""",
}

# Texts with personal data among their columns, under a cap and a unique order:
# the text, the cap, the columns that masking changes and the other columns.
CAPPED: dict[str, tuple[str, int, list[str], list[str]]] = {
    "sql_masked_join": (
        """
SELECT o_orderkey, c_name, n_name, o_orderpriority, CAST(round(o_totalprice * 100) AS BIGINT) AS price_cents
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderstatus = 'O' ORDER BY price_cents DESC, o_orderkey""",
        300,
        ["c_name"],
        ["o_orderkey", "n_name", "o_orderpriority", "price_cents"],
    ),
    "sql_masked_window": (
        """
WITH spend AS (SELECT o_custkey, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents FROM orders GROUP BY o_custkey)
SELECT c_custkey, c_name, c_mktsegment, rank() OVER (PARTITION BY c_nationkey ORDER BY cents DESC) AS spend_rank
FROM customer JOIN spend ON o_custkey = c_custkey ORDER BY c_custkey""",
        1000,
        ["c_name"],
        ["c_custkey", "c_mktsegment", "spend_rank"],
    ),
    "sql_masked_documents": (
        """
SELECT doc_id, text, source FROM documents WHERE lang = 'en' ORDER BY doc_id""",
        100,
        ["text"],
        ["doc_id", "source"],
    ),
}

# Scalar functions have engine-specific names, so this one has a text per engine.
SQL_SCALARS_SPARK = """
SELECT event_id, CAST(date_trunc('HOUR', ts) AS TIMESTAMP_NTZ) AS hour, upper(event_type) AS kind, length(event_type) AS kind_length,
  CAST(get_json_object(props, '$.k') AS BIGINT) AS k, abs(user_id - 75) AS distance, user_id % 7 AS bucket,
  coalesce(nullif(event_type, 'error'), 'failed') AS outcome, concat(event_type, '-', CAST(user_id AS STRING)) AS tag
FROM events"""
SQL_SCALARS_DUCKDB = """
SELECT event_id, date_trunc('hour', ts) AS hour, upper(event_type) AS kind, length(event_type) AS kind_length,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, abs(user_id - 75) AS distance, user_id % 7 AS bucket,
  coalesce(nullif(event_type, 'error'), 'failed') AS outcome, event_type || '-' || CAST(user_id AS VARCHAR) AS tag
FROM events"""
