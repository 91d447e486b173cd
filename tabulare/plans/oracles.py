"""The same questions as SQL text, for an independent engine on the same tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {
    "indicator_table": """
        SELECT r_name AS region, n_name AS nation, strftime(o_orderdate, '%Y-%m') AS month,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE)
                   AS revenue,
               count(*) AS lines, count(DISTINCT o_orderkey) AS orders
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
        GROUP BY r_name, n_name, strftime(o_orderdate, '%Y-%m')""",
    "filtered_rows": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag,
               strftime(l_shipdate, '%Y-%m-%d') AS ship_day
        FROM lineitem
        WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'
          AND l_returnflag IN ('A', 'R')""",
    "dataset_page": """
        SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day, o_totalprice
        FROM orders
        WHERE o_orderdate > TIMESTAMP '1998-06-01' OR (o_orderdate = TIMESTAMP '1998-06-01' AND o_orderkey > 700)
        ORDER BY o_orderdate, o_orderkey LIMIT 50""",
    "code_lookup": """
        SELECT c_custkey, c_name, n_name AS nation, r_name AS region
        FROM customer
        LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey""",
    "detail_counts": """
        SELECT o_orderkey, o_orderstatus, count(l_orderkey) AS lines
        FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
        GROUP BY o_orderkey, o_orderstatus""",
    "parents_with_detail": """
        SELECT o_orderkey, o_custkey FROM orders
        WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
    "orphan_report": """
        SELECT o_orderkey, o_custkey FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
    "indicator_rollup": """
        SELECT r_name AS region, n_name AS nation, count(*) AS customers,
               CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance,
               CAST(grouping(r_name) AS BIGINT) AS region_is_total,
               CAST(grouping(n_name) AS BIGINT) AS nation_is_total
        FROM customer
        LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey
        GROUP BY ROLLUP (r_name, n_name)""",
    "distinct_entities": """
        SELECT event_type, count(DISTINCT user_id) AS entities FROM events GROUP BY event_type""",
    "distinct_entities_approx": """
        SELECT event_type, count(DISTINCT user_id) AS entities, true AS within_bound
        FROM events GROUP BY event_type""",
    "crosstab": """
        SELECT user_id,
               count(*) FILTER (WHERE event_type = 'click') AS click,
               count(*) FILTER (WHERE event_type = 'error') AS error,
               count(*) FILTER (WHERE event_type = 'purchase') AS purchase,
               count(*) FILTER (WHERE event_type = 'signup') AS signup,
               count(*) FILTER (WHERE event_type = 'view') AS view,
               count(*) FILTER (WHERE event_type IS NULL
                                OR event_type NOT IN ('click', 'error', 'purchase', 'signup', 'view')) AS other
        FROM events GROUP BY user_id""",
    "median_by_group": """
        WITH ranked AS (
            SELECT event_type, CAST(value AS DECIMAL(18,2)) AS v,
                   row_number() OVER (PARTITION BY event_type ORDER BY value) AS rn,
                   count(*) OVER (PARTITION BY event_type) AS n
            FROM events WHERE value IS NOT NULL)
        SELECT event_type, CAST(sum(v) AS DOUBLE) / count(*) AS median
        FROM ranked WHERE rn IN ((n + 1) // 2, n // 2 + 1)
        GROUP BY event_type""",
    "top_per_group": """
        SELECT o_custkey, o_orderkey, o_totalprice,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS rank
        FROM orders QUALIFY rank <= 3""",
    "period_change": """
        WITH months AS (
            SELECT strftime(o_orderdate, '%Y-%m') AS period, count(*) AS rows FROM orders GROUP BY 1)
        SELECT period, rows, lag(rows) OVER (ORDER BY period) AS previous,
               rows - lag(rows) OVER (ORDER BY period) AS change
        FROM months""",
    "running_total": """
        SELECT event_id, user_id, ts, value,
               CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (
                   PARTITION BY user_id ORDER BY ts, event_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_value
        FROM events""",
    "latest_record": """
        SELECT user_id, event_id, ts, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "time_buckets": """
        SELECT date_trunc('hour', ts) AS bucket_start, event_type, count(*) AS events,
               CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
        FROM events GROUP BY 1, 2""",
    "sessions": """
        WITH marked AS (
            SELECT *, CASE WHEN ts <= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTE
                           THEN 0 ELSE 1 END AS opens
            FROM events),
        numbered AS (
            SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM marked)
        SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS rows,
               CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount
        FROM numbered GROUP BY user_id, session""",
    "interval_match": """
        SELECT e.user_id, e.event_id, e.ts, count(f.event_id) AS matches,
               CAST(coalesce(sum(CAST(f.value AS DECIMAL(18,2))), 0) AS DOUBLE) AS matched_amount
        FROM events e
        LEFT JOIN events f ON f.user_id = e.user_id AND f.ts > e.ts AND f.ts <= e.ts + INTERVAL 1 HOUR
        GROUP BY e.user_id, e.event_id, e.ts""",
    "json_field": """
        SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
    "clean_text": r"""
        SELECT p_partkey, lower(trim(regexp_replace(p_name, '\s+', ' ', 'g'))) AS part_name FROM part""",
    "url_host": """
        SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) AS host FROM pages""",
    "column_profile": " UNION ALL ".join(
        f"""
        SELECT '{name}' AS column_name, count(*) AS rows, count(*) - count({name}) AS nulls,
               count(DISTINCT {name}) AS distinct_values,
               CAST(min({name}) AS VARCHAR) AS least, CAST(max({name}) AS VARCHAR) AS greatest
        FROM events"""
        for name in ("event_id", "ts", "user_id", "event_type", "value", "props")
    ),
    "duplicate_keys": """
        SELECT l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber, count(*) AS rows
        FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "duplicate_text": """
        SELECT p_name, count(*) AS rows, min(p_partkey) AS first_key
        FROM part GROUP BY p_name HAVING count(*) > 1""",
    "snapshot_diff": """
        WITH old AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2001-06-01'),
        new AS (
            SELECT * REPLACE (CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN 'F'
                                   ELSE o_orderstatus END AS o_orderstatus)
            FROM orders WHERE o_orderdate >= TIMESTAMP '1995-07-01'),
        joined AS (
            SELECT coalesce(old.o_orderkey, new.o_orderkey) AS o_orderkey,
                   old.o_orderkey IS NULL AS is_added, new.o_orderkey IS NULL AS is_removed,
                   concat_ws(',',
                       CASE WHEN old.o_orderstatus IS DISTINCT FROM new.o_orderstatus THEN 'o_orderstatus' END,
                       CASE WHEN old.o_totalprice IS DISTINCT FROM new.o_totalprice THEN 'o_totalprice' END,
                       CASE WHEN old.o_orderpriority IS DISTINCT FROM new.o_orderpriority
                            THEN 'o_orderpriority' END) AS diff
            FROM old FULL OUTER JOIN new ON old.o_orderkey = new.o_orderkey)
        SELECT o_orderkey,
               CASE WHEN is_added THEN 'added' WHEN is_removed THEN 'removed' ELSE 'changed' END AS change,
               CASE WHEN is_added OR is_removed THEN '' ELSE diff END AS changed_columns
        FROM joined WHERE is_added OR is_removed OR diff <> ''""",
    "rows_only_in_first": """
        SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'
        EXCEPT
        SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'N'""",
    "rows_in_both": """
        SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R'
        INTERSECT
        SELECT l_partkey FROM lineitem WHERE l_returnflag = 'N'""",
    "stacked_rows": """
        SELECT 'region' AS code_list, CAST(r_regionkey AS BIGINT) AS code, r_name AS label FROM region
        UNION ALL
        SELECT 'nation', CAST(n_nationkey AS BIGINT), n_name FROM nation""",
    "stream_buckets": """
        SELECT date_trunc('hour', ts) AS bucket_start, event_type, count(*) AS events,
               CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value
        FROM events GROUP BY 1, 2
        HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
    "export_partitioned": """
        SELECT event_id, user_id, ts, event_type, value, strftime(ts, '%Y-%m-%d') AS day FROM events""",
}
