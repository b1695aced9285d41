"""DuckDB SQL equivalents of the catalogue queries (the correctness oracle).

Each string runs on views named after the driver tables.  Column names and
types match :mod:`tidepool.plans.catalog`.  Where the Spark plan is built
differently for scale (panes, two-level running scans, unions instead of
as-of joins), the SQL states the plain definition instead.
"""

from __future__ import annotations

CENTS = "CAST(round(value * 100) AS BIGINT)"
ARRIVAL = "ts + to_seconds((event_id * 7919) % 900)"
RUN_ID = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"

_TRACED = f"""
  a AS (SELECT event_id, ts, user_id, {ARRIVAL} AS arrival_ts FROM events),
  t AS (SELECT event_id, ts, user_id, arrival_ts,
               max(ts) OVER (ORDER BY arrival_ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                 - INTERVAL '300001 milliseconds' AS wm
        FROM a)"""

_WIN5 = """
  time_bucket(INTERVAL '5 minutes', ts) AS window_start,
  time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' AS window_end"""

_SLIDING = """
  WITH panes AS (
    SELECT time_bucket(INTERVAL '5 minutes', ts) AS pane, {key}, count(*) AS n
    FROM events GROUP BY ALL),
  fan AS (SELECT pane, {key}, n, unnest(generate_series(0, 11)) AS k FROM panes),
  win AS (
    SELECT pane - to_minutes(CAST(5 * k AS BIGINT)) AS window_start, {key}, CAST(sum(n) AS BIGINT) AS cnt
    FROM fan GROUP BY ALL)"""

_TUMBLE_HOUR = """
  SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start,
         time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
         user_id, count(*) AS cnt
  FROM events GROUP BY ALL"""

_TOKENS = """
  CASE WHEN rtrim(text, ' ') = '' AND text <> '' THEN []::VARCHAR[]
       ELSE string_split(rtrim(text, ' '), ' ') END"""

ORACLES: dict[str, str] = {
    "topn_per_window": _SLIDING.format(key="event_type") + """
  SELECT * FROM (
    SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, event_type AS item, cnt,
           row_number() OVER (PARTITION BY window_start ORDER BY cnt DESC, event_type) AS rank
    FROM win)
  WHERE rank <= 3""",

    "sliding_count": _SLIDING.format(key="user_id") + """
  SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, user_id, cnt FROM win""",

    "tumbling_count": _TUMBLE_HOUR,

    "window_count_fmt": f"""
  SELECT *, concat(user_id, '-----', epoch_ms(window_start), '----', epoch_ms(window_end),
                   '-----', cnt) AS line
  FROM ({_TUMBLE_HOUR})""",

    "manual_bucket_count": """
  SELECT (epoch_us(ts) // 3600000000) * 3600000 AS start_ms,
         (epoch_us(ts) // 3600000000) * 3600000 + 3600000 AS end_ms,
         user_id, count(*) AS cnt
  FROM events GROUP BY ALL""",

    "uv_hourly": """
  SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start,
         time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
         count(DISTINCT user_id) AS uv
  FROM events WHERE event_type = 'view' GROUP BY ALL""",

    "word_count": f"""
  SELECT word, count(*) AS cnt
  FROM (SELECT unnest({_TOKENS}) AS word FROM documents)
  GROUP BY word""",

    "filter_map_pair": f"""
  SELECT event_id, {CENTS} AS a, {CENTS} AS b FROM events WHERE {CENTS} > 500""",

    "replicate_by_rule": """
  SELECT event_id, user_id, event_type, CAST(0 AS INTEGER) AS copy FROM events
  WHERE event_type IN ('click', 'view')
  UNION ALL
  SELECT event_id, user_id, event_type, CAST(1 AS INTEGER) AS copy FROM events
  WHERE event_type = 'view'""",

    "map_with_setup": """
  SELECT l_orderkey, l_linenumber, CAST(l_linenumber AS BIGINT) * l_linenumber AS sq FROM lineitem""",

    "parse_keyed_lines": """
  SELECT event_id, CAST(user_id AS VARCHAR) AS key, (epoch_us(ts) // 1000000) * 1000 AS ts_ms FROM events""",

    "table_project": """
  SELECT user_id, event_type AS url, ts AS c_time FROM events""",

    "csv_behavior_scan": """
  SELECT user_id, event_id AS item_id, event_type AS category_id, event_type AS behavior,
         (epoch_us(ts) // 1000000) * 1000 AS ts_ms,
         make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS event_time
  FROM events""",

    "uv_hourly_approx": """
  SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start,
         time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
         count(DISTINCT user_id) AS uv, TRUE AS near
  FROM events WHERE event_type = 'view' GROUP BY ALL""",

    "partitioned_source": """
  SELECT event_id, ts, user_id, event_type, CAST(event_id % 8 AS INTEGER) AS owner,
         CAST(event_id % 8 AS INTEGER) AS partition FROM events""",

    "shuffle_spread": """
  SELECT CAST(p AS INTEGER) AS partition, TRUE AS even FROM range(8) r(p)""",

    "rebalance_spread": """
  SELECT CAST(p AS INTEGER) AS partition, TRUE AS even FROM range(8) r(p)""",

    "parallelism_spread": """
  SELECT CAST(p AS INTEGER) AS partition, TRUE AS even FROM range(3) r(p)""",

    "quarantine_counts": """
  SELECT format, kind, CAST(count(*) FILTER (WHERE coalesce(user_id % 7 = 0, FALSE) = (kind = 'quarantine')) AS BIGINT) AS n
  FROM events, (VALUES ('keyed'), ('csv')) f(format), (VALUES ('parsed'), ('quarantine')) k(kind)
  GROUP BY format, kind""",

    "redistribute": """
  SELECT event_id, user_id, event_type, TRUE AS together FROM events""",

    "replicate_all": """
  SELECT r_regionkey, r_name, CAST(0 AS INTEGER) AS replica FROM region
  UNION ALL
  SELECT r_regionkey, r_name, CAST(1 AS INTEGER) AS replica FROM region""",

    "sql_group_count": """
  SELECT user_id, COUNT(event_type) AS cnt FROM events GROUP BY user_id""",

    "sql_tumble": """
  SELECT user_id, COUNT(event_type) AS cnt,
         time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS end_t
  FROM events GROUP BY user_id, time_bucket(INTERVAL '1 hour', ts)""",

    "running_count": f"""
  SELECT event_id, user_id,
         count(*) OVER (PARTITION BY user_id ORDER BY event_id {RUN_ID}) AS running_cnt
  FROM events""",

    "running_sum": f"""
  SELECT event_id, user_id,
         first_value(event_type) OVER (PARTITION BY user_id ORDER BY event_id {RUN_ID}) AS event_type,
         CAST(sum({CENTS}) OVER (PARTITION BY user_id ORDER BY event_id {RUN_ID}) AS BIGINT) AS cents
  FROM events""",

    "running_avg_keyed": f"""
  SELECT event_id, user_id,
         CAST(sum({CENTS}) OVER (PARTITION BY user_id ORDER BY event_id {RUN_ID}) AS DOUBLE)
           / CAST(count(*) OVER (PARTITION BY user_id ORDER BY event_id {RUN_ID}) AS DOUBLE) AS avg_cents
  FROM events""",

    "running_avg": f"""
  SELECT event_id,
         CAST(sum({CENTS}) OVER (ORDER BY event_id {RUN_ID}) AS DOUBLE)
           / CAST(count(*) OVER (ORDER BY event_id {RUN_ID}) AS DOUBLE) AS avg_cents
  FROM events""",

    "running_events_per_user": f"""
  WITH f AS (
    SELECT event_id,
           CASE WHEN event_id = min(event_id) OVER (PARTITION BY user_id) THEN 1 ELSE 0 END AS first_seen
    FROM events)
  SELECT event_id,
         CAST(count(*) OVER (ORDER BY event_id {RUN_ID}) AS DOUBLE)
           / CAST(sum(first_seen) OVER (ORDER BY event_id {RUN_ID}) AS DOUBLE) AS events_per_user
  FROM f""",

    "throttled_avg": f"""
  WITH b AS (
    SELECT time_bucket(INTERVAL '10 minutes', ts) AS bucket_start, sum({CENTS}) AS s, count(*) AS n
    FROM events GROUP BY ALL)
  SELECT bucket_start,
         CAST(sum(n) OVER (ORDER BY bucket_start {RUN_ID}) AS BIGINT) AS cum_cnt,
         CAST(sum(s) OVER (ORDER BY bucket_start {RUN_ID}) AS DOUBLE)
           / CAST(sum(n) OVER (ORDER BY bucket_start {RUN_ID}) AS DOUBLE) AS cum_avg
  FROM b""",

    # The chain of timers: the first row, then each first row more than an hour after the one before.
    "throttled_timer_avg": f"""
  WITH RECURSIVE t AS (
    SELECT epoch_us(ts) // 1000 AS ms, sum({CENTS}) AS s, count(*) AS n FROM events WHERE ts IS NOT NULL GROUP BY ALL),
  chain(set_ms) AS (
    SELECT min(ms) FROM t HAVING count(*) > 0
    UNION ALL
    SELECT min(t.ms) FROM chain JOIN t ON t.ms > chain.set_ms + 3600000 HAVING count(*) > 0)
  SELECT make_timestamp((set_ms + 3600000) * 1000) AS fired_at, CAST(sum(n) AS BIGINT) AS cum_cnt,
         CAST(coalesce(sum(s), 0) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS cum_avg
  FROM chain JOIN t ON t.ms <= chain.set_ms + 3600000 GROUP BY set_ms""",

    "timestamp_text": """
  SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') || '.' || CASE
           WHEN strftime(ts, '%g') = '000' THEN '0' ELSE rtrim(strftime(ts, '%g'), '0') END AS ts_text
  FROM events""",

    "changelog_count": f"""
  WITH r AS (
    SELECT event_id, user_id,
           count(*) OVER (PARTITION BY user_id ORDER BY event_id {RUN_ID}) AS c
    FROM events)
  SELECT event_id, user_id, '+I' AS op, c AS cnt, CAST(0 AS INTEGER) AS op_seq FROM r WHERE c = 1
  UNION ALL
  SELECT event_id, user_id, '-U' AS op, c - 1 AS cnt, CAST(0 AS INTEGER) AS op_seq FROM r WHERE c > 1
  UNION ALL
  SELECT event_id, user_id, '+U' AS op, c AS cnt, CAST(1 AS INTEGER) AS op_seq FROM r WHERE c > 1""",

    "watermark_trace": f"""
  WITH {_TRACED}
  SELECT event_id, ts, arrival_ts, wm FROM t""",

    "late_split": f"""
  WITH {_TRACED}
  SELECT event_id, ts, wm,
         CASE WHEN wm IS NOT NULL AND ts < wm THEN 'late' ELSE 'ok' END AS status
  FROM t""",

    "late_window_side": f"""
  WITH {_TRACED},
  w AS (SELECT *, {_WIN5} FROM t)
  SELECT event_id, user_id, window_start, window_end,
         CASE WHEN wm IS NOT NULL AND wm >= window_end - INTERVAL '1 millisecond'
              THEN 'late' ELSE 'on_time' END AS status
  FROM w""",

    "late_refire": f"""
  WITH {_TRACED},
  w AS (SELECT *, {_WIN5} FROM t),
  c AS (
    SELECT *,
      CASE WHEN wm IS NOT NULL AND wm >= window_end + INTERVAL '299999 milliseconds' THEN 'late'
           WHEN wm IS NOT NULL AND wm >= window_end - INTERVAL '1 millisecond' THEN 'refire'
           ELSE 'on_time' END AS status
    FROM w),
  ot AS (
    SELECT user_id, window_start, window_end, count(*) AS n_on_time
    FROM c WHERE status = 'on_time' GROUP BY ALL),
  lr AS (
    SELECT user_id, window_start, window_end,
           row_number() OVER (PARTITION BY user_id, window_start ORDER BY arrival_ts, event_id) AS late_rank
    FROM c WHERE status = 'refire')
  SELECT user_id, window_start, window_end, CAST(1 AS BIGINT) AS firing, 'first' AS kind,
         n_on_time AS cnt
  FROM ot
  UNION ALL
  SELECT lr.user_id, lr.window_start, lr.window_end,
         CAST((CASE WHEN coalesce(ot.n_on_time, 0) > 0 THEN 1 ELSE 0 END) + late_rank AS BIGINT) AS firing,
         CASE WHEN coalesce(ot.n_on_time, 0) = 0 AND late_rank = 1 THEN 'first' ELSE 'refire' END AS kind,
         CAST(coalesce(ot.n_on_time, 0) + late_rank AS BIGINT) AS cnt
  FROM lr LEFT JOIN ot USING (user_id, window_start, window_end)""",

    "event_timers": """
  SELECT user_id, ts + INTERVAL '5 seconds' AS timer_ts, count(*) AS registrations,
         ts + INTERVAL '5 seconds'
           <= (SELECT max(ts) FROM events) - INTERVAL '5001 milliseconds' AS fired
  FROM events GROUP BY user_id, ts""",

    "interval_join": """
  SELECT o_orderkey, o_orderdate, l_linenumber, l_partkey, l_shipdate
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey
   AND l_shipdate >= o_orderdate - INTERVAL '10 days'
   AND l_shipdate <= o_orderdate + INTERVAL '5 days'""",

    "interval_join_mirror": """
  SELECT o_orderkey, o_orderdate, l_linenumber, l_partkey, l_shipdate
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
   AND o_orderdate >= l_shipdate - INTERVAL '5 days'
   AND o_orderdate <= l_shipdate + INTERVAL '10 days'""",

    "window_join": """
  WITH l AS (
    SELECT user_id, time_bucket(INTERVAL '1 day', ts) AS window_start, count(*) AS n_left
    FROM events WHERE event_type = 'click' GROUP BY ALL),
  r AS (
    SELECT user_id, time_bucket(INTERVAL '1 day', ts) AS window_start, count(*) AS n_right
    FROM events WHERE event_type = 'view' GROUP BY ALL)
  SELECT user_id, window_start, window_start + INTERVAL '1 day' AS window_end,
         n_left, n_right, n_left * n_right AS n_pairs
  FROM l JOIN r USING (user_id, window_start)""",

    "stream_equi_join": """
  SELECT o_orderkey, o_custkey, c_name, o_totalprice
  FROM orders JOIN customer ON o_custkey = c_custkey""",

    "control_filter": """
  WITH d AS (
    SELECT event_id, ts, user_id, event_type FROM events WHERE event_type IN ('click', 'view')),
  c AS (
    SELECT ts AS c_ts, CASE event_type WHEN 'signup' THEN 'click' ELSE 'view' END AS control_value
    FROM events WHERE event_type IN ('signup', 'error'))
  SELECT d.event_id, d.ts, d.user_id, d.event_type
  FROM d ASOF LEFT JOIN c ON d.ts >= c.c_ts
  WHERE d.event_type = c.control_value""",

    "reconcile": """
  WITH p AS (SELECT l_orderkey AS k, min(l_shipdate) AS pay_ts FROM lineitem GROUP BY l_orderkey),
  o AS (SELECT o_orderkey AS k, o_orderdate AS order_ts FROM orders),
  j AS (SELECT coalesce(o.k, p.k) AS o_orderkey, order_ts, pay_ts FROM o FULL JOIN p ON o.k = p.k)
  SELECT o_orderkey, order_ts, pay_ts,
         CASE WHEN pay_ts IS NULL THEN 'no_payment'
              WHEN order_ts IS NULL THEN 'no_order'
              WHEN abs(epoch_us(pay_ts) - epoch_us(order_ts)) <= 90 * 86400000000 THEN 'matched'
              ELSE 'timed_out' END AS status
  FROM j""",
}
