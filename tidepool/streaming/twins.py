"""Streaming twins: the same operators as Structured Streaming queries.

Each twin reads a table as a file stream, runs to completion with
``availableNow`` and returns what its sink wrote, so it is checked against the
same oracle as its batch form.  Event-time twins read their table over several
micro-batches in event order; an end-of-input marker is delivered after the last one, so
that every window closes (a bounded source ends with a maximal watermark).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions.timecols import micros
from tidepool.operators import rows, topn
from tidepool.plans import catalog
from tidepool.plans.oracles import ORACLES
from tidepool.session import scratch_path
from tidepool.sources import behavior
from tidepool.operators import eventtime
from tidepool.schemas import ALARM_OUT, LATE_OUT
from tidepool.streaming.processors import ArrivalAlarm, KeyedLateSplit
from tidepool.streaming.runner import (END_COL, SENTINEL_TS, OrderedInput, event_time, read_epochs, run_live, run_to_table,
                                      table_stream, with_end_marker, write_epoch)
from tidepool.streaming.stepwise import STEP_QUERIES, stream_changelog_count, stream_reconcile  # noqa: F401

HOUR = micros(1, "h")


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


#: Micro-batches, at least, in which a registered event-time twin reads its table.
N_BATCHES = 4


def _events_with_marker(spark, sf, events: DataFrame | None = None):
    """The events stream, event time as TIMESTAMP, and its end-of-input marker.

    The table is read in event-time order over several micro-batches; ``events`` replaces that stream."""
    if events is None:
        events = OrderedInput(spark, catalog.read_table(spark, sf, "events"), "ts", N_BATCHES)
    stream, end = with_end_marker(spark, events, "ts")
    return event_time(stream), end


def stream_word_count(spark: SparkSession, sf: str, docs: DataFrame | None = None) -> DataFrame:
    """Word count over a document stream: changed counts are merged by word into the buckets they are in."""
    docs = docs if docs is not None else table_stream(spark, sf, "documents")
    return run_to_table(spark, rows.word_count(docs, "text"), "word-count", output_mode="update", key=["word"])


def stream_tumbling_count(spark: SparkSession, sf: str, events: DataFrame | None = None) -> DataFrame:
    """Event-time tumbling count, append mode: each window is emitted once, when it closes."""
    ev, end = _events_with_marker(spark, sf, events)
    ev = ev.withWatermark("ts", "0 seconds")
    counts = (ev.groupBy(F.window("ts", "1 hour").alias("w"), "user_id", END_COL)
              .agg(F.count(F.lit(1)).alias("cnt"))
              .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "user_id", "cnt", END_COL))
    return _ntz(run_to_table(spark, counts, "tumbling-count", end=end), "window_start", "window_end")


def stream_sql_tumble(spark: SparkSession, sf: str, events: DataFrame | None = None) -> DataFrame:
    """SQL tumbling window over a streaming view with a watermark; each window is emitted once."""
    ev, end = _events_with_marker(spark, sf, events)
    q = catalog.on_view(ev.withWatermark("ts", "0 seconds"), """
        SELECT user_id, COUNT(event_type) AS cnt, window.end AS end_t, is_end
        FROM {view} GROUP BY user_id, is_end, window(ts, '1 hour')""")
    return _ntz(run_to_table(spark, q, "sql-tumble", end=end), "end_t")


def stream_topn_per_window(spark: SparkSession, sf: str, events: DataFrame | None = None) -> DataFrame:
    """Pane counts, sliding windows over the panes (both append mode), top-N per window in each micro-batch.

    Rows are counted per 5-minute pane first; only pane counts are expanded to the 12 windows
    they are in.  A window's counts are all emitted in the micro-batch in which it closes,
    so ranking inside that batch is exact and no state holds a window's items.
    """
    ev, end = _events_with_marker(spark, sf, events)
    ev = ev.withWatermark("ts", "0 seconds")
    panes = ev.groupBy(F.window("ts", "5 minutes").alias("pane"), "event_type", END_COL).agg(F.count(F.lit(1)).alias("n"))
    counts = (panes.groupBy(F.window("pane", "1 hour", "5 minutes").alias("w"), "event_type", END_COL)
              .agg(F.sum("n").alias("cnt"))
              .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "event_type", "cnt", END_COL))

    def rank(batch: DataFrame) -> DataFrame:
        top = topn.top_n(batch, ["window_start", "window_end"],
                         [F.desc("cnt"), F.asc_nulls_last("event_type")], catalog.TOP_N)
        return top.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                          F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                          F.col("event_type").alias("item"), "cnt",
                          F.col("rank").cast("bigint").alias("rank"))

    return run_to_table(spark, counts, "topn", per_batch=rank, end=end)


def stream_uv_hourly(spark: SparkSession, sf: str, events: DataFrame | None = None) -> DataFrame:
    """Exact hourly distinct viewers: distinct (window, user) in append mode, counted per batch."""
    ev, end = _events_with_marker(spark, sf, events)
    ev = ev.withWatermark("ts", "0 seconds")
    views = ev.filter((F.col("event_type") == "view") | F.col(END_COL))
    pairs = (views.groupBy(F.window("ts", "1 hour").alias("w"), "user_id", END_COL).agg(F.count(F.lit(1)).alias("_n"))
             .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "user_id", END_COL))

    def count(batch: DataFrame) -> DataFrame:
        return (batch.groupBy("window_start", "window_end").agg(F.count("user_id").alias("uv"))
                .select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                        F.col("window_end").cast("timestamp_ntz").alias("window_end"), "uv"))

    return run_to_table(spark, pairs, "uv-hourly", per_batch=count, end=end)


def stream_window_join(spark: SparkSession, sf: str, events: DataFrame | None = None) -> DataFrame:
    """Window join of clicks and views per user and day, factorised, on a stream.

    Both sides are counted per (user, day) in one append-mode aggregation; a
    window's counts for both sides close in the same micro-batch, so the join
    of the two count sets runs inside that batch and holds no join state.
    """
    ev, end = _events_with_marker(spark, sf, events)
    ev = ev.withWatermark("ts", "0 seconds")
    sides = ev.filter(F.col("event_type").isin("click", "view") | F.col(END_COL))
    counts = (sides.groupBy("user_id", F.window("ts", "1 day").alias("w"), "event_type", END_COL)
              .agg(F.count(F.lit(1)).alias("n"))
              .select("user_id", F.col("w.start").alias("window_start"),
                      F.col("w.end").alias("window_end"), "event_type", "n", END_COL))

    def join_sides(batch: DataFrame) -> DataFrame:
        keys = ["user_id", "window_start", "window_end"]
        left = batch.filter(F.col("event_type") == "click").select(*keys, F.col("n").alias("n_left"))
        right = batch.filter(F.col("event_type") == "view").select(*keys, F.col("n").alias("n_right"))
        joined = left.join(right, keys, "inner").withColumn("n_pairs", F.col("n_left") * F.col("n_right"))
        return _ntz(joined, "window_start", "window_end")

    return run_to_table(spark, counts, "window-join", per_batch=join_sides, end=end)


def stream_equi_join(spark: SparkSession, sf: str) -> DataFrame:
    """Order stream enriched from the customer table (stream-static join, no join state)."""
    orders = table_stream(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    cust = catalog.read_table(spark, sf, "customer").select("c_custkey", "c_name")
    joined = orders.join(cust, orders.o_custkey == cust.c_custkey, "inner").select(
        "o_orderkey", "o_custkey", "c_name", "o_totalprice")
    return run_to_table(spark, joined, "equi-join")


def stream_equi_join_streams(spark: SparkSession, sf: str) -> DataFrame:
    """Two streams joined on a key with no time bound: each side's rows stay in
    join state for the life of the query (as in the reference's two-list-state
    co-process).  Prefer the stream-static form when one side is a table."""
    orders = table_stream(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    cust = table_stream(spark, sf, "customer").select("c_custkey", "c_name")
    joined = orders.join(cust, orders.o_custkey == cust.c_custkey, "inner").select(
        "o_orderkey", "o_custkey", "c_name", "o_totalprice")
    return run_to_table(spark, joined, "equi-join-streams")


def stream_interval_join(spark: SparkSession, sf: str, out_of_order: str = "1 day") -> DataFrame:
    """Stream-stream interval join; watermarks on both sides bound the join state.

    Both tables are replayed in event-time order over several micro-batches.  Spark takes the lesser of the two
    watermarks, so a row is late only if it comes ``out_of_order`` after both sides have passed its time.
    """
    both = []

    def side(table: str, ts: str, *cols: str) -> DataFrame:
        df = catalog.read_table(spark, sf, table).select(*cols, ts)
        both.append(OrderedInput(spark, df, ts, N_BATCHES))
        return event_time(both[-1].stream(), ts).withWatermark(ts, out_of_order)

    o = side("orders", "o_orderdate", "o_orderkey")
    li = side("lineitem", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")
    cond = ((o.o_orderkey == li.l_orderkey)
            & (li.l_shipdate >= o.o_orderdate - F.expr("INTERVAL 10 DAYS"))
            & (li.l_shipdate <= o.o_orderdate + F.expr("INTERVAL 5 DAYS")))
    joined = o.join(li, cond, "inner").select(*catalog.INTERVAL_COLS)
    return _ntz(run_to_table(spark, joined, "interval-join", inputs=tuple(both)), "o_orderdate", "l_shipdate")


def stream_table_project(spark: SparkSession, sf: str) -> DataFrame:
    """Stream to table with renamed columns, appended as it arrives."""
    ev = table_stream(spark, sf, "events")
    return run_to_table(spark, rows.rename(ev, {"user_id": "user_id", "event_type": "url", "ts": "c_time"}),
                        "table-project")


def stream_sql_group_count(spark: SparkSession, sf: str, events: DataFrame | None = None) -> DataFrame:
    """SQL over a streaming temp view; changed counts are merged by user into the result table."""
    src = events if events is not None else table_stream(spark, sf, "events")
    q = catalog.on_view(src, "SELECT user_id, COUNT(event_type) AS cnt FROM {view} GROUP BY user_id")
    return run_to_table(spark, q, "sql-group-count", output_mode="update", key=["user_id"])


def stream_csv_behavior_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The behaviour log read as a CSV file stream."""
    path = behavior.write_behavior_csv(catalog.read_table(spark, sf, "events"),
                                       scratch_path(spark, "behavior-csv"))
    return run_to_table(spark, behavior.stream_behavior_csv(spark, path), "behavior-csv")


def stream_event_timers(spark: SparkSession, sf: str, events: DataFrame | None = None) -> DataFrame:
    """Event-time timers per user at ``ts + 5 s``; each fires once the watermark passes it.

    A timer is a group (user, millisecond) in append mode, which is emitted once when the
    watermark has passed it; the watermark's delay is the timer's.
    """
    ev, end = _events_with_marker(spark, sf, events)
    ev = ev.withWatermark("ts", "5 seconds")
    fired = (ev.groupBy(F.window("ts", "1 millisecond").alias("w"), "user_id", END_COL).agg(F.count(F.lit(1)).alias("_n"))
             .select("user_id", F.col("w.start").alias("at"), END_COL))
    out = run_to_table(spark, fired, "event-timers", end=end)
    return out.select("user_id", (F.col("at").cast("timestamp_ntz") + F.expr("INTERVAL 5 SECONDS")).alias("timer_ts"))


def stream_late_split_keyed(spark: SparkSession, sf: str, events: DataFrame | None = None) -> DataFrame:
    """Late rows of a replayed stream, routed to a side table in the same batch.

    Each micro-batch is persisted once and written to two sinks: the on-time
    rows and the late rows (the reference's main and side outputs).
    """
    src = events if events is not None else table_stream(spark, sf, "events")
    ev = eventtime.jittered_arrival(src.select("event_id", "ts", "user_id"))
    tagged = ev.groupBy("user_id").transformWithStateInPandas(
        statefulProcessor=KeyedLateSplit(), outputStructType=LATE_OUT,
        outputMode="Append", timeMode="None")
    main_out, side_out = scratch_path(spark, "late-main"), scratch_path(spark, "late-side")

    def two_sinks(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        write_epoch(batch.filter(F.col("status") == "ok"), main_out, epoch)
        write_epoch(batch.filter(F.col("status") == "late"), side_out, epoch)
        batch.unpersist()

    run_to_table(spark, tagged, "late-split", per_batch_sink=two_sinks, rocksdb=True)
    both = read_epochs(spark, main_out, LATE_OUT).unionByName(read_epochs(spark, side_out, LATE_OUT))
    return _ntz(both, "ts", "wm")


def stream_parse_keyed_lines(spark: SparkSession, sf: str) -> DataFrame:
    """``"key seconds"`` text lines read as a line stream and parsed."""
    from tidepool.functions.timecols import epoch_seconds

    lines_dir = scratch_path(spark, "keyed-lines")
    ev = catalog.read_table(spark, sf, "events")
    rows.keyed_lines(ev, F.col("user_id"), epoch_seconds("ts")).write.text(lines_dir)
    stream = spark.readStream.schema("value string").text(lines_dir)
    parsed, _quarantine = rows.parse_keyed_lines(stream)
    return run_to_table(spark, parsed, "keyed-lines")


def stream_throttled_avg(spark: SparkSession, sf: str, events: DataFrame | None = None) -> DataFrame:
    """Cumulative mean of click cents, emitted once per trigger, not once per row.

    A global streaming aggregate in update mode: partial sums per task, one
    row of state, and the trigger interval of a live stream is the throttle.  Run to
    completion here, the single batch emits the overall mean.  (``stream_throttled_timer_avg`` has timers.)
    """
    src = events if events is not None else table_stream(spark, sf, "events")
    acc = catalog.clicks(src).agg(F.count(F.lit(1)).alias("cum_cnt"), F.sum("cents").alias("cum_s"))

    def mean(batch: DataFrame) -> DataFrame:
        return batch.select("cum_cnt", (F.col("cum_s") / F.col("cum_cnt")).alias("cum_avg"))

    return run_to_table(spark, acc, "throttled-avg", output_mode="update", per_batch=mean)


def reconcile_sides(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Orders and line items as one (key, side, ts) event stream or table."""
    def side(df, key, ts, name):
        return df.select(F.col(key).alias("key"), F.lit(name).alias("side"), F.col(ts).alias("ts"))

    return side(orders, "o_orderkey", "o_orderdate", "order").unionByName(
        side(lineitem, "l_orderkey", "l_shipdate", "pay"))


def stream_proc_time_count(spark: SparkSession, sf: str) -> DataFrame:
    """Processing-time tumbling count: rows are stamped at ingest, counted per 5 s and user."""
    ev = table_stream(spark, sf, "events").withColumn("ingest_ts", F.current_timestamp())
    counts = (ev.withWatermark("ingest_ts", "0 seconds")
              .groupBy(F.window("ingest_ts", "5 seconds").alias("w"), "user_id")
              .agg(F.count(F.lit(1)).alias("cnt"))
              .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "user_id", "cnt"))
    return run_to_table(spark, counts, "proc-time-count", output_mode="update", key=["window_start", "window_end", "user_id"])


def final_ingest_windows(spark: SparkSession, rows: DataFrame | OrderedInput, keys: list[str], size: str = "5 seconds") -> DataFrame:
    """(window_start, window_end, keys, cnt): processing-time tumbling counts, each window given out once, when it is over.

    Rows are stamped when their micro-batch starts. The watermark follows the stamps, so a window closes with the first micro-batch after its end;
    the end of the input is stamped far in the future and closes the last one, as idle time does on a live stream.
    """
    stream, end = with_end_marker(spark, rows, "ts")
    stamp = F.when(F.col(END_COL), F.lit(SENTINEL_TS).cast("timestamp")).otherwise(F.current_timestamp())
    counts = (stream.withColumn("ingest_ts", stamp).withWatermark("ingest_ts", "0 seconds")
              .groupBy(F.window("ingest_ts", size).alias("w"), *keys, END_COL).agg(F.count(F.lit(1)).alias("cnt"))
              .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "cnt", END_COL))
    return run_to_table(spark, counts, "ingest-windows", end=end)


def stream_ingest_windows(spark: SparkSession, sf: str, events: DataFrame | None = None) -> DataFrame:
    """What final processing-time windows say whatever the clock: a user's windows add up to their rows, none came twice, all are whole 5 s."""
    if events is None:
        events = OrderedInput(spark, catalog.read_table(spark, sf, "events").select("event_id", "ts", "user_id"), "event_id", N_BATCHES)
    windows = final_ingest_windows(spark, events, ["user_id"])
    start, end = F.unix_micros("window_start"), F.unix_micros("window_end")
    return windows.groupBy("user_id").agg(
        F.sum("cnt").alias("cnt"), (F.count(F.lit(1)) == F.countDistinct("window_start")).alias("each_once"),
        F.bool_and((end - start == 5_000_000) & (start % 5_000_000 == 0)).alias("aligned"))


#: Processing time between an arrival and its alarm in the registered query.
ALARM_DELAY_MS = 2_000


def arrival_alarms(spark: SparkSession, keyed: DataFrame, delay_ms: int) -> DataFrame:
    """(key, kind, at_ms) of a stream with a column ``key``: every arrival, and an alarm ``delay_ms`` of processing time after it."""
    out = keyed.groupBy("key").transformWithState(statefulProcessor=ArrivalAlarm(delay_ms), outputStructType=ALARM_OUT,
                                                  outputMode="Append", timeMode="ProcessingTime")

    def last_due(rows: DataFrame) -> int | None:
        last = rows.filter("kind = 'arrival'").agg(F.max("at_ms")).first()[0]
        return None if last is None else last + delay_ms

    return run_live(spark, out, "arrival-alarms", last_due)


def stream_arrival_alarms(spark: SparkSession, sf: str, events: DataFrame | None = None, delay_ms: int = ALARM_DELAY_MS) -> DataFrame:
    """Per user: arrivals, and whether every instant with an arrival had one alarm, ``delay_ms`` later, and no alarm came otherwise."""
    events = events if events is not None else table_stream(spark, sf, "events")
    rows = arrival_alarms(spark, events.select(F.col("user_id").alias("key")), delay_ms)
    alarm = F.col("kind") == "alarm"
    instants = rows.groupBy("key", F.when(alarm, F.col("at_ms") - delay_ms).otherwise(F.col("at_ms")).alias("at_ms")).agg(
        F.count(F.when(~alarm, 1)).alias("arrivals"), F.count(F.when(alarm, 1)).alias("alarms"))
    return instants.groupBy(F.col("key").alias("user_id")).agg(
        F.sum("arrivals").alias("arrivals"), F.bool_and((F.col("arrivals") > 0) & (F.col("alarms") == 1)).alias("all_alarmed"))


def stream_quarantine_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Both text formats read as line streams; parsed and broken lines of a micro-batch go to a table each, and are counted."""
    parts = []
    lines = catalog.broken_lines(catalog.read_table(spark, sf, "events"))
    for fmt, split in (("keyed", rows.parse_keyed_lines), ("csv", behavior.split_behavior_lines)):
        folder = scratch_path(spark, f"{fmt}-lines")
        lines.select(F.col(fmt).alias("value")).write.text(folder)
        good, bad = split_to_sinks(spark, behavior.stream_behavior_lines(spark, folder), split, fmt)
        parts.append(catalog.count_kinds(fmt, good, bad))
    return parts[0].unionByName(parts[1])


def split_to_sinks(spark: SparkSession, lines: DataFrame, split, name: str) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine) of a stream of lines: ``split`` divides each micro-batch, which is read once and written to two sinks."""
    good_out, bad_out = scratch_path(spark, f"{name}-parsed"), scratch_path(spark, f"{name}-quarantine")
    good, bad = split(spark.createDataFrame([], lines.schema))

    def sinks(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        for part, out in zip(split(batch), (good_out, bad_out)):
            write_epoch(part, out, epoch)
        batch.unpersist()

    run_to_table(spark, lines, name, per_batch_sink=sinks)
    return read_epochs(spark, good_out, good.schema), read_epochs(spark, bad_out, bad.schema)


STREAM_QUERIES = {
    "stream_word_count": stream_word_count,
    "stream_tumbling_count": stream_tumbling_count,
    "stream_sql_tumble": stream_sql_tumble,
    "stream_topn_per_window": stream_topn_per_window,
    "stream_uv_hourly": stream_uv_hourly,
    "stream_window_join": stream_window_join,
    "stream_equi_join_static": stream_equi_join,
    "stream_equi_join_streams": stream_equi_join_streams,
    "stream_interval_join": stream_interval_join,
    "stream_table_project": stream_table_project,
    "stream_sql_group_count": stream_sql_group_count,
    "stream_csv_behavior_scan": stream_csv_behavior_scan,
    "stream_event_timers": stream_event_timers,
    "stream_late_split_keyed": stream_late_split_keyed,
    "stream_parse_keyed_lines": stream_parse_keyed_lines,
    "stream_proc_time_count": stream_proc_time_count,
    "stream_ingest_windows": stream_ingest_windows,
    "stream_arrival_alarms": stream_arrival_alarms,
    "stream_throttled_avg": stream_throttled_avg,
    "stream_quarantine_counts": stream_quarantine_counts,
    **STEP_QUERIES,
}

# A twin computes exactly what its batch form computes.
STREAM_ORACLES = {
    "stream_word_count": ORACLES["word_count"],
    "stream_tumbling_count": ORACLES["tumbling_count"],
    "stream_sql_tumble": ORACLES["sql_tumble"],
    "stream_topn_per_window": ORACLES["topn_per_window"],
    "stream_uv_hourly": ORACLES["uv_hourly"],
    "stream_window_join": ORACLES["window_join"],
    "stream_equi_join_static": ORACLES["stream_equi_join"],
    "stream_equi_join_streams": ORACLES["stream_equi_join"],
    "stream_interval_join": ORACLES["interval_join"],
    "stream_changelog_count": ORACLES["changelog_count"],
    "stream_table_project": ORACLES["table_project"],
    "stream_sql_group_count": ORACLES["sql_group_count"],
    "stream_quarantine_counts": ORACLES["quarantine_counts"],
    "stream_running_count": ORACLES["running_count"],
    "stream_running_sum": ORACLES["running_sum"],
    "stream_running_avg_keyed": ORACLES["running_avg_keyed"],
    "stream_running_avg": ORACLES["running_avg"],
    # What holds whatever the wall clock says.
    "stream_ingest_windows": "SELECT user_id, count(*) AS cnt, true AS each_once, true AS aligned FROM events GROUP BY user_id",
    "stream_arrival_alarms": "SELECT user_id, count(*) AS arrivals, true AS all_alarmed FROM events GROUP BY user_id",
    "stream_throttled_timer_avg": ORACLES["throttled_timer_avg"],
    "stream_late_split": ORACLES["late_split"],
    "stream_late_window_side": ORACLES["late_window_side"],
    "stream_late_refire": ORACLES["late_refire"],
    "stream_control_filter": ORACLES["control_filter"],
    "stream_csv_behavior_scan": ORACLES["csv_behavior_scan"],
    # Timers have millisecond resolution.
    "stream_event_timers": """
  SELECT DISTINCT user_id, make_timestamp((epoch_us(ts) // 1000) * 1000 + 5000000) AS timer_ts
  FROM events""",
    # Per-key watermark: the max event time of the same user's earlier arrivals.
    "stream_late_split_keyed": """
  WITH a AS (SELECT event_id, ts, user_id, ts + to_seconds((event_id * 7919) % 900) AS arrival_ts
             FROM events),
  t AS (SELECT event_id, ts,
               max(ts) OVER (PARTITION BY user_id ORDER BY arrival_ts, event_id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                 - INTERVAL '300001 milliseconds' AS wm
        FROM a)
  SELECT event_id, ts, wm, CASE WHEN wm IS NOT NULL AND ts < wm THEN 'late' ELSE 'ok' END AS status
  FROM t""",
    "stream_parse_keyed_lines": """
  SELECT CAST(user_id AS VARCHAR) AS key, (epoch_us(ts) // 1000000) * 1000 AS ts_ms FROM events""",
    # Event-time matching of each order with its first payment (earliest ship date).
    "stream_reconcile": """
  WITH p AS (SELECT l_orderkey AS k, min(l_shipdate) AS pay_ts FROM lineitem GROUP BY l_orderkey),
  o AS (SELECT o_orderkey AS k, o_orderdate AS order_ts FROM orders),
  j AS (SELECT coalesce(o.k, p.k) AS k, order_ts, pay_ts,
               abs(epoch_ms(pay_ts) - epoch_ms(order_ts)) <= CAST(90 AS BIGINT) * 86400000 AS in_time
        FROM o FULL JOIN p ON o.k = p.k)
  SELECT k AS o_orderkey, 'matched' AS status, order_ts AS at_ts FROM j WHERE in_time
  UNION ALL
  SELECT k, 'order_timeout', order_ts FROM j WHERE order_ts IS NOT NULL AND in_time IS NOT TRUE
  UNION ALL
  SELECT k, 'payment_timeout', pay_ts FROM j WHERE pay_ts IS NOT NULL AND in_time IS NOT TRUE""",
    # One micro-batch when run to completion: the overall mean.
    "stream_throttled_avg": """
  SELECT count(*) AS cum_cnt,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / count(*) AS cum_avg
  FROM events""",
}
