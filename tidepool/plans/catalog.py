"""The query catalogue: one function per operator of the inventory.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver tables.  Column names and types match the DuckDB oracle SQL in
:mod:`tidepool.plans.oracles` one for one.

Event mapping used throughout: user = ``user_id``, url = ``event_type``,
click value = integer cents, row order ("arrival") = ``event_id``.  Window
sizes are widened from seconds to minutes/hours because the events cover 30
days; every size is a parameter of the operator.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions.timecols import bucket_index, epoch_millis, epoch_seconds, micros, millis_text
from tidepool.operators import changelog, eventtime, joins, partition, rows, running as run, throttle, topn, windows
from tidepool.operators.running import RANGE_BUCKET_COL, Running, id_bucket
from tidepool.session import materialize, scratch_path
from tidepool.sources import behavior
from tidepool.sources.tables import clicks, read_table

MIN = micros(1, "min")
HOUR = micros(1, "h")
DAY = micros(1, "d")

# Fixed parameters of the catalogue queries.
TOP_N = 3
OUT_OF_ORDER = 5 * MIN          # bounded out-of-orderness of the replayed stream
LATE_WINDOW = 5 * MIN           # tumbling window of the late-data queries
ALLOWED_LATENESS = 5 * MIN
TIMER_DELAY = micros(5, "s")
TIMER_OUT_OF_ORDER = micros(5, "s")
THROTTLE_BUCKET = 10 * MIN
THROTTLE_DELAY_MS = 3_600_000    # between a row and the throttled mean it sets a timer for
MATCH_WITHIN = 90 * DAY
CLICK_THRESHOLD_CENTS = 500
MOST_LINES = 7                  # line numbers of an order go up to 7
REPLICATE_RULE = {"click": 1, "view": 2}
CONTROL_VALUE = {"signup": "click", "error": "view"}

# Ids per bucket of the running aggregates here: small, so that also small tables carry over buckets.
RUN_WIDTH = 4_096

Query = Callable[[SparkSession, str], DataFrame]


def _events(spark, sf):
    return read_table(spark, sf, "events")


def _clicks(spark, sf):
    return clicks(_events(spark, sf))


def _arrivals(spark, sf):
    return eventtime.jittered_arrival(_events(spark, sf))


# --- windows, top-N, distinct visitors -------------------------------------------------

def topn_per_window(spark, sf):
    counts = windows.sliding_count(_events(spark, sf), "ts", HOUR, 5 * MIN, ["event_type"])
    top = topn.top_n(counts, ["window_start", "window_end"],
                     [F.desc("cnt"), F.asc_nulls_last("event_type")], TOP_N)
    return top.select("window_start", "window_end", F.col("event_type").alias("item"), "cnt",
                      F.col("rank").cast("bigint").alias("rank"))


def sliding_count(spark, sf):
    return windows.sliding_count(_events(spark, sf), "ts", HOUR, 5 * MIN, ["user_id"])


def tumbling_count(spark, sf):
    return windows.tumbling_count(_events(spark, sf), "ts", HOUR, ["user_id"])


def window_count_fmt(spark, sf):
    return windows.format_window_count(tumbling_count(spark, sf), "user_id")


def manual_bucket_count(spark, sf):
    return windows.manual_bucket_count(_events(spark, sf), "ts", HOUR // 1000, ["user_id"])


def uv_hourly(spark, sf):
    views = _events(spark, sf).filter(F.col("event_type") == "view")
    return windows.distinct_visitors(views, "ts", HOUR, "user_id")


def uv_hourly_approx(spark, sf):
    """Per window: is the estimate within 5% (or one visitor) of the exact count?"""
    views = _events(spark, sf).filter(F.col("event_type") == "view")
    near = windows.distinct_visitors_approx(views, "ts", HOUR, "user_id").withColumnRenamed("uv", "estimate")
    both = windows.distinct_visitors(views, "ts", HOUR, "user_id").join(near, ["window_start", "window_end"])
    off = F.abs(F.col("estimate") - F.col("uv"))
    return both.select("window_start", "window_end", "uv", (off <= F.greatest(F.lit(1.0), 0.05 * F.col("uv"))).alias("near"))


# --- rows -------------------------------------------------------------------------------

def word_count(spark, sf):
    return rows.word_count(read_table(spark, sf, "documents"), "text")


def filter_map_pair(spark, sf):
    # cents > t implies value > t / 100: a predicate on the raw column that the
    # parquet scan can use (row-group min/max), ahead of the exact filter.
    ev = _events(spark, sf).filter(F.col("value") > CLICK_THRESHOLD_CENTS / 100)
    return rows.filter_map_pair(clicks(ev), "cents", CLICK_THRESHOLD_CENTS, ["event_id"])


def replicate_by_rule(spark, sf):
    return rows.replicate_by_rule(_events(spark, sf), "event_type", REPLICATE_RULE,
                                  ["event_id", "user_id", "event_type"])


def map_with_setup(spark, sf):
    """Line numbers mapped through a lookup that each task loads once."""
    def load():
        import pyarrow as pa

        return pa.array([i * i for i in range(MOST_LINES + 1)], pa.int64())

    def look_up(table, v):
        import pyarrow.compute as pc

        # A number outside the lookup is worked out.
        known = pc.and_(pc.greater_equal(v, 0), pc.less_equal(v, MOST_LINES))
        return pc.if_else(known, table.take(pc.if_else(known, v, 0)), pc.multiply(v, v))

    return rows.map_with_setup(read_table(spark, sf, "lineitem"), "l_linenumber",
                               ["l_orderkey", "l_linenumber"], setup=load, apply=look_up)


def parse_keyed_lines(spark, sf):
    ev = _events(spark, sf)
    lines = rows.keyed_lines(ev, F.col("user_id"), epoch_seconds("ts"), keep=["event_id"])
    parsed, _quarantine = rows.parse_keyed_lines(lines, keep=["event_id"])
    return parsed


def table_project(spark, sf):
    return rows.rename(_events(spark, sf), {"user_id": "user_id", "event_type": "url", "ts": "c_time"})


# --- sources and partitioning -----------------------------------------------------------

def csv_behavior_scan(spark, sf):
    path = behavior.write_behavior_csv(_events(spark, sf), scratch_path(spark, "behavior-csv"))
    return behavior.read_behavior_csv(spark, path)


def broken_lines(ev: DataFrame) -> DataFrame:
    """The events as lines of both text formats (``keyed``, ``csv``); every seventh user's line has no number where one has to be."""
    number = F.when(F.col("user_id") % 7 == 0, F.lit("n/a")).otherwise(epoch_seconds("ts").cast("string"))
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("user_id", "event_id", "event_type", "event_type")]
    csv = F.concat_ws(",", *fields, F.coalesce(number, F.lit("")))
    return ev.select(F.concat_ws(" ", fields[0], F.coalesce(number, F.lit(""))).alias("keyed"), csv.alias("csv"))


def count_kinds(fmt: str, good: DataFrame, bad: DataFrame) -> DataFrame:
    """Per kind (``parsed``, ``quarantine``) of a format's lines, how many there are."""
    counted = [d.agg(F.count(F.lit(1)).alias("n")).select(F.lit(fmt).alias("format"), F.lit(k).alias("kind"), "n")
               for k, d in (("parsed", good), ("quarantine", bad))]
    return counted[0].unionByName(counted[1])


def quarantine_counts(spark, sf):
    """Lines of both text formats, some of them broken: what was parsed and what was set aside."""
    lines = broken_lines(_events(spark, sf))
    keyed = rows.parse_keyed_lines(lines.select(F.col("keyed").alias("value")))
    csv = behavior.split_behavior_lines(lines.select(F.col("csv").alias("value")))
    return count_kinds("keyed", *keyed).unionByName(count_kinds("csv", *csv))


OWNERS = 8


def partitioned_source(spark, sf):
    """Rows with their owner and the partition that holds them: they have to be the same."""
    ev = _events(spark, sf).select("event_id", "ts", "user_id", "event_type")
    return partition.owned_partitions(ev, "event_id", OWNERS)


def redistribute(spark, sf):
    """Rows after keyBy, with whether all rows of their key are in one partition."""
    ev = _events(spark, sf).select("event_id", "user_id", "event_type")
    spread = partition.key_by(partition.shuffle(ev, OWNERS), "user_id", num_partitions=OWNERS)
    spread = spread.withColumn("_p", F.spark_partition_id())
    places = spread.groupBy(F.col("user_id").alias("_user")).agg((F.min("_p") == F.max("_p")).alias("together"))
    return (spread.drop("_p").join(places, F.col("user_id").eqNullSafe(F.col("_user")))
            .select("event_id", "user_id", "event_type", "together"))


def shuffle_spread(spark, sf):
    return partition.spread(partition.shuffle(_events(spark, sf), OWNERS), OWNERS, 0.5)


def rebalance_spread(spark, sf):
    return partition.spread(partition.rebalance(_events(spark, sf), OWNERS), OWNERS, 0.1)


def parallelism_spread(spark, sf):
    return partition.spread(partition.with_parallelism(_events(spark, sf), 3), 3, 0.1)


def replicate_all(spark, sf):
    return partition.replicate_to(read_table(spark, sf, "region"), 2)


# --- aggregates: final, running, changelog ----------------------------------------------

def on_view(df: DataFrame, sql: str) -> DataFrame:
    """``sql`` over ``df`` (batch or stream) as the temporary view ``{view}``; the view's name is the query's own and goes once it is planned."""
    view = f"tp_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(view)
    try:
        return df.sparkSession.sql(sql.format(view=view))
    finally:
        df.sparkSession.catalog.dropTempView(view)


def sql_group_count(spark, sf):
    return on_view(_events(spark, sf), "SELECT user_id, COUNT(event_type) AS cnt FROM {view} GROUP BY user_id")


def sql_tumble(spark, sf):
    return on_view(_events(spark, sf), """
        SELECT user_id, COUNT(event_type) AS cnt, window.end AS end_t
        FROM {view}
        GROUP BY user_id, window(ts, '1 hour')""")


def _per_user_running(spark, sf, specs):
    c = _clicks(spark, sf)
    return run.running(c, ["event_id"], specs, partition_by=["user_id"], bucket=id_bucket("event_id", RUN_WIDTH),
                       nulls_last=True)


def running_count(spark, sf):
    r = _per_user_running(spark, sf, [Running("running_cnt", "count", F.lit(1))])
    return r.select("event_id", "user_id", "running_cnt")


def running_sum(spark, sf):
    r = _per_user_running(spark, sf, [Running("cents_sum", "sum", "cents"),
                                      Running("first_row", "first", F.struct("event_type"))])
    return r.select("event_id", "user_id", F.col("first_row.event_type").alias("event_type"),
                    F.col("cents_sum").alias("cents"))


def running_avg_keyed(spark, sf):
    r = _per_user_running(spark, sf, [Running("s", "sum", "cents"), Running("n", "count", F.lit(1))])
    return r.select("event_id", "user_id", (F.col("s") / F.col("n")).alias("avg_cents"))


def running_avg(spark, sf):
    r = run.running(_clicks(spark, sf), ["event_id"],
                    [Running("s", "sum", "cents"), Running("n", "count", F.lit(1))],
                    bucket=id_bucket("event_id", RUN_WIDTH), nulls_last=True)
    return r.select("event_id", (F.col("s") / F.col("n")).alias("avg_cents"))


def running_events_per_user(spark, sf):
    ev = _events(spark, sf).select("event_id", "user_id")
    # First occurrence of each user: a grouped min, combined map-side, so no
    # task holds a whole user.  Its flag rows are unioned into the row stream
    # just ahead of the row they mark, and one running scan counts both.
    firsts = ev.groupBy("user_id").agg(F.min("event_id").alias("event_id")).select(
        "event_id", F.lit(0).alias("is_row"), F.lit(1).alias("first_seen"))
    rows_ = ev.select("event_id", F.lit(1).alias("is_row"), F.lit(0).alias("first_seen"))
    r = run.running(rows_.unionByName(firsts), ["event_id", "is_row"],
                    [Running("n", "sum", "is_row"), Running("users", "sum", "first_seen")],
                    bucket=id_bucket("event_id", RUN_WIDTH), nulls_last=True)
    return r.filter(F.col("is_row") == 1).select(
        "event_id", (F.col("n") / F.col("users")).alias("events_per_user"))


def throttled_avg(spark, sf):
    c = _clicks(spark, sf)
    per_bucket = (c.groupBy(F.window("ts", "600 seconds").alias("w"))
                  .agg(F.sum("cents").alias("s"), F.count(F.lit(1)).alias("n"))
                  .select(F.col("w.start").alias("bucket_start"), "s", "n"))
    # One row per 10-minute bucket: the cumulative window runs over this small
    # table, never over the events.
    r = run.running(per_bucket, ["bucket_start"],
                    [Running("cum_s", "sum", "s"), Running("cum_cnt", "sum", "n")],
                    bucket=bucket_index("bucket_start", DAY), nulls_last=True)
    return r.select("bucket_start", "cum_cnt", (F.col("cum_s") / F.col("cum_cnt")).alias("cum_avg"))


def throttled_timer_avg(spark, sf):
    ticks = materialize(throttle.sum_per_tick(_clicks(spark, sf), "ts", "cents"), "throttle-ticks")
    return throttle.throttled_mean(ticks, THROTTLE_DELAY_MS)[0]


def timestamp_text(spark, sf):
    return _events(spark, sf).select("event_id", millis_text(epoch_millis("ts")).alias("ts_text"))


def changelog_count(spark, sf):
    ev = _events(spark, sf)
    return changelog.changelog(ev, "user_id", "event_id", id_bucket("event_id", RUN_WIDTH))


# --- event time ---------------------------------------------------------------------------

def _traced(spark, sf):
    a = _arrivals(spark, sf).select("event_id", "ts", "user_id", "arrival_ts")
    return eventtime.watermark_trace(a, "ts", ["arrival_ts", "event_id"], OUT_OF_ORDER)


def watermark_trace(spark, sf):
    return _traced(spark, sf).select("event_id", "ts", "arrival_ts", "wm")


def late_split(spark, sf):
    return eventtime.late_split(_traced(spark, sf)).select("event_id", "ts", "wm", "status")


def late_window_side(spark, sf):
    c = eventtime.window_lateness(_traced(spark, sf), "ts", LATE_WINDOW, 0)
    return c.select("event_id", "user_id", "window_start", "window_end", "status")


def late_refire(spark, sf):
    c = eventtime.window_lateness(_traced(spark, sf), "ts", LATE_WINDOW, ALLOWED_LATENESS)
    # Both the first firings and the refire ranks read the classification:
    # compute it (and the watermark trace under it) once.
    c = materialize(c.select("event_id", "user_id", "arrival_ts", "window_start", "window_end",
                             "status", RANGE_BUCKET_COL))
    return eventtime.refire_counts(c, "user_id", ["arrival_ts", "event_id"])


def event_timers(spark, sf):
    ev = _events(spark, sf)
    final_wm = F.timestamp_add("MICROSECOND", F.lit(-(TIMER_OUT_OF_ORDER + 1000)),
                               ev.select(F.max("ts")).scalar())
    return eventtime.event_timers(ev, "user_id", "ts", TIMER_DELAY, final_wm)


# --- joins ----------------------------------------------------------------------------------

def _orders_and_lines(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return o, li


INTERVAL_COLS = ["o_orderkey", "o_orderdate", "l_linenumber", "l_partkey", "l_shipdate"]


def interval_join(spark, sf):
    o, li = _orders_and_lines(spark, sf)
    j = joins.interval_join(o, li, "o_orderkey", "l_orderkey", "o_orderdate", "l_shipdate",
                            -10 * DAY, 5 * DAY)
    return j.select(*INTERVAL_COLS)


def interval_join_mirror(spark, sf):
    o, li = _orders_and_lines(spark, sf)
    j = joins.interval_join(li, o, "l_orderkey", "o_orderkey", "l_shipdate", "o_orderdate",
                            -5 * DAY, 10 * DAY)
    return j.select(*INTERVAL_COLS)


def window_join(spark, sf):
    ev = _events(spark, sf)
    left = ev.filter(F.col("event_type") == "click")
    right = ev.filter(F.col("event_type") == "view")
    return joins.window_join_counts(left, right, "user_id", "ts", DAY)


def stream_equi_join(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = read_table(spark, sf, "customer").select("c_custkey", "c_name")
    return o.join(c, o.o_custkey == c.c_custkey, "inner").select(
        "o_orderkey", "o_custkey", "c_name", "o_totalprice")


def control_sides(ev: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(data rows, control rows) of the events: clicks and views are data, sign-ups and errors set the value that passes."""
    data = ev.filter(F.col("event_type").isin("click", "view")).select("event_id", "ts", "user_id", "event_type")
    value = F.lit(None).cast("string")
    for k, v in CONTROL_VALUE.items():
        value = F.when(F.col("event_type") == k, F.lit(v)).otherwise(value)
    return data, ev.filter(F.col("event_type").isin(*CONTROL_VALUE)).select("event_id", "ts", value.alias("control_value"))


def control_filter(spark, sf):
    data, control = control_sides(_events(spark, sf))
    return joins.latest_control_filter(data, control, "ts", "event_id", "event_type",
                                       "control_value")


def reconcile(spark, sf):
    o, li = _orders_and_lines(spark, sf)
    pays = li.groupBy("l_orderkey").agg(F.min("l_shipdate").alias("pay_ts")).withColumnRenamed(
        "l_orderkey", "o_orderkey")
    return joins.reconcile(o, pays, "o_orderkey", "o_orderdate", "pay_ts", MATCH_WITHIN)


QUERIES: dict[str, Query] = {
    "topn_per_window": topn_per_window,
    "sliding_count": sliding_count,
    "tumbling_count": tumbling_count,
    "window_count_fmt": window_count_fmt,
    "manual_bucket_count": manual_bucket_count,
    "uv_hourly": uv_hourly,
    "uv_hourly_approx": uv_hourly_approx,
    "word_count": word_count,
    "filter_map_pair": filter_map_pair,
    "replicate_by_rule": replicate_by_rule,
    "map_with_setup": map_with_setup,
    "parse_keyed_lines": parse_keyed_lines,
    "table_project": table_project,
    "csv_behavior_scan": csv_behavior_scan,
    "partitioned_source": partitioned_source,
    "redistribute": redistribute,
    "shuffle_spread": shuffle_spread,
    "rebalance_spread": rebalance_spread,
    "parallelism_spread": parallelism_spread,
    "quarantine_counts": quarantine_counts,
    "replicate_all": replicate_all,
    "sql_group_count": sql_group_count,
    "sql_tumble": sql_tumble,
    "running_count": running_count,
    "running_sum": running_sum,
    "running_avg_keyed": running_avg_keyed,
    "running_avg": running_avg,
    "running_events_per_user": running_events_per_user,
    "throttled_avg": throttled_avg,
    "throttled_timer_avg": throttled_timer_avg,
    "timestamp_text": timestamp_text,
    "changelog_count": changelog_count,
    "watermark_trace": watermark_trace,
    "late_split": late_split,
    "late_window_side": late_window_side,
    "late_refire": late_refire,
    "event_timers": event_timers,
    "interval_join": interval_join,
    "interval_join_mirror": interval_join_mirror,
    "window_join": window_join,
    "stream_equi_join": stream_equi_join,
    "control_filter": control_filter,
    "reconcile": reconcile,
}
