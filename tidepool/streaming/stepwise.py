"""Streaming queries whose micro-batches are batch plans over carried state (see :mod:`tidepool.streaming.carry`).

Running aggregates, changelogs, rows against the stream's own watermark, windows that refire, control streams and
reconciliation: what Spark's streaming operators leave out or drop. Keys are never brought together in one frame: a hot key is split by the
same buckets as in the batch form. Each step reads its state's version of the epoch before and writes its own, each
output goes to a folder per epoch, so a replayed epoch changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.timecols import epoch_micros, ntz_from_micros
from tidepool.operators import changelog, eventtime, joins, throttle
from tidepool.operators.eventtime import ONE_MS
from tidepool.operators.running import RANGE_BUCKET_COL, Running, carry_after, id_bucket, running
from tidepool.plans import catalog
from tidepool.session import materialize, scratch_path
from tidepool.streaming.carry import EpochTable, KeyedTable, StreamWatermark
from tidepool.streaming.runner import END_COL, OrderedInput, read_epochs, run_to_table, with_end_marker, write_epoch

#: Micro-batches in which a registered query reads its table.
N_BATCHES = 4
#: A watermark past every time.
FOREVER = 1 << 60

Step = Callable[[DataFrame, int, bool], None]


def run_steps(spark: SparkSession, rows: OrderedInput | DataFrame, name: str, step: Step, ts: str | None = None) -> None:
    """``step(batch, epoch, ended)`` for every micro-batch of ``rows``; with ``ts`` the last batch has ``ended`` true.

    The batch is kept (memory, else disk) while the step runs, as its plans read it more than once.
    """
    end, inputs = None, ()
    if ts is not None:
        stream, end = with_end_marker(spark, rows, ts)
    elif isinstance(rows, OrderedInput):
        stream, inputs = rows.stream(), (rows,)
    else:
        stream = rows

    def sink(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        try:
            ended = ts is not None and not batch.filter(END_COL).isEmpty()
            step(batch.filter(~F.col(END_COL)).drop(END_COL) if ts is not None else batch, epoch, ended)
        finally:
            batch.unpersist()

    run_to_table(spark, stream, name, per_batch_sink=sink, end=end, inputs=inputs)


# --- running aggregates and changelog -----------------------------------------------------------

def stream_running(spark: SparkSession, rows: OrderedInput | DataFrame, order: str, specs: list[Running], keys: list[str],
                   bucket: Column, finish: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Running aggregates of a stream, one output row per input row.

    Every micro-batch is a two-level scan that starts from what the batches before left per key. That state joins the sums per
    (key, bucket), not the rows, so the rows of a hot key stay in as many tasks as it has buckets. Rows have to
    come in ``order`` from batch to batch; inside a batch they are put in order.
    """
    empty = spark.createDataFrame([], rows.df.schema if isinstance(rows, OrderedInput) else rows.schema)
    how = {"partition_by": keys, "bucket": bucket, "nulls_last": True}
    table = KeyedTable(spark, carry_after(empty, [order], specs, **how).schema, keys, name="running")
    out = scratch_path(spark, "running-out")

    def step(batch: DataFrame, epoch: int, ended: bool) -> None:
        def change(old: DataFrame) -> DataFrame:
            write_epoch(finish(running(batch, [order], specs, carry=old, **how)), out, epoch)
            return carry_after(batch, [order], specs, carry=old, **how)

        table.update(batch, epoch, change)

    run_steps(spark, rows, "running", step)
    return read_epochs(spark, out, finish(running(empty, [order], specs, **how)).schema)


def _by_id(spark, df: DataFrame, events: DataFrame | None, *cols) -> OrderedInput | DataFrame:
    return events.select(*cols) if events is not None else OrderedInput(spark, df.select(*cols), "event_id", N_BATCHES, nulls_last=True)


def _running_query(specs: list[Running], keys: list[str], finish):
    def query(spark: SparkSession, sf: str, events: DataFrame | None = None) -> DataFrame:
        clicks = catalog.clicks(events) if events is not None else None
        rows = _by_id(spark, catalog._clicks(spark, sf), clicks, "event_id", "user_id", "event_type", "cents")
        return stream_running(spark, rows, "event_id", specs, keys, id_bucket("event_id", catalog.RUN_WIDTH), finish)

    return query


def stream_running_count(spark, sf, events=None):
    return _running_query([Running("running_cnt", "count", F.lit(1))], ["user_id"],
                          lambda r: r.select("event_id", "user_id", "running_cnt"))(spark, sf, events)


def stream_running_sum(spark, sf, events=None):
    specs = [Running("cents_sum", "sum", "cents"), Running("first_row", "first", F.struct("event_type"))]
    return _running_query(specs, ["user_id"], lambda r: r.select(
        "event_id", "user_id", F.col("first_row.event_type").alias("event_type"), F.col("cents_sum").alias("cents")))(spark, sf, events)


def stream_running_avg_keyed(spark, sf, events=None):
    specs = [Running("s", "sum", "cents"), Running("n", "count", F.lit(1))]
    return _running_query(specs, ["user_id"], lambda r: r.select(
        "event_id", "user_id", (F.col("s") / F.col("n")).alias("avg_cents")))(spark, sf, events)


def stream_running_avg(spark, sf, events=None):
    specs = [Running("s", "sum", "cents"), Running("n", "count", F.lit(1))]
    return _running_query(specs, [], lambda r: r.select("event_id", (F.col("s") / F.col("n")).alias("avg_cents")))(spark, sf, events)


def stream_changelog_count(spark: SparkSession, sf: str, events: DataFrame | None = None) -> DataFrame:
    """Changelog of the per-user count: the running count's rows, each with its -U and +U (or +I) derived where it is."""
    ev = catalog._events(spark, sf) if events is None else None
    rows = _by_id(spark, ev, events, "event_id", "user_id")
    specs = [Running("_cnt", "count", F.lit(1))]
    return stream_running(spark, rows, "event_id", specs, ["user_id"], id_bucket("event_id", catalog.RUN_WIDTH),
                          lambda r: r.select("event_id", "user_id", F.inline(changelog.changelog_ops(F.col("_cnt")))))


# --- throttled mean -----------------------------------------------------------------------------

THROTTLE_STATE = "s bigint, n bigint, timer_ms bigint"


def stream_throttled_timer_avg(spark: SparkSession, sf: str, events: DataFrame | None = None,
                               delay_ms: int = catalog.THROTTLE_DELAY_MS) -> DataFrame:
    """The mean of all clicks so far, given out when a timer fires that the first row after the timer before has set.

    Sum, count and the pending timer are carried, one row; rows come in event-time order from batch to batch.
    """
    clicks = catalog.clicks(events) if events is not None else catalog._clicks(spark, sf)
    rows = clicks.select("ts", "cents")
    if events is None:
        rows = OrderedInput(spark, rows, "ts", N_BATCHES)
    state = EpochTable(spark, T._parse_datatype_string(THROTTLE_STATE), name="throttle-state")
    out = scratch_path(spark, "throttle-out")

    def step(batch: DataFrame, epoch: int, ended: bool) -> None:
        row = state.before(epoch).first()
        ticks = materialize(throttle.sum_per_tick(batch, "ts", "cents"), "throttle-ticks")
        fired, left = throttle.throttled_mean(ticks, delay_ms, tuple(row) if row else (0, 0, None), ended)
        write_epoch(fired, out, epoch)
        state.write(spark.createDataFrame([left], state.schema), epoch)

    run_steps(spark, rows, "throttled-timer", step, ts="ts")
    return read_epochs(spark, out, T._parse_datatype_string("fired_at timestamp_ntz, cum_cnt bigint, cum_avg double"))


# --- the stream's own watermark -----------------------------------------------------------------

def _arrivals(spark, sf, events: DataFrame | None):
    if events is not None:
        return events
    return OrderedInput(spark, catalog._arrivals(spark, sf).select("event_id", "ts", "user_id", "arrival_ts"), "arrival_ts",
                        N_BATCHES, nulls_last=True)


ARRIVAL = ["arrival_ts", "event_id"]


def _main_and_side(spark, rows, name: str, tag: Callable[[DataFrame], DataFrame], late: Column, cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """(main, side) of a stream whose rows are tagged against the watermark each of them meets; together they are the input."""
    wm = StreamWatermark(spark, "ts", ARRIVAL, catalog.OUT_OF_ORDER)
    main, side = scratch_path(spark, f"{name}-main"), scratch_path(spark, f"{name}-side")
    schema = {}

    def step(batch: DataFrame, epoch: int, ended: bool) -> None:
        tagged = tag(wm.trace(batch, epoch)[0]).select(*cols).persist()
        schema["of"] = tagged.schema
        write_epoch(tagged.filter(~late), main, epoch)
        write_epoch(tagged.filter(late), side, epoch)
        tagged.unpersist()

    run_steps(spark, rows, name, step)
    return read_epochs(spark, main, schema["of"]), read_epochs(spark, side, schema["of"])


def stream_late_split(spark: SparkSession, sf: str, events: DataFrame | None = None) -> DataFrame:
    """Rows behind the stream's watermark at their arrival go to a side table, the others to the main one; both are returned."""
    main, side = _main_and_side(spark, _arrivals(spark, sf, events), "late-split", eventtime.late_split,
                                F.col("status") == "late", ["event_id", "ts", "wm", "status"])
    return main.unionByName(side)


def stream_late_window_side(spark: SparkSession, sf: str, events: DataFrame | None = None) -> DataFrame:
    """Rows of windows that had fired when they arrived go to a side table (Spark's own windows drop them without a word)."""
    main, side = _main_and_side(spark, _arrivals(spark, sf, events), "late-window",
                                lambda t: eventtime.window_lateness(t, "ts", catalog.LATE_WINDOW, 0), F.col("status") == "late",
                                ["event_id", "user_id", "window_start", "window_end", "status"])
    return main.unionByName(side)


REFIRE_STATE = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("window_start", T.TimestampNTZType()),
    T.StructField("window_end", T.TimestampNTZType()), T.StructField("n_on_time", T.LongType()),
    T.StructField("n_refire", T.LongType()), T.StructField("fired", T.BooleanType())])


def refire_step(old: DataFrame, classified: DataFrame, wm_us: int | None, lateness_us: int) -> tuple[DataFrame, DataFrame]:
    """(rows given out, state) of one micro-batch of windows that stay open for ``lateness_us`` after they fired.

    ``old`` has one row per open (user, window). A window gives out its count once the watermark has passed its end, then once more for
    every row that comes before it is purged, at its end plus the lateness.
    """
    wk = ["user_id", "window_start", "window_end"]
    key = F.struct(*wk)
    per = (classified.filter(F.col("status") != "late").groupBy(key.alias("_wk"))
           .agg(F.count(F.when(F.col("status") == "on_time", 1)).alias("b_on"), F.count(F.when(F.col("status") == "refire", 1)).alias("b_re")))
    zero = F.lit(0).cast("bigint")
    both = old.select(key.alias("_wk"), "n_on_time", "n_refire", "fired").join(per, "_wk", "full_outer").select(
        "_wk", (F.coalesce("n_on_time", zero) + F.coalesce("b_on", zero)).alias("n_on_time"),
        F.coalesce("n_refire", zero).alias("refired"), (F.coalesce("n_refire", zero) + F.coalesce("b_re", zero)).alias("n_refire"),
        F.coalesce("fired", F.lit(False)).alias("fired"))
    end = epoch_micros("_wk.window_end")
    wm = F.lit(wm_us).cast("bigint")
    closes = ~F.col("fired") & (F.col("n_on_time") > 0) & F.coalesce(wm >= end - ONE_MS, F.lit(False))
    firsts = both.filter(closes).select("_wk.*", F.lit(1).cast("bigint").alias("firing"), F.lit("first").alias("kind"), F.col("n_on_time").alias("cnt"))

    late = classified.filter(F.col("status") == "refire").select(*wk, *ARRIVAL, RANGE_BUCKET_COL)
    late = running(late, ARRIVAL, [Running("rank", "count", F.lit(1))], partition_by=wk, bucket=F.col(RANGE_BUCKET_COL), nulls_last=True)
    late = late.select(key.alias("_wk"), "rank").join(both.select("_wk", "n_on_time", "refired"), "_wk")
    rank = F.col("refired") + F.col("rank")
    has_first = F.when(F.col("n_on_time") > 0, 1).otherwise(0)
    refires = late.select("_wk.*", (has_first + rank).cast("bigint").alias("firing"),
                          F.when((F.col("n_on_time") == 0) & (rank == 1), "first").otherwise("refire").alias("kind"),
                          (F.col("n_on_time") + rank).cast("bigint").alias("cnt"))
    open_ = ~F.coalesce(wm >= end + (lateness_us - ONE_MS), F.lit(False))
    state = both.filter(open_).select("_wk.*", "n_on_time", "n_refire", (F.col("fired") | closes).alias("fired"))
    return firsts.unionByName(refires), state


def stream_late_refire(spark: SparkSession, sf: str, events: DataFrame | None = None) -> DataFrame:
    """Windows with allowed lateness on a stream: a first firing, a refire per late row, purged when the lateness is over."""
    wm = StreamWatermark(spark, "ts", ARRIVAL, catalog.OUT_OF_ORDER)
    state = EpochTable(spark, REFIRE_STATE, name="refire-state")
    out, schema = scratch_path(spark, "refire-out"), {}

    def step(batch: DataFrame, epoch: int, ended: bool) -> None:
        traced, after = wm.trace(batch, epoch)
        classified = eventtime.window_lateness(traced, "ts", catalog.LATE_WINDOW, catalog.ALLOWED_LATENESS).select(
            "user_id", "arrival_ts", "event_id", "window_start", "window_end", "status", RANGE_BUCKET_COL).persist()
        given, left = refire_step(state.before(epoch), classified, FOREVER if ended else after, catalog.ALLOWED_LATENESS)
        write_epoch(given, out, epoch)
        state.write(left, epoch)
        schema["of"] = given.schema
        classified.unpersist()

    run_steps(spark, _arrivals(spark, sf, events), "late-refire", step, ts="arrival_ts")
    return read_epochs(spark, out, schema["of"])


# --- control stream -----------------------------------------------------------------------------

#: How far arrivals may be out of order: more than the jitter of the replayed arrivals.
CONTROL_DELAY = 15 * catalog.MIN


def stream_control_filter(spark: SparkSession, sf: str, events: DataFrame | None = None, delay_us: int = CONTROL_DELAY) -> DataFrame:
    """Rows of a stream whose value equals the control value in force at their event time.

    Rows wait until the watermark has passed them, so a control row that arrives later than data it rules still counts. The control values are kept by
    event time: those after the watermark and the one in force at it; earlier ones are evicted. A data row later than ``delay_us``
    is held against the earliest value kept.
    """
    if events is None:
        rows = OrderedInput(spark, catalog._arrivals(spark, sf).select("event_id", "ts", "user_id", "event_type", "arrival_ts"),
                            "arrival_ts", N_BATCHES, nulls_last=True)
    else:
        rows = events
    columns = ["event_id", "ts", "user_id", "event_type"]
    empty = (rows.df if isinstance(rows, OrderedInput) else rows).select(*columns)
    waiting = EpochTable(spark, empty.schema, name="control-waiting")
    control_schema = T.StructType([empty.schema["event_id"], empty.schema["ts"], T.StructField("control_value", T.StringType())])
    controls = EpochTable(spark, control_schema, name="control-values")
    wm, out = StreamWatermark(spark, "ts", ARRIVAL, delay_us), scratch_path(spark, "control-out")

    def step(batch: DataFrame, epoch: int, ended: bool) -> None:
        _, after = wm.advance(batch, epoch)
        limit = F.lit(FOREVER if ended else -FOREVER if after is None else after)
        passed = epoch_micros("ts") <= limit
        data, control = catalog.control_sides(batch)
        known = controls.before(epoch).unionByName(control.filter("ts IS NOT NULL")).persist()
        held = waiting.before(epoch).unionByName(data.filter("ts IS NOT NULL")).persist()
        found = joins.latest_control_filter(held.filter(passed), known.filter(passed), "ts", "event_id", "event_type", "control_value")
        write_epoch(found, out, epoch)
        waiting.write(held.filter(~passed), epoch)
        in_force = known.filter(passed).orderBy(F.desc("ts"), F.desc("event_id")).limit(1)
        controls.write(known.filter(~passed).unionByName(in_force), epoch)
        for frame in (known, held):
            frame.unpersist()

    run_steps(spark, rows, "control-filter", step, ts="arrival_ts")
    return read_epochs(spark, out, empty.schema)


# --- reconciliation -----------------------------------------------------------------------------

RECONCILE_STATE = "key bigint, order_us bigint, pay_us bigint, pay_done boolean"
#: Payments of one order come within this time of its first one (ship dates are spread over all seven years of the table).
PAY_SPAN = 3_650 * catalog.DAY


def reconcile_step(old: DataFrame, batch: DataFrame, wm_us: int | None, within_us: int, pay_span_us: int) -> tuple[DataFrame, DataFrame]:
    """(outcomes, state) of one micro-batch of (key, side, ts) rows, ``side`` 'order' or 'pay'.

    Orders and payments of a key within ``within_us`` match; a side that the watermark leaves behind, or whose partner is too far away, times
    out. Only an order's first payment counts. A decided order leaves no state; a decided payment is remembered for ``pay_span_us``, so that later
    ones of its order are told from first ones. A NULL key matches nothing.
    """
    us = epoch_micros("ts")
    sides = batch.filter(F.col("key").isNotNull() | (F.col("side") == "pay")).groupBy(F.struct("key").alias("_k")).agg(
        F.min(F.when(F.col("side") == "order", us)).alias("b_order"), F.min(F.when(F.col("side") == "pay", us)).alias("b_pay"))
    both = old.select(F.struct("key").alias("_k"), "order_us", "pay_us", "pay_done").join(sides, "_k", "full_outer").select(
        "_k.key", F.coalesce("order_us", "b_order").alias("order_us"), F.coalesce("pay_us", "b_pay").alias("pay_us"),
        F.coalesce("pay_done", F.lit(False)).alias("pay_done"))
    order, pay, wm = F.col("order_us"), F.col("pay_us"), F.lit(wm_us).cast("bigint")

    def sure(c: Column) -> Column:
        return F.coalesce(c, F.lit(False))

    match = sure(~F.col("pay_done") & (F.abs(pay - order) <= within_us))
    order_out = ~match & sure(order.isNotNull() & (pay.isNotNull() | (wm > order + within_us)))
    pay_out = ~match & ~F.col("pay_done") & sure(pay.isNotNull() & (order.isNotNull() | (wm > pay + within_us)))
    both = both.withColumns({"_match": match, "_order_out": order_out, "_pay_out": pay_out})
    outcome = F.filter(F.array(
        F.when(F.col("_match"), F.struct(F.lit("matched").alias("status"), order.alias("at_us"))),
        F.when(F.col("_order_out"), F.struct(F.lit("order_timeout").alias("status"), order.alias("at_us"))),
        F.when(F.col("_pay_out"), F.struct(F.lit("payment_timeout").alias("status"), pay.alias("at_us")))), lambda x: x.isNotNull())
    given = both.select("key", F.inline(outcome))
    nameless = batch.filter(F.col("key").isNull() & (F.col("side") == "order")).select("key", F.lit("order_timeout").alias("status"), us.alias("at_us"))
    done = F.col("pay_done") | F.col("_match") | F.col("_pay_out")
    left_order = F.when(~F.col("_match") & ~F.col("_order_out"), order)
    state = both.select("key", left_order.alias("order_us"),
                        F.when(~(done & sure(wm > pay + pay_span_us)), pay).alias("pay_us"), done.alias("pay_done"))
    return given.unionByName(nameless), state.filter("order_us IS NOT NULL OR pay_us IS NOT NULL")


def stream_reconcile(spark: SparkSession, sf: str, sides: DataFrame | None = None, within_us: int = catalog.MATCH_WITHIN,
                     pay_span_us: int = PAY_SPAN) -> DataFrame:
    """Orders matched with their first payment (line-item ship date) on a stream of both, in event-time order from batch to batch.

    ``sides`` replaces the input, a (key, side, ts) stream.
    """
    if sides is None:
        def side(table, key, ts, name):
            return catalog.read_table(spark, sf, table).select(F.col(key).alias("key"), F.lit(name).alias("side"), F.col(ts).alias("ts"))

        both = side("orders", "o_orderkey", "o_orderdate", "order").unionByName(side("lineitem", "l_orderkey", "l_shipdate", "pay"))
        # A side without a time has nothing to wait for (its oracle leaves it out too).
        sides = OrderedInput(spark, both.filter("ts IS NOT NULL"), "ts", N_BATCHES)
    wm = StreamWatermark(spark, "ts", ["ts"], -ONE_MS)
    state = EpochTable(spark, T._parse_datatype_string(RECONCILE_STATE), name="reconcile-state")
    out = scratch_path(spark, "reconcile-out")

    def step(batch: DataFrame, epoch: int, ended: bool) -> None:
        _, after = wm.advance(batch, epoch)
        given, left = reconcile_step(state.before(epoch), batch, FOREVER if ended else after, within_us, pay_span_us)
        write_epoch(given, out, epoch)
        state.write(left, epoch)

    run_steps(spark, sides, "reconcile", step, ts="ts")
    given = read_epochs(spark, out, T._parse_datatype_string("key bigint, status string, at_us bigint"))
    return given.select(F.col("key").alias("o_orderkey"), "status", ntz_from_micros("at_us").alias("at_ts"))


STEP_QUERIES = {
    "stream_running_count": stream_running_count,
    "stream_running_sum": stream_running_sum,
    "stream_running_avg_keyed": stream_running_avg_keyed,
    "stream_running_avg": stream_running_avg,
    "stream_changelog_count": stream_changelog_count,
    "stream_throttled_timer_avg": stream_throttled_timer_avg,
    "stream_late_split": stream_late_split,
    "stream_late_window_side": stream_late_window_side,
    "stream_late_refire": stream_late_refire,
    "stream_control_filter": stream_control_filter,
    "stream_reconcile": stream_reconcile,
}
