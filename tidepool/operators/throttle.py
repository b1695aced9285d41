"""Throttled aggregates: rows are always accumulated, a result is given out when a timer fires.

A row that finds no timer pending sets one, ``delay_ms`` after itself; when that fires, the mean of all rows so far is given out. The next
row after it sets the next timer. Which rows set timers is a chain: each one is the first row after its
predecessor's timer. The chain is not walked: every distinct millisecond learns its successor in one shuffle by time,
and the members are found by jumps that grow by a factor (1, 4, 16, ... steps at a time), so no task and no driver loop sees all rows or all timers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.functions.timecols import epoch_millis, ntz_from_millis
from tidepool.operators.running import Running, running
from tidepool.session import materialize

#: Timers per bucket of the cumulative sums over timers.
TIMERS_PER_BUCKET = 4_096
#: Jumps that are put together per level: fewer levels (tables written), more joins in each.
HOPS = 4


def sum_per_tick(df: DataFrame, ts: str, value: str) -> DataFrame:
    """(at, s, n): sum of ``value`` and rows per millisecond. Rows without a time are left out; a NULL value counts as a row."""
    return (df.filter(F.col(ts).isNotNull()).groupBy(epoch_millis(ts).alias("at"))
            .agg(F.coalesce(F.sum(value), F.lit(0)).cast("bigint").alias("s"), F.count(F.lit(1)).alias("n")))


def successors(ticks: DataFrame, delay_ms: int) -> DataFrame:
    """(at, nxt): of every tick the first one more than ``delay_ms`` after it, where there is one.

    A tick's successor is sought in the time bucket (``delay_ms`` wide) that its timer falls into, else it is the first tick of the next
    bucket that has any. Only the buckets' first ticks, one row per ``delay_ms`` of time, are ordered in one task.
    """
    bucket = F.floor(F.col("at") / delay_ms).cast("bigint")
    points = ticks.select(bucket.alias("b"), "at", F.lit(None).cast("bigint").alias("asker"))
    asks = ticks.select((bucket + 1).alias("b"), (F.col("at") + delay_ms).alias("at"), F.col("at").alias("asker"))
    rows = points.unionByName(asks)
    point = F.when(F.col("asker").isNull(), F.col("at"))
    after = Window.partitionBy("b").orderBy(F.desc("at")).rangeBetween(Window.unboundedPreceding, -1)
    beyond = Window.orderBy(F.desc("b")).rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumn("inside", F.min(point).over(after)).filter("asker IS NOT NULL")
    later = rows.groupBy("b").agg(F.min(point).alias("first")).select("b", F.min("first").over(beyond).alias("later"))
    return inside.join(later, "b").select(F.col("asker").alias("at"), F.coalesce("inside", "later").alias("nxt")).filter("nxt IS NOT NULL")


def timer_starts(ticks: DataFrame, delay_ms: int, after_ms: int | None = None) -> DataFrame:
    """(at): the ticks that set a timer, the first one after ``after_ms`` (a timer still pending), then each first one after the timer before."""
    ticks = ticks.select("at") if after_ms is None else ticks.select("at").filter(F.col("at") > after_ms)
    low, high = ticks.agg(F.min("at"), F.max("at")).first()
    found = ticks.sparkSession.createDataFrame([] if low is None else [(low,)], "at bigint")
    if low is None or high - low <= delay_ms:
        return found
    members = (high - low) // delay_ms + 1  # of the chain, at most
    jump, levels = materialize(successors(ticks, delay_ms), "throttle-next"), []
    while HOPS ** len(levels) < members:
        levels.append(materialize(_hops(jump), "throttle-hops"))
        jump = levels[-1].select("at", F.col(f"n{HOPS}").alias("nxt")).filter("nxt IS NOT NULL")
    # A member's place in the chain, written to base HOPS, has one digit per level.
    for hops in levels:
        here = F.array("at", *[f"n{k}" for k in range(1, HOPS)])
        found = found.join(hops, "at", "left").select(F.explode(F.array_compact(here)).alias("at"))
    return materialize(found, "throttle-starts")


def _hops(jump: DataFrame) -> DataFrame:
    """(at, n1, ..., n[HOPS]): where 1 to HOPS jumps lead, NULL past the end."""
    hops = jump.select("at", F.col("nxt").alias("n1"))
    for k in range(1, HOPS):
        hops = hops.join(jump.select(F.col("at").alias(f"n{k}"), F.col("nxt").alias(f"n{k + 1}")), f"n{k}", "left")
    return hops


def throttled_mean(ticks: DataFrame, delay_ms: int, carried: tuple[int, int, int | None] = (0, 0, None),
                   ended: bool = True) -> tuple[DataFrame, tuple[int, int, int | None]]:
    """(firings, carry) of rows summed per millisecond by :func:`sum_per_tick`.

    A firing is (fired_at, cum_cnt, cum_avg): the mean over all rows up to the timer's time, its millisecond included. ``carried`` is
    (sum, rows, pending timer in ms) of the rows before. A timer fires once a later row is there, or at the end of the input; otherwise it
    is carried on. A row that comes later than its time sets no timer behind the pending one, and counts from the next firing on.
    """
    total, count, pending = carried
    spark = ticks.sparkSession
    starts = timer_starts(ticks, delay_ms, pending).select((F.col("at") + delay_ms).alias("fires"), F.col("at").alias("start"))
    last = ticks.agg(F.max("at"), F.sum("s"), F.sum("n")).first()
    after = starts.agg(F.max("fires")).first()[0]

    # At most one timer is set in a bucket of ``delay_ms``, so a row belongs to the timer set in its bucket or in the one before.
    bucket = F.floor(F.col("at") / delay_ms).cast("bigint")
    own = starts.select(F.floor(F.col("start") / delay_ms).cast("bigint").alias("b"), "start", "fires")
    before = own.select((F.col("b") + 1).alias("b"), F.col("fires").alias("fires_before"))
    sums = (ticks.withColumn("b", bucket).join(own, "b", "left").join(before, "b", "left")
            .select(F.when(F.col("start") <= F.col("at"), F.col("fires")).otherwise(F.coalesce("fires_before", F.lit(pending).cast("bigint"))).alias("fires"),
                    "s", "n")
            .groupBy("fires").agg(F.sum("s").alias("s"), F.sum("n").alias("n")))
    # Late rows of a batch that sets a timer before it has any pending belong to its first one; a pending timer fires without rows of its own, too.
    if pending is not None:
        none = spark.createDataFrame([(pending, 0, 0)], "fires bigint, s bigint, n bigint")
        sums = sums.unionByName(none).groupBy("fires").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    run = running(sums, ["fires"], [Running("cum_s", "sum", "s"), Running("cum_n", "sum", "n")],
                  bucket=F.floor(F.col("fires") / (delay_ms * TIMERS_PER_BUCKET)).cast("bigint"), nulls_last=True)
    fired = run if ended else run.filter(F.col("fires") < F.lit(last[0]).cast("bigint"))
    rows = F.col("cum_n") + F.lit(count)
    firings = fired.select(ntz_from_millis("fires").alias("fired_at"), rows.alias("cum_cnt"),
                           ((F.col("cum_s") + F.lit(total)) / rows).alias("cum_avg"))
    timer = max((t for t in (pending, after) if t is not None), default=None)
    if last[0] is not None and timer is not None and (ended or timer < last[0]):
        timer = None
    return firings, (total + (last[1] or 0), count + (last[2] or 0), timer)
