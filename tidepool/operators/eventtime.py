"""Watermarks as data, late-row handling, allowed lateness, event-time timers.

In batch the watermark each row *would* see on arrival is computed as a
column: the running maximum of event time over the rows that arrived before
it, minus the bounded out-of-orderness and 1 ms (the watermark is the largest
timestamp known to be complete).  Every late-data rule is then a predicate on
that column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.operators.running import (RANGE_BUCKET_COL, Running, range_bucket, running,
                                        with_range_buckets)

ONE_MS = 1_000


def jittered_arrival(df: DataFrame, ts: str = "ts", id_col: str = "event_id",
                     max_delay_s: int = 900, stride: int = 7919) -> DataFrame:
    """Deterministic out-of-order arrival: ``arrival_ts = ts + (id * stride % max_delay) s``."""
    delay = F.pmod(F.col(id_col) * F.lit(stride), F.lit(max_delay_s))
    return df.withColumn("arrival_ts", F.timestamp_add("SECOND", delay, F.col(ts)))


def watermark_trace(df: DataFrame, ts: str, arrival: list[str], delay_us: int,
                    bucket: Column | None = None) -> DataFrame:
    """Add ``wm``: the watermark in force when each row arrives.

    ``wm = max(ts of earlier arrivals) - delay - 1 ms``; NULL before any row.
    ``arrival`` must be a total order (end it with a unique column; NULL comes last).  By
    default the running max is bucketed by balanced ranges of that order.
    """
    if bucket is None:
        df, bucket = with_range_buckets(df, arrival, nulls_last=True), range_bucket()
    traced = running(df, arrival, [Running("_max_ts", "max", ts)], bucket=bucket,
                     include_current=False, nulls_last=True)
    return traced.withColumn(
        "wm", F.timestamp_add("MICROSECOND", F.lit(-(delay_us + ONE_MS)), F.col("_max_ts"))
    ).drop("_max_ts")


def late_split(traced: DataFrame, ts: str = "ts") -> DataFrame:
    """Tag each row ``late`` (event time behind the watermark) or ``ok``.

    One column instead of a side output: each consumer filters on ``status``.
    """
    late = F.col("wm").isNotNull() & (F.col(ts) < F.col("wm"))
    return traced.withColumn("status", F.when(late, "late").otherwise("ok"))


def _fired(window_end: Column, lateness_us: int = 0) -> Column:
    """A window has fired (and, with lateness, been purged) once the watermark
    reaches its last millisecond plus the allowed lateness."""
    limit = F.timestamp_add("MICROSECOND", F.lit(lateness_us - ONE_MS), window_end)
    return F.col("wm").isNotNull() & (F.col("wm") >= limit)


def window_lateness(traced: DataFrame, ts: str, size_us: int, lateness_us: int = 0) -> DataFrame:
    """Classify each row against its tumbling window.

    ``on_time``: the window has not fired yet; ``refire``: it fired but is
    kept for ``lateness_us`` (the row updates it); ``late``: the window is
    gone, so the row belongs to the late side output.
    """
    w = F.window(ts, f"{size_us // 1_000_000} seconds")
    staged = traced.withColumn("window_start", w.start).withColumn("window_end", w.end)
    status = (F.when(_fired(F.col("window_end"), lateness_us), "late")
              .when(_fired(F.col("window_end"), 0), "refire")
              .otherwise("on_time"))
    return staged.withColumn("status", status)


def refire_counts(classified: DataFrame, key: str, arrival: list[str],
                  bucket: Column | None = None) -> DataFrame:
    """Firings of windows kept open by allowed lateness.

    Each (key, window) with on-time rows fires once (``first``) with their
    count; every ``refire`` row then fires again with the count so far.  A
    window whose first row is already behind the watermark reports ``first``.
    """
    wk = [key, "window_start", "window_end"]
    on_time = (classified.filter(F.col("status") == "on_time")
               .groupBy(*wk).agg(F.count(F.lit(1)).alias("n_on_time")))
    extra = [RANGE_BUCKET_COL] if RANGE_BUCKET_COL in classified.columns else []
    late = classified.filter(F.col("status") == "refire").select(*wk, *arrival, *extra)
    if bucket is None:
        # The watermark trace already cut this arrival order into ranges.
        if RANGE_BUCKET_COL not in late.columns:
            late = with_range_buckets(late, arrival, nulls_last=True)
        bucket = range_bucket()
    late = running(late, arrival, [Running("late_rank", "count", F.lit(1))],
                   partition_by=wk, bucket=bucket, nulls_last=True)
    first = on_time.select(F.struct(*wk).alias("_wk"), "n_on_time")
    late = late.withColumn("_wk", F.struct(*wk)).join(first, "_wk", "left").fillna(0, subset=["n_on_time"])
    has_first = F.when(F.col("n_on_time") > 0, 1).otherwise(0)
    refires = late.select(
        *wk,
        (has_first + F.col("late_rank")).cast("bigint").alias("firing"),
        F.when((F.col("n_on_time") == 0) & (F.col("late_rank") == 1), "first")
         .otherwise("refire").alias("kind"),
        (F.col("n_on_time") + F.col("late_rank")).cast("bigint").alias("cnt"))
    firsts = on_time.select(*wk, F.lit(1).cast("bigint").alias("firing"), F.lit("first").alias("kind"),
                            F.col("n_on_time").cast("bigint").alias("cnt"))
    return firsts.unionByName(refires)


def event_timers(df: DataFrame, key: str, ts: str, after_us: int, final_wm: Column) -> DataFrame:
    """One event-time timer per (key, ts + after); ``fired`` if the watermark at
    the end of the input reaches it (the rest fire only when the input ends)."""
    timer = F.timestamp_add("MICROSECOND", F.lit(after_us), F.col(ts))
    return (df.groupBy(key, timer.alias("timer_ts")).agg(F.count(F.lit(1)).alias("registrations"))
            .withColumn("fired", F.col("timer_ts") <= final_wm))
