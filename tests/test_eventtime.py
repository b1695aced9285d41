"""Watermarks as data, late split, late windows, allowed lateness."""

from pyspark.sql import functions as F

from tests.conftest import ms_rows
from tidepool.functions.timecols import micros, ntz_from_millis
from tidepool.operators import eventtime


def _with_wm(df):
    return df.withColumn("wm", ntz_from_millis(F.col("wm_ms"))).drop("wm_ms")


def test_late_split_golden(spark):
    # Punctuated watermarks 999 and 1999 arrive between the three rows.
    rows = [("hello world", 1000, None), ("hello stream", 2000, 999), ("hello late", 1000, 1999)]
    df = _with_wm(ms_rows(spark, rows, "text string, ts long, wm_ms long", ["ts"]))
    out = {r.text: r.status for r in eventtime.late_split(df).collect()}
    assert out == {"hello world": "ok", "hello stream": "ok", "hello late": "late"}


def test_late_window_golden(spark):
    rows = [("a", 1000, None, 1), ("a", 2000, 999, 2), ("a", 4000, 1999, 3), ("a", 3000, 4999, 4)]
    df = _with_wm(ms_rows(spark, rows, "value string, ts long, wm_ms long, seq long", ["ts"]))
    c = eventtime.window_lateness(df, "ts", micros(5, "s"), 0)
    on_time = c.filter("status = 'on_time'").groupBy("window_start").count().collect()
    assert [(r.window_start.second, r["count"]) for r in on_time] == [(0, 3)]
    late = [r.seq for r in c.filter("status = 'late'").collect()]
    assert late == [4]


def test_watermark_trace_is_previous_max_minus_delay(spark):
    rows = [(1, 10_000), (2, 30_000), (3, 20_000), (4, 40_000)]
    df = ms_rows(spark, rows, "seq long, ts long", ["ts"])
    out = eventtime.watermark_trace(df, "ts", ["seq"], micros(5, "s"), bucket=F.lit(0))
    got = {r.seq: r.wm for r in out.collect()}
    assert got[1] is None
    assert (got[2].minute, got[2].second, got[2].microsecond) == (0, 4, 999_000)
    assert got[3] == got[4]  # max stays 30 s after the out-of-order row


def test_refire_counts_golden(spark):
    # Window [0,5s) for key a: two on-time rows, then two rows after it fired
    # (within lateness), then one after lateness.  Window [5s,10s) gets only a late row.
    rows = [("a", 1000, None, 1), ("a", 2000, 1000, 2), ("a", 3000, 6000, 3), ("a", 4000, 7000, 4),
            ("a", 1500, 20000, 5), ("a", 6000, 12000, 6)]
    df = _with_wm(ms_rows(spark, rows, "k string, ts long, wm_ms long, seq long", ["ts"]))
    c = eventtime.window_lateness(df, "ts", micros(5, "s"), micros(5, "s"))
    assert {r.seq: r.status for r in c.collect()} == {1: "on_time", 2: "on_time", 3: "refire",
                                                      4: "refire", 5: "late", 6: "refire"}
    out = eventtime.refire_counts(c, "k", ["seq"], bucket=F.lit(0))
    got = sorted((r.window_start.second, r.firing, r.kind, r.cnt) for r in out.collect())
    assert got == [(0, 1, "first", 2), (0, 2, "refire", 3), (0, 3, "refire", 4), (5, 1, "first", 1)]


def test_jittered_arrival_is_bounded(spark):
    df = spark.range(100).withColumnRenamed("id", "event_id").withColumn("ts", ntz_from_millis(F.lit(0)))
    out = eventtime.jittered_arrival(df)
    secs = [r.arrival_ts.second + 60 * r.arrival_ts.minute for r in out.collect()]
    assert min(secs) >= 0 and max(secs) < 900
