"""Event-time windows: tumbling, sliding (pane based), hand-made buckets, distinct visitors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions.timecols import epoch_millis, ntz_from_millis


def _interval(micros: int) -> str:
    return f"{micros // 1_000_000} seconds" if micros % 1_000_000 == 0 else f"{micros} microseconds"


def tumbling_count(df: DataFrame, ts: str, size_us: int, keys: list[str],
                   count_col: str | None = None) -> DataFrame:
    """Count per (tumbling window, key) with window bounds (incremental count)."""
    w = F.window(ts, _interval(size_us))
    counted = F.count(F.col(count_col)) if count_col else F.count(F.lit(1))
    return (df.groupBy(w.alias("w"), *keys).agg(counted.alias("cnt"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *keys, "cnt"))


def sliding_count(df: DataFrame, ts: str, size_us: int, slide_us: int, keys: list[str]) -> DataFrame:
    """Count per (sliding window, key) via panes.

    Rows are first counted per (slide-sized pane, key); only the pane counts
    are fanned out to the ``size/slide`` windows that contain them.  Spark's
    own sliding ``window()`` expands every input row that many times; here the
    expansion happens after the data has been reduced to one row per pane.
    """
    if size_us % slide_us:
        raise ValueError("window size must be a multiple of the slide")
    k = size_us // slide_us
    panes = (df.groupBy(F.window(ts, _interval(slide_us)).start.alias("pane"), *keys)
             .agg(F.count(F.lit(1)).alias("n")))
    fanned = (panes.select(*keys, "n", "pane",
                           F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("k"))
              .select(*keys, "n",
                      F.timestamp_add("MICROSECOND", -F.col("k").cast("bigint") * F.lit(slide_us),
                                     F.col("pane")).alias("window_start")))
    return (fanned.groupBy("window_start", *keys).agg(F.sum("n").alias("cnt"))
            .select("window_start",
                    F.timestamp_add("MICROSECOND", F.lit(size_us), F.col("window_start")).alias("window_end"),
                    *keys, "cnt"))


def manual_bucket_count(df: DataFrame, ts: str, size_ms: int, keys: list[str]) -> DataFrame:
    """The hand-made window: ``start = t - t % size`` on epoch ms, ``end = start + size``."""
    t = epoch_millis(ts)
    start = (t - F.pmod(t, F.lit(size_ms))).alias("start_ms")
    return (df.groupBy(start, *keys).agg(F.count(F.lit(1)).alias("cnt"))
            .select("start_ms", (F.col("start_ms") + size_ms).alias("end_ms"), *keys, "cnt"))


def format_window_count(df: DataFrame, key: str) -> DataFrame:
    """``key-----start----end-----count`` with epoch-ms bounds; typed columns kept."""
    line = F.concat_ws("", F.col(key).cast("string"), F.lit("-----"),
                       epoch_millis("window_start").cast("string"), F.lit("----"),
                       epoch_millis("window_end").cast("string"), F.lit("-----"),
                       F.col("cnt").cast("string"))
    return df.withColumn("line", line)


def distinct_visitors(df: DataFrame, ts: str, size_us: int, visitor: str) -> DataFrame:
    """Exact distinct visitors per tumbling window, in two aggregation stages.

    Stage 1 de-duplicates on (window, visitor); stage 2 counts per window.
    A hot window is spread over many tasks by stage 1, and stage 2 combines
    partial counts map-side, so no task holds a window's visitor set.  A NULL
    visitor is not counted, as in ``count(DISTINCT ...)``.
    """
    w = F.window(ts, _interval(size_us))
    pairs = df.select(w.alias("w"), visitor).distinct()
    return (pairs.groupBy("w").agg(F.count(visitor).alias("uv"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "uv"))


def distinct_visitors_approx(df: DataFrame, ts: str, size_us: int, visitor: str,
                             rsd: float = 0.01) -> DataFrame:
    """Approximate distinct visitors (HyperLogLog++ sketches merged across tasks)."""
    w = F.window(ts, _interval(size_us))
    return (df.groupBy(w.alias("w")).agg(F.approx_count_distinct(visitor, rsd).alias("uv"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "uv"))


def ms_bounds_to_ntz(df: DataFrame) -> DataFrame:
    return df.withColumn("window_start", ntz_from_millis("start_ms")).withColumn(
        "window_end", ntz_from_millis("end_ms"))
