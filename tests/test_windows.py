"""Windows: pane-based sliding = Spark's sliding window, hand-made = tumbling, SQL tumble golden."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, ms_rows
from tidepool.functions.timecols import micros
from tidepool.operators import topn, windows
from tidepool.sources.tables import read_table

HOUR = micros(1, "h")


def test_sliding_panes_equal_spark_sliding_window(spark):
    ev = read_table(spark, SF_SMALL, "events")
    mine = windows.sliding_count(ev, "ts", HOUR, micros(5, "min"), ["user_id"])
    theirs = (ev.groupBy(F.window("ts", "1 hour", "5 minutes").alias("w"), "user_id")
              .agg(F.count(F.lit(1)).alias("cnt"))
              .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "user_id", "cnt"))
    assert mine.exceptAll(theirs).count() == 0 and theirs.exceptAll(mine).count() == 0


def test_manual_bucket_equals_tumbling(spark):
    ev = read_table(spark, SF_SMALL, "events")
    manual = windows.ms_bounds_to_ntz(windows.manual_bucket_count(ev, "ts", 3_600_000, ["user_id"]))
    tumbling = windows.tumbling_count(ev, "ts", HOUR, ["user_id"])
    cols = ["window_start", "window_end", "user_id", "cnt"]
    assert manual.select(*cols).exceptAll(tumbling.select(*cols)).count() == 0
    assert manual.count() == tumbling.count()


def test_sql_tumble_golden(spark):
    h, m = 3_600_000, 60_000
    rows = [("Mary", "./home", 12 * h), ("Bob", "./cart", 12 * h), ("Mary", "./prod?id=1", 12 * h + 2 * m),
            ("Mary", "./prod?id=4", 12 * h + 55 * m), ("Bob", "./prod?id=5", 13 * h + m),
            ("Liz", "./home", 13 * h + 30 * m), ("Liz", "./prod?id=7", 13 * h + 59 * m),
            ("Mary", "./cart", 14 * h), ("Liz", "./home", 14 * h + 2 * m),
            ("Bob", "./prod?id=3", 14 * h + 30 * m), ("Bob", "./home", 14 * h + 40 * m)]
    ms_rows(spark, rows, "user string, url string, ts long", ["ts"]).createOrReplaceTempView("golden_clicks")
    out = spark.sql("""SELECT user, COUNT(url) AS cnt, window.end AS end_t
                       FROM golden_clicks GROUP BY user, window(ts, '1 hour')""")
    got = sorted((r.end_t.hour, r.user, r.cnt) for r in out.collect())
    assert got == [(13, "Bob", 1), (13, "Mary", 3), (14, "Bob", 1), (14, "Liz", 2),
                   (15, "Bob", 2), (15, "Liz", 1), (15, "Mary", 1)]


def test_top_n_ties_and_short_groups(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 5), (1, "c", 9), (1, "d", 1), (2, "x", 1)],
                               "w int, item string, cnt long")
    out = topn.top_n(df, ["w"], [F.desc("cnt"), F.asc("item")], 3)
    got = sorted((r.w, r.rank, r.item) for r in out.collect())
    assert got == [(1, 1, "c"), (1, 2, "a"), (1, 3, "b"), (2, 1, "x")]


def test_distinct_visitors_exact_and_approx(spark):
    ev = read_table(spark, SF_SMALL, "events")
    exact = {r.window_start: r.uv for r in windows.distinct_visitors(ev, "ts", HOUR, "user_id").collect()}
    approx = {r.window_start: r.uv for r in
              windows.distinct_visitors_approx(ev, "ts", HOUR, "user_id").collect()}
    assert exact.keys() == approx.keys()
    total_e, total_a = sum(exact.values()), sum(approx.values())
    assert abs(total_a - total_e) <= 0.05 * total_e
