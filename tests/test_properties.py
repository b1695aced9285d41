"""Properties from the test strategy: folds, partitions of the input, join symmetry."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidepool.functions.timecols import micros
from tidepool.operators import joins
from tidepool.plans import catalog


def test_changelog_folds_to_final_count(spark):
    log = catalog.changelog_count(spark, SF_SMALL)
    folded = (log.withColumn("delta", F.when(F.col("op") == "-U", -F.col("cnt")).otherwise(F.col("cnt")))
              .groupBy("user_id").agg(F.sum("delta").alias("folded")))
    # Each -U cancels the previous +I/+U, so the fold leaves the last value.
    final = catalog.sql_group_count(spark, SF_SMALL)
    got = {r.user_id: r.folded for r in folded.collect()}
    want = {r.user_id: r.cnt for r in final.collect()}
    assert got == want


def test_late_split_partitions_the_input(spark):
    split = catalog.late_split(spark, SF_SMALL)
    ids = catalog._events(spark, SF_SMALL).select("event_id")
    assert split.count() == ids.count()
    assert split.select("event_id").distinct().count() == ids.count()
    assert set(r.status for r in split.select("status").distinct().collect()) <= {"ok", "late"}


def test_late_window_counts_equal_input(spark):
    c = catalog.late_window_side(spark, SF_SMALL)
    refire = catalog.late_refire(spark, SF_SMALL)
    # Every on-time or within-lateness row is counted by exactly one last firing.
    last = refire.groupBy("user_id", "window_start").agg(F.max("cnt").alias("n"))
    total_counted = last.agg(F.sum("n")).first()[0]
    dropped = catalog.eventtime.window_lateness(catalog._traced(spark, SF_SMALL), "ts", catalog.LATE_WINDOW,
                                                catalog.ALLOWED_LATENESS).filter("status = 'late'").count()
    assert total_counted + dropped == c.count()


_BASE = dt.datetime(2024, 1, 1)
_rows = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 600)), min_size=0, max_size=25)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=_rows, right=_rows, lower=st.integers(-120, 0), upper=st.integers(0, 120),
       width=st.integers(1, 200))
def test_interval_join_forms_agree(spark, left, right, lower, upper, width):
    def frame(rows, k, t):
        data = [(key, _BASE + dt.timedelta(seconds=s)) for key, s in rows]
        return spark.createDataFrame(data, f"{k} int, {t} timestamp_ntz")

    lf, rf = frame(left, "lk", "lt"), frame(right, "rk", "rt")
    s = micros(1, "s")
    plain = joins.interval_join(lf, rf, "lk", "rk", "lt", "rt", lower * s, upper * s)
    bucketed = joins.interval_join(lf, rf, "lk", "rk", "lt", "rt", lower * s, upper * s, bucket_us=width * s)
    mirror = joins.interval_join(rf, lf, "rk", "lk", "rt", "lt", -upper * s, -lower * s)
    cols = ["lk", "lt", "rk", "rt"]
    a = sorted(tuple(r) for r in plain.select(*cols).collect())
    assert a == sorted(tuple(r) for r in bucketed.select(*cols).collect())
    assert a == sorted(tuple(r) for r in mirror.select(*cols).collect())
    brute = sorted((lk, _BASE + dt.timedelta(seconds=ls), rk, _BASE + dt.timedelta(seconds=rs))
                   for lk, ls in left for rk, rs in right
                   if lk == rk and ls + lower <= rs <= ls + upper)
    assert a == brute
