"""Throttled mean by timers, timestamp text, final processing-time windows and alarms."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, ms_rows
from tidepool.functions.timecols import millis_text
from tidepool.operators import throttle
from tidepool.plans import catalog
from tidepool.session import scratch_path
from tidepool.streaming import stepwise, twins
from tidepool.streaming.runner import OrderedInput

BASE = 1_704_067_200_000


def walk(rows, delay):
    """The rule row by row: rows in order of time, a timer set by the first row that finds none pending."""
    out, timer, s, n = [], None, 0, 0
    for at, v in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        if timer is not None and at > timer:
            out.append((timer, n, s / n))
            timer = None
        s, n = s + (v or 0), n + 1
        if timer is None:
            timer = at + delay
    return out + ([(timer, n, s / n)] if timer is not None else [])


def fired(df):
    got = df.select((F.unix_micros(F.col("fired_at").cast("timestamp")) / 1000).cast("bigint").alias("at"), "cum_cnt", "cum_avg")
    return sorted(tuple(r) for r in got.collect())


def table(spark, rows):
    return ms_rows(spark, rows, "ts long, cents long", ["ts"])


def random_rows(seed, n, span):
    rng = random.Random(seed)
    rows = [(BASE + rng.randrange(span), rng.choice([None, 3, 8, 20])) for _ in range(n)]
    return rows + [(None, 5)] + rows[:20]  # no time; equal times


@pytest.mark.parametrize("seed,n,span,delay", [(1, 300, 100_000, 1_000), (2, 40, 1_000_000, 700), (3, 200, 900, 10_000), (4, 500, 5_000, 1)])
def test_throttled_mean_is_the_rule_row_by_row(spark, seed, n, span, delay):
    rows = random_rows(seed, n, span)
    ticks = throttle.sum_per_tick(table(spark, rows), "ts", "cents")
    got, carry = throttle.throttled_mean(ticks, delay)
    assert fired(got) == [(t, c, pytest.approx(m)) for t, c, m in walk(rows, delay)]
    assert carry[1] == n + 20 and carry[2] is None


def test_timers_at_their_own_time_and_one_apart(spark):
    # A row at a timer's very time belongs to it and sets none; one millisecond later sets the next one.
    rows = [(BASE, 1), (BASE + 100, 3), (BASE + 101, 5), (BASE + 201, 7), (BASE + 900, 9)]
    got, _ = throttle.throttled_mean(throttle.sum_per_tick(table(spark, rows), "ts", "cents"), 100)
    assert fired(got) == [(BASE + 100, 2, 2.0), (BASE + 201, 4, 4.0), (BASE + 1000, 5, 5.0)]


def test_no_rows_no_firing(spark):
    got, carry = throttle.throttled_mean(throttle.sum_per_tick(table(spark, []), "ts", "cents"), 100)
    assert fired(got) == [] and carry == (0, 0, None)


def test_carried_over_batches_in_every_split(spark):
    rows = sorted((r for r in random_rows(5, 60, 20_000) if r[0] is not None), key=lambda r: r[0])
    want = walk(rows, 1_500)
    for cuts in ([7], [20, 21, 60], [1, 2, 40]):
        carry, got = (0, 0, None), []
        edges = [0, *cuts, len(rows)]
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            ticks = throttle.sum_per_tick(table(spark, rows[a:b]), "ts", "cents")
            part, carry = throttle.throttled_mean(ticks, 1_500, carry, ended=k == len(edges) - 2)
            got += fired(part)
        assert [(t, c) for t, c, _ in got] == [(t, c) for t, c, _ in want]
        assert [m for *_, m in got] == pytest.approx([m for *_, m in want])


def test_stream_fires_over_micro_batches(spark):
    events = catalog.read_table(spark, SF_SMALL, "events")
    rows = [(r.at, r.cents) for r in catalog.clicks(events).select(
        F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000).alias("at"), "cents").collect()]
    got = fired(stepwise.stream_throttled_timer_avg(spark, SF_SMALL))
    want = walk(rows, catalog.THROTTLE_DELAY_MS)
    assert len(want) > 10 and [g[:2] for g in got] == [w[:2] for w in want]


def test_millis_text(spark):
    df = spark.createDataFrame([(0,), (1_704_067_205_250,), (1_704_067_205_007,), (-1,), (1_704_067_205_100,), (None,)], "ms long")
    assert [r[0] for r in df.select(millis_text("ms")).collect()] == [
        "1970-01-01 00:00:00.0", "2024-01-01 00:00:05.25", "2024-01-01 00:00:05.007", "1969-12-31 23:59:59.999", "2024-01-01 00:00:05.1", None]


def with_nulls(spark):
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), None if i % 5 == 0 else i % 3) for i in range(60)]
    return spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long")


def test_final_ingest_windows_of_null_users(spark):
    feed = OrderedInput(spark, with_nulls(spark), "event_id", 3)
    got = {r.user_id: (r.cnt, r.each_once, r.aligned) for r in twins.stream_ingest_windows(spark, SF_SMALL, feed).collect()}
    assert got == {u: (16, True, True) for u in range(3)} | {None: (12, True, True)}


def test_alarms_of_null_users(spark):
    path = scratch_path(spark, "alarm-input")
    with_nulls(spark).write.parquet(path)
    stream = spark.readStream.schema(with_nulls(spark).schema).parquet(path)
    got = {r.user_id: (r.arrivals, r.all_alarmed) for r in twins.stream_arrival_alarms(spark, SF_SMALL, stream, delay_ms=500).collect()}
    assert got == {u: (16, True) for u in range(3)} | {None: (12, True)}
