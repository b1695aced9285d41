"""Stream = batch over a multi-file replay (one file per micro-batch).

State (counts, timers, per-key watermarks) and the watermark itself now move
across several micro-batches, unlike the single-batch registered twins.
"""

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tidepool.functions.timecols import epoch_micros
from tidepool.operators import eventtime
from tidepool.plans import catalog
from tidepool.session import scratch_path
from tidepool.sources.tables import TABLES
from tidepool.streaming import twins
from tidepool.streaming.runner import replay_files, replay_stream

N_FILES = 4


def _same(a, b, cols):
    def norm(df):
        return sorted(tuple(str(r[c]) for c in cols) for r in df.select(*cols).collect())
    return norm(a) == norm(b)


def _oracle_rows(name, cols):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    rel = con.sql(E.oracle_sql()[name])
    return sorted(tuple(str(r[rel.columns.index(c)]) for c in cols) for r in rel.fetchall())


@pytest.fixture(scope="module")
def events(spark):
    return catalog.read_table(spark, SF_SMALL, "events")


@pytest.fixture(scope="module")
def plain(spark, events):
    path = replay_files(spark, events, "event_id", N_FILES, scratch_path(spark, "replay"))
    return lambda: replay_stream(spark, path, events.schema)


def test_tumbling_count_across_batches(spark, plain):
    got = twins.stream_tumbling_count(spark, SF_SMALL, plain())
    want = catalog.tumbling_count(spark, SF_SMALL)
    assert _same(got, want, ["window_start", "window_end", "user_id", "cnt"])


def test_topn_across_batches(spark, plain):
    got = twins.stream_topn_per_window(spark, SF_SMALL, plain())
    want = catalog.topn_per_window(spark, SF_SMALL)
    assert _same(got, want, ["window_start", "window_end", "item", "cnt", "rank"])


def test_uv_across_batches(spark, plain):
    got = twins.stream_uv_hourly(spark, SF_SMALL, plain())
    assert _same(got, catalog.uv_hourly(spark, SF_SMALL), ["window_start", "window_end", "uv"])


def test_changelog_across_batches(spark, plain):
    got = twins.stream_changelog_count(spark, SF_SMALL, plain())
    cols = ["event_id", "user_id", "op", "cnt", "op_seq"]
    assert _same(got, catalog.changelog_count(spark, SF_SMALL), cols)


def test_event_timers_across_batches(spark, plain):
    got = twins.stream_event_timers(spark, SF_SMALL, plain())
    cols = ["user_id", "timer_ts"]
    got_rows = sorted(tuple(str(r[c]) for c in cols) for r in got.collect())
    assert got_rows == _oracle_rows("stream_event_timers", cols)


def test_keyed_late_split_across_batches(spark, events):
    # Replay in arrival order so every key sees its rows in arrival order across batches.
    arrivals = eventtime.jittered_arrival(events).withColumn("arrival_us", epoch_micros("arrival_ts"))
    path = replay_files(spark, arrivals.drop("arrival_ts"), "arrival_us", N_FILES,
                        scratch_path(spark, "replay-arrival"))
    stream = replay_stream(spark, path, arrivals.drop("arrival_ts").schema)
    got = twins.stream_late_split_keyed(spark, SF_SMALL, stream)
    cols = ["event_id", "status"]
    got_rows = sorted(tuple(str(r[c]) for c in cols) for r in got.collect())
    assert got_rows == _oracle_rows("stream_late_split_keyed", cols)


def test_throttled_avg_emits_once_per_batch(spark, plain, events):
    got = sorted((r.cum_cnt, r.cum_avg) for r in twins.stream_throttled_avg(spark, SF_SMALL, events=plain()).collect())
    assert len(got) == N_FILES
    assert [c for c, _ in got] == sorted({c for c, _ in got})  # strictly growing counts
    total = catalog.clicks(events).agg({"cents": "sum", "*": "count"}).first()
    assert got[-1][0] == total["count(1)"]
    assert abs(got[-1][1] - total["sum(cents)"] / total["count(1)"]) < 1e-9


def test_reconcile_across_batches(spark):
    # Orders and line items replayed together in event-time order: timers fire
    # and are deleted across micro-batch boundaries.
    sides = twins.reconcile_sides(catalog.read_table(spark, SF_SMALL, "orders"),
                                  catalog.read_table(spark, SF_SMALL, "lineitem"))
    sides = sides.withColumn("ts_us", epoch_micros("ts"))
    path = replay_files(spark, sides, "ts_us", 6, scratch_path(spark, "replay-reconcile"))
    got = twins.stream_reconcile(spark, SF_SMALL, replay_stream(spark, path, sides.schema).drop("ts_us"))
    cols = ["o_orderkey", "status", "at_ts"]
    got_rows = sorted(tuple(str(r[c]) for c in cols) for r in got.collect())
    assert got_rows == _oracle_rows("stream_reconcile", cols)


def test_window_join_across_batches(spark, plain):
    got = twins.stream_window_join(spark, SF_SMALL, plain())
    cols = ["user_id", "window_start", "window_end", "n_left", "n_right", "n_pairs"]
    assert _same(got, catalog.window_join(spark, SF_SMALL), cols)


@pytest.fixture(scope="module")
def odd_events(spark, events):
    """Every tenth user NULL, others negative; every seventh event type NULL."""
    from pyspark.sql import functions as F
    user = F.when(F.col("event_id") % 10 == 0, F.lit(None)).when(F.col("event_id") % 10 == 1, -F.col("user_id")).otherwise(F.col("user_id"))
    kind = F.when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.col("event_type"))
    return events.withColumn("user_id", user.cast("bigint")).withColumn("event_type", kind).cache()


@pytest.fixture(scope="module")
def odd(spark, odd_events):
    path = replay_files(spark, odd_events, "event_id", N_FILES, scratch_path(spark, "replay-odd"))
    return lambda: replay_stream(spark, path, odd_events.schema)


@pytest.mark.parametrize("twin, batch", [
    (twins.stream_tumbling_count, catalog.tumbling_count), (twins.stream_topn_per_window, catalog.topn_per_window),
    (twins.stream_uv_hourly, catalog.uv_hourly), (twins.stream_sql_tumble, catalog.sql_tumble),
    (twins.stream_event_timers, catalog.event_timers)])
def test_null_and_negative_keys_as_in_batch(spark, odd, odd_events, monkeypatch, twin, batch):
    got = twin(spark, SF_SMALL, odd())
    monkeypatch.setattr(catalog, "_events", lambda spark, sf: odd_events)
    want = batch(spark, SF_SMALL)
    cols = [c for c in got.columns if c in want.columns]
    if twin is twins.stream_event_timers:  # milliseconds
        rows = {(str(r.user_id), str(r.ts.replace(microsecond=r.ts.microsecond // 1000 * 1000) + dt.timedelta(seconds=5)))
                for r in odd_events.collect()}
        assert {(str(r.user_id), str(r.timer_ts)) for r in got.collect()} == rows
    else:
        assert _same(got, want, cols) and got.count() > 0


def test_tumbling_counts_add_up_to_the_input(spark, odd, odd_events):
    total = sum(r.cnt for r in twins.stream_tumbling_count(spark, SF_SMALL, odd()).collect())
    assert total == odd_events.count()


def test_read_epochs_raises_on_a_broken_file(spark, tmp_path):
    from tidepool.streaming.runner import read_epochs
    assert read_epochs(spark, str(tmp_path / "none"), events_schema := spark.range(1).schema).count() == 0
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        read_epochs(spark, str(tmp_path / "bad"), events_schema).count()
