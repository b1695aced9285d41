"""Steps over carried state: replayed epochs, bounded state, hot keys, late controls, NULL keys, upserts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidepool.operators import eventtime
from tidepool.operators.running import Running, carry_after, id_bucket, running
from tidepool.plans import catalog
from tidepool.session import scratch_path
from tidepool.streaming import stepwise, twins
from tidepool.streaming.carry import EpochTable, KeyedTable, StreamWatermark
from tidepool.streaming.runner import OrderedInput, run_to_table

DAY0 = dt.datetime(2024, 1, 1)


def rows_of(df, cols=None):
    return sorted(tuple(str(r[c]) for c in cols or df.columns) for r in df.collect())


# --- state tables -----------------------------------------------------------------------------------

def test_an_epoch_run_again_changes_nothing(spark):
    first = spark.createDataFrame([(None, 1), (1, 1), (2, 1), (-3, 1)], "k long, n long")
    second = spark.createDataFrame([(None, 5), (2, 7), (9, 1)], "k long, n long")
    table = KeyedTable(spark, first.schema, ["k"], buckets=4, path=scratch_path(spark, "upsert"))
    table.upsert(first, 0)
    table.upsert(second, 1)
    want = rows_of(table.read(1))
    assert want == sorted([("None", "5"), ("1", "1"), ("2", "7"), ("-3", "1"), ("9", "1")])
    table.upsert(second, 1)
    assert rows_of(table.read(1)) == want and rows_of(table.read(0)) == rows_of(first)
    table.upsert(first.limit(0), 2)
    assert rows_of(table.read(2)) == want


def test_only_touched_buckets_are_rewritten(spark):
    rows = spark.range(200).selectExpr("id AS k", "1L AS n")
    table = KeyedTable(spark, rows.schema, ["k"], buckets=16, path=scratch_path(spark, "touched"))
    table.upsert(rows, 0)
    table.upsert(spark.createDataFrame([(3, 2)], rows.schema), 1)
    versions = table.manifest(1)
    assert len(versions) == 16 and sorted(versions.values()) == [0] * 15 + [1]
    assert table.read(1).count() == 200
    table.upsert(spark.createDataFrame([(3, 4)], rows.schema), 2)
    table.upsert(spark.createDataFrame([(3, 5)], rows.schema), 3)
    assert table.read(3).filter("k = 3").first()["n"] == 5 and sorted(table.manifest(3).values()) == [0] * 15 + [3]


def test_epoch_table_keeps_two_versions(spark):
    table = EpochTable(spark, spark.range(1).schema, name="two")
    for epoch in range(4):
        table.write(spark.range(epoch + 1), epoch)
    assert table.before(0).count() == 0 and table.before(4).count() == 4 and table.before(3).count() == 3
    with pytest.raises(Exception):
        table.before(1).count()


def test_update_mode_keeps_one_row_per_key(spark):
    docs = spark.createDataFrame([(i, w) for i, w in enumerate(["a b", "b c", "a a", None, "c", "", "d a"])], "doc_id long, text string")
    feed = OrderedInput(spark, docs, "doc_id", 3)
    from tidepool.operators import rows

    got = run_to_table(spark, rows.word_count(feed.stream(), "text"), "words", output_mode="update", key=["word"], inputs=(feed,))
    assert len(feed) == 3 and rows_of(got) == rows_of(rows.word_count(docs, "text"))


# --- running aggregates -----------------------------------------------------------------------------

def test_a_scan_in_parts_equals_the_whole(spark):
    df = spark.range(300).selectExpr("id", "CASE WHEN id % 9 = 0 THEN NULL WHEN id % 3 > 0 THEN 7 ELSE id % 5 END AS k",
                                     "CASE WHEN id % 4 > 0 THEN id % 11 - 5 END AS v")
    specs = [Running(f"{kind}_", kind, "v") for kind in ("sum", "count", "max", "min", "last", "first")]
    for keys in (["k"], []):
        how = {"partition_by": keys, "bucket": id_bucket("id", 16), "nulls_last": True}
        got, carry = [], None
        for low, high in ((0, 40), (40, 41), (41, 200), (200, 300)):
            part = df.filter((F.col("id") >= low) & (F.col("id") < high))
            got += running(part, ["id"], specs, carry=carry, **how).collect()
            after = carry_after(part, ["id"], specs, carry=carry, **how)
            carry = spark.createDataFrame(after.collect(), after.schema)
        assert sorted(map(str, got)) == sorted(map(str, running(df, ["id"], specs, **how).collect()))


def test_no_task_reads_a_hot_key_whole(spark):
    """One user has half of the rows; the final window's groups are (user, bucket), of bounded size, also with carried state."""
    df = spark.range(4_000).selectExpr("id AS event_id", "CASE WHEN id % 2 = 0 THEN 0 ELSE id END AS user_id")
    how = {"partition_by": ["user_id"], "bucket": id_bucket("event_id", 256), "nulls_last": True}
    spec = [Running("n", "count", F.lit(1))]
    carry = carry_after(df.filter("event_id < 2000"), ["event_id"], spec, **how)
    out = running(df.filter("event_id >= 2000"), ["event_id"], spec, carry=carry, **how)
    assert out.filter("user_id = 0").agg(F.max("n")).first()[0] == 2_000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition(_grp" in plan and "windowspecdefinition(user_id" not in plan


@pytest.mark.parametrize("name", ["running_count", "running_sum", "changelog_count"])
def test_null_users_on_a_stream(spark, tmp_path, name):
    rows = [(i, DAY0 + dt.timedelta(minutes=i), None if i % 4 == 0 else i % 3, ("click", None, "view")[i % 3], float(i)) for i in range(300)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    got = getattr(stepwise, f"stream_{name}")(spark, str(tmp_path))
    want = getattr(catalog, name)(spark, str(tmp_path))
    assert rows_of(got, want.columns) == rows_of(want) and got.filter("user_id IS NULL").count() > 0


# --- the stream's own watermark ---------------------------------------------------------------------

def _arrivals(spark, rows):
    """(event_id, user_id, ts seconds, arrival seconds)."""
    data = [(i, u, DAY0 + dt.timedelta(seconds=t), DAY0 + dt.timedelta(seconds=a)) for i, u, t, a in rows]
    return spark.createDataFrame(data, "event_id long, user_id long, ts timestamp_ntz, arrival_ts timestamp_ntz")


def test_watermark_is_carried_between_batches(spark):
    rows = [(i, i % 3, (i * 37) % 500, i) for i in range(200)]
    whole = eventtime.watermark_trace(_arrivals(spark, rows), "ts", ["arrival_ts", "event_id"], 60_000_000)
    wm, got = StreamWatermark(spark, "ts", ["arrival_ts", "event_id"], 60_000_000), []
    for epoch, (low, high) in enumerate(((0, 50), (50, 50), (50, 51), (51, 200))):
        traced, _ = wm.trace(_arrivals(spark, rows[low:high] or rows[:1]).limit(high - low), epoch)
        got += [(r["event_id"], r["wm"]) for r in traced.collect()]
    assert sorted(got) == sorted((r["event_id"], r["wm"]) for r in whole.collect())


def test_main_and_side_are_the_input(spark):
    arrivals = _arrivals(spark, [(i, i % 3, (i * 37) % 5_000, i * 10) for i in range(500)])
    main, side = stepwise._main_and_side(spark, OrderedInput(spark, arrivals, "arrival_ts", 3), "both",
                                         lambda t: eventtime.window_lateness(t, "ts", catalog.LATE_WINDOW, 0),
                                         F.col("status") == "late", ["event_id", "status"])
    assert side.count() > 0 and {r["status"] for r in main.select("status").distinct().collect()} == {"on_time"}
    assert sorted(r["event_id"] for r in main.union(side).collect()) == list(range(500))


def test_refires_of_a_hot_window_and_purged_state(spark, monkeypatch):
    """One window of one user gets most rows, on time, late and too late, over many batches."""
    rows, n = [], 0
    for step in range(60):
        for _ in range(5 if step < 40 else 2):
            n += 1
            rows.append((n, 1, 10 + n % 200, step * 10))          # the hot window [0, 300)
        n += 1
        rows.append((n, None if step % 5 == 0 else 2, step * 20, step * 10))  # time goes on
    arrivals = _arrivals(spark, rows)
    states = []
    write = EpochTable.write

    def kept(self, df, epoch):
        out = write(self, df, epoch)
        if "refire-state" in self.path:
            states.append(out.collect())
        return out

    monkeypatch.setattr(EpochTable, "write", kept)
    monkeypatch.setattr(catalog, "OUT_OF_ORDER", 100_000_000)
    feed = OrderedInput(spark, arrivals, "arrival_ts", 6)
    got = stepwise.stream_late_refire(spark, SF_SMALL, feed)
    traced = eventtime.watermark_trace(arrivals, "ts", ["arrival_ts", "event_id"], 100_000_000)
    want = eventtime.refire_counts(eventtime.window_lateness(traced, "ts", catalog.LATE_WINDOW, catalog.ALLOWED_LATENESS),
                                   "user_id", ["arrival_ts", "event_id"])
    assert rows_of(got, want.columns) == rows_of(want)
    assert got.filter("user_id = 1 AND kind = 'refire'").count() > 20 and got.filter("user_id IS NULL").count() > 0
    assert states[-1] == [] and any(states[:-1])
    for left in states[1:-1]:  # purged windows leave no state
        assert not left or max(r["window_end"] for r in left) - min(r["window_end"] for r in left) < dt.timedelta(minutes=30)


# --- control stream -----------------------------------------------------------------------------------

def test_a_control_row_that_arrives_late_counts(spark):
    """(id, type, ts, arrival): the sign-up at 100 arrives after clicks at 110 and 120, which it lets through."""
    rows = [(1, "click", 50, 50), (2, "click", 110, 110), (3, "view", 115, 115), (4, "click", 120, 120), (5, "signup", 100, 300),
            (6, "error", 200, 200), (7, "view", 210, 210), (8, "click", 215, 215), (9, "click", 100, 330), (10, "view", 5_000, 5_000)]
    data = [(i, DAY0 + dt.timedelta(seconds=t), 1, k, DAY0 + dt.timedelta(seconds=a)) for i, k, t, a in rows]
    df = spark.createDataFrame(data, "event_id long, ts timestamp_ntz, user_id long, event_type string, arrival_ts timestamp_ntz")
    for batches in (1, 5):
        feed = OrderedInput(spark, df, "arrival_ts", batches)
        got = stepwise.stream_control_filter(spark, SF_SMALL, feed, delay_us=400_000_000)
        assert sorted(r["event_id"] for r in got.collect()) == [2, 4, 7, 9, 10]


# --- reconciliation -----------------------------------------------------------------------------------

def _sides(spark, rows):
    return spark.createDataFrame([(k, s, DAY0 + dt.timedelta(seconds=t)) for k, s, t in rows], "key long, side string, ts timestamp_ntz")


def _reconciled(spark, rows, batches, **how):
    feed = OrderedInput(spark, _sides(spark, rows), "ts", batches)
    out = stepwise.stream_reconcile(spark, SF_SMALL, feed, within_us=10_000_000, **how).collect()
    return sorted(((r["o_orderkey"], r["status"], int((r["at_ts"] - DAY0).total_seconds())) for r in out), key=str)


@pytest.mark.parametrize("batches", [1, 2, 7])
def test_reconcile_rules(spark, batches):
    rows = [(1, "order", 1), (2, "order", 2), (1, "pay", 30), (3, "pay", 4),              # too late; no payment; no order
            (4, "order", 1), (4, "pay", 9), (4, "pay", 10),                               # matched, second payment ignored
            (5, "pay", 5), (5, "order", 15),                                              # exactly in time
            (6, "pay", 1), (6, "pay", 22), (6, "order", 23),                              # only the first payment counts
            (-7, "order", 3), (-7, "pay", 4), (None, "order", 5), (None, "pay", 6), (None, "order", 7)]
    want = [(1, "order_timeout", 1), (1, "payment_timeout", 30), (2, "order_timeout", 2), (3, "payment_timeout", 4), (4, "matched", 1),
            (5, "matched", 15), (6, "payment_timeout", 1), (6, "order_timeout", 23), (-7, "matched", 3), (None, "order_timeout", 5),
            (None, "order_timeout", 7), (None, "payment_timeout", 6)]
    assert _reconciled(spark, rows, batches) == sorted(want, key=str)


def test_decided_keys_leave_no_state(spark):
    state = spark.createDataFrame([], stepwise.RECONCILE_STATE)
    sec = 1_000_000
    base = int((DAY0 - dt.datetime(1970, 1, 1)).total_seconds()) * sec
    sizes = []
    for k in range(6):
        batch = _sides(spark, [(k, "order", 100 * k + 1), (k, "pay", 100 * k + 2), (100 + k, "order", 100 * k + 3)])
        _, left = stepwise.reconcile_step(state, batch, base + (100 * k + 3) * sec, 10 * sec, 150 * sec)
        state = spark.createDataFrame(left.collect(), state.schema)
        sizes.append(state.count())
    assert max(sizes) <= 4 and sizes[-1] == sizes[-2]


# --- quarantine ---------------------------------------------------------------------------------------

def test_stream_counts_parsed_and_broken_lines(spark):
    got = twins.stream_quarantine_counts(spark, SF_SMALL)
    assert rows_of(got) == rows_of(catalog.quarantine_counts(spark, SF_SMALL))
