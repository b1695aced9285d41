"""Registered twins read every row of their table, also those without an id, through as many tasks as it has files."""

import datetime as dt

from tidepool.plans import catalog
from tidepool.streaming import runner, twins


def test_events_without_an_id_are_counted(spark, tmp_path):
    hour = dt.datetime(2024, 1, 1)
    rows = [(None if i % 5 == 3 else i, hour + dt.timedelta(minutes=i), i % 3, ("click", "view")[i % 2], 1.0) for i in range(400)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/events.parquet")

    def same(name, cols):
        got = getattr(twins, f"stream_{name}")(spark, str(tmp_path)).select(cols).collect()
        assert sorted(map(str, got)) == sorted(map(str, getattr(catalog, name)(spark, str(tmp_path)).select(cols).collect()))
        return got

    assert sum(r["cnt"] for r in same("tumbling_count", ["window_start", "window_end", "user_id", "cnt"])) == 400
    same("uv_hourly", ["window_start", "window_end", "uv"])


def test_files_are_bounded_and_come_in_order(spark):
    df = spark.range(4_000).selectExpr("CASE WHEN id % 7 > 0 THEN timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, id * 7919 % 4000) END AS ts", "id")
    stream = runner.time_ordered_stream(spark, df, "ts", 4, rows=200)
    seen = []

    def keep(batch, _):
        seen.append([r["ts"] for r in batch.collect()])

    runner.run_to_table(spark, stream, "in-order", per_batch_sink=keep)
    assert sum(map(len, seen)) == 4_000 and 4 <= len(seen) and max(map(len, seen)) < 2_000
    times = [[t for t in batch if t] for batch in seen]
    times = [t for t in times if t]
    assert all(max(a) < min(b) for a, b in zip(times, times[1:]))
