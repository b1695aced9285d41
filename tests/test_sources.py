"""Sources: the behaviour CSV log (batch and stream) and its malformed lines."""

from tests.conftest import SF_SMALL
from tidepool.session import scratch_path
from tidepool.sources import behavior
from tidepool.sources.tables import read_table
from tidepool.streaming.runner import run_to_table


def test_behavior_csv_round_trip_and_bad_lines(spark):
    ev = read_table(spark, SF_SMALL, "events")
    path = behavior.write_behavior_csv(ev, scratch_path(spark, "csv-test"))
    # A line with a non-numeric timestamp is dropped, not fatal.
    spark.createDataFrame([("1,2,click,click,notanumber",)], "value string").write.mode("append").text(path)
    batch = behavior.read_behavior_csv(spark, path)
    assert batch.count() == ev.count()
    stream = run_to_table(spark, behavior.stream_behavior_csv(spark, path), "csv-stream-test")
    assert stream.count() == ev.count()
    row = batch.orderBy("item_id").first()
    assert row.ts_ms % 1000 == 0 and row.event_time is not None


def test_every_line_is_parsed_or_quarantined(spark):
    lines = spark.createDataFrame([("1,2,a,view,10",), ("x,2,a,view,10",), ("",), (None,), ("1,2",), ("3,4,,,5",)], "value string")
    good, bad = behavior.split_behavior_lines(lines)
    assert sorted(r.user_id for r in good.collect()) == [1, 3]
    assert bad.count() == 4
