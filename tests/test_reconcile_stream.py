"""Reconciliation on a stream: the reference's order / payment fixture, 10 s window."""

import datetime as dt

from pyspark.sql import functions as F

from tidepool.schemas import RECONCILE_OUT
from tidepool.session import scratch_path
from tidepool.streaming.processors import Reconciler
from tidepool.streaming.runner import END_COL, event_time, run_to_table, with_end_marker


def _run(spark, rows):
    path = scratch_path(spark, "reconcile-fixture")
    epoch = dt.datetime(1970, 1, 1)
    data = [(k, side, epoch + dt.timedelta(milliseconds=ms)) for k, side, ms in rows]
    spark.createDataFrame(data, "key long, side string, ts timestamp_ntz").write.parquet(path)
    stream = spark.readStream.schema("key long, side string, ts timestamp_ntz").parquet(path)
    stream, end = with_end_marker(spark, stream, "ts")
    keyed = (event_time(stream)
             .select(F.coalesce("key", F.lit(0)).alias("key"), END_COL, "side", "ts",
                     F.floor(F.unix_micros("ts") / 1000).cast("bigint").alias("ts_ms"))
             .withWatermark("ts", "0 seconds"))
    out = keyed.groupBy("key", END_COL).transformWithState(
        statefulProcessor=Reconciler(within_ms=10_000), outputStructType=RECONCILE_OUT,
        outputMode="Append", timeMode="EventTime")
    return sorted((r.o_orderkey, r.status, r.at_ms) for r in
                  run_to_table(spark, out, "reconcile-golden", rocksdb=True, end=end).collect())


def test_reference_fixture(spark):
    rows = [(1, "order", 1_000), (2, "order", 2_000), (1, "pay", 30_000), (3, "pay", 4_000)]
    assert _run(spark, rows) == [(1, "order_timeout", 1_000), (1, "payment_timeout", 30_000),
                                 (2, "order_timeout", 2_000), (3, "payment_timeout", 4_000)]


def test_match_in_time_and_first_payment_only(spark):
    rows = [(1, "order", 1_000), (1, "pay", 9_000), (1, "pay", 9_500),   # matched; second payment ignored
            (2, "pay", 5_000), (2, "order", 15_000),                     # exactly 10 s apart: in time
            (3, "order", 1), (3, "pay", 10_002)]                         # 1 ms too late
    # (Event time 0 would be dropped: Spark treats rows at or below the initial watermark 0 as late.)
    assert _run(spark, rows) == [(1, "matched", 1_000), (2, "matched", 15_000),
                                 (3, "order_timeout", 1), (3, "payment_timeout", 10_002)]


def test_negative_keys_are_keys(spark):
    rows = [(-5, "order", 1_000), (-5, "pay", 2_000), (-1, "order", 3_000)]
    assert _run(spark, rows) == [(-5, "matched", 1_000), (-1, "order_timeout", 3_000)]
