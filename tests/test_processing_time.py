"""Processing-time timers on a live query (the reference's per-key alarm)."""

import time

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidepool.schemas import ALARM_OUT
from tidepool.session import STATE_STORE_KEY, STATE_STORE_PROVIDER, scratch_path
from tidepool.streaming.processors import ArrivalAlarm
from tidepool.streaming.runner import table_stream


def test_alarm_fires_after_arrival(spark):
    class FastAlarm(ArrivalAlarm):
        delay_ms = 1_000

    previous = spark.conf.get(STATE_STORE_KEY, None)
    spark.conf.set(STATE_STORE_KEY, STATE_STORE_PROVIDER)
    try:
        ev = table_stream(spark, SF_SMALL, "events").select(F.col("user_id").alias("key"))
        out = ev.groupBy("key").transformWithState(
            statefulProcessor=FastAlarm(), outputStructType=ALARM_OUT,
            outputMode="Append", timeMode="ProcessingTime")
        q = (out.writeStream.format("memory").queryName("tp_alarms")
             .option("checkpointLocation", scratch_path(spark, "alarm-ckpt"))
             .trigger(processingTime="500 milliseconds").start())
        try:
            deadline = time.time() + 60
            while time.time() < deadline:
                kinds = {r.kind: r.n for r in spark.sql(
                    "SELECT kind, count(*) AS n FROM tp_alarms GROUP BY kind").collect()}
                if kinds.get("alarm", 0) >= 1:
                    break
                time.sleep(1)
        finally:
            q.stop()
    finally:
        if previous is None:
            spark.conf.unset(STATE_STORE_KEY)
        else:
            spark.conf.set(STATE_STORE_KEY, previous)
    rows = spark.sql("SELECT * FROM tp_alarms").collect()
    arrivals = [r for r in rows if r.kind == "arrival"]
    alarms = [r for r in rows if r.kind == "alarm"]
    n_input = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert len(arrivals) == n_input
    assert alarms, "no processing-time alarm fired within 60 s"
    first_arrival = {r.key: r.at_ms for r in arrivals}
    assert all(a.at_ms >= first_arrival[a.key] + 1_000 for a in alarms)
