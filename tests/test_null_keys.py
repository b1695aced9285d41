"""Every events query with oracle SQL equals it on a table with NULL users, types, times, values and an id."""

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as E
from tidepool.plans.catalog import QUERIES
from tidepool.plans.oracles import ORACLES
from tidepool.sources.tables import TABLES
from tests.conftest import SF_SMALL
from tests.test_oracles import _rows

# Queries whose SQL names a table with these columns; times without a value are kept out of what needs one.
ON_EVENTS = [n for n in ORACLES if "events" in ORACLES[n]]
#: A row without a time is in no window and has no place in an order by time: tested without such rows.
NEEDS_TIME = {"late_refire", "late_split", "late_window_side", "watermark_trace", "quarantine_counts", "parse_keyed_lines",
              "csv_behavior_scan", "event_timers", "tumbling_count", "sliding_count", "topn_per_window", "window_count_fmt",
              "manual_bucket_count", "uv_hourly", "uv_hourly_approx", "sql_tumble", "throttled_avg", "window_join"}
#: A line of the CSV log has to have its item; a row without a key is owned by partition 0, where the SQL has no owner.
NEEDS_ID = {"quarantine_counts", "csv_behavior_scan", "partitioned_source"}


def write_events(spark, path, times: bool, ids: bool = False):
    kinds = ("click", "view", "signup", "error", None)
    start = dt.datetime(2024, 1, 1)
    rows = [(None if i == 777 and not ids else i, None if i % 41 == 5 and not times else start + dt.timedelta(minutes=13 * i, seconds=i),
             None if i % 10 == 3 else (i * 7) % 23 - 5, kinds[(i // 3) % 5], None if i % 17 == 1 else float(i % 90)) for i in range(1000)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{path}/events.parquet")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('" + (f"{path}/{t}.parquet/*.parquet" if t == "events"
                                                                          else f"{SF_SMALL}/{t}.parquet") + "')")
    return con


@pytest.mark.parametrize("name", sorted(ON_EVENTS))
def test_null_rows_are_kept_and_counted(spark, tmp_path, name):
    con = write_events(spark, tmp_path, times=name in NEEDS_TIME, ids=name in NEEDS_ID)
    got = QUERIES[name](spark, str(tmp_path))
    rel = con.sql(E.oracle_sql()[name])
    assert _rows(got.columns, got.collect()) == _rows(rel.columns, rel.fetchall())
