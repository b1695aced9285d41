"""The two-level running scan equals the plain window form, for every kind."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidepool.operators.running import Running, id_bucket, running


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(400):
        k = rnd.choice([0, 0, 0, 1, 2])  # key 0 is hot
        v = rnd.choice([None, rnd.randint(-50, 50)]) if i % 7 == 0 else rnd.randint(-50, 50)
        s = rnd.choice(["x", "y", None, "z"])
        rows.append((i, k, v, s))
    return spark.createDataFrame(rows, "id long, k int, v long, s string")


KINDS = [("sum", "v"), ("count", "v"), ("max", "v"), ("min", "v"), ("last", "s"), ("first", "s")]


def _plain(kind, col, w):
    c = F.col(col)
    return {"sum": F.sum(c), "count": F.count(c), "max": F.max(c), "min": F.min(c),
            "last": F.last(c, ignorenulls=True), "first": F.first(c, ignorenulls=True)}[kind].over(w)


@pytest.mark.parametrize("keyed", [False, True])
@pytest.mark.parametrize("include_current", [True, False])
@pytest.mark.parametrize("width", [1, 16, 1000])
def test_matches_plain_window(data, keyed, include_current, width):
    part = ["k"] if keyed else []
    specs = [Running(f"{kind}_{col}", kind, col) for kind, col in KINDS]
    got = running(data, ["id"], specs, partition_by=part, bucket=id_bucket("id", width),
                  include_current=include_current)
    upper = Window.currentRow if include_current else -1
    w = Window.partitionBy(*part).orderBy("id").rowsBetween(Window.unboundedPreceding, upper)
    want = data.select("id", *[_plain(kind, col, w).alias(f"{kind}_{col}") for kind, col in KINDS])
    names = ["id"] + [s.name for s in specs]
    g = sorted(tuple(r) for r in got.select(*names).collect())
    e = sorted(tuple(r) for r in want.select(*names).collect())
    assert g == e


def test_keyed_sum_keeps_first_fields(spark):
    # keyBy(f1).sum(1) over ("1",2),("1",3): each key seen once, rows pass unchanged.
    df = spark.createDataFrame([("1", 2, 0), ("1", 3, 1)], "f0 string, f1 int, seq long")
    out = running(df, ["seq"], [Running("s", "sum", "f1"), Running("f0_first", "first", "f0")],
                  partition_by=["f1"], bucket=F.lit(0))
    assert sorted((r.f0_first, r.s) for r in out.collect()) == [("1", 2), ("1", 3)]


def test_range_buckets_split_a_hot_timestamp(spark):
    from tidepool.functions.timecols import ntz_from_millis
    from tidepool.operators.running import RANGE_BUCKET_COL, with_range_buckets

    # A third of the rows share one timestamp; the id breaks the ties.
    df = spark.range(3000).select(
        F.col("id"), ntz_from_millis(F.when(F.col("id") % 3 == 0, F.lit(5_000)).otherwise(F.col("id"))).alias("ts"))
    tagged = with_range_buckets(df, ["ts", "id"], 10)
    sizes = [r["count"] for r in tagged.groupBy(RANGE_BUCKET_COL).count().collect()]
    assert sum(sizes) == 3000 and len(sizes) >= 8 and max(sizes) <= 3 * 3000 / 10
    # Buckets respect the order: bucket ranges do not overlap.
    spans = tagged.groupBy(RANGE_BUCKET_COL).agg(F.min(F.struct("ts", "id")).alias("lo"),
                                                 F.max(F.struct("ts", "id")).alias("hi"))
    spans = sorted((r[RANGE_BUCKET_COL], tuple(r.lo), tuple(r.hi)) for r in spans.collect())
    assert all(a[2] < b[1] for a, b in zip(spans, spans[1:]))


def test_running_over_range_buckets_matches_plain(data):
    from tidepool.operators.running import range_bucket, with_range_buckets

    tagged = with_range_buckets(data, ["k", "id"], 7)
    got = running(tagged, ["k", "id"], [Running("m", "max", "v"), Running("l", "last", "s")],
                  bucket=range_bucket(), include_current=False)
    w = Window.orderBy("k", "id").rowsBetween(Window.unboundedPreceding, -1)
    want = data.select("id", F.max("v").over(w).alias("m"), F.last("s", ignorenulls=True).over(w).alias("l"))
    assert sorted(tuple(r) for r in got.select("id", "m", "l").collect()) == \
        sorted(tuple(r) for r in want.collect())


def test_range_buckets_put_null_keys_first(spark):
    from tidepool.operators.running import RANGE_BUCKET_COL, with_range_buckets

    df = spark.createDataFrame([(None, -1)] + [(i, i) for i in range(100)], "k long, id long")
    tagged = {r.id: r[RANGE_BUCKET_COL] for r in with_range_buckets(df, ["k", "id"], 4).collect()}
    assert tagged[-1] == 0
    assert max(tagged.values()) >= 2
