"""Joins: interval (and its mirror), window join, equi join, control filter, reconcile."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, ms_rows
from tidepool.functions.timecols import micros
from tidepool.operators import joins
from tidepool.plans import catalog

MIN = micros(1, "min")


def test_interval_join_golden(spark):
    m = 60_000
    orders = ms_rows(spark, [("user-1", "order", 20 * m)], "userId string, kind string, ts long", ["ts"])
    pv = ms_rows(spark, [("user-1", "pv", 5 * m), ("user-1", "pv", 10 * m), ("user-1", "pv", 12 * m),
                         ("user-1", "pv", 22 * m)], "uid string, pkind string, pts long", ["pts"])
    j = joins.interval_join(orders, pv, "userId", "uid", "ts", "pts", -10 * MIN, 5 * MIN)
    assert sorted(r.pts.minute for r in j.collect()) == [10, 12, 22]
    jb = joins.interval_join(orders, pv, "userId", "uid", "ts", "pts", -10 * MIN, 5 * MIN,
                             bucket_us=3 * MIN)
    assert sorted(r.pts.minute for r in jb.collect()) == [10, 12, 22]
    mirror = joins.interval_join(pv, orders, "uid", "userId", "pts", "ts", -5 * MIN, 10 * MIN)
    assert sorted(r.pts.minute for r in mirror.collect()) == [10, 12, 22]


def test_interval_join_mirror_and_bucketed_agree_on_tables(spark):
    a = catalog.interval_join(spark, SF_SMALL)
    b = catalog.interval_join_mirror(spark, SF_SMALL)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    o, li = catalog._orders_and_lines(spark, SF_SMALL)
    c = joins.interval_join(o, li, "o_orderkey", "l_orderkey", "o_orderdate", "l_shipdate",
                            -10 * catalog.DAY, 5 * catalog.DAY, bucket_us=2 * catalog.DAY
                            ).select(*catalog.INTERVAL_COLS)
    assert c.exceptAll(a).count() == 0 and a.exceptAll(c).count() == 0


def test_window_join_golden(spark):
    left = ms_rows(spark, [("a", 1), ("b", 1)], "k string, ts long", ["ts"])
    right = ms_rows(spark, [("a", 2), ("b", 2), ("b", 3)], "k string, ts long", ["ts"])
    out = joins.window_join_counts(left, right, "k", "ts", micros(5, "s"))
    got = sorted((r.k, r.n_left, r.n_right, r.n_pairs) for r in out.collect())
    # a1-a2, b1-b2, b1-b3
    assert got == [("a", 1, 1, 1), ("b", 1, 2, 2)]


def test_equi_join_golden(spark):
    s1 = spark.createDataFrame([("a", 1), ("b", 2), ("a", 2)], "k string, v int")
    s2 = spark.createDataFrame([("a", "a"), ("b", "b"), ("a", "aaa")], "k2 string, w string")
    assert s1.join(s2, s1.k == s2.k2).count() == 5


def test_control_filter_latest_value_wins(spark):
    data = ms_rows(spark, [(1, 100, "u", "click"), (2, 300, "u", "click"), (3, 300, "u", "view"),
                           (4, 500, "u", "view"), (5, 50, "u", "click")],
                   "id long, ts long, user string, url string", ["ts"])
    control = ms_rows(spark, [(10, 200, "click"), (11, 300, "view")],
                      "id long, ts long, cv string", ["ts"])
    out = joins.latest_control_filter(data, control, "ts", "id", "url", "cv", num_buckets=3)
    # id 5 and 1 precede any control ("" matches nothing); at ts 300 the control applies first.
    assert sorted(r.id for r in out.collect()) == [3, 4]


def test_reconcile_golden(spark):
    orders = ms_rows(spark, [("order-1", 1000), ("order-2", 2000)], "k string, ots long", ["ots"])
    pays = ms_rows(spark, [("order-1", 30000), ("order-3", 4000)], "k string, pts long", ["pts"])
    out = joins.reconcile(orders, pays, "k", "ots", "pts", micros(10, "s"))
    got = {r.k: r.status for r in out.collect()}
    assert got == {"order-1": "timed_out", "order-2": "no_payment", "order-3": "no_order"}


def test_changelog_golden(spark):
    from tidepool.operators.changelog import changelog
    df = spark.createDataFrame([("Mary", "./home", 0), ("Bob", "./cart", 1), ("Mary", "./prod?id=1", 2),
                                ("Liz", "./home", 3)], "user string, url string, seq long")
    out = changelog(df, "user", "seq", bucket=F.lit(0))
    got = [(r.op, r.user, r.cnt) for r in out.orderBy("seq", "op_seq").collect()]
    assert got == [("+I", "Mary", 1), ("+I", "Bob", 1), ("-U", "Mary", 1), ("+U", "Mary", 2),
                   ("+I", "Liz", 1)]
