"""Goldens for projections, filters and row expansion (inputs from the reference's demos)."""

from pyspark.sql import functions as F

import pyarrow.compute as pc

from tidepool.operators import rows
from tidepool.operators.running import Running, running


def test_word_count_final_and_running(spark):
    lines = spark.createDataFrame([("hello world",), ("hello world",), ("kkk world",), ("world",)],
                                  "line string")
    final = {r.word: r.cnt for r in rows.word_count(lines, "line").collect()}
    assert final == {"hello": 2, "world": 4, "kkk": 1}
    # The reference's keyed reduce emits one updated count per token: 7 rows.
    toks = rows.tokens(lines.withColumn("lid", F.monotonically_increasing_id()), "line", ["lid"])
    toks = toks.withColumn("seq", F.monotonically_increasing_id())
    r = running(toks, ["seq"], [Running("cnt", "count", F.lit(1))], partition_by=["word"],
                bucket=F.lit(0))
    got = sorted((x.word, x.cnt) for x in r.collect())
    assert len(got) == 7
    assert ("world", 4) in got and ("hello", 2) in got and ("kkk", 1) in got


def test_split_rules_match_reference_tokenizer(spark):
    df = spark.createDataFrame([("a  b",), (" a",), ("a b  ",), ("   ",), ("",)], "line string")
    got = [r.t for r in df.select(rows.split_on_space("line").alias("t")).collect()]
    assert got == [["a", "", "b"], ["", "a"], ["a", "b"], [], [""]]


def test_replicate_by_rule(spark):
    df = spark.createDataFrame([("white",), ("black",), ("gray",)], "value string")
    out = rows.replicate_by_rule(df, "value", {"white": 1, "black": 2}, ["value"])
    assert sorted(r.value for r in out.collect()) == ["black", "black", "white"]


def test_square_both_paths(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "i int")
    assert sorted(r.sq for r in rows.square(df, "i", ["i"]).collect()) == [1, 4, 9]


def test_setup_and_teardown_run_once_per_task(spark, tmp_path):
    def note(what):
        with open(tmp_path / what, "a") as f:
            f.write("x")

    df = spark.range(1, 101, numPartitions=3).withColumnRenamed("id", "i")
    out = rows.map_with_setup(df, "i", ["i"], setup=lambda: note("open") or 10, teardown=lambda h: note(f"close{h}"),
                              apply=lambda h, v: pc.add(v, h))
    assert sorted(r.sq for r in out.collect()) == list(range(11, 111))
    assert (tmp_path / "open").read_text() == (tmp_path / "close10").read_text() == "xxx"


def test_filter_map_pair(spark):
    df = spark.createDataFrame([(1, 400), (2, 501), (3, 900)], "id long, v long")
    out = rows.filter_map_pair(df, "v", 500, ["id"])
    assert sorted((r.id, r.a, r.b) for r in out.collect()) == [(2, 501, 501), (3, 900, 900)]


def test_parse_keyed_lines_quarantines_bad_rows(spark):
    lines = spark.createDataFrame([("a 1",), ("b 7",), ("bad",), ("c x",)], "value string")
    parsed, bad = rows.parse_keyed_lines(lines)
    assert sorted((r.key, r.ts_ms) for r in parsed.collect()) == [("a", 1000), ("b", 7000)]
    assert sorted(r.value for r in bad.collect()) == ["bad", "c x"]


def test_rename(spark):
    df = spark.createDataFrame([("Mary", "./home", 1)], "f0 string, f1 string, f2 long")
    out = rows.rename(df, {"f0": "user", "f1": "url", "f2": "c_time"})
    assert out.columns == ["user", "url", "c_time"]
