"""Periodic runs against the definition, word by word, and on odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.llm import runs
from tidepool.llm.wordhash import Words


def brute(words):
    """(start, length, period) by trying every period at every place."""
    out, n = [], len(words)
    for q in range(1, n // 4 + 1):
        at = q
        while at < n:
            stop = at
            while stop < n and words[stop] == words[stop - q]:
                stop += 1
            if stop - at + q >= max(6, 4 * q):
                stretch = words[at - q:stop]
                if all(any(stretch[k] != stretch[k - s] for k in range(s, len(stretch))) for s in range(1, q)):
                    out.append((at - q, stop - at + q, q))
            at = stop + 1
    return sorted(out)


def found(texts):
    words = Words([" ".join(t).encode() for t in texts])
    owner, *rest = runs.find(words.hashes(), words.count)
    out = [[] for _ in texts]
    for k, *run in zip(owner.tolist(), *(x.tolist() for x in rest)):
        out[k].append(tuple(run))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_the_definition(seed):
    rng = random.Random(seed)
    for _ in range(30):
        texts = []
        for _ in range(8):
            n, letters = rng.choice([0, 1, 5, 6, 25, 90, 260]), rng.choice([1, 2, 3, 4, 40])
            words = [str(rng.randrange(letters)) for _ in range(n)]
            for _ in range(rng.randrange(4) if n else 0):
                a = rng.randrange(n)
                p = 1 + rng.randrange(max(1, (n - a) // 3))
                for i in range(a, min(n, a + p * rng.randrange(1, 9))):
                    words[i] = words[a + (i - a) % p]
                if rng.random() < 0.4:
                    words[rng.randrange(n)] = "x"
            texts.append(words)
        assert found(texts) == [brute(t) for t in texts]


def test_runs_inside_runs_and_side_by_side():
    block = ["a"] * 7 + ["b"]
    assert found([block * 4]) == [sorted([(0, 32, 8)] + [(8 * k, 7, 1) for k in range(4)])]
    assert found([["x"] * 6, ["x"] * 6, ["x"] * 5]) == [[(0, 6, 1)], [(0, 6, 1)], []]  # matches never leave a text
    assert found([["a", "b"] * 4 + ["b", "a"] * 4]) == [[(0, 8, 2), (8, 8, 2)]]


def test_long_texts_take_no_quadratic_time():
    n = 300_000
    assert found([["a"] * n]) == [[(0, n, 1)]]
    assert found([[str(i % 997) for i in range(n)]]) == [[(0, n, 997)]]
    assert found([[str(i) for i in range(n // 4 - 1)] * 4]) == [[(0, 4 * (n // 4 - 1), n // 4 - 1)]]


def test_collapse_odd_rows(spark):
    rows = [(1, "a " * 9), (1, "a " * 9), (None, "b\tb\nb b b b c"), (2, None), (3, ""), (4, " \n "), (5, "no run here"), (6, "é 漢 " * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'x' AS kept", "'x' AS runs", "'x' AS n_words", "'x' AS _row", "'x' AS _text", "array(1, null) AS start")
    got = [(r["_row"]["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["kept"], r["_row"]["kept"], r["_row"]["start"])
           for r in runs.collapse(docs).collect()]
    expected = [(1, 9, [(0, 9, 1)], "a"), (1, 9, [(0, 9, 1)], "a"), (None, 7, [(0, 6, 1)], "b c"), (2, 0, [], ""), (3, 0, [], ""),
                (4, 0, [], ""), (5, 3, [], "no run here"), (6, 10, [(0, 10, 2)], "é 漢")]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == sorted((*e, "x", [1, None]) for e in expected if e[0] is not None) + [(*expected[2], "x", [1, None])]
    assert runs.collapse(docs.limit(0)).count() == 0
    small = {r["_row"]["doc_id"]: r["kept"] for r in runs.collapse(docs, slice_bytes=1).collect()}
    assert small[6] == "é 漢" and small[None] == "b c"


def test_strongest_run(spark):
    one = spark.range(1).select(F.expr("array(named_struct('start', 9L, 'length', 8L, 'period', 2L), named_struct('start', 3L, 'length', 12L, "
                                       "'period', 3L), named_struct('start', 3L, 'length', 4L, 'period', 1L))").alias("runs"))
    none = spark.range(1).select(F.expr("cast(array() AS array<struct<start:bigint,length:bigint,period:bigint>>)").alias("runs"))
    assert tuple(one.select(runs.strongest(F.col("runs")).alias("b")).first()["b"]) == (3, 4, 1)
    assert none.select(runs.strongest(F.col("runs")).alias("b")).first()["b"] is None
    assert np.array(runs.find(np.empty(0, np.uint64), np.zeros(3, np.int64))).size == 0
