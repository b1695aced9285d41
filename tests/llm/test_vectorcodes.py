"""The tree against plain search, the codes against a plain version in whole numbers, odd rows."""

import math

import numpy as np
import pytest

from tidepool.llm import vectorcodes
from tidepool.llm.gnat import Gnat, squared


@pytest.mark.parametrize("high", [1, 3, 60, 2_000, 1 << 27])
def test_tree_finds_the_nearest_entry_and_the_lower_of_a_tie(high):
    rng = np.random.default_rng(high)
    for _ in range(25):
        entries = rng.integers(-high, high + 1, (int(rng.integers(1, 257)), int(rng.integers(1, 17))))
        queries = np.concatenate([rng.integers(-high, high + 1, (150, entries.shape[1])), entries[rng.integers(0, len(entries), 30)]])
        at, far = Gnat(entries, fan=int(rng.integers(2, 13)), leaf=int(rng.integers(1, 30))).nearest(queries)
        plain = ((queries[:, None, :] - entries[None]) ** 2).sum(axis=2)
        assert (far == plain.min(axis=1)).all() and (at == plain.argmin(axis=1)).all()
        assert (squared(queries, entries) == plain).all()


def test_subtrees_are_eliminated(monkeypatch):
    from tidepool.llm import gnat

    rng = np.random.default_rng(5)
    centres = rng.integers(-10_000, 10_000, (8, 4))
    entries = np.concatenate([c + rng.integers(-20, 20, (32, 4)) for c in centres])
    asked = []
    real = gnat.squared
    tree = Gnat(entries)
    monkeypatch.setattr(gnat, "squared", lambda a, b: asked.append(len(a) * len(b)) or real(a, b))
    tree.nearest(entries[rng.integers(0, 256, 500)] + 1)
    assert sum(asked) < 500 * 256 / 2


def plain_codes(rows, rounds=4):
    """(vec_id, code, error, label_error) and the entries, one number at a time."""
    kept = [(i, [math.floor(1024 * x) for x in v], l) for i, v, l in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // 4
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:256]
    books = [[r[1][p * width:(p + 1) * width] for r in first] for p in range(4)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for turn in range(rounds + 1):
        found = [[nearest(p, v[p * width:(p + 1) * width]) for p in range(4)] for _, v, _ in kept]
        if turn == rounds:
            break
        for p in range(4):
            for k in range(len(first)):
                mine = [v[p * width:(p + 1) * width] for (_, v, _), f in zip(kept, found) if f[p][1] == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    error = [sum(d for d, _ in f) for f in found]
    total = {}
    for (_, _, l), e in zip(kept, error):
        total[l] = total.get(l, 0) + e
    return sorted((i, "".join(f"{k:02x}" for _, k in f), e, total[l]) for (i, _, l), f, e in zip(kept, found, error)), books


def codes_of(spark, rows):
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr(
        "*", "'x' AS code", "'x' AS error", "'x' AS _row", "'x' AS _vector", "'x' AS label_error", "'x' AS _label")
    coded, books = vectorcodes.compress(vectors.repartition(3))
    out = vectorcodes.with_label_error(coded, "label").collect()
    assert all(r["_row"]["code"] == "x" for r in out)
    return sorted((r["_row"]["vec_id"], r["code"], r["error"], r["label_error"]) for r in out), books


def test_codes_equal_the_plain_version(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 0.3, (12, 8))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 12] + rng.normal(0, 0.02, 8)], None if i % 5 == 0 else i % 3) for i in range(500, 0, -1)]
    rows += [(1000 + k, rows[0][1], 7) for k in range(40)]  # ties
    rows += [(2000, None, 1), (2001, [None] + [0.0] * 7, 1), (2002, [float("nan")] + [0.0] * 7, 1), (2003, [float("inf")] + [0.0] * 7, 1)]
    got, books = codes_of(spark, rows)
    expected, entries = plain_codes(rows)
    assert got == expected
    assert books.tolist() == entries
    assert vectorcodes.digest(books) == vectorcodes.digest(np.array(entries))


def test_few_odd_and_no_vectors(spark):
    got, books = codes_of(spark, [(1, [0.5, 0.25], 1), (2, [0.5, 0.25, -1.0, 1e30, 0.125], 1), (3, [], None)])
    assert books.shape == (4, 3, 2) and [g[0] for g in got] == [1, 2, 3] and all(g[2] == 0 for g in got)
    assert books.max() == vectorcodes.limit(2)
    got, books = codes_of(spark, [(1, None, 1)])
    assert got == [] and books.shape[1] == 0
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectorcodes.compress(empty)[0].count() == 0
