"""The language model against a plain version over whole counters, and on odd rows."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidepool.llm import ngramlm


def tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + [None]


class Plain:
    def __init__(self, texts):
        self.one, self.two, self.three, self.texts = Counter(), Counter(), Counter(), len(texts)
        for t in texts:
            u = v = "^"
            for w in t:
                self.one[w] += 1
                self.two[v, w] += 1
                self.three[u, v, w] += 1
                u, v = v, w
        self.tokens, self.words = sum(self.one.values()), len(self.one)

    def parts(self, u, v, w):
        x2 = self.texts if v == "^" else self.two[u, v]
        x1 = self.texts if v == "^" else self.one[v]
        kind = ngramlm.TWO + x2.bit_length() - 1 if x2 else ngramlm.ONE + x1.bit_length() - 1 if x1 else 0
        return kind, (self.three[u, v, w] / x2 if x2 else 0.0, self.two[v, w] / x1 if x1 else 0.0,
                      self.one[w] / max(1, self.tokens), 1 / (self.words + 1))


def walk(text):
    u = v = "^"
    for w in text:
        yield u, v, w
        u, v = v, w


def plain_scores(rows, trained, held, rounds=ngramlm.ROUNDS):
    texts = [tokens(t) for _, t in rows]
    kept = Plain([t for t, a, b in zip(texts, trained, held) if a and not b])
    full = Plain([t for t, a in zip(texts, trained) if a])
    events = Counter()
    for t, a, b in zip(texts, trained, held):
        if a and b:
            events.update(kept.parts(*x) for x in walk(t))
    weights = ngramlm._settled({}, kept.tokens > 0)
    for _ in range(rounds if kept.tokens else 0):
        uses = {}
        for (kind, p), n in events.items():
            mine = [a * b for a, b in zip(weights[kind], p)]
            into = uses.setdefault(kind, [0.0] * 4)
            for k in range(4):
                into[k] += n * mine[k] / sum(mine)
        weights = ngramlm._settled(uses, True)
    out = []
    for (key, _), t in zip(rows, texts):
        p = [sum(a * b for a, b in zip(weights[k], x)) for k, x in (full.parts(*g) for g in walk(t))]
        out.append((key, len(t), sum(full.one[w] > 0 for w in t), full.tokens,
                    sum(math.log10((full.one[w] + 1) / (full.tokens + full.words + 1)) for w in t), sum(map(math.log10, p))))
    return out


def scores(spark, rows, train="doc_id % 3 <> 0", **how):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'x' AS key", "'x' AS role", "'x' AS score", "'x' AS n_tokens", "'x' AS train_tokens").repartition(3)
    found = ngramlm.score(docs, F.expr(train), **how)
    keys = docs.selectExpr("doc_id", "text", f"coalesce({train}, false) AS t", f"pmod(xxhash64(doc_id), {ngramlm.HOLD_EVERY}) = 0 AS h").collect()
    given = [(r["doc_id"], r["text"]) for r in keys]
    expected = plain_scores(given, [r["t"] for r in keys], [r["h"] for r in keys])
    got = [(r["key"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in found.collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[4])
    got, expected = sorted(got, key=order), sorted(expected, key=order)
    assert [g[:4] for g in got] == [e[:4] for e in expected]
    for g, e in zip(got, expected):
        assert g[4:] == pytest.approx(e[4:], rel=1e-9, abs=1e-9)
    return got


@pytest.mark.parametrize("chunk_bytes", [200, 1 << 23])
def test_scores_equal_the_plain_version(spark, monkeypatch, chunk_bytes):
    monkeypatch.setattr(ngramlm, "SPARE_BITS", 34)
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("the The a cat dog sat on mat É é".split()) if rng.random() < 0.9 else f"w{rng.randrange(50)}"
                         for _ in range(rng.randrange(30)))) for i in range(160)]
    rows += [(200, None), (201, ""), (201, ""), (None, "the cat"), (None, "the cat"), (202, "unknown only here\n"), (203, "x " * 400)]
    scores(spark, rows, chunk_bytes=chunk_bytes, bucket_keys=300)


def test_no_training_text_and_no_text(spark):
    got = scores(spark, [(1, "a b"), (2, None)], train="false")
    assert [(g[2], g[3], g[4], g[5]) for g in got] == [(0, 0, 0.0, 0.0)] * 2
    scores(spark, [(1, "a b"), (2, None)], train="true")
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngramlm.score(empty, F.lit(True)).count() == 0


def test_probabilities_of_all_continuations_sum_to_one():
    rng = random.Random(7)
    model = Plain([[rng.choice("abcde") for _ in range(9)] + [None] for _ in range(30)])
    weights = ngramlm._settled({ngramlm.TWO + 2: [5.0, 1.0, 1.0, 0.1], ngramlm.ONE + 3: [0.0, 3.0, 2.0, 1.0]}, True)
    for u, v in (("^", "^"), ("^", "a"), ("a", "b"), ("zz", "a"), ("zz", "zz")):
        total = 0.0
        for w in [*model.one, "unknown"]:
            kind, p = model.parts(u, v, w)
            total += sum(a * b for a, b in zip(weights[kind], p))
        assert total == pytest.approx(1.0)


def test_held_out_texts_are_foreseen_better_than_by_single_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    sums = ngramlm.score(docs, ~held).filter(F.crc32(F.col("key").cast("string").cast("binary")) % 7 == 2).agg(
        F.sum("score"), F.sum("base_score")).first()
    assert sums[0] > sums[1]
