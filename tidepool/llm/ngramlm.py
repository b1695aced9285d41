"""Scores of an n-gram language model by deleted interpolation.

The model is a trigram mixture: P(w | u, v) = a3 c(u v w) / c(u v) + a2 c(v w) / c(v) + a1 c(w) / N + a0 / (V + 1), whose weights
depend on how often the longest context that is known came up (buckets by powers of two). The weights are learned by
expectation-maximisation: a part of the training texts (one in ``HOLD_EVERY``) is deleted from the counts, and its tokens, with the counts
of the rest, say which mixture would have foreseen them best. Scores are then taken with the counts of all training texts.

How it runs: texts are packed to chunks of a bounded size. A chunk sends each of its distinct n-grams once, with how often its
training texts hold it, by bucket of a hash; a bucket adds up and answers every chunk with the corpus counts of what it sent. So an
n-gram that all texts share costs one entry per chunk, texts never meet, and no task holds more than a bucket's n-grams, whose number is
bounded by using more buckets for more text. Words are told apart by 62 bits of their hash, longer n-grams by ``SPARE_BITS`` bits more than it takes
to number them, so that a chance meeting has probability 2^-SPARE_BITS whatever the size of the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import materialize, text_of
from tidepool.llm.wordhash import U, Words, pair

HOLD_EVERY = 8
ROUNDS = 12
CHUNK_BYTES = 1 << 22
STEP = 1 << 17      # tokens priced together
BUCKET_KEYS = 1 << 21
SPARE_BITS = 20
#: Tokens that no text holds: the end of a text, and what comes before its first word.
END, BEFORE, BEFORE_TWO = U(0x5851F42D4C957F2D), U(0x14057B7EF767814F), U(0x2545F4914F6CDD1D)
_WORD = 1 << 62
#: Buckets of contexts: 0 none is known, ONE + log2 the last word is, TWO + log2 the last two are.
ONE, TWO, KINDS = 64, 128, 192
IDLE, KEPT, HELD = 0, 1, 2  # roles of a text: scored only, counted, held out for the weights

CHUNK_SCHEMA = ("chunk bigint, held boolean, keys array<bigint>, roles binary, sizes binary, texts binary, "
                "n_tokens bigint, kept_tokens bigint, kept_texts bigint, held_tokens bigint, held_texts bigint")
SENT_SCHEMA = "bucket bigint, chunk bigint, n bigint, grams binary, kept binary, held binary"
REPLY_SCHEMA = "chunk bigint, bucket bigint, n bigint, kept binary, held binary, words_kept bigint, words bigint"
EVENT_SCHEMA = "c3 bigint, x2 bigint, c2 bigint, x1 bigint, c1 bigint, n bigint"
RESULT_SCHEMA = "key bigint, n_tokens bigint, n_known bigint, base_score double, score double"


def _squeeze(numbers: np.ndarray) -> bytes:
    """Whole numbers as planes of bytes, so that small ones cost little."""
    planes = np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _swell(body: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


def _pack(batches: Iterator[pd.DataFrame], chunk_bytes: int) -> Iterator[pd.DataFrame]:
    """Chunks of whole texts; held-out texts are in chunks of their own, since the weights are learned from those."""
    part, number = TaskContext.get().partitionId(), 0
    press = zstandard.ZstdCompressor(level=3)
    open_: dict[bool, list] = {}

    def row(held: bool) -> pd.DataFrame:
        keys, roles, texts = open_.pop(held)
        roles = np.array(roles, np.uint8)
        tokens = Words(texts).count + 1
        return pd.DataFrame([{
            "chunk": (part << 32) + number, "held": held, "keys": keys, "roles": roles.tobytes(),
            "sizes": np.array([len(t) for t in texts], np.int64).tobytes(), "texts": press.compress(b"".join(texts)),
            "n_tokens": int(tokens.sum()), "kept_tokens": int(tokens[roles == KEPT].sum()), "kept_texts": int((roles == KEPT).sum()),
            "held_tokens": int(tokens[roles == HELD].sum()), "held_texts": int((roles == HELD).sum())}])

    size = {False: 0, True: 0}
    for batch in batches:
        for key, role, text in zip(batch["key"], batch["role"], batch["text"]):
            held = bool(role == HELD)
            mine = open_.setdefault(held, [[], [], []])
            text = bytes(text).lower()  # A-Z only, as these are bytes
            for into, value in zip(mine, (None if pd.isna(key) else int(key), int(role), text)):
                into.append(value)
            size[held] += len(text)
            if size[held] >= chunk_bytes:
                yield row(held)
                size[held], number = 0, number + 1
    for held in list(open_):
        yield row(held)
        number += 1


class Chunk:
    """A chunk's tokens and its distinct n-grams in ascending order."""

    def __init__(self, row, bits: int):
        body, ends = zstandard.ZstdDecompressor().decompress(row.texts), np.cumsum(np.frombuffer(row.sizes, np.int64))
        words = Words([body[e - s:e] for s, e in zip(np.diff(ends, prepend=0).tolist(), ends.tolist())])
        self.count = words.count + 1
        upto = np.cumsum(self.count)
        self.first = upto - self.count
        token = np.empty(int(upto[-1]), np.uint64)
        is_word = np.ones(len(token), bool)
        is_word[upto - 1] = False
        token[is_word], token[upto - 1] = words.hashes(), END
        del body, words, is_word
        grams, n = np.empty(3 * len(token), np.uint64), len(token)
        grams[:n] = (token >> U(2)) | U(_WORD)
        two = pair(self.shifted(token, BEFORE), token)
        grams[n:2 * n] = two >> U(64 - bits)
        grams[2 * n:] = pair(self.shifted(two, BEFORE_TWO), token) >> U(64 - bits)
        del token, two
        self.order = np.argsort(grams).astype(np.uint32)
        grams = grams[self.order]
        new = np.ones(len(grams), bool)
        new[1:] = grams[1:] != grams[:-1]
        self.begin = np.flatnonzero(new)
        self.grams = grams[self.begin]
        self.roles = np.frombuffer(row.roles, np.uint8)

    def shifted(self, values: np.ndarray, at_start) -> np.ndarray:
        """For each token the value of the one before it in its text."""
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[self.first] = at_start
        return out

    def times(self, role: int) -> np.ndarray:
        """How often texts of a role hold each n-gram."""
        mine = np.tile(np.repeat(self.roles == role, self.count), 3)[self.order]
        return np.add.reduceat(mine.astype(np.int64), self.begin)

    def of_tokens(self, counts: np.ndarray) -> np.ndarray:
        """Counts per n-gram, as (1, 2, 3 words) x tokens."""
        out = np.empty(len(self.order), np.int64)
        out[self.order] = np.repeat(counts, np.diff(np.append(self.begin, len(self.order))))
        return out.reshape(3, -1)


def _bounds(buckets: int, word_buckets: int, bits: int) -> np.ndarray:
    """Where each bucket begins: equal ranges, longer n-grams first, then words (whose numbers are the greater ones)."""
    longer = [(k << bits) // buckets for k in range(buckets)]
    return np.array(longer + [_WORD + (k << 62) // word_buckets for k in range(word_buckets)], np.uint64)


def _send(batches, bounds: np.ndarray, bits: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples():
            chunk = Chunk(row, bits)
            kept, held = chunk.times(KEPT), chunk.times(HELD)
            edges = np.append(np.searchsorted(chunk.grams, bounds), len(chunk.grams)).tolist()
            out = []
            for k, (b, e) in enumerate(zip(edges, edges[1:])):
                if e > b:
                    out.append((k, row.chunk, e - b, _squeeze(np.diff(chunk.grams[b:e], prepend=U(0))), _squeeze(kept[b:e]), _squeeze(held[b:e])))
            yield pd.DataFrame(out, columns=["bucket", "chunk", "n", "grams", "kept", "held"])


def _answer(rows: pd.DataFrame) -> pd.DataFrame:
    """One bucket: the corpus counts of what each chunk sent, in the order it was sent."""
    number = rows["n"].to_numpy()
    every = np.concatenate([np.cumsum(_swell(g, n), dtype=np.uint64) for g, n in zip(rows["grams"], number.tolist())])
    order = np.argsort(every, kind="stable")
    ranked = every[order]
    new = np.ones(len(order), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    begin = np.flatnonzero(new)
    is_word = ranked[begin] >= U(_WORD)
    size, out, total = np.diff(np.append(begin, len(order))), {}, {}
    for name in ("kept", "held"):
        sent = np.concatenate([_swell(x, n) for x, n in zip(rows[name], number.tolist())]).astype(np.int64)
        total[name] = np.add.reduceat(sent[order], begin)
        corpus = np.empty(len(order), np.int64)
        corpus[order] = np.repeat(total[name], size)
        end = np.cumsum(number)
        out[name] = [_squeeze(corpus[e - n:e]) for n, e in zip(number.tolist(), end.tolist())]
    once = np.zeros(len(rows), np.int64)  # the bucket's own figures travel with its first row
    once[0] = 1
    return pd.DataFrame({"chunk": rows["chunk"], "bucket": rows["bucket"], "n": number, **out,
                         "words_kept": once * int((is_word & (total["kept"] > 0)).sum()),
                         "words": once * int((is_word & (total["kept"] + total["held"] > 0)).sum())})


def _counts(chunk: Chunk, replies: list, names: list[str], texts: int) -> tuple[np.ndarray, ...]:
    """(c3, x2, c2, x1, c1) of each token: corpus counts of its n-grams and of their contexts (``texts`` before the first word)."""
    total = np.concatenate([sum(_swell(r[name], r["n"]).astype(np.int64) for name in names)
                            for r in sorted(replies, key=lambda r: r["bucket"])])
    c1, c2, c3 = chunk.of_tokens(total)
    return c3, chunk.shifted(c2, texts), c2, chunk.shifted(c1, texts), c1


def _events(batches, bits: int, texts: int) -> Iterator[pd.DataFrame]:
    """Held-out tokens by their counts among the kept texts."""
    for batch in batches:
        for row in batch.itertuples():
            counts = _counts(Chunk(row, bits), row.replies, ["kept"], texts)
            frame = pd.DataFrame(dict(zip(("c3", "x2", "c2", "x1", "c1"), counts)))
            yield frame.groupby(list(frame.columns), sort=False).size().rename("n").reset_index()


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.zeros(len(a)), where=b > 0)


def _score(batches, bits: int, texts: int, tokens: int, words: int, weights: np.ndarray) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples():
            chunk = Chunk(row, bits)
            counts = _counts(chunk, row.replies, ["kept", "held"], texts)
            base, score = np.empty(len(counts[0])), np.empty(len(counts[0]))
            for k in range(0, len(base), STEP):
                c3, x2, c2, x1, c1 = (c[k:k + STEP] for c in counts)
                kind = np.where(x2 > 0, TWO + np.log2(np.maximum(x2, 1)).astype(np.int64),
                                np.where(x1 > 0, ONE + np.log2(np.maximum(x1, 1)).astype(np.int64), 0))
                a = weights[kind]
                p = a[:, 0] * _ratio(c3, x2) + a[:, 1] * _ratio(c2, x1) + a[:, 2] * (c1 / max(tokens, 1)) + a[:, 3] / (words + 1)
                score[k:k + STEP], base[k:k + STEP] = np.log10(p), np.log10((c1 + 1) / (tokens + words + 1))
            yield pd.DataFrame({"key": pd.array(list(row.keys), "Int64"), "n_tokens": chunk.count,
                                "n_known": np.add.reduceat((counts[-1] > 0).astype(np.int64), chunk.first),
                                "base_score": np.add.reduceat(base, chunk.first), "score": np.add.reduceat(score, chunk.first)})


def _settled(sums: dict[int, list[float]], known: bool) -> np.ndarray:
    """Weights per bucket from expected uses, one more of each that the bucket has; a bucket without held-out tokens takes the
    weights of the nearest one of its kind. Without any counted token all weight is on the last part, alike for all words."""
    out = np.zeros((KINDS, 4))
    if not known:
        out[:, 3] = 1
        return out
    for low, high, parts in ((0, ONE, [2, 3]), (ONE, TWO, [1, 2, 3]), (TWO, KINDS, [0, 1, 2, 3])):
        seen = [b for b in sums if low <= b < high]
        for b in range(low, high):
            near = min(seen, key=lambda s: (abs(s - b), s)) if seen else None
            uses = np.array([(sums[near][k] if near is not None else 0.0) + 1 for k in parts])
            out[b, parts] = uses / uses.sum()
    return out


def learn_weights(events: DataFrame, tokens: int, words: int, rounds: int = ROUNDS) -> np.ndarray:
    """Mixture weights per bucket of contexts, by expectation-maximisation over the held-out tokens.

    ``events`` has one row per combination of counts (c3, x2, c2, x1, c1) and ``n`` how many tokens it stands for; a round
    is one aggregate over them that gives back at most ``KINDS`` rows.
    """
    log2 = lambda c: F.floor(F.log2(c)).cast("int")
    kind = (F.when(F.col("x2") > 0, F.lit(TWO) + log2(F.col("x2"))).when(F.col("x1") > 0, F.lit(ONE) + log2(F.col("x1"))).otherwise(F.lit(0)))
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    rows = events.select(kind.alias("kind"), "n", share("c3", "x2").alias("p0"), share("c2", "x1").alias("p1"),
                         (F.col("c1") / F.lit(float(max(tokens, 1)))).alias("p2"), F.lit(1.0 / (words + 1)).alias("p3"))
    weights = _settled({}, tokens > 0)
    for _ in range(rounds if tokens else 0):
        part = [F.element_at(F.lit([float(x) for x in weights[:, k]]), F.col("kind") + 1) * F.col(f"p{k}") for k in range(4)]
        used = rows.select("kind", "n", *(x.alias(f"u{k}") for k, x in enumerate(part)))
        whole = F.col("u0") + F.col("u1") + F.col("u2") + F.col("u3")
        found = used.groupBy("kind").agg(*(F.sum(F.col("n") * F.col(f"u{k}") / whole).alias(f"s{k}") for k in range(4))).collect()
        weights = _settled({r["kind"]: [r[f"s{k}"] for k in range(4)] for r in found}, True)
    return weights


def score(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS,
          chunk_bytes: int = CHUNK_BYTES, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """One row per text: key (as long), n_tokens, n_known, base_score, score, train_tokens.

    Tokens are the words (runs of characters other than ASCII white space, A-Z lowered) and one end. The model learns from the rows for which
    ``train`` is true (null: not). n_known counts tokens that training texts hold; base_score is the log10 probability under add-one unigrams,
    score that under the interpolated trigrams; train_tokens is the same in every row.

    Which training texts are held out for the weights depends on the key's hash alone. Null and empty texts are one token, the
    end; null keys are keys; repeated rows are scored and counted each. Other columns are not read. Without a training
    text every token has probability 1 / 1. An empty table gives an empty result.
    """
    held = F.pmod(F.xxhash64(F.col(key)), F.lit(HOLD_EVERY)) == 0
    role = F.when(F.coalesce(train, F.lit(False)), F.when(held, HELD).otherwise(KEPT)).otherwise(IDLE)
    rows = docs.select(F.col(key).cast("long").alias("key"), role.alias("role"), text_of(text).cast("binary").alias("text"))
    chunks = materialize(rows.mapInPandas(lambda b: _pack(b, chunk_bytes), CHUNK_SCHEMA), "chunks")
    sums = chunks.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (
        "n_tokens", "kept_tokens", "kept_texts", "held_tokens", "held_texts"))).first()
    entries = 2 * sums["n_tokens"]
    bits = min(61, max(32, math.ceil(math.log2(max(2, entries))) + SPARE_BITS))
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(spread, -(-entries // bucket_keys))
    bounds = _bounds(buckets, -(-buckets // 8), bits)
    sent = chunks.mapInPandas(lambda b: _send(b, bounds, bits), SENT_SCHEMA)
    answers = materialize(sent.groupBy("bucket").applyInPandas(_answer, REPLY_SCHEMA), "answers")
    vocabulary = answers.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("words_kept", "words"))).first()

    def answered(which: DataFrame) -> DataFrame:
        per_chunk = answers.groupBy(F.col("chunk").alias("_c")).agg(F.collect_list(F.struct("bucket", "n", "kept", "held")).alias("replies"))
        return which.hint("merge").join(per_chunk, F.col("chunk") == F.col("_c")).drop("_c")

    events = answered(chunks.filter("held")).mapInPandas(lambda b: _events(b, bits, sums["kept_texts"]), EVENT_SCHEMA)
    weights = learn_weights(materialize(events, "events"), sums["kept_tokens"], vocabulary["words_kept"], rounds)
    tokens, texts = sums["kept_tokens"] + sums["held_tokens"], sums["kept_texts"] + sums["held_texts"]
    words = vocabulary["words"]
    found = answered(chunks).mapInPandas(lambda b: _score(b, bits, texts, tokens, words, weights), RESULT_SCHEMA)
    return found.withColumn("train_tokens", F.lit(tokens).cast("long"))
