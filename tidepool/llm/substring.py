"""Exact substring deduplication by level-wise doubling.

Which windows of ``length`` words occur more than once anywhere? Sequences of a short length are looked at
first; only windows whose sequences repeat at one length are looked at with twice that length, up to
the whole window, or until no candidates survive.

At a short length a window is represented by one of its sequences, the one with the smallest hash: equal
windows pick the same one, so a window whose pick occurs once in the corpus cannot repeat. Picks
are few (about one in ten words), and windows in a row share them.

Texts are packed to chunks of a bounded size. Per level each chunk sends the distinct hashes of its
candidates, by hash bucket, and the bucket answers with one bit per hash: does it occur elsewhere? A
hash that many documents share is sent once per chunk, so no bucket is hot, and texts never
meet. Whole windows are compared by 128 bits.

Chunks are long rows. They meet their answers one chunk at a time (cogroup), and reach Python in batches
of a bounded size, so an executor never holds a partition's texts as one Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.common import materialize, text_of
from tidepool.llm.wordhash import Words, grams

LENGTH = 35
SHORTEST = 9
CHUNK_BYTES = 1 << 21
BUCKET_WORDS = 1 << 19
BATCH_BYTES = 1 << 22
BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
CHUNK_SCHEMA = "chunk bigint, keys array<bigint>, sizes binary, texts binary, n_words bigint"
PROBE_SCHEMA = "bucket bigint, chunk bigint, hashes binary, again binary"
REPLY_SCHEMA = "chunk bigint, level int, bucket bigint, n int, bits binary"
RESULT_SCHEMA = "key bigint, n_words bigint, n_removed bigint, spans array<struct<begin:bigint,end:bigint>>, kept string"


def levels(length: int, shortest: int = SHORTEST) -> list[int]:
    out = [min(shortest, length)]
    while out[-1] < length:
        out.append(min(2 * out[-1], length))
    return out


def _pack(batches: Iterator[pd.DataFrame], chunk_bytes: int) -> Iterator[pd.DataFrame]:
    part, number = TaskContext.get().partitionId(), 0
    keys, texts, size = [], [], 0
    press = zstandard.ZstdCompressor(level=3)

    def row():
        return pd.DataFrame([{
            "chunk": (part << 32) + number, "keys": keys, "sizes": np.array([len(t) for t in texts], np.int64).tobytes(),
            "texts": press.compress(b"".join(texts)), "n_words": int(Words(texts).count.sum())}])

    for batch in batches:
        for key, text in zip(batch["key"], batch["text"]):
            keys.append(None if pd.isna(key) else int(key))
            texts.append(bytes(text))
            size += len(text)
            if size >= chunk_bytes:
                yield row()
                keys, texts, size, number = [], [], 0, number + 1
    if keys:
        yield row()


class Chunk:
    """A chunk's words and the state of its windows."""

    def __init__(self, sizes: bytes, texts: bytes, length: int):
        body, ends = zstandard.ZstdDecompressor().decompress(texts), np.cumsum(np.frombuffer(sizes, np.int64))
        self.texts = [body[e - s:e] for s, e in zip(np.diff(ends, prepend=0).tolist(), ends.tolist())]
        self.words, self.length = Words(self.texts), length
        self.one = self.words.hashes(0)
        self.live = np.flatnonzero(self.words.left() >= length)  # starts of windows that may repeat

    def probe(self, size: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(buckets, hashes, sent more than once here, hash number of each live window); by bucket and hash."""
        if size < self.length:
            value = grams(self.one, size)
            pick = self._smallest(value, self.length - size + 1)[self.live]
            pick, of_window = np.unique(pick, return_inverse=True)
            hashes, of_pick, times = np.unique(value[pick], return_inverse=True, return_counts=True)
            of_window = of_pick[of_window]
            hashes = hashes[:, None]
        else:
            two = self.words.hashes(1)
            both = [grams(one, size)[self.live] for one in (self.one, two)]
            order = np.lexsort(both[::-1])
            a, b = (x[order] for x in both)
            new = np.ones(len(order), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            of_window = np.empty(len(order), np.int64)
            of_window[order] = np.cumsum(new) - 1
            hashes, times = np.stack([a[new], b[new]], axis=1), np.bincount(of_window, minlength=int(new.sum()))
        bucket = (hashes[:, 0] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return bucket[order], hashes[order], times[order] > 1, place[of_window]

    @staticmethod
    def _smallest(value: np.ndarray, span: int) -> np.ndarray:
        """For each place, where the smallest of the next ``span`` values is (the first of equals)."""
        best, at, have = value, np.arange(len(value)), 1
        while have < span:
            step = min(have, span - have)
            if len(best) <= step:
                return at[:0]
            later = best[step:] < best[:-step]
            at = np.where(later, at[step:], at[:-step])
            best = np.where(later, best[step:], best[:-step])
            have += step
        return at

    def keep(self, size: int, buckets: int, replies: pd.DataFrame) -> None:
        """Drop the windows whose hash at this level does not repeat."""
        bucket, _, _, of_window = self.probe(size, buckets)
        repeated = np.zeros(len(bucket), bool)
        begin = dict(zip(*np.unique(bucket, return_index=True)))
        for r in replies.itertuples():
            at = begin[r.bucket]
            repeated[at:at + r.n] = np.unpackbits(np.frombuffer(r.bits, np.uint8), count=r.n).view(bool)
        self.live = self.live[repeated[of_window]]


def _advance(row, replies: pd.DataFrame | None, done: list[int], buckets: int, length: int) -> Chunk:
    chunk = Chunk(row.sizes, row.texts, length)
    for k, size in enumerate(done):
        if len(chunk.live):
            chunk.keep(size, buckets, replies[replies["level"] == k])
    return chunk


def _probe(row, replies: pd.DataFrame | None, done: list[int], size: int, buckets: int, length: int) -> pd.DataFrame:
    """What a chunk asks at the level of ``size`` words: a row per bucket."""
    chunk = _advance(row, replies, done, buckets, length)
    if not len(chunk.live):
        return pd.DataFrame(columns=["bucket", "chunk", "hashes", "again"])
    bucket, hashes, again, _ = chunk.probe(size, buckets)
    numbers, begin = np.unique(bucket, return_index=True)
    end = [*begin[1:].tolist(), len(bucket)]
    return pd.DataFrame({
        "bucket": numbers, "chunk": row.chunk,
        "hashes": [hashes[b:e].tobytes() for b, e in zip(begin.tolist(), end)],
        "again": [np.packbits(again[b:e]).tobytes() for b, e in zip(begin.tolist(), end)]})


def _answering(level: int, lanes: int):
    return lambda rows: _answer(rows, level, lanes)


def _answer(rows: pd.DataFrame, level: int, lanes: int) -> pd.DataFrame:
    """One bucket: which of each chunk's hashes occur twice or more."""
    sent = [np.frombuffer(h, np.uint64).reshape(-1, lanes) for h in rows["hashes"]]
    number = np.array([len(s) for s in sent])
    again = np.concatenate([np.unpackbits(np.frombuffer(a, np.uint8), count=n) for a, n in zip(rows["again"], number.tolist())])
    every = np.concatenate(sent)
    order = np.lexsort(every.T[::-1])
    ranked = every[order]
    new = np.ones(len(order), bool)
    new[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    repeated = np.bincount(group, weights=1 + again)[group] > 1
    end = np.cumsum(number)
    return pd.DataFrame({"chunk": rows["chunk"], "level": level, "bucket": rows["bucket"], "n": number,
                         "bits": [np.packbits(repeated[e - n:e]).tobytes() for n, e in zip(number.tolist(), end.tolist())]})


def _remove(row, replies: pd.DataFrame, done: list[int], buckets: int, length: int) -> pd.DataFrame:
    """A chunk's documents without the words that its windows, as answered, cover."""
    chunk = _advance(row, replies, done, buckets, length)
    words = chunk.words
    cover = np.zeros(len(words.begin) + 1, np.int64)
    cover[chunk.live] += 1
    np.subtract.at(cover, chunk.live + length, 1)
    gone = np.cumsum(cover)[:-1] > 0
    before = np.concatenate([[0], np.cumsum(gone)])
    removed = before[words.first[1:]] - before[words.first[:-1]]
    spans, kept = [], []
    for k, text in enumerate(chunk.texts):
        parts = text.split()
        if removed[k]:
            mine = gone[words.first[k]:words.first[k + 1]]
            edge = np.flatnonzero(np.diff(np.concatenate([[0], mine.view(np.int8), [0]]))).tolist()
            spans.append([{"begin": b, "end": e} for b, e in zip(edge[::2], edge[1::2])])
            parts = [w for w, g in zip(parts, mine.tolist()) if not g]
        else:
            spans.append([])
        kept.append(b" ".join(parts).decode())
    return pd.DataFrame({"key": pd.array(list(row.keys), "Int64"), "n_words": words.count,
                         "n_removed": removed, "spans": spans, "kept": kept})


@contextmanager
def _small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> Iterator[None]:
    """Rows go to Python in batches of about ``size`` bytes; else a partition of long rows is one batch, several times in memory."""
    before = spark.conf.get(BATCH_KEY)
    spark.conf.set(BATCH_KEY, str(size))
    try:
        yield
    finally:
        spark.conf.set(BATCH_KEY, before)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                   shortest: int = SHORTEST, chunk_bytes: int = CHUNK_BYTES, bucket_words: int = BUCKET_WORDS) -> DataFrame:
    """One row per document: key, n_words, n_removed, spans (word numbers [begin, end) that go) and kept
    (the other words, joined by one space).

    A word goes if a window of ``length`` words covers it whose words also start anywhere else, in the same
    text or another; all occurrences go. Windows are those of the input. Null texts have no words; texts
    shorter than the window lose nothing; repeated rows are repeats of each other. Other columns are
    not read. An empty table gives an empty result.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), text_of(text).cast("binary").alias("text"))
    spark = docs.sparkSession
    with _small_batches(spark):
        chunks = materialize(rows.mapInPandas(lambda b: _pack(b, chunk_bytes), CHUNK_SCHEMA), "chunks")
    words = chunks.agg(F.sum("n_words")).first()[0] or 0
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(spread, -(-words // bucket_words))
    sizes, replies = levels(length, shortest), None

    def per_chunk(step, schema: str) -> DataFrame:
        """``step`` over each chunk and all answers that it got."""
        one = lambda chunk, answers: step(next(chunk.itertuples()), answers)
        return chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInPandas(one, schema)

    for k, size in enumerate(sizes):
        done, lanes = sizes[:k], 2 if size == length else 1
        if replies is None:
            probes = chunks.mapInPandas(lambda batches: (_probe(row, None, [], sizes[0], buckets, length)
                                                         for batch in batches for row in batch.itertuples()), PROBE_SCHEMA)
        else:
            probes = per_chunk(lambda row, answers, done=done, size=size: _probe(row, answers, done, size, buckets, length), PROBE_SCHEMA)
        answers = probes.groupBy("bucket").applyInPandas(_answering(k, lanes), REPLY_SCHEMA)
        with _small_batches(spark):
            answers = materialize(answers, "answers")
        replies = answers if replies is None else replies.unionByName(answers)
    return per_chunk(lambda row, answers: _remove(row, answers, sizes, buckets, length), RESULT_SCHEMA)
