"""Vector compression: each part of a vector becomes the number of its nearest codebook entry.

Vectors are whole numbers here, so that sums, distances and ties are exact and do not depend on how Spark divides the
rows. Each round is one job over the table: tasks find the nearest entries through the tree of ``gnat``, add up their parts per entry and
send one row per (part, entry); what the driver holds is the codebooks, ``ENTRIES`` entries a part.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import materialize
from tidepool.llm.gnat import Gnat

PARTS = 4
ENTRIES = 256       # a part's number takes two hexadecimal digits
ROUNDS = 4
SCALE = 1024
ROWS = 1 << 13      # rows worked on together


def usable(vector: Column) -> Column:
    """Not null, and no component null, NaN or infinite."""
    return vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def limit(width: int) -> int:
    """Greatest component, in whole numbers, for which distances of parts of ``width`` components stay below 2^62."""
    return math.isqrt((1 << 62) // max(1, width)) // 2


def whole(column: pa.Array, dims: int) -> np.ndarray:
    """floor(SCALE * x) of each vector, filled up with zeros to ``dims`` components."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    top = limit(dims // PARTS)
    with np.errstate(over="ignore"):
        values = np.clip(np.floor(values * SCALE), -top, top).astype(np.int64)
    if len(lengths) and (lengths == dims).all():
        return values.reshape(-1, dims)
    out = np.zeros((len(lengths), dims), np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def _parts(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for k in range(0, batch.num_rows, ROWS):
        rows = batch.slice(k, ROWS)
        yield rows, whole(rows.column("_vector"), dims).reshape(rows.num_rows, PARTS, dims // PARTS)


def _sums(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per part and entry that is used here: number and sum of its parts."""
    parts, entries, width = books.shape
    trees = [Gnat(b) for b in books]
    count, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
    for batch in batches:
        for _, x in _parts(batch, parts * width):
            for p in range(parts):
                at, _ = trees[p].nearest(x[:, p])
                count[p] += np.bincount(at, minlength=entries)
                order = np.argsort(at, kind="stable")
                used, first = np.unique(at[order], return_index=True)
                sums[p, used] += np.add.reduceat(x[order, p], first, axis=0)
    part, entry = np.nonzero(count)
    flat = pa.array(sums[part, entry].reshape(-1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(count[part, entry]),
         pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * width), flat)], ["part", "entry", "n", "sums"])


def _codes(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    parts, _, width = books.shape
    trees = [Gnat(b) for b in books]
    for batch in batches:
        for rows, x in _parts(batch, parts * width):
            found = [trees[p].nearest(x[:, p]) for p in range(parts)]
            digits = np.stack([at for at, _ in found], axis=1).astype(np.uint8).tobytes().hex()
            code = [digits[k:k + 2 * parts] for k in range(0, len(digits), 2 * parts)]
            error = np.sum([far for _, far in found], axis=0)
            yield pa.RecordBatch.from_arrays([rows.column("_row"), pa.array(code, pa.string()), pa.array(error, pa.int64())],
                                             ["_row", "code", "error"])


def learn(rows: DataFrame, dims: int, start: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, component) after ``rounds`` rounds from ``start``; unused entries stay."""
    books, width = start, dims // PARTS
    for _ in range(rounds):
        sums = rows.select("_vector").mapInArrow(lambda b, books=books: _sums(b, books),
                                                 "part int, entry int, n bigint, sums array<bigint>")
        # Decimal sums: no overflow however many rows there are. At most PARTS * ENTRIES rows come back.
        total = sums.groupBy("part", "entry").agg(
            F.sum("n").alias("n"), F.array(*(F.sum(F.get("sums", F.lit(k)).cast("decimal(38,0)")) for k in range(width))).alias("sums"))
        books = books.copy()
        for r in total.collect():
            books[r["part"], r["entry"]] = [int(s) // r["n"] for s in r["sums"]]
    return books


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(rows, codebooks). Each row with a usable vector has the struct ``_row`` of all its columns, ``code`` (the numbers of
    its parts, two lowercase hexadecimal digits each) and ``error`` (squared distances of its parts to their entries, summed).

    Components become ``floor(SCALE * x)``, vectors are cut into ``PARTS`` equal parts. The codebooks start as the parts of the
    ``ENTRIES`` rows of least key (null keys last, rows of the same key by vector; fewer if the table is smaller); ``rounds`` rounds of
    nearest entry (ties to the lower number) and mean, rounded down, follow. Vectors that are null or hold a component that is
    null, NaN or infinite are left out. A vector shorter than the longest, or whose length is no multiple of ``PARTS``, is filled up with
    zeros; components beyond ``limit`` count as that limit. Repeated rows count each. Empty tables give no row and no entry.
    """
    spark = vectors.sparkSession
    spread = vectors.filter(usable(F.col(vector)))
    rows = spread.select(F.struct(*(F.col(c) for c in vectors.columns)).alias("_row"), F.col(vector).cast("array<double>").alias("_vector"))
    # The least rows: each task keeps ENTRIES of its own.
    first = (spread.select(F.col(key).alias("_key"), F.col(vector).cast("array<double>").alias("_vector"))
             .orderBy(F.col("_key").asc_nulls_last(), "_vector").limit(ENTRIES).collect())
    longest = spread.agg(F.max(F.size(vector))).first()[0] or 0
    dims = max(PARTS, -(-longest // PARTS) * PARTS)
    start = whole(pa.array([r["_vector"] for r in first], pa.list_(pa.float64())), dims)
    start = np.ascontiguousarray(start.reshape(len(first), PARTS, dims // PARTS).transpose(1, 0, 2))
    kind = rows.schema["_row"].dataType.simpleString()
    schema = f"_row {kind}, code string, error bigint"
    if not first:
        return spark.createDataFrame([], schema), start
    books = learn(rows, dims, start, rounds)
    return rows.mapInArrow(lambda b: _codes(b, books), schema), books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def with_label_error(coded: DataFrame, label: str) -> DataFrame:
    """``coded`` plus label_error: the error of all rows of the same label (field of ``_row``; null is a label).

    Errors are summed per label before anything moves; the small table of sums is joined back (a label of many rows is split by
    Spark's skew join).
    """
    coded = materialize(coded, "codes")
    mine = F.col(f"_row.{label}")
    sums = coded.groupBy(mine.alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, mine.eqNullSafe(F.col("_label")), "left").drop("_label")
