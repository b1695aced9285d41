"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.session import ensure_utc, materialize

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = "\t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(column: str) -> Column:
    """The text, empty if null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of a text (JVM side, no regular expression per character)."""
    return F.array_remove(F.split(F.translate(text, WHITE, " " * len(WHITE)), " "), "")


def give_back() -> None:
    """Return freed memory to the system: Arrow's, and the C library's where it can (an idle Python worker would hold both)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def giving_back(rows: Iterator) -> Iterator:
    """The batches of a Python task; freed memory goes back at its end, before the worker idles beside other stages."""
    try:
        yield from rows
    finally:
        give_back()


def hash60(*parts: Column) -> Column:
    """60 bits of md5 over the parts joined by ``|``: the same number in any engine.

    A null part is written as ``\\N``, so it differs from the empty string.
    """
    text = F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("\\N")) for p in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def running_before(df: DataFrame, keys: list[str], order: list[str], totals: dict[str, str]) -> DataFrame:
    """Rows plus, per entry ``name -> column`` of ``totals``, the sum of ``column`` over the
    rows of the same ``keys`` that come before in ``order`` (``None`` counts rows).

    No key's rows meet in one task: the table is range-sorted by (keys, order), so a hot key
    spans many ranges; sums run inside (range, keys) and the small table of sums per
    (range, keys) supplies what lies before. Rows that agree in keys and order are one
    range, in any order: pass an order without ties for a repeatable result.
    """
    values = {n: F.lit(1).cast("long") if c is None else F.coalesce(F.col(c), F.lit(0)).cast("long")
              for n, c in totals.items()}
    by = [F.col(c).asc_nulls_last() for c in (*keys, *order)]
    laid = df.repartitionByRange(*by).sortWithinPartitions(*by)
    laid = laid.withColumn("_at", F.monotonically_increasing_id())
    laid = laid.withColumn("_part", F.shiftright("_at", 33))
    laid = materialize(laid, "ranges")
    sums = laid.groupBy("_part", *keys).agg(*(F.sum(v).alias(f"_{n}") for n, v in values.items()))
    # One row per range and key that meets it: ranges + keys rows in all.
    earlier = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy("_part")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("_part").alias("_p"), *(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)),
                       *(F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in values))
    inside = Window.partitionBy("_part", *keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    run = laid.withColumns({n: F.coalesce(F.sum(v).over(inside), F.lit(0)) for n, v in values.items()})
    on = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    out = run.join(sums, on)
    return out.select(*df.columns, *((F.col(n) + F.col(f"_{n}")).alias(n) for n in values))
