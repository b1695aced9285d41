"""Row projections, filters and row expansion (map / filter / flatMap)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions.text import split_on_space


def filter_map_pair(df: DataFrame, value: str, threshold: int, keep: list[str]) -> DataFrame:
    """``filter(v > threshold)`` then ``map(v -> (v, v))``; the filter reaches the scan."""
    return df.filter(F.col(value) > threshold).select(
        *keep, F.col(value).alias("a"), F.col(value).alias("b"))


def tokens(df: DataFrame, text: str, keep: list[str] = ()) -> DataFrame:
    """flatMap a line into one row per space-separated token."""
    return df.select(*keep, F.explode(split_on_space(text)).alias("word"))


def word_count(df: DataFrame, text: str) -> DataFrame:
    """Final keyed reduce of (word, 1): partial counts are combined map-side,
    so frequent words never concentrate raw rows in one task."""
    return tokens(df, text).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def replicate_by_rule(df: DataFrame, col: str, copies: dict[str, int], keep: list[str]) -> DataFrame:
    """flatMap that emits each row ``copies[value]`` times (0 drops it).

    Values missing from ``copies`` are dropped, as in the reference's
    if / else-if chain with no else branch.
    """
    n = F.lit(0)
    for value, k in reversed(list(copies.items())):
        n = F.when(F.col(col) == value, F.lit(int(k))).otherwise(n)
    return df.select(*keep, F.posexplode(F.array_repeat(F.lit(True), n)).alias("copy", "_t")).drop("_t")


def square(df: DataFrame, col: str, keep: list[str]) -> DataFrame:
    """map(i -> i*i) as a JVM expression (the fast path)."""
    return df.select(*keep, (F.col(col).cast("bigint") * F.col(col).cast("bigint")).alias("sq"))


def map_with_setup(df: DataFrame, col: str, keep: list[str],
                   setup: Callable[[], object] | None = None,
                   teardown: Callable[[object], None] | None = None,
                   apply: Callable[[object, object], object] | None = None) -> DataFrame:
    """A rich map: per-partition setup, a vectorised map per Arrow batch, teardown.

    ``apply(handle, values)`` maps an Arrow array of int64 to one (None: squares).

    Spark calls the function once per partition with an iterator of Arrow
    record batches, so ``setup`` / ``teardown`` run once per task, like the
    reference's open/close.  Use :func:`square` when no setup is needed.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    out_schema = df.select(*keep, F.lit(0).cast("bigint").alias("sq")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handle = setup() if setup else None
        try:
            for rb in batches:
                v = rb.column(col).cast(pa.int64())
                cols = [rb.column(k) for k in keep] + [apply(handle, v) if apply else pc.multiply(v, v)]
                yield pa.RecordBatch.from_arrays(cols, names=list(keep) + ["sq"])
        finally:
            if teardown:
                teardown(handle)

    return df.select(*dict.fromkeys(list(keep) + [col])).mapInArrow(run, out_schema)


def keyed_lines(df: DataFrame, key: Column, seconds: Column, keep: list[str] = ()) -> DataFrame:
    """Render rows as the reference's ``"key seconds"`` text lines; a NULL is an empty field."""
    fields = [F.coalesce(c.cast("string"), F.lit("")) for c in (key, seconds)]
    return df.select(*keep, F.concat_ws(" ", *fields).alias("value"))


def parse_keyed_lines(lines: DataFrame, keep: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Parse ``"key seconds"`` lines into ``(key, ts_ms)``.

    Returns ``(parsed, quarantine)``: a line without a second field or with a
    non-integer one goes to ``quarantine`` instead of failing the job.  An empty key is NULL.
    """
    key = F.nullif(F.split(F.col("value"), " ").getItem(0), F.lit(""))
    secs = F.expr("try_cast(try_element_at(split(value, ' '), 2) AS BIGINT)")
    staged = lines.select(*keep, "value", key.alias("key"), secs.alias("_secs"))
    ok = F.col("_secs").isNotNull()
    parsed = staged.filter(ok).select(*keep, "key", (F.col("_secs") * 1000).alias("ts_ms"))
    quarantine = staged.filter(~ok).select(*keep, "value")
    return parsed, quarantine


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Positional-style rename on table creation (``$("f0").as("user")``)."""
    return df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])
