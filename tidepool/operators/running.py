"""Running (per-row) aggregates as a two-level prefix scan.

The reference emits one updated aggregate per input row.  The naive Spark form,
``agg.over(Window.partitionBy(k).orderBy(o))``, puts a whole key (or, for a
global aggregate, the whole table) into one task.  Here every key is split into
ordered buckets instead:

1. ``groupBy(keys, bucket)`` summarises each bucket (partial + final aggregate,
   so a hot key is pre-aggregated map-side);
2. a window over the *summary* table carries the combined value of all earlier
   buckets into each bucket (one row per bucket, so this stays small);
3. the rows are joined to their bucket's carry and finished with a window over
   ``(keys, bucket)`` only.  The join's hash partitioning on ``(keys, bucket)``
   is the partitioning the final window needs, so the big side shuffles once.

The bucket column must be non-decreasing in the row order.  With a unique,
dense id as the order (``floor(id / width)``) a bucket never holds more than
``width`` rows, whatever the key skew.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("sum", "count", "max", "min", "last", "first")

# Rows per id bucket.  A bucket is the unit of work of the final window, so
# this bounds the rows one task sorts for one key, independent of skew.
ID_BUCKET_WIDTH = 1 << 20


@dataclass(frozen=True)
class Running:
    """One running aggregate: output column, kind, and input expression."""

    name: str
    kind: str
    expr: Column | str

    def col(self) -> Column:
        return F.col(self.expr) if isinstance(self.expr, str) else self.expr


def id_bucket(id_col: str, width: int = ID_BUCKET_WIDTH) -> Column:
    """Bucket of a unique, dense id: never more than ``width`` rows."""
    return F.floor(F.col(id_col) / F.lit(width)).cast("bigint")


RANGE_BUCKET_COL = "_rbkt"
# Sampled keys per bucket when cutting an order into balanced ranges.
SAMPLE_PER_BUCKET = 32


def _numeric_key(df: DataFrame, name: str) -> Column:
    """Order-preserving, zone-free comparable form of a sort column."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col(name))
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(F.col(name))
    return F.col(name)


def range_bounds(df: DataFrame, order_by: list[str], num_buckets: int,
                 seed: int = 7) -> list[tuple]:
    """``num_buckets - 1`` cut points of the total order, from a uniform sample.

    Rows are counted first and sampled with the fraction that yields about
    ``k = num_buckets * SAMPLE_PER_BUCKET`` sort keys in all, so what reaches the
    driver depends on the buckets asked for, not on the rows or their partitions.
    """
    if num_buckets <= 1:
        return []
    keys = df.select(*[_numeric_key(df, c).alias(f"_k{i}") for i, c in enumerate(order_by)]).dropna()
    rows, k = keys.count(), num_buckets * SAMPLE_PER_BUCKET
    if rows > k:
        keys = keys.sample(False, k / rows, seed)
    sample = sorted(tuple(r) for r in keys.collect())
    if not sample:
        return []
    cuts = [sample[(i * len(sample)) // num_buckets] for i in range(1, num_buckets)]
    return sorted(set(cuts))


def with_range_buckets(df: DataFrame, order_by: list[str], num_buckets: int | None = None,
                       nulls_last: bool = False) -> DataFrame:
    """Tag rows with a balanced, order-preserving bucket, for orders with no dense id.

    The total order (end it with a unique column) is cut at sampled points, so
    buckets hold about equal row counts however skewed the leading column is:
    equal timestamps, however many, are split by the tie-breaking columns.
    The bucket is a pure function of the row over literal cut points, so every
    branch of a plan, and every recomputation after a lost executor, assigns
    the same bucket.  No shuffle is added.

    bucket = #cuts whose leading value < v  (a JVM binary search, ``Bucketizer``)
           + #cuts with leading value = v and tie-break <= the row's (only rows
             that tie a cut's leading value look this up).
    The leading column must be integral or a timestamp (exact as a double).
    NULL sort keys come first, or last with ``nulls_last``.
    """
    from collections import Counter

    from pyspark.ml.feature import Bucketizer

    spark = df.sparkSession
    n = num_buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = range_bounds(df, order_by, n)
    if not cuts:
        bucket = F.when(F.col(order_by[0]).isNull(), F.lit(1 if nulls_last else 0)).otherwise(F.lit(0))
        return df.withColumn(RANGE_BUCKET_COL, bucket.cast("bigint"))
    leads = sorted({c[0] for c in cuts})
    per_lead = Counter(c[0] for c in cuts)
    prefix = [0]
    for d in leads:
        prefix.append(prefix[-1] + per_lead[d])

    lead = _numeric_key(df, order_by[0]).cast("bigint")
    staged = df.withColumn("_rlead", lead.cast("double"))
    splits = [-float("inf")] + [d + 0.5 for d in leads] + [float("inf")]
    staged = Bucketizer(splits=splits, inputCol="_rlead", outputCol="_ridx",
                        handleInvalid="keep").transform(staged)
    idx = F.col("_ridx").cast("int")
    # Cut tables enter the plan as one literal each (the JSON one is constant
    # folded), so building the query costs the same for any bucket count.
    below = F.element_at(F.lit(prefix).cast("array<bigint>"), idx + 1)
    next_lead = F.try_element_at(F.lit(leads).cast("array<bigint>"), idx + 1)

    rest = order_by[1:]
    if rest:
        names = [f"_k{i}" for i in range(len(rest))]
        types = [df.select(_numeric_key(df, c)).schema[0].dataType for c in rest]
        # Structs compare field by field, NULL lowest; a flag ahead of each field puts NULL where it belongs.
        flag = [F.when(_numeric_key(df, c).isNull(), F.lit(1 if nulls_last else -1)).otherwise(F.lit(0)) for c in rest]
        row_rest = F.struct(*[x for f, c, nm in zip(flag, rest, names) for x in (f.alias(f"{nm}n"), _numeric_key(df, c).alias(nm))])
        by_lead: dict = {d: [] for d in leads}
        for c in cuts:
            by_lead[c[0]].append({k: v for nm, x in zip(names, c[1:]) for k, v in ((f"{nm}n", 0), (nm, x))})
        nested = list(by_lead.values())
        ddl = "array<array<struct<" + ", ".join(f"{nm}n: int, {nm}: {t.simpleString()}" for nm, t in zip(names, types)) + ">>>"
        rests = F.from_json(F.lit(json.dumps(nested)), ddl)
        tied = F.size(F.filter(F.try_element_at(rests, idx + 1), lambda x: x <= row_rest))
    else:
        tied = F.try_element_at(F.lit([per_lead[d] for d in leads]).cast("array<bigint>"), idx + 1)
    # NULL sort keys: bucket 0, or one past all others.
    bucket = F.when(lead.isNull(), F.lit(len(cuts) + 1 if nulls_last else 0)).otherwise(
        below + F.when(lead == next_lead, tied).otherwise(F.lit(0)))
    return staged.withColumn(RANGE_BUCKET_COL, bucket.cast("bigint")).drop("_rlead", "_ridx")


def range_bucket() -> Column:
    return F.col(RANGE_BUCKET_COL)


def _bucket_summary(spec: Running, order_struct: Column) -> Column:
    c = spec.col()
    tag = f"_s_{spec.name}"
    if spec.kind == "sum":
        return F.sum(c).alias(tag)
    if spec.kind == "count":
        return F.count(c).alias(tag)
    if spec.kind == "max":
        return F.max(c).alias(tag)
    if spec.kind == "min":
        return F.min(c).alias(tag)
    if spec.kind == "last":
        return F.max_by(c, F.when(c.isNotNull(), order_struct)).alias(tag)
    if spec.kind == "first":
        return F.min_by(c, F.when(c.isNotNull(), order_struct)).alias(tag)
    raise ValueError(f"unknown running kind {spec.kind!r}; expected one of {KINDS}")


def _carry(spec: Running, w) -> Column:
    s = F.col(f"_s_{spec.name}")
    tag = f"_c_{spec.name}"
    if spec.kind in ("sum", "count"):
        return F.sum(s).over(w).alias(tag)
    if spec.kind == "max":
        return F.max(s).over(w).alias(tag)
    if spec.kind == "min":
        return F.min(s).over(w).alias(tag)
    if spec.kind == "last":
        return F.last(s, ignorenulls=True).over(w).alias(tag)
    return F.first(s, ignorenulls=True).over(w).alias(tag)


def _finish(spec: Running, w) -> Column:
    c = spec.col()
    carry = F.col(f"_c_{spec.name}")
    if spec.kind == "sum":
        inner = F.sum(c).over(w)
        out = F.when(carry.isNull() & inner.isNull(), F.lit(None)).otherwise(
            F.coalesce(carry, F.lit(0)) + F.coalesce(inner, F.lit(0)))
    elif spec.kind == "count":
        out = F.coalesce(carry, F.lit(0)) + F.count(c).over(w)
    elif spec.kind == "max":
        out = F.greatest(carry, F.max(c).over(w))
    elif spec.kind == "min":
        out = F.least(carry, F.min(c).over(w))
    elif spec.kind == "last":
        out = F.coalesce(F.last(c, ignorenulls=True).over(w), carry)
    else:
        out = F.coalesce(carry, F.first(c, ignorenulls=True).over(w))
    return out.alias(spec.name)


@dataclass(frozen=True)
class _Scan:
    """The parts of a running scan: tagged rows, one summary row per (keys, bucket), what lies before each of them."""

    rows: DataFrame
    summary: DataFrame
    before: object


def _scan(df: DataFrame, order_by, specs, keys, bucket, nulls_last, carry: DataFrame | None) -> _Scan:
    def asc(c: Column) -> Column:
        return c.asc_nulls_last() if nulls_last else c.asc_nulls_first()

    nulls = F.lit(1 if nulls_last else -1)
    order_struct = F.struct(*[x for c in order_by for x in (F.when(F.col(c).isNull(), nulls).otherwise(F.lit(0)), F.col(c))])
    # Keys and bucket as one struct: never NULL itself, so the join keeps rows with NULL inside, and the
    # join's partitioning is still the window's.
    group = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], bucket.cast("bigint").alias("bkt"))
    b = df.withColumn("_grp", group)
    summary = b.groupBy("_grp").agg(*[_bucket_summary(s, order_struct) for s in specs]).withColumn("_carried", F.lit(False))
    if carry is not None:
        # What earlier rows left per key comes before every bucket of the key.
        group = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.lit(None).cast("bigint").alias("bkt"))
        summary = summary.unionByName(carry.select(group.alias("_grp"), *[f"_s_{s.name}" for s in specs], F.lit(True).alias("_carried")))
    # In the order of buckets; what was carried comes first.
    before = (Window.partitionBy(*[F.col(f"_grp.k{i}") for i in range(len(keys))])
              .orderBy(F.col("_carried").desc(), asc(F.col("_grp.bkt"))).rowsBetween(Window.unboundedPreceding, -1))
    return _Scan(b, summary, before)


def running(df: DataFrame, order_by: list[str], specs: list[Running], *,
            partition_by: list[str] | tuple = (), bucket: Column,
            include_current: bool = True, nulls_last: bool = False, carry: DataFrame | None = None) -> DataFrame:
    """Append running aggregates to every row of ``df``.

    ``include_current=False`` gives the value over rows strictly before the
    current one (e.g. the watermark a row sees on arrival).  NULL keys are a key
    like any other; NULL order values (and a NULL bucket) come first, or last with ``nulls_last``.
    ``carry`` continues a scan over earlier rows: what :func:`carry_after` gave for them.
    """
    keys = list(partition_by)
    scan = _scan(df, order_by, specs, keys, bucket, nulls_last, carry)
    ahead = scan.summary.select("_grp", "_carried", *[_carry(s, scan.before) for s in specs]).filter(~F.col("_carried")).drop("_carried")

    joined = scan.rows.join(ahead, on="_grp", how="inner")
    upper = Window.currentRow if include_current else -1
    asc = [F.col(c).asc_nulls_last() if nulls_last else F.col(c).asc_nulls_first() for c in order_by]
    w_in = Window.partitionBy("_grp").orderBy(*asc).rowsBetween(Window.unboundedPreceding, upper)
    out_cols = [F.col(c) for c in df.columns]
    return joined.select(*out_cols, *[_finish(s, w_in) for s in specs])


def carry_after(df: DataFrame, order_by: list[str], specs: list[Running], *, partition_by: list[str] | tuple = (),
                bucket: Column, nulls_last: bool = False, carry: DataFrame | None = None) -> DataFrame:
    """One row per key: what a scan over later rows has to carry (the keys and ``_s_<name>``)."""
    keys = list(partition_by)
    scan = _scan(df, order_by, specs, keys, bucket, nulls_last, carry)
    place = F.struct((~F.col("_carried")).alias("later"), F.when(F.col("_grp.bkt").isNull(), F.lit(1 if nulls_last else -1)).otherwise(0),
                     F.col("_grp.bkt"))

    def total(spec: Running) -> Column:
        s = F.col(f"_s_{spec.name}")
        if spec.kind in ("sum", "count"):
            out = F.sum(s)
        elif spec.kind in ("max", "min"):
            out = F.max(s) if spec.kind == "max" else F.min(s)
        else:
            pick = F.max_by if spec.kind == "last" else F.min_by
            out = pick(s, F.when(s.isNotNull(), place))
        return out.alias(f"_s_{spec.name}")

    per_key = scan.summary.groupBy(*[F.col(f"_grp.k{i}").alias(k) for i, k in enumerate(keys)]).agg(*[total(s) for s in specs])
    return per_key.select(*keys, *[f"_s_{s.name}" for s in specs])
