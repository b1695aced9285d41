"""Partitioning operators: keyBy, shuffle, rebalance, broadcast-to-all, parallelism."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_by(df: DataFrame, *keys: str, num_partitions: int | None = None) -> DataFrame:
    """Hash-partition by key (usually implicit in ``groupBy`` / ``join``)."""
    return df.repartition(num_partitions, *keys) if num_partitions else df.repartition(*keys)


def shuffle(df: DataFrame, num_partitions: int, seed: int = 42) -> DataFrame:
    """Random redistribution (``shuffle()``)."""
    return df.repartition(num_partitions, F.rand(seed))


def rebalance(df: DataFrame, num_partitions: int) -> DataFrame:
    """Round-robin redistribution (``rebalance()``)."""
    return df.repartition(num_partitions)


def with_parallelism(df: DataFrame, num_partitions: int) -> DataFrame:
    """Per-operator parallelism: shrink without a shuffle, grow with one."""
    return df.coalesce(num_partitions) if num_partitions == 1 else df.repartition(num_partitions)


def replicate_to(df: DataFrame, n: int) -> DataFrame:
    """``broadcast()`` partitioning: every row goes to each of ``n`` consumers.

    Expressed as a generator (``explode``), not a join, so it stays inside one
    codegen stage and never builds a cross product.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    return df.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("replica"))


def spread(df: DataFrame, num_partitions: int, within: float) -> DataFrame:
    """Per partition: does it hold its even share of the rows, give or take ``within`` of it?"""
    sizes = df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    share = total / num_partitions
    return sizes.select("partition", (F.abs(F.col("n") - share) <= within * share).alias("even"))


def owned_partitions(df: DataFrame, key: str, owners: int) -> DataFrame:
    """Rows owned by partition ``key % owners``, laid out so partition k holds owner k.

    The owner is the partition number itself; hash or range partitioning could put two
    owners into one partition.  A NULL key has owner 0.
    """
    owner = F.coalesce(F.pmod(F.col(key), F.lit(owners)), F.lit(0)).cast("int")
    owned = df.withColumn("owner", owner)
    return owned.repartitionById(owners, "owner").withColumn("partition", F.spark_partition_id())
