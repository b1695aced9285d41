"""Changelog (retract) output of a continuously updated group count.

A grouped count over a stream is an updating table.  Its changelog has, per
input row, ``+I`` for the first row of a key, otherwise ``-U`` (the old count)
followed by ``+U`` (the new count).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.operators.running import Running, running


def changelog_ops(count: Column) -> Column:
    """The changelog rows for a running count value, as an array of structs."""
    def row(op, cnt, seq):
        return F.struct(F.lit(op).alias("op"), cnt.alias("cnt"), F.lit(seq).alias("op_seq"))

    return F.when(count == 1, F.array(row("+I", count, 0))).otherwise(
        F.array(row("-U", count - 1, 0), row("+U", count, 1)))


def changelog(df: DataFrame, key: str, order: str, bucket: Column) -> DataFrame:
    """Changelog of ``SELECT key, COUNT(*) GROUP BY key`` in ``order`` of arrival."""
    counted = running(df.select(order, key), [order], [Running("_cnt", "count", F.lit(1))],
                      partition_by=[key], bucket=bucket, nulls_last=True)
    return counted.select(order, key, F.inline(changelog_ops(F.col("_cnt"))))
