"""Top-N per group (per window end in the reference)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, group: list[str], order: list[Column], n: int,
          rank_col: str = "rank") -> DataFrame:
    """Keep the first ``n`` rows of each group by ``order`` (ties need a final key).

    ``row_number() <= n`` lets Catalyst insert a per-task group limit before
    the shuffle, so each task sends at most ``n`` rows per group.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)
