"""Scans of the parquet tables.

Only a path and a table name: projection and filters stay lazy so Catalyst
pushes them into the parquet reader (see ``PushedFilters`` / ``ReadSchema``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.session import ensure_utc

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan a table. How many splits it is read in is for ``spark.sql.files.maxPartitionBytes``."""
    ensure_utc(spark)
    return spark.read.parquet(table_path(sf_dir, name))


def clicks(events: DataFrame) -> DataFrame:
    """Events seen as the click record: user, url, event time, integer cents.

    Money is carried as integer cents so sums are exact and engine independent.
    """
    return events.select(
        "event_id", "ts", "user_id", "event_type",
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
    )
