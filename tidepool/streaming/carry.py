"""State carried from micro-batch to micro-batch as tables.

A step of a stream that no built-in streaming operator expresses is written with batch operators: it joins a micro-batch
with the state the batch before left and leaves its own. The state is a table in the shared checkpoint folder,
one version per epoch. Epoch e reads version e - 1 and writes version e in overwrite mode, so an epoch that is
run again after a failure finds what it found before and leaves what it left before.

* :class:`EpochTable`: a table that every epoch writes whole (open rows, one watermark).
* :class:`KeyedTable`: rows by key in hash buckets; an epoch writes the buckets it touches, a manifest names
  each bucket's version.
* :class:`StreamWatermark`: the watermark each row meets, over all micro-batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.timecols import epoch_micros, ntz_from_micros
from tidepool.operators import eventtime
from tidepool.operators.eventtime import ONE_MS
from tidepool.session import scratch_path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that no version needs any more (nothing happens if it is gone)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class EpochTable:
    """A table of which every epoch writes a version; the last two are kept."""

    def __init__(self, spark: SparkSession, schema: T.StructType, path: str | None = None, name: str = "state"):
        self.spark, self.schema = spark, schema
        self.path = path or scratch_path(spark, name)

    def before(self, epoch: int) -> DataFrame:
        if epoch == 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/epoch={epoch - 1}")

    def write(self, df: DataFrame, epoch: int) -> DataFrame:
        path = f"{self.path}/epoch={epoch}"
        df.write.mode("overwrite").parquet(path)
        if epoch > 1:
            remove_folder(self.spark, f"{self.path}/epoch={epoch - 2}")
        return self.spark.read.schema(self.schema).parquet(path)


def key_of(keys: list[str]) -> Column:
    """The keys as one struct: never NULL itself, so that NULL keys join and group like any other."""
    return F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]) if keys else F.struct(F.lit(0).alias("k0"))


class KeyedTable:
    """One row per key, upserted per epoch.

    Rows are in ``buckets`` hash buckets of their key. An epoch rewrites the buckets that hold a key of its batch,
    to a folder of its own; its manifest says which folder each bucket is in. Folders that the last two manifests do not name are deleted.
    """

    MANIFEST = "bucket int, version bigint"

    def __init__(self, spark: SparkSession, schema: T.StructType, keys: list[str], buckets: int | None = None,
                 path: str | None = None, name: str = "keyed"):
        self.spark, self.schema, self.keys = spark, schema, keys
        self.buckets = buckets or (int(spark.conf.get("spark.sql.shuffle.partitions")) if keys else 1)
        self.path = path or scratch_path(spark, name)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(key_of(self.keys)), F.lit(self.buckets)).cast("int")

    def manifest(self, epoch: int) -> dict[int, int]:
        """Bucket -> version after ``epoch``: at most ``buckets`` entries."""
        if epoch < 0:
            return {}
        rows = self.spark.read.schema(self.MANIFEST).parquet(f"{self.path}/manifest/epoch={epoch}").collect()
        return {r["bucket"]: r["version"] for r in rows}

    def _rows(self, versions: dict[int, int]) -> DataFrame:
        paths = [f"{self.path}/version={v}/bucket={b}" for b, v in sorted(versions.items())]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self, epoch: int) -> DataFrame:
        """All rows as they were after ``epoch``."""
        return self._rows(self.manifest(epoch))

    def update(self, keys_of: DataFrame, epoch: int, change: Callable[[DataFrame], DataFrame]) -> None:
        """``change(old)`` replaces the rows of every bucket that holds a key of ``keys_of``; ``old`` has these
        buckets' rows as the epoch before left them."""
        had = self.manifest(epoch - 1)
        touched = {r[0] for r in keys_of.select(self.bucket().alias("b")).distinct().collect()}
        new = change(self._rows({b: v for b, v in had.items() if b in touched}))
        new = new.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]).withColumn("bucket", self.bucket())
        # One task writes a bucket: its rows are hash partitioned by it.
        folder = f"{self.path}/version={epoch}"
        new.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)
        filled = {r[0] for r in self.spark.read.parquet(folder).select("bucket").distinct().collect()} if touched and not new.isEmpty() else set()
        now = {b: v for b, v in had.items() if b not in touched} | dict.fromkeys(filled, epoch)
        rows = [(int(b), int(v)) for b, v in sorted(now.items())]
        self.spark.createDataFrame(rows, self.MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/epoch={epoch}")
        if epoch > 1:
            for version in set(self.manifest(epoch - 2).values()) - set(had.values()) - set(now.values()):
                remove_folder(self.spark, f"{self.path}/version={version}")

    def upsert(self, batch: DataFrame, epoch: int) -> None:
        """The batch's row of a key replaces the one before (update-mode output: one row per key and batch)."""
        def change(old: DataFrame) -> DataFrame:
            fresh = batch.select(key_of(self.keys).alias("_key")).distinct()
            kept = old.withColumn("_key", key_of(self.keys)).join(fresh, "_key", "left_anti").drop("_key")
            return kept.unionByName(batch.select(*self.schema.names))

        self.update(batch, epoch, change)


class StreamWatermark:
    """The stream's own watermark: the greatest event time of all rows that arrived before, less the delay and 1 ms.

    Inside a batch it is a prefix maximum over the arrival order (``eventtime.watermark_trace``); between batches the
    greatest time so far is carried, one row. Batches have to come in arrival order.
    """

    SCHEMA = T.StructType([T.StructField("max_us", T.LongType())])

    def __init__(self, spark: SparkSession, ts: str, arrival: list[str], delay_us: int):
        self.spark, self.ts, self.arrival, self.delay_us = spark, ts, arrival, delay_us
        self.state = EpochTable(spark, self.SCHEMA, name="watermark")

    def advance(self, batch: DataFrame, epoch: int) -> tuple[int | None, int | None]:
        """(watermark before the batch, watermark after it), in epoch microseconds; None before any row."""
        row = self.state.before(epoch).first()
        before = row["max_us"] if row else None
        inside = batch.agg(F.max(epoch_micros(self.ts))).first()[0]
        seen = [x for x in (before, inside) if x is not None]
        after = max(seen) if seen else None
        self.state.write(self.spark.createDataFrame([(after,)], self.SCHEMA), epoch)
        back = self.delay_us + ONE_MS
        return (None if before is None else before - back, None if after is None else after - back)

    def trace(self, batch: DataFrame, epoch: int) -> tuple[DataFrame, int | None]:
        """(``batch`` with ``wm``, the watermark each row meets; watermark after the batch in epoch microseconds)."""
        before, after = self.advance(batch, epoch)
        traced = eventtime.watermark_trace(batch, self.ts, self.arrival, self.delay_us)
        if before is not None:
            traced = traced.withColumn("wm", F.greatest("wm", ntz_from_micros(F.lit(before).cast("bigint"))))
        return traced, after
