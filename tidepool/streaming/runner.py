"""Run a streaming query to completion over the data available now.

Streaming twins read the tables as file streams, run with
``trigger(availableNow=True)`` and write to a sink under the shared checkpoint
folder; the result is read back as a batch DataFrame.  Checkpoints live in the
same shared folder, so a restarted driver resumes where the query stopped.
"""

from __future__ import annotations

import datetime as dt
import threading
import time
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.timecols import epoch_micros
from tidepool.session import STATE_STORE_KEY, STATE_STORE_PROVIDER, ensure_utc, scratch_path
from tidepool.sources.tables import table_path

# Event time of the end-of-input marker.  A bounded source ends with a maximal
# watermark so every window fires; a file stream does not, so one row this far
# in the future is appended to move the watermark past every real window (it
# stays inside the nanosecond range pandas uses inside stateful processors).
SENTINEL_TS = dt.datetime(2200, 1, 1)

CHANGELOG_KEY = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


#: Marks the end-of-input row; real rows have FALSE, whatever their other columns hold.
END_COL = "is_end"


def table_stream(spark: SparkSession, sf_dir: str, name: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A table file read as a stream (schema taken from the file footer, not inferred from rows)."""
    ensure_utc(spark)
    path = table_path(sf_dir, name)
    schema = spark.read.parquet(path).schema
    # A glob turns the single file into a pattern the file source can list.
    pattern = path[:-1] + "[" + path[-1] + "]"
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(pattern)


class EndMarker:
    """The end of a bounded input: one row far in the future, in a source of its own.

    The source is empty while the input is read, however many micro-batches that takes.
    ``deliver`` then adds the row, and another run on the same checkpoint reads it, which
    moves the watermark past every real window.
    """

    def __init__(self, spark: SparkSession, schema: T.StructType, ts: str, inputs: tuple = ()):
        self.spark, self.ts, self.inputs = spark, ts, tuple(inputs)
        self.schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
        self.folder = scratch_path(spark, "end-marker")
        spark.createDataFrame([], self.schema).write.parquet(self.folder)

    def stream(self) -> DataFrame:
        return self.spark.readStream.schema(self.schema).parquet(self.folder)

    def deliver(self) -> None:
        row = {f.name: None for f in self.schema.fields} | {self.ts: SENTINEL_TS, END_COL: True}
        rows = [tuple(row[f.name] for f in self.schema.fields)]
        self.spark.createDataFrame(rows, self.schema).write.mode("append").parquet(self.folder)


class OrderedInput:
    """All rows of a table as a stream, in the order of ``by`` (a time or a number), over ``batches`` micro-batches.

    The rows arrive slice by slice: ``deliver(k)`` adds those between two cut points to the folder that the stream reads, as new
    files, and the next run of the query on the same checkpoint takes them as one micro-batch. So order
    does not depend on what a store says about its files, a slice has as many tasks as the table has splits there,
    and a scan per slice reads the row groups of its range. The cut points are approximate quantiles: ``batches`` numbers on the driver. All
    rows of one value are in one slice; NULL comes first, or last with ``nulls_last``.
    """

    def __init__(self, spark: SparkSession, df: DataFrame, by: str, batches: int, nulls_last: bool = False):
        ensure_utc(spark)
        self.spark, self.df, self.nulls_last = spark, df, nulls_last
        kind = df.schema[by].dataType
        self.by = epoch_micros(by) if isinstance(kind, T.TimestampNTZType) else F.unix_micros(by) if isinstance(kind, T.TimestampType) else F.col(by)
        shares = [k / batches for k in range(1, batches)]
        cuts = df.select(self.by.cast("double").alias("v")).approxQuantile("v", shares, 0.01) if shares else []
        self.edges = [None, *sorted(set(cuts)), None]
        self.folder = scratch_path(spark, "input")
        spark.createDataFrame([], df.schema).write.parquet(self.folder)

    def __len__(self) -> int:
        return len(self.edges) - 1

    def stream(self) -> DataFrame:
        return self.spark.readStream.schema(self.df.schema).parquet(self.folder)

    def deliver(self, k: int) -> None:
        if k >= len(self):
            return
        low, high = self.edges[k], self.edges[k + 1]
        inside = F.lit(True)
        if low is not None:
            inside = inside & (self.by >= F.lit(int(low)))
        if high is not None:
            inside = inside & (self.by < F.lit(int(high)))
        nulls = self.by.isNull() if k == (len(self) - 1 if self.nulls_last else 0) else F.lit(False)
        self.df.filter(nulls | (self.by.isNotNull() & inside)).write.mode("append").parquet(self.folder)


def with_end_marker(spark: SparkSession, stream: DataFrame | OrderedInput, ts: str) -> tuple[DataFrame, EndMarker]:
    """``stream`` plus ``is_end`` and the source of its end marker; hand the marker to ``run_to_table``."""
    inputs = (stream,) if isinstance(stream, OrderedInput) else ()
    flagged = (stream.stream() if inputs else stream).withColumn(END_COL, F.lit(False))
    end = EndMarker(spark, flagged.schema, ts, inputs)
    return flagged.unionByName(end.stream()), end


def replay_files(spark: SparkSession, df: DataFrame, order_col: str, n_files: int, path: str) -> str:
    """Write ``df`` as ``n_files`` parquet files in ``order_col`` order, one after another.

    Read back with ``maxFilesPerTrigger=1`` this replays the table as a stream
    of ``n_files`` micro-batches in arrival order (file streams take files in
    modification-time order).  For tests on small tables only: each file is written by one task.
    """
    lo, hi = df.select(F.min(order_col), F.max(order_col)).first()
    if lo is None:
        return path
    width = (hi - lo) // n_files + 1
    for i in range(n_files):
        chunk = df.filter((F.col(order_col) >= lo + i * width) & (F.col(order_col) < lo + (i + 1) * width))
        chunk.coalesce(1).write.mode("append").parquet(path)
    return path


def replay_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """One replay file per micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


#: Rows of a replay file, about; and files of a micro-batch at most.
REPLAY_ROWS, REPLAY_FILES = 1 << 17, 16


def time_ordered_stream(spark: SparkSession, df: DataFrame, ts: str, batches: int, rows: int = REPLAY_ROWS) -> DataFrame:
    """All rows of ``df`` as a stream in the order of ``ts``, over ``batches`` micro-batches or more.

    The table is written once, range-sorted, to files of about ``rows`` rows (all rows of one time are in one file,
    null times come first). A file stream takes files by modification time, so that is set to follow the
    order of the ranges; where a store does not keep it, all files are one micro-batch, in which no row is late.
    """
    path = scratch_path(spark, "replay")
    n_files = max(batches, -(-df.count() // rows))
    df.repartitionByRange(n_files, F.col(ts).asc_nulls_first()).write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def files():
        found = [s for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")]
        return sorted(found, key=lambda s: (int(s.getPath().getName().split("-")[1]), s.getPath().getName()))

    first = files()
    begin = max((s.getModificationTime() for s in first), default=0) // 1000 * 1000 - 1000 * len(first)
    for k, s in enumerate(first):
        fs.setTimes(s.getPath(), begin + 1000 * k, -1)
    kept = [s.getModificationTime() for s in files()] == [begin + 1000 * k for k in range(len(first))]
    reader = spark.readStream.schema(df.schema).option("maxFileAge", f"{len(first) + 604_800}s")
    if kept:
        reader = reader.option("maxFilesPerTrigger", max(1, min(REPLAY_FILES, len(first) // batches)))
    return reader.parquet(path)


def event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ); the session zone is UTC."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


#: Settings are read when a query starts; queries started by several threads take turns.
_STARTING = threading.Lock()
NO_DATA_KEY = "spark.sql.streaming.noDataMicroBatches.enabled"


@contextmanager
def _starting(spark: SparkSession, rocksdb: bool, last: bool = True):
    """The session while a query starts: RocksDB (committing only each batch's changes) for queries that need it
    (stateful processors); no micro-batch without data except after the last slice. Then the session's own settings again."""
    wanted = {STATE_STORE_KEY: STATE_STORE_PROVIDER, CHANGELOG_KEY: "true"} if rocksdb else {}
    if not last:
        wanted[NO_DATA_KEY] = "false"
    with _STARTING:
        before = {key: spark.conf.get(key, None) for key in wanted}
        for key, value in wanted.items():
            spark.conf.set(key, value)
        try:
            yield
        finally:
            for key, value in before.items():
                if value is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, value)


def run_to_table(spark: SparkSession, query: DataFrame, name: str, output_mode: str = "append",
                 per_batch: Callable[[DataFrame], DataFrame] | None = None,
                 rocksdb: bool = False,
                 per_batch_sink: Callable[[DataFrame, int], None] | None = None,
                 end: EndMarker | None = None, key: list[str] | None = None, inputs: tuple[OrderedInput, ...] = ()) -> DataFrame:
    """Run ``query`` until the available input is consumed; return what it wrote.

    ``inputs`` (or those of ``end``) are delivered slice by slice, each slice read by a run of its own on the same checkpoint.

    With ``end``, the end marker is delivered after that and read by another run on the same
    checkpoint; its own result rows (``is_end``) are left out of what was written, not inside the query, where
    Catalyst would push the filter below the watermark and the marker would never count.

    With ``key``, ``update`` results are merged into one row per key (:class:`~tidepool.streaming.carry.KeyedTable`):
    an epoch rewrites the key buckets it touches, and run again it changes nothing.

    ``append`` results go to a parquet file sink (exactly-once through the
    sink's commit log).  ``update`` / ``complete`` results, or any query with a
    ``per_batch`` step, go through ``foreachBatch``: ``complete`` overwrites the
    table each batch, the others append the (transformed) batch.
    """
    out = scratch_path(spark, f"out-{name}")
    ckpt = scratch_path(spark, f"ckpt-{name}")

    epochs: list[int] = []
    table = None

    def real(rows: DataFrame) -> DataFrame:
        return rows.filter(~F.col(END_COL)).drop(END_COL) if END_COL in rows.columns else rows

    def sink(batch: DataFrame, epoch: int) -> None:
        batch = real(batch)
        result = per_batch(batch) if per_batch else batch
        if table is not None:
            table.upsert(result, epoch)
            epochs.append(epoch)
        elif output_mode == "complete":
            result.write.mode("overwrite").parquet(out)
        else:
            write_epoch(result, out, epoch)

    def run(last: bool = True) -> None:
        writer = query.writeStream.option("checkpointLocation", ckpt).outputMode(output_mode)
        if per_batch_sink is not None:
            writer = writer.foreachBatch(per_batch_sink)
        elif per_batch is None and output_mode == "append":
            writer = writer.format("parquet").option("path", out)
        else:
            writer = writer.foreachBatch(sink)
        with _starting(spark, rocksdb, last):
            handle = writer.trigger(availableNow=True).start()
        handle.awaitTermination()
        if handle.exception():
            raise handle.exception()

    empty = spark.createDataFrame([], query.schema)
    expected = (per_batch(real(empty)) if per_batch else real(empty)).schema
    if key is not None:
        from tidepool.streaming.carry import KeyedTable

        table = KeyedTable(spark, expected, key, path=out)
    inputs = tuple(inputs) + (end.inputs if end is not None else ())
    slices = max((len(i) for i in inputs), default=0)
    for k in range(slices):
        for i in inputs:
            i.deliver(k)
        if end is not None and k == slices - 1:
            end.deliver()  # with the last rows: the watermark moves after their micro-batch
        run(last=k == slices - 1)
    if not slices:
        run()
        if end is not None:
            end.deliver()
            run()
    if table is not None:
        return table.read(epochs[-1]) if epochs else spark.createDataFrame([], expected)
    return read_epochs(spark, out, expected)


def run_live(spark: SparkSession, query: DataFrame, name: str, last_due: Callable[[DataFrame], int | None],
             trigger: str = "500 milliseconds", timeout_s: float = 900) -> DataFrame:
    """Run a query with processing-time timers on a live trigger until its last timer has fired; return what it wrote.

    Once a micro-batch finds no more input, ``last_due(rows written)`` says when the last timer is due (epoch ms, None: no timer). The query is
    stopped after the first micro-batch that started later than that.
    """
    out, ckpt = scratch_path(spark, f"out-{name}"), scratch_path(spark, f"ckpt-{name}")
    writer = query.writeStream.option("checkpointLocation", ckpt).outputMode("append").foreachBatch(lambda b, e: write_epoch(b, out, e))
    with _starting(spark, rocksdb=True):
        handle = writer.trigger(processingTime=trigger).start()
    give_up, due = time.monotonic() + timeout_s, None
    try:
        while True:
            if not handle.isActive and handle.exception():
                raise handle.exception()
            if time.monotonic() > give_up:
                raise TimeoutError(f"{name}: timers still pending after {timeout_s} s")
            seen = handle.lastProgress
            if seen is not None and seen["numInputRows"] == 0:
                if due is None:
                    due = last_due(read_epochs(spark, out, query.schema))
                    if due is None:
                        break
                started = dt.datetime.fromisoformat(seen["timestamp"].replace("Z", "+00:00"))
                if started.timestamp() * 1000 > due + 1:
                    break
            time.sleep(0.2)
        for _ in range(250):  # between two micro-batches, if there is such a time: nothing has to be broken off
            if not handle.status["isTriggerActive"]:
                break
            time.sleep(0.02)
    finally:
        handle.stop()
    return read_epochs(spark, out, query.schema)


def write_epoch(df: DataFrame, path: str, epoch: int) -> None:
    """Idempotent micro-batch write: a retried epoch overwrites its own folder."""
    df.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")


def read_epochs(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read a sink written by the file sink or by :func:`write_epoch` (epoch column dropped).

    A sink without a single row (no folder, or no data files in it) is an empty result; anything
    else that goes wrong is an error.
    """
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return spark.createDataFrame([], schema)
        raise
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
