"""The five-column user-behaviour CSV log (user,item,category,behaviour,epoch-seconds)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.timecols import epoch_seconds, ntz_from_seconds
from tidepool.schemas import USER_BEHAVIOR_CSV


def write_behavior_csv(events: DataFrame, path: str) -> str:
    """Render events as the behaviour log: user, item (event id), category and
    behaviour (event type), event time in whole epoch seconds."""
    (events.select(
        F.col("user_id"), F.col("event_id").alias("item_id"), F.col("event_type").alias("category_id"),
        F.col("event_type").alias("behavior"), epoch_seconds("ts").alias("epoch_s"))
     .write.mode("overwrite").option("header", "false").csv(path))
    return path


#: The log's fields as text; numbers are read from them, so that a broken number is told from an empty field.
_TEXT_FIELDS = ", ".join(f"{f.name} string" for f in USER_BEHAVIOR_CSV.fields)
_NUMBERS = [f.name for f in USER_BEHAVIOR_CSV.fields if f.dataType == T.LongType()]


def split_behavior_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(parsed, quarantine)`` of text lines (column ``value``), batch or stream: every line is in one of them.

    A line is parsed if it has a time in whole seconds and its other numbers are numbers or empty (NULL).
    """
    raw = lines.select("value", F.from_csv("value", _TEXT_FIELDS, {"mode": "PERMISSIVE"}).alias("_r"))
    number = {c: F.expr(f"try_cast(_r.{c} AS BIGINT)") for c in _NUMBERS}
    valid = number["epoch_s"].isNotNull()
    for c in _NUMBERS:
        valid = valid & (number[c].isNotNull() | F.col(f"_r.{c}").isNull())
    valid = F.coalesce(valid, F.lit(False))
    typed = raw.filter(valid).select(*(number.get(f.name, F.col(f"_r.{f.name}")).alias(f.name) for f in USER_BEHAVIOR_CSV.fields))
    parsed = typed.select("user_id", "item_id", "category_id", "behavior", (F.col("epoch_s") * 1000).alias("ts_ms"),
                          ntz_from_seconds("epoch_s").alias("event_time"))
    return parsed, raw.filter(~valid).select("value")


def scan_behavior_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(rows, quarantine)`` of a folder of log files; seconds become ms and an event time."""
    return split_behavior_lines(spark.read.schema("value string").text(path))


def read_behavior_csv(spark: SparkSession, path: str) -> DataFrame:
    """The rows of :func:`scan_behavior_csv`, for a reader who looks at the quarantine elsewhere."""
    return scan_behavior_csv(spark, path)[0]


def stream_behavior_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same log as an unbounded stream of lines; split them in each micro-batch (one pass, two outputs)."""
    reader = spark.readStream.schema("value string")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def stream_behavior_csv(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The rows of the log as an unbounded stream."""
    return split_behavior_lines(stream_behavior_lines(spark, path, max_files_per_trigger))[0]
