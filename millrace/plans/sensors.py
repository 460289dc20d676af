"""Sensor readings: publishing them, and scoring a whole history at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.dates import gmt_time
from millrace.functions.numbers import number
from millrace.functions.records import drifting_fields, drifting_json, parsed_fields, record_json, to_messages
from millrace.operators.scoring import finite, score_history
from millrace.schemas import READING_FIELDS, SCORE_FIELDS
from millrace.sources.messages import publish
from millrace.sources.tables import read_table

NEEDED = ("dateGMT", "timeGMT", "sampleMeasurement")


def read_readings(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, READING_FIELDS)


def publish_readings(rows: DataFrame, target: str, fmt: str = "kafka", **options) -> None:
    """Each reading as one JSON message under its device key."""
    publish(to_messages(rows), target, fmt, **options)


def readings_of(messages: DataFrame) -> DataFrame:
    """Messages with what scoring needs: `device_id`, `ts`, `seq`, `value`, and the text as `record`.

    A message that does not parse, or whose time or measurement is unreadable or not finite, has null there. The
    text is parsed once per message: filters on parsed fields stay above the `inline`.
    """
    parsed = messages.select(
        F.col("key").alias("device_id"), "seq", F.col("value").alias("record"), parsed_fields("value", *NEEDED)
    )
    return _timed(parsed)


def drifting_readings_of(messages: DataFrame) -> DataFrame:
    """The same for messages whose fields differ: any object with the fields that scoring needs, as texts or as numbers."""
    kept = messages.select(F.col("key").alias("device_id"), "seq", F.col("value").alias("record"))
    return _timed(drifting_fields(kept, "record", *NEEDED))


def _timed(parsed: DataFrame) -> DataFrame:
    value = number("sampleMeasurement")
    return parsed.select(
        "device_id",
        gmt_time("dateGMT", "timeGMT").alias("ts"),
        "seq",
        F.when(finite(value), value).alias("value"),
        "record",
    )


def is_reading() -> Column:
    return F.col("ts").isNotNull() & finite(F.col("value"))


def unreadable(messages: DataFrame) -> DataFrame:
    """Messages that cannot be scored."""
    return readings_of(messages).where(~is_reading())


def rejected_messages(messages: DataFrame) -> DataFrame:
    """Messages that cannot be scored, as they came; each message is either here or scored."""
    return unreadable(messages).select(F.col("device_id").alias("key"), F.col("record").alias("value"), "seq")


def scored_messages(scored: DataFrame) -> DataFrame:
    """Scored readings as messages again: the record with its four result fields filled in, and the mark `late`."""
    late = F.col("late") if "late" in scored.columns else F.lit(False).alias("late")
    rows = scored.select("device_id", *SCORE_FIELDS, late, parsed_fields("record", *READING_FIELDS))
    return rows.select(F.col("device_id").alias("key"), record_json("late").alias("value"))


def scored_drifting_messages(scored: DataFrame) -> DataFrame:
    """Scored readings as messages again: each record as it came, fields that no schema knows included, with the results set."""
    late = F.col("late") if "late" in scored.columns else F.lit(False)
    results = {**{name: F.col(name) for name in SCORE_FIELDS}, "late": late}
    return scored.select(F.col("device_id").alias("key"), drifting_json("record", results).alias("value"))


def score_drifting_messages(messages: DataFrame, chunk: str = "hour", alpha: float = 1.0) -> DataFrame:
    """All messages scored in time order per device, with 24 fields, 28, or further ones."""
    return scored_drifting_messages(score_history(drifting_readings_of(messages), chunk, alpha))


def score_messages(messages: DataFrame, chunk: str = "hour", alpha: float = 1.0) -> DataFrame:
    """The batch twin of the stream: all messages scored in time order per device."""
    return scored_messages(score_history(readings_of(messages), chunk, alpha))
