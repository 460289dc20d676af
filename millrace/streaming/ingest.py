"""Continuous ingest of text lines into a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.functions.logs import accepted, parse_access
from millrace.operators.counting import line_counters
from millrace.sources.growing import growing_lines


def line_stream(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """New files of a folder as lines."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder)


def ingest_lines(spark: SparkSession, folder: str, target: str, checkpoint: str, once: bool = False):
    """Start the query that copies new lines to `target`, each exactly once across restarts."""
    trigger = {"availableNow": True} if once else {"processingTime": "2 seconds"}
    writer = line_stream(spark, folder).writeStream.format("text").outputMode("append")
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start(target)


def tail_lines(spark: SparkSession, folder: str, target: str, checkpoint: str, pattern: str = "*", from_end: bool = False, once: bool = False):
    """Start the query that copies finished lines of growing files to `target`, each exactly once across renames and restarts."""
    trigger = {"availableNow": True} if once else {"processingTime": "2 seconds"}
    writer = growing_lines(spark, folder, pattern, from_end).select("value").writeStream.format("text").outputMode("append")
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start(target)


#: The name under which a query of `ingest_requests` reports its counters.
COUNTERS = "line_counters"


def ingest_requests(spark: SparkSession, folder: str, target: str, checkpoint: str, once: bool = False, files_per_trigger: int = 1000):
    """Start the query that turns new access-log lines into a table of valid requests, counting lines as they pass (see `StreamCounts`)."""
    trigger = {"availableNow": True} if once else {"processingTime": "2 seconds"}
    parsed = parse_access(line_stream(spark, folder, files_per_trigger))
    counted = parsed.observe(COUNTERS, *(counter.alias(name) for name, counter in line_counters().items()))
    writer = accepted(counted).drop("value").writeStream.format("parquet").outputMode("append")
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start(target)
