"""Session settings, and the shared folder for anything that must outlive a task."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

# Spark chooses broadcast joins itself from the size it knows, and falls back to a shuffled
# join beyond the threshold; nothing in this package forces a broadcast. Skewed join
# partitions are split at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app: str, master: str | None = None, extra: dict | None = None) -> SparkSession:
    """A session with the settings above, where neither spark-submit nor `extra` says otherwise."""
    submitted = SparkConf()
    defaults = {name: value for name, value in SETTINGS.items() if not submitted.contains(name)}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**defaults, **(extra or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@lru_cache(maxsize=None)
def _local_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="millrace-")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only on a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_folder(spark.sparkContext.applicationId)


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def written(rows: DataFrame, purpose: str) -> DataFrame:
    """`rows` computed once and written to the shared folder.

    A written table survives the loss of the executors that computed it, unlike a cache.
    """
    folder = run_folder(rows.sparkSession, purpose)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def temporary_table(rows: DataFrame, name: str) -> DataFrame:
    """`rows` written once, and registered as a temporary view."""
    table = written(rows, name)
    table.createOrReplaceTempView(name)
    return table
