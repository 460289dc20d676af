"""Keyed messages: a Kafka topic, or files of the same key/value shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.layout import numbered
from millrace.session import run_folder

MESSAGE_SCHEMA = "key string, value string, seq bigint"
#: Messages that are sent at once: less than 750 bytes each as JSON lines, so that a trigger of `file_stream` takes them whole.
FEED_ROWS = 2_500_000
SENT = ["key", "value", "seq"]


def publish(messages: DataFrame, target: str, fmt: str = "kafka", **options) -> None:
    """Send a batch of `key`, `value` rows; `target` is the topic, or the folder for file formats."""
    if fmt == "kafka":
        messages.select("key", "value").write.format("kafka").option("topic", target).options(**options).save()
    else:
        messages.write.format(fmt).options(**options).mode("append").save(target)


def _place(timed: DataFrame, parts: int) -> Column:
    """The number of a range of times `_at`, from 0; equal times are in one range, rows without a time in the first."""
    edges = sorted(set(timed.approxQuantile("_at", [i / parts for i in range(1, parts)], 0.1 / parts))) if parts > 1 else []
    return sum((F.coalesce(F.col("_at") > edge, F.lit(False)).cast("int") for edge in edges), F.lit(0))


def ordered_feeds(messages: DataFrame, at: str = "at", ranges: int = 1, rows: int = FEED_ROWS) -> list[DataFrame]:
    """Messages in feeds of at most about `rows`, in which each key's messages come in order of their time `at`, feed after feed.

    They are cut in `ranges` of times, each of these by keys, and what one busy key makes larger by times again. So a key comes
    once in each range, however many feeds there are. The messages are written once, in folders by feed.
    """
    count = messages.count()
    if ranges == 1 and count <= rows:
        return [messages.select(*SENT)]
    timed = messages.select(*SENT, F.unix_micros(F.col(at).cast("timestamp")).alias("_at"))
    buckets = -(-count * 5 // (4 * ranges * rows))
    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int").alias("_bucket")
    folder = run_folder(messages.sparkSession, "feeds")
    timed.select("*", _place(timed, ranges).alias("_range"), bucket).write.partitionBy("_range", "_bucket").parquet(folder)
    stored = messages.sparkSession.read.schema(f"{MESSAGE_SCHEMA}, _at bigint, _range int, _bucket int").parquet(folder)
    feeds = []
    for line in sorted(stored.groupBy("_range", "_bucket").count().collect()):
        feed = stored.where((F.col("_range") == line["_range"]) & (F.col("_bucket") == line["_bucket"]))
        parts = -(-line["count"] // rows)
        place = _place(feed, parts)
        feeds += [feed.where(place == i).select(*SENT) for i in range(parts)]
    return feeds


def with_offsets(messages: DataFrame, partitions: int, order: str = "seq") -> DataFrame:
    """Messages with the `partition` of their key, and their dense `offset` in it, from 0 in `order`, as a topic would number them.

    All messages of a key are in one partition; a null key counts as the empty one. Nothing is sorted as a whole: see `numbered`.
    """
    digits = F.substring(F.md5(F.coalesce(F.col("key"), F.lit(""))), 1, 8)
    partition = (F.conv(digits, 16, 10).cast("bigint") % partitions).cast("int").alias("partition")
    return numbered(messages.select("*", partition), "partition", [order], "offset")


def file_stream(spark: SparkSession, source: str, schema, fmt: str, **options) -> DataFrame:
    """New files of a folder or glob as a stream, at most `maxBytesPerTrigger` at a time."""
    settings = {"maxBytesPerTrigger": str(2 * 1024**3), **options}
    return spark.readStream.schema(schema).format(fmt).options(**settings).load(source)


def subscribe(spark: SparkSession, source: str, fmt: str = "kafka", **options) -> DataFrame:
    """A stream of `key`, `value`, `seq`; `seq` is the offset, which orders messages of one key.

    A trigger reads a bounded amount, so that the rows of one key within a micro-batch stay
    bounded too; the bounds are options. A Kafka consumer starts at the latest offset unless told
    otherwise.
    """
    if fmt == "kafka":
        settings = {"startingOffsets": "latest", "maxOffsetsPerTrigger": "5000000", **options}
        stream = spark.readStream.format("kafka").option("subscribe", source).options(**settings).load()
        return stream.select(
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            F.col("offset").alias("seq"),
        )
    return file_stream(spark, source, MESSAGE_SCHEMA, fmt, **options)


def deliver(stream: DataFrame, target: str, checkpoint: str, fmt: str = "kafka", once: bool = False, **options):
    """Start the query that writes `stream`; every 2 seconds, or until caught up when `once`.

    The checkpoint holds offsets and state, so a restart goes on where it stopped.
    """
    trigger = {"availableNow": True} if once else {"processingTime": "2 seconds"}
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(**trigger)
    if fmt == "kafka":
        return writer.format("kafka").option("topic", target).options(**options).start()
    return writer.format(fmt).options(**options).start(target)
