"""Streaming queries, run until they have caught up with the given tables and read back."""

from __future__ import annotations

import os

import pandas as pd
from pyspark.sql import functions as F

from checks import inputs
from checks.files import COUNTS_SQL
from checks.jobs import ALPHA, DRIFTED_SQL, drifted, drifted_columns, KEYED_SCORE_SQL, MESSAGE_SCORE_SQL, SCORE_COLUMNS, SMOOTHED_SCORE_SQL, rounded
from checks.registry import query, table
from millrace.functions.dates import gmt_time
from millrace.functions.records import from_json_text
from millrace.functions.numbers import number
from millrace.operators.counting import StreamCounts
from millrace.operators.scoring import score_history
from millrace.plans.sensors import rejected_messages
from millrace.session import run_folder
from millrace.sources.growing import local_path
from millrace.sources.messages import MESSAGE_SCHEMA, deliver, file_stream, ordered_feeds, publish, subscribe
from millrace.sources.sinks import write_lines
from millrace.streaming.ingest import COUNTERS, ingest_lines, ingest_requests, tail_lines
from millrace.streaming.scoring import score_message_stream, score_stream, state_after, stored_state


@query("line_ingest", "SELECT concat_ws(',', event_id, user_id, event_type) AS value FROM events")
def line_ingest(spark, sf_dir):
    folder = run_folder(spark, "ingest")
    write_lines(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type"), f"{folder}/in")
    ingest_lines(spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint", once=True).awaitTermination()
    return spark.read.text(f"{folder}/out")


#: Files that grow in `tailed_lines`, and into how many parts their lines are cut.
LOGS, ROUNDS = 8, 3


def _appended(folder, round_number, sizes):
    """A task appends the lines of the round to its logs. All but the last round leave the last line without its end.

    A task that runs again cuts its files to the size before the round first.
    """

    def append(frames):
        file, name, last = None, None, b""

        def close():
            if file is not None:
                file.write(last if round_number == ROUNDS - 1 else last[:-1])
                file.close()

        for frame in frames:
            for log, text in zip(frame["log"], frame["line"]):
                if name != log:
                    close()
                    path, size = sizes.get(log, (f"{folder}/log-{log}.txt", 0))
                    file, name, last = open(path, "r+b" if size else "wb"), log, b""
                    file.truncate(size)
                    file.seek(size)
                file.write(last)
                last = text.encode() + b"\n"
        close()
        yield pd.DataFrame({"done": [1]})

    return append


@query("tailed_lines", "SELECT concat_ws(',', event_id, user_id, event_type) AS value FROM events")
def tailed_lines(spark, sf_dir):
    """Logs that grow between the runs of a query, one renamed and begun anew in between; every line once."""
    folder = run_folder(spark, "tailed")
    logs = local_path(f"{folder}/logs")
    os.makedirs(logs)
    line = F.concat_ws(",", "event_id", "user_id", "event_type")
    place = F.pmod(F.xxhash64("event_id"), F.lit(LOGS * ROUNDS))
    lines = table(spark, sf_dir, "events").select(line.alias("line"), (place % LOGS).alias("log"), F.floor(place / LOGS).alias("round"))
    sizes = {}
    for i in range(ROUNDS):
        # The line that the round before left open ends first.
        for path, _ in sizes.values():
            with open(path, "ab") as log:
                log.write(b"\n")
        sizes = {n: (path, os.path.getsize(path)) for n, (path, _) in sizes.items()}
        written = lines.where(F.col("round") == i).repartition(LOGS, "log").sortWithinPartitions("log")
        written.mapInPandas(_appended(logs, i, sizes), "done int").write.format("noop").mode("overwrite").save()
        sizes = {n: (f"{logs}/log-{n}.txt", 0) for n in range(LOGS) if os.path.exists(f"{logs}/log-{n}.txt")}
        tail_lines(spark, logs, f"{folder}/out", f"{folder}/checkpoint", "log-*", once=True).awaitTermination()
        if i == 0:  # the log is renamed with its open line, and a new one takes its name
            first = min(sizes)
            path = sizes.pop(first)[0]
            os.rename(path, f"{path}.1")
            with open(f"{path}.1", "ab") as log:
                log.write(b"\n")
    return spark.read.text(f"{folder}/out")


@query(
    "message_stream",
    f"""SELECT concat_ws('-', stateCode, countryCode, siteNum, parameterCode, poc) AS key, seq, sampleMeasurement
        FROM ({inputs.READINGS_SQL})""",
)
def message_stream(spark, sf_dir):
    """Published messages, read as a stream and delivered unchanged."""
    folder = run_folder(spark, "messages")
    publish(inputs.reading_messages(spark, sf_dir), f"{folder}/in", "json")
    stream = subscribe(spark, f"{folder}/in", "json")
    deliver(stream, f"{folder}/out", f"{folder}/checkpoint", "parquet", once=True).awaitTermination()
    sent = spark.read.schema(MESSAGE_SCHEMA).parquet(f"{folder}/out")
    return sent.select("key", "seq", from_json_text("value")["sampleMeasurement"].alias("sampleMeasurement"))


@query("keyed_score_stream", KEYED_SCORE_SQL)
def keyed_score_stream(spark, sf_dir):
    """The keyed state of the stream gives what the batch query gives."""
    folder = run_folder(spark, "scores")
    schema = table(spark, sf_dir, "events").schema
    # The glob also matches a table that is a folder of files.
    events = file_stream(spark, f"{sf_dir}/events.parquet*", schema, "parquet").select(
        F.col("user_id").alias("device_id"), "ts", F.col("event_id").alias("seq"), "value"
    )
    deliver(score_stream(events), f"{folder}/out", f"{folder}/checkpoint", "parquet", once=True).awaitTermination()
    return spark.read.parquet(f"{folder}/out").select(*SCORE_COLUMNS)


def _events(spark, sf_dir, condition="true"):
    events = table(spark, sf_dir, "events").where(condition)
    return events.select(F.col("user_id").alias("device_id"), "ts", F.col("event_id").alias("seq"), "value")


def _event_stream(spark, folder, schema):
    stream = file_stream(spark, folder, schema, "parquet")
    return stream.select(F.col("user_id").alias("device_id"), "ts", F.col("event_id").alias("seq"), "value")


@query("smoothed_score_stream", SMOOTHED_SCORE_SQL)
def smoothed_score_stream(spark, sf_dir):
    """The stream with an exponential mean gives what the batch query gives."""
    folder = run_folder(spark, "smoothed")
    events = _event_stream(spark, f"{sf_dir}/events.parquet*", table(spark, sf_dir, "events").schema)
    deliver(score_stream(events, ALPHA), f"{folder}/out", f"{folder}/checkpoint", "parquet", once=True).awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("device_id", "seq", *(rounded(name) for name in SCORE_COLUMNS[2:]))


#: What the state of a device must be after all its events.
STATE_SQL = f"""
    WITH s AS ({KEYED_SCORE_SQL}), e AS (SELECT event_id AS seq, ts, value FROM events)
    SELECT device_id, count(*) AS records, arg_max(value, (ts, seq)) AS value, arg_max(prediction, (ts, seq)) AS prediction,
        arg_max("predictionNext", (ts, seq)) AS "predictionNext",
        CAST(sum(CAST(floor(error * 1000000 + 0.5) AS HUGEINT)) AS VARCHAR) AS errors, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS latest
    FROM s JOIN e USING (seq) GROUP BY device_id"""


@query("state_of_devices", STATE_SQL)
def state_of_devices(spark, sf_dir):
    """The state that a stream keeps for each device, read from its checkpoint."""
    folder = run_folder(spark, "state")
    events = _event_stream(spark, f"{sf_dir}/events.parquet*", table(spark, sf_dir, "events").schema)
    deliver(score_stream(events), f"{folder}/out", f"{folder}/checkpoint", "parquet", once=True).awaitTermination()
    state = stored_state(spark, f"{folder}/checkpoint")
    latest = F.date_format("latest", "yyyy-MM-dd HH:mm:ss").alias("latest")
    return state.select("device_id", "records", "value", "prediction", "predictionNext", F.col("errors").cast("string").alias("errors"), latest)


#: Where a history ends and the stream goes on; the events are of January 2024.
HALF = "2024-01-15 00:00:00"


@query(
    "resumed_scores",
    f"""SELECT s.* FROM ({KEYED_SCORE_SQL}) s JOIN events ON seq = event_id WHERE ts >= TIMESTAMP '{HALF}'""",
)
def resumed_scores(spark, sf_dir):
    """A history scored as a batch, and what came later as a stream that goes on from the state of that batch."""
    folder = run_folder(spark, "resumed")
    state = state_after(score_history(_events(spark, sf_dir, f"ts < timestamp_ntz '{HALF}'")))
    later = table(spark, sf_dir, "events").where(f"ts >= timestamp_ntz '{HALF}'")
    later.write.parquet(f"{folder}/in")
    stream = score_stream(_event_stream(spark, f"{folder}/in", later.schema), state=state)
    deliver(stream, f"{folder}/out", f"{folder}/checkpoint", "parquet", once=True).awaitTermination()
    return spark.read.parquet(f"{folder}/out").select(*SCORE_COLUMNS)


ENRICHED_SQL = f"""SELECT device_id AS key, prediction, error, anomaly, "predictionNext", "predictionNext" AS value
    FROM ({MESSAGE_SCORE_SQL})"""


def _timed_messages(spark, sf_dir):
    return inputs.reading_messages(spark, sf_dir, gmt_time("dateGMT", "timeGMT").alias("at"))


def _scored_in_order(spark, folder, feeds, **options):
    """Feeds sent one after another; each is scored before the next one comes, by a query that goes on from the last one's checkpoint.

    Each of `ordered_feeds` fits one trigger, so the rows of a device arrive in time order from trigger to trigger.
    """
    for some in feeds:
        publish(some, f"{folder}/in", "json")
        stream = score_message_stream(subscribe(spark, f"{folder}/in", "json"), **options)
        deliver(stream, f"{folder}/out", f"{folder}/checkpoint", "json", once=True).awaitTermination()
    return spark.read.schema("key string, value string").json(f"{folder}/out")


@query("message_score_stream", ENRICHED_SQL)
def message_score_stream(spark, sf_dir):
    """JSON messages in, enriched JSON messages out under the same keys."""
    sent = _scored_in_order(spark, run_folder(spark, "enriched"), ordered_feeds(_timed_messages(spark, sf_dir)))
    record = sent.select("key", from_json_text("value").alias("r"))
    scores = [F.col(f"r.{name}").alias(name) for name in ("prediction", "error", "anomaly", "predictionNext")]
    return record.select("key", *scores, number("r.sampleMeasurement").alias("value"))


def _spoiled(column):
    """Every seventh message is cut, and has no end."""
    return F.when(F.col("seq") % 7 == 0, F.lit("{cut")).otherwise(F.col(column)).alias(column)


@query(
    "message_rejects",
    f"""SELECT concat_ws('-', stateCode, countryCode, siteNum, parameterCode, poc) AS key, '{{cut' AS value, seq
        FROM ({inputs.READINGS_SQL}) WHERE seq % 7 = 0""",
)
def message_rejects(spark, sf_dir):
    """Messages that cannot be scored go to a sink of their own, as they came."""
    folder = run_folder(spark, "rejects")
    publish(inputs.reading_messages(spark, sf_dir).select("key", _spoiled("value"), "seq"), f"{folder}/in", "json")
    stream = rejected_messages(subscribe(spark, f"{folder}/in", "json"))
    deliver(stream, f"{folder}/out", f"{folder}/checkpoint", "parquet", once=True).awaitTermination()
    return spark.read.schema(MESSAGE_SCHEMA).parquet(f"{folder}/out")


#: Ranges of times that are scored one after another.
RANGES = 4


@query("message_score_triggers", f"SELECT *, false AS late FROM ({ENRICHED_SQL})")
def message_score_triggers(spark, sf_dir):
    """Triggers of one range of times after another, the state kept between them. A later one must hold no earlier time of a device."""
    feeds = ordered_feeds(_timed_messages(spark, sf_dir), ranges=RANGES)
    sent = _scored_in_order(spark, run_folder(spark, "triggers"), feeds)
    scores = [F.col(f"r.{name}").alias(name) for name in ("prediction", "error", "anomaly", "predictionNext")]
    late = F.get_json_object("value", "$.late").cast("boolean").alias("late")
    rows = sent.select("key", from_json_text("value").alias("r"), late)
    return rows.select("key", *scores, number("r.sampleMeasurement").alias("value"), "late")


@query("observed_stream_counts", COUNTS_SQL)
def observed_stream_counts(spark, sf_dir):
    """Counters of a stream, added up over its triggers."""
    folder = run_folder(spark, "counted")
    write_lines(inputs.access_lines(spark, sf_dir), f"{folder}/in")
    query = ingest_requests(spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint", once=True)
    counts = StreamCounts(COUNTERS)
    while not query.awaitTermination(5):
        counts.update(query)
    found = counts.update(query)
    one = spark.read.parquet(f"{folder}/out").agg(F.count("*").alias("written"))
    return one.where(F.col("written") == found["lines"] - found["bad_lines"]).select(
        *(F.lit(found[name]).cast("bigint").alias(name) for name in ("lines", "bad_lines"))
    )


@query("drifted_message_stream", DRIFTED_SQL)
def drifted_message_stream(spark, sf_dir):
    """The same messages as a stream."""
    feeds = [drifted(some) for some in ordered_feeds(_timed_messages(spark, sf_dir))]
    return drifted_columns(_scored_in_order(spark, run_folder(spark, "drifted"), feeds, drifting=True))


@query(
    "message_stream_every_two_seconds",
    f"""SELECT concat_ws('-', stateCode, countryCode, siteNum, parameterCode, poc) AS key, seq FROM ({inputs.READINGS_SQL})""",
)
def message_stream_every_two_seconds(spark, sf_dir):
    """The stream as a job runs it, with a trigger every two seconds; stopped when all messages are through."""
    folder = run_folder(spark, "timed")
    publish(inputs.reading_messages(spark, sf_dir), f"{folder}/in", "json")
    running = deliver(subscribe(spark, f"{folder}/in", "json"), f"{folder}/out", f"{folder}/checkpoint", "parquet")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.schema(MESSAGE_SCHEMA).parquet(f"{folder}/out").select("key", "seq")


@query(
    "late_messages",
    f"""WITH r AS (SELECT concat_ws('-', stateCode, countryCode, siteNum, parameterCode, poc) AS key, dateGMT, timeGMT,
            dateGMT < '{HALF[:10]}' AS early FROM ({inputs.READINGS_SQL}))
        SELECT key, dateGMT, timeGMT, early AND key IN (SELECT key FROM r WHERE NOT early) AS late FROM r""",
)
def late_messages(spark, sf_dir):
    """The later half of the messages first, the earlier in a second run: what is older than a scored message of its device says so."""
    messages = _timed_messages(spark, sf_dir)
    early = F.col("at") < F.lit(HALF).cast("timestamp")
    feeds = ordered_feeds(messages.where(~early)) + ordered_feeds(messages.where(early))
    sent = _scored_in_order(spark, run_folder(spark, "late"), feeds)
    get = lambda name: F.get_json_object("value", f"$.{name}")
    return sent.select("key", get("dateGMT").alias("dateGMT"), get("timeGMT").alias("timeGMT"), get("late").cast("boolean").alias("late"))
