import datetime as dt
import json
import random
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.functions.records import to_messages
from millrace.operators import smoothing
from millrace.operators.scoring import score_history
from millrace.plans import sensors
from millrace.schemas import READING_FIELDS, READING_MESSAGE, SCORE_FIELDS
from millrace.sources.messages import deliver, publish, subscribe
from millrace.streaming.ingest import ingest_lines
from millrace.streaming.scoring import Scorer, score_frame, score_message_stream, score_stream, state_after, stored_state

START = dt.datetime(2024, 1, 1)
SCHEMA = "device_id string, ts timestamp, seq bigint, value double"
SCORES = ["prediction", "error", "anomaly", "predictionNext"]


def brute_force(values, alpha=1.0):
    """The definition, record by record."""
    results, errors = [], []
    prediction = forecast = value_before = prediction_before = 0.0
    for n, value in enumerate(values):
        prediction = forecast if n else 0.0
        error = abs(prediction_before - value_before) if n >= 2 else 0.0
        mean = sum(errors) / len(errors) if errors else 0.0
        if not errors:
            anomaly = 0.0
        elif mean == 0:
            anomaly = 1.0 if error > 0 else 0.0
        else:
            anomaly = min(1.0, error / (3 * mean))
        if n >= 2:
            errors.append(error)
        forecast = value if n == 0 else alpha * value + (1 - alpha) * forecast
        results.append((prediction, error, anomaly, forecast))
        prediction_before, value_before = prediction, value
    return results


def history(seed=1, devices=4, hot=400):
    """Irregular readings; one device sends most of them, another repeats one value."""
    generator = random.Random(seed)
    rows, seq = [], 0
    for device in range(devices):
        moment = START
        for at in range(hot if device == 0 else 40):
            moment += dt.timedelta(minutes=generator.choice([0, 1, 5, 59, 60, 200]))
            seq += 1
            value = 5.0 if device == 1 and at < 10 else round(generator.uniform(0, 50), 2)
            rows.append((f"d{device}", moment, seq, value))
    return rows


def expected_scores(rows, alpha=1.0):
    found = {}
    for device in {row[0] for row in rows}:
        ordered = sorted((row for row in rows if row[0] == device), key=lambda row: (row[1], row[2]))
        for row, scores in zip(ordered, brute_force([row[3] for row in ordered], alpha)):
            found[row[2]] = scores
    return found


def check(frame, expected):
    rows = frame.collect()
    assert len(rows) == len(expected)
    for row in rows:
        assert [row[name] for name in SCORES] == pytest.approx(expected[row.seq], abs=1e-9)


@pytest.mark.parametrize("chunk", ["minute", "hour", "day", "year"])
def test_history_does_not_depend_on_the_chunks(spark, chunk):
    rows = history()
    shuffled = random.Random(2).sample(rows, len(rows))
    check(score_history(spark.createDataFrame(shuffled, SCHEMA), chunk), expected_scores(rows))


def test_short_histories(spark):
    for count in range(1, 6):
        rows = [("d", START + dt.timedelta(hours=at), at, float(at * at)) for at in range(count)]
        check(score_history(spark.createDataFrame(rows, SCHEMA)), expected_scores(rows))
        check(score_history(spark.createDataFrame(rows, SCHEMA), alpha=0.5), expected_scores(rows, 0.5))


@pytest.mark.parametrize(("chunk", "alpha"), [("minute", 0.3), ("hour", 0.01), ("day", 0.999999), ("year", 0.3), ("year", 0.9)])
def test_an_exponential_mean_does_not_depend_on_the_chunks(spark, chunk, alpha):
    rows = history()
    shuffled = random.Random(2).sample(rows, len(rows))
    found = score_history(spark.createDataFrame(shuffled, SCHEMA).repartition(3), chunk, alpha).collect()
    expected = expected_scores(rows, alpha)
    assert len(found) == len(expected)
    for row in found:
        assert [row[name] for name in SCORES] == pytest.approx(expected[row.seq], abs=1e-6)


def test_maps_are_composed_over_batches_of_any_size():
    generator = np.random.default_rng(3)
    rows = pd.DataFrame({"k": np.repeat([1, 2, 5], [40, 1, 60]), "c": 7, "_a": generator.uniform(0, 1, 101), "_b": generator.normal(size=101)})
    expected, key = [], None
    for k, a, b in zip(rows["k"], rows["_a"], rows["_b"]):
        if k != key:
            key, x, y = k, 1.0, 0.0
        expected.append((x, y))
        x, y = a * x, a * y + b
    for size in (1, 2, 7, 39, 101):
        frames = [rows.iloc[i : i + size] for i in range(0, 101, size)]
        found = pd.concat(smoothing._scan(["k", "c"], ["k"])(iter([rows.iloc[:0], *frames])))
        assert np.allclose(found[["_a", "_b"]].to_numpy(), expected, rtol=1e-12, atol=1e-15)


def test_rows_move_once_to_their_chunk(spark, plan):
    text = plan(score_history(spark.createDataFrame(history(), SCHEMA), alpha=0.3))
    assert "SinglePartition" not in text and "Python" not in text.replace("MapInPandas", "")
    with pytest.raises(ValueError):
        score_history(spark.createDataFrame(history(), SCHEMA), alpha=1.5)


def test_rows_that_cannot_be_scored_are_left_out(spark):
    rows = [("d", START, 1, 1.0), ("d", None, 2, 1.0), ("d", START, 3, None), (None, START, 4, 1.0)]
    assert [r.seq for r in score_history(spark.createDataFrame(rows, SCHEMA)).collect()] == [1]


def test_a_device_is_split_over_chunks(spark, plan):
    text = plan(score_history(spark.createDataFrame(history(), SCHEMA)))
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning(device_id" in line]
    assert exchanges and all("_chunk" in line for line in exchanges[:1])
    assert "SinglePartition" not in text


@pytest.mark.parametrize("alpha", [1.0, 0.3])
def test_state_carries_over_frames(alpha):
    rows = [row for row in history() if row[0] == "d0"]
    frame = pd.DataFrame(rows, columns=["device_id", "ts", "seq", "value"])
    state, parts = None, []
    for start, end in [(0, 1), (1, 2), (2, 3), (3, 90), (90, 91), (91, len(frame))]:
        scored, state = score_frame(frame.iloc[start:end], state, alpha)
        parts.append(scored)
    scored = pd.concat(parts)
    for found, wanted in zip(scored[SCORES].itertuples(index=False), brute_force(frame["value"], alpha)):
        assert tuple(found) == pytest.approx(wanted, abs=1e-9 if alpha == 1.0 else 1e-6)
    assert state[0] == len(frame) and isinstance(state[4], Decimal) and not scored["late"].any()


def run_in_batches(spark, tmp_path, batches, alpha=1.0):
    source, out = tmp_path / "in", str(tmp_path / "out")
    for at, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(SCHEMA).parquet(str(source))
        deliver(score_stream(stream, alpha), out, str(tmp_path / "checkpoint"), "parquet", once=True).awaitTermination()
    return spark.read.parquet(out)


def test_stream_equals_history_across_restarts(spark, tmp_path):
    rows = sorted(history(hot=120), key=lambda row: row[1])
    cuts = [0, 50, 51, 130, len(rows)]
    scored = run_in_batches(spark, tmp_path, [rows[a:b] for a, b in zip(cuts, cuts[1:])])
    check(scored, expected_scores(rows))
    assert scored.where("late").count() == 0


def test_a_reading_behind_its_device_is_marked(spark, tmp_path):
    first = [("d", START + dt.timedelta(hours=5), 1, 1.0), ("e", START, 2, 1.0)]
    second = [("d", START, 3, 2.0), ("e", START + dt.timedelta(hours=1), 4, 2.0)]
    scored = run_in_batches(spark, tmp_path, [first, second])
    assert {r.seq for r in scored.where("late").collect()} == {3}


def record(device, moment, value, **fields):
    named = {
        "stateCode": device, "countryCode": "1", "siteNum": "2", "parameterCode": "3", "poc": "4",
        "dateGMT": f"{moment:%Y-%m-%d}", "timeGMT": f"{moment:%H:%M}", "sampleMeasurement": value, **fields,
    }
    return tuple(named.get(name) for name in READING_FIELDS)


def readings(spark, *records):
    return spark.createDataFrame(list(records), ", ".join(f"{name} string" for name in READING_FIELDS))


def test_messages(spark):
    row = to_messages(readings(spark, record("10", START, "0.5", stateName="A \"b\""))).first()
    assert row.key == "10-1-2-3-4"
    value = json.loads(row.value)
    assert list(value) == READING_FIELDS + SCORE_FIELDS
    assert value["stateName"] == 'A "b"' and value["mdl"] == "" and value["predictionNext"] == 0.0


def test_scores_already_present_are_kept(spark):
    row = readings(spark, record("10", START, "0.5")).withColumn("prediction", F.lit(2.5))
    assert json.loads(to_messages(row).first().value)["prediction"] == 2.5


def test_unreadable_messages_are_kept_apart(spark):
    good = to_messages(readings(spark, record("10", START, "0.5"), record("10", START, "x")))
    broken = spark.createDataFrame([("10-1-2-3-4", "{no json")], "key string, value string")
    messages = good.union(broken).withColumn("seq", F.monotonically_increasing_id())
    assert sensors.unreadable(messages).count() == 2
    assert sensors.score_messages(messages).count() == 1


def test_messages_in_enriched_messages_out(spark, tmp_path):
    values = [1.0, 4.0, 2.0, 2.0, 9.0]
    records = [record("10", START + dt.timedelta(hours=at), str(value)) for at, value in enumerate(values)]
    messages = to_messages(readings(spark, *records)).withColumn("seq", F.monotonically_increasing_id())
    publish(messages, str(tmp_path / "topic"), "json")
    stream = score_message_stream(subscribe(spark, str(tmp_path / "topic"), "json"))
    deliver(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), "json", once=True).awaitTermination()
    sent = spark.read.schema("key string, value string").json(str(tmp_path / "out"))
    decoded = {r.r.timeGMT: r.r for r in sent.select(F.from_json("value", READING_MESSAGE).alias("r")).collect()}
    assert {r.key for r in sent.collect()} == {"10-1-2-3-4"}
    for at, wanted in enumerate(brute_force(values)):
        assert [decoded[f"{at:02d}:00"][name] for name in SCORES] == pytest.approx(wanted)
    batch = sensors.score_messages(messages)
    assert sorted(map(str, batch.collect())) == sorted(map(str, sent.collect()))


def test_lines_are_ingested_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for at in range(3):
        (tmp_path / "in" / f"{at}.txt").write_text(f"line {at}\nmore {at}\n")
        ingest_lines(
            spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint"), once=True
        ).awaitTermination()
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == sorted(
        f"{word} {at}" for word in ("line", "more") for at in range(3)
    )


def test_a_trigger_reads_a_bounded_amount(spark, tmp_path):
    for at in range(3):
        messages = spark.createDataFrame([("k", f"v{at}", at)], "key string, value string, seq bigint").coalesce(1)
        publish(messages, str(tmp_path / "topic"), "json")
    stream = subscribe(spark, str(tmp_path / "topic"), "json", maxBytesPerTrigger="1")
    query = deliver(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), "json", once=True)
    query.awaitTermination(120)
    assert spark.read.json(str(tmp_path / "out")).count() == 3
    assert sum(progress.numInputRows > 0 for progress in query.recentProgress) == 3


def test_stream_runs_on_a_two_second_trigger(spark, tmp_path):
    messages = to_messages(readings(spark, record("10", START, "0.5"))).withColumn("seq", F.lit(1).cast("bigint"))
    publish(messages, str(tmp_path / "topic"), "json")
    query = deliver(
        subscribe(spark, str(tmp_path / "topic"), "json"), str(tmp_path / "out"), str(tmp_path / "checkpoint"), "json"
    )
    try:
        query.processAllAvailable()
        assert spark.read.json(str(tmp_path / "out")).count() == 1
    finally:
        query.stop()


def test_stream_and_history_agree_on_values_at_the_edges(spark):
    values = [1.0, 1e14, 2.0, 3.0, 4.0, 1e300, 5.0, -1e13, 0.0, 0.0]
    rows = [("d", START + dt.timedelta(minutes=17 * i), i, v) for i, v in enumerate(values)]
    odd = [("d", START + dt.timedelta(hours=1, seconds=1), 90, x) for x in (float("nan"), float("inf"), None)]
    history = spark.createDataFrame(rows + odd, "device_id string, ts timestamp, seq long, value double")
    found = score_history(history).orderBy("seq").collect()
    frame = pd.DataFrame(rows, columns=["device_id", "ts", "seq", "value"])
    state, parts = None, []
    for cut in (slice(0, 3), slice(3, 4), slice(4, 10)):
        scored, state = score_frame(frame.iloc[cut], state)
        parts.append(scored)
    stream = pd.concat(parts)
    assert [r.seq for r in found] == list(range(10))
    for name in ("prediction", "error", "anomaly", "predictionNext"):
        assert [r[name] for r in found] == stream[name].tolist(), name


def test_messages_without_a_finite_measurement_are_unreadable(spark):
    def reading(value):
        known = {"dateGMT": "2024-01-01", "timeGMT": "10:00", "sampleMeasurement": value}
        return tuple(known.get(name, "x") for name in READING_FIELDS)

    kind = ", ".join(f"{name} string" for name in READING_FIELDS)
    messages = to_messages(spark.createDataFrame([reading(v) for v in ("1.5", "NaN", "Infinity", "", "z")], kind))
    assert sensors.unreadable(messages.withColumn("seq", F.lit(1).cast("long"))).count() == 4


def test_rejects_and_late_marks_reach_their_sinks(spark, tmp_path):
    hours = [(0, "1"), (5, "2"), (3, "4"), (6, "x")]
    for seq, (at, value) in enumerate(hours):
        message = to_messages(readings(spark, record("10", START + dt.timedelta(hours=at), value)))
        publish(message.withColumn("seq", F.lit(seq).cast("long")).coalesce(1), str(tmp_path / "topic"), "json")
    stream = subscribe(spark, str(tmp_path / "topic"), "json", maxBytesPerTrigger="1")
    for name, rows in (("out", score_message_stream(stream)), ("rejects", sensors.rejected_messages(stream))):
        deliver(rows, str(tmp_path / name), str(tmp_path / f"{name}-checkpoint"), "json", once=True).awaitTermination()
    sent = [json.loads(r.value) for r in spark.read.schema("key string, value string").json(str(tmp_path / "out")).collect()]
    assert {m["timeGMT"]: m["late"] for m in sent} == {"00:00": False, "05:00": False, "03:00": True}
    rejects = spark.read.schema("key string, value string, seq long").json(str(tmp_path / "rejects")).collect()
    assert [(r.seq, json.loads(r.value)["sampleMeasurement"]) for r in rejects] == [(3, "x")]


def test_a_busy_device_is_scored_hour_by_hour(spark, tmp_path):
    """Batches of seven rows: more than one for each device, in no order; nothing stays put aside."""
    rows = history(hot=150)
    shuffled = random.Random(4).sample(rows, len(rows))
    sizes = {name: spark.conf.get(name) for name in ("spark.sql.execution.arrow.maxRecordsPerBatch",)}
    try:
        for name in sizes:
            spark.conf.set(name, "7")
        check(run_in_batches(spark, tmp_path, [shuffled]), expected_scores(rows))
    finally:
        for name, value in sizes.items():
            spark.conf.set(name, value)
    left = spark.read.format("statestore").option("stateVarName", "aside").load(str(tmp_path / "checkpoint"))
    assert left.count() == 0


class Handle:
    """State in plain dictionaries."""

    def __init__(self):
        self.value, self.map, self.most = None, {}, 0

    def getValueState(self, name, schema):
        return self

    def getMapState(self, name, key, value):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def updateValue(self, key, value):
        self.map[key] = value
        self.most = max(self.most, len(self.map))

    def getValue(self, key):
        return self.map[key]

    def removeKey(self, key):
        del self.map[key]


@pytest.mark.parametrize("size", [1, 10, 1000])
def test_batches_of_any_size_score_alike(size):
    rows = [row for row in history() if row[0] == "d0"]
    mixed = pd.DataFrame(random.Random(1).sample(rows, len(rows)), columns=["device_id", "ts", "seq", "value"])
    scorer, handle = Scorer(1.0), Handle()
    scorer.init(handle)
    parts = list(scorer.handleInputRows(("d0",), (mixed.iloc[i : i + size] for i in range(0, len(mixed), size)), None))
    scored = pd.concat(parts)
    wanted = brute_force([row[3] for row in sorted(rows, key=lambda row: (row[1], row[2]))])
    assert np.allclose(scored[SCORES].to_numpy(), wanted, atol=1e-9) and not scored["late"].any()
    assert handle.map == {} and (handle.most > 0) == (size < 1000) and handle.value[0] == len(rows)
    hours = [part["ts"].dt.floor("h").nunique() for part in parts]
    assert size == 1000 or max(hours) == 1


def test_a_stream_goes_on_from_a_scored_history(spark, tmp_path):
    rows = sorted(history(hot=120), key=lambda row: row[1])
    early, later = rows[:130], rows[130:]
    state = state_after(score_history(spark.createDataFrame(early, SCHEMA)))
    late_row = ("d0", START - dt.timedelta(days=1), 9999, 1.0)
    spark.createDataFrame(later, SCHEMA).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    deliver(score_stream(stream, state=state), out, checkpoint, "parquet", once=True).awaitTermination()
    wanted = expected_scores(rows)
    check(spark.read.parquet(out), {row[2]: wanted[row[2]] for row in later})
    stored = {r.device_id: r for r in stored_state(spark, checkpoint).collect()}
    assert {d: r.records for d, r in stored.items()} == {d: sum(row[0] == d for row in rows) for d in stored}
    assert set(stored) == {row[0] for row in rows}
    # The state of the history marks what is older than it.
    spark.createDataFrame([late_row], SCHEMA).write.mode("append").parquet(str(tmp_path / "in"))
    deliver(score_stream(stream, state=state), out, checkpoint, "parquet", once=True).awaitTermination()
    assert [r.seq for r in spark.read.parquet(out).where("late").collect()] == [9999]


def test_drifted_messages_are_parsed_once(spark, plan):
    """They are what they say: 24 fields, 28, or 24 and two that no schema knows."""
    from checks.jobs import drifted

    rows = spark.range(6).select(F.col("id").cast("string").alias("stateCode"), *(F.lit("x").alias(n) for n in READING_FIELDS[1:]))
    messages = to_messages(rows).withColumn("seq", F.get_json_object("value", "$.stateCode").cast("bigint")).repartition(2).localCheckpoint()
    frame = drifted(messages)
    assert plan(frame).count("from_json(") == 1
    found = {r.seq: json.loads(r.value) for r in frame.collect()}
    assert {at: len(fields) for at, fields in found.items()} == {0: 24, 1: 28, 2: 26, 3: 24, 4: 28, 5: 26}
    assert found[5]["battery"] == 5 and found[5]["tags"] == {"site": "s5"} and found[5]["stateCode"] == "5"


def test_filters_on_drifting_fields_do_not_parse(spark, plan):
    messages = spark.createDataFrame([("k", '{"dateGMT": "2024-01-01", "timeGMT": "00:00", "sampleMeasurement": 1.5, "more": 1}', 1)], "key string, value string, seq bigint")
    usable = sensors.drifting_readings_of(messages).where(sensors.is_reading())
    assert plan(usable).count("parse_json(") == 1
    assert [(r.device_id, r.value) for r in usable.collect()] == [("k", 1.5)]
