"""Routed files, numbers within a value, buckets, and counters of a pass."""

import json
import random

import pytest
from pyspark.sql import functions as F

from checks.files import BUCKETS, bucketed_totals
from millrace.functions.records import drifting_fields, drifting_json
from millrace.operators.counting import StreamCounts, observed
from millrace.operators.layout import in_file_order, numbered, write_routed
from millrace.plans import access_log
from millrace.plans.sensors import drifting_readings_of, is_reading
from millrace.sources.messages import with_offsets
from millrace.sources.tables import load_overwrite, overwrite_partitions
from millrace.streaming.ingest import COUNTERS, ingest_requests

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def skewed(spark):
    generator = random.Random(5)
    rows = [("big" if generator.random() < 0.8 else generator.choice(["a", "b", None, "c d/é"]), generator.randrange(50), at) for at in range(2000)]
    generator.shuffle(rows)
    return rows, spark.createDataFrame(rows, "system string, city int, bid long").repartition(5)


def expected_places(rows):
    groups = {}
    for system, city, bid in sorted(rows, key=lambda r: (r[1], r[2])):
        groups.setdefault(system, []).append((city, bid))
    return sorted(((s, c, b, at) for s, own in groups.items() for at, (c, b) in enumerate(own)), key=repr)


def test_one_system_is_many_sorted_files(spark, skewed, tmp_path):
    rows, frame = skewed
    path = str(tmp_path / "routed")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_routed(frame, path, "system", ["city", "bid"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted((tmp_path / "routed" / "system=big").glob("*.parquet"))
    assert len(files) > 3
    read = [(r.city, r.bid) for f in files for r in spark.read.parquet(str(f)).collect()]
    assert read == sorted((c, b) for s, c, b in rows if s == "big")
    found = in_file_order(spark, path, "system", "place").select("system", "city", "bid", "place").collect()
    assert sorted(map(tuple, found), key=repr) == expected_places(rows)


def test_numbers_have_no_gaps(spark, skewed, plan):
    rows, frame = skewed
    found = numbered(frame, "system", ["city", "bid"], "place")
    assert sorted(map(tuple, found.select("system", "city", "bid", "place").collect()), key=repr) == expected_places(rows)
    assert found.columns == ["system", "city", "bid", "place"] and "SinglePartition" not in plan(found)
    assert numbered(frame.limit(0), "system", ["city", "bid"], "place").collect() == []


def test_offsets_do_not_depend_on_how_messages_are_cut(spark):
    rows = [(f"k{at % 7}" if at % 11 else None, f"v{at}", at) for at in range(500)]
    frames = [spark.createDataFrame(rows, "key string, value string, seq long").repartition(n) for n in (1, 6)]
    one, other = (sorted(map(tuple, with_offsets(frame, 3).collect()), key=repr) for frame in frames)
    assert one == other and {r[0]: r[3] for r in one} == {r[0]: r[3] for r in other}
    for partition in {r[3] for r in one}:
        own = sorted((r[4], r[2]) for r in one if r[3] == partition)
        assert [offset for offset, _ in own] == list(range(len(own))) and own == sorted(own, key=lambda x: x[1])


def test_bucketed_tables_are_joined_where_they_lie(spark, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(bucketed_totals(spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")
    assert "SortMergeJoin" in text and "Exchange" not in text and f"SelectedBucketsCount: {BUCKETS} out of {BUCKETS}" in text


def test_other_partitions_stay(spark, tmp_path):
    path = str(tmp_path / "table")
    load_overwrite(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "v int, p string"), path, ["p"])
    found = overwrite_partitions(spark.createDataFrame([(9, "b"), (8, "d")], "v int, p string"), path, ["p"])
    assert sorted((r.p, r.v) for r in found.collect()) == [("a", 1), ("b", 9), ("c", 3), ("d", 8)]


LINE = 'ip{} - - [24/Apr/2011:04:06:01 -0400] "GET / HTTP/1.1" 200 {} "-" "agent"'


def test_counters_come_with_the_pass_that_writes(spark, tmp_path):
    lines = [LINE.format(1, 10), LINE.format(2, "bytes"), LINE.format(1, "-"), "no line", "", None, LINE.format(3, 32)]
    frame = spark.createDataFrame([(x,) for x in lines], "value string").repartition(3)
    counts = access_log.write_requests(frame, str(tmp_path / "out"))
    assert counts == {"lines": 7, "bad_lines": 4, "bytes": 42}
    written = spark.read.parquet(str(tmp_path / "out"))
    assert written.count() == 3 and "value" not in written.columns
    assert access_log.write_requests(frame.limit(0), str(tmp_path / "none")) == {"lines": 0, "bad_lines": 0, "bytes": 0}


def test_a_counted_scan_is_the_only_one(spark, tmp_path, plan):
    frame = spark.read.parquet(f"{SF_DIR}/events.parquet")
    counted, counts = observed(frame, {"n": F.count(F.lit(1))})
    assert plan(counted.where("event_id % 2 = 0")).count("Scan parquet") == 1
    counted.where("event_id % 2 = 0").write.parquet(str(tmp_path / "even"))
    assert counts.get == {"n": frame.count()}


def test_counters_of_a_stream_add_up(spark, tmp_path):
    for at in range(4):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{at}.log").write_text("\n".join([LINE.format(at, 1)] * (at + 1) + ["bad"] * 2) + "\n")
    counts = StreamCounts(COUNTERS)
    run = lambda: ingest_requests(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "c"), True, files_per_trigger=1)
    query = run()
    query.awaitTermination()
    assert counts.update(query) == counts.update(query) == {"lines": 18, "bad_lines": 8} and len(counts.seen) == 4
    (tmp_path / "in" / "9.log").write_text("bad\n")
    query = run()
    query.awaitTermination()
    assert counts.update(query) == {"lines": 19, "bad_lines": 9}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10


def test_unknown_fields_travel(spark):
    texts = ['{"a":"x","n":1.50,"deep":{"z":[1,null]},"score":7}', '{"n":"2"}', "{}", "[1]", '"text"', "{cut", None, '{"a":1,"a":2}']
    frame = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("s", F.lit(2.5))
    found = [r.j and json.loads(r.j) for r in frame.select(drifting_json("t", {"score": F.col("s"), "late": F.lit(False)}).alias("j")).collect()]
    more = {"score": 2.5, "late": False}
    assert found == [{"a": "x", "n": 1.5, "deep": {"z": [1, None]}, **more}, {"n": "2", **more}, more, None, None, None, None, None]
    assert [(r.n, r.a) for r in drifting_fields(frame, "t", "n", "a").collect()][:4] == [("1.5", "x"), ("2", None), (None, None), (None, None)]


def test_measurements_may_be_texts_or_numbers(spark):
    base = {"dateGMT": "2024-01-01", "timeGMT": "10:00"}
    values = ["3.25", 3.25, 3, "NaN", "", None, [1]]
    rows = [("k", json.dumps({**base, "sampleMeasurement": v, "extra": {"x": 1}}), at) for at, v in enumerate(values)]
    frame = spark.createDataFrame([*rows, ("k", "{}", 9)], "key string, value string, seq long")
    found = {r.seq: r.value for r in drifting_readings_of(frame).where(is_reading()).collect()}
    assert found == {0: 3.25, 1: 3.25, 2: 3.0}
