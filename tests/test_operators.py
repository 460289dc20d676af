import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.joining import count_by, matched, unmatched, with_lookup
from millrace.operators.layout import with_parallelism
from millrace.operators.ranking import best_of_columns, best_rows, first_best, most_frequent, top_rows
from millrace.operators.reshaping import repeat_rows, unpivot


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows and more under one key, with ties, copies, nulls and a null key."""
    generator = random.Random(7)
    rows = []
    for at in range(3000):
        key = "hot" if at % 3 == 0 else generator.choice(["a", "b", "c", None, f"k{at % 50}"])
        rows.append((key, generator.choice([None, 1.0, 2.0, 2.5, 2.5, -1.0]), generator.choice("xyz")))
    return spark.createDataFrame(rows, "k string, v double, name string"), rows


def test_best_rows(skewed):
    frame, rows = skewed
    top = {}
    for key, value, _ in rows:
        if value is not None:
            top[key] = max(value, top.get(key, value))
    expected = sorted((r for r in rows if r[1] is not None and r[1] == top[r[0]]), key=str)
    assert sorted((tuple(r) for r in best_rows(frame, ["k"], "v").collect()), key=str) == expected


def test_first_best(skewed):
    frame, rows = skewed
    best = {}
    for key, value, name in rows:
        if value is not None:
            best[key] = min(best.get(key, (-value, name)), (-value, name))
    found = {r.k: (-r.v, r.name) for r in first_best(frame, ["k"], "v", ["name"]).collect()}
    assert found == best


def test_most_frequent(skewed):
    frame, rows = skewed
    votes = {}
    for key, _, name in rows:
        votes.setdefault(key, {}).setdefault(name, 0)
        votes[key][name] += 1
    expected = {key: min(names, key=lambda name: (-names[name], name)) for key, names in votes.items()}
    assert {r.k: r.name for r in most_frequent(frame, ["k"], "name").collect()} == expected


def test_rankings_keep_no_group_in_one_task(skewed, plan):
    frame, _ = skewed
    for result in (best_rows(frame, ["k"], "v"), first_best(frame, ["k"], "v", ["name"]), most_frequent(frame, ["k"], "name")):
        text = plan(result)
        assert "Window" not in text and "partial_" in text and "CartesianProduct" not in text


def test_best_rows_when_nothing_may_be_broadcast(spark, skewed, plan):
    frame, _ = skewed
    expected = sorted(map(str, best_rows(frame, ["k"], "v").collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = best_rows(frame, ["k"], "v")
        assert "SortMergeJoin" in plan(result) or "ShuffledHashJoin" in plan(result)
        assert sorted(map(str, result.collect())) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")


def test_repeat_rows(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 3), ("c", 25), ("d", 7), ("e", 20)], "k string, n bigint")
    found = {r.k: r["count"] for r in repeat_rows(rows, "n", copies_at_once=10).groupBy("k").count().collect()}
    assert found == {"a": 1, "b": 3, "c": 25, "d": 7, "e": 20}


def test_best_of_columns_aggregates_only_in_stated_partitions(spark, plan):
    rows = spark.range(0, 20_000, 1, 5).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"),
        (F.col("id") % 11).cast("double").alias("a"),
        F.when(F.col("id") % 2 > 0, (F.col("id") % 13).cast("double")).alias("b"),
    )
    best = best_of_columns(rows, ["k"], ["a", "b"], "name", "value")
    # An exchange that Spark adds is merged by its compressed size; a table of groups takes some twenty times as much.
    assert "ENSURE_REQUIREMENTS" not in plan(best) and plan(best).count("REPARTITION_BY_NUM") == 3
    long = [(r.k, name, r[name]) for r in rows.collect() for name in ("a", "b") if r[name] is not None]
    top = {k: max(v for j, _, v in long if j == k) for k in {k for k, _, _ in long}}
    assert sorted(map(tuple, best.collect())) == sorted(x for x in long if x[2] == top[x[0]])


def test_best_of_columns_is_best_rows_of_the_unpivoted(spark, plan):
    rows = spark.createDataFrame(
        [(1, 2.0, 5.0, None), (1, 5.0, 5.0, 1.0), (1, 5.0, 1.0, 1.0), (2, None, None, None), (None, 1.0, None, 3.0), (3, float("nan"), 9.0, 9.0)],
        "k int, a double, b double, c double",
    )
    best = best_of_columns(rows, ["k"], ["a", "b", "c"], "name", "value")
    # Before it runs: afterwards the plan shows the final and the first form.
    assert "Join" not in plan(best) and plan(best).count("Scan ExistingRDD") == 1
    long = unpivot(rows, ["k"], ["a", "b", "c"], "name", "value")
    found = sorted(map(str, best.collect()))
    assert found == sorted(map(str, best_rows(long, ["k"], "value").collect())) and len(found) == 6


def test_rows_without_copies_vanish(spark):
    rows = spark.createDataFrame([("a", 0), ("b", None), ("c", 2)], "k string, n bigint")
    assert [tuple(r) for r in repeat_rows(rows, "n").collect()] == [("c",), ("c",)]


def test_many_copies_are_spread(spark):
    rows = spark.createDataFrame([("a", 1000)], "k string, n bigint")
    spread = repeat_rows(rows, "n", copies_at_once=10).groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) > 4 and sum(r["count"] for r in spread) == 1000


def test_unpivot_reads_once(spark, tmp_path, plan):
    spark.createDataFrame([(1, "x", None)], "id int, a string, b string").write.parquet(str(tmp_path / "t"))
    long = unpivot(spark.read.parquet(str(tmp_path / "t")), ["id"], ["a", "b"], "name", "value")
    assert {tuple(r) for r in long.collect()} == {(1, "a", "x"), (1, "b", None)}
    assert plan(long).count("FileScan") == 1


def test_lookup(spark):
    counts = spark.createDataFrame([("1", 5), ("2", 3), ("9", 1)], "id string, n bigint")
    lookup = spark.createDataFrame([("1", "one"), ("2", "zwei"), ("2", "two"), ("3", "three")], "id string, name string")
    named = with_lookup(counts, lookup, "id")
    assert {(r.name, r.n) for r in matched(named).collect()} == {("one", 5), ("two", 3)}
    assert [(r.id, r.n) for r in unmatched(named).collect()] == [("9", 1)]
    assert {(r.name, r.n) for r in matched(with_lookup(counts, None, "id")).collect()} == {("1", 5), ("2", 3), ("9", 1)}


def test_small_lookup_is_broadcast_by_its_size(spark, tmp_path, plan):
    spark.createDataFrame([("1", "one")], "id string, name string").write.parquet(str(tmp_path / "names"))
    spark.range(1000).selectExpr("cast(id as string) id").write.parquet(str(tmp_path / "rows"))
    rows, names = spark.read.parquet(str(tmp_path / "rows")), spark.read.parquet(str(tmp_path / "names"))
    assert "BroadcastHashJoin" in plan(with_lookup(count_by(rows, "id"), names, "id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        assert "SortMergeJoin" in plan(with_lookup(count_by(rows, "id"), names, "id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")


def test_top_rows_and_parallelism(spark):
    rows = spark.range(100).withColumn("g", F.col("id") % 10)
    assert [tuple(r) for r in top_rows(count_by(rows, "g"), 2, F.desc("n"), F.asc("g")).collect()] == [(0, 10), (1, 10)]
    assert with_parallelism(rows, 3).rdd.getNumPartitions() == 3
    assert with_parallelism(rows, None) is rows


def test_a_hot_partition_of_winners_is_split(spark, plan):
    """All rows of one group are equal winners: the join splits them instead of giving them to one task."""
    rows = spark.range(400_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 1000).cast("string")).alias("k"),
        F.lit(1.0).alias("v"),
        F.md5(F.col("id").cast("string")).alias("text"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        best = best_rows(rows.repartition(16), ["k"], "v")
        assert best.count() == 400_000
        best.write.format("noop").mode("overwrite").save()
        best.collect()
        assert "skew=true" in plan(best).split("Initial Plan")[0]
    finally:
        for name in settings:
            spark.conf.unset(name)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")
