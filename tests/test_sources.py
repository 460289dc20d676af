import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millrace import session
from millrace.sources import database
from millrace.plans import weather
from millrace.sources.database import move_statements, run_in_transaction
from millrace.sources.messages import ordered_feeds, publish
from millrace.sources.sinks import append_csv, write_lines
from millrace.sources.tables import read_lines, read_lookup, read_quoted, read_table, rejected_lookup


def test_lines_from_many_paths(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.txt").write_text(f"{name}1\n{name}2\n")
    paths = [str(tmp_path / "a.txt"), str(tmp_path / "b.txt")]
    assert sorted(r.value for r in read_lines(spark, paths).collect()) == ["a1", "a2", "b1", "b2"]
    assert read_lines(spark, paths[0]).count() == 2


def test_lookup_file(spark, tmp_path):
    (tmp_path / "city.txt").write_text("31 northport\n32\teastvale\n\n33 new  port\nlonely\n0  unknown \n")
    rows = {tuple(r) for r in read_lookup(spark, str(tmp_path / "city.txt")).collect()}
    assert rows == {("31", "northport"), ("32", "eastvale"), ("33", "new  port"), ("0", "unknown")}
    assert sorted(r.value for r in rejected_lookup(spark, str(tmp_path / "city.txt")).collect()) == ["", "lonely"]


def test_quoted_fields_and_bad_numbers(spark, tmp_path):
    (tmp_path / "t.csv").write_text('n,text\n"1","a, \\"b\\""\n"x",plain\n')
    rows = read_quoted(spark, str(tmp_path / "t.csv"), {"n": "int", "text": "string"}).collect()
    assert [tuple(r) for r in rows] == [(1, 'a, "b"'), (None, "plain")]


def test_lines_write_nulls_as_empty_fields(spark, tmp_path):
    rows = spark.createDataFrame([("a", None, 1.5)], "x string, y string, z double")
    write_lines(rows, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).first().value == "a,,1.5"


def test_append_and_file_limit(spark, tmp_path):
    rows = spark.range(1000).repartition(40)
    for _ in range(2):
        append_csv(rows, str(tmp_path / "out"), files=4)
    assert len(list((tmp_path / "out").glob("part-*"))) == 8
    assert read_table(spark, str(tmp_path / "out"), ["id"]).count() == 2000


def test_weather_rows(spark, tmp_path):
    (tmp_path / "part-0").write_text("AG000060390,1940-01-02,88,202,,,0\nAG000060390,1940-01-01,47,224,,,x\n")
    rows = weather.read_weather(spark, str(tmp_path / "part-0"))
    assert weather.row_count(rows).first()[0] == 2
    first = weather.first_days(rows, 1).first()
    assert (str(first.date), first.tmin, first.snow, first.prcp) == ("1940-01-01", 47, None, None)


class Connection:
    """Records what an export does to its database."""

    def __init__(self, fails_on=None):
        self.log, self.fails_on = [], fails_on

    def setAutoCommit(self, on):
        self.log.append(("autocommit", on))

    def createStatement(self):
        return self

    def executeUpdate(self, text):
        self.log.append(text)
        if self.fails_on and text.startswith(self.fails_on):
            raise RuntimeError("no")

    def __getattr__(self, name):
        return lambda: self.log.append(name)


def test_export_moves_in_one_transaction():
    connection = Connection()
    run_in_transaction(connection, move_statements("weather", "weather_stage", ["a", "b"]))
    assert connection.log == [
        ("autocommit", False),
        "INSERT INTO weather (a, b) SELECT a, b FROM weather_stage",
        "DELETE FROM weather_stage",
        "commit", "close", "close",
    ]


def test_a_failed_move_is_rolled_back():
    connection = Connection(fails_on="DELETE")
    with pytest.raises(RuntimeError):
        run_in_transaction(connection, move_statements("weather", "weather_stage", ["a"]))
    assert "rollback" in connection.log and "commit" not in connection.log


def test_published_files_are_appended(spark, tmp_path):
    messages = spark.createDataFrame([("k", "v", 1)], "key string, value string, seq bigint")
    for _ in range(2):
        publish(messages, str(tmp_path / "topic"), "json")
    assert spark.read.json(str(tmp_path / "topic")).count() == 2


def test_shared_folder_comes_from_the_session(spark, monkeypatch):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_folder(spark) == named
    assert session.run_folder(spark, "x").startswith(f"{named}/x-")
    assert session.run_folder(spark, "x") != session.run_folder(spark, "x")


def test_temporary_table_is_a_written_table(spark):
    table = session.temporary_table(spark.range(5).withColumn("x", F.rand()), "five")
    assert table.collect() == table.collect()
    assert spark.sql("SELECT count(*) FROM five").first()[0] == 5
    assert "FileScan" in table._jdf.queryExecution().executedPlan().toString()


class Staging:
    """Stands in for rows whose staging table ends up with the given counts."""

    def __init__(self, monkeypatch, rows, counts):
        self.sparkSession, self.columns, self.rows, self.written = None, ["a"], rows, 0
        self.statements, left = [], iter(counts)
        monkeypatch.setattr(database, "written", lambda rows, purpose: rows)
        monkeypatch.setattr(database, "staged_count", lambda *_: next(left))
        monkeypatch.setattr(database, "open_connection", lambda *_: None)
        monkeypatch.setattr(database, "run_in_transaction", lambda _, statements: self.statements.extend(statements))

    def count(self):
        return self.rows

    def jdbc(self, url, table, properties):
        assert table == "stage"
        self.written += 1

    def __getattr__(self, name):
        return self if name == "write" else lambda *_: self


def test_export_fills_the_staging_table_again_after_a_double_write(monkeypatch):
    rows = Staging(monkeypatch, 10, [12, 10])
    assert database.export_table(rows, "url", "target", "stage", {}) == 10
    assert rows.written == 2 and len(rows.statements) == 2


def test_export_leaves_the_target_alone_when_counts_never_agree(monkeypatch):
    rows = Staging(monkeypatch, 10, [11, 11, 11])
    with pytest.raises(RuntimeError, match="target is unchanged"):
        database.export_table(rows, "url", "target", "stage", {})
    assert rows.written == 3 and rows.statements == []


def test_weather_tables_and_checks(spark, monkeypatch):
    connection = Connection()
    monkeypatch.setattr(weather, "open_connection", lambda *_: connection)
    weather.prepare_tables(spark, "url", {})
    assert [text for text in connection.log if isinstance(text, str)] == [*weather.PREPARE, "commit", "close", "close"]
    asked = []
    monkeypatch.setattr(weather, "answer", lambda spark, url, query, properties: asked.append(query))
    weather.check_export(spark, "url", {})
    assert asked == weather.CHECKS


@pytest.mark.parametrize("ranges", [1, 3])
def test_feeds_are_small_and_in_time_order_for_each_key(spark, ranges):
    """What no trigger takes whole is cut by keys, and a busy key by times."""
    start, generator = dt.datetime(2024, 1, 1), random.Random(2)
    rows = [("busy" if at % 2 else f"k{at % 40}", f"v{at}", at, start + dt.timedelta(minutes=generator.randint(0, 5000))) for at in range(2000)]
    rows += [(None, "no key", 2000, start), ("k1", "no time", 2001, None)]
    messages = spark.createDataFrame(rows, "key string, value string, seq bigint, at timestamp").repartition(5)
    feeds = [[tuple(r) for r in feed.collect()] for feed in ordered_feeds(messages, ranges=ranges, rows=150)]
    assert sorted(sum(feeds, []), key=lambda r: r[2]) == [r[:3] for r in rows] and max(map(len, feeds)) < 250
    times, latest = {r[2]: r[3] or dt.datetime.min for r in rows}, {}
    for feed in feeds:
        for key in {r[0] for r in feed}:
            known = [times[r[2]] for r in feed if r[0] == key]
            assert min(known) >= latest.get(key, dt.datetime.min)
            latest[key] = max(known)
    assert ranges > 1 or all(sum(r[0] == key for r in feed) in (0, sum(r[0] == key for r in rows)) for feed in feeds for key in ("k2", "k4", None))


def test_few_messages_are_one_feed(spark):
    messages = spark.createDataFrame([("a", "x", 1, dt.datetime(2024, 1, 1))], "key string, value string, seq bigint, at timestamp")
    assert [feed.columns for feed in ordered_feeds(messages)] == [["key", "value", "seq"]]
    assert sum(feed.count() for feed in ordered_feeds(messages, ranges=4)) == 1
