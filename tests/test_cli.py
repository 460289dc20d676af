import pytest

from millrace import cli
from test_bids_by_city import line as ad_line
from test_city_profile import IE
from test_flights import HEADER, ROWS
from test_sensors import START, record


@pytest.fixture
def run(spark):
    def go(*arguments):
        args = cli.parser().parse_args([str(argument) for argument in arguments])
        return args.run(spark, args)

    return go


def read(spark, path):
    return sorted(r.value for r in spark.read.text(str(path)).collect())


def test_words(run, spark, tmp_path):
    (tmp_path / "a.txt").write_text("one three three\n")
    (tmp_path / "b.txt").write_text("three seven\n")
    run("longest-words", tmp_path / "a.txt", tmp_path / "b.txt", "--top", 2, "--output", tmp_path / "long")
    assert read(spark, tmp_path / "long") == ["seven", "three"]
    run("most-used-word", tmp_path / "a.txt", tmp_path / "b.txt", "--output", tmp_path / "most")
    assert read(spark, tmp_path / "most") == ["3\tthree"]


def test_log_stats(run, spark, tmp_path, capsys):
    (tmp_path / "log").write_text(f'ip1 - - [t] "GET /" 200 10 "-" "{IE}"\nip1 - - [t] "GET /" 200 x "-" "-"\n')
    run("log-stats", tmp_path / "log", "--compress", "false", "--output", tmp_path / "out")
    assert read(spark, tmp_path / "out" / "traffic") == ["ip1,10.0,10"]
    assert read(spark, tmp_path / "out" / "browsers") == ["IE\t1"]
    assert read(spark, tmp_path / "out" / "bad_lines") == ["2\t1"]
    run("log-stats", tmp_path / "log")
    shown = capsys.readouterr().out
    assert "IE" in shown and "|2    |1        |" in shown and "further rows" not in shown


def test_rows_that_are_not_shown_are_counted(run, spark, tmp_path, capsys):
    (tmp_path / "a.txt").write_text("\n".join(f"word{i:03d}" for i in range(130)) + "\n")
    run("longest-words", tmp_path / "a.txt", "--top", 130)
    assert "30 further rows" in capsys.readouterr().out
    run("longest-words", tmp_path / "a.txt", "--top", 130, "--output", tmp_path / "out")
    assert len(read(spark, tmp_path / "out")) == 130


def test_city_bids(run, spark, tmp_path, capsys):
    (tmp_path / "ads").write_text("\n".join([ad_line(city="126"), ad_line(city="9"), ad_line("nnnn")]) + "\n")
    (tmp_path / "cities").write_text("126 north port\nlonely\n")
    run(
        "city-bids", tmp_path / "ads", "--city_names_file", tmp_path / "cities", "--by_os", "--reducers_num", 2,
        "--output", tmp_path / "out",
    )
    assert read(spark, tmp_path / "out" / "by_city") == ["north port\t1"]
    assert read(spark, tmp_path / "out" / "by_os") == ["Windows\t126\t1", "Windows\t9\t1"]
    assert read(spark, tmp_path / "out" / "bad_lines") == ["3\t1"]
    assert len(read(spark, tmp_path / "out" / "unknown_cities")) == 1
    assert read(spark, tmp_path / "out" / "rejected_city_names") == ["lonely"]
    run("city-bids", tmp_path / "ads", "--output", tmp_path / "ids")
    assert read(spark, tmp_path / "ids" / "by_city") == ["126\t1", "9\t1"]


def test_flights_and_sql(run, spark, tmp_path):
    (tmp_path / "carriers.csv").write_text("Code,Description\nWN,Southwest\n")
    (tmp_path / "airports.csv").write_text("iata,airport,city,state,country,lat,lon\nJFK,Kennedy,New York,NY,USA,1,2\n")
    (tmp_path / "2007.csv").write_text("\n".join([HEADER, *ROWS]) + "\n")
    warehouse = tmp_path / "warehouse"
    run(
        "load-flights", "--carriers", tmp_path / "carriers.csv", "--airports", tmp_path / "airports.csv",
        "--flights", tmp_path / "2007.csv", "--warehouse", warehouse,
    )
    expected = {
        "per_carrier": ["AA\t2", "UA\t1", "WN\t4"],
        "top_carrier": ["WN\t4"],
        "city_departures": ["1"],
        "busiest_airports": ["JFK\t4", "LGA\t1", "ORD\t4", "XXX\t1"],
    }
    for question, lines in expected.items():
        run("flights", question, "--warehouse", warehouse, "--output", tmp_path / question)
        assert read(spark, tmp_path / question) == lines
    (tmp_path / "q.sql").write_text("SELECT uniquecarrier, count(*) FROM y2007 WHERE cancelled = 1 GROUP BY 1;\n")
    run("sql", tmp_path / "q.sql", "--warehouse", warehouse, "--tables", "y2007", "--output", tmp_path / "sql")
    assert read(spark, tmp_path / "sql") == ["AA\t2", "UA\t1", "WN\t2"]


def test_city_profile(run, spark, tmp_path):
    header = "\t".join(cli.AD_LOGS)
    (tmp_path / "logs").write_text("\n".join([header, ad_line(city="7"), ad_line(city="7", agent="x")]) + "\n")
    run("city-profile", tmp_path / "logs", "--output", tmp_path / "out")
    assert read(spark, tmp_path / "out") == ["7\tOther\tIE\tOther"]


def test_motels(run, spark, tmp_path):
    (tmp_path / "bids").write_text("1,15-04-08-2016,0.89,,,2.07,,,0.5\n1,15-04-08-2016,ERROR_X\n")
    (tmp_path / "rates").write_text("15-04-08-2016,Euro,EUR,0.803\n")
    (tmp_path / "motels").write_text("1,Inn,HU,http://x,text\n")
    for files in (16, 0):
        out = tmp_path / f"out{files}"
        run(
            "motels", "--bids_path", tmp_path / "bids", "--exchange_rate_path", tmp_path / "rates",
            "--motels_path", tmp_path / "motels", "--result_path", out, "--files", files,
        )
        assert read(spark, out / "aggregated") == ["1,Inn,2016-08-04 15:00,US,1.662"]
        assert read(spark, out / "erroneous") == ["15-04-08-2016,ERROR_X,1"]


def test_sensor_arguments(spark, tmp_path, monkeypatch):
    """The Kafka options of the sensor jobs, without a broker."""
    seen = {}
    monkeypatch.setattr(cli.sensors, "publish_readings", lambda rows, topic, **options: seen.update(rows=rows, topic=topic, **options))
    (tmp_path / "readings.csv").write_text(",".join(f or "" for f in record("10", START, "0.5")) + "\n")
    args = cli.parser().parse_args(["publish-readings", str(tmp_path / "readings.csv"), "--brokers", "h:1"])
    args.run(spark, args)
    assert seen["topic"] == "monitoring20" and seen["kafka.bootstrap.servers"] == "h:1"
    assert seen["rows"].first().sampleMeasurement == "0.5"


def test_jobs_need_their_arguments():
    for arguments in (["longest-words", "x"], ["motels"], ["log-stats", "x", "--compress", "maybe"], []):
        with pytest.raises(SystemExit):
            cli.parser().parse_args(arguments)
