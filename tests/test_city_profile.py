from millrace.operators.ranking import most_frequent
from millrace.plans import city_profile as jobs

IE = "Mozilla/5.0 (compatible; MSIE 9.0; Windows NT 6.1; Trident/5.0)"
FIREFOX = "Mozilla/5.0 (X11; Ubuntu; Linux x86_64; rv:15.0) Gecko/20100101 Firefox/15.0.1"
IPHONE = (
    "Mozilla/5.0 (iPhone; CPU iPhone OS 6_0 like Mac OS X) AppleWebKit/536.26 Version/6.0 Mobile/10A403 Safari/8536.25"
)


def logs(spark, *rows):
    return spark.createDataFrame(list(rows), "city_id int, user_agent string")


def test_agent_lines(spark):
    lines = spark.createDataFrame([(f"234\t{IE}",), ("1\t2\t3",), ("1",)], "value string")
    parsed = jobs.parse_agent_lines(lines)
    families = jobs.agent_families(parsed.where("valid")).collect()
    assert [tuple(r) for r in families] == [("234", "Other", "Windows", "IE")]
    assert [r.value for r in parsed.where("not valid").collect()] == ["1\t2\t3", "1"]


def test_profile(spark):
    rows = logs(spark, (1, IE), (1, IE), (1, FIREFOX), (2, IPHONE), (2, FIREFOX), (2, IPHONE), (3, None))
    assert {tuple(r) for r in jobs.city_profile(rows).collect()} == {
        (1, "Windows", "IE", "Other"), (2, "iOS", "Mobile Safari", "iPhone"), (3, "Other", "Other", "Other"),
    }


def test_ties_take_the_smallest_name(spark):
    rows = logs(spark, (1, IE), (1, FIREFOX))
    assert tuple(jobs.city_profile(rows).first()) == (1, "Ubuntu", "Firefox", "Other")


def test_rows_without_a_city_report_the_system_only(spark):
    rows = logs(spark, (None, IE))
    assert tuple(jobs.city_profile(rows).first()) == (None, "Windows", None, None)


def test_joined_profile_is_the_same(spark):
    rows = logs(spark, (1, IE), (1, IE), (1, FIREFOX), (2, IPHONE), (2, FIREFOX), (None, IE))
    families = jobs.agent_families(rows)
    joined = jobs.joined_profile(*[most_frequent(families, ["city_id"], kind) for kind in jobs.KINDS])
    assert sorted(joined.collect(), key=str) == sorted(jobs.city_profile(rows).collect(), key=str)


def test_logs_are_read_once_and_agents_counted_first(spark, tmp_path, plan):
    logs(spark, (1, IE)).write.parquet(str(tmp_path / "logs"))
    text = plan(jobs.city_profile(spark.read.parquet(str(tmp_path / "logs"))))
    assert text.count("FileScan") == 1 and "Window" not in text and "Join" not in text
