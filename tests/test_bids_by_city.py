from millrace.functions.agents import OS_RULES, browser, device, family, operating_system
from millrace.functions.logs import parse_ad_log, rejected
from millrace.plans import bids_by_city as jobs
from pyspark.sql import functions as F

AGENT = "Mozilla/5.0 (compatible; MSIE 9.0; Windows NT 6.1; Trident/5.0)"
PROFILE = "20011,20044,20102"


def line(price="301", city="55", agent=AGENT, **other):
    fields = {
        0: "0f1e2d3c4b5a69788796a5b4c3d2e1f0", 1: "20190303080706005", 2: "1", 3: "PLQ7XYZ0abc", 4: agent,
        5: "10.20.30.*", 6: "81", 7: city, 8: "3", 9: "00112233445566778899aabbccddeeff",
        10: "ffeeddccbbaa99887766554433221100", 11: "null", 12: "7000000001", 13: "300", 14: "250", 15: "FirstView",
        16: "Na", 17: "12", 18: "4412", 19: price, 20: "77", 21: "null", 22: "9001", 23: PROFILE,
    }
    fields.update({int(name[1:]): value for name, value in other.items()})
    return "\t".join(fields[at] for at in range(24))


def lines(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "value string")


def counts(frame):
    return {tuple(r)[:-1]: tuple(r)[-1] for r in frame.collect()}


def test_threshold_is_strict(spark):
    log = lines(spark, line("301"), line("120"), line("250"), line("251"))
    assert counts(jobs.bids_by_city(log)) == {("55",): 2}


def test_bad_lines_are_counted_and_kept(spark):
    log = lines(spark, line("nnnn"), line(), "", line(c11="http://x"), line(c16="Fixed"), line(c8="B"), "a\tb")
    assert tuple(jobs.bad_lines(log).first()) == (7, 6)
    assert rejected(parse_ad_log(log)).count() == 6
    assert counts(jobs.bids_by_city(log)) == {("55",): 1}


def test_a_further_tab_belongs_to_the_last_column(spark):
    row = parse_ad_log(lines(spark, line() + "\tmore")).first()
    assert row.valid and row.user_profile_ids == PROFILE + "\tmore"


def test_city_names_and_unknown_cities(spark):
    log = lines(spark, *[line(city="31")] * 7, *[line(city="32")] * 4, line(city="999"), line("1", city="998"))
    cities = spark.createDataFrame([("31", "northport"), ("32", "eastvale"), ("0", "unknown")], "city_id string, name string")
    assert counts(jobs.bids_by_city(log, cities)) == {("northport",): 7, ("eastvale",): 4}
    assert tuple(jobs.unknown_cities(log, cities).first()) == (1, 1)


def test_breakdown_by_system_and_exact_totals(spark):
    linux = "Mozilla/5.0 (X11; Ubuntu; Linux x86_64; rv:15.0) Gecko/20100101 Firefox/15.0.1"
    log = lines(spark, *[line(city="1")] * 5, *[line(city="1", agent=linux)] * 3, *[line(city="2")] * 4)
    by_os = jobs.bids_by_os_and_city(log)
    assert counts(by_os) == {("Windows", "1"): 5, ("Ubuntu", "1"): 3, ("Windows", "2"): 4}
    assert counts(jobs.city_totals(by_os)) == {("1",): 8, ("2",): 4}


def test_one_system_per_partition_cities_in_numeric_order(spark):
    rows = [(os, str(city), 1) for os in ("a", "b", "c") for city in (10, 9, 100, 2)]
    routed = jobs.routed_by_os(spark.createDataFrame(rows, "os string, city_id string, n bigint"), 5)
    assert routed.rdd.getNumPartitions() == 5
    placed = routed.withColumn("at", F.spark_partition_id()).collect()
    for os in ("a", "b", "c"):
        assert len({r["at"] for r in placed if r.os == os}) == 1
        assert [r.city_id for r in placed if r.os == os] == ["2", "9", "10", "100"]


def test_agent_families(spark):
    agents = spark.createDataFrame([(AGENT,), ("curl/7.26.0",)], "ua string")
    rows = agents.select(device("ua"), operating_system("ua"), browser("ua")).collect()
    assert [tuple(r) for r in rows] == [("Other", "Windows", "IE"), ("Other", "Other", "Other")]


def test_first_rule_that_fits_wins(spark):
    agents = spark.createDataFrame([("Linux Ubuntu",), ("Linux",), ("x",), (None,)], "ua string")
    assert [r[0] for r in agents.select(family("ua", OS_RULES)).collect()] == ["Ubuntu", "Linux", "Other", "Other"]
    assert [r[0] for r in agents.select(family("ua", [])).collect()] == ["Other"] * 4


def test_counting_precedes_the_lookup(spark, plan):
    cities = spark.createDataFrame([("31", "northport")], "city_id string, name string")
    text = plan(jobs.bids_by_city(lines(spark, line()), cities))
    assert "partial_count(1)" in text and "CartesianProduct" not in text and "Window" not in text
