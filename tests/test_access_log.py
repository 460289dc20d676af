import pytest

from millrace.functions.logs import parse_access, rejected
from millrace.plans.access_log import bad_lines, requests_by_browser, traffic_by_ip, write_traffic

LINE = (
    "ip77 - - [03/Mar/2019:08:07:06 +0100] \"GET /plants/fern.html?page=2 HTTP/1.0\" 304 {} "
    "\"http://garden.example/plants/\" \"Mozilla/5.0 (compatible; MSIE 9.0; Windows NT 6.1; Trident/5.0; KitProbe 2.3)\""
)


def lines(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "value string")


@pytest.mark.parametrize("size, expected", [("40719", ("ip77", 40719.0, 40719)), ("-", ("ip77", 0.0, 0))])
def test_one_line(spark, size, expected):
    log = lines(spark, LINE.format(size))
    assert [tuple(r) for r in traffic_by_ip(log).collect()] == [expected]
    assert [tuple(r) for r in requests_by_browser(log).collect()] == [("IE", 1)]
    assert tuple(bad_lines(log).first()) == (1, 0)


def test_line_with_a_word_for_its_size_is_rejected(spark):
    log = lines(spark, LINE.format("bytes"))
    assert traffic_by_ip(log).count() == 0
    assert requests_by_browser(log).count() == 0
    assert tuple(bad_lines(log).first()) == (1, 1)
    assert [r.value for r in rejected(parse_access(log)).collect()] == [LINE.format("bytes")]


def test_a_size_beyond_bigint_is_rejected_not_counted_as_zero(spark):
    log = lines(spark, LINE.format("9" * 30), LINE.format("5"))
    assert [tuple(r) for r in traffic_by_ip(log).collect()] == [("ip77", 5.0, 5)]
    assert tuple(bad_lines(log).first()) == (2, 1)


def test_average_has_two_decimals(spark):
    sizes = [100] + [333] * 5
    rows = traffic_by_ip(lines(spark, *[LINE.format(size) for size in sizes])).collect()
    assert [tuple(r) for r in rows] == [("ip77", 294.17, 1765)]


def test_fields_have_no_quotes_and_must_start_the_line(spark):
    row = parse_access(lines(spark, LINE.format(7))).first()
    assert row.request == "GET /plants/fern.html?page=2 HTTP/1.0"
    assert row.status == "304" and row.time == "[03/Mar/2019:08:07:06 +0100]"
    assert row.user_agent.startswith("Mozilla/5.0") and row.user_agent.endswith("KitProbe 2.3)")
    assert tuple(bad_lines(lines(spark, "x" + LINE.format(7), "", "ip1")).first()) == (3, 3)


def test_text_after_the_last_quote_is_ignored(spark):
    row = parse_access(lines(spark, LINE.format(7) + " more")).first()
    assert row.valid and row.user_agent.endswith("KitProbe 2.3)")


@pytest.mark.parametrize("compress", [True, False])
@pytest.mark.parametrize("output_format", ["csv", "sequence"])
def test_outputs(spark, tmp_path, output_format, compress):
    stats = traffic_by_ip(lines(spark, LINE.format(10), LINE.format(11)))
    folder = str(tmp_path / "out")
    write_traffic(stats, folder, output_format, compress)
    names = [p.name for p in (tmp_path / "out").iterdir() if p.name.startswith("part")]
    if output_format == "csv":
        assert all(name.endswith(".snappy") == compress for name in names)
        assert [r.value for r in spark.read.text(folder).collect()] == ["ip77,10.5,21"] or compress
        assert [tuple(r) for r in spark.read.csv(folder).collect()] == [("ip77", "10.5", "21")]
    else:
        assert spark.sparkContext.sequenceFile(folder).collect() == [('"ip77"', "[10.5, 21]")]
        header = next(p for p in (tmp_path / "out").iterdir() if p.name.startswith("part")).read_bytes()[:200]
        assert (b"SnappyCodec" in header) == compress


def test_the_pattern_runs_once_per_line(spark, plan):
    assert plan(traffic_by_ip(lines(spark, LINE))).split("Initial Plan")[0].count("regexp_replace(") == 1
