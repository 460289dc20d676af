import pytest

from millrace.functions.dates import bid_hour
from millrace.functions.numbers import to_euro
from millrace.plans import motels as jobs
from millrace.schemas import EXCHANGE_RATES, MOTELS, RAW_BIDS
from millrace.sources.tables import read_table


def bids(spark, *rows):
    """Rows as (motel, hour, HU, US, MX, CA); the other countries are filled in."""
    full = []
    for motel, hour, *prices in rows:
        named = dict(zip(["HU", "US", "MX", "CA"], prices))
        full.append((motel, hour, *[named.get(name) for name in RAW_BIDS[2:]]))
    return spark.createDataFrame(full, ", ".join(f"{name} string" for name in RAW_BIDS))


def rates(spark, *rows):
    return spark.createDataFrame([(hour, "Euro", "EUR", rate) for hour, rate in rows], ", ".join(f"{c} string" for c in EXCHANGE_RATES))


def names(spark, *rows):
    return spark.createDataFrame(list(rows), ", ".join(f"{c} string" for c in MOTELS))


def test_dates_and_prices(spark):
    row = spark.createDataFrame([("23-17-11-2014", "100", "")], "d string, p string, e string").select(
        bid_hour("d"), to_euro("p", "p"), to_euro("e", "p"), bid_hour("p")
    )
    assert tuple(row.first()) == ("2014-11-17 23:00", 10000.0, None, None)
    third = spark.createDataFrame([("250", "0.1234567")], "p string, r string").select(to_euro("p", "r"))
    assert third.first()[0] == 30.864


def test_error_counts(spark):
    raw = bids(
        spark, ("1", "03-09-10-2017", "ERROR_1"), ("2", "21-02-04-2015", "1.10"), ("3", "04-09-10-2017", "ERROR_2"),
        ("4", "03-09-10-2017", "ERROR_1"), ("5", "03-09-10-2017", "ERROR_2"), ("6", "03-09-10-2017", None),
    )
    assert {tuple(r) for r in jobs.error_counts(raw).collect()} == {
        ("03-09-10-2017", "ERROR_1", 2), ("03-09-10-2017", "ERROR_2", 1), ("04-09-10-2017", "ERROR_2", 1),
    }


def test_offers(spark):
    raw = bids(
        spark, ("0000042", "07-19-12-2018", "1.10", "3.25", "", "1.10"), ("0000017", "10-30-03-2013", "ERROR_NOTHING_OFFERED")
    )
    found = jobs.offers(raw, rates(spark, ("07-19-12-2018", "0.72"), ("10-30-03-2013", "0.91"))).collect()
    assert {tuple(r) for r in found} == {
        ("0000042", "US", "2018-12-19 07:00", 2.34), ("0000042", "CA", "2018-12-19 07:00", 0.792),
    }


def test_offers_of_three_countries(spark):
    found = jobs.offers(bids(spark, ("2", "09-13-01-2020", "1.01", "0.75", "1.45", "2.05")), rates(spark, ("09-13-01-2020", "0.8")))
    assert {(r.loSa, r.BidDate, r.price) for r in found.collect()} == {
        ("US", "2020-01-13 09:00", 0.6), ("MX", "2020-01-13 09:00", 1.16), ("CA", "2020-01-13 09:00", 1.64),
    }


def test_empty_first_price_is_no_error(spark):
    assert jobs.offers(bids(spark, ("1", "09-13-01-2020", None, "1")), rates(spark, ("09-13-01-2020", "1"))).count() == 1


def test_best_offer_has_the_name(spark):
    raw = bids(spark, ("0000042", "07-19-12-2018", "1.10", "3.25", None, "1.10"))
    best = jobs.best_offers(raw, rates(spark, ("07-19-12-2018", "0.72")), names(spark, ("0000042", "Harbour Rest")))
    assert [tuple(r) for r in best.collect()] == [("0000042", "Harbour Rest", "2018-12-19 07:00", "US", 2.34)]


def test_ties(spark):
    raw = bids(spark, ("2", "07-19-12-2018", "1.10", "1.10", "1.10", "1.10"), ("2", "07-19-12-2018", "0.1", "0.5", "1.10", "bad"))
    prices, motels = rates(spark, ("07-19-12-2018", "0.72")), names(spark)
    everything = jobs.best_offers(raw, prices, motels).collect()
    assert sorted((r.loSa, r.price, r.MotelName) for r in everything) == [
        ("CA", 0.792, None), ("MX", 0.792, None), ("MX", 0.792, None), ("US", 0.792, None),
    ]
    first = jobs.best_offers(raw, prices, motels, ties="first").collect()
    assert [(r.loSa, r.price) for r in first] == [("CA", 0.792)]
    with pytest.raises(ValueError):
        jobs.best_offers(raw, prices, motels, ties="any")


def test_bids_without_rate_are_dropped_and_counted(spark):
    raw = bids(spark, ("1", "09-13-01-2020", "1", "2", "3", "4"), ("1", "10-13-01-2020", "1", "2"), ("1", "10-13-01-2020", "1", None))
    known = rates(spark, ("09-13-01-2020", "1"))
    assert jobs.best_offers(raw, known, names(spark)).count() == 1
    assert jobs.unrated_bids(raw, known).first().bids == 1


def test_best_offers_agree_with_the_offers(spark):
    import random

    generator = random.Random(3)
    hours = [f"{hour:02d}-05-08-2016" for hour in range(5)]
    texts = ["", None, "x", "0.5", "0.50", "1", "1.5", "2.25", "2.2500"]
    raw = bids(spark, *[(str(generator.randrange(4)), generator.choice(hours), "1", *generator.choices(texts, k=3)) for _ in range(400)])
    # One hour has two rates, another has none.
    known = rates(spark, *[(hour, f"0.{80 + at}") for at, hour in enumerate(hours[:4])], (hours[0], "0.95"))
    motels = names(spark, ("1", "one"))
    offers = [tuple(r) for r in jobs.offers(raw, known).collect()]
    top = {}
    for motel, _, hour, price in offers:
        top[motel, hour] = max(price, top.get((motel, hour), 0))
    expected = sorted((m, h, c, p) for m, c, h, p in offers if p == top[m, h])
    for ties, wanted in (("all", expected), ("first", sorted({(m, h): (m, h, c, p) for m, h, c, p in reversed(expected)}.values()))):
        found = jobs.best_offers(raw, known, motels, ties).collect()
        assert sorted((r.MotelID, r.BidDate, r.loSa, r.price) for r in found) == wanted
        assert {r.MotelName for r in found if r.MotelID == "1"} == {"one"}


def test_ragged_and_parquet_inputs(spark, tmp_path):
    folder = tmp_path / "bids"
    folder.mkdir()
    (folder / "a.txt").write_text("0000042,21-02-04-2015,1.10,1.05,1.40,3.25,,1.35\n0000017,03-09-10-2017,ERROR_NOTHING_OFFERED\n")
    (tmp_path / "motels.txt").write_text("0000042,Harbour Rest,I,http://x,sea, sand\n")
    (tmp_path / "rates.txt").write_text("21-02-04-2015,Euro,EUR,0.72\n")
    raw = read_table(spark, str(folder), RAW_BIDS)
    rows = {r.MotelID: r for r in raw.collect()}
    assert rows["0000042"].US == "3.25" and rows["0000042"].MX is None and rows["0000042"].DE is None
    assert rows["0000017"].HU == "ERROR_NOTHING_OFFERED" and rows["0000017"].UK is None
    raw.write.parquet(str(tmp_path / "bids.parquet"))
    for run, path in enumerate([str(folder), str(tmp_path / "bids.parquet")]):
        out = str(tmp_path / f"out{run}")
        jobs.run(spark, path, str(tmp_path / "rates.txt"), str(tmp_path / "motels.txt"), out, as_lines=bool(run))
        assert [r.value for r in spark.read.text(f"{out}/aggregated").collect()] == ["0000042,Harbour Rest,2015-04-02 21:00,US,2.34"]
        assert [r.value for r in spark.read.text(f"{out}/erroneous").collect()] == ["03-09-10-2017,ERROR_NOTHING_OFFERED,1"]


def test_bids_are_reduced_before_each_shuffle_and_never_windowed(spark, plan):
    raw = bids(spark, ("1", "09-13-01-2020", "1", "2", "3", "4"))
    text = plan(jobs.best_offers(raw, rates(spark, ("09-13-01-2020", "1")), names(spark)))
    assert "Window" not in text and "partial_count" in text and "partial_max" in text
    assert "SortAggregate" not in text and "CartesianProduct" not in text


def test_a_busy_hour_leaves_the_partitions_of_the_rate_join(spark, plan):
    """Without a broadcast the prices are shuffled again by motel and hour before they are grouped."""
    raw = bids(spark, ("1", "09-13-01-2020", "1", "2", "3", "4"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(jobs.best_offers(raw, rates(spark, ("09-13-01-2020", "1")), names(spark)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")
    assert "Exchange hashpartitioning(MotelID" in text and "Exchange hashpartitioning(BidDate" in text
