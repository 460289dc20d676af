from millrace.plans import flights as jobs

HEADER = (
    "Year,Month,DayofMonth,DayOfWeek,DepTime,CRSDepTime,ArrTime,CRSArrTime,UniqueCarrier,FlightNum,TailNum,"
    "ActualElapsedTime,CRSElapsedTime,AirTime,ArrDelay,DepDelay,Origin,Dest,Distance,TaxiIn,TaxiOut,Cancelled,"
    "CancellationCode,Diverted,CarrierDelay,WeatherDelay,NASDelay,SecurityDelay,LateAircraftDelay"
)


def flight(month, carrier, origin, dest, cancelled=0, code=""):
    return f"2007,{month},1,1,NA,1900,NA,2000,{carrier},12,N1,NA,60,NA,NA,NA,{origin},{dest},300,0,0,{cancelled},{code},0,0,0,0,0,0"


def load(spark, tmp_path, rows):
    (tmp_path / "carriers.csv").write_text('Code,Description\n"WN","Southwest, Inc."\n')
    (tmp_path / "airports.csv").write_text(
        '"iata","airport","city","state","country","lat","lon"\n'
        '"JFK","John F Kennedy","New York","NY","USA",40.6,-73.7\n"LGA","LaGuardia","New York","NY","USA",40.7,-73.8\n'
        '"ORD","O\'Hare","Chicago","IL","USA",41.9,-87.9\n'
    )
    (tmp_path / "2007.csv").write_text("\n".join([HEADER, *rows]) + "\n")
    paths = {"carriers": "carriers.csv", "airports": "airports.csv", "y2007": "2007.csv"}
    return jobs.load_tables(spark, {k: str(tmp_path / v) for k, v in paths.items()}, str(tmp_path / "warehouse"))


ROWS = [
    flight(6, "WN", "JFK", "ORD"),
    flight(6, "WN", "LGA", "ORD"),
    flight(6, "AA", "ORD", "JFK", 1, "A"),
    flight(7, "AA", "JFK", "ORD", 1, "B"),
    flight(8, "WN", "XXX", "JFK", 1, "A"),
    flight(9, "WN", "XXX", "LGA", 1, "A"),
    flight(9, "UA", "JFK", "LGA", 1, "A"),
]


def test_tables(spark, tmp_path):
    tables = load(spark, tmp_path, ROWS)
    assert tables["carriers"].first().description == "Southwest, Inc."
    row = tables["y2007"].first()
    assert (row.Year, row.DepTime, row.CRSDepTime, row.CancellationCode) == (2007, None, 1900, None)
    assert tables["airports"].where("iata = 'JFK'").first().lat == 40.6
    assert spark.sql("SELECT count(*) FROM y2007 JOIN airports ON Origin = iata").first()[0] == 5
    assert load(spark, tmp_path, ROWS[:2])["y2007"].count() == 2


def test_questions(spark, tmp_path):
    tables = load(spark, tmp_path, ROWS)
    y2007, airports = tables["y2007"], tables["airports"]
    assert {tuple(r) for r in jobs.flights_per_carrier(y2007).collect()} == {("WN", 4), ("AA", 2), ("UA", 1)}
    assert tuple(jobs.top_carrier(y2007).first()) == ("WN", 4)
    assert jobs.city_departures(y2007, airports).first()[0] == 2
    assert jobs.city_departures(y2007, airports, "Nowhere").first()[0] == 0
    assert [tuple(r) for r in jobs.busiest_airports(y2007, top=3).collect()] == [("JFK", 4), ("ORD", 4), ("LGA", 1)]


def test_cancellations(spark, tmp_path):
    tables = load(spark, tmp_path, ROWS)
    rows = jobs.cancelled_by_carrier(tables["y2007"], tables["airports"]).collect()
    assert [tuple(r) for r in rows] == [("AA", 2, ["Chicago", "New York"]), ("WN", 2, [])]


def test_scan_reads_what_it_needs(spark, tmp_path, plan):
    tables = load(spark, tmp_path, ROWS)
    text = plan(jobs.city_departures(tables["y2007"], tables["airports"]))
    assert "PushedFilters: [IsNotNull(Month), EqualTo(Month,6), IsNotNull(Origin)]" in text
    assert "ReadSchema: struct<Month:int,Origin:string>" in text
    assert plan(jobs.busiest_airports(tables["y2007"])).count("FileScan") == 1
