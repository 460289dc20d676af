"""Flight questions over carriers, airports and one year of flights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.joining import count_by
from millrace.operators.ranking import top_rows
from millrace.schemas import AIRPORTS, CARRIERS, FLIGHTS
from millrace.sources.tables import load_overwrite, read_quoted

SUMMER = (6, 7, 8)


def load_tables(spark: SparkSession, paths: dict[str, str], warehouse: str) -> dict[str, DataFrame]:
    """The three quoted CSV files as Parquet tables, replaced on each load, and as temporary views."""
    columns = {"carriers": CARRIERS, "airports": AIRPORTS, "y2007": FLIGHTS}
    tables = {}
    for name, kinds in columns.items():
        tables[name] = load_overwrite(read_quoted(spark, paths[name], kinds), f"{warehouse}/{name}")
        tables[name].createOrReplaceTempView(name)
    return tables


def flights_per_carrier(flights: DataFrame) -> DataFrame:
    return count_by(flights, "UniqueCarrier", n="total_flights")


def top_carrier(flights: DataFrame) -> DataFrame:
    return top_rows(flights_per_carrier(flights), 1, F.desc("total_flights"), F.asc("UniqueCarrier"))


def city_departures(flights: DataFrame, airports: DataFrame, city: str = "New York", month: int = 6) -> DataFrame:
    """Departures from all airports of a city in a month."""
    departures = count_by(flights.where(F.col("Month") == month), "Origin")
    there = airports.where(F.col("city") == city).select("iata")
    joined = departures.join(there, departures["Origin"] == there["iata"])
    return joined.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_flights"))


def busiest_airports(flights: DataFrame, months: Sequence[int] = SUMMER, top: int = 5) -> DataFrame:
    """Airports by departures plus arrivals. Both ends of a flight come from one scan."""
    ends = flights.where(F.col("Month").isin(*months)).select(F.explode(F.array("Origin", "Dest")).alias("airport"))
    totals = ends.groupBy("airport").agg(F.count("airport").alias("total_flights"))
    return top_rows(totals, top, F.desc("total_flights"), F.asc("airport"))


def cancelled_by_carrier(flights: DataFrame, airports: DataFrame, more_than: int = 1) -> DataFrame:
    """Carriers with more than one cancellation and the set of cities they cancelled in.

    Cancellations are counted per carrier and airport before the join, so the set of a carrier
    is built from at most one row per airport.
    """
    counts = count_by(flights.where(F.col("Cancelled") == 1), "UniqueCarrier", "Origin")
    cities = airports.select("iata", "city")
    return (
        counts.join(cities, counts["Origin"] == cities["iata"], "left")
        .groupBy("UniqueCarrier")
        .agg(F.sum("n").alias("cancelled_flights"), F.sort_array(F.collect_set("city")).alias("cities"))
        .where(F.col("cancelled_flights") > more_than)
        .orderBy(F.desc("cancelled_flights"), F.asc("UniqueCarrier"))
    )
