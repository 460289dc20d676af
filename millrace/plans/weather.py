"""Daily weather rows: files to a database table, then two checks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.ranking import top_rows
from millrace.schemas import WEATHER
from millrace.sources.database import answer, export_table, open_connection, run_in_transaction
from millrace.sources.staged import export_staged
from millrace.sources.tables import read_quoted

# The table, its staging twin, and the two checks.
WEATHER_COLUMNS = "stationid varchar(20), date date, tmin int, tmax int, snow int, snwd int, prcp int"
PREPARE = [
    "DROP TABLE IF EXISTS weather",
    f"CREATE TABLE weather ({WEATHER_COLUMNS})",
    "DROP TABLE IF EXISTS weather_stage",
    f"CREATE TABLE weather_stage ({WEATHER_COLUMNS})",
]
CHECKS = ["SELECT count(*) FROM weather", "SELECT * FROM weather ORDER BY stationid, date LIMIT 10"]


def prepare_tables(spark: SparkSession, url: str, properties: Mapping[str, str]) -> None:
    """Empty tables for the export; existing ones are dropped."""
    run_in_transaction(open_connection(spark, url, properties), PREPARE)


def check_export(spark: SparkSession, url: str, properties: Mapping[str, str]) -> list[DataFrame]:
    """The row count and the first ten days, as the database answers them."""
    return [answer(spark, url, query, properties) for query in CHECKS]


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """Headerless comma-separated rows; empty or unreadable measurements are null."""
    return read_quoted(spark, path, WEATHER, header=False)


def first_days(weather: DataFrame, limit: int = 10) -> DataFrame:
    return top_rows(weather, limit, F.asc("stationid"), F.asc("date"))


def row_count(weather: DataFrame) -> DataFrame:
    return weather.agg(F.count(F.lit(1)).alias("rows"))


def export_weather(spark: SparkSession, path: str, url: str, properties: Mapping[str, str]) -> int:
    return export_table(read_weather(spark, path), url, "weather", "weather_stage", properties)


def stage_weather(spark: SparkSession, path: str, target: str) -> int:
    """The same export to a folder, for users without a database; check it with `row_count` and `first_days` of `read_staged`."""
    return export_staged(read_weather(spark, path), target)
