"""Bid errors per hour, and the best price per motel and hour in euro."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.dates import bid_hour
from millrace.functions.numbers import number, round_half_up, to_euro
from millrace.operators.ranking import best_of_columns
from millrace.operators.reshaping import unpivot
from millrace.schemas import BID_COUNTRIES, EXCHANGE_RATES, MOTELS, RAW_BIDS
from millrace.sources.sinks import append_csv, write_lines
from millrace.sources.tables import read_table

ERROR_MARK = "ERROR"


def error_counts(raw_bids: DataFrame) -> DataFrame:
    """How often each error message occurs per hour."""
    return raw_bids.where(F.col("HU").contains(ERROR_MARK)).groupBy("BidDate", "HU").count()


def rated_bids(raw_bids: DataFrame, rates: DataFrame) -> DataFrame:
    """Bids that are no errors, with the exchange rate of their hour; null where there is none.

    A bid with an empty first price is no error and stays.
    """
    return _with_rates(raw_bids, rates).drop("shown")


def _with_rates(raw_bids: DataFrame, rates: DataFrame) -> DataFrame:
    # The hour as the results show it comes with its rate: read once per hour, not once per bid.
    good = raw_bids.where(~F.coalesce("HU", F.lit("")).contains(ERROR_MARK))
    bids = good.select("MotelID", "BidDate", *BID_COUNTRIES)
    hourly = rates.select("ValidFrom", number("ExchangeRate").alias("rate"), bid_hour("ValidFrom").alias("shown"))
    return bids.join(hourly, bids["BidDate"] == hourly["ValidFrom"], "left").drop("ValidFrom")


def offers(raw_bids: DataFrame, rates: DataFrame) -> DataFrame:
    """One row per bid and country with a readable price and a rate, in euro."""
    rated = _with_rates(raw_bids, rates).where("rate is not null")
    prices = unpivot(rated, ["MotelID", "shown", "rate"], BID_COUNTRIES, "loSa", "usd")
    euro = to_euro("usd", "rate")
    return prices.select("MotelID", "loSa", F.col("shown").alias("BidDate"), euro.alias("price")).where(
        F.col("price").isNotNull()
    )


def unrated_bids(raw_bids: DataFrame, rates: DataFrame) -> DataFrame:
    """One row: how many bids have a price but no exchange rate, and so give no offer."""
    priced = reduce(lambda left, right: left | right, [number(country).isNotNull() for country in BID_COUNTRIES])
    return rated_bids(raw_bids, rates).where(F.col("rate").isNull() & priced).agg(F.count(F.lit(1)).alias("bids"))


def best_offers(raw_bids: DataFrame, rates: DataFrame, motels: DataFrame, ties: str = "all") -> DataFrame:
    """The highest price per motel and hour, with the motel's name.

    `ties='all'` keeps every country and bid that reaches it, `ties='first'` the first country in
    alphabetical order. Countries stay columns until the winners are known: a bid is one narrow
    row in the shuffle, and equal bids are counted, not carried along. Names join the winners.
    """
    if ties not in ("all", "first"):
        raise ValueError(f"ties must be 'all' or 'first', not {ties!r}")
    euro = [round_half_up(number(country) * F.col("rate"), 3).alias(country) for country in BID_COUNTRIES]
    # Grouped by the halves of the hour text: grouping by the join key itself would let the
    # aggregation run inside the join's partitions, where a busy hour is a single task.
    halves = [F.substr("BidDate", F.lit(1), F.lit(2)).alias("hour"), F.substr("BidDate", F.lit(3)).alias("day")]
    prices = rated_bids(raw_bids, rates).where("rate is not null").select("MotelID", *halves, *euro)
    winners = best_of_columns(prices, OFFER_KEYS, BID_COUNTRIES, "loSa", "price") if ties == "all" else _first_best(prices)
    names = motels.select("MotelID", "MotelName")
    return winners.join(names, "MotelID", "left").select(
        "MotelID", "MotelName", bid_hour(F.concat("hour", "day")).alias("BidDate"), "loSa", "price"
    )


OFFER_KEYS = ["MotelID", "hour", "day"]


def _first_best(prices: DataFrame) -> DataFrame:
    per_country = prices.groupBy(*OFFER_KEYS).agg(*[F.max(country).alias(country) for country in BID_COUNTRIES])
    top = per_country.withColumn("price", F.greatest(*BID_COUNTRIES)).where(F.col("price").isNotNull())
    country = F.coalesce(*[F.when(F.col(name) == F.col("price"), name) for name in sorted(BID_COUNTRIES)])
    return top.select(*OFFER_KEYS, country.alias("loSa"), "price")


def run(
    spark: SparkSession,
    bids_path: str,
    rates_path: str,
    motels_path: str,
    result_path: str,
    ties: str = "all",
    as_lines: bool = False,
    files: int | None = None,
) -> None:
    """Read the three inputs (Parquet by suffix, else CSV) and write the errors, the best offers and the count of bids without a rate."""
    raw_bids = read_table(spark, bids_path, RAW_BIDS)
    rates = read_table(spark, rates_path, EXCHANGE_RATES)
    motels = read_table(spark, motels_path, MOTELS)
    results = {
        "erroneous": error_counts(raw_bids),
        "aggregated": best_offers(raw_bids, rates, motels, ties),
        "unrated": unrated_bids(raw_bids, rates),
    }
    for folder, rows in results.items():
        if as_lines:
            write_lines(rows, f"{result_path}/{folder}")
        else:
            append_csv(rows, f"{result_path}/{folder}", files)
