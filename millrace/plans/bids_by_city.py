"""High-priced impressions per city, in total or by operating system, from ad-log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.agents import operating_system
from millrace.functions.logs import accepted, line_counts, parse_ad_log
from millrace.operators.joining import count_by, matched, unmatched, with_lookup
from millrace.operators.layout import partition_and_sort
from millrace.session import temporary_table

PRICE_LIMIT = 250


def high_bids(lines: DataFrame, limit: int = PRICE_LIMIT) -> DataFrame:
    """Valid lines with a bid above the limit."""
    return accepted(parse_ad_log(lines)).where(F.col("bidding_price") > limit)


def bids_by_city(lines: DataFrame, cities: DataFrame | None = None, limit: int = PRICE_LIMIT) -> DataFrame:
    """High bids per city, named when a lookup of `city_id`, `name` is given; unknown ids are left out."""
    counts = count_by(high_bids(lines, limit), "city_id")
    return matched(with_lookup(counts, cities, "city_id")).select(F.col("name").alias("city"), "n")


def unknown_cities(lines: DataFrame, cities: DataFrame, limit: int = PRICE_LIMIT) -> DataFrame:
    """One row: how many city ids, and how many high bids, the lookup does not know."""
    counts = count_by(high_bids(lines, limit), "city_id")
    return _unknown(with_lookup(counts, cities, "city_id"))


def _unknown(named: DataFrame) -> DataFrame:
    bids = F.coalesce(F.sum("n"), F.lit(0)).alias("bids")
    return unmatched(named).agg(F.count(F.lit(1)).alias("cities"), bids)


def bids_by_os_and_city(lines: DataFrame, limit: int = PRICE_LIMIT) -> DataFrame:
    """High bids per operating system and city; equal agents are counted before classification."""
    counts = count_by(high_bids(lines, limit), "city_id", "user_agent")
    return counts.groupBy(operating_system("user_agent").alias("os"), "city_id").agg(F.sum("n").alias("n"))


def city_totals(by_os: DataFrame, cities: DataFrame | None = None) -> DataFrame:
    """The breakdown rolled up to one exact total per city."""
    totals = by_os.groupBy("city_id").agg(F.sum("n").alias("n"))
    return matched(with_lookup(totals, cities, "city_id")).select(F.col("name").alias("city"), "n")


def routed_by_os(by_os: DataFrame, partitions: int | None = None) -> DataFrame:
    """The breakdown with each operating system in one partition, cities in numeric order."""
    ordered = by_os.withColumn("_city", F.col("city_id").try_cast("bigint"))
    return partition_and_sort(ordered, partitions, ["os"], ["_city", "city_id", "os"]).drop("_city")


def bad_lines(lines: DataFrame) -> DataFrame:
    return line_counts(parse_ad_log(lines))


def line_groups(lines: DataFrame, limit: int = PRICE_LIMIT) -> DataFrame:
    """Lines, bad lines and high bids per city and agent; bad lines share one group without either."""
    good = F.coalesce("valid", F.lit(False))
    keys = [F.when(good, F.col(name)).alias(name) for name in ("city_id", "user_agent")]
    return (
        parse_ad_log(lines)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.count_if(~good).alias("bad_lines"),
            F.count_if(good & (F.col("bidding_price") > limit)).alias("n"),
        )
    )


def reports(lines: DataFrame, cities: DataFrame | None = None, limit: int = PRICE_LIMIT) -> dict[str, DataFrame]:
    """Both city tables, the bad lines and the unknown cities from a single pass over the log."""
    groups = temporary_table(line_groups(lines, limit), "line_groups")
    high = groups.where("n > 0")
    by_os = high.groupBy(operating_system("user_agent").alias("os"), "city_id").agg(F.sum("n").alias("n"))
    named = with_lookup(high.groupBy("city_id").agg(F.sum("n").alias("n")), cities, "city_id")
    counts = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("lines", "bad_lines")]
    return {
        "by_os": by_os,
        "by_city": matched(named).select(F.col("name").alias("city"), "n"),
        "unknown_cities": _unknown(named),
        "bad_lines": groups.agg(*counts),
    }
