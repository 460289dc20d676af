"""Line formats: the web access log and the 24-column ad log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.numbers import byte_count

# Fixed value: seven groups, matched from the start of the line; quotes stay outside the groups.
ACCESS_LINE = r'^(ip\d+) - - (\[.*\]) "(.*)" (\d+) (-|\d+) "(.*)" "(.*)"'
ACCESS_FIELDS = ["ip", "time", "request", "status", "size", "referrer", "user_agent"]

# What each column of an ad-log line must look like, in column order.
AD_LOG_PATTERNS = {
    "bid_id": "[a-zA-Z0-9]+",
    "timestamp_": "[0-9]+",
    "log_type": r"\d+",
    "ipinyouid": r"[^\t]+",
    "user_agent": r"[^\t]*",
    "ip": "[0-9.*]*",
    "region_id": r"\d+",
    "city_id": r"\d+",
    "ad_exchange": "[0-9a-zA_Z]+",
    "domain": "[a-zA-Z0-9]+",
    "url": "[a-zA-Z0-9]+",
    "anonim_url": "null",
    "ad_slot_id": "[0-9_a-zA-Z]+",
    "ad_slot_width": r"\d+",
    "ad_slot_heigth": r"\d+",
    "ad_slot_visibility": "[a-zA-Z]+",
    "ad_slot_format": "Na",
    "ad_slot_floor_price": r"\d+",
    "creative_id": "[0-9a-zA-Z]+",
    "bidding_price": r"\d+",
    "pauing_price": r"\d+",
    "landing_page_url": "null",
    "advertiser_id": r"\d+",
    "user_profile_ids": ".+",
}
AD_LOG_LINE = "^" + r"\t".join(AD_LOG_PATTERNS.values())


def parse_access(lines: DataFrame, line: str = "value") -> DataFrame:
    """Lines split into their fields, plus `bytes` and `valid`; the fields of other lines are null.

    A line is valid when it matches and its size fits a bigint. The pattern runs once per line: it
    rewrites the line to its groups, one per text line, which an input line can never contain.
    Count with `count_if("valid")` rather than filter first, or the pattern runs again in the filter.
    """
    groups = "\n".join(f"${at}" for at in range(1, len(ACCESS_FIELDS) + 1))
    found = F.split(F.regexp_replace(line, f"(?d){ACCESS_LINE}.*", groups), "\n")
    matches = F.size("_found") == len(ACCESS_FIELDS)
    fields = {name: F.when(matches, F.get("_found", F.lit(at))) for at, name in enumerate(ACCESS_FIELDS)}
    parsed = lines.withColumn("_found", found).withColumns({**fields, "bytes": byte_count(fields["size"])})
    return parsed.withColumn("valid", F.col("bytes").isNotNull()).drop("_found")


def parse_ad_log(lines: DataFrame, line: str = "value") -> DataFrame:
    """Tab-separated lines as text columns plus a numeric bid price, with `valid`.

    One anchored pattern checks all columns in a single pass over the line. A price that does not
    fit a bigint makes the line invalid.
    """
    fields = F.split(line, r"\t", len(AD_LOG_PATTERNS))
    columns = {name: F.get(fields, F.lit(at)) for at, name in enumerate(AD_LOG_PATTERNS)}
    columns["bidding_price"] = columns["bidding_price"].try_cast("bigint")
    return lines.withColumns(columns).withColumn(
        "valid", F.col(line).rlike(AD_LOG_LINE) & F.col("bidding_price").isNotNull()
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where("valid").drop("valid")


def rejected(parsed: DataFrame, line: str = "value") -> DataFrame:
    """The lines that did not parse, as they came."""
    return parsed.where("valid is not true").select(line)


def line_counts(parsed: DataFrame) -> DataFrame:
    """One row: how many lines were read, and how many of them did not parse."""
    return parsed.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(~F.coalesce(F.col("valid"), F.lit(False))).alias("bad_lines"),
    )
