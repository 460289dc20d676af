"""Traffic per address and requests per browser, from web access-log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.agents import browser
from millrace.functions.logs import accepted, line_counts, parse_access
from millrace.functions.numbers import round_half_up
from millrace.operators.counting import line_counters, observed
from millrace.session import temporary_table
from millrace.sources.sinks import write_csv, write_pairs


def _with_average(sums: DataFrame) -> DataFrame:
    average = round_half_up(F.col("total_bytes") / F.col("requests"), 2)
    return sums.select("ip", average.alias("average_bytes"), "total_bytes")


def _by_browser(agents: DataFrame) -> DataFrame:
    return agents.groupBy(browser("user_agent").alias("browser")).agg(F.sum("n").alias("requests"))


def traffic_by_ip(lines: DataFrame) -> DataFrame:
    """Average bytes per request, with two decimals, and total bytes per address."""
    good = F.col("valid")
    total = F.sum(F.when(good, F.col("bytes"))).alias("total_bytes")
    sums = parse_access(lines).groupBy("ip").agg(total, F.count_if(good).alias("requests"))
    return _with_average(sums.where("requests > 0"))


def requests_by_browser(lines: DataFrame) -> DataFrame:
    """Requests per browser family; equal agents are counted before they are classified."""
    agents = parse_access(lines).groupBy("user_agent").agg(F.count_if("valid").alias("n"))
    return _by_browser(agents.where("n > 0"))


def bad_lines(lines: DataFrame) -> DataFrame:
    return line_counts(parse_access(lines))


def write_requests(lines: DataFrame, path: str) -> dict[str, int]:
    """Writes the valid lines' fields, and returns how many lines were read, how many were bad, and the bytes, from the same pass."""
    counters = {**line_counters(), "bytes": F.coalesce(F.sum("bytes"), F.lit(0))}
    parsed, counts = observed(parse_access(lines), counters)
    accepted(parsed).drop("value").write.parquet(path)
    return counts.get


def request_groups(lines: DataFrame) -> DataFrame:
    """Lines, requests and bytes per address and agent: everything the three reports need."""
    good = F.col("valid")
    return (
        parse_access(lines)
        .groupBy("ip", "user_agent")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.count_if(good).alias("requests"),
            F.sum(F.when(good, F.col("bytes"))).alias("total_bytes"),
        )
    )


def reports(lines: DataFrame) -> dict[str, DataFrame]:
    """Traffic, browsers and bad lines from a single pass over the log."""
    groups = temporary_table(request_groups(lines), "request_groups")
    good = groups.where("requests > 0")
    traffic = good.groupBy("ip").agg(F.sum("total_bytes").alias("total_bytes"), F.sum("requests").alias("requests"))
    agents = good.groupBy("user_agent").agg(F.sum("requests").alias("n"))
    read, requests = F.coalesce(F.sum("lines"), F.lit(0)), F.coalesce(F.sum("requests"), F.lit(0))
    return {
        "traffic": _with_average(traffic),
        "browsers": _by_browser(agents),
        "bad_lines": groups.agg(read.alias("lines"), (read - requests).alias("bad_lines")),
    }


def write_traffic(stats: DataFrame, path: str, output_format: str = "csv", compress: bool = True) -> None:
    """The per-address table as CSV or as a SequenceFile, with Snappy unless switched off."""
    if output_format == "sequence":
        write_pairs(stats, path, compress)
    else:
        write_csv(stats, path, compress)
