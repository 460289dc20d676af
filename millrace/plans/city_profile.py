"""The most frequent device, operating system and browser of each city."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.agents import browser, device, operating_system
from millrace.operators.joining import count_by
from millrace.operators.ranking import most_counted
from millrace.operators.reshaping import unpivot
from millrace.operators.rules import families_by_rules

KINDS = ["os", "browser", "device"]


def agent_families(rows: DataFrame) -> DataFrame:
    """`city_id`, `device`, `os`, `browser` for each row with a city and a user agent."""
    return rows.select(
        "city_id",
        device("user_agent").alias("device"),
        operating_system("user_agent").alias("os"),
        browser("user_agent").alias("browser"),
    )


def requests_by_family(lines: DataFrame, rules: DataFrame) -> DataFrame:
    """`family`, `requests` of lines that are user agents, by the rules of a table. Equal agents are counted before they are named."""
    counted = lines.groupBy(F.col("value").alias("agent")).agg(F.count("*").alias("requests"))
    named = families_by_rules(counted, rules, "agent").where("agent is not null")
    known = counted.where("agent is not null").join(named, "agent")
    return known.groupBy("family").agg(F.sum("requests").alias("requests"))


def parse_agent_lines(lines: DataFrame) -> DataFrame:
    """`city_id` TAB `user_agent` lines; a line without exactly two fields is not valid."""
    fields = F.split("value", "\t")
    return lines.withColumns(
        {
            "city_id": F.get(fields, F.lit(0)),
            "user_agent": F.get(fields, F.lit(1)),
            "valid": F.size(fields) == 2,
        }
    )


def family_votes(logs: DataFrame) -> DataFrame:
    """Log rows per city, kind and family. Equal agents of a city are counted before they are
    classified, so the classification runs once per city and agent and the logs are read once."""
    agents = count_by(logs, "city_id", "user_agent")
    families = agents.select(
        "city_id",
        "n",
        operating_system("user_agent").alias("os"),
        browser("user_agent").alias("browser"),
        device("user_agent").alias("device"),
    )
    votes = unpivot(families, ["city_id", "n"], KINDS, "kind", "family")
    return votes.groupBy("city_id", "kind", "family").agg(F.sum("n").alias("n"))


def city_profile(logs: DataFrame) -> DataFrame:
    """One row per city. Rows without a city share one, of which only the system is reported."""
    favourites = most_counted(family_votes(logs), ["city_id", "kind"], "family", "n")
    picked = {kind: F.max(F.when(F.col("kind") == kind, F.col("family"))) for kind in KINDS}
    profile = favourites.groupBy("city_id").agg(*[pick.alias(kind) for kind, pick in picked.items()])
    named = F.col("city_id").isNotNull()
    return profile.select(
        "city_id", "os", F.when(named, F.col("browser")).alias("browser"), F.when(named, F.col("device")).alias("device")
    )


def joined_profile(top_os: DataFrame, top_browser: DataFrame, top_device: DataFrame) -> DataFrame:
    """The same result from three separate per-city tables."""
    return top_os.join(top_browser, "city_id", "left").join(top_device, "city_id", "left").distinct()
