"""Inputs of the jobs, derived from the given tables by Spark, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import table
from millrace.functions.records import complete, device_key, record_json
from millrace.schemas import AD_LOGS, READING_FIELDS

# Agents that the derived log lines carry, chosen by user id.
AGENTS = [
    "Mozilla/5.0 (compatible; MSIE 9.0; Windows NT 6.1; Trident/5.0)",
    "Mozilla/5.0 (X11; Ubuntu; Linux x86_64; rv:15.0) Gecko/20100101 Firefox/15.0.1",
    "Mozilla/5.0 (Windows NT 6.1) AppleWebKit/537.1 (KHTML, like Gecko) Chrome/21.0.1180.89 Safari/537.1",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 6_0 like Mac OS X) AppleWebKit/536.26 Version/6.0 Mobile/10A403 Safari/8536.25",
    "Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)",
    "Mozilla/5.0 (Linux; U; Android 4.0.4; en-us) AppleWebKit/534.30 Version/4.0 Mobile Safari/534.30",
    "Opera/9.80 (J2ME/MIDP; Opera Mini/9.80; U; en) Presto/2.5.25",
    "curl/7.26.0",
    "Mozilla/5.0 (Windows NT 6.1) AppleWebKit/535.11 (KHTML, like Gecko) Chrome/17.0.963.84 Safari/535.11 SE 2.X MetaSr 1.0",
    "Mozilla/5.0 (Linux; U; Android 4.1.2; zh-cn; SCH-I739 Build/JZO54K) AppleWebKit/534.30 Version/4.0 Mobile Safari/534.30",
    "Mozilla/5.0 (compatible; MSIE 9.0; Windows Phone OS 7.5; Trident/5.0; IEMobile/9.0; NOKIA; Lumia 800)",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/90.0.4430.93 Safari/537.36 Edg/90.0.818.51",
    "Mozilla/5.0 (X11; Fedora; Linux x86_64; rv:30.0) Gecko/20100101 Firefox/30.0",
    "Mozilla/5.0 (X11; U; Linux i686; en-US; rv:1.9.0.6) Gecko/20090208 Debian Firefox/3.0.6",
    "Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/535.4 (KHTML, like Gecko) Version/5.0 Safari/535.4 Midori/0.4",
    "Mozilla/5.0 (Windows NT 5.1; rv:1.9.0.19) Gecko/2010061201 Firefox/3.0.19 Flock/2.6.0",
    "Mozilla/5.0 (PlayBook; U; RIM Tablet OS 2.1.0; en-US) AppleWebKit/536.2 (KHTML, like Gecko) Version/7.2.1.0 Safari/536.2",
    "Mozilla/5.0 (Windows NT 6.1) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/31.0.1650.63 Safari/537.36 BIDUBrowser/6.0",
    "Mozilla/5.0 (compatible; Ezooms/1.0; ezooms.bot@example.org)",
    "Mozilla/5.0 (Linux; Android 6.0.1; Nexus 5X Build/MMB29P) Chrome/41.0.2272.96 Mobile Safari/537.36 (compatible; Googlebot/2.1)",
]
# What they are, as read from their texts: browser, operating system, device.
FAMILIES = {
    "browser": ["IE", "Firefox", "Chrome", "Mobile Safari", "Googlebot", "Android", "Opera Mini", "Other",
        "Sogou Explorer", "Android", "IE Mobile", "Edge", "Firefox", "Firefox", "Midori", "Flock", "Safari", "Baidu Browser", "ezooms.bot", "Googlebot",
    ],
    "os": ["Windows", "Ubuntu", "Windows", "iOS", "Other", "Android", "Other", "Other",
        "Windows", "Android", "Windows Phone", "Windows", "Fedora", "Debian", "Linux", "Windows", "BlackBerry Tablet OS", "Windows", "Other", "Android",
    ],
    "device": ["Other", "Other", "Other", "iPhone", "Spider", "Generic Smartphone", "Other", "Other",
        "Other", "SCH-I739", "Generic Smartphone", "Other", "Other", "Other", "Other", "Other", "Other", "Other", "Spider", "Spider",
    ],
}


def agent() -> Column:
    return F.element_at(F.array(*[F.lit(agent) for agent in AGENTS]), (F.col("user_id") % len(AGENTS) + 1).cast("int"))


AGENT_SQL = "list_extract([" + ", ".join(f"'{agent}'" for agent in AGENTS) + f"], user_id % {len(AGENTS)} + 1)"


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _whole(value: Column) -> Column:
    return F.floor(value + 0.5).cast("bigint").cast("string")


# Access-log lines: an error event has no number for its size, a view has a dash.
def access_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = (
        F.when(F.col("event_type") == "error", "bytes")
        .when(F.col("event_type") == "view", "-")
        .otherwise(_whole(F.col("value") * 100))
    )
    line = F.concat(
        F.lit("ip"), _text("user_id"), F.lit(" - - ["), F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"),
        F.lit(' +0000] "GET /'), F.col("event_type"), F.lit("/"), _text("event_id"), F.lit(' HTTP/1.1" 200 '),
        size, F.lit(' "http://host'), (F.col("user_id") % 10).cast("string"), F.lit('/" "'), agent(), F.lit('"'),
    )
    return table(spark, sf_dir, "events").select(line.alias("value"))


# Said from the events, not by parsing the lines again.
ACCESS_SQL = f"""
    SELECT concat('ip', user_id) AS ip, {AGENT_SQL} AS user_agent, event_type <> 'error' AS valid,
        CASE WHEN event_type IN ('error', 'view') THEN 0 ELSE CAST(floor(value * 100 + 0.5) AS BIGINT) END AS bytes
    FROM events"""


# Ad-log rows: a signup has no number for its price, and so makes a bad line.
def _ad_fields() -> list[Column]:
    price = F.when(F.col("event_type") == "signup", "nnnn").otherwise(_whole(F.col("value") * 10))
    values = {
        "bid_id": F.concat(F.lit("b"), _text("event_id")),
        "timestamp_": F.date_format("ts", "yyyyMMddHHmmss"),
        "ipinyouid": F.concat(F.lit("U"), _text("user_id")),
        "user_agent": agent(),
        "region_id": (F.col("user_id") % 7).cast("string"),
        "city_id": (F.col("user_id") % 40).cast("string"),
        "bidding_price": price,
    }
    return [values.get(name, F.lit(AD_CONSTANTS.get(name, "1"))).alias(name) for name in AD_LOGS]


AD_CONSTANTS = {
    "ip": "10.20.30.*", "anonim_url": "null", "ad_slot_visibility": "FirstView", "ad_slot_format": "Na",
    "landing_page_url": "null", "user_profile_ids": "20011,20044",
}


def ad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(*_ad_fields())


def ad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows as lines. Besides signups, four in 97 are bad: a wrong address, exchange or format, or too few columns."""
    bad = {"anonim_url": (1, "shown"), "ad_exchange": (2, "-"), "ad_slot_format": (3, "Fixed")}
    kind = F.col("event_id") % 97
    fields = []
    for field, name in zip(_ad_fields(), AD_LOGS):
        fields.append(F.when(kind == bad[name][0], bad[name][1]).otherwise(field) if name in bad else field)
    line = F.concat_ws("\t", *fields)
    short = F.substring_index(line, "\t", len(AD_LOGS) - 1)
    return table(spark, sf_dir, "events").select(F.when(kind == 4, short).otherwise(line).alias("value"))


_AD_VALUES_SQL = {
    "bid_id": "concat('b', event_id)",
    "timestamp_": "strftime(ts, '%Y%m%d%H%M%S')",
    "ipinyouid": "concat('U', user_id)",
    "user_agent": AGENT_SQL,
    "region_id": "CAST(user_id % 7 AS VARCHAR)",
    "city_id": "CAST(user_id % 40 AS VARCHAR)",
    "bidding_price": "CASE event_type WHEN 'signup' THEN 'nnnn' "
    "ELSE CAST(CAST(floor(value * 10 + 0.5) AS BIGINT) AS VARCHAR) END",
}
AD_ROWS_SQL = "SELECT " + ", ".join(
    f"{_AD_VALUES_SQL.get(name, repr(AD_CONSTANTS.get(name, '1')))} AS {name}" for name in AD_LOGS
) + " FROM events"
AD_SQL = f"""
    SELECT {AGENT_SQL} AS user_agent, CAST(user_id % 40 AS VARCHAR) AS city_id,
        CAST(floor(value * 10 + 0.5) AS BIGINT) AS bidding_price,
        event_type <> 'signup' AND event_id % 97 NOT IN (1, 2, 3, 4) AS valid
    FROM events"""
CITIES_SQL = "SELECT CAST(n_nationkey AS VARCHAR) AS city_id, n_name AS name FROM nation"


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(_text("n_nationkey").alias("city_id"), F.col("n_name").alias("name"))


# Motel bids: returned and finished items are errors, some first prices and some US prices are empty.
def raw_bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    error = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")

    def price(value: Column) -> Column:
        text = F.concat(F.lit("1."), F.lpad(_whole(value), 2, "0"))
        return F.when(~error, text)

    return table(spark, sf_dir, "lineitem").select(
        F.lpad(_text("l_suppkey"), 12, "0").alias("MotelID"),
        F.concat(
            F.lpad((F.col("l_linenumber") * 3).cast("string"), 2, "0"),
            F.date_format("l_shipdate", "-dd-MM-yyyy"),
        ).alias("BidDate"),
        F.when(error, F.concat(F.lit("ERROR_CODE_"), (F.col("l_partkey") % 6).cast("string")))
        .when(F.col("l_tax") > 0, F.concat(_whole(F.col("l_quantity")), F.lit(".5")))
        .alias("HU"),
        F.when(F.col("l_discount") > 0, price(F.col("l_discount") * 100)).alias("US"),
        price(F.col("l_tax") * 100).alias("MX"),
        price(F.col("l_quantity") % 12).alias("CA"),
    )


RAW_BIDS_SQL = """
    SELECT lpad(CAST(l_suppkey AS VARCHAR), 12, '0') AS MotelID,
        concat(lpad(CAST(l_linenumber * 3 AS VARCHAR), 2, '0'), strftime(l_shipdate, '-%d-%m-%Y')) AS BidDate,
        CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN concat('ERROR_CODE_', l_partkey % 6)
            WHEN l_tax > 0 THEN concat(CAST(floor(l_quantity + 0.5) AS BIGINT), '.5') END AS HU,
        CASE WHEN NOT (l_returnflag = 'R' AND l_linestatus = 'F') AND l_discount > 0
            THEN concat('1.', lpad(CAST(CAST(floor(l_discount * 100 + 0.5) AS BIGINT) AS VARCHAR), 2, '0')) END AS US,
        CASE WHEN NOT (l_returnflag = 'R' AND l_linestatus = 'F')
            THEN concat('1.', lpad(CAST(CAST(floor(l_tax * 100 + 0.5) AS BIGINT) AS VARCHAR), 2, '0')) END AS MX,
        CASE WHEN NOT (l_returnflag = 'R' AND l_linestatus = 'F')
            THEN concat('1.', lpad(CAST(CAST(floor(l_quantity % 12 + 0.5) AS BIGINT) AS VARCHAR), 2, '0')) END AS CA
    FROM lineitem"""


# Exchange rates: the hours of every order date; later ship dates have none.
def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "orders").select("o_orderdate").distinct()
    hours = F.explode(F.sequence(F.lit(3), F.lit(21), F.lit(3))).alias("hour")
    return days.select("o_orderdate", hours).select(
        F.concat(F.lpad(_text("hour"), 2, "0"), F.date_format("o_orderdate", "-dd-MM-yyyy")).alias("ValidFrom"),
        F.lit("Euro").alias("CurrencyName"),
        F.lit("EUR").alias("CurrencyCode"),
        F.concat(F.lit("0.8"), F.date_format("o_orderdate", "dd")).alias("ExchangeRate"),
    )


RATES_SQL = """
    SELECT concat(lpad(CAST(hour AS VARCHAR), 2, '0'), strftime(o_orderdate, '-%d-%m-%Y')) AS ValidFrom,
        'Euro' AS CurrencyName, 'EUR' AS CurrencyCode, concat('0.8', strftime(o_orderdate, '%d')) AS ExchangeRate
    FROM (SELECT o_orderdate, unnest(range(3, 22, 3)) AS hour FROM (SELECT DISTINCT o_orderdate FROM orders))"""


def motels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers of all nations but one, so that some motels have no name."""
    named = table(spark, sf_dir, "supplier").where(F.col("s_nationkey") != 3)
    return named.select(F.lpad(_text("s_suppkey"), 12, "0").alias("MotelID"), F.col("s_name").alias("MotelName"))


MOTELS_SQL = """
    SELECT lpad(CAST(s_suppkey AS VARCHAR), 12, '0') AS MotelID, s_name AS MotelName FROM supplier
    WHERE s_nationkey <> 3"""


# Sensor readings: a user is a device, its events are readings.
def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = {
        "stateCode": F.lpad((F.col("user_id") % 50).cast("string"), 2, "0"),
        "countryCode": _text("user_id"),
        "siteNum": F.lit("0001"),
        "parameterCode": F.lit("44201"),
        "poc": F.lit("1"),
        "parameterName": F.col("event_type"),
        "dateGMT": F.date_format("ts", "yyyy-MM-dd"),
        "timeGMT": F.date_format("ts", "HH:mm"),
        "sampleMeasurement": _text("value"),
    }
    fields = [values.get(name, F.lit("")).alias(name) for name in READING_FIELDS]
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), *fields)


_READING_VALUES_SQL = {
    "stateCode": "lpad(CAST(user_id % 50 AS VARCHAR), 2, '0')",
    "countryCode": "CAST(user_id AS VARCHAR)",
    "siteNum": "'0001'",
    "parameterCode": "'44201'",
    "poc": "'1'",
    "parameterName": "event_type",
    "dateGMT": "strftime(ts, '%Y-%m-%d')",
    "timeGMT": "strftime(ts, '%H:%M')",
    "sampleMeasurement": "CAST(value AS VARCHAR)",
}
READINGS_SQL = "SELECT event_id AS seq, " + ", ".join(
    f"{_READING_VALUES_SQL.get(name, chr(39) * 2)} AS {name}" for name in READING_FIELDS
) + " FROM events"


def family_sql(column: str, kind: str) -> str:
    """The known family of each agent that the derived lines carry."""
    cases = [f"WHEN '{agent}' THEN '{family}'" for agent, family in zip(AGENTS, FAMILIES[kind])]
    return f"CASE {column} {' '.join(cases)} END"


# Flights: a line of an order is a flight from its supplier to its part; some have no origin, returned ones are cancelled.
def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.month("l_shipdate").alias("Month"),
        F.concat(F.lit("C"), _text("l_linenumber")).alias("UniqueCarrier"),
        F.when(F.col("l_quantity") > 1, F.concat(F.lit("A"), _text("l_suppkey"))).alias("Origin"),
        F.concat(F.lit("A"), _text("l_partkey")).alias("Dest"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("Cancelled"),
    )


FLIGHTS_SQL = """
    SELECT month(l_shipdate) AS month, concat('C', l_linenumber) AS carrier, concat('A', l_partkey) AS dest,
        CASE WHEN l_quantity > 1 THEN concat('A', l_suppkey) END AS origin, l_returnflag = 'R' AS cancelled
    FROM lineitem"""


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as airports in the city of their nation's name; those of one nation are missing."""
    nations = table(spark, sf_dir, "nation")
    there = table(spark, sf_dir, "supplier").where("s_nationkey <> 3").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    return there.select(F.concat(F.lit("A"), _text("s_suppkey")).alias("iata"), F.col("n_name").alias("city"))


AIRPORTS_SQL = """
    SELECT concat('A', s_suppkey) AS iata, n_name AS city FROM supplier JOIN nation ON s_nationkey = n_nationkey
    WHERE s_nationkey <> 3"""


def reading_messages(spark: SparkSession, sf_dir: str, *also: Column) -> DataFrame:
    """The readings as `key`, `value` messages with their position in the feed, and further columns of theirs."""
    rows = complete(readings(spark, sf_dir), "seq")
    return rows.select(device_key().alias("key"), record_json().alias("value"), "seq", *also)
