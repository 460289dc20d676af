"""The jobs on inputs derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs
from checks.registry import ORACLES, query, table
from millrace.functions.records import parsed_fields
from millrace.operators import rules
from millrace.operators.scoring import score_history
from millrace.plans import access_log, bids_by_city, city_profile, flights, motels, sensors, words
from millrace.schemas import READING_FIELDS
from millrace.session import written
from millrace.sources.messages import with_offsets

WORD_SQL = r"unnest(regexp_extract_all(text, '[\p{L}\p{N}_'']+'))"


@query(
    "top_word",
    f"""SELECT word, occurrences FROM (
            SELECT lower(w) AS word, count(*) AS occurrences FROM (SELECT {WORD_SQL} AS w FROM documents) GROUP BY 1)
        ORDER BY occurrences DESC, word DESC LIMIT 1""",
)
def top_word(spark, sf_dir):
    return words.most_used_word(table(spark, sf_dir, "documents"), "text")


@query(
    "word_counts",
    f"SELECT lower(w) AS word, count(*) AS occurrences FROM (SELECT {WORD_SQL} AS w FROM documents) GROUP BY 1",
)
def word_counts(spark, sf_dir):
    return words.word_counts(table(spark, sf_dir, "documents"), "text")


@query(
    "longest_words",
    f"""SELECT lower(w) AS word, CAST(max(length(w)) AS INTEGER) AS length FROM (SELECT {WORD_SQL} AS w FROM documents)
        GROUP BY 1 ORDER BY length DESC, word LIMIT 30""",
)
def longest_words(spark, sf_dir):
    return words.longest_words(table(spark, sf_dir, "documents"), 30, "text")


@query(
    "log_stats",
    f"""SELECT ip, floor(CAST(sum(bytes) AS BIGINT) / count(*) * 100 + 0.5) / 100 AS average_bytes,
            CAST(sum(bytes) AS BIGINT) AS total_bytes
        FROM ({inputs.ACCESS_SQL}) WHERE valid GROUP BY ip""",
)
def log_stats(spark, sf_dir):
    return access_log.traffic_by_ip(inputs.access_lines(spark, sf_dir))


LOG_STATS_SQL = ORACLES["log_stats"]
BROWSERS_SQL = f"""SELECT {inputs.family_sql('user_agent', 'browser')} AS browser, count(*) AS requests
    FROM ({inputs.ACCESS_SQL}) WHERE valid GROUP BY 1"""
LOG_REJECTS_SQL = f"SELECT count(*) AS lines, count(*) FILTER (NOT valid) AS bad_lines FROM ({inputs.ACCESS_SQL})"


@query(
    "log_reports",
    f"""SELECT 'traffic ' || ip AS name, total_bytes AS n FROM ({LOG_STATS_SQL})
        UNION ALL SELECT 'browser ' || browser, requests FROM ({BROWSERS_SQL})
        UNION ALL SELECT 'bad lines', bad_lines FROM ({LOG_REJECTS_SQL})""",
)
def log_reports(spark, sf_dir):
    """All three reports of the log from one pass over it."""
    found = access_log.reports(inputs.access_lines(spark, sf_dir))
    traffic = found["traffic"].select(F.concat(F.lit("traffic "), "ip").alias("name"), F.col("total_bytes").alias("n"))
    browsers = found["browsers"].select(F.concat(F.lit("browser "), "browser"), "requests")
    return traffic.union(browsers).union(found["bad_lines"].select(F.lit("bad lines"), "bad_lines"))


@query("log_browsers", BROWSERS_SQL)
def log_browsers(spark, sf_dir):
    return access_log.requests_by_browser(inputs.access_lines(spark, sf_dir))


@query("log_rejects", LOG_REJECTS_SQL)
def log_rejects(spark, sf_dir):
    return access_log.bad_lines(inputs.access_lines(spark, sf_dir))


@query(
    "tab_records",
    f"SELECT city_id, user_agent, bidding_price FROM ({inputs.AD_SQL}) WHERE valid AND bidding_price > 250",
)
def tab_records(spark, sf_dir):
    return bids_by_city.high_bids(inputs.ad_lines(spark, sf_dir)).select("city_id", "user_agent", "bidding_price")


@query(
    "tab_rejects",
    f"SELECT count(*) AS lines, count(*) FILTER (NOT valid) AS bad_lines FROM ({inputs.AD_SQL})",
)
def tab_rejects(spark, sf_dir):
    return bids_by_city.bad_lines(inputs.ad_lines(spark, sf_dir))


@query(
    "bids_by_city",
    f"""SELECT name AS city, count(*) AS n FROM ({inputs.AD_SQL}) JOIN ({inputs.CITIES_SQL}) USING (city_id)
        WHERE valid AND bidding_price > 250 GROUP BY name""",
)
def bids_by_named_city(spark, sf_dir):
    return bids_by_city.bids_by_city(inputs.ad_lines(spark, sf_dir), inputs.cities(spark, sf_dir))


@query(
    "bids_by_city_id",
    f"SELECT city_id AS city, count(*) AS n FROM ({inputs.AD_SQL}) WHERE valid AND bidding_price > 250 GROUP BY 1",
)
def bids_by_city_id(spark, sf_dir):
    return bids_by_city.bids_by_city(inputs.ad_lines(spark, sf_dir))


@query(
    "unknown_cities",
    f"""SELECT count(DISTINCT city_id) AS cities, count(*) AS bids FROM ({inputs.AD_SQL})
        WHERE valid AND bidding_price > 250 AND city_id NOT IN (SELECT city_id FROM ({inputs.CITIES_SQL}))""",
)
def unknown_cities(spark, sf_dir):
    return bids_by_city.unknown_cities(inputs.ad_lines(spark, sf_dir), inputs.cities(spark, sf_dir))


@query(
    "city_reports",
    f"""WITH high AS (SELECT * FROM ({inputs.AD_SQL}) WHERE valid AND bidding_price > 250)
        SELECT 'os ' || {inputs.family_sql('user_agent', 'os')} AS name, count(*) AS n FROM high GROUP BY 1
        UNION ALL SELECT 'city ' || name, count(*) FROM high JOIN ({inputs.CITIES_SQL}) USING (city_id) GROUP BY 1
        UNION ALL SELECT 'unknown', count(*) FROM high WHERE city_id NOT IN (SELECT city_id FROM ({inputs.CITIES_SQL}))
        UNION ALL SELECT 'bad lines', count(*) FROM ({inputs.AD_SQL}) WHERE NOT valid""",
)
def city_reports(spark, sf_dir):
    """Both city tables, the unknown cities and the bad lines from one pass over the log."""
    found = bids_by_city.reports(inputs.ad_lines(spark, sf_dir), inputs.cities(spark, sf_dir))
    systems = found["by_os"].groupBy(F.concat(F.lit("os "), "os").alias("name")).agg(F.sum("n").alias("n"))
    named = found["by_city"].select(F.concat(F.lit("city "), "city"), "n")
    unknown = found["unknown_cities"].select(F.lit("unknown"), "bids")
    return systems.union(named).union(unknown).union(found["bad_lines"].select(F.lit("bad lines"), "bad_lines"))


@query(
    "bids_by_os_and_city",
    f"""SELECT {inputs.family_sql('user_agent', 'os')} AS os, city_id, count(*) AS n FROM ({inputs.AD_SQL})
        WHERE valid AND bidding_price > 250 GROUP BY 1, 2""",
)
def bids_by_os_and_city(spark, sf_dir):
    return bids_by_city.routed_by_os(bids_by_city.bids_by_os_and_city(inputs.ad_lines(spark, sf_dir)), 4)


@query(
    "city_totals",
    f"""SELECT name AS city, count(*) AS n FROM ({inputs.AD_SQL}) JOIN ({inputs.CITIES_SQL}) USING (city_id)
        WHERE valid AND bidding_price > 250 GROUP BY name""",
)
def city_totals(spark, sf_dir):
    by_os = bids_by_city.bids_by_os_and_city(inputs.ad_lines(spark, sf_dir))
    return bids_by_city.city_totals(by_os, inputs.cities(spark, sf_dir))


FAMILIES_SQL = f"""SELECT city_id, {inputs.family_sql('user_agent', 'device')} AS device,
    {inputs.family_sql('user_agent', 'os')} AS os, {inputs.family_sql('user_agent', 'browser')} AS browser
    FROM ({inputs.AD_ROWS_SQL})"""


@query("agent_families", FAMILIES_SQL)
def agent_families(spark, sf_dir):
    """Each row through the classification, from `city_id` TAB `user_agent` lines."""
    lines = inputs.ad_rows(spark, sf_dir).select(F.concat_ws("\t", "city_id", "user_agent").alias("value"))
    return city_profile.agent_families(city_profile.parse_agent_lines(lines).where("valid"))


def _favourite_sql(kind: str) -> str:
    return f"""(SELECT city_id, {kind} FROM (
        SELECT city_id, {kind}, row_number() OVER (PARTITION BY city_id ORDER BY count(*) DESC, {kind}) AS r
        FROM ({FAMILIES_SQL}) GROUP BY city_id, {kind}) WHERE r = 1)"""


@query(
    "city_profile",
    f"""SELECT city_id, os, browser, device FROM {_favourite_sql('os')} LEFT JOIN {_favourite_sql('browser')} USING (city_id)
        LEFT JOIN {_favourite_sql('device')} USING (city_id)""",
)
def profile(spark, sf_dir):
    return city_profile.city_profile(inputs.ad_rows(spark, sf_dir))


@query("flights_per_carrier", f"SELECT carrier AS \"UniqueCarrier\", count(*) AS total_flights FROM ({inputs.FLIGHTS_SQL}) GROUP BY 1")
def flights_per_carrier(spark, sf_dir):
    return flights.flights_per_carrier(inputs.flights(spark, sf_dir))


@query(
    "top_carrier",
    f"""SELECT carrier AS "UniqueCarrier", count(*) AS total_flights FROM ({inputs.FLIGHTS_SQL})
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
)
def top_carrier(spark, sf_dir):
    return flights.top_carrier(inputs.flights(spark, sf_dir))


@query(
    "city_departures",
    f"""SELECT count(*) AS total_flights FROM ({inputs.FLIGHTS_SQL}) JOIN ({inputs.AIRPORTS_SQL}) ON origin = iata
        WHERE month = 6 AND city = 'NATION_7'""",
)
def city_departures(spark, sf_dir):
    return flights.city_departures(inputs.flights(spark, sf_dir), inputs.airports(spark, sf_dir), "NATION_7")


@query(
    "busiest_airports",
    f"""SELECT airport, count(*) AS total_flights FROM (
            SELECT origin AS airport, month FROM ({inputs.FLIGHTS_SQL}) UNION ALL SELECT dest, month FROM ({inputs.FLIGHTS_SQL}))
        WHERE month IN (6, 7, 8) AND airport IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
)
def busiest_airports(spark, sf_dir):
    return flights.busiest_airports(inputs.flights(spark, sf_dir))


@query(
    "cancelled_by_carrier",
    f"""SELECT carrier AS "UniqueCarrier", count(*) AS cancelled_flights, string_agg(DISTINCT city, ',' ORDER BY city) AS cities
        FROM ({inputs.FLIGHTS_SQL}) LEFT JOIN ({inputs.AIRPORTS_SQL}) ON origin = iata
        WHERE cancelled GROUP BY 1 HAVING count(*) > 1""",
)
def cancelled_by_carrier(spark, sf_dir):
    found = flights.cancelled_by_carrier(inputs.flights(spark, sf_dir), inputs.airports(spark, sf_dir))
    return found.withColumn("cities", F.array_join("cities", ","))


@query(
    "motel_errors",
    f"SELECT BidDate, HU, count(*) AS count FROM ({inputs.RAW_BIDS_SQL}) WHERE contains(HU, 'ERROR') GROUP BY 1, 2",
)
def motel_errors(spark, sf_dir):
    return motels.error_counts(inputs.raw_bids(spark, sf_dir))


OFFERS_SQL = f"""
    SELECT MotelID, loSa, strftime(strptime(BidDate, '%H-%d-%m-%Y'), '%Y-%m-%d %H:%M') AS BidDate,
        floor(CAST(usd AS DOUBLE) * CAST(ExchangeRate AS DOUBLE) * 1000 + 0.5) / 1000 AS price
    FROM (SELECT MotelID, BidDate, loSa, usd
          FROM (SELECT * FROM ({inputs.RAW_BIDS_SQL}) WHERE NOT contains(coalesce(HU, ''), 'ERROR'))
          UNPIVOT (usd FOR loSa IN (US, MX, CA)))
    JOIN ({inputs.RATES_SQL}) ON BidDate = ValidFrom"""


@query("motel_offers", OFFERS_SQL)
def motel_offers(spark, sf_dir):
    return motels.offers(inputs.raw_bids(spark, sf_dir), inputs.rates(spark, sf_dir))


@query(
    "unrated_bids",
    f"""SELECT count(*) AS bids FROM ({inputs.RAW_BIDS_SQL}) WHERE NOT contains(coalesce(HU, ''), 'ERROR')
        AND coalesce(US, MX, CA) IS NOT NULL AND BidDate NOT IN (SELECT ValidFrom FROM ({inputs.RATES_SQL}))""",
)
def unrated_bids(spark, sf_dir):
    return motels.unrated_bids(inputs.raw_bids(spark, sf_dir), inputs.rates(spark, sf_dir))


@query(
    "motel_best_offers",
    f"""SELECT o.MotelID, MotelName, BidDate, loSa, price FROM (
            SELECT *, max(price) OVER (PARTITION BY MotelID, BidDate) AS top FROM ({OFFERS_SQL})) o
        LEFT JOIN ({inputs.MOTELS_SQL}) m ON o.MotelID = m.MotelID WHERE price = top""",
)
def motel_best_offers(spark, sf_dir):
    return motels.best_offers(
        inputs.raw_bids(spark, sf_dir), inputs.rates(spark, sf_dir), inputs.motels(spark, sf_dir)
    )


@query(
    "motel_first_offers",
    f"""SELECT o.MotelID, MotelName, BidDate, loSa, price FROM (
            SELECT *, row_number() OVER (PARTITION BY MotelID, BidDate ORDER BY price DESC, loSa) AS r FROM ({OFFERS_SQL})) o
        LEFT JOIN ({inputs.MOTELS_SQL}) m ON o.MotelID = m.MotelID WHERE r = 1""",
)
def motel_first_offers(spark, sf_dir):
    return motels.best_offers(
        inputs.raw_bids(spark, sf_dir), inputs.rates(spark, sf_dir), inputs.motels(spark, sf_dir), ties="first"
    )


def score_sql(source: str) -> str:
    """Scores of rows with device_id, ts, seq, value, by plain windows over each device."""
    return f"""
    WITH a AS (SELECT *, row_number() OVER w AS g, lag(value, 1) OVER w AS p1, lag(value, 2) OVER w AS p2
               FROM ({source}) WINDOW w AS (PARTITION BY device_id ORDER BY ts, seq)),
    b AS (SELECT *, CASE WHEN g >= 3 THEN abs(p2 - p1) ELSE 0.0 END AS error FROM a),
    c AS (SELECT *, sum(CAST(floor(error * 1000000 + 0.5) AS HUGEINT)) OVER (PARTITION BY device_id ORDER BY ts, seq
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier FROM b)
    SELECT device_id, seq, coalesce(p1, 0.0) AS prediction, error,
        CASE WHEN g <= 3 THEN 0.0 WHEN earlier = 0 THEN CASE WHEN error > 0 THEN 1.0 ELSE 0.0 END
            ELSE least(1.0, error / (3.0::DOUBLE * (CAST(earlier AS DOUBLE) / 1000000.0::DOUBLE / (g - 3)))) END::DOUBLE AS anomaly,
        value AS "predictionNext"
    FROM c"""


SCORE_COLUMNS = ["device_id", "seq", "prediction", "error", "anomaly", "predictionNext"]
KEYED_SCORE_SQL = score_sql("SELECT user_id AS device_id, ts, event_id AS seq, value FROM events")


@query("keyed_score", KEYED_SCORE_SQL)
def keyed_score(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("device_id"), "ts", F.col("event_id").alias("seq"), "value"
    )
    return score_history(events).select(*SCORE_COLUMNS)


# Rules as customers bring them: a build number, a kind of event, and for some a word that most agents have.
_RULES_SQL = """
    SELECT c_custkey AS position, concat('family ', c_custkey % 41) AS family,
        CASE WHEN c_custkey % 3 = 0 THEN [concat('build/', c_custkey % 997, ';'), 'Mozilla']
            WHEN c_custkey % 3 = 1 THEN [concat('build/', c_custkey % 997, ';'), list_extract(['view', 'click', 'error'], c_custkey % 3 + 1)]
            ELSE [concat(c_custkey % 89, ';'), 'Chrome', 'a'] END AS parts
    FROM customer"""
_AGENTS_SQL = f"SELECT DISTINCT concat({inputs.AGENT_SQL}, ' build/', event_id % 997, '; ', event_type) AS agent FROM events"


@query(
    "families_by_rules",
    f"""WITH a AS ({_AGENTS_SQL}), r AS ({_RULES_SQL}),
        m AS (SELECT agent, arg_min(family, position) AS family FROM a JOIN r
              ON len(list_filter(parts, lambda p: contains(agent, p))) = len(parts) GROUP BY agent)
        SELECT agent, coalesce(family, 'Other') AS family FROM a LEFT JOIN m USING (agent)""",
)
def families_by_rules(spark, sf_dir):
    """As many rules as there are customers, in a table."""
    key, text = F.col("c_custkey"), lambda name: F.col(name).cast("string")
    build = F.concat(F.lit("build/"), (key % 997).cast("string"), F.lit(";"))
    kind = F.element_at(F.array(F.lit("view"), F.lit("click"), F.lit("error")), (key % 3 + 1).cast("int"))
    parts = (
        F.when(key % 3 == 0, F.array(build, F.lit("Mozilla")))
        .when(key % 3 == 1, F.array(build, kind))
        .otherwise(F.array(F.concat((key % 89).cast("string"), F.lit(";")), F.lit("Chrome"), F.lit("a")))
    )
    brought = table(spark, sf_dir, "customer").select(
        key.alias("position"), F.concat(F.lit("family "), (key % 41).cast("string")).alias("family"), parts.alias("parts")
    )
    agent = F.concat(inputs.agent(), F.lit(" build/"), (F.col("event_id") % 997).cast("string"), F.lit("; "), text("event_type"))
    return rules.families_by_rules(table(spark, sf_dir, "events").select(agent.alias("agent")), brought, "agent")


#: Weight of the newest value, and the decimals to which smoothed scores are compared: sums of doubles depend on their order. With a
#: third as the weight no mean ends in the digit five, where rounding would turn on the last bit.
ALPHA, PLACES = 1 / 3, 4


def rounded(name: str):
    return (F.floor(F.col(name) * 10**PLACES + 0.5) / 10**PLACES).alias(name)


def smoothed_score_sql(source: str) -> str:
    """The definition row by row: a recursive table walks each device's rows, the rest are plain windows."""
    cut = lambda name: f'floor("{name}" * {10**PLACES} + 0.5) / {10**PLACES} AS "{name}"'
    return f"""
    WITH RECURSIVE a AS (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY ts, seq) AS g FROM ({source})),
    m AS (SELECT device_id, g, seq, value, value AS mean FROM a WHERE g = 1 UNION ALL
          SELECT a.device_id, a.g, a.seq, a.value, {ALPHA}::DOUBLE * a.value + (1 - {ALPHA}::DOUBLE) * m.mean
          FROM a JOIN m ON a.device_id = m.device_id AND a.g = m.g + 1),
    p AS (SELECT *, CASE WHEN g = 1 THEN 0.0 ELSE lag(mean) OVER w END::DOUBLE AS prediction FROM m WINDOW w AS (PARTITION BY device_id ORDER BY g)),
    b AS (SELECT *, CASE WHEN g >= 3 THEN lag(abs(prediction - value)) OVER w ELSE 0.0 END::DOUBLE AS error
          FROM p WINDOW w AS (PARTITION BY device_id ORDER BY g)),
    c AS (SELECT *, mean AS "predictionNext", sum(CAST(floor(error * 1000000 + 0.5) AS HUGEINT)) OVER (PARTITION BY device_id ORDER BY g
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier FROM b),
    d AS (SELECT *, CASE WHEN g <= 3 THEN 0.0 WHEN earlier = 0 THEN CASE WHEN floor(error * 1000000 + 0.5) > 0 THEN 1.0 ELSE 0.0 END
            ELSE least(1.0, error / (3.0::DOUBLE * (CAST(earlier AS DOUBLE) / 1000000.0::DOUBLE / (g - 3)))) END::DOUBLE AS anomaly FROM c)
    SELECT device_id, seq, {", ".join(cut(name) for name in SCORE_COLUMNS[2:])} FROM d"""


SMOOTHED_SCORE_SQL = smoothed_score_sql("SELECT user_id AS device_id, ts, event_id AS seq, value FROM events")


@query("smoothed_score", SMOOTHED_SCORE_SQL)
def smoothed_score(spark, sf_dir):
    """Scores with an exponential mean as the forecast."""
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("device_id"), "ts", F.col("event_id").alias("seq"), "value"
    )
    return score_history(events, alpha=ALPHA).select("device_id", "seq", *(rounded(name) for name in SCORE_COLUMNS[2:]))


MESSAGE_SCORE_SQL = score_sql(
    f"""SELECT concat_ws('-', stateCode, countryCode, siteNum, parameterCode, poc) AS device_id,
        strptime(concat(dateGMT, ' ', timeGMT), '%Y-%m-%d %H:%M') AS ts, seq, CAST(sampleMeasurement AS DOUBLE) AS value
        FROM ({inputs.READINGS_SQL})"""
)


@query("message_score", MESSAGE_SCORE_SQL)
def message_score(spark, sf_dir):
    """The batch twin of the stream, from JSON messages."""
    messages = inputs.reading_messages(spark, sf_dir)
    return score_history(sensors.readings_of(messages), "day").select(*SCORE_COLUMNS)


# Messages as they drift: without results, with them, and with fields that no schema knows.
def drifted(messages):
    kind = F.col("seq") % 3
    # Parsed once: a struct that is changed field by field would be parsed anew for each of them.
    known = messages.select("key", "value", "seq", parsed_fields("value", *READING_FIELDS))
    battery, tags = (F.col("seq") % 100).alias("battery"), F.struct(F.concat(F.lit("s"), F.col("seq") % 7).alias("site")).alias("tags")
    few, more = F.struct(*READING_FIELDS), F.struct(*READING_FIELDS, battery, tags)
    value = F.when(kind == 0, F.to_json(few)).when(kind == 1, F.col("value")).otherwise(F.to_json(more))
    return known.select("key", value.alias("value"), "seq")


def drifted_columns(sent):
    """What is compared of the drifted messages that were sent."""
    names = ("prediction", "error", "anomaly", "predictionNext")
    get = lambda path, kind: F.try_variant_get("v", f"$.{path}", kind)
    return sent.select("key", F.parse_json("value").alias("v"), F.size(F.json_object_keys("value")).cast("bigint").alias("fields")).select(
        "key", *(get(name, "double").alias(name) for name in names), get("sampleMeasurement", "double").alias("value"),
        get("battery", "bigint").alias("battery"), get("tags.site", "string").alias("site"), "fields",
    )


DRIFTED_SQL = f"""
    SELECT device_id AS key, prediction, error, anomaly, "predictionNext", "predictionNext" AS value,
        CASE WHEN seq % 3 = 2 THEN seq % 100 END AS battery, CASE WHEN seq % 3 = 2 THEN concat('s', seq % 7) END AS site,
        CAST({len(READING_FIELDS) + 5} + CASE WHEN seq % 3 = 2 THEN 2 ELSE 0 END AS BIGINT) AS fields
    FROM ({MESSAGE_SCORE_SQL})"""


@query("drifted_messages", DRIFTED_SQL)
def drifted_messages(spark, sf_dir):
    """Messages of 24 and 28 fields, and with unknown ones, scored and sent on whole."""
    return drifted_columns(sensors.score_drifting_messages(drifted(inputs.reading_messages(spark, sf_dir)), "day"))


#: Partitions of a topic whose messages are numbered.
TOPIC = 12


@query(
    "numbered_messages",
    f"""WITH m AS (SELECT concat_ws('-', stateCode, countryCode, siteNum, parameterCode, poc) AS key, seq FROM ({inputs.READINGS_SQL})),
        p AS (SELECT key, seq, CAST(CAST('0x' || substr(md5(key), 1, 8) AS BIGINT) % {TOPIC} AS INTEGER) AS partition FROM m)
        SELECT key, seq, partition, row_number() OVER (PARTITION BY partition ORDER BY seq) - 1 AS "offset" FROM p""",
)
def numbered_messages(spark, sf_dir):
    """The offsets that a topic would give the messages of a batch."""
    return with_offsets(inputs.reading_messages(spark, sf_dir).select("key", "seq"), TOPIC)


THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


@query(
    "join_by_size",
    f"""SELECT kind, city_id, n FROM (SELECT city_id, count(*) AS n FROM ({inputs.AD_ROWS_SQL}) JOIN ({inputs.CITIES_SQL}) USING (city_id)
        GROUP BY city_id), (SELECT unnest(['BroadcastHashJoin', 'SortMergeJoin']) AS kind)""",
)
def join_by_size(spark, sf_dir):
    """A lookup join below the threshold of a broadcast and above it: the kind of join that was planned, and its rows."""
    rows, lookup = inputs.ad_rows(spark, sf_dir).select("city_id"), inputs.cities(spark, sf_dir)
    set_before = spark.conf.get(THRESHOLD, None)
    found = []
    try:
        for threshold in ("32m", "-1"):
            spark.conf.set(THRESHOLD, threshold)
            joined = rows.join(lookup, "city_id")
            planned = joined._jdf.queryExecution().executedPlan().toString()
            kind = next((name for name in ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin") if name in planned), "none")
            counted = joined.groupBy("city_id").agg(F.count("*").alias("n"))
            found.append(written(counted.select(F.lit(kind).alias("kind"), "city_id", "n"), "joined"))
    finally:
        spark.conf.unset(THRESHOLD) if set_before is None else spark.conf.set(THRESHOLD, set_before)
    return found[0].unionByName(found[1])
