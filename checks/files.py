"""Sources and sinks: every query writes its input to a new shared folder and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs
from checks.jobs import LOG_STATS_SQL, log_stats, motel_errors
from checks.registry import query, table
from millrace.functions.agents import operating_system
from millrace.functions.records import from_json_text
from millrace.operators.layout import in_file_order, write_routed
from millrace.plans import access_log, weather
from millrace.schemas import AD_LOGS, EXCHANGE_RATES, RAW_BIDS
from millrace.session import run_folder, temporary_table
from millrace.sources.sinks import append_csv, delimited, write_lines
from millrace.sources.staged import export_staged, read_staged
from millrace.sources.tables import load_overwrite, overwrite_partitions, read_lines, read_quoted, read_table, save_bucketed


@query("line_scan", "SELECT concat_ws(',', event_id, user_id, event_type, props) AS value FROM events")
def line_scan(spark, sf_dir):
    """Formatted lines in two folders, read as one input."""
    folder = run_folder(spark, "lines")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props")
    errors = F.col("event_type") == "error"
    write_lines(events.where(errors), f"{folder}/errors")
    write_lines(events.where(~errors), f"{folder}/others")
    return read_lines(spark, [f"{folder}/errors", f"{folder}/others"])


@query("ragged_csv", f"SELECT MotelID, BidDate, HU, US, MX, CA FROM ({inputs.RAW_BIDS_SQL})")
def ragged_csv(spark, sf_dir):
    """Error rows end after the message; the reader pads them."""
    folder = run_folder(spark, "bids")
    bids = inputs.raw_bids(spark, sf_dir)
    missing = [F.lit("").alias(name) for name in RAW_BIDS if name not in bids.columns]
    full = bids.select("*", *missing)
    short = F.coalesce("HU", F.lit("")).contains("ERROR")
    line = F.when(short, delimited(RAW_BIDS[:3])).otherwise(delimited(RAW_BIDS))
    full.select(line.alias("value")).write.text(folder)
    return read_table(spark, folder, RAW_BIDS).select("MotelID", "BidDate", "HU", "US", "MX", "CA")


@query("parquet_by_suffix", f"SELECT ValidFrom, ExchangeRate FROM ({inputs.RATES_SQL})")
def parquet_by_suffix(spark, sf_dir):
    path = run_folder(spark, "rates") + ".parquet"
    load_overwrite(inputs.rates(spark, sf_dir), path)
    return read_table(spark, path, EXCHANGE_RATES).select("ValidFrom", "ExchangeRate")


@query(
    "pushed_scan",
    "SELECT l_orderkey, l_extendedprice FROM lineitem WHERE l_quantity > 45 AND l_shipdate >= TIMESTAMP '1998-01-01'",
)
def pushed_scan(spark, sf_dir):
    lines = read_table(spark, f"{sf_dir}/lineitem.parquet", [])
    recent = (F.col("l_quantity") > 45) & (F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    return lines.where(recent).select("l_orderkey", "l_extendedprice")


PART_COLUMNS = {"p_partkey": "bigint", "p_name": "string", "p_type": "string", "p_size": "int", "p_retailprice": "double"}


@query("quoted_csv", f"SELECT {', '.join(PART_COLUMNS)} FROM part")
def quoted_csv(spark, sf_dir):
    """Quoted fields under a header line, typed on reading."""
    folder = run_folder(spark, "part")
    table(spark, sf_dir, "part").select(*PART_COLUMNS).write.csv(folder, header=True, quoteAll=True)
    return read_quoted(spark, folder, PART_COLUMNS)


@query(
    "tab_table",
    f"""SELECT bid_id, TRY_CAST(city_id AS INTEGER) AS city_id, user_agent,
        TRY_CAST(bidding_price AS INTEGER) AS bidding_price FROM ({inputs.AD_ROWS_SQL})""",
)
def tab_table(spark, sf_dir):
    """Tab-separated rows under a header line; a price that is no number is null."""
    folder = run_folder(spark, "ads")
    inputs.ad_rows(spark, sf_dir).write.csv(folder, sep="\t", header=True)
    rows = read_quoted(spark, folder, AD_LOGS, sep="\t")
    return rows.select("bid_id", "city_id", "user_agent", "bidding_price")


@query("load_overwrite", "SELECT c_custkey, c_name FROM customer")
def overwrite_twice(spark, sf_dir):
    """A table loaded twice holds the second load only."""
    folder = run_folder(spark, "customer")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    load_overwrite(customers, folder)
    return load_overwrite(customers, folder)


@query(
    "shared_view",
    """SELECT 'type' AS kind, event_type AS name, count(*) AS n FROM events GROUP BY 2 UNION ALL
       SELECT 'props', props, count(*) FROM events GROUP BY 2 UNION ALL
       SELECT 'user', CAST(user_id AS VARCHAR), count(*) FROM events GROUP BY 2""",
)
def shared_view(spark, sf_dir):
    """An intermediate written once and used three times, in SQL."""
    events = table(spark, sf_dir, "events").groupBy("event_type", "props", "user_id")
    temporary_table(events.agg(F.count(F.lit(1)).alias("n")), "event_groups")
    return spark.sql(
        """SELECT 'type' AS kind, event_type AS name, sum(n) AS n FROM event_groups GROUP BY event_type
           UNION ALL SELECT 'props', props, sum(n) FROM event_groups GROUP BY props
           UNION ALL SELECT 'user', CAST(user_id AS STRING), sum(n) FROM event_groups GROUP BY user_id"""
    )


@query(
    "appended_csv",
    f"""WITH e AS (SELECT BidDate, HU, count(*) AS n FROM ({inputs.RAW_BIDS_SQL}) WHERE contains(HU, 'ERROR') GROUP BY 1, 2)
        SELECT BidDate, HU, CAST(n AS VARCHAR) AS n FROM e UNION ALL SELECT BidDate, HU, CAST(n AS VARCHAR) FROM e""",
)
def appended_csv(spark, sf_dir):
    folder = run_folder(spark, "errors")
    errors = motel_errors(spark, sf_dir)
    append_csv(errors, folder)
    append_csv(errors, folder)
    return read_table(spark, folder, ["BidDate", "HU", "n"])


@query("compressed_csv", LOG_STATS_SQL)
def compressed_csv(spark, sf_dir):
    folder = run_folder(spark, "traffic")
    access_log.write_traffic(log_stats(spark, sf_dir), folder)
    return read_quoted(
        spark, folder, {"ip": "string", "average_bytes": "double", "total_bytes": "bigint"}, header=False
    )


@query(
    "sequence_pairs",
    f"""SELECT concat('"', ip, '"') AS key, concat('[', average_bytes, ', ', total_bytes, ']') AS value
        FROM ({LOG_STATS_SQL})""",
)
def sequence_pairs(spark, sf_dir):
    folder = run_folder(spark, "pairs")
    access_log.write_traffic(log_stats(spark, sf_dir), folder, "sequence")
    return spark.sparkContext.sequenceFile(folder).toDF("key string, value string")


WEATHER_SQL = """SELECT CAST(l_suppkey AS VARCHAR) AS stationid, CAST(l_shipdate AS DATE) AS date,
    CAST(l_quantity AS INTEGER) AS tmin, CASE WHEN l_tax > 0 THEN CAST(l_quantity AS INTEGER) + l_linenumber END AS tmax,
    l_linenumber AS prcp FROM lineitem"""


def _weather(spark, sf_dir):
    folder = run_folder(spark, "weather")
    quantity = F.col("l_quantity").cast("int")
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("stationid"),
        F.to_date("l_shipdate").alias("date"),
        quantity.alias("tmin"),
        F.when(F.col("l_tax") > 0, quantity + F.col("l_linenumber")).alias("tmax"),
        F.lit(None).cast("int").alias("snow"),
        F.lit(None).cast("int").alias("snwd"),
        F.col("l_linenumber").alias("prcp"),
    )
    write_lines(rows, folder)
    return weather.read_weather(spark, folder)


@query(
    "weather_rows",
    f"SELECT stationid, strftime(date, '%Y-%m-%d') AS date, tmin, tmax, prcp FROM ({WEATHER_SQL})",
)
def weather_rows(spark, sf_dir):
    rows = _weather(spark, sf_dir)
    return rows.select("stationid", F.col("date").cast("string").alias("date"), "tmin", "tmax", "prcp")


@query(
    "staged_export",
    f"SELECT stationid, strftime(date, '%Y-%m-%d') AS date, tmin, tmax, prcp FROM ({WEATHER_SQL})",
)
def staged_export(spark, sf_dir):
    """The rows of another export, replaced by one part of the table, to which the rest is appended; read back by its manifest."""
    target = f"{run_folder(spark, 'staged')}/weather"
    rows = _weather(spark, sf_dir)
    export_staged(rows.where("tmax is null"), target)
    export_staged(rows.where("prcp > 3"), target)
    export_staged(rows.where("prcp <= 3"), target, overwrite=False)
    return read_staged(spark, target).select("stationid", F.col("date").cast("string").alias("date"), "tmin", "tmax", "prcp")


@query(
    "staged_row_count",
    "SELECT count(*) AS rows FROM lineitem",
)
def staged_row_count(spark, sf_dir):
    """The check of an export: how many rows the table has."""
    target = f"{run_folder(spark, 'staged')}/weather"
    export_staged(_weather(spark, sf_dir), target)
    return weather.row_count(read_staged(spark, target))


@query(
    "weather_first_days",
    f"""SELECT stationid, strftime(date, '%Y-%m-%d') AS date FROM ({WEATHER_SQL})
        ORDER BY stationid, date LIMIT 10""",
)
def weather_first_days(spark, sf_dir):
    """Station and day only: rows of one station and day may tie."""
    rows = weather.first_days(_weather(spark, sf_dir).select("stationid", "date"))
    return rows.select("stationid", F.col("date").cast("string").alias("date"))


@query(
    "published_messages",
    f"""SELECT concat_ws('-', stateCode, countryCode, siteNum, parameterCode, poc) AS key,
            CAST(to_json({{{', '.join(f"{name}: {name}" for name in inputs.READING_FIELDS)},
            prediction: 0.0::DOUBLE, error: 0.0::DOUBLE, anomaly: 0.0::DOUBLE, predictionNext: 0.0::DOUBLE}}) AS VARCHAR) AS value,
            seq FROM ({inputs.READINGS_SQL})""",
)
def published_messages(spark, sf_dir):
    return inputs.reading_messages(spark, sf_dir)


@query(
    "decoded_messages",
    f"""SELECT seq, countryCode, parameterName, dateGMT, timeGMT, sampleMeasurement, 0.0::DOUBLE AS prediction
        FROM ({inputs.READINGS_SQL})""",
)
def decoded_messages(spark, sf_dir):
    record = inputs.reading_messages(spark, sf_dir).select("seq", from_json_text("value").alias("record"))
    fields = ["countryCode", "parameterName", "dateGMT", "timeGMT", "sampleMeasurement", "prediction"]
    return record.select("seq", *[F.col(f"record.{name}").alias(name) for name in fields])


@query(
    "routed_files",
    f"""SELECT {inputs.family_sql(inputs.AGENT_SQL, 'os')} AS os, user_id % 40 AS city_id, event_id AS bid,
        row_number() OVER (PARTITION BY {inputs.family_sql(inputs.AGENT_SQL, 'os')} ORDER BY user_id % 40, event_id) - 1 AS place FROM events""",
)
def routed_files(spark, sf_dir):
    """A folder for each system, its files one sorted sequence; read back in the order of file names."""
    path = f"{run_folder(spark, 'routed')}/by_os"
    events = table(spark, sf_dir, "events")
    rows = events.select(
        operating_system(inputs.agent()).alias("os"), (F.col("user_id") % 40).alias("city_id"), F.col("event_id").alias("bid")
    )
    write_routed(rows, path, "os", ["city_id", "bid"])
    return in_file_order(spark, path, "os", "place")


COUNTS_SQL = f"""SELECT count(*) AS lines, count(*) FILTER (NOT valid) AS bad_lines FROM ({inputs.ACCESS_SQL})"""


@query(
    "observed_counts",
    f"""SELECT *, (SELECT CAST(sum(bytes) AS BIGINT) FROM ({inputs.ACCESS_SQL}) WHERE valid) AS bytes,
        lines - bad_lines AS written FROM ({COUNTS_SQL})""",
)
def observed_counts(spark, sf_dir):
    """Counters of the pass that writes the requests, and how many it wrote."""
    path = run_folder(spark, "requests")
    counts = access_log.write_requests(inputs.access_lines(spark, sf_dir), path)
    return spark.read.parquet(path).agg(
        *(F.lit(counts[name]).cast("bigint").alias(name) for name in ("lines", "bad_lines", "bytes")), F.count("*").alias("written")
    )


@query(
    "colocated_join",
    """SELECT o_custkey, count(*) AS lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey""",
)
def colocated_join(spark, sf_dir):
    """Two tables laid out by their join key; only the counts by another key are moved."""
    return bucketed_totals(spark, sf_dir).groupBy("o_custkey").agg(F.sum("lines").alias("lines"), F.sum("quantity").alias("quantity"))


BUCKETS = 16


def bucketed_totals(spark, sf_dir):
    """Lines and their quantity for each order, from two bucketed catalog tables."""
    folder = run_folder(spark, "bucketed")
    name = folder.rsplit("-", 1)[1]
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_quantity").cast("bigint").alias("quantity"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = save_bucketed(lines, f"lines_{name}", f"{folder}/lines", ["l_orderkey"], BUCKETS)
    orders = save_bucketed(orders, f"orders_{name}", f"{folder}/orders", ["o_orderkey"], BUCKETS)
    per_order = lines.groupBy("l_orderkey").agg(F.count("*").alias("lines"), F.sum("quantity").alias("quantity"))
    return per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


@query(
    "overwritten_partition",
    "SELECT event_id, CASE WHEN event_type = 'error' THEN value + 1 ELSE value END AS value, event_type FROM events",
)
def overwritten_partition(spark, sf_dir):
    """One partition of a table replaced, the others left."""
    path = f"{run_folder(spark, 'partitions')}/events"
    events = table(spark, sf_dir, "events").select("event_id", "value", "event_type")
    load_overwrite(events, path, ["event_type"])
    errors = events.where("event_type = 'error'").withColumn("value", F.col("value") + 1)
    return overwrite_partitions(errors, path, ["event_type"])
