"""Filters, joins, aggregations, rankings and set operations on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query, table
from millrace.functions.dates import bid_hour
from millrace.functions.numbers import number, round_half_up, to_euro
from millrace.operators.joining import count_by, matched, unmatched, with_lookup
from millrace.operators.layout import partition_and_sort, with_parallelism
from millrace.operators.ranking import best_of_columns, best_rows, first_best, most_frequent, top_rows
from millrace.plans.city_profile import joined_profile

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query("group_count", "SELECT l_suppkey, count(*) AS total FROM lineitem GROUP BY l_suppkey")
def group_count(spark, sf_dir):
    return count_by(table(spark, sf_dir, "lineitem"), "l_suppkey", n="total")


@query("row_count", "SELECT count(*) AS total FROM lineitem")
def row_count(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("total"))


@query(
    "column_count",
    "SELECT l_returnflag, count(nullif(l_tax, 0)) AS taxed, count(*) AS total FROM lineitem GROUP BY l_returnflag",
)
def column_count(spark, sf_dir):
    taxed = F.nullif(F.col("l_tax"), F.lit(0.0))
    lines = table(spark, sf_dir, "lineitem").groupBy("l_returnflag")
    return lines.agg(F.count(taxed).alias("taxed"), F.count(F.lit(1)).alias("total"))


@query(
    "sum_per_key",
    "SELECT l_partkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem GROUP BY l_partkey",
)
def sum_per_key(spark, sf_dir):
    quantity = F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(quantity)


@query(
    "join_filter_count",
    """SELECT count(*) AS total FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN supplier ON l_suppkey = s_suppkey WHERE month(o_orderdate) = 6 AND s_nationkey = 3""",
)
def join_filter_count(spark, sf_dir):
    """The lines left by the dimension are counted per order before they meet the orders."""
    suppliers = table(spark, sf_dir, "supplier").where("s_nationkey = 3").select("s_suppkey")
    june = table(spark, sf_dir, "orders").where(F.month("o_orderdate") == 6).select("o_orderkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    per_order = count_by(lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")), "l_orderkey")
    joined = per_order.join(june, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))


@query(
    "dimension_join_count",
    """SELECT s_nationkey, count(*) AS total FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
       WHERE month(l_shipdate) IN (6, 7, 8) GROUP BY s_nationkey""",
)
def dimension_join_count(spark, sf_dir):
    """A fact counted on its join key, then joined to a dimension."""
    summer = table(spark, sf_dir, "lineitem").where(F.month("l_shipdate").isin(6, 7, 8))
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    counted = count_by(summer, "l_suppkey").join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    return counted.groupBy("s_nationkey").agg(F.sum("n").alias("total"))


@query(
    "left_enrich",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, s_name FROM lineitem
       LEFT JOIN (SELECT * FROM supplier WHERE s_nationkey <> 3) s ON l_suppkey = s_suppkey""",
)
def left_enrich(spark, sf_dir):
    names = table(spark, sf_dir, "supplier").where("s_nationkey <> 3").select("s_suppkey", "s_name")
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEY)
    return lines.join(names, F.col("l_suppkey") == F.col("s_suppkey"), "left").drop("s_suppkey")


@query(
    "rate_join",
    """SELECT o_orderkey, floor(o_totalprice * rate * 1000 + 0.5) / 1000 AS euro
       FROM orders LEFT JOIN (
           SELECT DISTINCT strftime(l_shipdate, '%Y-%m') AS valid_from,
               TRY_CAST(concat('0.8', strftime(l_shipdate, '%m')) AS DOUBLE) AS rate
           FROM lineitem WHERE year(l_shipdate) <> 1997) r
       ON strftime(o_orderdate, '%Y-%m') = valid_from""",
)
def rate_join(spark, sf_dir):
    """Orders against monthly rates under another key name; orders of 1997 have none and stay null."""
    shipped = table(spark, sf_dir, "lineitem").where(F.year("l_shipdate") != 1997)
    rates = shipped.select(
        F.date_format("l_shipdate", "yyyy-MM").alias("valid_from"),
        number(F.concat(F.lit("0.8"), F.date_format("l_shipdate", "MM"))).alias("rate"),
    ).distinct()
    orders = table(spark, sf_dir, "orders")
    joined = orders.join(rates, F.date_format("o_orderdate", "yyyy-MM") == F.col("valid_from"), "left")
    return joined.select("o_orderkey", round_half_up(F.col("o_totalprice") * F.col("rate"), 3).alias("euro"))


@query(
    "profile_join",
    """WITH votes AS (SELECT user_id, event_type, props, hour(ts) AS hour FROM events),
       a AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS r
             FROM votes GROUP BY user_id, event_type),
       b AS (SELECT user_id, props, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, props) AS r
             FROM votes GROUP BY user_id, props),
       c AS (SELECT user_id, hour, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, hour) AS r
             FROM votes GROUP BY user_id, hour)
       SELECT DISTINCT a.user_id AS city_id, event_type AS os, props AS browser, CAST(hour AS INTEGER) AS device
       FROM a LEFT JOIN b ON a.user_id = b.user_id AND b.r = 1 LEFT JOIN c ON a.user_id = c.user_id AND c.r = 1
       WHERE a.r = 1""",
)
def profile_join(spark, sf_dir):
    """Three favourites per user, chained by left joins."""
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("city_id"),
        F.col("event_type").alias("os"),
        F.col("props").alias("browser"),
        F.hour("ts").alias("device"),
    )
    return joined_profile(*[most_frequent(events, ["city_id"], kind) for kind in ("os", "browser", "device")])


LOOKUP_COUNTS_SQL = """(SELECT s_nationkey AS nation, count(*) AS n FROM lineitem
    JOIN supplier ON l_suppkey = s_suppkey WHERE l_extendedprice > 250 GROUP BY s_nationkey) c"""
LOOKUP_SQL = "(SELECT n_nationkey, n_name FROM nation WHERE n_regionkey <> 2)"


def _lookup_counts(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"))
    dear = table(spark, sf_dir, "lineitem").where("l_extendedprice > 250")
    counted = count_by(dear, "l_suppkey").join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    return counted.groupBy("nation").agg(F.sum("n").alias("n"))


def _lookup(spark, sf_dir):
    """Nations of all regions but one, so that some ids are unknown."""
    nations = table(spark, sf_dir, "nation").where("n_regionkey <> 2")
    return nations.select(F.col("n_nationkey").alias("nation"), F.col("n_name").alias("name"))


@query("lookup_join", f"SELECT n_name AS name, n FROM {LOOKUP_COUNTS_SQL} JOIN {LOOKUP_SQL} ON nation = n_nationkey")
def lookup_join(spark, sf_dir):
    return matched(with_lookup(_lookup_counts(spark, sf_dir), _lookup(spark, sf_dir), "nation")).select("name", "n")


@query("lookup_passthrough", f"SELECT CAST(nation AS VARCHAR) AS name, n FROM {LOOKUP_COUNTS_SQL}")
def lookup_passthrough(spark, sf_dir):
    return with_lookup(_lookup_counts(spark, sf_dir), None, "nation").select("name", "n")


@query(
    "lookup_rejects",
    f"""SELECT count(*) AS ids, CAST(coalesce(sum(n), 0) AS BIGINT) AS lines FROM {LOOKUP_COUNTS_SQL}
        WHERE NOT EXISTS (SELECT 1 FROM {LOOKUP_SQL} WHERE n_nationkey = nation)""",
)
def lookup_rejects(spark, sf_dir):
    unknown = unmatched(with_lookup(_lookup_counts(spark, sf_dir), _lookup(spark, sf_dir), "nation"))
    return unknown.agg(F.count(F.lit(1)).alias("ids"), F.coalesce(F.sum("n"), F.lit(0)).alias("lines"))


@query(
    "busiest_union",
    """SELECT nation, CAST(sum(n) AS BIGINT) AS total FROM (
           SELECT s_nationkey AS nation, count(s_nationkey) AS n FROM supplier GROUP BY s_nationkey UNION ALL
           SELECT c_nationkey, count(c_nationkey) FROM customer GROUP BY c_nationkey)
       GROUP BY nation ORDER BY total DESC, nation LIMIT 5""",
)
def busiest_union(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"))
    each = [ends.groupBy("nation").agg(F.count("nation").alias("n")) for ends in (suppliers, customers)]
    counts = each[0].unionByName(each[1])
    totals = counts.groupBy("nation").agg(F.sum("n").alias("total"))
    return top_rows(totals, 5, F.desc("total"), F.asc("nation"))


@query(
    "busiest_both_ends",
    """SELECT day, CAST(sum(n) AS BIGINT) AS total FROM (
           SELECT strftime(o_orderdate, '%m-%d') AS day, count(*) AS n FROM orders
           WHERE month(o_orderdate) IN (6, 7, 8) GROUP BY 1 UNION ALL
           SELECT strftime(o_orderdate + INTERVAL 1 DAY, '%m-%d'), count(*) FROM orders
           WHERE month(o_orderdate) IN (6, 7, 8) GROUP BY 1)
       GROUP BY day ORDER BY total DESC, day LIMIT 5""",
)
def busiest_both_ends(spark, sf_dir):
    """Both ends of a row, here an order's day and the day after, counted in one scan."""
    summer = table(spark, sf_dir, "orders").where(F.month("o_orderdate").isin(6, 7, 8))
    ends = F.array(F.col("o_orderdate"), F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"))
    days = summer.select(F.explode(ends).alias("at")).select(F.date_format("at", "MM-dd").alias("day"))
    return top_rows(count_by(days, "day", n="total"), 5, F.desc("total"), F.asc("day"))


@query(
    "flag_names_set",
    """SELECT l_returnflag, count(*) AS lines, string_agg(DISTINCT n_name, ',' ORDER BY n_name) AS names
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
       LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) n ON s_nationkey = n_nationkey
       WHERE l_linestatus = 'O' GROUP BY l_returnflag HAVING count(*) > 1 ORDER BY lines DESC, l_returnflag""",
)
def flag_names_set(spark, sf_dir):
    """Counts and name sets: lines are counted per flag and supplier before any join."""
    lines = table(spark, sf_dir, "lineitem").where("l_linestatus = 'O'")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nations = table(spark, sf_dir, "nation").where("n_regionkey <> 2").select("n_nationkey", "n_name")
    named = (
        count_by(lines, "l_returnflag", "l_suppkey")
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    )
    names = F.array_join(F.sort_array(F.collect_set("n_name")), ",")
    return (
        named.groupBy("l_returnflag")
        .agg(F.sum("n").alias("lines"), names.alias("names"))
        .where("lines > 1")
        .orderBy(F.desc("lines"), F.asc("l_returnflag"))
    )


@query(
    "error_hourly",
    """SELECT strftime(ts, '%H-%d-%m-%Y') AS hour, event_type, count(*) AS n FROM events
       WHERE event_type LIKE '%error%' GROUP BY 1, 2""",
)
def error_hourly(spark, sf_dir):
    errors = table(spark, sf_dir, "events").where(F.col("event_type").contains("error"))
    return errors.groupBy(F.date_format("ts", "HH-dd-MM-yyyy").alias("hour"), "event_type").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("non_errors", "SELECT event_type, count(*) AS n FROM events WHERE event_type NOT LIKE '%error%' GROUP BY 1")
def non_errors(spark, sf_dir):
    kept = table(spark, sf_dir, "events").where(~F.coalesce("event_type", F.lit("")).contains("error"))
    return count_by(kept, "event_type")


@query(
    "flag_and_threshold",
    "SELECT event_id, value FROM events WHERE event_type = 'purchase' AND value > 250",
)
def flag_and_threshold(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.where((F.col("event_type") == "purchase") & (F.col("value") > 250)).select("event_id", "value")


@query("projection_rename", "SELECT o_orderkey AS id, o_totalprice AS price, 'USD' AS currency FROM orders")
def projection_rename(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"), F.lit("USD").alias("currency")
    )


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query(
    "argmax_first",
    """SELECT user_id, hour, value, event_id FROM (
           SELECT user_id, strftime(ts, '%Y-%m-%d %H:00') AS hour, value, event_id,
               row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY value DESC, event_id) AS r
           FROM events) WHERE r = 1""",
)
def argmax_first(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("hour", F.date_format("ts", "yyyy-MM-dd HH:00"))
    return first_best(events, ["user_id", "hour"], "value", ["event_id"])


@query(
    "os_city_count",
    "SELECT user_id % 10 AS city, event_type, count(*) AS n FROM events WHERE value > 10 GROUP BY 1, 2",
)
def os_city_count(spark, sf_dir):
    events = table(spark, sf_dir, "events").where("value > 10").withColumn("city", F.col("user_id") % 10)
    return count_by(events, "city", "event_type")


@query(
    "os_city_rollup",
    "SELECT user_id % 10 AS city, CAST(count(*) AS BIGINT) AS n FROM events WHERE value > 10 GROUP BY 1",
)
def os_city_rollup(spark, sf_dir):
    return os_city_count(spark, sf_dir).groupBy("city").agg(F.sum("n").alias("n"))


@query(
    "unpivot_best",
    """WITH long AS (
           SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, kind, floor(amount * 0.803 * 1000 + 0.5) / 1000 AS price
           FROM lineitem UNPIVOT (amount FOR kind IN (l_discount, l_tax, l_quantity)))
       SELECT * EXCLUDE (top) FROM (
           SELECT *, max(price) OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS top FROM long)
       WHERE price = top""",
)
def unpivot_best(spark, sf_dir):
    columns = ["l_discount", "l_tax", "l_quantity"]
    prices = [round_half_up(F.col(column) * F.lit(0.803), 3).alias(column) for column in columns]
    return best_of_columns(table(spark, sf_dir, "lineitem").select(*LINE_KEY, *prices), LINE_KEY, columns, "kind", "price")


@query(
    "best_with_ties",
    """SELECT l_suppkey, l_orderkey, l_quantity FROM (
           SELECT *, max(l_quantity) OVER (PARTITION BY l_suppkey) AS top FROM lineitem) WHERE l_quantity = top""",
)
def best_with_ties(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_quantity")
    return best_rows(lines, ["l_suppkey"], "l_quantity")


@query(
    "top_category",
    """SELECT user_id, event_type FROM (
           SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS r
           FROM events GROUP BY user_id, event_type) WHERE r = 1""",
)
def top_category(spark, sf_dir):
    return most_frequent(table(spark, sf_dir, "events"), ["user_id"], "event_type")


@query(
    "ordered_counts",
    "SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey ORDER BY n DESC, c_nationkey",
)
def ordered_counts(spark, sf_dir):
    return count_by(table(spark, sf_dir, "customer"), "c_nationkey").orderBy(F.desc("n"), F.asc("c_nationkey"))


@query(
    "top_one",
    "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey ORDER BY n DESC, l_suppkey LIMIT 1",
)
def top_one(spark, sf_dir):
    return top_rows(count_by(table(spark, sf_dir, "lineitem"), "l_suppkey"), 1, F.desc("n"), F.asc("l_suppkey"))


@query(
    "two_key_limit",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
       ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 10""",
)
def two_key_limit(spark, sf_dir):
    return top_rows(table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_quantity"), 10, *LINE_KEY)


@query(
    "partitioned_and_sorted",
    """SELECT event_type, city, n,
           row_number() OVER (PARTITION BY event_type ORDER BY city) AS place
       FROM (SELECT event_type, user_id % 40 AS city, count(*) AS n FROM events GROUP BY 1, 2)""",
)
def partitioned_and_sorted(spark, sf_dir):
    """Counts laid out by event type; the position within the layout shows the order inside a partition."""
    events = table(spark, sf_dir, "events").withColumn("city", F.col("user_id") % 40)
    laid_out = partition_and_sort(count_by(events, "event_type", "city"), 4, ["event_type"], ["event_type", "city"])
    placed = laid_out.withColumn("_at", F.monotonically_increasing_id())
    first = placed.groupBy("event_type").agg(F.min("_at").alias("_first"))
    return placed.join(first, "event_type").select(
        "event_type", "city", "n", (F.col("_at") - F.col("_first") + 1).alias("place")
    )


@query("fixed_parallelism", "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag")
def fixed_parallelism(spark, sf_dir):
    return with_parallelism(count_by(table(spark, sf_dir, "lineitem"), "l_returnflag"), 3)


@query(
    "date_text",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M') AS at FROM orders""",
)
def date_text(spark, sf_dir):
    """Dates to feed texts and back."""
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", bid_hour(F.date_format("o_orderdate", "HH-dd-MM-yyyy")).alias("at"))


@query(
    "tolerant_numbers",
    """SELECT o_orderkey,
           floor(TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN '' ELSE CAST(o_totalprice AS VARCHAR) END AS DOUBLE)
               * 0.803 * 1000 + 0.5) / 1000 AS euro FROM orders""",
)
def tolerant_numbers(spark, sf_dir):
    text = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_totalprice").cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", to_euro(text, F.lit("0.803")).alias("euro"))


@query("valid_prices", "SELECT count(*) AS n FROM orders WHERE o_orderstatus <> 'P'")
def valid_prices(spark, sf_dir):
    """Rows whose price text is empty or no number are dropped."""
    return tolerant_numbers(spark, sf_dir).where(F.col("euro").isNotNull()).agg(F.count(F.lit(1)).alias("n"))


@query(
    "absolute_difference",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, abs(l_quantity - 25) AS distance FROM lineitem",
)
def absolute_difference(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(*LINE_KEY, F.abs(F.col("l_quantity") - 25).alias("distance"))
