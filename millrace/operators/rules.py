"""Ordered rules that live in a table: a rule fits a text that contains all its parts, and the first rule that fits names the text.

Every run of GRAM characters of a part occurs in each text that the rule fits. A rule is filed under the rarest such run, as counted
over the texts, so texts and rules meet in an equi-join that proposes few pairs; the pairs are then checked part by part. The plan
is the same for ten rules and for a million. Of rules with the same parts only the first can name a text, so the others are left out
before they meet any.

Texts are written compressed, and each has as many runs as characters: the size that Spark plans with is far below what a join has to
hold, so no side made of them is ever broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import written

GRAM = 3
RULE = "position bigint, family string, parts array<string>"


def grams(text: Column) -> Column:
    """The distinct runs of GRAM characters of a text; none for a shorter one."""
    places = F.when(F.length(text) >= GRAM, F.sequence(F.lit(1), F.length(text) - (GRAM - 1))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda at: F.substring(text, at, F.lit(GRAM))))


def rule_rows(spark: SparkSession, rules) -> DataFrame:
    """Rules of a list of (family, parts) as a table, in the order of the list."""
    return spark.createDataFrame([(at, family, list(parts)) for at, (family, parts) in enumerate(rules)], RULE)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """A rule file: position, family and one part or more in each line, parted by tabs. Lines without a position or part are no rules."""
    fields = F.split("value", "\t")
    rows = spark.read.text(path).select(
        F.element_at(fields, 1).try_cast("bigint").alias("position"),
        F.get(fields, F.lit(1)).alias("family"),
        F.filter(F.slice(fields, 3, F.greatest(F.size(fields), F.lit(1))), lambda part: part != "").alias("parts"),
    )
    return rows.where("position is not null and size(parts) > 0")


def _first_of_equals(rules: DataFrame) -> DataFrame:
    """One rule for each set of parts that are not empty: the first one."""
    parts = F.array_sort(F.array_distinct(F.filter("parts", lambda part: part != ""))).alias("parts")
    return rules.groupBy(parts).agg(F.min(F.struct("position", "family")).alias("_first")).select("_first.*", "parts")


def _filed(rules: DataFrame, counts: DataFrame) -> DataFrame:
    """Rules with the `gram` they are found by; one whose parts are all too short for one has the empty text."""
    numbered = _first_of_equals(rules)
    numbered = numbered.withColumn("of", F.array_distinct(F.flatten(F.transform("parts", grams))))
    short = numbered.where("size(of) = 0").select("position", "family", "parts", F.lit("").alias("gram"))
    rarest = F.min(F.struct("count", "gram"))["gram"].alias("gram")
    # A run that no text has leaves the rule without one: it fits nothing.
    each = numbered.select("position", "family", "parts", F.size("of").alias("needed"), F.explode("of").alias("gram"))
    found = each.join(counts.hint("merge"), "gram").groupBy("position", "family", "parts", "needed").agg(rarest, F.count("*").alias("present"))
    return found.where("present = needed").select("position", "family", "parts", "gram").unionByName(short)


def families_by_rules(texts: DataFrame, rules: DataFrame, column: str, default: str = "Other") -> DataFrame:
    """Each distinct text of a column with the `family` of the first rule that fits, or `default`.

    `rules` has position, family and parts; the smallest position wins, and of equal ones the smallest family. An empty part is no
    condition, a rule without parts fits every text, and a null part or no list of parts makes the rule fit none. A null text stays null
    and is `default`.
    """
    own = texts.select(F.col(column).alias("text")).distinct()
    own = written(own.withColumn("grams", grams(F.coalesce("text", F.lit("")))), "texts")
    usable = rules.where("position is not null and parts is not null and not exists(parts, p -> p is null)")
    counts = own.select(F.explode("grams").alias("gram")).groupBy("gram").count()
    filed = _filed(usable, counts)
    runs = own.where("text is not null").select("text", F.explode(F.array_append("grams", F.lit(""))).alias("gram"))
    met = runs.hint("merge").join(filed, "gram")
    fits = met.where(F.forall("parts", lambda part: F.contains(F.col("text"), part)))
    first = fits.groupBy("text").agg(F.min(F.struct("position", "family"))["family"].alias("family"))
    named = own.select("text").join(first.hint("merge"), "text", "left")
    return named.select(F.col("text").alias(column), F.coalesce("family", F.lit(default)).alias("family"))
