"""URL filtering: written rules first, gradient-boosted trees on lexical features for what no rule says."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.words import saved

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rules_of(lines: list[str]) -> list[Rule]:
    """Rules written as `allow host/path` or `block host/path`."""
    found = []
    for line in lines:
        verdict, place = line.split()
        host, slash, path = place.partition("/")
        found.append(Rule(verdict, host, slash + path))
    return found


@dataclass(frozen=True)
class Settings:
    """max_labelled bounds the labelled URLs that the trees learn from; more are thinned by a hash of the URL."""

    trees: int = 20
    depth: int = 4
    max_labelled: int = 500_000
    seed: int = 5


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next /, ? or #, A-Z lower-cased; empty for null and where no :// is."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """(rule, verdict) of the longest rule that fits; null if none does."""
    chosen = F.when(F.lit(False), F.struct(F.lit("").alias("rule"), F.lit("").alias("verdict")))
    for rule in sorted(rules, key=lambda r: -len(r.text)):
        of_host = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        chosen = chosen.when(
            of_host & F.startswith(path, F.lit(rule.path)), F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        )
    return chosen


def _lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    query = F.coalesce(F.regexp_extract(url, r"(?s)\?([^#]*)", 1), F.lit(""))
    size = F.greatest(F.char_length(url), F.lit(1)).cast("double")
    count = lambda pattern, of: F.regexp_count(of, F.lit(pattern)).cast("double")
    # Entropy of the characters: log2 n - sum(c log2 c) / n over the counts c of the distinct ones.
    letters = F.array_distinct(F.split(url, ""))
    times = F.transform(letters, lambda x: (F.char_length(url) - F.char_length(F.replace(url, x, F.lit("")))).cast("double"))
    spread = F.aggregate(times, F.lit(0.0), lambda total, c: total + F.when(c > 0, c * F.log2(c)).otherwise(0.0))
    return {
        "length": size,
        "host_length": F.char_length(host).cast("double"),
        "path_length": F.char_length(path).cast("double"),
        "depth": count("/", path),
        "host_parts": count(r"\.", host),
        "digits": count("[0-9]", url) / size,
        "host_digits": count("[0-9]", host),
        "hyphens": count("-", host),
        "parameters": F.when(query == "", 0.0).otherwise(count("&", query) + 1),
        "marks": count("[^A-Za-z0-9/.:]", url),
        "capitals": count("[A-Z]", url),
        "secure": F.startswith(url, F.lit("https")).cast("double"),
        "entropy": F.log2(size) - spread / size,
    }


def _endings(host: Column, path: Column) -> dict[str, Column]:
    """What statistics are kept on: the last part of the host, the last two, the first directory, the ending of the file."""
    return {
        "suffix": F.element_at(F.split(host, r"\."), -1),
        "domain": F.regexp_extract(host, r"([^.]*\.[^.]*)$", 1),
        "directory": F.regexp_extract(path, r"^/([^/]*)", 1),
        "ending": F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1),
    }


def judged_urls(pages: DataFrame, rules: list[Rule], how: Settings = Settings(), id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict and block_score of every row.

    The URLs that a rule judges are the labelled ones. Boosted trees learn from their lexical features and from smoothed shares of
    blocked URLs by ending; they judge the rest, blocking from a probability of one half on. Statistics by ending are joined as a table,
    whose size Spark weighs. With labels of one kind only, the rest gets that verdict; without any, it is allowed.

    A null URL and one without :// have an empty host and path, fit no rule and are judged by their features. Repeated rows get the
    same verdict, ids may be null; other columns are not looked at.
    """
    url = F.coalesce(F.col("url"), F.lit(""))
    plain = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"))
    plain = plain.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    plain = plain.withColumn("judged", rule_of(F.col("host"), F.col("path"), rules))
    parts = {**_lexical(url, F.col("host"), F.col("path"))}
    endings = _endings(F.col("host"), F.col("path"))
    plain = plain.select(
        "page_id", "url", "host", "path", F.col("judged.rule").alias("rule"), F.col("judged.verdict").alias("verdict"),
        *(c.alias(f"x_{k}") for k, c in parts.items()), *(c.alias(f"e_{k}") for k, c in endings.items()),
    )
    rows = saved(plain, "urls")

    labelled = rows.where("verdict is not null").withColumn("y", (F.col("verdict") == "block").cast("double"))
    counts = labelled.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0.0)).alias("blocked")).first()
    if not 0 < counts["blocked"] < counts["n"]:
        other = "block" if counts["n"] and counts["blocked"] else "allow"
        score = F.lit(1.0 if other == "block" else 0.0)
        return rows.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(other)).alias("verdict"), score.alias("block_score"))
    prior = counts["blocked"] / counts["n"]
    described = rows
    for k in endings:
        shares = labelled.groupBy(f"e_{k}").agg(((F.sum("y") + 10 * prior) / (F.count("*") + 10)).alias(f"x_{k}"))
        described = described.join(shares, f"e_{k}", "left").fillna({f"x_{k}": prior})
    names = [f"x_{k}" for k in [*parts, *endings]]
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(described)
    sample = vectors.where("verdict is not null").withColumn("y", (F.col("verdict") == "block").cast("double"))
    if counts["n"] > how.max_labelled:
        share = int((1 << 20) * how.max_labelled / counts["n"])
        sample = sample.where(F.pmod(F.xxhash64("url", F.lit(how.seed)), F.lit(1 << 20)) < share)
    trees = GBTClassifier(
        featuresCol="features", labelCol="y", maxIter=how.trees, maxDepth=how.depth, seed=how.seed, maxBins=32, cacheNodeIds=False
    ).fit(saved(sample.select("features", "y"), "labelled-urls"))
    chance = vector_to_array(F.col("probability"))[1]
    judged = trees.transform(vectors).withColumn("block_score", chance)
    learned = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("verdict", learned).alias("verdict"), "block_score")
