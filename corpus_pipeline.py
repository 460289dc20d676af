"""From raw documents to a training mix: five stages, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm.decontamination import clean_documents
from millrace.llm.mixing import mixed_sources
from millrace.llm.near_duplicates import Sketching, near_duplicates
from millrace.llm.quality import quality_scores
from millrace.llm.queries import MIX, table
from millrace.llm.repeats import PASSAGE, without_repeats
from millrace.llm.words import saved

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


TEXT_KEYS = ["xxhash64(text) AS text_key", "xxhash64(1, text) AS text_check"]
#: A number below 2^63 for an id and text; ids may be null, and repeat.
SHORT_NAME = "shiftrightunsigned(xxhash64(doc_id, text_key, text_check), 1)"


def named(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, names): the documents with `name`, a number of their id and text, and doc_id, name, n of each different one.

    Names are computed from the rows wherever they are read, so no text is written or moved for them. Different pairs of id and
    128 bits of the text whose hashes are equal (about one pair in 2^64 of all) are found and get negative names.
    """
    keyed = docs.selectExpr(*COLUMNS, *TEXT_KEYS)
    key = ["doc_id", "text_key", "text_check"]
    names = saved(keyed.groupBy(*key).agg(F.count("*").alias("n")).withColumn("name", F.expr(SHORT_NAME)), "names")
    equal = names.groupBy("name").agg(F.count("*").alias("of")).where("of > 1")
    clashing = names.join(equal, "name").select(*key).orderBy(*key).collect()
    if not clashing:
        return keyed.withColumn("name", F.expr(SHORT_NAME)), names.select("doc_id", "name", "n")
    spark = docs.sparkSession
    own = spark.createDataFrame([(*r, -1 - at) for at, r in enumerate(clashing)], "own_id long, own_key long, own_check long, own_name long")
    own = F.broadcast(own)

    def with_own(rows: DataFrame) -> DataFrame:
        same = F.col("doc_id").eqNullSafe(F.col("own_id")) & F.col("text_key").eqNullSafe(F.col("own_key"))
        found = rows.join(own, same & F.col("text_check").eqNullSafe(F.col("own_check")), "left")
        return found.withColumn("name", F.coalesce("own_name", F.expr(SHORT_NAME))).drop("own_id", "own_key", "own_check", "own_name")

    return with_own(keyed), with_own(names).select("doc_id", "name", "n")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, does not reject.

    Every row is judged by its own text: rows of one id, and rows without an id, too. A label counts for all texts of its id.
    """
    rows, names = named(docs)
    labels = names.join(table(spark, sf_dir, "labels"), "doc_id").select("name", "quality")
    scores = quality_scores(rows, labels, id_column="name")
    rejected = scores.where("predicted = 0").select(F.col("doc_id").alias("name")).distinct()
    return rows.join(rejected, "name", "left_anti").select(COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id, and of those any one.

    Rows are grouped by their texts, so a row that repeats an id, or has none, is a copy like any other and goes unless it is the one
    that stays; one with an id stays rather than one without. Texts without words are copies where id and text are equal.
    """
    rows, names = named(docs)
    found = near_duplicates(rows, id_column="name", how=Sketching(width=5, percent=80)).select(F.col("doc_id").alias("name"), "component_id")
    members = names.join(found.distinct(), "name")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "name"))["name"].alias("first")
    kept = members.groupBy("component_id").agg(first)
    gone = saved(members.join(kept, "component_id").where("name <> first").select("name"), "copies")
    left = rows.join(gone, "name", "left_anti")
    repeated = saved(names.where("n > 1").select("name"), "repeated")
    if repeated.isEmpty():
        return left.select(COLUMNS)
    once = left.join(repeated, "name", "left_semi").dropDuplicates(["name"])
    return left.join(repeated, "name", "left_anti").unionByName(once).select(COLUMNS)


def own_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of PASSAGE words, or of 400 bytes, and more that occur elsewhere too; those with nothing left go.

    No occurrence stays, as boilerplate has no first place; whole copies are for the stage before, which leaves one of them.
    """
    found = without_repeats(docs, words=PASSAGE)
    return (
        found.where("n_removed = 0 or trim(text) <> ''")
        .select("row.doc_id", "text", "row.lang", "row.source", F.coalesce(F.char_length("text").cast("long"), "row.n_chars").alias("n_chars"))
    )


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark")).select(COLUMNS)


def weighted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, and how often each is to be read."""
    return mixed_sources(docs, MIX).select("row.*", "n_tokens", "copies")


STAGES = [
    ("quality classifier", good_quality),
    ("MinHash near-dedup", one_of_each),
    ("suffix-array dedup", own_passages),
    ("benchmark decontamination", uncontaminated),
    ("mixing to target weights", weighted),
]

#: The classifier, bands of hashes and suffix arrays cannot be said in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
