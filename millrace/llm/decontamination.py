"""Benchmark decontamination in DataFrame operations: hashed word windows, a broadcast table of test windows, checked hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.words import saved

#: Test windows up to this number are broadcast (about 200 bytes each); more are joined by a shuffle.
BROADCAST_WINDOWS = 500_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words: ASCII but digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PIECE = r"[0-9A-Za-z[^\x00-\x7F]]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is; ASCII texts take the quicker function, which does the same there."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lowered(F.coalesce(text, F.lit(""))), BETWEEN), "")


def _bound(value: Column, use) -> Column:
    """use(value), with `value` computed once: a name inside a lambda would be computed again for each element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _windows(hashes: Column, lengths: list[int]) -> Column:
    """(start, length, hash) of every run of `lengths` words; start counts from 1."""

    def of_length(size: int) -> Column:
        starts = F.when(F.size(hashes) >= size, F.sequence(F.lit(1), F.size(hashes) - (size - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(
            starts, lambda i: F.struct(i.alias("start"), F.lit(size).alias("length"), F.xxhash64(F.slice(hashes, i, size)).alias("hash"))
        )

    return F.concat(*(of_length(size) for size in lengths))


def test_windows(benchmark: DataFrame, width: int, id_column: str, text_column: str) -> DataFrame:
    """(hash, length, phrase, items) of each distinct window; an item shorter than `width` words is one window."""
    items = benchmark.select(F.col(id_column).cast("string").alias("item"), words_of(F.col(text_column)).alias("words")).where("size(words) > 0")
    length = F.least(F.lit(width), F.size("words"))
    starts = F.explode(F.sequence(F.lit(1), F.size("words") - length + 1))
    phrases = items.select("item", "words", length.alias("length"), starts.alias("start")).select(
        "item", "length", F.slice("words", F.col("start"), F.col("length")).alias("phrase")
    )
    return (
        phrases.groupBy("phrase", "length")
        .agg(F.collect_set("item").alias("items"))
        .withColumn("hash", F.xxhash64(F.transform("phrase", lambda w: F.xxhash64(w))))
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, width: int = 10, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, text, n_words, spans (start, length; disjoint, in words from 1), n_hit, items (sorted), contaminated.

    Every window of `width` words of a document is hashed and looked up among the windows of the benchmark, which are
    broadcast if they are few and joined by a shuffle otherwise. Found places go back to their document, where words are compared
    one by one; what remains is merged into spans.

    Null and empty texts have no words and no hits. An item without words has no window; an item with a null id hits, but is not
    named. Rows of one id are judged each by its own text, repeated rows alike; a null id is an id. Other columns are not looked at.
    """
    known = saved(test_windows(benchmark, width, item_column, item_text), "windows")
    shape = known.groupBy("length").count().collect()  # at most `width` rows
    lengths = sorted(row["length"] for row in shape)
    if sum(row["count"] for row in shape) <= BROADCAST_WINDOWS:
        known = F.broadcast(known)

    plain = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = "array<struct<start:int,length:int,phrase:array<string>,items:array<string>>>"
    if lengths:
        hashes = F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w))
        places = plain.select("doc_id", F.inline(_bound(hashes, lambda h: _windows(h, lengths))))
        found = (
            places.join(known, ["hash", "length"])
            .groupBy("doc_id")
            .agg(F.collect_set(F.struct("start", "length", "phrase", "items")).alias("found"))
        )
        joined = plain.join(found.withColumnRenamed("doc_id", "found_id"), F.col("doc_id").eqNullSafe(F.col("found_id")), "left").drop("found_id")
    else:
        joined = plain.withColumn("found", F.lit(None).cast(kind))
    checked = joined.withColumn(
        "judged",
        _bound(
            words_of(F.col("text")),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.filter(
                    F.coalesce("found", F.array().cast(kind)), lambda f: F.slice(w, f["start"], f["length"]) == f["phrase"]
                ).alias("hits"),
            ),
        ),
    ).select("doc_id", "text", "judged.n_words", "judged.hits")
    ordered = F.array_sort(F.transform("hits", lambda f: F.struct(f["start"].alias("start"), f["length"].alias("length"))))
    merged = F.aggregate(
        ordered,
        F.array().cast("array<struct<start:int,length:int>>"),
        lambda spans, s: F.when(
            (F.size(spans) > 0) & (s["start"] <= F.element_at(spans, -1)["start"] + F.element_at(spans, -1)["length"]),
            F.concat(
                F.slice(spans, 1, F.size(spans) - 1),
                F.array(
                    F.struct(
                        F.element_at(spans, -1)["start"].alias("start"),
                        F.greatest(
                            F.element_at(spans, -1)["length"], s["start"] + s["length"] - F.element_at(spans, -1)["start"]
                        ).alias("length"),
                    )
                ),
            ),
        ).otherwise(F.concat(spans, F.array(s))),
    )
    # One place covers most documents: without hits there is nothing to merge.
    spans = F.when(F.size("hits") > 0, merged).otherwise(F.array().cast("array<struct<start:int,length:int>>"))
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda f: f["items"]))))
    return checked.select(
        "doc_id", "text", "n_words", spans.alias("spans"), items.alias("items"), (F.size("hits") > 0).alias("contaminated")
    ).withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"]))


def without_spans(judged: DataFrame) -> DataFrame:
    """(doc_id, text) of contamination()'s rows with the hit words, and what follows each up to the next word, taken out."""
    pieces = F.regexp_extract_all("text", F.lit(PIECE), F.lit(0))
    lead = F.regexp_extract("text", r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", 0)
    left = F.filter(pieces, lambda p, i: ~F.exists("spans", lambda s: (i + 1 >= s["start"]) & (i + 1 < s["start"] + s["length"])))
    return judged.select("doc_id", F.when(F.col("contaminated"), F.concat(lead, F.array_join(left, ""))).otherwise(F.col("text")).alias("text"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of `docs`, all columns, whose (id, text) holds no window of the benchmark."""
    id_column, text_column = options.get("id_column", "doc_id"), options.get("text_column", "text")
    judged = contamination(docs, benchmark, **options).where("contaminated")
    hit = judged.select(F.col("doc_id").alias("hit_id"), F.xxhash64("text").alias("hit_text")).distinct()
    same = docs[id_column].eqNullSafe(F.col("hit_id")) & (F.xxhash64(docs[text_column]) == F.col("hit_text"))
    return docs.join(hit, same, "left_anti")
