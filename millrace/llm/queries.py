"""One query for each operator over the given tables, with the SQL that it must match where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import (
    decontamination, hamming_index, html_text, language_model, mixing, near_duplicates, quality, repeats, sharding, token_counts, url_filter,
    vector_codes, whitening,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op1_near_duplicates")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), how=near_duplicates.Sketching(width=3, percent=85))


OP6 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT item_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
bw AS (
  SELECT item_id, least(10, len(w)) AS size, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i, w FROM b WHERE len(w) > 0),
known AS (SELECT DISTINCT item_id, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS phrase FROM bw),
dw AS (
  SELECT r, size, unnest(generate_series(1, len(w) - size + 1)) AS i, w FROM d, (SELECT DISTINCT size FROM known) WHERE len(w) >= size),
hit AS (
  SELECT r, i, size, item_id FROM (SELECT r, i, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS phrase FROM dw)
  JOIN known USING (size, phrase)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + size - 1)) AS p FROM hit) GROUP BY r),
items AS (
  SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS list
  FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""


@query("op6_decontamination", OP6)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def held_out(divisor: int, remainder: int):
    return F.crc32(F.col("doc_id").cast("string")) % divisor == remainder


@query("op10_quality_classifier")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn=~held_out(3, 1))
    return scores.select("doc_id", held_out(3, 1).alias("held_out"), "score", "predicted")


@query("op7_suffix_array_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings of 400 bytes go; passages of more than 50 words, most of them shorter than that, are counted beside them and stay."""
    found = repeats.without_repeats(table(spark, sf_dir, "documents"), marked=repeats.PASSAGE)
    return found.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text", "n_passages", "n_passage_bytes")


#: The vocabulary file of op3.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


@query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), VOCABULARY, raw=True)


#: Sources are numbered; the first ones stand for the web, the next for reference works, the rest for forums.
DOMAIN = """CASE WHEN try_cast(regexp_extract(source, '[0-9]+', 0) AS INT) < 8 THEN 'web'
  WHEN try_cast(regexp_extract(source, '[0-9]+', 0) AS INT) < 14 THEN 'reference' ELSE 'forum' END"""
MIX = mixing.Mix(
    levels=(("domain", DOMAIN), ("lang", "lang"), ("source", "source")),
    weights={"domain": {"web": 5, "reference": 3, "forum": 2}, "lang": {"en": 6, "de": 2, "fr": 2}},
)


def _fill_sql(level: str, parents: list[str], above: str) -> str:
    """Budgets of one level, as mixing._filled has them."""
    weights = MIX.weights.get(level, {})
    weight = "CASE " + level + "".join(f" WHEN '{k}' THEN {v}" for k, v in weights.items()) + " ELSE 1 END" if weights else "1"
    keys = ", ".join([*parents, level])
    part = f"PARTITION BY {', '.join(parents)}" if parents else ""
    using = f"JOIN {above} USING ({', '.join(parents)})" if parents else f"CROSS JOIN {above}"
    return f"""
  {level}_a AS (SELECT {keys}, sum(capacity)::HUGEINT AS capacity, ({weight})::HUGEINT AS weight FROM leaf GROUP BY {keys}),
  {level}_b AS (SELECT {keys}, capacity, weight, budget AS of_parent,
    coalesce(sum(capacity) OVER ({part} ORDER BY capacity::DOUBLE / weight::DOUBLE, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(weight) OVER ({part} ORDER BY capacity::DOUBLE / weight::DOUBLE, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after
    FROM {level}_a {using}),
  {level}_c AS (SELECT *, capacity * after <= weight * (of_parent - before) AS is_full FROM {level}_b),
  {level}_d AS (SELECT *, sum(CASE WHEN is_full THEN capacity ELSE 0 END) OVER ({part}) AS taken,
    sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({part}) AS shares FROM {level}_c),
  {level}_budget AS (SELECT {keys}, (CASE WHEN is_full THEN capacity
    ELSE least(((of_parent - taken) * weight)::HUGEINT // nullif(shares, 0)::HUGEINT, capacity) END)::HUGEINT AS budget FROM {level}_d)"""


_LEVELS = [name for name, _ in MIX.levels]
OP8 = f"""
WITH doc AS (SELECT doc_id, {DOMAIN} AS domain, coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens FROM documents),
  leaf AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens, sum(n_tokens)::HUGEINT * {MIX.epochs} AS capacity FROM doc GROUP BY ALL),
  root AS (SELECT least((sum(tokens) * {MIX.parts})::HUGEINT // {MIX.of}::HUGEINT, sum(capacity)::HUGEINT) AS budget FROM leaf),
  {",".join(_fill_sql(level, _LEVELS[:i], "root" if i == 0 else f"{_LEVELS[i - 1]}_budget") for i, level in enumerate(_LEVELS))},
  plan AS (SELECT domain, lang, source, (budget // tokens)::BIGINT AS full_epochs, (budget % tokens)::BIGINT AS rest
    FROM leaf JOIN source_budget USING (domain, lang, source) WHERE tokens > 0),
  placed AS (SELECT doc.*, full_epochs, rest, md5('{MIX.seed}/' || full_epochs || '/' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place
    FROM doc JOIN plan USING (domain, lang, source)),
  ordered AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place) AS upto FROM placed)
SELECT doc_id, domain, lang, source, n_tokens, full_epochs + CAST(rest > 0 AND upto <= rest AS BIGINT) AS copies FROM ordered
WHERE full_epochs + CAST(rest > 0 AND upto <= rest AS BIGINT) > 0
"""


@query("op8_source_mixing", OP8)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.mixed_sources(table(spark, sf_dir, "documents"), MIX)
    return taken.select("row.doc_id", "domain", "lang", "source", "n_tokens", "copies")


RULES = url_filter.rules_of(["allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/"])


@query("op2_url_filter")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged_urls(table(spark, sf_dir, "pages"), RULES)


@query("op5_html_extraction")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


@query("op9_nearest_neighbours")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_index.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op4_language_model")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = language_model.text_scores(table(spark, sf_dir, "documents"), ~held_out(7, 2))
    return scores.select("doc_id", held_out(7, 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def _op11_sql(parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> str:
    """Every component against every entry: rows of (r, p, x) and codebooks of (p, e, c), where p is a place in the vector."""
    assigned = """assigned{i} AS (
  SELECT r, part, (min(d * {entries} + e) % {entries})::BIGINT AS e, (min(d * {entries} + e) // {entries})::BIGINT AS d
  FROM (SELECT r, part, e, sum((x - c) * (x - c))::HUGEINT AS d FROM parts JOIN book{i} USING (p) GROUP BY r, part, e) GROUP BY r, part)"""
    moved = """book{j} AS (
  SELECT p, e, coalesce(m, c) AS c FROM book{i} LEFT JOIN (
    SELECT p, e, ((s - ((s % n) + n) % n) // n)::BIGINT AS m
    FROM (SELECT p, e, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM parts JOIN assigned{i} USING (r, part) GROUP BY p, e)) USING (p, e))"""
    steps = [assigned.format(i=0, entries=entries)]
    for i in range(rounds):
        steps += [moved.format(i=i, j=i + 1), assigned.format(i=i + 1, entries=entries)]
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, embedding AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
parts AS (
  SELECT r, p, p * {parts} // w AS part, x FROM (
    SELECT r, len(v) AS w, unnest(range(len(v))) AS p, unnest(list_transform(v, lambda x: floor({scale} * x::DOUBLE)::BIGINT)) AS x FROM kept)),
book0 AS (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= {entries}),
{", ".join(steps)},
coded AS (
  SELECT r, string_agg(format('{{:02x}}', e), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM assigned{rounds} GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, e, p))
   FROM (SELECT book{rounds}.*, part FROM book{rounds} JOIN (SELECT DISTINCT p, part FROM parts) USING (p))) AS codebooks_sha256
FROM kept JOIN coded USING (r)
"""


@query("op11_vector_codes", _op11_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))
    return coded.select(F.col("vec_key").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")


@query("op12_sharding")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.sharded(table(spark, sf_dir, "documents"), carried=["doc_id"])
    return placed.select("row.doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whitened(table(spark, sf_dir, "embeddings"))
    return found.withColumnRenamed("vec_key", "vec_id")
