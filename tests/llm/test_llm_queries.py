"""The queries on the smallest tables, and the pipeline stage by stage."""

import os
import random
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from check_oracle import difference, oracle_connection
from millrace.llm import repeats
from millrace.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the tables are not here")
ROWS = {"op2_url_filter": "pages", "op5_html_extraction": "pages"} | {
    name: "documents" for name in ("op1_near_duplicates", "op3_token_counts", "op4_language_model", "op7_suffix_array_dedup", "op10_quality_classifier")
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_sql(spark, name):
    assert difference(spark, oracle_connection(SF_DIR), SF_DIR, name) is None


@pytest.mark.parametrize("name", sorted(ROWS))
def test_query_has_a_row_for_each_input_row(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() == spark.read.parquet(f"{SF_DIR}/{ROWS[name]}.parquet").count()


def test_native_operators_run_no_python(spark, plan):
    for name in ("op6_decontamination", "op8_source_mixing"):
        assert not any(x in plan(QUERIES[name](spark, SF_DIR)) for x in ("Python", "Pandas", "Arrow"))


def test_stages_take_effect_and_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF_DIR)
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in before.select("doc_id").collect()} and ids
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == columns
            before = corpus_pipeline.saved(after, "stage")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = {r.doc_id for r in corpus_pipeline.good_quality(spark, docs, SF_DIR).collect()}
    assert sum((i in kept) == bool(q) for i, q in labels.items()) >= 0.97 * len(labels)


def test_run_is_the_stages_one_after_another(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.saved(stage(spark, docs, SF_DIR), "stage")
    found = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, docs.select(found.columns).collect()), key=repr)


def without_passages(texts):
    """The stage's rule in plain Python: runs of 51 words and strings of 400 bytes that occur twice go from every text."""
    lies = {i: [m.span() for m in re.finditer(rb"[^ \t-\r]+", t)] for i, t in texts.items()}
    words = {i: [t[a:b] for a, b in lies[i]] for i, t in texts.items()}
    runs = Counter(tuple(w[k : k + 51]) for w in words.values() for k in range(len(w) - 50))
    strings = Counter(t[k : k + 400] for t in texts.values() for k in range(len(t) - 399))
    kept = {}
    for i, t in texts.items():
        gone = [(lies[i][k][0], lies[i][k + 50][1]) for k in range(len(words[i]) - 50) if runs[tuple(words[i][k : k + 51])] > 1]
        gone += [(k, k + 400) for k in range(len(t) - 399) if strings[t[k : k + 400]] > 1]
        taken = {p for a, b in gone for p in range(a, b)}
        kept[i] = bytes(b for p, b in enumerate(t) if p not in taken).decode("utf-8", "ignore")
    return {i: t for i, t in kept.items() if t.strip() or not texts[i]}


def test_passages_of_more_than_fifty_words_are_taken_out(spark):
    rng = random.Random(5)
    own = lambda n: " ".join(f"{rng.randrange(10**6)}" for _ in range(n))
    short = " ".join(rng.choice("abcdefgé") for _ in range(51))
    fifty, sixty, solid = own(50), own(60), own(200).replace(" ", "")
    texts = {
        1: f"{own(30)} {short} {own(20)}", 2: f"{short} {own(90)}", 3: f"{own(9)} {short.replace(' ', chr(10) + ' ')}",
        4: f"{own(70)} {fifty} {own(5)}", 5: f"{fifty} {own(70)}", 6: f"{own(3)} {sixty} {own(3)} {sixty}", 7: own(400),
        8: f"{own(40)} {solid} {own(2)}", 9: f"{solid}", 10: f"{own(4)} {short.upper()}", 11: "", 12: sixty,
    }
    rows = [(i, t, "en", "s1", len(t)) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = {r.doc_id: r.text for r in corpus_pipeline.own_passages(spark, docs, SF_DIR).collect()}
    assert found == without_passages({i: t.encode() for i, t in texts.items()})
    assert 9 not in found and 12 not in found and fifty in found[4] and short not in found[1]


def test_op7_counts_passages_shorter_than_its_strings(spark, tmp_path):
    rng = random.Random(8)
    own = lambda n: " ".join(f"{rng.randrange(10**6)}" for _ in range(n))
    passage, fifty, long = (" ".join(rng.choice(["to", "be", "né", "or"]) for _ in range(n)) for n in (55, 50, 300))
    texts = {
        1: f"{own(30)} {passage} {own(20)}", 2: f"{own(5)} {passage.replace(' ', chr(10))}", 3: f"{own(40)} {fifty} x", 4: f"{own(9)} {fifty} y",
        5: f"{long} {own(9)} {long[:-3]}", 6: own(300), 7: "", 8: None, 9: f"{passage} {own(1)} {passage} {own(60)}",
    }
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, t, "en", "s1", 0) for i, t in texts.items()], columns).write.parquet(f"{tmp_path}/documents.parquet")
    raws = {i: (t or "").encode() for i, t in texts.items()}
    lies = {i: [m.span() for m in re.finditer(rb"[^ \t-\r]+", t)] for i, t in raws.items()}
    runs = {i: [tuple(raws[i][a:b] for a, b in own[k : k + 51]) for k in range(len(own) - 50)] for i, own in lies.items()}
    seen = Counter(run for own in runs.values() for run in own)
    expected = {}
    for i, own in runs.items():
        marked = {p for k, run in enumerate(own) if seen[run] > 1 for p in range(lies[i][k][0], lies[i][k + 50][1])}
        expected[i] = (len(raws[i]), sum(p - 1 not in marked for p in marked), len(marked))
    rows = {r.doc_id: r for r in QUERIES["op7_suffix_array_dedup"](spark, str(tmp_path)).collect()}
    assert {i: (r.n_bytes, r.n_passages, r.n_passage_bytes) for i, r in rows.items()} == expected
    assert {i for i, r in rows.items() if r.n_passages} == {1, 2, 5, 9} and {i for i, r in rows.items() if r.n_removed} == {5}
    assert all(r.text == texts[i] for i, r in rows.items() if i != 5)
    plain = repeats.without_repeats(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    own = ["n_removed", "n_spans", "kept_sha256", "text"]
    assert {r.row.doc_id: [r[c] for c in own] for r in plain.collect()} == {i: [r[c] for c in own] for i, r in rows.items()}


def test_crowded_seeds_of_words_are_counted_alike(spark):
    rng = random.Random(6)
    own = lambda n: " ".join(f"{rng.randrange(30)}" for _ in range(n))
    shared = own(80)
    rows = [(f"{own(rng.randrange(60))} {' '.join(shared.split()[rng.randrange(20):])} {own(40)}",) for _ in range(20)]
    docs = spark.createDataFrame(rows, "text string")
    spans = [{r.text_key: repeats._united([tuple(x) for x in r.spans]) for r in repeats.repeat_spans(docs, window=51, surroundings=n, kind=np.uint64).collect()} for n in (1, 20_000)]
    assert spans[0] == spans[1] and spans[0]
