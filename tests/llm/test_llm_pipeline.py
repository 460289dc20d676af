"""The stages of the pipeline on planted rows, each against a plain version of its rule."""

import random
import re
from collections import Counter

import pytest

import corpus_pipeline
from millrace.llm.queries import MIX, OP8

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(3)
    known = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(900)]
    return lambda n: " ".join(rng.choice(known) for _ in range(n))


@pytest.fixture(scope="module")
def rows(prose):
    """Ids and texts with copies, near copies, repeated rows, rows without ids, and texts without words."""
    rng = random.Random(9)
    base = prose(120).split()
    junk = lambda n: " ".join("".join(rng.choice("0123456789#!$|") for _ in range(rng.randint(9, 30))) for _ in range(n))
    found = [(i, prose(rng.randint(30, 90)) if i % 2 == 0 else junk(rng.randint(8, 60))) for i in range(60)]
    for i in range(60, 75):
        near = list(base)
        for _ in range(rng.randint(0, 3)):
            near[rng.randrange(120)] = prose(1)
        found.append((i, " ".join(near)))
    found += [(4, found[4][1]), (4, found[4][1]), (80, found[4][1]), (None, found[4][1]), (5, found[6][1]), (None, found[7][1])]
    found += [(None, prose(50)), (None, "alone here"), (None, "alone here"), (81, None), (81, None), (82, ""), (None, ""), (None, ""), (83, " \n"), (84, " \n")]
    return found


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 5}", len(t or "")) for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture
def tables(spark, tmp_path, prose):
    spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(60)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, prose(25)), (2, prose(10)), (3, prose(4)), (4, None)], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    return str(tmp_path)


def of(frame):
    return Counter((r.doc_id, r.text) for r in frame.collect())


def test_quality_judges_every_row_by_its_text(spark, rows, tables):
    kept = of(corpus_pipeline.good_quality(spark, frame(spark, rows), tables))
    assert all((kept[i, t] > 0) == (i % 2 == 0) for i, t in rows if i in range(8, 60))
    verdict = {}
    for i, t in rows:
        verdict.setdefault(t or "", set()).add(kept[i, t] > 0)
    assert all(len(v) == 1 for v in verdict.values())
    assert all(n == Counter(rows)[row] for row, n in kept.items()) and kept[None, rows[4][1]] == 1 and not kept[None, rows[7][1]]


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_one_row_of_each_group_of_near_copies_stays(spark, rows):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            near = sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
            if near or (not sets[a] and rows[a] == rows[b]):
                group[root(a)] = root(b)
    members = {}
    for i in range(len(rows)):
        members.setdefault(root(i), []).append(rows[i])
    found = list(of(corpus_pipeline.one_of_each(spark, frame(spark, rows), "")).elements())
    assert len(found) == len(members)
    assert Counter(i for i, _ in found) == Counter(min((i for i, _ in m), key=lambda i: (i is None, i or 0)) for m in members.values())
    assert Counter(found) <= Counter(rows)


def test_documents_with_a_window_of_the_benchmark_go(spark, rows, tables):
    items = [r.text for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    planted = [(200, f"x {items[0]} y"), (201, " ".join(items[0].split()[4:14])), (202, " ".join(items[0].split()[4:13])), (203, items[2].upper()), (None, items[1])]
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    windows = {tuple(w[i : i + 10]) for w in map(split, items) if w for i in range(max(1, len(w) - 9))}

    def hit(text):
        w = split(text)
        return any(tuple(w[i : i + size]) in windows for size in {len(x) for x in windows} for i in range(len(w) - size + 1))

    all_rows = rows + planted
    kept = of(corpus_pipeline.uncontaminated(spark, frame(spark, all_rows), tables))
    assert kept == Counter(r for r in all_rows if not hit(r[1])) and (202, planted[2][1]) in kept and (201, planted[1][1]) not in kept


def test_the_mix_is_that_of_its_sql(spark, rows):
    duckdb = pytest.importorskip("duckdb")
    docs = frame(spark, [r for r in rows if r[0] is not None])
    connection = duckdb.connect()
    documents = docs.toPandas()  # noqa: F841  (read by the SQL)
    connection.register("documents", documents)
    expected = Counter((int(r[0]), int(r[5])) for r in connection.sql(OP8).fetchall())
    found = corpus_pipeline.weighted(spark, docs, "")
    assert Counter((r.doc_id, r.copies) for r in found.collect()) == expected and MIX.epochs > 1


def test_a_document_read_twice_is_kept_once(spark, prose, tables):
    long, other = prose(200), prose(150)
    docs = frame(spark, [(1, long), (1, long), (2, other), (None, long), (None, other)])
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        docs = corpus_pipeline.saved(stage(spark, docs, tables), "stage")
    assert of(docs) == Counter([(1, long), (2, other)])


def test_names_that_clash_are_told_apart(spark, rows, monkeypatch):
    docs = frame(spark, rows)
    whole = of(corpus_pipeline.one_of_each(spark, docs, ''))
    monkeypatch.setattr(corpus_pipeline, "SHORT_NAME", "pmod(xxhash64(doc_id, text_key, text_check), 40)")
    named, names = corpus_pipeline.named(docs)
    assert names.count() == names.select("name").distinct().count() == len(set(rows))
    assert named.select("name").distinct().count() == len(set(rows))
    clashing = of(corpus_pipeline.one_of_each(spark, docs, ''))
    assert sorted(i for i, _ in clashing.elements() if i is not None) == sorted(i for i, _ in whole.elements() if i is not None)
