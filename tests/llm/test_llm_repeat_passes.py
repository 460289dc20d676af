"""What the repeat finder keeps small: passes over the texts, rows held by a task, places per repeat."""

import random

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import repeats
from millrace.llm.words import exact_hashes


def test_each_place_is_given_once_with_the_longest_repeat_it_starts():
    nested = {}
    found = list(repeats.maximal_repeats(np.array([10, 20, 30]), np.array([0, 41, 46]), np.array([-1, -2, -3]), 40, nested))
    assert sorted(found) == [(10, 41, 0), (20, 46, 1), (30, 46, 1)] and nested == {(1, 46): (0, 41)}


def test_bytes_and_words_are_found_in_one_pass(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(repeats, "saved", lambda rows, purpose, write=repeats.saved: kept.append(purpose) or write(rows, purpose))
    rng = random.Random(3)
    shared = " ".join(f"{rng.randrange(10**6)}" for _ in range(90))
    docs = spark.createDataFrame([(f"{rng.random()} {shared} {rng.random()}",) for _ in range(3)], "text string")
    assert repeats.without_repeats(docs, marked=51).where("n_passages = 1 and n_spans = 1").count() == 3
    assert kept == ["anchors", "classes", "ranges"]


@pytest.mark.parametrize(("kind", "window"), [(np.uint8, 40), (np.uint64, 9)])
def test_anchors_of_texts_laid_together_are_those_of_each_alone(kind, window, monkeypatch):
    monkeypatch.setattr(repeats, "ROWS", 100)
    monkeypatch.setattr(repeats, "PILE", 1000)
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab \té") for _ in range(rng.randint(0, 300))) for _ in range(60)] + ["a" * 300, "", " ", "x" * 2000]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([7] * len(texts)), pa.array(texts)], names=["text_key", "text_check", "text"])
    found = list(repeats._anchors({kind: window})(iter([batch])))
    assert len(found) > 1 and max(b.num_rows for b in found) < 100 + 2000
    expected = []
    for i, text in enumerate(texts):
        raw = repeats._laid([text.encode()], kind)[0]
        for seed, place, first, last in repeats.owners(raw, window):
            expected.append((i, 7, (seed & ~1) | repeats.BITS[kind], *repeats._digest(raw[first : last + window].tobytes()), first, last - first + 1, place - first))
    assert [tuple(r.values()) for b in found for r in b.to_pylist()] == expected


def test_words_have_one_hash_each():
    words = [b"a", b"A", b"a\0", b"12345678", b"123456789", b"1234567890123456", b"12345678901234567", b"12345678901234568", b"\xc3\xa9"]
    found, first = exact_hashes(b" \t".join([*words, b"a", words[6]]) + b"\n")
    assert len(set(found.tolist())) == len(words) and found[0] == found[-2] and found[6] == found[-1] and found.max() < 1 << 63
    assert first.tolist()[:3] == [0, 3, 6] and exact_hashes(b"")[0].tolist() == []
