"""Maximal repeat groups with all their occurrences, against every substring of every surrounding."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import repeats

WINDOW = 40


@pytest.fixture(scope="module")
def texts():
    """Passages in several texts with other ends, passages within passages, whole copies, runs of one letter, null, empty and short texts."""
    rng = random.Random(9)
    fresh = lambda n: "".join(rng.choice("abcdefgh \u00e9") for _ in range(n))
    passage, short = fresh(130), fresh(60)
    rows = [fresh(rng.randint(0, 50)) + passage[rng.randint(0, 40) : rng.randint(85, 130)] + fresh(rng.randint(0, 50)) for _ in range(12)]
    rows += [fresh(10) + short + fresh(rng.randint(0, 3)) for _ in range(5)] + [short, short + passage, passage + "x" + passage]
    rows += ["a" * 70, "b" + "a" * 60, "ab" * 45, fresh(39), fresh(200), rows[2], rows[2], passage, None, "", "a"]
    return rows


def named(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    keys = {r.text: (r.a, r.b) for r in rows.select("text", F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b")).collect()}
    return rows, keys


def digest(part):
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(part), dtype=np.int64).tolist())


def expected(texts, keys):
    """Each group's length and places: strings of a surrounding that others of its seed have too, but none with the same unit on a side."""
    surroundings = defaultdict(list)
    for t in filter(None, texts):
        raw = np.frombuffer(t.encode(), dtype=np.uint8)
        for seed, _, first, last in repeats.owners(raw, WINDOW):
            surroundings[seed].append((keys[t], first, raw[first : last + WINDOW].tobytes()))
    found = {}
    for own in surroundings.values():
        places = defaultdict(list)
        for i, (_, _, part) in enumerate(own):
            for a in range(len(part) - WINDOW + 1):
                for z in range(a + WINDOW, len(part) + 1):
                    places[part[a:z]].append((i, a, z))
        for string, at in places.items():
            lefts = {own[i][2][a - 1] if a else (i,) for i, a, _ in at}
            rights = {own[i][2][z] if z < len(own[i][2]) else (i,) for i, _, z in at}
            if len(lefts) > 1 and len(rights) > 1:
                found[digest(string)] = (len(string), Counter((own[i][0], own[i][1] + a) for i, a, _ in at))
    return found


def unfolded(groups, occurrences):
    """Each group's length and all its places, its own and those of the groups within it."""
    groups, around = groups.collect(), {}
    places = {(g.group_key, g.group_check): Counter() for g in groups}
    assert len(places) == len(groups)
    for g in groups:
        around[g.group_key, g.group_check] = (g.around_key, g.around_check)
    for r in occurrences.collect():
        name = (r.group_key, r.group_check)
        while name != (None, None):
            places[name][(r.text_key, r.text_check), r.first] += 1
            name = around[name]
    return {(g.group_key, g.group_check): (g.length, places[g.group_key, g.group_check]) for g in groups}


def test_groups_and_all_their_places(spark, texts):
    docs, keys = named(spark, texts)
    found = unfolded(*repeats.repeat_groups(docs, window=WINDOW))
    assert found == expected(texts, keys)
    assert len(found) > 20


@pytest.mark.parametrize("surroundings", [1, 20_000])
def test_spans_are_what_groups_cover(spark, texts, surroundings):
    docs, _ = named(spark, texts)
    found = defaultdict(list)
    for length, places in unfolded(*repeats.repeat_groups(docs, window=WINDOW, surroundings=surroundings)).values():
        assert sum(places.values()) > 1
        for key, first in places:
            found[key].append((first, first + length))
    spans = {(r.text_key, r.text_check): repeats._united([tuple(x) for x in r.spans]) for r in repeats.repeat_spans(docs, window=WINDOW).collect()}
    assert {k: repeats._united(x) for k, x in found.items()} == spans


def test_no_groups(spark):
    docs, _ = named(spark, [None, "", "short"])
    assert [x.count() for x in repeats.repeat_groups(docs)] == [0, 0]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert [x.count() for x in repeats.repeat_groups(empty)] == [0, 0]
