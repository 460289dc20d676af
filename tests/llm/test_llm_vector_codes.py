"""Cover trees and codes against plain comparisons of whole numbers."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from millrace.llm import cover_tree, vector_codes
from millrace.llm.vector_codes import Settings

VECTORS = "vec_id long, embedding array<float>, label int, code string, vec_key int, trees int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1, 2) for i, v, label in rows], VECTORS).repartition(3)


def nearest(point, book):
    return min(range(len(book)), key=lambda e: (sum((int(a) - int(b)) ** 2 for a, b in zip(point, book[e])), e))


@pytest.mark.parametrize("spread", [3, 40, 5000, 2**40])
@pytest.mark.parametrize("leaf", [1, 8])
def test_trees_cover_and_assign_exactly(spread, leaf):
    rng = np.random.default_rng(spread)
    groups = rng.integers(-spread, spread, (12, 3))
    points = groups[rng.integers(0, 12, 500)] + rng.integers(-2, 3, (500, 3))
    tree = cover_tree.cover_tree(points, leaf)
    assert sorted(tree.order.tolist()) == list(range(500)) and (tree.points == points[tree.order]).all()
    for i in range(len(tree.low)):
        own, centre = tree.points[tree.low[i] : tree.high[i]], tree.points[tree.centre[i]]
        assert np.sqrt(((own - centre).astype(float) ** 2).sum(axis=1)).max() <= tree.radius[i] * (1 + 1e-12)
        children = range(tree.first[i], tree.last[i])
        if children:
            assert tree.centre[children[0]] == tree.centre[i] and sum(tree.high[c] - tree.low[c] for c in children) == len(own)
            heads = tree.points[tree.centre[children]].astype(float)
            apart = np.sqrt(((heads[:, None] - heads[None]) ** 2).sum(axis=2)) + np.eye(len(heads)) * 1e99
            assert apart.min() > tree.radius[i] / 2 >= max(tree.radius[c] for c in children)
        else:
            assert len(own) <= leaf or tree.radius[i] == 0
    entries = np.concatenate([points[:9], points[:2], groups[:3] + 1])
    found = cover_tree.assign(tree, entries)
    expected = [nearest(p, entries) for p in tree.points.tolist()]
    assert found.entry.tolist() == expected and found.counts.tolist() == [expected.count(e) for e in range(len(entries))]
    for e in range(len(entries)):
        assert found.sums[e].tolist() == [sum(int(p[d]) for p, x in zip(tree.points.tolist(), expected) if x == e) for d in range(3)]
    assert found.by_subtree > 250 or spread == 3


def plain_codes(rows, how):
    """The rows' codes by comparing everything with everything."""
    kept = [(i, v, label) for i, v, label in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    length = Counter(len(v) for _, v, _ in kept).most_common(1)[0][0]
    kept = [(i, [math.floor(how.scale * float(np.float32(c))) for c in v], label) for i, v, label in kept if len(v) == length]
    edges = [length * p // how.parts for p in range(how.parts + 1)]
    start = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[: how.entries]
    books = [[v[a:b] for _, v, _ in start] for a, b in zip(edges, edges[1:])]
    split = lambda: [[nearest(v[a:b], books[p]) for p, (a, b) in enumerate(zip(edges, edges[1:]))] for _, v, _ in kept]
    for _ in range(how.rounds):
        codes = split()
        for p, (a, b) in enumerate(zip(edges, edges[1:])):
            for e in range(len(books[p])):
                own = [v[a:b] for (_, v, _), code in zip(kept, codes) if code[p] == e]
                if own:
                    books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    out, by_label = [], defaultdict(int)
    for (i, v, label), code in zip(kept, split()):
        error = sum(sum((x - y) ** 2 for x, y in zip(v[a:b], books[p][code[p]])) for p, (a, b) in enumerate(zip(edges, edges[1:])))
        by_label[label] += error
        out.append((i, label, bytes(code).hex(), error))
    limit = 2**63 - 1
    return Counter((i, label, code, min(limit, error), min(limit, by_label[label]), digest) for i, label, code, error in out)


@pytest.mark.parametrize("length", [16, 32, 19, 5])
def test_codes_against_plain_comparison(spark, length):
    rng = np.random.default_rng(length)
    kinds = rng.normal(size=(9, length))
    rows = [(i, (kinds[i % 9] + rng.normal(size=length) * 0.1 * (i % 3)).tolist(), i % 4 if i % 5 else None) for i in range(300)]
    rows += [(300, None, 1), (301, [], 1), (302, [None] + [1.0] * (length - 1), 1), (303, [math.nan] * length, 1), (304, [math.inf] * length, 2)]
    rows += [(305, [1.0] * (length + 1), 1), (None, rows[4][1], 9), (7, rows[7][1], 3), (7, rows[8][1], 3), (7, rows[7][1], 3), (-5, [0.0] * length, None)]
    how = Settings(block=100 * length)
    found = vector_codes.vector_codes(frame(spark, rows), how)
    assert Counter(map(tuple, found.collect())) == plain_codes(rows, how)


def test_large_numbers_stay_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=16) * 10.0 ** rng.integers(0, 13)).tolist(), 1) for i in range(120)]
    how = Settings(parts=4, entries=5)
    assert Counter(map(tuple, vector_codes.vector_codes(frame(spark, rows), how).collect())) == plain_codes(rows, how)


def test_few_vectors_and_none(spark):
    assert vector_codes.vector_codes(frame(spark, [])).collect() == []
    assert vector_codes.vector_codes(frame(spark, [(1, None, 1), (2, [math.nan], 1)])).collect() == []
    rows = [(1, [0.5] * 16, None), (2, [-0.25] * 16, 1)]
    assert Counter(map(tuple, vector_codes.vector_codes(frame(spark, rows)).collect())) == plain_codes(rows, Settings())
