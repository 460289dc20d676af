"""Whitening against plain arithmetic on whole numbers."""

import math
from collections import Counter

import numpy as np
import pytest

from millrace.llm import whitening
from millrace.llm.whitening import Settings

VECTORS = "vec_id long, embedding array<float>, n int, vec_key string, component int, whitened double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 1, 0.5) for i, v in rows], VECTORS).repartition(3)


def expected(rows, components):
    """n, sums, covariance and deviations in Python's integers."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    width = Counter(len(v) for _, v in kept).most_common(1)[0][0]
    x = [(i, [math.floor(1024 * float(np.float32(c))) + 100_000 for c in v]) for i, v in kept if len(v) == width]
    n, sums = len(x), [sum(v[d] for _, v in x) for d in range(width)]
    spread = [[sum((n * v[a] - sums[a]) * (n * v[b] - sums[b]) for _, v in x) / n**3 for b in range(width)] for a in range(width)]
    return x, n, sums, np.array(spread)


@pytest.mark.parametrize("low", [0, -(2**40)])
@pytest.mark.parametrize("rows", [1, 63, 64, 1000])
def test_bit_planes_give_the_exact_products(low, rows):
    rng = np.random.default_rng(rows)
    block = np.column_stack([rng.integers(low, low + 2**k, rows) for k in (0, 1, 5, 20, 41)])
    sums, products = whitening.scatter(block)
    plain = block.astype(object)
    assert sums.tolist() == plain.sum(axis=0).tolist() and products.tolist() == plain.T.dot(plain).tolist()


def test_whitened_vectors(spark):
    rng = np.random.default_rng(2)
    turn = rng.normal(size=(12, 12)) * np.geomspace(3, 0.1, 12)
    rows = [(i, (rng.normal(size=12) @ turn).tolist()) for i in range(400)]
    rows += [(400, None), (401, []), (402, [1.0, None] * 6), (403, [math.nan] * 12), (404, [math.inf] + [0.0] * 11), (405, [1.0] * 11)]
    rows += [(None, rows[3][1]), (7, rows[7][1]), (7, rows[8][1]), (406, [0.0] * 12), (407, [-200.0] + [0.0] * 11), (407, [5e6] + [0.0] * 11)]
    x, n, sums, spread = expected(rows, 8)
    values, vectors = np.linalg.eigh(spread)
    found = whitening.whitened(frame(spark, rows), Settings(rows_in_block=100)).collect()
    assert len(found) == 8 * len(x) and {r.n for r in found} == {n}
    deviations = Counter((i, min(2**63 - 1, sum((n * c - s) ** 2 for c, s in zip(v, sums)))) for i, v in x)
    assert Counter((r.vec_key, r.deviation) for r in found if r.component == 1) == deviations
    own = {}
    for r in found:
        own.setdefault((r.component), []).append(r)
    for k, of in own.items():
        e, direction = values[-k], vectors[:, -k]
        assert all(abs(r.explained / (e / np.trace(spread)) - 1) < 1e-9 for r in of)
        plain = sorted(float(np.dot([(n * c - s) / n for c, s in zip(v, sums)], direction)) / math.sqrt(e) for _, v in x)
        got = sorted(r.whitened for r in of)
        assert np.allclose(got, plain, atol=1e-6) or np.allclose(got, [-p for p in reversed(plain)], atol=1e-6)
    assert 0 <= found[0].identity_error < 1e-4 and len({r.identity_error for r in found}) == 1


def test_directions_without_spread_and_few_dimensions(spark):
    found = whitening.whitened(frame(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0]), (3, [5.0, 2.0])])).collect()
    assert {(r.component, r.explained) for r in found} == {(1, 1.0), (2, 0.0)}
    assert [r.whitened for r in found if r.component == 2] == [0.0] * 3 and found[0].identity_error < 1e-9
    alone = whitening.whitened(frame(spark, [(1, [0.5, 0.5, 0.5])])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in alone] == [(k, 1, 0, 0.0, 0.0, 0.0) for k in (1, 2, 3)]


def test_no_vectors(spark):
    assert whitening.whitened(frame(spark, [])).collect() == []
    assert whitening.whitened(frame(spark, [(1, None), (2, [math.nan])])).collect() == []
