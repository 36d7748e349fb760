import math
import random

import numpy as np
import pytest

from loadstar.llm import whitening
from loadstar.llm.whitening import Centre, op11_whitening, principal_axes, whitened

SCHEMA = "vec_id long, embedding array<float>, label int, packed string, n long, dim int, weight int, whitened string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "p", 1, 1, 1, "w") for i, v in rows], SCHEMA)


def hazards(length=5):
    rng = random.Random(2)
    base = [[rng.gauss(0, 1 + k) for k in range(length)] for _ in range(40)]
    rows = list(enumerate(base))
    rows += [(100 + k, base[0]) for k in range(30)]  # one vector in many rows
    rows += [(0, base[0]), (0, base[0]), (None, base[1])]
    rows += [(200, None), (201, [None] * length), (202, [math.nan] + base[0][1:]), (203, [math.inf] + base[0][1:]), (204, []), (205, base[0][:2])]
    rows += [(206, [300.0] * length), (207, [-40000.0] + base[3][1:]), (208, [1e-30] * length), (209, [-1e-30] * length)]
    return rows


def brute(rows, length, by_count=False):
    """Exact fit in Python integers, and eigenvectors of the resulting covariance."""
    kept = []
    for i, v in rows:
        if v and len(v) == length and all(e is not None and math.isfinite(e) for e in v):
            kept.append((i, tuple(math.floor(64 * float(np.float32(e))) + 1_000_000 for e in v)))
    fit = [x for _, x in kept] if by_count else sorted({x for _, x in kept})
    n = len(fit)
    sums = [sum(x[k] for x in fit) for k in range(length)]
    d = np.array([[(n * x[k] - sums[k]) / n for k in range(length)] for x in fit])
    values, vectors = np.linalg.eigh(d.T @ d / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for i, x in kept:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        centred = np.array([(n * a - s) / n for a, s in zip(x, sums, strict=True)])
        for k in range(min(16, length)):
            out.append((i, k + 1, n, deviation, abs(centred @ vectors[:, k]) / math.sqrt(values[k]), values[k] / values.sum()))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[3]))


@pytest.mark.parametrize("by_count", [False, True])
def test_every_awkward_case(spark, by_count):
    rows = hazards()
    got = whitened(frame(spark, rows).repartition(4), by_count=by_count).collect()
    got.sort(key=lambda r: (r.vec_id is None, r.vec_id or 0, r.component, r.deviation))
    expected = brute(rows, 5, by_count)
    assert [(r.vec_id, r.component, r.n, r.deviation) for r in got] == [e[:4] for e in expected]
    np.testing.assert_allclose([abs(r.whitened) for r in got], [e[4] for e in expected], rtol=1e-8, atol=1e-9)
    np.testing.assert_allclose([r.explained for r in got], [e[5] for e in expected], rtol=1e-9, atol=1e-15)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_the_whole_table(spark, sf_dir):
    source = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    got = sorted(op11_whitening(spark, sf_dir).collect(), key=lambda r: (r.vec_id, r.component))
    expected = brute([tuple(r) for r in source], 64)
    assert [(r.vec_id, r.component, r.n, r.deviation) for r in got] == [e[:4] for e in expected]
    np.testing.assert_allclose([abs(r.whitened) for r in got], [e[4] for e in expected], rtol=1e-6, atol=1e-9)
    assert got[0].identity_error < 1e-9


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, rows):
    assert whitened(frame(spark, rows)).collect() == []


def test_components_without_variance_are_left_out(spark):
    rows = [(i, [float(i), 2.0 * i, 1.0]) for i in range(9)]
    assert {r.component for r in whitened(frame(spark, rows)).collect()} == {1}


def test_deviations_beyond_64_bits():
    huge = Centre(3, [3 << 50, 0])
    x = np.array([[1 << 50, 0], [0, 1]])
    assert whitening._deviations(x, huge) == [0, None]
    small = Centre(3, [7, -5])
    assert whitening._deviations(np.array([[2, -4]]), small) == [(3 * 2 - 7) ** 2 + (3 * -4 + 5) ** 2]


def test_axes_of_a_known_matrix():
    values, vectors = principal_axes(np.array([[2.0, 0.0], [0.0, 5.0]]), 16)
    assert values.tolist() == [5.0, 2.0] and np.allclose(np.abs(vectors), [[0, 1], [1, 0]])
