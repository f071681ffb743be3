"""Whitening against whole-number brute force, unbounded integers, awkward vectors."""

import math
from fractions import Fraction

import numpy as np
import pytest

from lexigrid.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, key string, x int"


def whiten(spark, rows, **more):
    df = spark.createDataFrame([(i, v, "k", 1) for i, v in rows], SCHEMA).repartition(3)
    return whitening.whiten(df, **more).collect()


def exact(vectors):
    """n, sums and covariances of distinct vectors of whole numbers, as fractions."""
    n = len(vectors)
    sums = [sum(c) for c in zip(*vectors, strict=True)]
    far = [[Fraction(a) - Fraction(s, n) for a, s in zip(v, sums, strict=True)] for v in vectors]
    d = len(sums)
    return n, sums, np.array([[float(sum(f[i] * f[j] for f in far) / n) for j in range(d)] for i in range(d)])


@pytest.mark.parametrize("seed, scale", [(1, 1.0), (2, 3e9)])
def test_coordinates_and_deviations(spark, seed, scale):
    rng = np.random.default_rng(seed)
    vectors = (rng.normal(size=(150, 6)) * [5, 4, 3, 2, 1, 0.5] + 40).astype(np.float32) * np.float32(scale)
    vectors = np.concatenate([vectors, vectors[:30]])  # repeated vectors count once
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    whole = [tuple(math.floor(256 * c) for c in v) for _, v in rows]
    n, sums, cov = exact(sorted(set(whole)))
    values, u = np.linalg.eigh(cov)
    got = whiten(spark, rows)
    assert len(got) == 4 * len(rows) and {r.n for r in got} == {n}
    for r in got:
        far = [n * a - s for a, s in zip(whole[r.key], sums, strict=True)]
        dev = sum(f * f for f in far)
        assert r.deviation == (dev if dev < 1 << 63 else None)
        z = np.array([float(Fraction(f, n)) for f in far]) @ u[:, -r.component] / math.sqrt(values[-r.component])
        assert abs(abs(z) - abs(r.whitened)) < 1e-6
        assert abs(r.explained - values[-r.component] / values.sum()) < 1e-9 and r.identity_error < 1e-9


def test_the_covariance_is_exact(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(-(1 << 40), 1 << 40, size=(40, 3)).tolist()
    model = whitening.fit(spark.createDataFrame([(v,) for v in x], "x array<long>"))
    assert np.array_equal(model.covariance, exact([tuple(v) for v in x])[2])


def test_vectors_that_cannot_be_used_are_dropped(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [0.0, 1.0]), (3, [-1.0, 0.5]), (4, [3e38, 0.0])]
    bad = [(5, None), (6, []), (7, [nan, 1.0]), (8, [1.0, None]), (9, [inf, 0.0]), (10, [1.0, 2.0, 3.0]), (11, [1.0])]
    got = whiten(spark, good[:4] + bad)
    assert sorted((r.key or 0, r.component) for r in got) == sorted((k, c) for k in (0, 1, 1, 3) for c in (1, 2))
    assert {r.n for r in got} == {3}
    assert {r.key for r in whiten(spark, good)} == {1, None, 3, 4}


def test_what_cannot_be_whitened_is_left_out(spark):
    assert whiten(spark, []) == [] == whiten(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    got = whiten(spark, [(i, [float(i), 2.0 * i, 7.0]) for i in range(20)])
    assert {r.component for r in got} == {1} and abs(got[0].explained - 1) < 1e-9
