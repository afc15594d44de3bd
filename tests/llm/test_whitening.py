"""Embedding whitening by polarisation covariance."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import types as T

from bitlake.llm import whitening

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("x", T.StringType()), T.StructField("n", T.StringType()), T.StructField("a.b", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "n", "ab") for i, v in rows], SCHEMA).repartition(3)


def vectors(seed, n, d, wide=1.0):
    rng = random.Random(seed)
    return [[rng.gauss(0.3 * k, wide * (1 + 3 * (k == 1) + 2 * (k == 2))) for k in range(d)] for _ in range(n)]


def whole(v):
    return tuple(math.floor(256 * float(np.float32(c))) for c in v)


def plain(rows, k=4):
    """The contract in exact fractions, then eigh."""
    good = [(i, whole(v)) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({x for _, x in good})
    n, d = len(fit), len(fit[0])
    s = [sum(x[j] for x in fit) for j in range(d)]
    cov = np.array([[float(Fraction(sum((n * x[a] - s[a]) * (n * x[b] - s[b]) for x in fit), n ** 3))
                     for b in range(d)] for a in range(d)])
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    out = {}
    for i, x in good:
        y = [n * a - b for a, b in zip(x, s)]
        out.setdefault(i, []).append((n, sum(v * v for v in y), (np.array(y, float) / n) @ u / np.sqrt(e)))
    return out, e / np.trace(cov), n


@pytest.mark.parametrize("d", [2, 5, 17])
def test_against_exact_fractions(spark, d):
    rows = list(enumerate(vectors(d, 60, d)))
    rows += [(60, rows[0][1]), (60, rows[0][1]), (None, rows[3][1])]
    rows += [(70, None), (71, [None] * d), (72, [math.nan] + [0.0] * (d - 1)), (73, [math.inf] * d), (74, [-math.inf] * d)]
    want, explained, n = plain(rows)
    got = whitening.whiten(frame(spark, rows)).collect()
    k = min(4, d)
    assert len(got) == k * sum(len(v) for v in want.values()) and {r.n for r in got} == {n} == {60}
    by = {}
    for r in got:
        by.setdefault(r.vec_id, []).append(r)
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        assert r.identity_error < 1e-9
    assert set(by) == set(want)
    sign = [0] * k
    for i, rs in by.items():
        for r in rs:
            _, deviation, w = want[i][0]
            assert r.deviation == deviation
            c = r.component - 1
            sign[c] = sign[c] or (1 if r.whitened * w[c] > 0 else -1)
            assert r.whitened == pytest.approx(sign[c] * w[c], abs=1e-9)


def test_large_numbers_stay_exact(spark):
    """Sums of squares far beyond 64 bits, and an offset that swamps the spread."""
    rng = random.Random(8)
    for offset, spread in ((1e6, 1.0), (0.0, 1e9)):
        rows = [(i, [float(np.float32(offset + spread * rng.gauss(0, 1 + j))) for j in range(3)]) for i in range(40)]
        want, explained, _ = plain(rows)
        for r in whitening.whiten(frame(spark, rows)).collect():
            deviation = want[r.vec_id][0][1]
            assert r.deviation == (deviation if deviation < 1 << 63 else None)
            assert abs(r.whitened) == pytest.approx(abs(want[r.vec_id][0][2][r.component - 1]), abs=1e-8)
            assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)


def test_square_sums_by_limbs():
    rng = np.random.default_rng(3)
    for bits in (5, 23, 24, 25, 48, 60):
        v = rng.integers(-(1 << bits), 1 << bits, (500, 3))
        assert whitening.square_sums(v, (1 << bits) + 1) == [sum(int(a) ** 2 for a in c) for c in v.T]
    assert [sum(d << 40 * k for k, d in enumerate(whitening._digits(v))) for v in (0, -5, 1 << 200)] == [0, -5, 1 << 200]


def test_without_variance_and_other_lengths(spark):
    same = [(i, [0.5, 1.5, -2.0]) for i in range(4)]
    got = whitening.whiten(frame(spark, same)).collect()
    assert len(got) == 12 and all(r.whitened is None and r.explained is None and r.deviation == 0 and r.n == 1 for r in got)
    line = [(i, [float(i), 1.0, 2.0]) for i in range(5)] + [(9, [1.0]), (10, [1.0, 2.0]), (11, [])]
    got = whitening.whiten(frame(spark, line)).collect()
    assert {r.vec_id for r in got} == set(range(5)) and {r.n for r in got} == {5}
    assert all((r.whitened is None) == (r.component > 1) and r.identity_error < 1e-9 for r in got)
    assert {r.explained for r in got if r.component == 1} == {1.0} and all(r.explained == 0 for r in got if r.component > 1)


def test_long_vectors_and_empty(spark):
    rows = list(enumerate(vectors(2, 12, 150)))
    got = whitening.whiten(frame(spark, rows)).collect()
    assert len(got) == 48 and all(r.identity_error < 1e-9 for r in got)
    for rows in ([], [(1, None), (2, [math.nan])], [(1, [])]):
        out = whitening.whiten(frame(spark, rows))
        assert out.count() == 0
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
