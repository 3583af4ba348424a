"""Whitening against exact arithmetic and dense linear algebra, on nulls, repeats, ties and clashing columns."""

from fractions import Fraction

import numpy as np
import pytest

from spanloom.llm import whitening

ROWS = "vec_id long, embedding array<float>, component int, n string"


def frame(spark, vectors, ids=None):
    return spark.createDataFrame([(i, v, 7, "x") for i, v in zip(ids or range(len(vectors)), vectors, strict=True)], ROWS)


def expected(vectors, count):
    """Rows by doubles, from the same whole numbers."""
    x = np.floor(64 * np.array(vectors, np.float64)) + 1_000_000
    n, mean = len(x), x.mean(0)
    v = (x - mean).T @ (x - mean) / n
    e, u = np.linalg.eigh(v)
    order = np.argsort(-e)[:count]
    return x, (x - mean) @ u[:, order] / np.sqrt(e[order]), e[order] / np.trace(v)


def test_whitening_is_that_of_dense_algebra_and_drops_unusable_vectors(spark):
    rng = np.random.default_rng(5)
    good = (rng.normal(size=(60, 6)) * [3, 2, 1, 0.5, 0.2, 0.1]).astype(np.float32).tolist()
    good += good[:3]
    bad = [None, [None] * 6, [float("nan")] + [0.0] * 5, [0.0] * 5 + [float("inf")], [0.5] * 5 + [None], []]
    rows = whitening.whiten(frame(spark, [*good, *bad]).repartition(5), 4).collect()
    x, w, explained = expected(good, 4)
    assert len(rows) == 4 * len(good) and {r["n"] for r in rows} == {len(good)}
    sums = x.sum(0)
    for r in rows:
        k = r["component"] - 1
        assert r["deviation"] == int(((len(x) * x[r["vec_id"]] - sums) ** 2).sum())
        sign = np.sign(sum(q["whitened"] * w[q["vec_id"], k] for q in rows if q["component"] == k + 1))
        assert r["whitened"] == pytest.approx(sign * w[r["vec_id"], k], abs=1e-9)
        assert r["explained"] == pytest.approx(explained[k], rel=1e-9) and r["identity_error"] < 1e-9


def test_no_variance_no_rows_and_null_keys_stay(spark):
    assert whitening.whiten(frame(spark, [[1.0, 2.0]] * 5)).count() == 0
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [None, []])).count() == 0
    rows = whitening.whiten(frame(spark, [[1.0, 2.0], [1.0, 3.0], [1.0, 3.0]], [None, 4, 4])).collect()
    assert sorted((r["vec_id"] is None, r["component"]) for r in rows) == [(False, 1), (False, 1), (True, 1)]
    assert whitening.whiten(frame(spark, [[1.0, 2.0], [1.0, 3.0], [1.0, 3.0]])).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    with pytest.raises(Exception, match="different lengths"):
        whitening.whiten(frame(spark, [[1.0, 2.0], [1.0]]))


def test_sums_are_exact_beyond_doubles_and_longs(spark):
    vectors = [[3.0e12, 1.0], [-3.0e12, 5.0], [1.5e9, 0.015625]] * 3
    n, sums, products = whitening.moments(frame(spark, vectors).repartition(3))
    whole = [[int(np.floor(64 * np.float64(np.float32(c)))) for c in v] for v in vectors]
    assert n == 9 and sums.tolist() == [sum(c) for c in zip(*whole, strict=True)]
    assert products.tolist() == [[sum(v[i] * v[j] for v in whole) for j in range(2)] for i in range(2)]
    rows = whitening.whiten(frame(spark, vectors)).collect()
    exact = [sum((9 * v[i] - sums[i]) ** 2 for i in range(2)) for v in whole]
    assert all(r["deviation"] == (exact[r["vec_id"]] if exact[r["vec_id"]] < 2**63 else None) for r in rows)


def test_polynomial_is_exact(spark):
    rng = np.random.default_rng(2)
    a = rng.integers(-5, 6, (7, 4)).astype(object)
    m = a @ a.T  # of rank 4: three roots are 0
    m[0] = m[:, 0] = 0  # makes pivots vanish
    got = whitening.characteristic_polynomial(spark, m)
    c, b = [Fraction(1)], np.eye(7, dtype=int).astype(object) * Fraction(1)  # Faddeev-LeVerrier
    for k in range(1, 8):
        mb = m @ b
        c.append(-sum(mb[i, i] for i in range(7)) / k)
        b = mb + np.eye(7, dtype=int).astype(object) * c[-1]
    assert got == [int(v) for v in reversed(c)]
    roots, s = whitening.largest_roots(got, 7)
    assert [r / 2**s for r, _ in roots] == pytest.approx([e for e in np.linalg.eigvalsh(m.astype(float))[::-1] if e > 1e-9])


def test_equal_roots_have_orthogonal_components(spark):
    m = np.diag([4, 4, 9, 1, 4]).astype(object)
    m[0, 3] = m[3, 0] = 0
    axes, values = whitening.principal_components(spark, m, 4)
    assert [float(v) for v in values] == pytest.approx([9, 4, 4, 4])
    assert axes @ axes.T == pytest.approx(np.eye(4), abs=1e-12)
    assert np.abs(m.astype(float) @ axes.T - axes.T * [float(v) for v in values]).max() < 1e-12


def test_close_roots_keep_their_digits(spark):
    q, _ = np.linalg.qr(np.random.default_rng(3).normal(size=(12, 12)))
    m = np.rint(q @ np.diag([1e9 + 30, 1e9, *np.arange(10, 0, -1) * 1e6]) @ q.T)
    m = ((m + m.T) // 2).astype(object)
    axes, values = whitening.principal_components(spark, m, 2)
    for u, e in zip(axes, values, strict=True):
        exact = [Fraction(float(v)) for v in u]
        off = max(abs(float(sum(int(m[i, j]) * exact[j] for j in range(12)) - e * exact[i])) for i in range(12))
        assert off < 1e-6  # of 1e9: the last digits of a double
    assert abs(axes[0] @ axes[1]) < 1e-15
