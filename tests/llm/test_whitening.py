import math

import numpy as np
import pytest

from tidemark.llm.whitening import count_above, exact_products, leading_components, whiten

SCHEMA = "vec_id long, embedding array<float>, label int, component int, n long, x string"


def table(spark, vectors, ids=None):
    return spark.createDataFrame([(i, v, 0, 1, 2, "y") for i, v in zip(ids or range(len(vectors)), vectors, strict=True)], SCHEMA)


def symmetric(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values),) * 2))
    a = q @ np.diag(values) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("values", [[5, 3, 1, 0.5, 1e-3, -2], [1, 1, 1, 0], [0, 0, 0], [4], list(range(40))])
def test_pivots_count_eigenvalues(values):
    a = symmetric(values)
    for s in [-3, -1, 1e-6, 0.7, 2.2, 4.5, 100]:
        assert count_above(a, s) == sum(v > s for v in values)


def test_pivots_of_two_rows():
    a = np.array([[0.0, 1, 0], [1, 0, 0], [0, 0, 0]])
    assert count_above(a, 0) == 1 and count_above(np.kron(np.eye(3), a), 0) == 3
    for seed in range(30):
        a = np.random.default_rng(seed).integers(-2, 3, (9, 9)).astype(float)
        a = a + a.T
        assert count_above(a, 0.123) == (np.linalg.eigvalsh(a) > 0.123).sum()


@pytest.mark.parametrize("values", [
    [9, 8, 7, 6, 5, 4, 3, 2, 1], [1e6, 1e6 * (1 - 1e-9), 10, 9.999999, 1, 1e-1], [3, 3, 3, 2, 2, 1], [5, 5 - 1e-15, 1, 0, 0],
    [1e10, 1, 1e-1], [2.0] * 6, [1.0], [100 + i * 1e-6 for i in range(20)]])
def test_components_are_the_eigenvectors(values):
    a = symmetric(values, len(values))
    got, axes = leading_components(a, 8)
    want = sorted([v for v in values if v > 1e-12 * max(values)], reverse=True)[:8]
    assert len(got) == len(want) and np.allclose(got, want, rtol=1e-9, atol=1e-12 * max(values))
    assert np.abs(axes.T @ axes - np.eye(len(got))).max() < 1e-9
    assert np.linalg.norm(a @ axes - axes * got, axis=0).max() < 1e-11 * max(values)


def test_products_are_exact_for_entries_of_any_size():
    for top in (10, 1 << 22, 1 << 27, 1 << 40):
        z = np.random.default_rng(top % 97).integers(-top, top, (50, 3))
        want = [[sum(int(a) * int(b) for a, b in zip(z[:, i], z[:, j], strict=True)) for j in range(3)] for i in range(3)]
        assert exact_products(z).tolist() == want


def brute(vectors, k=8):
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors])
    n, s = len(x), x.sum(axis=0)
    d = n * x.astype(object) - s
    v = np.array((d.T @ d) / n ** 3, float)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return n, (d * d).sum(axis=1), ((d / n).astype(float) @ u) / np.sqrt(e), e / np.trace(v)


def test_whitening_of_a_table_with_odd_rows(spark):
    rng = np.random.default_rng(5)
    vectors = ((rng.standard_normal((300, 12)) * np.geomspace(5, 0.1, 12)) @ rng.standard_normal((12, 12)) + 40).tolist()
    odd = [None, [], [None] * 12, [1.0] * 11 + [float("nan")], [float("inf")] + [0.0] * 11]
    twice = vectors + vectors[:20]
    ids = [*range(300), *range(20), *range(900, 905)]
    ids[7] = None
    rows = whiten(table(spark, twice + odd, ids).repartition(5)).collect()
    n, deviation, want, explained = brute(twice)
    assert len(rows) == 8 * n and {r["n"] for r in rows} == {n} and len({r["identity_error"] for r in rows}) == 1
    assert rows[0]["identity_error"] < 1e-9 and sum(r["vec_id"] is None for r in rows) == 8
    got = {(r["vec_id"], r["component"]): r for r in rows}
    signs = [np.sign(got[0, c + 1]["whitened"] * want[0, c]) for c in range(8)]
    for i in (i for i in range(300) if i != 7):
        for c in range(8):
            r = got[i, c + 1]
            assert r["deviation"] == deviation[i] and math.isclose(r["explained"], explained[c], rel_tol=1e-9)
            assert abs(r["whitened"] - signs[c] * want[i, c]) < 1e-8


def test_small_and_degenerate_tables(spark):
    assert whiten(table(spark, [])).count() == 0
    assert whiten(table(spark, [None, []])).count() == 0
    assert whiten(table(spark, [[1.0, 2.0]])).count() == 0
    assert whiten(table(spark, [[1.0, 2.0]] * 5)).count() == 0
    rows = whiten(table(spark, [[1.0, 2.0], [2.0, 4.0], [3.0, 6.0]])).collect()  # rank one
    assert {r["component"] for r in rows} == {1} and rows[0]["identity_error"] < 1e-9 and abs(rows[0]["explained"] - 1) < 1e-12
    assert whiten(table(spark, [])).schema.simpleString() == whiten(table(spark, [[1.0, 2.0], [2.0, 1.0]])).schema.simpleString()
    with pytest.raises(ValueError):
        whiten(table(spark, [[1.0], [1.0, 2.0]]))


def test_large_entries_have_a_deviation_or_null(spark):
    rows = whiten(table(spark, [[1e9, 0.0], [-1e9, 1.0], [0.0, 5.0]], [1, 2, 3])).collect()
    n, deviation, _, _ = brute([[1e9, 0.0], [-1e9, 1.0], [0.0, 5.0]], 2)
    for r in rows:
        want = deviation[r["vec_id"] - 1]
        assert r["deviation"] == (want if want < 1 << 63 else None)
