"""Whitening against a dense eigen solver and plain integers."""

import numpy as np
import pytest

from millrace.llm import whitening

SCHEMA = "vec_id bigint, embedding array<double>, label int, n int, `a.b` string"


def rows_of(vectors, first=0):
    return [(first + i, v, 1, 0, "x") for i, v in enumerate(vectors)]


def expected(vectors, components=8):
    x = [[int(np.floor(1024 * c)) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    y = np.array(x, dtype=float) - np.array(sums) / n
    v = y.T @ y / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return n, deviations, y @ vectors / np.sqrt(values), values / np.trace(v)


def found(frame):
    out = {}
    for r in whitening.query(frame).collect():
        out.setdefault(r["vec_id"], {})[r["component"]] = r
    return out


def test_whitened_vectors(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(300, 12)) * np.linspace(1, 4, 12)).tolist()
    odd = [None, [None, *vectors[0][1:]], [float("nan")] * 12, [float("inf"), *vectors[0][1:]], []]
    got = found(spark.createDataFrame(rows_of(vectors) + rows_of(odd, 1000), SCHEMA).repartition(5))
    n, deviations, whitened, shares = expected(vectors)
    assert sorted(got) == list(range(300))
    mine = np.array([[got[i][k + 1]["whitened"] for k in range(8)] for i in range(300)])
    sign = np.sign((mine * whitened).sum(axis=0))
    assert np.abs(mine * sign - whitened).max() < 1e-9
    for i in range(300):
        for k in range(8):
            r = got[i][k + 1]
            assert r["n"] == n and r["deviation"] == deviations[i] == int(r["deviation_wide"])
            assert abs(r["explained"] / shares[k] - 1) < 1e-9 and r["identity_error"] < 1e-9


def test_repeated_ids_and_other_lengths(spark):
    rng = np.random.default_rng(5)
    long, short = rng.normal(size=(40, 6)).tolist(), rng.normal(size=(30, 3)).tolist()
    rows = [(None, v, 1, 0, "x") for v in long] + [(7, v, 1, 0, "x") for v in short]
    got = whitening.query(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted({(r["vec_id"], r["n"]) for r in got}, key=str) == [(7, 30), (None, 40)]
    assert len(got) == 40 * 6 + 30 * 3
    for vec_id, vectors in ((None, long), (7, short)):
        assert sorted(r["deviation"] for r in got if r["vec_id"] == vec_id and r["component"] == 1) == sorted(expected(vectors)[1])


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 5])
def test_without_variance(spark, vectors):
    assert whitening.query(spark.createDataFrame(rows_of(vectors), SCHEMA)).count() == 0


def test_low_rank_and_wide_entries(spark):
    line = [[float(i), 2.0 * i, -float(i)] for i in range(20)]
    got = whitening.query(spark.createDataFrame(rows_of(line), SCHEMA)).collect()
    assert {r["component"] for r in got} == {1} and all(abs(r["explained"] - 1) < 1e-9 for r in got)
    wide = [[1e15 * i, 1.0] for i in range(4)] + [[1e300, 2.0]]
    got = {r["vec_id"]: r for r in whitening.query(spark.createDataFrame(rows_of(wide), SCHEMA)).collect()}
    x = [min(int(v[0]) * 1024 + 100_000, 2**63 - 1) for v in wide]
    y = [1024 + 100_000] * 4 + [2048 + 100_000]
    deviations = [(5 * a - sum(x)) ** 2 + (5 * b - sum(y)) ** 2 for a, b in zip(x, y)]
    assert [got[i]["deviation_wide"] for i in range(5)] == [d if d < 10**38 else None for d in deviations]
    assert all(got[i]["deviation"] is None for i in range(5))


def test_eigen_pairs():
    rng = np.random.default_rng(0)
    for trial in range(60):
        n = int(rng.choice([1, 2, 3, 9, 20]))
        if trial % 3 == 0:
            q, _ = np.linalg.qr(rng.normal(size=(n, n)))
            v = q @ np.diag(rng.choice([1.0, 1.0, 2.0, 5.0, 0.0], n)) @ q.T
        else:
            a = rng.normal(size=(n, int(rng.integers(1, 2 * n + 1)))) * 10.0 ** rng.uniform(-2, 2)
            v = a @ a.T
        known = np.linalg.eigvalsh((v + v.T) / 2)[::-1]
        values, vectors = whitening.top_pairs(v, 8)
        assert len(values) == min(8, int((known > np.abs(v).sum(axis=1).max() * 1e-11).sum()))
        assert np.allclose(values, known[: len(values)], rtol=1e-9, atol=1e-12)
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max(initial=0) < 1e-12
        assert np.abs(v @ vectors - vectors * values).max(initial=0) <= 1e-11 * max(known[0], 1e-300)


def test_inertia():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 40):
        a = rng.normal(size=(n, n))
        v = a + a.T
        for shift in rng.normal(size=10):
            assert whitening.count_above(*whitening.tridiagonal(v), shift) == (np.linalg.eigvalsh(v) > shift).sum()
