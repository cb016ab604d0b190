"""Whitening against dense eigenvalues and exact sums."""

import math

import numpy as np
import pandas as pd
import pytest
from llm_fixtures import SF_DIR  # noqa: F401

from kilnwatt.llm import whitening
from kilnwatt.llm.queries import QUERIES


def plain(rows, k=32):
    """rows: (vec_id, vector), all valid and of one size."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    centred = np.array(x, dtype=np.longdouble) - np.array(sums, dtype=np.longdouble) / n
    cov = (centred.T @ centred / n).astype(float)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(k, int((values > 1e-9 * values[0]).sum()))
    white = centred.astype(float) @ vectors[:, :k] / np.sqrt(values[:k])
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    return n, deviation, white, values[:k] / np.trace(cov)


def test_query(spark):
    got = QUERIES["op13_whitening"](spark, SF_DIR).toPandas().sort_values(["vec_id", "component"])
    table = pd.read_parquet(f"{SF_DIR}/embeddings.parquet").sort_values("vec_id")
    rows = list(zip(table.vec_id, table.embedding, strict=True))
    n, deviation, white, explained = plain(rows)
    k = white.shape[1]
    assert len(got) == n * k and (got.n == n).all()
    assert (got.deviation.to_numpy().reshape(n, k)[:, 0] == deviation).all()
    mine = got.whitened.to_numpy().reshape(n, k)
    sign = np.sign((mine * white).sum(axis=0))
    assert np.abs(mine * sign - white).max() < 1e-7
    assert np.allclose(got.explained.to_numpy().reshape(n, k)[0], explained, rtol=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-10
    assert np.abs(mine.T @ mine / n - np.eye(k)).max() < 1e-9


def test_odd_vectors(spark):
    rng = np.random.default_rng(0)
    good = [(int(i // 2) if i else None, rng.standard_normal(5).tolist()) for i in range(40)]  # null and repeated ids
    good += [good[3], good[3]]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0, 4.0]), (103, [float("nan")] * 5), (104, [float("inf")] + [0.0] * 4), (105, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in good + bad], "vec_id long, embedding array<float>, label string")
    got = whitening.whitened(df.selectExpr("*", "1 as n", "2 as component", "3 as at"), 3).toPandas()
    want = {i: None for i, _ in good}
    assert len(got) == 3 * len(good) and set(got.n) == {len(good)}
    assert sorted({-1 if v != v or v is None else int(v) for v in got.vec_id.tolist()}) == sorted(-1 if i is None else i for i in want)
    n, deviation, white, explained = plain([(i, np.float32(v)) for i, v in good], 3)
    assert sorted(set(map(int, got.deviation))) == sorted(set(deviation))
    assert np.allclose(np.sort(np.abs(got.whitened)), np.sort(np.abs(white).ravel()), atol=1e-8)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, None)]])
def test_nothing_to_whiten(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert whitening.whitened(df).collect() == []


def test_wide_numbers_are_exact(spark):
    rows = [(i, [float(i * 2**40), float((i * i) % 7), 1e300 if i == 3 else 0.0]) for i in range(9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    size, n, total = whitening.sums(df)
    x = [[min(math.floor(min(64 * c, whitening.MOST)), 2**62) + 1_000_000 for c in v] for _, v in rows]
    assert (size, n, list(total)) == (3, 9, [sum(c) for c in zip(*x)])
    centre = np.array([t // n for t in total], dtype=np.int64)
    z = [[a - int(c) for a, c in zip(v, centre)] for v in x]
    assert whitening.products(df, 3, centre).tolist() == [[sum(v[i] * v[j] for v in z) for j in range(3)] for i in range(3)]


def test_inertia_counts():
    rng = np.random.default_rng(1)
    for d in (1, 2, 7, 40):
        for _ in range(20):
            s = rng.standard_normal((d, d))
            s = s + s.T
            values = np.linalg.eigvalsh(s)
            shift = float(rng.uniform(values[0] - 1, values[-1] + 1))
            assert whitening.above(s, shift) == (values > shift).sum()


def test_repeated_eigenvalues():
    turn = np.linalg.qr(np.random.default_rng(2).standard_normal((12, 12)))[0]
    matrix = turn @ np.diag([5.0] * 4 + [3, 2, 2] + [0] * 5) @ turn.T
    matrix = (matrix + matrix.T) / 2
    values, vectors = whitening.leading(matrix, 32)
    assert np.allclose(values, [5, 5, 5, 5, 3, 2, 2], rtol=1e-12)
    assert np.allclose(vectors.T @ vectors, np.eye(7), atol=1e-12) and np.allclose(matrix @ vectors, vectors * values, atol=1e-12)
    assert whitening.leading(np.zeros((3, 3)), 2)[1].shape == (3, 0)
