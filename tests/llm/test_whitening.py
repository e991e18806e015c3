import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import whitening
from basketry.llm.queries import QUERIES


def table(spark, rows):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    for c in ("id", "x", "v", "slot", "value", "component", "n", "whitened"):
        df = df.withColumn(c, F.lit("clash"))
    return df


def plain(rows, components):
    """Brute force: eigenvectors of the covariance of the integer rows."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in good], np.int64)
    n, s = len(x), x.sum(axis=0)
    y = (n * x - s) / n
    e, vectors = np.linalg.eigh(y.T @ y / n)
    e, vectors = e[::-1][:components], vectors[:, ::-1][:, :components]
    deviation = [sum(int(d) ** 2 for d in r) for r in (n * x - s)]
    return [i for i, _ in good], n, deviation, e, y @ vectors / np.sqrt(e), e / np.trace(y.T @ y / n)


def compare(df, rows, components=32):
    got = whitening.whiten(df, components).collect()
    ids, n, deviation, e, z, share = plain(rows, components)
    assert sorted((r.id, r.component) for r in got) == sorted((i, c + 1) for i in ids for c in range(len(e)))
    at = {i: k for k, i in enumerate(ids)}
    found = np.zeros((len(ids), len(e)))
    for r in got:
        assert (r.n, r.deviation) == (n, deviation[at[r.id]])
        assert r.explained == pytest.approx(share[r.component - 1], rel=1e-9)
        assert r.identity_error < 1e-9
        found[at[r.id], r.component - 1] = r.whitened
    sign = np.sign((found * z).sum(axis=0))
    assert np.abs(found * sign - z).max() < 1e-6
    return got


def test_against_eigenvectors_of_the_covariance(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((300, 40)) * np.linspace(3, 0.2, 40) + rng.standard_normal(40)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    assert len(compare(table(spark, rows).repartition(5), rows)) == 300 * 32


def test_rows_that_take_no_part_and_repeated_ones(spark):
    rng = np.random.default_rng(4)
    x = (rng.standard_normal((60, 5)) * [4, 3, 2, 1, 0.5]).tolist()
    rows = [(i, v) for i, v in enumerate(x)]
    rows += [(100 + i, [9.0, 9.0, 9.0, 9.0, 9.0]) for i in range(200)]  # one frequent vector
    odd = [(500, None), (501, []), (502, [1.0, None, 1.0, 1.0, 1.0]), (503, [1.0, float("nan"), 1.0, 1.0, 1.0]),
           (504, [1.0, float("-inf"), 1.0, 1.0, 1.0]), (505, [1e30, 0.0, 0.0, 0.0, 0.0])]
    compare(table(spark, rows + odd), rows)
    got = whitening.whiten(table(spark, [*rows, (506, [1.0, 2.0]), (None, x[0]), (0, x[0])])).collect()
    assert {r.id for r in got} == {i for i, _ in rows} | {None}  # another length goes, null and repeated ids stay
    assert len(got) == 5 * (len(rows) + 2)
    assert len({r.whitened for r in got if r.id in (None, 0) and r.component == 1}) == 1


def test_fewer_directions_than_asked_for(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((50, 3)) @ rng.integers(-3, 4, (3, 8))
    x = np.round(x * 64) / 64
    x[:, 5] = 7.0  # constant
    got = whitening.whiten(table(spark, [(i, v.tolist()) for i, v in enumerate(x)]), 32).collect()
    rank = np.linalg.matrix_rank(x - x.mean(axis=0), tol=1e-8)
    assert {r.component for r in got} == set(range(1, rank + 1))
    assert got[0].identity_error < 1e-4


def test_equal_eigenvalues(spark):
    rows = [(2 * k + (s > 0), [s * (8.0 if j == k else 0.0) for j in range(6)]) for k in range(6) for s in (-1, 1)]
    got = whitening.whiten(table(spark, rows)).collect()
    assert len(got) == 12 * 6 and got[0].identity_error < 1e-9
    assert {round(r.explained, 9) for r in got} == {round(1 / 6, 9)}


def test_nothing_to_whiten(spark):
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [(1, None), (2, [])])).collect() == []
    assert whitening.whiten(table(spark, [(i, [1.0, 2.0]) for i in range(9)])).collect() == []  # all equal
    assert whitening.whiten(table(spark, [(1, [3.0])])).collect() == []


def test_exact_beyond_doubles_and_64_bits():
    x = np.array([[1 << 40, -5], [3, 1 << 40]], np.int64)
    n, sums = 1 << 30, [7, -9]
    d = whitening.exact_deviation(x, n, sums)
    assert d.tolist() == [[(1 << 70) - 7, -5 * n + 9], [3 * n - 7, (1 << 70) + 9]]
    assert whitening.squared_length(d) == [None, None]
    d = whitening.exact_deviation(np.array([[3, 1 << 26]], np.int64), 5, [1, 2])
    assert whitening.squared_length(d) == [14 ** 2 + (5 * (1 << 26) - 2) ** 2]


def test_recurrence_stops_before_all_directions_are_used():
    rng = np.random.default_rng(6)
    a = rng.standard_normal((400, 300)) * 0.5 ** np.arange(300)
    a[:, 1] *= 2  # close to the first
    a -= a.mean(axis=0)
    product = lambda w, c: (a.T @ (a @ w), (a @ c).T @ (a @ w), float((a @ w) @ (a @ w)))
    v, b, steps = whitening.bidiagonalise(product, 300, 8)
    assert steps < 200
    assert np.abs(v.T @ v - np.eye(v.shape[1])).max() < 1e-12
    assert np.allclose(np.linalg.svd(b)[1][:8], np.linalg.svd(a)[1][:8], rtol=1e-12)


def test_query_on_whole_table(spark, sf_small):
    rows = [(r.vec_id, [float(c) for c in r.embedding])
            for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()]
    got = QUERIES["op11_whitening"](spark, sf_small)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    compare(spark.read.parquet(f"{sf_small}/embeddings.parquet"), rows)
    assert got.count() == len(rows) * 32
