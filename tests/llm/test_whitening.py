import math

import numpy as np
import pytest

from tallyline.llm import whitening
from tallyline.llm.queries import QUERIES


@pytest.mark.parametrize("n", [1, 2, 3, 7, 40])
def test_divide_and_conquer_finds_all_components(n):
    rng = np.random.default_rng(n)
    a = rng.normal(size=(n, n))
    a = a @ a.T
    values, vectors = whitening.eigen(a)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1], rtol=0, atol=1e-11)
    assert np.abs(vectors.T @ vectors - np.eye(n)).max() < 1e-13
    assert np.abs(a @ vectors - vectors * values).max() < 1e-11


@pytest.mark.parametrize("a", [np.eye(6), np.zeros((4, 4)), np.diag([1.0, 1, 1, 2, 2, 3]), np.ones((6, 6)), np.diag([1e6, 1, 1e-6, 0, 0])])
def test_repeated_and_vanishing_eigenvalues(a):
    values, vectors = whitening.eigen(a)
    assert np.abs(vectors.T @ vectors - np.eye(len(a))).max() < 1e-13
    assert np.abs(a @ vectors - vectors * values).max() <= 1e-14 * max(np.abs(a).max(), 1)


def test_polar_factor_is_the_sign():
    rng = np.random.default_rng(5)
    q, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    values = np.array([3, 1, 1e-3, 1e-6, 2, 5, -1, -4, -1e-5, -2, -2, -0.1])
    assert np.abs(whitening.polar(q * values @ q.T) - q * np.sign(values) @ q.T).max() < 1e-9


def plain(vectors):
    """(integers, deviation, whitened, explained) by numpy's own eigenvectors."""
    x = np.floor(np.asarray(vectors, float) * 64).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(0)
    scaled = n * x - sums
    y = scaled / n
    v = y.T @ y / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    return (scaled.astype(object) ** 2).sum(1), y @ q / np.sqrt(e), e / e.sum()


def some_vectors(n=300, d=10):
    rng = np.random.default_rng(7)
    return (rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) + rng.normal(size=d) * 3).astype(np.float32)


def test_query_equals_plain_whitening(spark, tmp_path):
    vectors = some_vectors(400, 40)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    odd = [(900, None), (901, [math.nan] * 40), (902, [math.inf] + [0.0] * 39), (903, [None] * 40), (904, []), (905, [1.0] * 39)]
    spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").repartition(4).write.parquet(f"{tmp_path}/embeddings.parquet")
    df = QUERIES["op12_whitening"](spark, str(tmp_path))
    assert dict(df.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
                               "explained": "double", "identity_error": "double"}
    got = sorted((r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in df.collect())
    deviation, whitened, explained = plain(vectors)
    assert [(r[0], r[1]) for r in got] == [(i, k) for i in range(400) for k in range(1, 33)]
    assert {r[2] for r in got} == {400} and [r[3] for r in got[::32]] == deviation.tolist()
    mine = np.array([r[4] for r in got]).reshape(400, 32)
    sign = np.sign((mine * whitened[:, :32]).sum(0))
    assert np.abs(mine * sign - whitened[:, :32]).max() < 1e-9
    assert np.allclose([r[5] for r in got[:32]], explained[:32], rtol=1e-9)
    errors = {r[6] for r in got}
    assert len(errors) == 1 and errors.pop() < 1e-12


def test_odd_tables(spark):
    def of(rows):
        df = spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "row long, v array<double>, whitened string, n double")
        return whitening.components(df, whitening.fit(df, "v"), "v").collect()
    assert of([]) == [] and of([(1, None)]) == [] and of([(1, [])]) == []
    alone = of([(1, [0.5, 0.25])])
    assert [(r["row"].row, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in alone] == [
        (1, 1, 1, 0, None, None, None), (1, 2, 1, 0, None, None, None)]
    line = sorted(of([(k, [float(k), 2.0 * k]) for k in (0, 1, 2, 2)]), key=lambda r: (r["row"].row, r.component))
    assert all((r.whitened is None) == (r.component == 2) for r in line) and line[0].identity_error < 1e-12
    assert line[4].whitened == line[5].whitened  # a repeated row
    assert len(of([(k, [1e300, 1.0]) for k in range(3)])) == 0
    big = of([(k, [float(k * 2**40), 0.0]) for k in range(3)])
    assert [r.deviation for r in big if r["row"].row == 0 and r.component == 1] == [None]  # longer than a long holds


def test_huge_entries_are_summed_exactly(spark):
    base = 2.0**44
    rows = [(k, [base + v[0], v[1] - base]) for k, v in enumerate(some_vectors(200, 2).astype(float).round(3).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>").repartition(3)
    model = whitening.fit(df, "v")
    deviation, whitened, _ = plain([v for _, v in rows])
    got = sorted((r["row"].vec_id, r.deviation) for r in whitening.whiten(df, model, "v").collect())
    assert [d for _, d in got] == [int(d) if d < 1 << 63 else None for d in deviation]
    assert whitening.identity_error(df, model, "v") < 1e-9
