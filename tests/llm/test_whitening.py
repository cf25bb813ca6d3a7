"""Whitening: eigenvectors against numpy's, the query against plain numpy, edges."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwork.llm import whitening as w
from tillwork.llm.queries import QUERIES


def spread(values, seed=0):
    """A symmetric matrix of the given eigenvalues."""
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return (q * np.array(values)) @ q.T


MATRICES = [
    *[spread(np.random.default_rng(n).random(n) * 10, n) for n in (1, 2, 3, 4, 7, 64, 150)],
    np.eye(6),
    np.diag([3.0, 3, 3, 1, 0]),
    np.ones((5, 5)),
    np.diag([1, 1 + 1e-12, 1 + 2e-12, 0.5]),
    np.kron(np.eye(3), [[2, 1], [1, 2]]),
    spread([5, 5, 5 - 1e-9, 5 - 2e-9, 1, 0.1, 0], 3),
    spread([1e6, 1e-3, 1e-6, 1e-7, 0], 4) / 7,
    spread([1e-280] * 3 + [1e-281] * 4, 5),
    np.zeros((3, 3)),
]


@pytest.mark.parametrize("i", range(len(MATRICES)))
def test_eigenvectors(i):
    a = (MATRICES[i] + MATRICES[i].T) / 2
    values, vectors = w.leading_eigen(a, 4)
    scale = max(np.abs(a).max(), 1e-300)
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1][: len(values)]).max() < 1e-13 * scale * len(a)
    assert np.abs(a @ vectors - vectors * values).max() < 1e-13 * scale * len(a)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-11


@pytest.mark.parametrize("i", range(7))
def test_sturm_counts(i):
    a = (MATRICES[i] + MATRICES[i].T) / 2
    d, e, u = w.tridiagonal(a)
    points = np.linspace(-1, 11, 101)
    assert (w.sturm_count(d, e, points) == (np.linalg.eigvalsh(a)[:, None] < points).sum(axis=0)).all()
    back = np.diag(d) + np.diag(e, 1) + np.diag(e, -1)
    for column in u.T[::-1]:
        h = np.eye(len(a)) - 2 * np.outer(column, column)
        back = h @ back @ h
    assert np.abs(back - a).max() < 1e-12 * len(a)


def plain(rows, most=4):
    """(vec_id, x) of usable rows to {(vec_id, component): (n, deviation, |whitened|, explained)} in exact sums."""
    width = max((len(x) for _, x in rows), default=0)
    filled = [(i, [*x, *[0] * (width - len(x))]) for i, x in rows]
    fit = sorted({tuple(x) for _, x in filled})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    gap = np.array([[n * a - s for a, s in zip(x, sums, strict=True)] for x in fit], object)
    v = (gap.T @ gap / n**3).astype(float) if n else np.zeros((width, width))
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    out = []
    for i, x in filled:
        g = [n * a - s for a, s in zip(x, sums, strict=True)]
        for k in range(len(values)):
            if values[k] > 1e-12 * max(1e-300, np.trace(v)):
                z = abs(np.array([float(a) / n for a in g]) @ vectors[:, k]) / np.sqrt(values[k])
                out.append((i, k + 1, n, sum(a * a for a in g), z, values[k] / np.trace(v)))
    return sorted(out, key=lambda r: (str(r[0]), r[1:]))


def agree(got, want, sign=True):
    got = sorted(((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in got), key=lambda r: (str(r[0]), r[1:]))
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == [r[3] if r[3] < 1 << 63 else None for r in want]
    assert np.allclose([r[4:] for r in got], [r[4:] for r in want], rtol=1e-9, atol=1e-9)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    got = QUERIES["op12_embedding_whitening"](spark, sf).collect()
    agree(got, plain([(r.vec_id, [int(np.floor(256 * c)) for c in r.embedding]) for r in rows]))
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-12


def test_edges(spark, folder):
    """Nulls, ragged and repeated vectors, a large mean, clashing columns, missing ids."""
    nan, inf = float("nan"), float("inf")
    vectors = [
        [1e6 + 0.01, 2.0, -0.0], [1e6 + 0.02, 1.5, 0.25], [1e6, -2.0], [1e6, -2.0, 0.0], [1e6 - 0.5, 0.1, 3.0],
        [1e6, nan, 1.0], [inf, 1.0, 1.0], None, [1.0, None, 2.0], [1e6 + 0.02, 1.5, 0.25],
    ]
    ids = [1, 2, 3, 4, 5, 6, 7, 8, 9, None]
    df = spark.createDataFrame([(i, v, 5, "c") for i, v in zip(ids, vectors, strict=True)], "vec_id long, embedding array<double>, n int, x string")
    good = [(i, [int(np.floor(256 * c)) for c in v]) for i, v in zip(ids, vectors, strict=True) if v and all(c is not None and np.isfinite(c) for c in v)]
    got = QUERIES["op12_embedding_whitening"](spark, folder(embeddings=df)).collect()
    want = plain(good)
    assert {r.component for r in got} == {1, 2, 3}
    agree(got, want)
    assert w.whiten(df).columns == ["vec_id", "x", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for few in (df.limit(0), df.limit(1), df.where("embedding is null"), df.withColumn("embedding", F.slice("embedding", 5, 9))):
        assert w.whiten(few).collect() == []


def test_beyond_64_bits(spark):
    df = spark.createDataFrame([(i, [float(i * 10**14), float(i % 3)]) for i in range(50)], "vec_id long, embedding array<double>")
    got = w.whiten(df).collect()
    agree(got, plain([(i, [i * 10**14 * 256, i % 3 * 256]) for i in range(50)]))
    assert {r.deviation for r in got} == {None}
