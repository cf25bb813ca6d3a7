"""Nearest neighbours: recall against brute force, exact scores, copies and odd vectors."""

import numpy as np
import pytest

from tillwork.llm import nndescent as nn
from tillwork.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, score string, node int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA)


def brute(rows, every, top=10):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v):
            good[i] = np.array(v, np.float32).astype(float)
    width = max(map(len, good.values()), default=0)
    ids = np.array(sorted(good))
    m = np.array([np.pad(good[i], (0, width - len(good[i]))) for i in ids])
    out = {}
    for at, q in enumerate(ids):
        if q % every == 0:
            d = np.sqrt(((m - m[at]) ** 2).sum(axis=1))
            order = [k for k in np.lexsort((ids, d)) if k != at][:top]
            out[q] = [(int(ids[k]), float(d[k])) for k in order]
    return out


def by_query(got):
    out = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r.rank
    return out


def recall(got, want):
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    return hits / sum(map(len, want.values()))


@pytest.mark.parametrize("sf", ["0.001", "0.1"])
def test_query(spark, sf):
    sf = f"/root/testdata/sf{sf}"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got, want = by_query(QUERIES["op4_nearest_neighbours"](spark, sf).collect()), brute(rows, 100)
    assert got.keys() == want.keys() and all(len(got[q]) == 10 for q in got)
    assert recall(got, want) >= 0.95
    vectors = {i: np.array(v, float) for i, v in rows}
    for q, found in got.items():
        assert all(abs(d - np.linalg.norm(vectors[q] - vectors[i])) < 1e-12 for i, d in found)
        assert found == sorted(found, key=lambda x: (x[1], x[0])) and q not in dict(found)


def test_copies_and_ties(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=12).tolist()) for i in range(600)]
    rows += [(i, rows[20][1]) for i in range(600, 900)]
    want = brute(rows, 20)
    got = by_query(nn.nearest_neighbours(frame(spark, rows), 20).collect())
    assert recall(got, want) >= 0.95 and got[20] == want[20] and got[660] == want[660]


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (5, [0.0, 0.0]), (100, [1.0, 2.0]), (None, [1.0, 1.0]), (6, [1.0]), (7, []), (8, [-1.0, 2.0]), (200, [0.0, 0.0])]
    got = by_query(nn.nearest_neighbours(frame(spark, [*rows, rows[0]]), 100).collect())
    assert got == brute(rows, 100) and got.keys() == {0, 100}
    assert nn.nearest_neighbours(frame(spark, []), 100).collect() == []
    assert nn.nearest_neighbours(frame(spark, [(0, [1.0])]), 100).collect() == []
