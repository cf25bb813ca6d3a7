"""Exact top-k: bounds hold, every result is the brute-force one."""

import random

import numpy as np
import pytest

from tillwork.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA)


def brute(rows, every, top):
    good = {i: np.floor(64 * np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()}
    out = []
    for q in sorted(i for i in good if i % every == 0):
        def dot(i):
            n = min(len(good[q]), len(good[i]))
            return int(good[q][:n] @ good[i][:n])
        best = sorted(((-dot(i), i) for i in good if i != q))[:top]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return out


def test_query(same):
    assert same("op5_exact_top_k") == []


@pytest.mark.parametrize("block", [3, 64])
def test_clusters_ties_and_copies(spark, block):
    rng = random.Random(block)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    rows = [(i, [c + rng.gauss(0, 0.05) for c in rng.choice(centres)]) for i in range(400)]
    rows += [(i, rows[7][1]) for i in range(400, 460)] + [(i, [0.0] * 8) for i in range(460, 470)]
    got = topk.exact_top(frame(spark, rows), 10, top=5, block=block).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == brute(rows, 10, 5)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, [0.5, -1.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (None, [1.0, 1.0]), (5, [1.0, 1.0]), (6, [1.0]), (-20, [3e9, 3e9]), (7, [])]
    got = topk.exact_top(frame(spark, rows), 20).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == brute(rows, 20, 20) and len(got) == 15
    again = topk.exact_top(frame(spark, [*rows, rows[0], rows[7]]), 20).orderBy("query_id", "rank").collect()
    assert again == got
    assert topk.exact_top(frame(spark, []), 20).collect() == []
    assert topk.exact_top(frame(spark, [(0, [1.0])]), 20).collect() == []


def test_bounds_hold():
    rng = np.random.default_rng(1)
    q, block = rng.integers(-90, 90, (30, 16)), rng.integers(-90, 90, (50, 16))
    of = topk.bounds(q, block.max(axis=0)[None], block.min(axis=0)[None])[:, 0]
    assert (of >= (q @ block.T).max(axis=1)).all()
