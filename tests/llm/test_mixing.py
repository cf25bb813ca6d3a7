"""Mixing: targets, permutation, what each document gives, against plain Python."""

import math
import random
from collections import Counter

import pytest
import xxhash

from tillwork.llm import mixing
from tillwork.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, target string, rank int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, None, s, None, 1, "x", 2) for i, t, s in rows], DOCS)


def reshared(sizes: dict, weights=(5, 2, 1), most=3) -> dict:
    """Targets by handing the excess round and round."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        free = sum(w[s] for s in order if s not in full)
        got = {s: most * sizes[s] if s in full else w[s] * rest / free for s in order}
        over = {s for s in order if s not in full and got[s] > most * sizes[s]}
        if not over:
            return got
        full |= over


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 1, 10, 500, 9000]) for s in ["b", "a", "ä", "", "z", "Z", None, "src10", "src2"]}
    rows = [(i, "w " * n, s) for i, (s, n) in enumerate(sizes.items())]
    got = mixing.source_targets(mixing.document_sizes(docs(spark, rows))).collect()
    want = reshared(sizes)
    assert {r.source: r.target for r in got} == pytest.approx(want)
    assert {r.source: r.source_size for r in got} == sizes


@pytest.mark.parametrize("n", [1, 2, 7, 64, 1000])
def test_permutation(spark, n):
    from pyspark.sql import functions as F

    image = mixing.permuted(F.col("id"), F.lit(n).cast("long"), [F.lit(3), F.lit(9)])
    got = {r.id: r.image for r in spark.range(n).withColumn("image", image).collect()}
    assert sorted(got.values()) == list(range(n))

    def chained(*values):
        seed = 42
        for v, width in values:
            seed = xxhash.xxh64_intdigest(v.to_bytes(width, "little", signed=True), seed)
        return seed - (1 << 64) if seed >> 63 else seed

    for was, image in got.items():
        x = was
        for r in range(mixing.ROUNDS):
            mirror = (chained((3, 4), (9, 4), (r, 4)) - x) % n
            if chained((max(x, mirror), 8), (3, 4), (9, 4), (r, 4)) & 1:
                x = mirror
        assert x == image


def test_taken_is_what_the_slots_take(spark):
    rng = random.Random(5)
    rows = [(i, "w " * rng.choice([0, 1, 5, 63, 64, 200, 3000]), rng.choice(["a", "b", "c", "d", None])) for i in range(300)]
    rows += [(7, "w w", "a"), (7, "w w", "a"), (None, "w " * 70, "b"), (500, None, "c")]
    df = docs(spark, rows)
    how = {"block_words": 16, "shard_slots": 700}
    sizes = mixing.document_sizes(df)
    targets = mixing.source_targets(sizes)
    slots = mixing.mix_slots(targets, **how).collect()
    per_shard = Counter(r.shard for r in slots)
    total = sum(len((t or "").split()) for _, t, _ in rows)
    assert sum(per_shard.values()) == math.ceil(total / 16) and set(per_shard.values()) - {700} == {math.ceil(total / 16) % 700}
    uses = Counter((r.rank, r.block) for r in slots)
    want = []
    for r in mixing.laid_out(sizes.where("size > 0"), targets).collect():
        words = range(r.begin, r.begin + r["size"])
        want.append((r.doc_id, r["size"], sum(uses[(r["rank"], w // 16)] for w in words)))
    want += [(i, 0, 0) for i, t, _ in rows if not (t or "").split()]
    got = mixing.mixed(df, **how).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(((r.doc_id, r["size"], r.taken) for r in got), key=key) == sorted(want, key=key)
    assert all(r.taken <= 3 * r["size"] for r in got)


def test_near_the_targets_and_repeatable(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op8_mix_sources"](spark, sf).collect()
    again = QUERIES["op8_mix_sources"](spark, sf).collect()
    assert sorted(got) == sorted(again) and len(got) == 1000
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    taken, target = Counter(), {}
    for r in got:
        assert r.taken <= 3 * r["size"]
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    for s, t in target.items():
        assert abs(taken[s] - t) <= 0.01 * t + 4 * mixing.BLOCK_WORDS, (s, t, taken[s])


def test_empty_and_copies(spark):
    assert mixing.mixed(docs(spark, [])).collect() == []
    assert mixing.mixed(docs(spark, [(1, None, "a"), (2, " \n", None)])).select("doc_id", "taken").collect() == [(1, 0), (2, 0)]
    rows = [(i, f"t{i} " * 640, "a" if i % 2 else "b") for i in range(40)]
    mixed = mixing.mixed_documents(docs(spark, rows))
    assert mixed.columns == docs(spark, []).columns
    n = Counter(r.source for r in mixed.collect())
    assert n["a"] > 1.5 * n["b"] > 0


def test_whole_documents_come_near_the_targets(spark):
    """Long documents of a source with a small target too, with and without ids."""
    rng = random.Random(3)
    rows = [(i if i % 3 else None, f"t{i} " * rng.randint(200, 900), s) for i, s in enumerate(["a", "b", "c"] * 500)]
    df = docs(spark, rows)
    target = {r.source: r.target for r in mixing.source_targets(mixing.document_sizes(df)).collect()}
    kept = mixing.mixed_documents(df).collect()
    words = Counter()
    for r in kept:
        words[r.source] += len(r.text.split())
    for s, t in target.items():
        assert abs(words[s] - t) <= 0.15 * t, (s, t, words[s])
    assert sorted(kept, key=str) == sorted(mixing.mixed_documents(df).collect(), key=str)
