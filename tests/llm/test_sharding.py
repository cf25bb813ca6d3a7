"""Byte shards: cuts against a sort in plain Python, whole results, hot groups, edges."""

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tillwork.llm import sharding as sh
from tillwork.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def checked(rows, shards, tolerance, largest=0):
    """``rows`` (text, shard, slot, ...): gapless slots, shards near their bytes; the bytes of each shard."""
    size, slots = [0] * shards, defaultdict(list)
    for text, shard, slot, *_ in rows:
        size[shard] += len((text or "").encode()) + 8
        slots[shard].append(slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    total, upto = sum(size), 0
    for i in range(shards - 1):
        upto += size[i]
        assert abs(upto - total * (i + 1) / shards) <= max(tolerance * total / shards, largest / 2) + 1
    return size


def test_query(spark):
    df = QUERIES["op11_byte_shards"](spark, SF)
    got = df.collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = Counter((d.doc_id, len(d.text.encode()) + 8, zlib.crc32(d.text.encode())) for d in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    text = {d.doc_id: d.text for d in docs}
    checked([(text[r.doc_id], r.shard, r.slot) for r in got], 24, sh.TOLERANCE, max(r.size for r in got))
    again = QUERIES["op11_byte_shards"](spark, SF).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in again} == {(r.doc_id, r.shard, r.slot) for r in got}


@pytest.mark.parametrize("part_bytes", [1 << 40, 3000])
def test_cuts_are_those_of_a_sort(spark, part_bytes):
    """Every shard holds a run of the sorted rows, cut where plain Python would cut it."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    first, second = sh.row_hashes(docs)
    every = sorted((r.a, r.b, r.n) for r in docs.select(first.alias("a"), second.alias("b"), sh.row_bytes(F.col("text")).alias("n")).collect())
    out = sh.sharded(docs, 7, 0.0, part_bytes).withColumns({"a": first, "b": second}).orderBy("shard", "slot").collect()
    assert [(r.a, r.b) for r in out] == [e[:2] for e in every]
    total, ends, upto = sum(e[2] for e in every), [0] * 7, 0
    for i in range(1, 7):
        edges = [0]
        for e in every:
            edges.append(edges[-1] + e[2])
        ends[i] = min(range(len(edges)), key=lambda k: (abs(edges[k] - total * i / 7), k))
    counts = Counter(r.shard for r in out)
    for i in range(6):
        upto += counts[i]
        assert upto == ends[i + 1]


def test_equal_texts_stay_together(spark):
    rows = [(i, f"text {i // 5} " + "x" * 50, "s") for i in range(20_000)]
    out = sh.sharded(spark.createDataFrame(rows, "doc_id long, text string, source string"), 24).collect()
    shards = defaultdict(set)
    for r in out:
        shards[r.text].add(r.shard)
    assert max(map(len, shards.values())) == 1
    checked([(r.text, r.shard, r.slot) for r in out], 24, sh.TOLERANCE)


def test_hot_groups(spark):
    """A third of the rows with one text, a third the very same row."""
    same = spark.range(30_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("the same row").alias("text"))
    text = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit("one text of many ids").alias("text"))
    rest = spark.range(30_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    docs = same.unionByName(text).unionByName(rest).repartition(7)
    for part_bytes in (1 << 40, 20_000):
        out = sh.sharded(docs, 24, part_bytes=part_bytes)
        rows = out.collect()
        assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in docs.collect())
        size = checked([(r.text, r.shard, r.slot) for r in rows], 24, sh.TOLERANCE)
        assert max(size) <= 1.03 * min(size)
        per_task = out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert per_task <= 90_000 / 24 * 1.4


def test_edges(spark, folder):
    texts = ["", None, "", None, "é\U0001f600", "x" * 200_000, "a", "a", "a"]
    df = spark.createDataFrame(
        [(i if i % 3 else None, t, 7, "p", {"k": i % 2}) for i, t in enumerate(texts)],
        "doc_id long, text string, shard int, part string, row map<string,int>",
    )
    got = sh.sharded(df, 4).collect()
    assert Counter((r.doc_id, r.text, r.part, str(r.row)) for r in got) == Counter(
        (r.doc_id, r.text, r.part, str(r.row)) for r in df.collect()
    )
    checked([(r.text, r.shard, r.slot) for r in got], 4, 0, 200_008)
    many = df.unionByName(df).unionByName(df).where("text <> 'x' and length(text) < 9")
    checked([(r.text, r.shard, r.slot) for r in sh.sharded(many, 3).collect()], 3, sh.TOLERANCE, 20)
    assert sh.sharded(df.limit(0), 4).collect() == []
    rows = QUERIES["op11_byte_shards"](spark, folder(documents=df.drop("row"))).collect()
    assert sorted(r.size for r in rows) == sorted(len((t or "").encode()) + 8 for t in texts)
    assert {r.text_crc32 for r in rows} == {zlib.crc32((t or "").encode()) for t in texts}
