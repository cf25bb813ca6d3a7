"""Token files: bit packing, random access, order of documents, ids as the library gives them."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tillwork.llm import tokenfile as tf
from tillwork.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("width", range(1, 33))
def test_packing(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 8 * 37, dtype=np.uint64).astype(np.uint32)
    data = tf.packed(ids, width)
    assert len(data) == 37 * width and (tf.unpacked(data, width) == ids).all()


def test_random_access():
    rng = np.random.default_rng(1)
    docs = [(i if i % 7 else None, rng.integers(0, 5000, n, dtype=np.uint32)) for i, n in enumerate([0, 1, 1023, 1024, 1025, 0, 300_000, 5])]
    sink = pa.BufferOutputStream()
    writer = tf.TokenFileWriter(sink, tf.bit_width(5000))
    for d in docs:
        writer.add(*d)
    writer.close()
    file = tf.TokenFile(pa.BufferReader(sink.getvalue()))
    assert file.width == 13 and file.doc_ids == [d for d, _ in docs]
    for i, (_, ids) in enumerate(docs):
        assert (file.document(i) == ids).all()
    at = 0
    for (d, ids), (doc_id, start, got) in zip(docs, file.documents(), strict=True):
        assert doc_id == d and start == at and (got == ids).all()
        at += len(ids)


def expected(rows):
    tokenizer = Tokenizer.from_file(PATH)
    out, start = [], 0
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()]
    got = [tuple(r) for r in QUERIES["op10_token_files"](spark, sf).orderBy("start").collect()]
    assert got == expected(rows)


def test_edges(spark, folder):
    rng = random.Random(3)
    odd = ["", None, " ", "It's DON'T 'S x's", "<|EndOfText|> a", "a <|endoftext|>b", "<|startoftext|>", "é ́x", "A B C\x85D", "ǅ ΣΑΣ İ", "x" * 100_000, "日本 \U0001f600\x00\x1c.", "1234 5.6%"]
    odd += ["".join(rng.choices("aB' \n.́é<|>s5 ", k=60)) for _ in range(60)]
    ids = list(range(len(odd)))
    rng.shuffle(ids)
    rows = [*zip(ids, odd, strict=True), (None, "no id"), (3, "again"), (3, "again")]
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], "doc_id long, text string, file string, start int")
    got = sorted((tuple(r) for r in QUERIES["op10_token_files"](spark, folder(documents=df)).collect()), key=lambda r: r[1])
    seen = [r[0] for r in got]
    assert seen == sorted(seen, key=lambda i: (i is not None, i or 0))
    want = {(r[0], r[2], r[3]) for x in rows for r in expected([x])}
    assert {(r[0], r[2], r[3]) for r in got} == want and len(got) == len(rows)
    assert all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:], strict=False)) and got[0][1] == 0
    assert QUERIES["op10_token_files"](spark, folder(documents=df.limit(0))).collect() == []


def test_whole_text_encoding(spark, tmp_path):
    """A tokenizer that keeps white space is applied to whole texts."""
    definition = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
    df = spark.createDataFrame([(1, "a  b\n c")], "doc_id long, text string")
    files = tf.write_token_files(df, definition, 2, str(tmp_path / "t"))
    got = tf.read_token_files(files, str(tmp_path / "t"), lambda ids: {"ids": ids.tolist()}, "ids array<long>").collect()
    assert got[0].ids == [*Tokenizer.from_str(definition).encode("a  b\n c", add_special_tokens=False).ids, 2]
