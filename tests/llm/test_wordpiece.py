"""Token counts against the tokenizers library's word-piece model."""

import random

import public_tokenizers
import pytest
from tokenizers import models

from tillwork.llm import wordpiece
from tillwork.llm.queries import QUERIES

PIECES = wordpiece.sentencepiece_pieces(public_tokenizers.path("piece_bpe_32k.model"))


def greedy(word: str, pieces: set, longest: int):
    at = n = 0
    while at < len(word):
        end = next((e for e in range(min(len(word), at + longest), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return None
        at, n = end, n + 1
    return n


@pytest.mark.parametrize("seed", range(5))
def test_small_vocabularies(seed):
    rng = random.Random(seed)
    pieces = {"".join(rng.choices("ab", k=rng.randint(1, 6))) for _ in range(rng.randint(1, 14))}
    match = wordpiece.LongestMatch(pieces)
    for _ in range(2000):
        word = "".join(rng.choices("abc" if seed % 2 else "ab", k=rng.randint(0, 14)))
        assert match.count(word) == greedy(word, pieces, 6), (pieces, word)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    vocab = {p: i for i, p in enumerate([*PIECES, "<none>"])}
    model = models.WordPiece(vocab, unk_token="<none>", continuing_subword_prefix="", max_input_chars_per_word=10**9)
    unknown = vocab["<none>"]
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = [[t.id for t in model.tokenize("▁" + w.decode())] for w in r.text.encode().split()]
        want[r.doc_id] = (r.doc_id, len(ids), sum(map(len, ids)), sum(i == [unknown] for i in ids))
    got = QUERIES["op1_token_counts"](spark, sf).collect()
    assert {r.doc_id: tuple(r) for r in got} == want and len(got) == len(want)


def test_edges(spark):
    long = "ab" * 500_000
    rows = [(1, None), (None, "a"), (2, ""), (3, " \t\n"), (4, "the the the"), (4, "the the the"), (5, long)]
    df = spark.createDataFrame([(i, t, 5, "x") for i, t in rows], "doc_id long, text string, n_words int, extra string")
    got = {r.doc_id: tuple(r)[1:] for r in wordpiece.token_counts(df, ("▁the", "▁", "a", "ab", "b")).collect()}
    assert got == {1: (0, 0, 0), None: (1, 2, 0), 2: (0, 0, 0), 3: (0, 0, 0), 4: (2, 2, 1), 5: (1, 500_001, 0)}
    assert wordpiece.token_counts(df, ("▁",)).count() == len(rows)
    assert wordpiece.token_counts(df.limit(0), PIECES).collect() == []
    assert wordpiece.LongestMatch([]).count("a") is None
