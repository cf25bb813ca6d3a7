"""Token counts by greedy longest match, in time linear in the text.

The vocabulary is a trie.  Where no edge leads on, a failure link goes to the state that the
longest-match rule reaches after giving out one or more whole tokens, and a precomputed number says
how many.  So each character is read once and no piece is ever built.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm.common import query, table

#: begins every word, as in the vocabulary's word-initial pieces
WORD_START = "▁"
#: remembered words of one Python worker; beyond it words are counted again, with the same result
REMEMBERED = 400_000
#: a word that no sequence of pieces spells is one unknown token; unknowns count in these high bits
_UNKNOWN = 1 << 40


class LongestMatch:
    """A trie with failure links; ``popped[s]`` tokens are complete when state ``s`` fails."""

    def __init__(self, pieces: Iterable[str]):
        self.children: list[dict[str, int]] = [{}]
        final = set()
        for piece in pieces:
            state = 0
            for c in piece:
                if c not in self.children[state]:
                    self.children[state][c] = len(self.children)
                    self.children.append({})
                state = self.children[state][c]
            final.add(state)
        final.discard(0)
        self.fail, self.popped = [-1] * len(self.children), [0] * len(self.children)
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for c, state in self.children[parent].items():
                queue.append(state)
                if state in final:
                    self.fail[state], self.popped[state] = 0, 1
                    continue
                back, tokens = self.fail[parent], self.popped[parent]
                while back >= 0 and c not in self.children[back]:
                    tokens += self.popped[back]
                    back = self.fail[back]
                if back >= 0:
                    self.fail[state], self.popped[state] = self.children[back][c], tokens

    def count(self, word: str) -> int | None:
        """The number of greedy longest pieces of ``word``; None if they can't spell it."""
        children, fail, popped = self.children, self.fail, self.popped
        state = tokens = 0
        for c in word:
            while (to := children[state].get(c)) is None:
                if fail[state] < 0:
                    return None
                tokens += popped[state]
                state = fail[state]
            state = to
        while state:
            if fail[state] < 0:
                return None
            tokens += popped[state]
            state = fail[state]
        return tokens


class _Counts(dict):
    """Word (UTF-8) to its count, filled on demand and bounded."""

    def __init__(self, pieces: tuple[str, ...]):
        self.match = LongestMatch(pieces)

    def __missing__(self, word: bytes) -> int:
        found = self.match.count(WORD_START + word.decode())
        value = 1 + _UNKNOWN if found is None else found
        if len(self) < REMEMBERED and len(word) < 64:
            self[word] = value
        return value


@lru_cache(maxsize=1)
def _counts(pieces: tuple[str, ...]) -> _Counts:
    return _Counts(pieces)


def sentencepiece_pieces(path: str) -> tuple[str, ...]:
    """The text pieces of a SentencePiece model, without control, unknown and byte entries."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return tuple(
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    )


def token_counts(docs: DataFrame, pieces: tuple[str, ...]) -> DataFrame:
    """(doc_id, n_words, n_tokens, n_unknown) for each row of ``docs`` (doc_id, text).

    Words are runs of anything but ASCII white space.  Each is matched from its start, always by
    the longest piece; a word that can't be spelt so counts as one token and one unknown.  A null
    or empty text has no words.  Other columns are left behind; repeated rows stay.  The words that
    a worker remembers only save time.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = _counts(pieces).__getitem__
        for batch in batches:
            words = [(text or "").encode().split() for text in batch["text"]]
            sums = [sum(map(of, w)) for w in words]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "n_words": [len(w) for w in words],
                    "n_tokens": [s % _UNKNOWN for s in sums],
                    "n_unknown": [s // _UNKNOWN for s in sums],
                }
            )

    # ids go through as text: pandas would turn a column with nulls into doubles
    out = docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(
        count, "doc_id string, n_words long, n_tokens long, n_unknown long"
    )
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-piece counts of every document with the pieces of a public 32k vocabulary."""
    import public_tokenizers

    return token_counts(
        table(spark, sf_dir, "documents"), sentencepiece_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    )
