"""Language identification by a bidirectional gated recurrent network over bytes.

Texts are cut into segments of bytes.  One network reads a segment forwards, one backwards; at every
position their two states together give a probability for each language.  A document's probabilities
are the means over all its positions.  The networks are trained in numpy by backpropagation through
time on a bounded sample of labelled texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm.common import query, table

#: labelled rows that training sees at most, and the characters of each
SAMPLE_ROWS = 3000
SAMPLE_CHARS = 512
HIDDEN = 12
SEGMENT = 128
#: segments that are read side by side
LANES = 2048
STEPS = 450
BATCH = 128
TRAIN_BYTES = 96
UNKNOWN = "und"
#: of the way from chance (one over the number of languages) to 1, what the score of a text in a known
#: language reaches: a score of 0.5 with four languages
LEAST_EVIDENCE = 1 / 3


class ByteGRU:
    """One direction.  ``inputs``: a row of 3 * hidden for each byte; states are (hidden, lanes).

    The rows of the three gates follow each other: keep, reset, candidate.
    """

    def __init__(self, inputs: np.ndarray, recurrent: np.ndarray):
        self.inputs, self.recurrent = inputs, recurrent
        self.h = recurrent.shape[1]

    def run(self, x: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States after each step, (steps, hidden, lanes), for bytes ``x`` (steps, lanes).

        Where ``mask`` is 0 the state is empty, so that filling before the first byte has no effect.
        """
        h, half = self.h, np.float32(0.5)
        columns = np.ascontiguousarray(self.inputs.T)
        state = np.zeros((h, x.shape[1]), np.float32)
        out = np.empty((len(x), *state.shape), np.float32)
        full = mask.all(axis=1)
        for t in range(len(x)):
            g, a = np.take(columns, x[t], axis=1), self.recurrent @ state
            gates = g[: 2 * h]
            gates += a[: 2 * h]
            gates *= half
            np.tanh(gates, out=gates)
            gates *= half
            gates += half
            candidate = np.tanh(gates[h:] * a[2 * h :] + g[2 * h :])
            new = candidate + gates[:h] * (state - candidate)
            if not full[t]:
                new *= mask[t]
            if keep is not None:
                keep.append((state, gates, candidate, a[2 * h :]))
            state = out[t] = new
        return out

    def back(self, x: np.ndarray, mask: np.ndarray, kept: list, grad_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of inputs and recurrent weights from those of the states."""
        h = self.h
        grad_inputs, grad_recurrent = np.zeros((len(x), 3 * h, x.shape[1]), np.float32), np.zeros_like(self.recurrent)
        carried = np.zeros_like(grad_out[0])
        for t in range(len(x) - 1, -1, -1):
            state, gates, candidate, a = kept[t]
            z, r = gates[:h], gates[h:]
            d = (grad_out[t] + carried) * mask[t]
            d_candidate = d * (1 - z) * (1 - candidate * candidate)
            into = grad_inputs[t]
            into[:h] = d * (state - candidate) * z * (1 - z)
            into[h : 2 * h] = d_candidate * a * r * (1 - r)
            into[2 * h :] = d_candidate
            inner = into.copy()
            inner[2 * h :] *= r
            grad_recurrent += inner @ state.T
            carried = d * z + self.recurrent.T @ inner
        by_byte = np.empty_like(self.inputs)
        flat = x.ravel()
        for k in range(3 * h):
            by_byte[:, k] = np.bincount(flat, grad_inputs[:, k].ravel(), minlength=256)
        return by_byte, grad_recurrent


class LanguageModel:
    """Both directions and the output layer; ``labels`` names its rows."""

    def __init__(self, labels: list[str], weights: list[np.ndarray]):
        self.labels, self.weights = labels, weights

    @classmethod
    def fresh(cls, labels: list[str], hidden: int, seed: int) -> LanguageModel:
        rng = np.random.default_rng(seed)
        spread = 1 / np.sqrt(hidden)
        shapes = [(256, 3 * hidden), (3 * hidden, hidden)] * 2 + [(len(labels), 2 * hidden), (len(labels), 1)]
        return cls(labels, [rng.uniform(-spread, spread, s).astype(np.float32) for s in shapes])

    def _directions(self) -> tuple[ByteGRU, ByteGRU]:
        return ByteGRU(*self.weights[:2]), ByteGRU(*self.weights[2:4])

    def positions(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Probabilities (steps, labels, lanes) at every position."""
        forward, backward = self._directions()
        states = forward.run(x, mask), backward.run(x[::-1], mask[::-1])[::-1]
        return self._softmax(states)

    def _softmax(self, states: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        out, bias = self.weights[4:]
        h = states[0].shape[1]
        p = np.matmul(out[:, :h], states[0])
        p += np.matmul(out[:, h:], states[1])
        p += bias
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        return p

    def gradients(self, x: np.ndarray, mask: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross-entropy over the positions of the lanes, and its gradient for each weight."""
        forward, backward = self._directions()
        kept_f, kept_b = [], []
        rx, rmask = np.ascontiguousarray(x[::-1]), np.ascontiguousarray(mask[::-1])
        f, b = forward.run(x, mask, kept_f), backward.run(rx, rmask, kept_b)[::-1]
        p = self._softmax((f, b))
        n, lanes = mask.sum(), np.arange(x.shape[1])
        right = p[:, label, lanes]
        loss = -(np.log(right + 1e-9) * mask).sum() / n
        p[:, label, lanes] -= 1
        p *= (mask / n)[:, None, :]
        out, h = self.weights[4], self.weights[1].shape[1]
        d_out = np.concatenate([np.einsum("tcb,thb->ch", p, s, optimize=True) for s in (f, b)], axis=1)
        d_f, d_b = np.matmul(out[:, :h].T, p), np.matmul(out[:, h:].T, p)[::-1]
        return loss, [
            *forward.back(x, mask, kept_f, d_f),
            *backward.back(rx, rmask, kept_b, d_b),
            d_out,
            p.sum(axis=(0, 2))[:, None],
        ]

    def document_probabilities(self, texts: list[bytes]) -> np.ndarray:
        """(documents, labels): means over all bytes; zeros for an empty text."""
        pieces = [-(-len(t) // SEGMENT) for t in texts]
        owner = np.repeat(np.arange(len(texts)), pieces)
        sums = np.zeros((len(texts), len(self.labels)))
        if not len(owner):
            return sums
        filled = np.zeros((len(owner), SEGMENT), np.uint8)
        flat, at = filled.reshape(-1), 0
        length = np.full(len(owner), SEGMENT)
        for text, n in zip(texts, pieces, strict=True):
            if n:
                flat[at * SEGMENT : at * SEGMENT + len(text)] = np.frombuffer(text, np.uint8)
                at += n
                length[at - 1] = len(text) - (n - 1) * SEGMENT
        for lo in range(0, len(owner), LANES):
            size = length[lo : lo + LANES]
            x = np.ascontiguousarray(filled[lo : lo + LANES, : size.max()].T)
            mask = (np.arange(len(x))[:, None] < size).astype(np.float32)
            p = self.positions(x, mask)
            p *= mask[:, None, :]
            np.add.at(sums, owner[lo : lo + LANES], p.sum(axis=0).T)
        return sums / np.maximum(1, [len(t) for t in texts])[:, None]


def train(rows: list[tuple[bytes, str]], steps: int = STEPS, hidden: int = HIDDEN, seed: int = 1) -> LanguageModel:
    """Fit on (text, language) pairs with Adam; each step takes random stretches of random texts."""
    labels = sorted({lang for _, lang in rows})
    index = np.array([labels.index(lang) for _, lang in rows])
    model, rng = LanguageModel.fresh(labels, hidden, seed), np.random.default_rng(seed)
    mean, square = ([np.zeros_like(w) for w in model.weights] for _ in range(2))
    for step in range(1, steps + 1):
        chosen = rng.integers(len(rows), size=BATCH)
        x, mask = np.zeros((TRAIN_BYTES, BATCH), np.uint8), np.zeros((TRAIN_BYTES, BATCH), np.float32)
        for lane, i in enumerate(chosen):
            text = rows[i][0]
            at = rng.integers(max(1, len(text) - TRAIN_BYTES + 1))
            part = np.frombuffer(text[at : at + TRAIN_BYTES], np.uint8)
            x[: len(part), lane], mask[: len(part), lane] = part, 1
        _, grads = model.gradients(x, mask, index[chosen])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = 0.02 * min(1, (steps - step + 1) / (0.5 * steps))
        for w, g, m, s in zip(model.weights, grads, mean, square, strict=True):
            g = g * min(1, 1 / (norm + 1e-9))
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return model


def is_held_out(doc_id: Column) -> Column:
    """A third of the ids; a null id is not held out, and not learned from either."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> list[tuple[bytes, str]]:
    """At most ``rows`` labelled texts, a stretch of ``chars`` characters of each, chosen by hashes.

    A hash first thins the rows to about what is needed, so that the tasks together send no more.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
    share = min(1.0, 1.3 * rows / max(1, labelled.count()))
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    start = F.pmod(F.xxhash64("doc_id", F.lit("at")), F.greatest(F.lit(1), F.length("text") - chars + 1)) + 1
    stretch = F.col("text").substr(start.cast("int"), F.lit(chars))
    picked = labelled.where((h < int(share * (1 << 30))) & F.col("text").rlike(r"\p{L}"))
    found = picked.select(stretch.alias("text"), "lang", h.alias("h"), "doc_id").orderBy("h", "doc_id").limit(rows)
    return [(r.text.encode(), r.lang) for r in found.collect()]


def language_of(model: LanguageModel | None) -> Callable[[Column], Column]:
    """A column function from a whole text to a struct of lang_pred and score.

    ``und`` with score 0 for a null text, a text without letters, or without a model.
    """

    def label(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for column in columns:
            lang, score = [UNKNOWN] * len(column), [0.0] * len(column)
            for lo in range(0, len(column), 1000):
                texts = column[lo : lo + 1000].tolist()
                known = [model is not None and any(c.isalpha() for c in t or "") for t in texts]
                if any(known):
                    p = model.document_probabilities([t.encode() if k else b"" for t, k in zip(texts, known, strict=True)])
                    for i in np.flatnonzero(known):
                        best = int(p[i].argmax())
                        lang[lo + i], score[lo + i] = model.labels[best], min(1.0, float(p[i, best]))
            yield pd.DataFrame({"lang_pred": lang, "score": score})

    return F.pandas_udf(label, "lang_pred string, score double")


def learned(docs: DataFrame) -> LanguageModel | None:
    """A model of the labelled rows that are not held out; None when there is none."""
    rows = training_sample(docs)
    return train(rows) if rows else None


def identified(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row of ``docs`` (doc_id, text, lang).

    Other columns are left behind; repeated rows stay.
    """
    label = language_of(learned(docs))
    named = docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), label(F.col("text")).alias("p"))
    return named.select("doc_id", "held_out", "p.lang_pred", "p.score")


def least_score(n_labels: int) -> float:
    """The score below which a text is in none of ``n_labels`` languages; one label cannot reject."""
    return 1 / n_labels + LEAST_EVIDENCE * (1 - 1 / n_labels)


def with_known_language(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` in a language that the model knows; a missing ``lang`` is filled in.

    A text without letters or with a score below ``least_score`` is in none.  Without a labelled row
    there is no model: then all rows with a letter stay as they are.
    """
    model = learned(docs)
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    columns = [c for c in docs.columns if c != "lang"]
    is_known = (F.col("_p.lang_pred") != UNKNOWN) & (
        (F.col("_p.score") >= least_score(len(model.labels))) | F.lit(len(model.labels) == 1)
    )
    named = docs.withColumn("_p", language_of(model)(F.col("text"))).where(is_known)
    return named.select(*columns, F.coalesce("lang", "_p.lang_pred").alias("lang")).select(docs.columns)


@query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return identified(table(spark, sf_dir, "documents"))
