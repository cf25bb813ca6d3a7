"""SentencePiece codec: the library's ids without dropout, exact round trips with it."""

import random

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from tillwork.llm import pieces
from tillwork.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = pieces.model_parts(PATH)
ODD = ["", " ", "a", "  two  spaces ", "\n\n x\ty\r", "▁ literal ▁▁", "日本 \U0001f600 é\x00", "<s>x</s><0x41>", "word" * 300, " " * 50, "Ünï — “q”"]


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def codec():
    return pieces.Codec(*PARTS)


def ids_of(data):
    return pieces.np.frombuffer(data, "<u4").tolist()


def test_no_dropout_is_the_library(spark, model, codec):
    texts = [t for t in ODD if "▁" not in t]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text in texts:
        assert ids_of(codec.encode(text)) == model.encode(text), text[:80]


def test_lossless_and_varied(codec):
    rng = random.Random(2)
    texts = ODD + ["".join(rng.choices("abcthe ▁\n.é日<", k=200)) for _ in range(50)]
    for dropout in (0.0, 0.1, 0.5, 1.0):
        other = pieces.Codec(*PARTS, dropout=dropout)
        assert all(other.decode(other.encode(text, 3)) == text for text in texts)
    text = "information and communication of the international organisation " * 20
    some = pieces.Codec(*PARTS, dropout=0.1)
    cuts = {some.encode(text, key) for key in range(20)}
    assert len(cuts) == 20 and sum(map(len, cuts)) > 20 * len(codec.encode(text))


def test_share_of_skipped_merges(codec):
    """Each candidate is skipped about as often as asked for."""
    some = pieces.Codec(*PARTS, dropout=0.2)
    words = [f"{a}{b}" for a in "bcdfghklmnprst" for b in "aeiou"]
    alone = [w for w in words if len(list(codec.spans(w, 0))) == 1]
    skipped = sum(len(list(some.spans(w, 977 * k + i))) == 2 for k in range(60) for i, w in enumerate(alone))
    assert abs(skipped / (60 * len(alone)) - 0.2) < 0.03


def test_everything_dropped_is_characters():
    assert list(pieces.Codec(*PARTS, dropout=1.0).spans("hello", 5)) == list("hello")


def test_very_long_text():
    text = "x1" * 150_000
    some = pieces.Codec(*PARTS, dropout=0.1)
    assert some.decode(some.encode(text, 1)) == text


def test_query_and_frames(spark):
    got = QUERIES["op9_sentencepiece_dropout"](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == 200 and all(r.lossless for r in got)
    again = QUERIES["op9_sentencepiece_dropout"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(got) == sorted(again)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "x"), (99, None), (3, "again"), (3, "again")]
    df = spark.createDataFrame([(i, t, 1, "y") for i, t in rows], "doc_id long, text string, n_ids int, ids string")
    ids = pieces.encoded(df, PARTS)
    back = pieces.decoded(ids, PARTS).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted((tuple(r) for r in back), key=key) == sorted(rows, key=key)
    assert pieces.encoded(df.limit(0), PARTS).collect() == []
    other = pieces.encoded(df, PARTS, seed=8).collect()
    assert any(a.ids != b.ids for a, b in zip(sorted(ids.collect(), key=str), sorted(other, key=str), strict=True))


def test_each_occurrence_is_cut_anew(spark, codec):
    """A word has many segmentations over documents, and over its repeats in one."""
    word = " internationalization"
    df = spark.createDataFrame([(i, word[1:]) for i in range(300)] + [(None, f"{word[1:]} {i}") for i in range(300)], "doc_id long, text string")
    rows = pieces.encoded(df, PARTS).collect()
    assert len({tuple(r.ids) for r in rows if r.doc_id is not None}) > 10
    words = {codec.decode(pieces.np.array(r.ids, "<u4").tobytes()).split()[0] for r in rows}
    assert words == {word[1:]} and len({tuple(r.ids[:3]) for r in rows if r.doc_id is None}) > 10
    one = pieces.encoded(spark.createDataFrame([(1, word[1:] + word * 299)], "doc_id long, text string"), PARTS).first().ids
    cuts, cut = set(), []
    for i in one:
        if codec.bytes[i].startswith(b" ") and cut:
            cuts.add(tuple(cut))
            cut = []
        cut.append(i)
    assert len(cuts) > 10


def test_what_is_remembered_does_not_change_the_ids(monkeypatch):
    texts = [" ".join(random.Random(i).choices(["information", "a1b2/c3-d4", "naïve", "x" * 70, "of\nthe"], k=60)) for i in range(40)]
    some = pieces.Codec(*PARTS, dropout=0.3)
    want = [some.encode(t, i) for i, t in enumerate(texts)]
    assert want == [some.encode(t, i) for i, t in enumerate(texts)]
    monkeypatch.setattr(pieces, "REMEMBERED", 0)
    none = pieces.Codec(*PARTS, dropout=0.3)
    assert want == [none.encode(t, i) for i, t in enumerate(texts)]


def draws_of(key, n, dropout):
    """The splitmix generator, a number at a time."""
    mask, out = (1 << 64) - 1, []
    for i in range(1, 2 * n + 1):
        h = (i * 0x9E3779B97F4A7C15 + key) & mask
        h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 & mask
        h = (h ^ h >> 27) * 0x94D049BB133111EB & mask
        h ^= h >> 31
        out += [h & 0xFFFFFFFF, h >> 32]
    return [d < int(dropout * (1 << 32)) for d in out]


def slow(text, key, dropout):
    """All neighbours are looked through for the best candidate, again for each merge."""
    known, byte_ids, skip = PARTS
    ids = {t.replace("▁", " "): i for i, (t, _) in enumerate(known) if i not in skip and i not in byte_ids}
    score = {t: known[i][1] for t, i in ids.items() if len(t) > 1}
    near = {t[k : k + 2] for t in score for k in range(len(t) - 1)}
    text = " " + text
    skipped = draws_of(key, len(text), dropout)
    cuts = [0, *[i for i in range(1, len(text)) if text[i - 1 : i + 1] not in near], len(text)]
    out = []
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        symbols, refused, drawn = [(i, i + 1) for i in range(lo, hi)], set(), 4 * lo
        while True:
            pairs = [(a[0], b[1]) for a, b in zip(symbols, symbols[1:], strict=False)]
            open_ = [p for p in pairs if text[p[0] : p[1]] in score and p not in refused]
            if not open_:
                break
            best = min(open_, key=lambda p: (-score[text[p[0] : p[1]]], p[0]))
            drawn += 1
            if skipped[drawn - 1]:
                refused.add(best)
            else:
                symbols = [s for s in symbols if not best[0] <= s[0] < best[1]]
                symbols = sorted([*symbols, best])
        for a, b in symbols:
            out += [ids[text[a:b]]] if text[a:b] in ids else [byte_ids[c] for c in text[a:b].encode()]
    return out


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_all_ways_give_the_ids_of_a_slow_search(monkeypatch, dropout):
    """Remembered or not, together or alone, short parts or long ones."""
    rng = random.Random(4)
    texts = [t for t in ODD if t] + ["".join(rng.choices("theinacso ▁\n.é日<x1", k=rng.choice([1, 9, 150]))) for _ in range(60)]
    texts += [" ".join(rng.choices(["information", "a1b2/c3-d4", "naïve", "x" * 70, "of\nthe"], k=30)) for _ in range(10)]
    want = [slow(t, 31 * k, dropout) for k, t in enumerate(texts)]
    some = pieces.Codec(*PARTS, dropout=dropout)
    for _ in range(3):
        ids, ends = some.encode_all(texts, [31 * k for k in range(len(texts))])
        assert [one.tolist() for one in pieces.np.split(ids, ends[:-1])] == want
        assert [ids_of(some.encode(t, 31 * k)) for k, t in enumerate(texts)] == want
    monkeypatch.setattr(pieces, "LONG", 4)
    monkeypatch.setattr(pieces, "SIDE_BY_SIDE", 3)
    few = pieces.Codec(*PARTS, dropout=dropout)
    assert [ids_of(few.encode(t, 31 * k)) for k, t in enumerate(texts)] == want
    ids, ends = few.encode_all(["", ""], [1, 2])
    assert len(ids) == 0 and ends.tolist() == [0, 0] and len(few.encode_all([], [])[0]) == 0


def test_documents_go_in_slices_by_rows_and_size(monkeypatch):
    monkeypatch.setattr(pieces, "TOGETHER", (3, 10))
    for column in (["a" * n for n in (1, 2, 3, 4, 50, 1, 9, 9)] + [None], [[1] * 4, None, [1] * 20, [], [2]]):
        batch = pieces.pa.RecordBatch.from_arrays([pieces.pa.array(range(len(column))), pieces.pa.array(column)], ["doc_id", "v"])
        cut = [one.column(1).to_pylist() for one in pieces._slices(batch)]
        assert sum(cut, []) == column and all(len(c) <= 3 and (len(c) == 1 or sum(len(v or []) for v in c) <= 10) for c in cut)


def test_slices_of_a_batch_stay_small():
    """What a worker lays out at a time is bounded by rows and by characters; a longer document goes alone."""
    texts = ["a" * 10_000] * 600 + ["b"] * 900 + ["c" * 1_500_000, None, ""]
    batch = pa.RecordBatch.from_pydict({"doc_id": range(len(texts)), "text": texts})
    slices = [s.column(1).to_pylist() for s in pieces._slices(batch)]
    assert [t for s in slices for t in s] == texts
    assert all(len(s) <= 200 and (len(s) == 1 or sum(len(t or "") for t in s) <= 1_000_000) for s in slices)
