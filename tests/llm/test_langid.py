"""Language identification: gradients, masking, held-out accuracy, odd texts."""

import zlib

import numpy as np

from tillwork.llm import langid
from tillwork.llm.queries import QUERIES


def test_gradients_are_the_slopes():
    rng = np.random.default_rng(4)
    model = langid.LanguageModel.fresh(["a", "b", "c"], 5, 1)
    model.weights = [w.astype(np.float64) for w in model.weights]
    x = rng.integers(0, 256, (7, 4)).astype(np.uint8)
    mask = (np.arange(7)[:, None] < [7, 3, 1, 5]).astype(np.float32)
    label = np.array([0, 2, 1, 1])
    _, grads = model.gradients(x, mask, label)
    for k, w in enumerate(model.weights):
        spots = [tuple(s) for s in np.argwhere(np.abs(grads[k]) > 1e-3)[:: max(1, (np.abs(grads[k]) > 1e-3).sum() // 5)]]
        assert spots
        for spot in spots:
            was, step = w[spot], 1e-2
            w[spot] = was + step
            up, _ = model.gradients(x, mask, label)
            w[spot] = was - step
            down, _ = model.gradients(x, mask, label)
            w[spot] = was
            assert abs((up - down) / (2 * step) - grads[k][spot]) < 2e-2 * abs(grads[k][spot]) + 2e-4


def test_filling_has_no_effect():
    model = langid.LanguageModel.fresh(["a", "b"], 6, 2)
    texts = [b"abc", b"x" * 128, b"y" * 129, b"", b"hello world" * 50]
    together = model.document_probabilities(texts)
    for text, p in zip(texts, together, strict=True):
        assert np.allclose(model.document_probabilities([text])[0], p, atol=1e-5)
    assert together[3].sum() == 0 and np.allclose(together[[0, 1, 2, 4]].sum(axis=1), 1, atol=1e-5)


def test_every_position_counts():
    """A document's probabilities are the means over all positions of all segments."""
    model = langid.LanguageModel.fresh(["a", "b"], 6, 3)
    text = bytes(range(32, 127)) * 5
    sums = np.zeros(2)
    for at in range(0, len(text), langid.SEGMENT):
        part = np.frombuffer(text[at : at + langid.SEGMENT], np.uint8)[:, None]
        sums += model.positions(part, np.ones(part.shape, np.float32))[:, :, 0].sum(axis=0)
    assert np.allclose(model.document_probabilities([text])[0], sums / len(text), atol=1e-5)


def test_query_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op3_language_id"](spark, sf).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held) > 200


def test_edges(spark, folder):
    words = {"en": "the cat and that with ", "de": "der und ist schön mit "}
    rows = [(i, words[lang] * 20, lang) for i in range(60) for lang in [("en", "de")[i % 2]]]
    rows += [(100, None, "en"), (101, "", "en"), (102, "12 !? ²", None), (None, "the cat and that", "en")]
    rows += [(103, "the cat and that", None), (103, "the cat and that", None), (104, "und ist schön " * 40_000, "de")]
    df = spark.createDataFrame([(*r, 0.5, False) for r in rows], "doc_id long, text string, lang string, score double, held_out boolean")
    got = QUERIES["op3_language_id"](spark, folder(documents=df)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (100, 101, 102))
    assert by[None].lang_pred == by[103].lang_pred == "en" and by[104].lang_pred == "de"
    assert by[None].held_out is False
    blank = df.selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {r.lang_pred for r in langid.identified(blank).collect()} == {"und"}
    assert langid.identified(df.limit(0)).collect() == []


def test_rows_without_a_model_stay(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, "12 !?", None), (3, None, None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in langid.with_known_language(docs).collect()] == [(1, "some words", None)]


def test_unknown_text_goes_and_held_out_text_stays(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = ["xqzj kkwv zzpt qqqq vvvx jjkz", "Все люди рождаются свободными и равными в своем достоинстве и правах.", "Minden emberi lény szabadon születik és egyenlő méltósága és joga van.", "Tämä on suomenkielinen teksti, jossa kerrotaan talvesta ja lumesta."]
    more = spark.createDataFrame([(10**6 + i, t, None, None, None) for i, t in enumerate(odd)], docs.schema)
    kept = {r.doc_id for r in langid.with_known_language(docs.unionByName(more)).collect()}
    held = {r.doc_id for r in docs.where(langid.is_held_out(docs.doc_id) & docs.text.rlike(r"\p{L}")).collect()}
    assert len(held & kept) >= 0.995 * len(held) > 200
    assert any(10**6 + i not in kept for i in range(len(odd)))
