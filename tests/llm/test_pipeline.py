"""The pipeline, stage by stage against plain Python over the same rows."""

import re
from collections import Counter

import corpus_pipeline as cp
import pytest
from test_pii import base
from test_shinglejoin import linked

from tillwork.llm import pieces

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    # an unlabelled row, one without letters, one without text
    extra = [(9001, "12 34 !", "en", "src1", 7), (9002, None, None, None, None), (9003, "the of and that with for the", None, "src2", 28)]
    out = [docs.unionByName(spark.createDataFrame(extra, docs.schema))]
    for name, stage in cp.STAGES:
        out.append(cp.stored(stage(spark, out[-1], SF), name))
    return dict(zip(["input", *[n for n, _ in cp.STAGES]], out, strict=True))


def test_columns(steps):
    names = list(steps)
    for name in names[1:-1]:
        assert steps[name].schema.simpleString() == steps["input"].schema.simpleString()
    assert [n for n, _ in cp.STAGES] == names[1:]


def test_language_keeps_all_with_letters(steps):
    before, after = steps["input"].collect(), {r.doc_id: r for r in steps["language"].collect()}
    assert set(after) == {r.doc_id for r in before if re.search(r"[^\W\d_]", r.text or "")}
    assert all(after[r.doc_id].text == r.text and after[r.doc_id].lang == r.lang for r in before if r.doc_id in after and r.lang)
    assert after[9003].lang is not None and not {9001, 9002} & set(after)


def test_one_of_each_group_stays(steps):
    before = {r.doc_id: r for r in steps["language"].collect()}
    want = set(linked([(i, r.text) for i, r in before.items()], 5, 80).values())
    after = steps["near_copies"].collect()
    assert len(after) == len(want) < len(before) and all(r == before[r.doc_id] and r.doc_id in want for r in after)


def test_personal_data_is_gone(steps):
    before, after = ({r.doc_id: r for r in steps[n].collect()} for n in ("near_copies", "personal_data"))
    assert before.keys() == after.keys()
    hit = 0
    for i, r in before.items():
        new = after[i]
        spans = base(r.text)
        hit += bool(spans)
        if not spans and 'token = "' not in r.text:
            assert new == r
        assert not base(new.text) and not re.search(r'token = "[0-9a-f]{20}', new.text) and new.n_chars == len(new.text)
        assert re.sub(r"\[(EMAIL|IP|CARD|PHONE|CONTEXT)\]", "", new.text)[:20] in r.text or spans
    assert hit


def test_mix_follows_the_targets(steps):
    """Whole documents, as often as the mix takes their words or one more; sources near their targets."""
    before = {r.doc_id: r for r in steps["personal_data"].collect()}
    taken = {r.doc_id: r for r in cp.mixing.mixed(steps["personal_data"]).collect()}
    after = steps["mix"].collect()
    assert all(before[r.doc_id] == r for r in after)
    times = Counter(r.doc_id for r in after)
    words, taken_words, spread = Counter(), Counter(), Counter()
    for i, r in taken.items():
        more = times[i] - r.taken // max(1, r["size"])
        left = r.taken % max(1, r["size"]) / max(1, r["size"])
        # the draw for the rest: none where nothing is left over
        assert more in (0, 1) and not (more and left == 0)
        source = before[i].source
        words[source] += times[i] * r["size"]
        taken_words[source] += r.taken
        spread[source] += left * (1 - left) * r["size"] ** 2
    # a source has some ten documents here, so its words scatter about what the mix takes
    assert all(abs(words[s] - taken_words[s]) <= 4 * spread[s] ** 0.5 + 1 for s in taken_words)
    whole = sum(taken_words.values())
    assert abs(sum(words.values()) - whole) < 0.1 * whole


def test_ids_decode_to_the_texts(spark, steps):
    want = sorted((r.doc_id, r.text) for r in steps["mix"].collect())
    back = pieces.decoded(steps["pieces"], pieces.public_model()).collect()
    assert sorted(tuple(r) for r in back) == want


def test_run(spark):
    got = [cp.run(spark, SF) for _ in range(2)]
    assert got[0].columns == ["doc_id", "ids"]
    assert sorted(got[0].collect()) == sorted(got[1].collect()) != []


def test_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in cp.STAGES:
        docs = cp.stored(stage(spark, docs, SF), name)
        assert docs.count() == 0
