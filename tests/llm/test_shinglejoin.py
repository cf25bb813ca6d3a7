"""Jaccard join: brute force over small corpora, groups of copies, prefixes under any order."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from tillwork.llm import shinglejoin as sj
from tillwork.llm.components import components


def shingles(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(w)} if 0 < len(w) < 3 else {tuple(w[i : i + 3]) for i in range(len(w) - 2)}


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 90 * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), root(i)) for i, s in sets.items())


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, t, 1, 2, "x") for i, t in rows], "doc_id long, text string, n int, node int, component_id string"
    )


def result(spark, rows):
    return sorted(tuple(r) for r in sj.jaccard_components(frame(spark, rows)).collect())


def test_query(same):
    assert same("op6_jaccard_join") == []
    assert same("op6_jaccard_join", "/root/testdata/sf0.01") == []


def corpus(seed):
    """Near copies at all distances around the threshold, chains, copies, a passage that many share."""
    rng = random.Random(seed)
    vocabulary = [f"W{i}" if i % 3 else f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=30)
    texts = []
    for _ in range(25):
        words = rng.choices(vocabulary, k=rng.randint(1, 120))
        if rng.random() < 0.5:
            at = rng.randint(0, len(words))
            words[at:at] = passage
        for _ in range(rng.randint(1, 12)):
            texts.append(list(words))
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
    texts += [rng.choices(vocabulary[:3], k=rng.randint(0, 5)) for _ in range(40)]
    rows = [(i, rng.choice([" ", "\n", " \t"]).join(t)) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_brute_force(spark, seed):
    rows = corpus(seed)
    want = brute(rows)
    assert len({c for *_, c in want}) < 0.8 * len(want)
    assert result(spark, rows) == want


@pytest.mark.parametrize("paired, listed", [(1, -1), (1000, 10**9)])
def test_how_the_work_is_cut_does_not_change_the_result(spark, monkeypatch, paired, listed):
    """With nearly all shared tokens last and turns of leaders, and with neither."""
    monkeypatch.setattr(sj, "PAIRED", paired)
    monkeypatch.setattr(sj, "LISTED", listed)
    rows = corpus(7)
    assert result(spark, rows) == brute(rows)


def test_many_near_copies(spark):
    """One group of near copies at all distances, some of them beyond the threshold of every other."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(250):
        copy = list(words)
        for _ in range(rng.randint(0, 7)):
            copy[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    want = brute(rows)
    assert 1 < len({c for *_, c in want}) < 200
    assert result(spark, rows) == want


def test_a_group_of_near_copies_lists_few_pairs(spark):
    """Copies of one text at all distances: pairs listed stay in proportion to the rows."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(150)]
    made = {}
    for m in (200, 800):
        rows = []
        for i in range(m):
            copy = list(words)
            for _ in range(rng.randint(0, 12)):
                copy[rng.randrange(150)] = f"x{rng.randrange(10**9)}"
            rows.append((i, " ".join(copy)))
        docs = frame(spark, rows)
        first = sj.sets(docs)
        crowds = sj.bit_filter(sj._token_counts(sj.F.col("tokens"), first).where(sj.F.col("m") > sj.PAIRED), "token")
        late = sj.bit_filter(sj.crowded_tokens(docs, crowds, 150 * m), "token")
        own = first.select(sj.F.col("doc_id").alias("node"), "n")
        shared = sj.stored(sj.shared_tokens(sj.prefix_rows(docs, late), own), "test-shared")
        pairs = sj.stored(sj.leader_pairs(sj.open_tokens(shared, None), 0), "test-pairs")
        parts = components(sj.verified(pairs, sj.texts_of(docs, pairs)))
        made[m] = pairs.count() + sj.listed_pairs(sj.open_tokens(shared, parts)).count()
    assert made[800] < 8 * made[200] and made[800] < 8 * 800


@pytest.mark.parametrize("counted", [40, 1 << 20])
def test_tokens_of_crowds(spark, monkeypatch, counted):
    """Counts of whole texts, whatever a task counts at a time, and only of texts that the filter lets in."""
    monkeypatch.setattr(sj, "COUNTED", counted)
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choices("abcde", k=rng.randrange(30)))) for i in range(60)] + [(60, None), (61, ""), (None, "a b c d")]
    of = [sj.shingle_set(t) for _, t in rows]
    every, none = np.full(sj.FILTER_WORDS, (1 << 64) - 1, np.uint64), np.zeros(sj.FILTER_WORDS, np.uint64)
    count = Counter(t for s in of for t in sj._long(s))
    docs = frame(spark, rows)
    got = [r.token for r in sj.crowded_tokens(docs, every, sum(map(len, of))).collect()]
    want = {t for t, m in count.items() if m > sj.PAIRED}
    assert len(got) == len(want) > 0 and set(got) == want
    assert sj.crowded_tokens(docs, none, 0).collect() == [] and sj.crowded_tokens(docs.limit(0), every, 0).collect() == []


@pytest.mark.parametrize("k", [3, 5])
@pytest.mark.parametrize("together", [1, 1 << 18])
def test_sets_of_many_texts_are_those_of_each(monkeypatch, k, together):
    """Equal sets have equal hashes, different shingles different ones, wherever a text is cut into words."""
    monkeypatch.setattr(sj, "TOGETHER", together)
    rng = random.Random(4)
    texts = [None, "", " \n", "a", "A", "a b", "x" * 64 + " y z", "x" * 65 + " y z", "\0 a\0 \0a", "  p q\x0br\x1cs t u  ", "é É ü ß ñ"]
    texts += ["".join(rng.choices("abAB \t\n", k=rng.randrange(200))) for _ in range(200)]
    want = [{" ".join("".join(chr(c) for c in w) for w in s) for s in plain_shingles(t, k)} for t in texts]
    got = [s.tolist() for s in sj.shingle_sets(texts, k)]
    assert [len(s) for s in got] == [len(s) for s in want] and all(s == sorted(set(s)) for s in got)
    assert got == [sj.shingle_set(t, k).tolist() for t in texts]
    assert len({h for s in got for h in s}) == len(set().union(*want))
    assert len({(frozenset(w), tuple(s)) for w, s in zip(want, got, strict=True)}) == len({frozenset(w) for w in want})


def plain_shingles(text, k):
    w = [tuple(x) for x in (text or "").encode().lower().split()]
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def test_families_of_near_copies_meet_leaders_first(spark, monkeypatch):
    """Families whose pairs are a few times their rows: listing them grows with the square of a family."""
    rng, rows, turns = random.Random(8), [], []
    for f in range(12):
        words = [f"w{f}_{i}" for i in range(60)]
        for _ in range(8):
            copy = list(words)
            copy[rng.randrange(60)] = f"x{rng.randrange(10**9)}"
            rows.append((len(rows), " ".join(copy)))
    leader_pairs = sj.leader_pairs
    monkeypatch.setattr(sj, "leader_pairs", lambda rows, turn, rule: turns.append(turn) or leader_pairs(rows, turn, rule))
    assert result(spark, rows) == brute(rows)
    assert turns


def test_edges(spark):
    long = " ".join(str(i) for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a"), (5, "A"), (6, "a b"), (7, "a  B"), (8, long), (9, long + " x"), (10, "é É"), (11, "É é")]
    assert result(spark, rows) == brute(rows)
    assert result(spark, []) == [] and result(spark, [(1, None)]) == [(1, 0, 1)]
    got = result(spark, [(4, "x y z"), (4, "x y z"), (3, "x y z"), (4, "p q r")])
    assert got == [(3, 1, 3), (4, 1, 3), (4, 1, 3), (4, 1, 3)]
    got = result(spark, [(3, "x y z"), (4, "x y z"), (4, "p q r"), (2, "p q r"), (9, "x y z"), (9, "k l m"), (9, "n o p")])
    assert got == [(2, 1, 2), (3, 1, 2), (4, 1, 2), (4, 1, 2), (9, 1, 2), (9, 1, 2), (9, 1, 2)]
    odd = sj.jaccard_components(frame(spark, [(None, "x y z"), (3, "x y z"), (None, "solo text here")])).collect()
    assert sorted((tuple(r) for r in odd), key=str) == sorted([(None, 1, 3), (3, 1, 3), (None, 1, None)], key=str)


@pytest.mark.parametrize("full", [0, 1, 40])
def test_prefixes_meet_under_every_order(full):
    """Whatever the filter of late tokens lets through."""
    rng = np.random.default_rng(3)
    last = np.zeros(sj.FILTER_WORDS, np.uint64)
    for _ in range(full):
        last |= rng.integers(0, 1 << 64, sj.FILTER_WORDS, dtype=np.uint64) & rng.integers(0, 1 << 64, sj.FILTER_WORDS, dtype=np.uint64)
    for _ in range(300):
        n = int(rng.integers(1, 120))
        a = np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.95], rng.integers(0, 1 << 62, int(rng.integers(0, 4)), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if not len(b) or 100 * both < 90 * (len(a) + len(b) - both):
            continue
        for order in range(sj.ORDERS):
            p, q = (sj.ordered_prefix(s, order, sj.prefix_length(len(s)), sj._passes(last, s)).tolist() for s in (a, b))
            assert set(p) & set(q)
            # the first that they share leaves enough in both
            i, j = next((i, q.index(t)) for i, t in enumerate(p) if t in q)
            assert min(len(a) - i, len(b) - j) * 190 >= (len(a) + len(b)) * 90


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(140)] + [(i, i + 1) for i in range(400, 460)] + [(900, i) for i in range(901, 990)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {i: i for e in edges for i in e}
    for _ in range(500):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == {i: c for i, c in label.items() if i in got} and {i for a, b in edges if a != b for i in (a, b)} == set(got)


def test_one_of_each(spark):
    rows = [(5, "a b c d"), (2, "a b c d"), (9, "other words here now"), (7, None), (None, "a b c d"), (2, "a b c d")]
    kept = sj.one_of_each(frame(spark, rows))
    assert kept.columns == frame(spark, []).columns
    assert sorted([r.doc_id for r in kept.collect()], key=str) == [2, 7, 9]


def linked(rows, k, share):
    """Smallest id of each component, by all pairs."""
    sets = {}
    for i, t in rows:
        w = t.lower().split()
        sets[i] = {tuple(w)} if len(w) < k else {tuple(w[j : j + k]) for j in range(len(w) - k + 1)}
    label = {i: i for i in sets}
    links = [(a, b) for a, b in combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= share * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return label


def test_the_stage_links_five_words_at_four_fifths(spark):
    rows = [(i, t) for i, t in corpus(4) if t.split()]
    want, other = linked(rows, 5, 80), linked(rows, 3, 90)
    assert want != other
    got = {r.doc_id: r.component_id for r in sj.jaccard_components(frame(spark, rows), sj.STAGE).collect()}
    assert got == want
    assert sorted(r.doc_id for r in sj.one_of_each(frame(spark, rows)).collect()) == sorted(set(want.values()))


def test_one_row_of_each_group_stays(spark):
    """Repeated rows, rows without an id that copy others, and groups without any id."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    near = lambda t: t + " end"
    rows = [(2, a), (2, a), (5, a), (None, a), (None, near(a)), (None, b), (None, b), (None, near(b)), (8, near(c)), (None, c), (8, "only here"), (7, None)]
    kept = [(r.doc_id, r.text) for r in sj.one_of_each(frame(spark, rows)).collect()]
    assert len(kept) == 5 and {(2, a), (8, near(c)), (8, "only here"), (7, None)} < set(kept)
    assert [i for i, t in kept if t in (b, near(b))] == [None]


def test_runs_are_packed():
    """Steps of a sorted run come back whole, and a quarter of their bytes is zeros."""
    rng = np.random.default_rng(3)
    run = np.unique(rng.integers(5 << 54, 6 << 54, 300, dtype=np.uint64))
    for part in (run, run[:1], np.array([0, (1 << 64) - 1], np.uint64)):
        assert sj._unpacked(sj._packed(part)).view(np.uint64).tolist() == part.tolist()
    assert sj._packed(run).count(0) > 0.24 * 8 * len(run)
