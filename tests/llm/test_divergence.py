"""Source divergence: the SQL check, and plain Python over edges."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tillwork.llm import divergence as dv
from tillwork.llm.queries import QUERIES


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(same, sf):
    assert same("op13_source_divergence", f"/root/testdata/{sf}") == []


TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, most):
    """Rows (text, lang, source) to the audit's rows."""
    count, docs, groups = defaultdict(Counter), Counter(), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        terms = TERM.findall((text or "").translate(LOWER))
        count[lang, source].update(terms)
        docs.update((lang, t) for t in set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for la, t in docs if la == lang and docs[la, t] >= least]
        whole = Counter()
        for s in sources:
            whole.update(count[lang, s])

        def share(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        p, q = {s: share(count[lang, s]) for s in sources}, share(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pair = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            term = [(t, f(p[s][t], q[t])) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, items, last in (("pair", pair, None), ("term", term, most)):
                ranked = sorted(items, key=lambda r: (-r[1], r[0].encode()))[:last]
                out += [(lang, s, part, i, v, k) for k, (i, v) in enumerate(ranked, 1)]
    return sorted(out)


def test_edges(spark, folder):
    """Nulls, empty and very long texts, ties beyond the tenth rank, repeats, clashing columns."""
    ties = " ".join("t" + chr(97 + i) + chr(97 + j) for i in range(26) for j in range(3))
    rows = [
        *[(ties, "a", "s1")] * 12, *[("Common Common words", "a", "s2")] * 15, ("ÄÖ\x80 É É İ x1y_z{q", "a", "s3"),
        (None, "a", "s4"), ("", None, "s1"), ("no term kept here", None, None), (None, None, None), ("12 34", "b", "s1"),
        *[("É \U0001f600\U0001f600 common " * 3, "a", s) for s in ("s3", "s5", None, "s1")] * 4,
        ("long Words " * 40_000, "a", "s5"), ("words", "a", "s퟿"), ("words", "a", "s\U0001f600"), ("words", "a", "s～"),
    ]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, source string, n int, term string")
    got = sorted(tuple(r) for r in QUERIES["op13_source_divergence"](spark, folder(documents=df)).collect())
    assert got == plain(rows, 10, 10)
    assert sorted(map(tuple, dv.audit(df, least_docs=1, most=3).collect())) == plain(rows, 1, 3)
    assert dv.audit(df.limit(0)).collect() == []


def test_small_memory(spark, monkeypatch):
    """Counts handed on early add up to the same."""
    rows = [(f"w{chr(97 + i % 26)} x{chr(97 + i % 7)}", "l", f"s{i % 3}") for i in range(500)]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    monkeypatch.setattr(dv, "REMEMBERED", 10)
    monkeypatch.setattr(dv, "PACK", 4)
    assert sorted(map(tuple, dv.audit(df).collect())) == plain(rows, 10, 10)


def test_large_counts():
    counts, totals = np.array([[0, 10**12, 8 * 10**15]]), np.array([5 * 10**10, 10**12 + 77, 9 * 10**15])
    want = [[1 + 10**9 * (int(c) + 2) // int(t) for c, t in zip(counts[0], totals, strict=True)]]
    assert dv._shares(counts, totals).tolist() == want
