"""Personal data against the plain patterns, and discovery by learned labels."""

import hashlib
import random
import re

from tillwork.llm import pii
from tillwork.llm.queries import QUERIES

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base(text):
    out = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


def check(rows, got):
    """Rows of a result against the plain patterns; returns the spans beyond them."""
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    more = {}
    for i, text in rows:
        want = base(text)
        r = by_id[i].pop()
        names = [f"{k}:{a}:{b}" for a, _, b, k in want]
        assert r.base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest(), (text or "")[:200]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for *_, k in want) for kind in PLAIN)
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if not s.startswith("context")] == names
        more[i] = [text[slice(*map(int, s.split(":")[1:]))] for s in spans if s.startswith("context")]
    return more


def test_queries(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
        got = QUERIES["op7_personal_data"](spark, sf).collect()
        assert len(got) == len(rows)
        more = check(rows, got)
    tokens = {i: re.findall(r'token = "([^"]*)"', t) for i, t in rows}
    assert more == tokens and any(tokens.values())


def test_odd_texts(spark):
    rng = random.Random(11)
    odd = [None, "", " ", "a@b.c@d.e", "a@b.co_x@y.zz", "a@b-c.d.-e", "x@y", "@a.b", "1.2.3.4.5.6.7.8", "256.1.1.1 0001.002.3.4", "1.2.3", "4539 1488 0343 6467", "4539-1488-0343-6467 1", "0" * 12, "+1 (743) 555-3824.", "+1 23", "++1 234 567 890", "é日\U0001f600 a@b.cd é 10.0.0.1", "a.b@" * 30, "12 " * 3000, "x" * 20_000 + "@", "1." * 50_000, "9" * 100_000, "+1" * 1000]
    for alphabet in ("a@.-1 ", "0123 -.", "+1 ().-2", "a1@.é_%+"):
        odd += ["".join(rng.choices(alphabet, k=rng.randint(1, 80))) for _ in range(150)]
    rows = list(enumerate(odd)) + [(None, "me@x.org"), (3, "a@b.c 1.1.1.1"), (3, "a@b.c 1.1.1.1")]
    rows = [r for r in rows if r[0] != 3 or r[1] == "a@b.c 1.1.1.1"]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, spans string, base string")
    check(rows, pii.personal_data(df).collect())
    assert pii.personal_data(df.limit(0)).collect() == []


def test_many_matches_in_one_text(spark):
    text = " ".join(f"u{i}@x.org" for i in range(20_000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    check([(1, text)], pii.personal_data(df).collect())


def test_labels_are_learned_from_seeds(spark):
    seeds = [f"user-mail: u{i}@site.org" for i in range(5)] + [f'key = "{hashlib.md5(b"%d" % i).hexdigest()}"' for i in range(5)]
    other = ["User-Mail:  root7.local", 'key = "plain-777"', "size: 123456", "room: 4711-22", "no label 1234567", "size: 654321"]
    rows = list(enumerate(seeds + other))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    more = check(rows, pii.personal_data(df).collect())
    found = {v for values in more.values() for v in values}
    assert {"root7.local", "plain-777"} <= found and not found & {"123456", "654321", "4711-22", "1234567"}
    assert not any(more[i] for i in range(5))


def test_rounds_reach_further(spark):
    """A value learned in one round vouches for another pattern in the next."""
    edges = [("a:", f"s{i}", True) for i in range(9)] + [("a:", "x1", False)]
    edges += [("b:", v, True) for v in ("s0", "s1", "s2", "s3")] + [("b:", "x1", False), ("b:", "x2", False)]
    df = spark.createDataFrame(edges, "pattern string, value string, seed boolean")
    once = {r.pattern for r in pii.trusted_patterns(df, rounds=1).collect()}
    assert once == {"a:"} and {r.pattern for r in pii.trusted_patterns(df).collect()} == {"a:", "b:"}


def test_masking(spark):
    rows = [(1, "mail a@b.cd or +1 (743) 555-3824, ip 1.2.3.4", 7), (2, "clean", 5), (3, None, None), (1, "other", 5), (None, "a@b.cd", 6)]
    df = spark.createDataFrame([(i, t, n, "z") for i, t, n in rows], "doc_id long, text string, n_chars long, spans string")
    got = pii.masked_documents(df)
    assert got.schema == df.schema
    assert sorted((tuple(r)[:3] for r in got.collect()), key=str) == sorted(
        [(1, "mail [EMAIL] or [PHONE], ip [IP]", 32), (2, "clean", 5), (3, None, None), (1, "other", 5), (None, "[EMAIL]", 7)], key=str
    )


def test_seeds_and_values_of_any_shape(spark):
    """Emails without a digit, phones with brackets, cards with spaces; letters-only and short values."""
    names = ["bob", "ann", "eve", "joe", "kim"]
    seeds = [f"Contact: {n}@example.com." for n in names]
    seeds += [f"tel: +1 (743) 555-382{i}" for i in range(5)]
    seeds += [f"card# {c}" for c in ("4539 1488 0343 6467", "4111 1111 1111 1111", "5500 0000 0000 0004", "3400 0000 0000 009")]
    other = ["contact: bobby_at_home, later", "tel: 5551", "card# none-x", "note: letters", "see: x1"]
    rows = list(enumerate(seeds + other))
    more = check(rows, pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert [v for values in more.values() for v in values] == ["bobby_at_home", "5551", "none-x"]
