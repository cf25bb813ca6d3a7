"""Documents whose word-shingle sets are nearly equal: an exact Jaccard join and its components.

Equal sets are one node.  Two nodes can only reach the threshold if they share a token among the
first few of each, under any order of all tokens, and so early in both that enough tokens are left.
So candidates must share prefix tokens under several different orders: pairs of nodes are listed for
the tokens of each order, and only pairs that every order lists are compared.  In every order the
tokens that crowds of texts share go last, so that near copies too differ at the front if they differ
enough.  What still meets in large groups is linked to leaders first: every node of a token is
compared with one of them, and nodes that links join already are not listed as pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm.common import WORD, query, stored, table
from tillwork.llm.components import components


class Rule(NamedTuple):
    """Words of a shingle; sets link when ``den`` * intersection >= ``num`` * union."""

    shingle: int = 3
    num: int = 90
    den: int = 100


#: the contract of op6_jaccard_join, and what stages on word shingles take
EXACT, STAGE = Rule(), Rule(5, 80, 100)
#: 64-bit words of the filters of nodes and tokens; one that is full only lets more through
FILTER_WORDS = 1 << 18
#: different orders of the tokens
ORDERS = 2
#: tokens of more texts go last
PAIRED = 6
#: leaders are sought until no more pairs than so many a row are left to list
LISTED = 2
#: some eight buckets of counted tokens hold so many
COUNTED = 1 << 20
#: pairs that are compared at a time
COMPARED = 50
#: bytes of texts that are cut into words at a time
TOGETHER = 1 << 18
#: bytes of the longest word that is hashed along with others
LONG = 64

_MULTIPLIERS = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
#: the first 0 to 8 bytes of eight
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: white space among the bytes
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _mixed(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """Another well-spread 64-bit value for each."""
    h = (h ^ np.uint64(salt)) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _word_hashes(raw: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: its length and its bytes, eight at a time.

    Words begin ``at`` in ``raw``, a whole number of eights that go on for two behind the last word.
    """
    eights = raw.view("<u8")
    h = size.astype(np.uint64) * _MULTIPLIERS[2]
    left = np.flatnonzero(size <= LONG)
    lo = 0
    while len(left):
        place = at[left] + lo
        shift = (place & 7).astype(np.uint64) << np.uint64(3)
        place >>= 3
        block = (eights[place] >> shift) | (eights[place + 1] << np.uint64(1) << (np.uint64(63) - shift))
        h[left] = _mixed(h[left] ^ (block & _FIRST[np.minimum(size[left] - lo, 8)]))
        lo += 8
        left = left[size[left] > lo]
    for i in np.flatnonzero(size > LONG).tolist():
        h[i] = xxhash.xxh64_intdigest(raw[at[i] : at[i] + size[i]].tobytes())
    return h


def _sets_together(texts: list[bytes], k: int) -> Iterator[np.ndarray]:
    length = np.array([len(t) for t in texts], np.int64)
    data = b" " + b" ".join(texts)
    raw = np.frombuffer(data.ljust((len(data) + 24) & ~7), np.uint8)
    blank = _BLANK[raw]
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    at, size = edges[::2], edges[1::2] - edges[::2]
    h = _word_hashes(raw, at, size)
    first = np.searchsorted(at, np.append(0, np.cumsum(length + 1)) + 1)
    n = max(0, len(h) - k + 1)
    mixed = h[:n] * _MULTIPLIERS[0]
    for i in range(1, k):
        mixed = _mixed(mixed + h[i : i + n] * _MULTIPLIERS[i % 3])
    bounds = first.tolist()
    for lo, hi in zip(bounds, bounds[1:], strict=False):
        mixed[lo : max(lo, hi - k + 1)].sort()
    fresh = np.append(True, mixed[1:] != mixed[:-1])[:n]
    fresh[first[:-1][first[:-1] < n]] = True
    for text, lo, hi in zip(texts, bounds, bounds[1:], strict=False):
        if 0 < hi - lo < k:
            yield np.array([xxhash.xxh64_intdigest(b" ".join(text.split()), hi - lo)], np.uint64)
        else:
            end = max(lo, hi - k + 1)
            yield mixed[lo:end][fresh[lo:end]]


def shingle_sets(texts: Iterable[str | None], k: int = EXACT.shingle) -> Iterator[np.ndarray]:
    """For each text, sorted 64-bit hashes of the distinct runs of ``k`` words; of all words if there are fewer.

    Words are runs of anything but ASCII white space, A-Z in lower case.  Texts are cut into words some
    ``TOGETHER`` bytes at a time, a longer one alone.
    """
    some, size = [], 0
    for text in texts:
        some.append((text or "").encode().lower())
        size += len(some[-1])
        if size > TOGETHER:
            yield from _sets_together(some, k)
            some, size = [], 0
    if some:
        yield from _sets_together(some, k)


def shingle_set(text: str | None, k: int = EXACT.shingle) -> np.ndarray:
    """The set of one text, see ``shingle_sets``."""
    return next(shingle_sets([text], k))


def prefix_length(n: int, num: int = EXACT.num, den: int = EXACT.den) -> int:
    """So many tokens of a set of ``n`` hold one of any set that links with it, in any order."""
    return n - -(-num * n // den) + 1


def ordered_prefix(tokens: np.ndarray, order: int, length: int, last: np.ndarray | None = None) -> np.ndarray:
    """The first ``length`` tokens in the order of their hash; those where ``last`` is true come after the others.

    The hash names the token; equal hashes are equal tokens but for a chance of 2**-63.
    """
    key = _mixed(tokens, order) >> np.uint64(1)
    if last is not None:
        key |= last.astype(np.uint64) << np.uint64(63)
    first = np.partition(key, length - 1)[:length] if length < len(key) else key
    first.sort()
    return first


def _long(values: np.ndarray) -> list[int]:
    return values.view(np.int64).tolist()


def _mapped(df: DataFrame, make, schema: str) -> DataFrame:
    """``make`` turns a batch's rows, a few hundred at a time, into rows of ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    whole = StructType.fromDDL(schema)
    arrow = to_arrow_schema(whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for small in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                yield pa.RecordBatch.from_pydict(make(small), schema=arrow)
            # what a batch of texts took goes back before the worker rests
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, whole)


def sets(docs: DataFrame, rule: Rule = EXACT) -> DataFrame:
    """(doc_id, n, s1, s2, tokens) of each row: set size, a 128-bit digest, a prefix by hash alone."""

    def make(batch: pa.RecordBatch) -> dict:
        of = list(shingle_sets(batch.column("text").to_pylist(), rule.shingle))
        digest = [divmod(xxhash.xxh3_128_intdigest(s.tobytes()), 1 << 64) for s in of]
        s1, s2 = np.array(digest, np.uint64).reshape(-1, 2).view(np.int64).T
        tokens = [_long(_prefix(s, 0, rule)) for s in of]
        return {"doc_id": batch.column("doc_id"), "n": [len(s) for s in of], "s1": s1, "s2": s2, "tokens": tokens}

    return _mapped(_texts(docs), make, "doc_id long, n long, s1 long, s2 long, tokens array<long>")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "text")


def _prefix(s: np.ndarray, order: int, rule: Rule, last: np.ndarray | None = None) -> np.ndarray:
    return ordered_prefix(s, order, prefix_length(len(s), rule.num, rule.den), last) if len(s) else s


def _packed(run: np.ndarray) -> bytes:
    """A sorted run by its steps, first all lowest bytes, last all highest: those are zeros, which the shuffle's codec takes out."""
    return np.diff(run, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64).view(np.int64)


def crowded_tokens(docs: DataFrame, crowds: np.ndarray, n_tokens: int, rule: Rule = EXACT) -> DataFrame:
    """(token) of more than ``PAIRED`` of the texts that have a token of the filter ``crowds`` in their prefix.

    The whole texts count.  Nearly all tokens are of one text, so they do not travel as rows: a task
    counts some ``COUNTED`` / 4 at a time and hands on sorted runs of them, one for each bucket of the
    first bits.  The buckets grow in number with ``n_tokens``, those of all texts, so that each fits a task.
    """
    bits = (n_tokens // COUNTED).bit_length() + 3

    def runs(kept: list[np.ndarray]) -> pa.RecordBatch:
        token, m = np.unique(np.concatenate(kept), return_counts=True)
        bucket, first = np.unique(token >> np.uint64(64 - bits), return_index=True)
        ends = np.append(first, len(token)).tolist()
        cuts = list(zip(ends, ends[1:], strict=False))
        columns = [[_packed(token[lo:hi]) for lo, hi in cuts], [m[lo:hi].astype(np.int64).tobytes() for lo, hi in cuts]]
        return pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int64)), *map(pa.array, columns)], ["bucket", "tokens", "counts"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0
        for batch in batches:
            for s in shingle_sets((text.as_py() for text in batch.column(0)), rule.shingle):
                if len(s) and _passes(crowds, _prefix(s, 0, rule)).any():
                    kept.append(s)
                    size += len(s)
                    if size > COUNTED // 4:
                        yield runs(kept)
                        kept, size = [], 0
        if kept:
            yield runs(kept)

    def crowded(tokens: list[bytes], counts: list[bytes]) -> pa.RecordBatch:
        token, m = np.concatenate([_unpacked(t) for t in tokens]), np.frombuffer(b"".join(counts), np.int64)
        order = np.argsort(token, kind="stable")
        token, m = token[order], m[order]
        first = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        return pa.RecordBatch.from_arrays([pa.array(token[first][np.add.reduceat(m, first) > PAIRED])], ["token"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tokens, counts = None, [], []
        for batch in batches:
            for bucket, token, m in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if bucket != now and tokens:
                    yield crowded(tokens, counts)
                    tokens, counts = [], []
                now = bucket
                tokens.append(token)
                counts.append(m)
        if tokens:
            yield crowded(tokens, counts)

    by_bucket = docs.select("text").mapInArrow(sort, "bucket long, tokens binary, counts binary").repartition("bucket").sortWithinPartitions("bucket")
    return by_bucket.mapInArrow(count, "token long")


def prefix_rows(docs: DataFrame, last: np.ndarray, rule: Rule = EXACT) -> DataFrame:
    """(doc_id, n, tokens): prefixes with the tokens of the filter last, in order, one list an order.

    Texts without words and rows without an id are left out.
    """

    def make(batch: pa.RecordBatch) -> dict:
        out = {"doc_id": [], "n": [], "tokens": []}
        of = list(shingle_sets(batch.column("text").to_pylist(), rule.shingle))
        late = np.split(_passes(last, np.concatenate(of)), np.cumsum([len(s) for s in of])[:-1])
        for doc_id, s, some in zip(batch.column("doc_id").to_pylist(), of, late, strict=True):
            if len(s):
                out["doc_id"].append(doc_id)
                out["n"].append(len(s))
                out["tokens"].append([_long(_prefix(s, o, rule, some)) for o in range(ORDERS)])
        return out

    return _mapped(_texts(docs).where("doc_id is not null"), make, "doc_id long, n long, tokens array<array<long>>")


def _token_counts(tokens: Column, df: DataFrame) -> DataFrame:
    return df.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count("*").alias("m"))


def _spot(values: np.ndarray, k: int) -> np.ndarray:
    """The bit place with number ``k``, 0 to 2, of each value in a filter, whose size is a power of two."""
    return (_mixed(values, 77 + k) & np.uint64(64 * FILTER_WORDS - 1)).astype(np.int64)


def bit_filter(df: DataFrame, column: str) -> np.ndarray:
    """A Bloom filter of a column of longs in ``FILTER_WORDS`` words.

    Each task sends the words that it sets, never more than there are.
    """
    schema = pa.schema([("word", pa.int64()), ("bits", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(FILTER_WORDS, np.uint64)
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for spot in (_spot(values, k) for k in range(3)):
                np.bitwise_or.at(words, spot >> 6, np.uint64(1) << (spot & 63).astype(np.uint64))
        used = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(words[used].view(np.int64))], schema=schema)

    rows = df.select(column).mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(FILTER_WORDS, np.int64)
    words[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return words.view(np.uint64)


def _passes(words: np.ndarray, values: np.ndarray) -> np.ndarray:
    # most values fail at their first place
    left = np.arange(len(values))
    for k in range(3):
        spot = _spot(values[left], k)
        left = left[(words[spot >> 6] >> (spot & 63).astype(np.uint64)) & np.uint64(1) == 1]
    inside = np.zeros(len(values), bool)
    inside[left] = True
    return inside


def shared_tokens(prefixes: DataFrame, own: DataFrame) -> DataFrame:
    """(node, n, spots of token, o, pos): the nodes in ``own`` with the prefix tokens that several rows have, and their places.

    Most tokens are of one row.  Those of several are found by counting, and a filter of them keeps
    the rest out.  A node is one row with a list no longer than its prefixes: what is said of nodes
    meets them once, not once a token.
    """
    words = bit_filter(_token_counts(F.flatten("tokens"), prefixes).where("m > 1"), "token")

    def make(batch: pa.RecordBatch) -> dict:
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(3)]
        ends = [0]
        for of_node in batch.column("tokens"):
            ends.append(ends[-1])
            for o, of in enumerate(of_node.values):
                token = of.values.to_numpy()
                pos = np.flatnonzero(_passes(words, token.view(np.uint64)))
                ends[-1] += len(pos)
                for column, part in zip(out, (token[pos], np.full(len(pos), o), pos), strict=True):
                    column.append(part)
        spot = pa.StructArray.from_arrays([np.concatenate(c) for c in out], ["token", "o", "pos"])
        return {"node": batch.column("doc_id"), "n": batch.column("n"), "spots": pa.ListArray.from_arrays(ends, spot)}

    rows = _mapped(prefixes, make, "node long, n long, spots array<struct<token long, o long, pos long>>")
    # one document can have several sets, or one set in several rows
    return rows.where("size(spots) > 0").join(own, ["node", "n"], "left_semi").distinct()


def texts_of(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, text) of the documents in ``pairs``; a filter of them spares the others the shuffle."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    words = bit_filter(nodes, "node")

    def make(batch: pa.RecordBatch) -> dict:
        some = batch.filter(pa.array(_passes(words, batch.column("doc_id").to_numpy().view(np.uint64))))
        return {"node": some.column("doc_id"), "text": some.column("text")}

    known = _texts(docs).where("doc_id is not null and text is not null")
    # rows can be repeated
    return _mapped(known, make, "node long, text string").join(nodes, "node", "left_semi").distinct()


def _enough_left(a: str, b: str, rule: Rule) -> Column:
    """Whether the sets can link if the token here is the first that they share.

    The token and all behind it, in the set where that is less, must make up the intersection.
    """
    left = F.least(F.col(f"{a}n") - F.col(f"{a}pos"), F.col(f"{b}n") - F.col(f"{b}pos"))
    return left * (rule.num + rule.den) >= (F.col(f"{a}n") + F.col(f"{b}n")) * rule.num


def _all_orders(met: DataFrame) -> DataFrame:
    """The pairs (a, b) of ``met`` (o, a, b) that meet under every order."""
    seen = met.groupBy("a", "b").agg(*[F.max((F.col("o") == o).cast("int")).alias(f"o{o}") for o in range(ORDERS)])
    for o in range(ORDERS):
        seen = seen.where(f"o{o} = 1")
    return seen.select("a", "b")


def _sides(rows: DataFrame, prefix: str, *columns: str) -> DataFrame:
    return rows.select(*columns, *[F.col(c).alias(prefix + c) for c in ("node", "n", "pos", "part")])


def open_tokens(shared: DataFrame, parts: DataFrame | None) -> DataFrame:
    """A row for each spot of ``shared`` with ``part``, the smallest node that links reach, of tokens that meet in several parts."""
    nodes = shared.withColumn("part", F.col("node"))
    if parts is not None:
        nodes = shared.join(parts.withColumnRenamed("component", "part"), "node", "left").withColumn("part", F.coalesce("part", "node"))
    rows = nodes.select("node", "n", "part", F.inline("spots"))
    several = rows.groupBy("token").agg(F.min("part").alias("x"), F.max("part").alias("y")).where("x < y").select("token")
    return rows.join(several, "token", "left_semi")


def pairs_to_list(rows: DataFrame) -> tuple[int, int]:
    """(pairs of nodes of different parts that share a token, rows)."""
    of_part = rows.groupBy("token", "part").agg(F.count("*").cast("decimal(38,0)").alias("m"))
    of_token = of_part.groupBy("token").agg(F.sum("m").alias("m"), F.sum(F.col("m") * F.col("m")).alias("own"))
    found = of_token.agg(F.sum((F.col("m") * F.col("m") - F.col("own")) / 2), F.sum("m")).first()
    return int(found[0] or 0), int(found[1] or 0)


def leader_pairs(rows: DataFrame, turn: int, rule: Rule = EXACT) -> DataFrame:
    """(a, b): the nodes of each token, each with one of them.

    At first it is the one that has the token earliest, which has the fewest tokens of its own, and
    then one by hash.
    """
    order = [F.col("pos")] if turn == 0 else [F.xxhash64(F.lit(turn), "part")]
    first = rows.groupBy("token").agg(F.min(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)], "node", "n", "pos", "part")).alias("l"))
    right = first.select("token", *[F.col(f"l.{c}").alias(f"b_{c}") for c in ("node", "n", "pos", "part")])
    met = _sides(rows, "a_", "token", "o").join(right, "token").where((F.col("a_part") != F.col("b_part")) & _enough_left("a_", "b_", rule))
    return _all_orders(met.select("o", F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")))


def listed_pairs(rows: DataFrame, rule: Rule = EXACT) -> DataFrame:
    """(a, b): all pairs of nodes of different parts that meet early enough under every order."""
    met = _sides(rows, "a_", "token", "o").join(_sides(rows, "b_", "token"), "token")
    met = met.where((F.col("a_node") < F.col("b_node")) & (F.col("a_part") != F.col("b_part")) & _enough_left("a_", "b_", rule))
    return _all_orders(met.select("o", F.col("a_node").alias("a"), F.col("b_node").alias("b")))


def verified(pairs: DataFrame, texts: DataFrame, rule: Rule = EXACT) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("a_text"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("b_text"))

    def make(batch: pa.RecordBatch) -> dict:
        out = {"a": [], "b": []}
        for some in (batch.slice(i, COMPARED) for i in range(0, batch.num_rows, COMPARED)):
            a, b, x, y = (some.column(c).to_pylist() for c in ("a", "b", "a_text", "b_text"))
            # leaders come up again and again
            texts = list(dict.fromkeys(x + y))
            set_of = dict(zip(texts, shingle_sets(texts, rule.shingle), strict=True))
            for i in range(len(a)):
                own, other = set_of[x[i]], set_of[y[i]]
                common = len(np.intersect1d(own, other, assume_unique=True))
                if common * rule.den >= (len(own) + len(other) - common) * rule.num and common:
                    out["a"].append(a[i])
                    out["b"].append(b[i])
        return out

    whole = pairs.join(left, "a").join(right, "b").select("a", "b", "a_text", "b_text")
    return _mapped(whole, make, "a long, b long")


def linked(docs: DataFrame, shared: DataFrame, rule: Rule = EXACT) -> DataFrame:
    """(a, b): links between nodes of ``shared``, enough to join all that their links join.

    Nodes are compared with leaders in turns, for as long as a turn takes a quarter off the pairs left
    to list; what is left then is listed.
    """
    found, parts, before = [], None, None
    while True:
        rows = stored(open_tokens(shared, parts), "shingle-open")
        left, size = pairs_to_list(rows)
        last = left <= LISTED * size or before is not None and left > before * 3 // 4
        before = left
        pairs = stored(listed_pairs(rows, rule) if last else leader_pairs(rows, len(found), rule), "shingle-pairs")
        found.append(stored(verified(pairs, texts_of(docs, pairs), rule), "shingle-links"))
        links = reduce(DataFrame.unionByName, found)
        if last:
            return links
        parts = components(links)
        # parts only grow, so a node whose tokens are all of one part stays out from here on
        shared = stored(shared.join(rows.select("node").distinct(), "node", "left_semi"), "shingle-shared")


def _same_document(placed: DataFrame) -> DataFrame:
    """(a, b): the nodes of the sets of one document, linked to the smallest of them."""
    several = placed.where("doc_id is not null and node is not null").groupBy("doc_id").agg(
        F.min("node").alias("a"), F.max("node").alias("most")
    )
    return placed.join(several.where("a < most").drop("most"), "doc_id").where("node > a").select("a", F.col("node").alias("b"))


def jaccard_components(docs: DataFrame, rule: Rule = EXACT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs`` (doc_id, text).

    Two documents link when their sets of distinct shingles reach the threshold of ``rule``;
    component_id is the smallest doc_id that links reach.  A text with fewer words than a shingle
    has them as its only one; null texts and those without words have none and link with
    nothing.  Rows that share a doc_id count as one document with several sets.  A null doc_id gets
    the component of its set, null if no other row has that set.  Other columns are left behind.
    """
    rows = stored(sets(docs, rule), "shingle-sets")
    crowds = bit_filter(_token_counts(F.col("tokens"), rows).where(F.col("m") > PAIRED), "token")
    n_tokens = rows.agg(F.sum("n")).first()[0] or 0
    late = bit_filter(crowded_tokens(docs, crowds, n_tokens, rule), "token")
    rows = rows.drop("tokens")
    classes = stored(
        rows.where("n > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("node"), F.first("n").alias("n")).where("node is not null"),
        "shingle-classes",
    )
    prefixes = stored(prefix_rows(docs, late, rule), "shingle-prefixes")
    shared = stored(shared_tokens(prefixes, classes.select("node", "n")), "shingle-shared")
    placed = rows.join(classes.drop("n"), ["s1", "s2"], "left")
    links = linked(docs, shared, rule)
    parts = components(links.unionByName(_same_document(placed)))
    return placed.join(parts, "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "node", "doc_id").alias("component_id"),
    )


def one_of_each(docs: DataFrame, rule: Rule = STAGE) -> DataFrame:
    """One row of each group of equal or near texts: that with the smallest doc_id, null last.

    Texts are the nodes, named by a 64-bit hash, so that rows without an id take part and repeated
    rows are one; two different texts have the same name with a chance of 2**-64.  Among rows of a
    group with the same doc_id, the smallest hash of the text stays, then the smallest row.  Rows
    that share a doc_id but not a text are not linked by it.  Texts without words link with nothing;
    of equal rows without words one stays.  All columns must be of types that can be ordered.
    """
    has_words = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    keyed = docs.where(has_words).withColumn("_text", F.xxhash64("text"))
    # a third of the rows can be copies of one text: minima before anything meets in a join
    ids = keyed.groupBy("_text").agg(F.min("doc_id").alias("_id"))
    texts = keyed.select(F.col("_text").alias("doc_id"), "text")
    groups = jaccard_components(texts, rule).select(F.col("doc_id").alias("_text"), "component_id").distinct()
    order = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_text").alias("text"))
    kept = ids.join(groups, "_text").groupBy("component_id").agg(F.min(order)["text"].alias("_text"))
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    row = F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "text", *others)
    best = keyed.groupBy("_text").agg(F.min(row).alias("_row")).join(kept, "_text", "left_semi")
    return best.select("_row.*").select(docs.columns).unionByName(docs.where(~has_words).distinct())


SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s
    FROM w),
n AS (SELECT doc_id, len(s)::BIGINT AS n FROM s),
t AS (SELECT doc_id, unnest(s) AS t FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM t a JOIN t b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * i >= 90 * (x.n + y.n - i)),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT doc_id, n AS n_shingles, min(b) AS component_id FROM n JOIN r ON doc_id = a GROUP BY doc_id, n
"""


@query("op6_jaccard_join", SQL)
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of nearly equal documents."""
    return jaccard_components(table(spark, sf_dir, "documents"))
