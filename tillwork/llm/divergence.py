"""How far each source's words are from those of the other sources of its language.

Terms are counted in each (lang, source) and smoothed to shares p of 1,000,000,000.  Terms with the
same counts have the same shares, so the measure is worked out for cells of equal counts and weighed
by the number of terms in them; only the cells that reach the report are expanded to terms again.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwork.llm.common import query, stored, table

#: a share of 1
UNIT = 1_000_000_000
#: distinct (lang, source, term) that a task keeps before it hands its counts on
REMEMBERED = 200_000
#: cells of a language that are compared at a time
PACK = 2048
#: most (lang, source) that are broadcast; more meet the cells in shuffled joins
BROADCAST_GROUPS = 200_000

# a term is a run of ASCII letters and characters beyond ASCII; in UTF-8 those are bytes from 0x80 up
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, n_docs) of the rows of ``docs``; a row of null term for every (lang, source).

    Every row of ``docs`` is a document, also one that repeats another or lacks an id.  A task adds
    up what it reads, so a frequent term leaves it as one row.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, dict[bytes, list[int]]] = defaultdict(dict)
        held = 0

        def flushed() -> pa.RecordBatch:
            rows = [(l, s, t, c[0], c[1]) for (l, s), terms in sums.items() for t, c in terms.items()]
            rows += [(l, s, None, 0, 0) for l, s in sums]
            langs, sources, terms, ns, docs = zip(*rows, strict=True)
            names = ["lang", "source", "term", "n", "n_docs"]
            terms = pa.array(terms, pa.binary()).cast(pa.string(), safe=False)
            columns = [pa.array(langs, pa.string()), pa.array(sources, pa.string()), terms]
            return pa.RecordBatch.from_arrays([*columns, pa.array(ns, pa.int64()), pa.array(docs, pa.int64())], names)

        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            pairs = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
            for pair, text in zip(pairs, texts, strict=True):
                terms = sums[pair]
                seen: dict[bytes, int] = {}
                for term in text.as_py().translate(_TERM_BYTES).split():
                    seen[term] = seen.get(term, 0) + 1
                before = len(terms)
                for term, n in seen.items():
                    if term in terms:
                        both = terms[term]
                        both[0] += n
                        both[1] += 1
                    else:
                        terms[term] = [n, 1]
                held += len(terms) - before
                if held >= REMEMBERED:
                    yield flushed()
                    sums.clear()
                    held = 0
        if sums:
            yield flushed()

    filled = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    parts = filled.mapInArrow(count, "lang string, source string, term string, n long, n_docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (n + 2) / (total + 2 * terms)), exact for counts of any size."""
    wide = "decimal(20,0)"
    part = F.lit(UNIT).cast("decimal(10,0)") * (n.cast(wide) + F.lit(2).cast(wide))
    whole = total.cast(wide) + F.lit(2).cast(wide) * terms.cast(wide)
    return F.call_function("div", part, whole) + 1


def distance(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); at most UNIT squared, which a long holds."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def top_terms(own: DataFrame, langs: DataFrame, groups: DataFrame, most: int) -> DataFrame:
    """(lang, source, item, value, rank): the terms that a source uses more than its language does.

    ``own`` (lang, source, term, n, lang_n) holds the kept terms of each source.
    """
    group = ["lang", "source"]
    cells = own.groupBy(*group, "n", "lang_n").agg(F.count(F.lit(1)).alias("terms"))
    sized = cells.join(groups, group).join(langs, "lang")
    p, q = share(F.col("n"), F.col("total"), F.col("v")), share(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    above = sized.select(*group, "n", "lang_n", "terms", p.alias("p"), q.alias("q")).where("p > q")
    valued = above.select(*group, "n", "lang_n", "terms", distance(F.col("p"), F.col("q")).alias("value"))
    # cells of equal value are one place; of each group the first ``most`` values are enough
    by_value = Window.partitionBy(*group).orderBy(F.desc("value"))
    merged = valued.groupBy(*group, "value").agg(F.sum("terms").alias("terms"))
    first = merged.withColumn("place", F.row_number().over(by_value)).where(F.col("place") <= most)
    before = F.sum("terms").over(by_value.rowsBetween(Window.unboundedPreceding, -1))
    reached = first.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < most)
    chosen = valued.drop("terms").join(reached.select(*group, "value"), [*group, "value"])
    # the filter on the number leaves each task at most ``most`` rows of a group before the shuffle
    order = Window.partitionBy(*group).orderBy(F.desc("value"), "item")
    items = own.join(chosen, [*group, "n", "lang_n"]).select(*group, F.col("term").alias("item"), "value")
    return items.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * (counts + 2) / totals) by long division in steps of 1,000, which 64 bits hold."""
    rest = counts + 2
    out = np.zeros_like(rest)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, totals)
        out = out * 1000 + digit
    return out + 1


def source_pairs(own: DataFrame, langs: DataFrame, groups: DataFrame, n_groups: int) -> DataFrame:
    """(lang, source, item, value): the distance of every two sources of a language over its kept terms.

    Terms with the same counts in all sources are one cell.  Cells travel in packs, and each pack
    meets the sources of its language once; the sums of a task are one number for two sources.
    """

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if n_groups <= BROADCAST_GROUPS else df

    numbered = groups.withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    lists = numbered.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "total"))).alias("sources"))
    sources = lists.join(langs.select("lang", "v"), "lang", "left").select(
        "lang", F.coalesce("v", F.lit(0)).alias("v"), F.col("sources.total").alias("totals")
    )
    # a term has at most one count from each source
    vectors = (
        own.join(small(numbered.select("lang", "source", "at")), ["lang", "source"])
        .groupBy("lang", "term")
        .agg(F.sort_array(F.collect_list(F.struct("at", "n"))).alias("counts"))
    )
    cells = stored(vectors.groupBy("lang", "counts").agg(F.count(F.lit(1)).alias("terms")), "divergence-cells")
    packs_of = cells.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / PACK).alias("packs"))
    packs = (
        cells.join(small(packs_of), "lang")
        .withColumn("pack", F.pmod(F.xxhash64("counts"), F.col("packs")))
        .groupBy("lang", "pack")
        .agg(F.collect_list(F.struct(F.col("counts.at").alias("at"), F.col("counts.n").alias("n"), "terms")).alias("cells"))
    )
    # a language without kept terms has no pack, but its sources are listed all the same
    columns = ["lang", "v", "totals", "cells"]
    whole = packs.join(small(sources), "lang").select(*columns)
    whole = whole.unionByName(sources.select("*", F.lit(None).cast(packs.schema["cells"].dataType).alias("cells")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                size = len(row["totals"])
                value = sums.setdefault(row["lang"], np.zeros((size, size), np.int64))
                packed = row["cells"] or []
                if not packed:
                    continue
                counts = np.zeros((len(packed), size), np.int64)
                for k, cell in enumerate(packed):
                    counts[k, cell["at"]] = cell["n"]
                terms = np.array([c["terms"] for c in packed], np.int64)
                p = _shares(counts, np.array(row["totals"], np.int64) + 2 * row["v"])
                for a in range(size):
                    gap = p - p[:, a : a + 1]
                    value[a] += (gap * gap // (p + p[:, a : a + 1]) * terms[:, None]).sum(axis=0)
        for lang, value in sums.items():
            a, b = np.nonzero(~np.eye(len(value), dtype=bool))
            for k in range(0, len(a), 100_000):
                x, y = a[k : k + 100_000], b[k : k + 100_000]
                columns = [pa.array([lang] * len(x), pa.string()), pa.array(x), pa.array(y), pa.array(value[x, y])]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "a", "b", "value"])

    parts = whole.mapInArrow(compare, "lang string, a long, b long, value long")
    sums = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    one = numbered.select("lang", F.col("at").cast("long").alias("a"), "source")
    other = numbered.select("lang", F.col("at").cast("long").alias("b"), F.col("source").alias("item"))
    return sums.join(one, ["lang", "a"]).join(other, ["lang", "b"]).select("lang", "source", "item", "value")


def audit(docs: DataFrame, least_docs: int = 10, most: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank): distances to the other sources, and telling terms.

    ``docs`` needs text, lang and source; nulls count as '', other columns are left behind.  A
    language keeps the terms that at least ``least_docs`` of its documents hold.  Part ``pair`` ranks
    the other sources of the language by their distance over all kept terms, 0 if there are none;
    part ``term`` ranks the first ``most`` kept terms whose share in the source is above that in the
    language.  Equal values rank by the UTF-8 of the item.  A source without terms has pairs alone, the
    only source of a language terms alone; an empty table gives no rows.  Counts are exact up to
    9 * 10^15 terms in a language.
    """
    counts = stored(term_counts(docs), "divergence-counts")
    words = counts.where("term is not null")
    kept = (
        words.groupBy("lang", "term")
        .agg(F.sum("n").alias("lang_n"), F.sum("n_docs").alias("n_docs"))
        .where(F.col("n_docs") >= least_docs)
        .drop("n_docs")
    )
    own = stored(words.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "divergence-terms")
    # every kept term occurs in some source of its language
    terms = own.select("lang", "term", "lang_n").distinct()
    langs = terms.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count(F.lit(1)).alias("v"))
    totals = own.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (
        counts.where("term is null").select("lang", "source")
        .join(totals, ["lang", "source"], "left")
        .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"))
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    n_groups = counts.where("term is null").count()
    pairs = source_pairs(own, langs, groups, n_groups).withColumn("rank", F.row_number().over(by_value))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    telling = top_terms(own, langs, groups, most).withColumn("part", F.lit("term"))
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(telling.select(*columns))


SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
words AS (
  SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
langs AS (
  SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
own AS (
  SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN langs USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, sum(n)::HUGEINT AS total, count(*) AS v FROM langs GROUP BY lang),
groups AS (
  SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN own USING (lang, source) GROUP BY lang, source),
shares AS (
  SELECT lang, source, term, coalesce(o.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(o.n, 0) + 2)) // (g.total + 2 * s.v) AS p,
         1 + (1000000000::HUGEINT * (l.n + 2)) // (s.total + 2 * s.v) AS q
  FROM groups g JOIN langs l USING (lang) JOIN sizes s USING (lang) LEFT JOIN own o USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL),
every_pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value
  FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
  FROM (SELECT * FROM every_pair UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""


@query("op13_source_divergence", SQL)
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source of the documents against the other sources of its language."""
    return audit(table(spark, sf_dir, "documents"))
