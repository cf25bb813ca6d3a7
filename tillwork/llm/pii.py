"""Personal data: fixed patterns, and fields that bootstrapped contextual extraction finds.

Fixed patterns find emails, IP addresses, card and phone numbers.  Other identifiers are found by
what stands before them.  Seed entities - values with the shape of a fixed pattern or of a key -
induce lexical patterns, the label and delimiter on their left.  Patterns and values form a graph;
in rounds, a pattern is trusted by the share of its values that are known, and a value becomes known
by the patterns that point at it.  Trusted patterns then discover values of any shape.  Everything is
an expression over columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm.common import query, stored, table

# The expressions below find what these say, leftmost and non-overlapping:
#   email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip     [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   card   [0-9]([\x20-]?[0-9])+
#   phone  \+[0-9][\x20().0-9-]+[0-9]
# A run that fails from its first character fails from any later one, so a search begins only at
# the start of a run or where the last match ended; possessive loops never go back.  Both keep the
# time linear and the stack flat on very long runs.
KINDS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
RANK = {kind: i for i, kind in enumerate([*KINDS, "context"])}

#: a lexical pattern: a label, a delimiter, maybe an opening mark, right before the value
_LABEL = r"""[\p{L}][\p{L}0-9_-]{0,30}\s{0,2}[:=#]\s{0,2}["'(<\[]?"""
LABEL = rf"({_LABEL})$"
#: a value that a pattern may point at: the token after its delimiter, of whatever characters; what
#: encloses, ends or begins another field does not belong to it
TOKEN = rf"""(?<![\p{{L}}0-9_-]){_LABEL}[^\s"'()<>\[\]{{}},;:=#]++"""
LABEL_REACH = 40
#: keys and digests: long, with letters and digits mixed
KEY_SHAPE = r"^(?=[0-9]*[A-Za-z])(?=[A-Za-z]*[0-9])[A-Za-z0-9]{20,}$"

ROUNDS = 3
TRUST = 0.8
#: a pattern needs so many different known values
SUPPORT = 3

_SPAN = "array<struct<start:int,rank:int,stop:int>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running_sums(numbers: Column, block: int = 64) -> Column:
    """Inclusive running sums of a non-empty array; sums of blocks keep long arrays cheap."""

    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0), lambda x, y: x + y)

    def of_blocks(parts: Column) -> Column:
        return _let(
            F.transform(parts, total),
            lambda sums: F.flatten(
                F.transform(
                    parts,
                    lambda part, b: _let(
                        total(F.slice(sums, F.lit(1), b)),
                        lambda start: F.transform(part, lambda _, i: start + total(F.slice(part, F.lit(1), i + 1))),
                    ),
                )
            ),
        )

    def cut(n: Column) -> Column:
        last = F.ceil(F.size(n) / block).cast("int") - 1
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(n, b * block + 1, F.lit(block)))

    return _let(numbers, lambda n: _let(cut(n), of_blocks))


def matches(text: Column, pattern: str, make: Callable[[Column, Column, Column], Column]) -> Column:
    """``make(start, value, text since the last match)`` for each match, as an array; null for none.

    Matches and what lies between them come from two passes with the same pattern; their lengths
    add up to the places, in code points.
    """

    def placed(found: Column) -> Column:
        m, between = found["m"], found["between"]
        steps = F.transform(
            between, lambda gap, i: F.length(gap) + F.coalesce(F.length(F.get(m, i - 1)), F.lit(0))
        )
        return _let(
            running_sums(steps), lambda starts: F.transform(m, lambda v, i: make(F.get(starts, i), v, F.get(between, i)))
        )

    return _let(
        F.regexp_extract_all(text, F.lit(pattern), 0),
        lambda m: F.when(
            F.size(m) > 0, _let(F.struct(m.alias("m"), F.split(text, pattern, -1).alias("between")), placed)
        ),
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether 12 to 19 digits have a right check digit.

    Filled up to 20 with zeros, which add nothing, the digits at odd places are the doubled ones.
    """
    padded = F.lpad(digits, 20, "0")
    doubled = F.translate(padded, "0123456789", "0246813579")
    places = [F.substring(doubled if i % 2 else padded, i, 1).cast("int") for i in range(1, 21)]
    return sum(places[1:], places[0]) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    """Whether a match of a fixed pattern is kept."""
    if kind == "ip":
        return value.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.|$)){4}$")
    if kind == "card":
        return _let(_digits(value), lambda d: F.when(F.length(d).between(12, 19), _luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _or_empty(array: Column, kind: str) -> Column:
    return F.coalesce(array.cast(kind), F.array().cast(kind))


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns by start, then kind; none for null."""

    def spans(kind: str) -> Column:
        may_have = {"email": text.contains("@"), "phone": text.contains("+")}.get(kind, text.rlike("[0-9]"))

        def make(start: Column, value: Column, _: Column) -> Column:
            stop = F.when(_holds(kind, value), start + F.length(value))
            return F.struct(start.alias("start"), F.lit(RANK[kind]).alias("rank"), stop.alias("stop"))

        found = F.when(may_have, matches(text, KINDS[kind], make))
        return F.filter(_or_empty(found, _SPAN), lambda s: s["stop"].isNotNull())

    return F.array_sort(F.concat(*[spans(kind) for kind in KINDS]))


_CANDIDATE = "array<struct<start:int,stop:int,value:string,pattern:string>>"


def _pattern(label: Column) -> Column:
    return F.lower(F.regexp_replace(label, r"\s+", " "))


def labelled_values(text: Column) -> Column:
    """Tokens with a label in front: start, stop, value, pattern."""

    def make(start: Column, run: Column, _: Column) -> Column:
        label = F.regexp_extract(run, rf"^({_LABEL})", 1)
        # a sentence's mark behind a token is not part of it
        value = F.rtrim(F.substring(run, F.length(label) + 1, F.length(run)), F.lit(".!?"))
        left = start + F.length(label)
        return F.struct(
            left.alias("start"), (left + F.length(value)).alias("stop"), value.alias("value"), _pattern(label).alias("pattern")
        )

    found = F.when(text.rlike("[:=#]"), matches(text, TOKEN, make))
    return F.filter(_or_empty(found, _CANDIDATE), lambda c: c["value"] != "")


def labelled_base(text: Column, base: Column) -> Column:
    """Base spans with a label in front, whatever their characters: pattern, value."""

    def make(s: Column) -> Column:
        at = F.greatest(s["start"] - LABEL_REACH, F.lit(0))
        label = F.regexp_extract(F.substring(text, at + 1, s["start"] - at), LABEL, 1)
        return F.struct(_pattern(label).alias("pattern"), F.substring(text, s["start"] + 1, s["stop"] - s["start"]).alias("value"))

    found = F.when(text.rlike("[:=#]"), F.transform(base, make))
    return F.filter(_or_empty(found, "array<struct<pattern:string,value:string>>"), lambda c: c["pattern"] != "")


def found_in(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text, base spans, those with labels, and labelled values."""
    spans = docs.select("doc_id", "text", base_spans(F.col("text")).alias("base"))
    return spans.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        "base",
        labelled_base(F.col("text"), F.col("base")).alias("seeds"),
        labelled_values(F.col("text")).alias("values"),
    )


def _in_base(c: Column) -> Column:
    return F.exists("base", lambda s: (s["start"] < c["stop"]) & (c["start"] < s["stop"]))


def pattern_graph(found: DataFrame) -> DataFrame:
    """Distinct (pattern, value, seed): which pattern stands before which value."""
    each = found.where(F.size("values") > 0).select("base", F.explode("values").alias("c")).where(~_in_base(F.col("c")))
    others = each.select("c.pattern", "c.value", F.col("c.value").rlike(KEY_SHAPE).alias("seed"))
    seeds = found.select(F.explode("seeds").alias("c")).select("c.pattern", "c.value", F.lit(True).alias("seed"))
    return others.unionByName(seeds).groupBy("pattern", "value").agg(F.max("seed").alias("seed"))


def trusted_patterns(
    edges: DataFrame, rounds: int = ROUNDS, trust: float = TRUST, support: int = SUPPORT
) -> DataFrame:
    """(pattern, confidence) of the patterns to trust after all rounds.

    Confidence is the share of a pattern's different values that are known.  A round makes values
    known by the best pattern that points at them.
    """
    known = edges.withColumn("known", F.col("seed"))
    for r in range(rounds):
        patterns = (
            known.groupBy("pattern")
            .agg(F.count_if("known").alias("good"), F.count("*").alias("n"))
            .where(F.col("good") >= support)
            .select("pattern", (F.col("good") / F.col("n")).alias("confidence"))
        )
        if r + 1 < rounds:
            scores = edges.join(patterns, "pattern").groupBy("value").agg(F.max("confidence").alias("score"))
            known = edges.join(scores, "value", "left").withColumn(
                "known", F.col("seed") | (F.coalesce("score", F.lit(0.0)) >= trust)
            )
    return patterns.where(F.col("confidence") >= trust)


def with_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, base, spans): base spans, and all spans with those that patterns discover.

    Spans are structs of start, rank (a place in ``RANK``) and stop, by start, then kind; places are
    code points.  Null and empty texts have none.  Repeated rows stay.  ``docs`` needs doc_id and
    text; other columns are left behind.
    """
    found = stored(found_in(docs), "pii-found")
    patterns = stored(trusted_patterns(stored(pattern_graph(found), "pii-graph")), "pii-patterns")
    is_rich = F.size("values") > 0
    new = (
        found.where(is_rich)
        .select("doc_id", "text_hash", "base", F.explode("values").alias("c"))
        .where(~_in_base(F.col("c")))
        .select("doc_id", "text_hash", "c.*")
        .join(patterns.select("pattern"), "pattern", "left_semi")
        .select(
            F.col("doc_id").alias("_doc_id"),
            F.col("text_hash").alias("_hash"),
            F.struct("start", F.lit(RANK["context"]).alias("rank"), "stop").alias("span"),
        )
        # rows that agree in id and text have the same spans
        .groupBy("_doc_id", "_hash")
        .agg(F.collect_set("span").cast(_SPAN).alias("new"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_hash") == F.col("_hash"))
    # only rows with labelled values meet the join
    rich = found.where(is_rich).join(new, same, "left")
    spans = F.array_sort(F.concat("base", F.coalesce("new", F.array().cast(_SPAN))))
    out = ["doc_id", "text_hash", "base"]
    return rich.select(*out, spans.alias("spans")).unionByName(
        found.where(~is_rich).select(*out, F.col("base").alias("spans"))
    )


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in RANK])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["stop"].cast("string")),
        ),
        ",",
    )


def personal_data(docs: DataFrame) -> DataFrame:
    """Counts by kind, a digest of the base spans and all spans, for each row of ``docs``."""

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["rank"] == RANK[kind])).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return with_spans(docs).select(
        "doc_id", *counts, F.sha2(spelled(F.col("base")), 256).alias("base_sha256"), spelled(F.col("spans")).alias("spans")
    )


def masked(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in brackets; spans that overlap become one."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in RANK])

    def step(done: Column, s: Column) -> Column:
        new = F.concat(
            done["out"], F.substring(text, done["at"] + 1, s["start"] - done["at"]), F.get(names, s["rank"])
        )
        return F.struct(
            F.greatest(done["at"], s["stop"]).alias("at"),
            F.when(s["start"] >= done["at"], new).otherwise(done["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    whole = F.aggregate(
        spans, start, step, lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))
    )
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def masked_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data masked and n_chars to match; rows without any are unchanged."""
    spans = (
        with_spans(docs)
        .where(F.size("spans") > 0)
        .select(F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_hash"), F.col("spans").alias("_spans"))
        .distinct()
    )
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.xxhash64("text") == F.col("_hash"))
    joined = docs.join(spans, same, "left").withColumn(
        "_new", F.when(F.col("_spans").isNotNull(), masked(F.col("text"), F.col("_spans")))
    )
    new = {"text": F.col("_new"), "n_chars": F.length("_new")}
    return joined.select(
        [
            F.coalesce(new[f.name].cast(f.dataType), f.name).alias(f.name) if f.name in new else f.name
            for f in docs.schema.fields
        ]
    )


@query("op7_personal_data")
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return personal_data(table(spark, sf_dir, "documents"))
