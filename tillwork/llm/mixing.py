"""Mixing sources to target weights.

The words of a source form one stream, document after document, cut into blocks of a fixed number
of words.  The mix is a row of slots in output shards, each slot one block.  A shard's slots are
dealt to the sources by a multinomial draw: every source first gets the whole part of its
expectation, the slots left over are drawn by the fractional parts, so that a small mix is near its
targets too.  A source's slots are numbered through all shards; the number, modulo the number of
its blocks, goes through a pseudorandom permutation to a block.  A block therefore returns only
after all others of its source have been used as often.  Everything is an expression over columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillwork.llm.common import query, stored, table, word_count

WEIGHTS = (5, 2, 1)
#: no source gives more than this many times its own size
MOST_TIMES = 3
#: words of a block, slots of an output shard
BLOCK_WORDS = 32
SHARD_SLOTS = 65_536
SEED = 20_240_601
#: documents that are laid end to end by one window
RUN_DOCS = 4096
ROUNDS = 12


def document_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): one row for each row of ``docs``; a null text has no words."""
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_times: int = MOST_TIMES
) -> DataFrame:
    """One row a source: rank, weight, source_size, n_docs, target.

    Sources by code point, null last, take the weights in turn and share all words by them.  A
    target above ``most_times`` the source's size stops there and the rest goes to the others by
    weight, until none is above: sources in order of size for their weight fill up first.  The
    windows without a key see one row a source, not a document.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    in_turn = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = totals.withColumn("rank", F.row_number().over(in_turn) - 1).withColumn(
        "weight",
        F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")),
    )
    most = F.col("source_size") * most_times
    every = Window.partitionBy()
    fullest_first = Window.orderBy(most / F.col("weight"), "rank")
    before = fullest_first.rowsBetween(Window.unboundedPreceding, -1)
    words_left = F.sum("source_size").over(every) - F.coalesce(F.sum(most).over(before), F.lit(0))
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    full = ranked.withColumn("is_full", most / F.col("weight") < words_left / weight_left)
    shared = F.sum("source_size").over(every) - F.sum(F.when(F.col("is_full"), most).otherwise(0)).over(every)
    sharers = F.sum(F.when(F.col("is_full"), 0).otherwise(F.col("weight"))).over(every)
    target = F.when(F.col("is_full"), most.cast("double")).otherwise(F.col("weight") * shared / sharers)
    return full.select("source", "rank", "weight", "source_size", "n_docs", target.alias("target"))


def permuted(index: Column, size: Column, key: list[Column], rounds: int = ROUNDS) -> Column:
    """The image of ``index`` under a keyed permutation of 0 .. size - 1.

    Swap-or-not: in each round an index and its mirror image around a keyed point change places if
    a hash of the larger of the two says so.  It is a permutation for any size.
    """

    def turned(at: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(*key, r), size) - at, size)
        coin = F.xxhash64(F.greatest(at, mirror), *key, r).bitwiseAND(F.lit(1)) == 1
        return F.when(coin, mirror).otherwise(at)

    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), index.cast("long"), turned)


def draw_counts(targets: DataFrame, block_words: int, shard_slots: int, seed: int) -> DataFrame:
    """Slots of each source in each shard: (rank, n_blocks, shard, count), counts above 0.

    ``targets`` as from ``source_targets``.
    """
    every = Window.partitionBy()
    slots = F.ceil(F.sum("source_size").over(every) / block_words)
    shares = (
        targets.withColumn("slots", slots)
        .withColumn("share", F.col("target") / F.sum("target").over(every))
        .where("source_size > 0")
        .withColumn("n_blocks", F.ceil(F.col("source_size") / block_words))
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.ceil(F.col("slots") / shard_slots) - 1)))
    )
    expected = F.least(F.lit(shard_slots), F.col("slots") - F.col("shard") * shard_slots) * F.col("share")
    shard = Window.partitionBy("shard").orderBy("rank")
    whole = shares.withColumn("sure", F.floor(expected)).withColumn("hi", F.sum(expected - F.floor(expected)).over(shard))
    parts = whole.withColumn("lo", F.lag("hi", 1, 0.0).over(shard))
    # the left-over slots of a shard: their number is the sum of the fractions
    draws = (
        parts.groupBy("shard")
        .agg(F.max("hi").alias("width"))
        .withColumn("draw", F.explode(F.expr("sequence(1, greatest(1, cast(round(width) as int)))")))
        .where(F.col("draw") <= F.round("width"))
        .withColumn("u", F.pmod(F.xxhash64("shard", "draw", F.lit(seed)), F.lit(1 << 52)) / float(1 << 52) * F.col("width"))
        .select("shard", "u", F.floor("u").alias("cell"))
    )
    # a fraction is below 1, so its interval touches two cells at most
    cells = parts.select("shard", "rank", "lo", "hi", F.explode(F.sequence(F.floor("lo"), F.floor("hi"))).alias("cell"))
    drawn = (
        cells.join(draws, ["shard", "cell"])
        .where("lo <= u and u < hi")
        .groupBy("shard", "rank")
        .agg(F.count("*").alias("drawn"))
    )
    return (
        parts.join(drawn, ["shard", "rank"], "left")
        .select("rank", "n_blocks", "shard", (F.col("sure") + F.coalesce("drawn", F.lit(0))).alias("count"))
        .where("count > 0")
    )


def mix_slots(
    targets: DataFrame,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    most_times: int = MOST_TIMES,
    seed: int = SEED,
) -> DataFrame:
    """The mix itself: one row a slot, (shard, rank, number, block).

    ``number`` counts the slots of a source through all shards.  Slots beyond ``most_times`` the
    source's blocks, which only a draw for a source at that limit can ask for, stay empty.
    """
    counts = draw_counts(targets, block_words, shard_slots, seed)
    earlier = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        counts.withColumn("first", F.coalesce(F.sum("count").over(earlier), F.lit(0)))
        .withColumn("last", F.least(F.col("first") + F.col("count"), F.col("n_blocks") * most_times) - 1)
        .where("last >= first")
    )
    # few rows that become many: a number of its own keeps them from being put together
    spread = int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = runs.repartition(spread, "rank", "shard")
    slots = runs.select("shard", "rank", "n_blocks", F.explode(F.sequence("first", "last")).alias("number"))
    block = permuted(F.col("number") % F.col("n_blocks"), F.col("n_blocks"), [F.col("rank"), F.lit(seed)])
    return slots.select("shard", "rank", "number", block.alias("block"))


def laid_out(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Every document with its source's row and the word at which it begins in the source's stream.

    Documents are dealt to runs by a hash of their id; a window adds up a run, another the runs of
    a source.  Rows that agree in doc_id and size may change places.
    """
    known = sizes.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    dealt = known.drop("_source").withColumn("run", F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("n_docs") / RUN_DOCS)))
    earlier = Window.partitionBy("rank").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy("rank", "run")
        .agg(F.sum("size").alias("_run_size"))
        .select("rank", "run", F.coalesce(F.sum("_run_size").over(earlier), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy("rank", "run").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    return (
        dealt.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(starts, ["rank", "run"])
        .withColumn("begin", F.col("_start") + F.col("_inside"))
        .drop("_start", "_inside", "run")
    )


def _placed_takings(
    docs: DataFrame, weights: tuple[int, ...], most_times: int, block_words: int, shard_slots: int, seed: int
) -> tuple[DataFrame, DataFrame]:
    """(rank, doc_id, size, source_size, target, taken) of each row of ``docs``, and the targets."""
    sizes = stored(document_sizes(docs), "mix-sizes")
    targets = stored(source_targets(sizes, weights, most_times), "mix-targets")
    uses = mix_slots(targets, block_words, shard_slots, most_times, seed).groupBy("rank", "block").agg(F.count("*").alias("uses"))
    placed = laid_out(sizes.where("size > 0"), targets)
    first, last = F.floor(F.col("begin") / block_words), F.floor((F.col("begin") + F.col("size") - 1) / block_words)
    pieces = placed.withColumn("block", F.explode(F.sequence(first, last)))
    inside = F.least((F.col("block") + 1) * block_words, F.col("begin") + F.col("size")) - F.greatest(
        F.col("block") * block_words, F.col("begin")
    )
    kept = ["rank", "doc_id", "size", "source_size", "target"]
    taken = (
        pieces.withColumn("words", inside)
        # made by exploding a small table, so its size is not known to be large
        .join(uses.hint("merge"), ["rank", "block"], "left")
        .groupBy("begin", *kept)
        .agg(F.sum(F.col("words") * F.coalesce("uses", F.lit(0))).alias("taken"))
        .select(*kept, "taken")
    )
    empty = sizes.where("size = 0").join(
        targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))
    )
    return taken.unionByName(empty.select(*kept, F.lit(0).cast("long").alias("taken"))), targets


def mixed(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most_times: int = MOST_TIMES,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    seed: int = SEED,
) -> DataFrame:
    """For each document how many of its words the mix takes, repeats counted.

    Input: doc_id, source, text; other columns are left behind.  Null sources are a source of their
    own.  A document without words takes no part (taken 0).  Repeated rows count as often as they
    are there.  Result: doc_id, size, source_size, target, taken.  The same rows give the same mix.
    """
    return _placed_takings(docs, weights, most_times, block_words, shard_slots, seed)[0].drop("rank")


def mixed_documents(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most_times: int = MOST_TIMES,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    seed: int = SEED,
) -> DataFrame:
    """The mix in whole documents: each row so often that a source's words come near its target.

    A row of which the mix takes ``taken`` of ``size`` words is there floor(taken / size) times, and
    once more if a hash of seed, doc_id and text is below the fraction left over.  Rows that agree
    in doc_id, source and size share taken / size.  Columns are those of ``docs``.
    """
    rows, targets = _placed_takings(docs, weights, most_times, block_words, shard_slots, seed)
    times = (
        rows.where("taken > 0")
        .groupBy("rank", F.col("doc_id").alias("_doc_id"), F.col("size").alias("_size"))
        .agg((F.sum("taken") / F.sum("size")).alias("_times"))
        .join(targets.select("rank", F.col("source").alias("_source")), "rank")
        .drop("rank")
    )
    same = (
        F.col("doc_id").eqNullSafe(F.col("_doc_id"))
        & F.col("source").eqNullSafe(F.col("_source"))
        & (word_count(F.col("text")) == F.col("_size"))
    )
    coin = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 52)) / float(1 << 52)
    copies = F.floor("_times") + F.when(coin < F.col("_times") - F.floor("_times"), 1).otherwise(0)
    return (
        docs.join(times, same)
        .withColumn("_copies", copies.cast("int"))
        .where("_copies > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies")))
        .select(docs.columns)
    )


@query("op8_mix_sources")
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents."""
    return mixed(table(spark, sf_dir, "documents"))
