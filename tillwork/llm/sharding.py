"""Documents dealt to shards of near equal bytes by a histogram sort.

Rows are ordered by the hash of their text, then by the hash of the rest of the row, so that equal
texts follow each other.  Rounds of counting find the keys at which the order is cut: each round
sums, in every task, the exact bytes between candidate keys, and puts new candidates around the cuts
that are not near enough yet.  Then the rows move once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwork.llm.common import query, stored, table

#: bytes of text that a task should sort, and the most such parts; at most 1.5 GB a part at 100 TB
PART_BYTES = 128 << 20
MOST_PARTS = 1 << 16
#: candidate keys of a round, over all cuts that are still open
PROBES = 1 << 14
#: how far a cut may be from its place, as a share of a shard
TOLERANCE = 0.01
#: copies of one row that are laid out together
COPIES = 4096

#: keys are 16 bytes that compare like whole numbers
KEY_BITS = 128


def row_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text and 8 for its id; null has no bytes."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType | T.VariantType):
        return True
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.ArrayType) and _has_map(kind.elementType)


def row_hashes(docs: DataFrame) -> list[Column]:
    """Of a row: the hash of its text, and that of its other columns (of maps, as JSON)."""
    others = [
        F.to_json(F.struct(F.col(f"`{f.name}`"))) if _has_map(f.dataType) else F.col(f"`{f.name}`")
        for f in docs.schema.fields
        if f.name != "text"
    ]
    return [F.xxhash64("text"), F.xxhash64(*others) if others else F.lit(0).cast("long")]


def _keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Two signed 64-bit halves as 16 bytes in the order of the numbers."""
    out = np.empty((len(first), 2), ">u8")
    for i, half in enumerate((first, second)):
        out[:, i] = half.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return out.view("S16").ravel()


def _as_key(number: int) -> bytes:
    return number.to_bytes(KEY_BITS // 8, "big")


def _sorted_keys(numbers: list[int]) -> np.ndarray:
    return np.array([_as_key(k) for k in numbers], "S16")


@dataclass
class Cut:
    """A place in the order, ``target`` bytes from its start, known to lie among the keys low <= key < high.

    ``below`` and ``rows`` count what is under ``low``.  When it is found, ``low`` is the key of the
    first row after the cut and ``copies`` says how many rows of that very key stay before it.
    """

    target: float
    low: int = 0
    high: int = 1 << KEY_BITS
    below: int = 0
    rows: int = 0
    copies: int = 0
    found: bool = False


def _counted(keys: DataFrame, probes: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(bin, bytes, rows, least key, greatest key) of the rows between neighbouring probes, where there are any.

    ``keys`` holds h1, h2 and size.  Bin i is from probe i - 1 up to probe i.
    """
    edges = _sorted_keys(probes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(edges) + 1
        sizes, rows = np.zeros(n, np.int64), np.zeros(n, np.int64)
        least, most = np.full(n, b"\xff" * 16, "S16"), np.full(n, b"", "S16")
        for batch in batches:
            key = _keys(batch.column("h1").to_numpy(), batch.column("h2").to_numpy())
            order = np.argsort(key)
            key, size = key[order], batch.column("size").to_numpy()[order]
            at = np.searchsorted(edges, key, "right")
            np.add.at(sizes, at, size)
            np.add.at(rows, at, 1)
            # sorted, so the first and the last of each bin bound it
            bins, first = np.unique(at, return_index=True)
            last = np.append(first[1:], len(at)) - 1
            least[bins] = np.where(key[first] < least[bins], key[first], least[bins])
            most[bins] = np.where(key[last] > most[bins], key[last], most[bins])
        some = np.flatnonzero(rows)
        if len(some):
            ends = [pa.array([k.ljust(16, b"\0") for k in part[some].tolist()], pa.binary()) for part in (least, most)]
            columns = [pa.array(some), pa.array(sizes[some]), pa.array(rows[some]), *ends]
            yield pa.RecordBatch.from_arrays(columns, ["bin", "bytes", "rows", "least", "most"])

    parts = keys.mapInArrow(count, "bin long, bytes long, rows long, least binary, most binary")
    sums = parts.groupBy("bin").agg(F.sum("bytes"), F.sum("rows"), F.min("least"), F.max("most"))
    return [
        (b, size, n, int.from_bytes(least, "big"), int.from_bytes(most, "big"))
        for b, size, n, least, most in sorted(sums.collect(), key=lambda r: r[0])
    ]


def _probes(open_cuts: list[Cut]) -> list[int]:
    """Candidate keys, evenly between the bounds of each open cut, bounds included."""
    spans = sorted({(c.low, c.high) for c in open_cuts})
    each = max(2, PROBES // len(spans))
    out: set[int] = set()
    for low, high in spans:
        steps = min(each, high - low)
        out.update(low + (high - low) * i // steps for i in range(steps + 1))
    return sorted(k for k in out if k < 1 << KEY_BITS)


def find_cuts(keys: DataFrame, targets: list[float], tolerances: list[float]) -> list[Cut]:
    """Cuts of the order at the given bytes, each within its tolerance where the rows allow it.

    A cut goes between two rows of different keys if one such place is within the tolerance, and to
    the nearer side of a row that is larger than that.  Only where rows of one key, that is copies of
    one whole row, are more than the tolerance on both sides does it go between them.
    """
    cuts = [Cut(t) for t in targets]
    while open_cuts := [c for c in cuts if not c.found]:
        probes = _probes(open_cuts)
        bins = _counted(keys, probes)
        # bytes and rows under each bin that has any
        before = np.cumsum([0, *[b[1] for b in bins]])
        rows_before = np.cumsum([0, *[b[2] for b in bins]])
        for cut, tolerance in zip(cuts, tolerances, strict=True):
            if cut.found:
                continue
            # the bin in which the bytes pass the target
            i = int(np.searchsorted(before, cut.target, "right")) - 1
            i = min(max(i, 0), len(bins) - 1)
            _, size, rows, least, most = bins[i]
            below, after = int(before[i]), int(before[i + 1])
            cut.below, cut.rows = below, int(rows_before[i])
            near_low, near_high = cut.target - below, after - cut.target
            one_key = least == most
            if min(near_low, near_high) <= tolerance or (one_key and rows == 1):
                up = near_high < near_low
                cut.found = True
                cut.low = (most + 1) if up else least
                cut.below, cut.rows = (after, cut.rows + rows) if up else (below, cut.rows)
            elif one_key:
                # copies of one row: as many of them as come nearest
                cut.copies = min(rows, max(0, round(near_low * rows / size)))
                cut.found, cut.low = True, least
                cut.below, cut.rows = below + cut.copies * size // rows, cut.rows + cut.copies
                if cut.copies == rows:
                    cut.low, cut.copies = most + 1, 0
            else:
                cut.low, cut.high = least, most + 1
    return cuts


def _part_of(cuts: list[Cut]):
    """A function of the part of a row by its hashes; rows of a key that is cut within get -1."""
    edges = _sorted_keys([min(c.low, (1 << KEY_BITS) - 1) for c in cuts])
    # a cut after the greatest key there is has no row behind it
    beyond = sum(c.low >= 1 << KEY_BITS for c in cuts)
    within = np.array(sorted({_as_key(c.low) for c in cuts if c.copies}), "S16")

    @F.pandas_udf("long")
    def part(h1: pd.Series, h2: pd.Series) -> pd.Series:
        key = _keys(h1.to_numpy(), h2.to_numpy())
        at = np.searchsorted(edges[: len(edges) - beyond], key, "right")
        if len(within):
            at = np.where(np.isin(key, within), -1, at)
        return pd.Series(at)

    return part


def _copies(hashed: DataFrame, cuts: list[Cut]) -> DataFrame:
    """(row, h1, h2, part) of the rows of keys that a cut goes through.

    Copies are counted first, so what moves is one row for each task and each cut, and they are laid
    out again in pieces.
    """
    pieces, at = [], 0
    while at < len(cuts):
        if not cuts[at].copies:
            at += 1
            continue
        run = [c.copies for c in cuts[at:] if c.low == cuts[at].low and c.copies]
        key = _as_key(cuts[at].low)
        halves = [int.from_bytes(key[i : i + 8], "big") - (1 << 63) for i in (0, 8)]
        for k, (low, high) in enumerate(zip([0, *run], [*run, None], strict=True)):
            pieces.append((*halves, at + k, low, high))
        at += len(run)
    spans = hashed.sparkSession.createDataFrame(pieces, "k1 long, k2 long, part long, low long, high long")
    some = F.lit(False)
    for k1, k2 in sorted({p[:2] for p in pieces}):
        some = some | ((F.col("h1") == k1) & (F.col("h2") == k2))
    counted = hashed.where(some).groupBy("row", "h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    # a row for each key; different contents of one key, were there any, follow each other
    upto = Window.partitionBy("h1", "h2").orderBy(F.to_json("row")).rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.withColumn("end", F.sum("n").over(upto))
    same = (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2"))
    first = F.greatest("low", F.col("end") - F.col("n"))
    times = F.least(F.coalesce("high", "end"), F.col("end")) - first
    dealt = placed.join(F.broadcast(spans), same).withColumn("times", times).where("times > 0")
    blocks = dealt.withColumn("block", F.explode(F.expr(f"sequence(0L, (times - 1) div {COPIES})")))
    here = F.least(F.lit(COPIES), F.col("times") - F.col("block") * COPIES).cast("int")
    spread = blocks.repartition("part", "block", "h1")
    return spread.withColumn("copy", F.explode(F.sequence(F.lit(1), here))).select("row", "h1", "h2", "part")


def _between(cuts: list[Cut], per_shard: int) -> list[Cut]:
    """Cuts within a shard that lie beyond those at its ends, which are the exacter ones, move to these."""
    place = [(c.low, c.copies) for c in cuts]
    ends = [i for i in range(len(cuts)) if (i + 1) % per_shard == 0]
    out = list(cuts)
    for start, stop in zip([-1, *ends], [*ends, len(cuts)], strict=True):
        for i in range(start + 1, stop):
            if start >= 0 and place[i] < place[start]:
                out[i] = cuts[start]
            elif stop < len(cuts) and place[i] > place[stop]:
                out[i] = cuts[stop]
    return out


def sharded(
    docs: DataFrame, shards: int = 24, tolerance: float = TOLERANCE, part_bytes: int = PART_BYTES
) -> DataFrame:
    """The rows of ``docs`` with shard (0 to ``shards`` - 1) and slot (0, 1, 2 ... in each shard).

    ``docs`` needs text; a null text has no bytes, and each row counts 8 more.  Each cut between
    shards lies within ``tolerance`` of a shard from its place, or at the nearer side of a row that is
    larger than that.  Equal texts follow each other and stay in one shard unless the tolerance
    forbids it; then they are cut by the rest of the row, and copies of one whole row by number, so
    that a third of all rows in one group only spans more shards.  The same rows give the same shards
    and slots; ``docs`` has to give the same rows when it is read again.  Columns named shard or slot
    are replaced, all others stay.  A table with fewer rows than shards, or with rows larger than a
    shard, leaves shards empty; an empty table has no rows.

    Each task sorts one part of a shard, about ``part_bytes``, and the driver knows a key for each part.
    """
    kept = docs.drop("shard", "slot")
    first, second = row_hashes(kept)
    whole = F.struct(*[F.col(f"`{c}`") for c in kept.columns])
    hashed = kept.select(whole.alias("row"), first.alias("h1"), second.alias("h2"))
    keys = stored(
        kept.select(first.alias("h1"), second.alias("h2"), row_bytes(F.col("text")).alias("size")), "shard-keys"
    )
    rows, total = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    per_shard = max(1, min(MOST_PARTS // shards, -(-total // (part_bytes * shards))))
    parts = shards * per_shard
    # the cuts between shards are exact, those between the parts of one only keep tasks even
    at = range(1, parts)
    near = [tolerance * total / shards if i % per_shard == 0 else 0.1 * total / parts for i in at]
    cuts = _between(find_cuts(keys, [total * i / parts for i in at], near), per_shard) if rows else []
    starts = [0, *([c.rows for c in cuts] or [0] * (parts - 1))]
    offsets = kept.sparkSession.createDataFrame(
        [(i, i // per_shard, starts[i] - starts[i // per_shard * per_shard]) for i in range(parts)],
        "part long, shard int, start long",
    )
    placed = hashed.withColumn("part", _part_of(cuts)("h1", "h2"))
    if any(c.copies for c in cuts):
        placed = placed.where("part >= 0").unionByName(_copies(hashed, cuts))
    # a partition holds one part, in order
    moved = placed.repartitionById(parts, F.col("part").cast("int")).sortWithinPartitions("h1", "h2")
    numbered = moved.withColumn("at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    return numbered.join(F.broadcast(offsets), "part").select("row.*", "shard", (F.col("start") + F.col("at")).alias("slot"))


@query("op11_byte_shards")
def op11_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return sharded(table(spark, sf_dir, "documents").select("doc_id", "text"), 24).select(
        "doc_id",
        row_bytes(F.col("text")).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
