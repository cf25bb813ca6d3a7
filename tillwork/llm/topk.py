"""Exact search for the highest inner products, with block-at-a-time pruning.

Vectors lie in document order in blocks; a block keeps its vectors (a forward index) and, for each
component, its largest and smallest value.  Summed over a query's components, the larger of the two
products bounds every score in the block.  A query takes its blocks by falling bound, in rounds that
grow, until no bound reaches its k-th score.  Nothing is left out: a block is skipped only if no
score in it can enter the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillwork.llm.common import query, stored, table
from tillwork.llm.vectors import matrix, one_per_id, top_rows

SCALE = 64
TOP = 20
BLOCK = 256
#: queries that are scored together, and block bounds that are computed together
QUERY_GROUP = 256
BOUND_GROUP = 128
#: a query's blocks of the first round; each later round takes so many times more
FIRST, GROWTH = 2, 4
#: sums of products below this are exact in double precision
_EXACT = float(1 << 53)

_INT = pa.list_(pa.int64())


def _narrow(m: np.ndarray) -> tuple[bytes, int]:
    """An integer matrix in the fewest bytes a value, and that number."""
    top = int(max(m.max(initial=0), -1 - m.min(initial=0)))
    size = next(n for n in (2, 4, 8) if top < 1 << (8 * n - 1))
    return m.astype(f"<i{size}").tobytes(), size


def _wide(data: bytes, size: int, rows: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{size}").astype(np.int64).reshape(rows, -1) if data else np.zeros((rows, 0), np.int64)


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component, for the usable vectors, one an id."""
    return one_per_id(vectors).select(
        "vec_id", F.transform("embedding", lambda x: F.floor(x * F.lit(float(scale)))).alias("v")
    )


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of the rows; beyond 64 bits they wrap around."""
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))
    if width and float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * width < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """(queries, blocks): no vector of a block scores more."""
    return products(np.maximum(queries, 0), high) + products(np.minimum(queries, 0), low)


def forward_blocks(q: DataFrame, block: int = BLOCK) -> DataFrame:
    """Blocks of ``block`` vectors in document order: block, ids, values, high, low.

    Document order puts vectors with the same signs in their leading components together.
    """
    lead = F.transform(F.slice("v", 1, 24), lambda x: F.when(x < 0, "0").otherwise("1"))
    ordered = (
        q.withColumn("order", F.array_join(lead, ""))
        .repartitionByRange("order", "vec_id")
        .sortWithinPartitions("order", "vec_id")
        .select("vec_id", "v")
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        serial, ids, rows = TaskContext.get().partitionId() << 32, [], []

        def made() -> pa.RecordBatch:
            m = matrix(rows, dtype=np.int64)
            data, size = _narrow(m)
            return pa.RecordBatch.from_pydict(
                {
                    "block": [serial],
                    "ids": pa.array([ids], _INT),
                    "size": [size],
                    "data": [data],
                    "high": pa.array([m.max(axis=0).tolist()], _INT),
                    "low": pa.array([m.min(axis=0).tolist()], _INT),
                }
            )

        for batch in batches:
            for vec_id, v in zip(batch.column("vec_id").to_pylist(), batch.column("v").to_pylist(), strict=True):
                ids.append(vec_id)
                rows.append(v)
                if len(ids) == block:
                    yield made()
                    serial, ids, rows = serial + 1, [], []
        if ids:
            yield made()

    return ordered.mapInArrow(
        build, "block long, ids array<long>, size long, data binary, high array<long>, low array<long>"
    )


def query_groups(q: DataFrame, n_groups: int) -> DataFrame:
    """Groups of queries: grp, asked (their ids), q_size and q_data (their vectors)."""
    lists = q.groupBy(F.pmod(F.xxhash64("vec_id"), F.lit(n_groups)).alias("grp")).agg(
        F.collect_list(F.struct("vec_id", "v")).alias("queries")
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                data, size = _narrow(matrix([x["v"] for x in row["queries"]], dtype=np.int64))
                asked = pa.array([[x["vec_id"] for x in row["queries"]]], _INT)
                yield pa.RecordBatch.from_pydict({"grp": [row["grp"]], "asked": asked, "q_size": [size], "q_data": [data]})

    return lists.mapInArrow(pack, "grp long, asked array<long>, q_size long, q_data binary")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time, their lists as Arrow arrays and not as Python objects."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i] for name in batch.schema.names}
            yield {k: v.values if isinstance(v, pa.ListScalar) else v.as_py() for k, v in row.items()}


def ranked_blocks(groups: DataFrame, blocks: DataFrame, n_blocks: int) -> DataFrame:
    """(query_id, grp, block, bound, place): every query's blocks by falling bound.

    The stated queries meet all blocks, groups of queries with groups of blocks.
    """
    n_groups = -(-n_blocks // BOUND_GROUP)
    summaries = (
        blocks.select("block", "high", "low")
        .withColumn("part", F.pmod(F.xxhash64("block"), F.lit(n_groups)))
        .groupBy("part")
        .agg(F.collect_list(F.struct("block", "high", "low")).alias("blocks"))
    )
    asked = groups.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1)))).withColumn(
        "part", F.col("part").cast("long")
    )
    schema = pa.schema([("query_id", pa.int64()), ("grp", pa.int64()), ("block", pa.int64()), ("bound", pa.int64())])

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            ids, names = row["asked"].to_numpy(), row["blocks"].field("block").to_numpy()
            high, low = (matrix(row["blocks"].field(k).to_pylist(), dtype=np.int64) for k in ("high", "low"))
            of = bounds(_wide(row["q_data"], row["q_size"], len(ids)), high, low)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(ids, len(names))),
                    pa.array(np.full(of.size, row["grp"])),
                    pa.array(np.tile(names, len(ids))),
                    pa.array(of.ravel()),
                ],
                schema=schema,
            )

    pairs = asked.join(summaries, "part").mapInArrow(bound, "query_id long, grp long, block long, bound long")
    falling = Window.partitionBy("query_id").orderBy(F.desc("bound"), "block")
    return pairs.withColumn("place", F.row_number().over(falling))


def scored(wanted: DataFrame, groups: DataFrame, blocks: DataFrame, top: int) -> DataFrame:
    """(query_id, vec_id, score) of the best ``top`` of each wanted (query, block) that reach its ``kth``.

    Queries of a group that want the same block are scored against it together.
    """
    together = wanted.groupBy("grp", "block").agg(F.collect_list(F.struct("query_id", "kth")).alias("wanted"))
    work = together.join(groups, "grp").join(blocks.select("block", "ids", "size", "data"), "block")
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            ids, asked = row["ids"].to_numpy(), row["asked"].to_numpy()
            wanted_ids = row["wanted"].field("query_id").to_numpy()
            least = row["wanted"].field("kth").fill_null(np.iinfo(np.int64).min).to_numpy()
            order = np.argsort(asked)
            places = order[np.searchsorted(asked, wanted_ids, sorter=order)]
            q = _wide(row["q_data"], row["q_size"], len(asked))[places]
            s = products(q, _wide(row["data"], row["size"], len(ids)))
            reach = (s >= least[:, None]) & (ids != wanted_ids[:, None])
            for i in np.flatnonzero(reach.sum(axis=1) > top):
                use = np.flatnonzero(reach[i])
                reach[i] = False
                reach[i, use[top_rows(s[i, use], ids[use], top)]] = True
            which, found = np.nonzero(reach)
            columns = wanted_ids[which], ids[found], s[which, found]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    return work.mapInArrow(score, "query_id long, vec_id long, score long")


def exact_top(vectors: DataFrame, every: int, top: int = TOP, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``top`` highest inner products, ties to smaller ids.

    ``vectors`` has vec_id and embedding; other columns are left behind.  Queries are the ids divisible
    by ``every``, candidates all others, all if fewer than ``top``.  Null ids, null vectors and those
    with null or non-finite components take no part; an id that repeats counts once; vectors of
    different lengths are filled up with zeros.  The bounds of a round's scores decide the next round.
    """
    q = stored(quantised(vectors), "topk-vectors")
    blocks = stored(forward_blocks(q, block), "topk-blocks")
    n_blocks, n_queries = blocks.count(), q.where(F.col("vec_id") % every == 0).count()
    n_groups = max(1, -(-n_queries // QUERY_GROUP))
    groups = stored(query_groups(q.where(F.col("vec_id") % every == 0), n_groups), "topk-queries")
    best = q.sparkSession.createDataFrame([], "query_id long, vec_id long, score long, rank int")
    falling = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    if n_blocks:
        places = stored(ranked_blocks(groups, blocks, n_blocks), "topk-bounds")
        lo, n = 1, FIRST
        while lo <= n_blocks:
            kth = best.where(F.col("rank") == top).select("query_id", F.col("score").alias("kth"))
            wanted = (
                places.where(F.col("place").between(lo, lo + n - 1))
                .join(kth, "query_id", "left")
                .where(F.col("kth").isNull() | (F.col("bound") >= F.col("kth")))
            )
            new = scored(wanted, groups, blocks, top)
            ranked = best.drop("rank").unionByName(new).withColumn("rank", F.row_number().over(falling))
            best = stored(ranked.where(F.col("rank") <= top), "topk-best")
            lo, n = lo + n, n * GROWTH
    return best.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


@query(
    "op5_exact_top_k",
    """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
               WHERE embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.v::DOUBLE[], b.v::DOUBLE[])::BIGINT AS score
          FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
    """,
)
def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest inner products of every 20th vector."""
    return exact_top(table(spark, sf_dir, "embeddings"), 20)
