"""Approximate nearest neighbours: NN-descent builds a graph, queries search it greedily.

Equal vectors are one node.  The graph gives each node its K nearest so far.  A round brings a
node's neighbours, and nodes it is a neighbour of, together: neighbours of neighbours that are nearer
than a node's farthest take its place.  Rounds stop when few edges change.  A query starts from its
node's neighbours and expands the nearest nodes not yet expanded until none is left among the best.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillwork.llm.common import query, stored, table
from tillwork.llm.vectors import matrix, one_per_id

TOP = 10
#: neighbours of a node; nodes that are taken from those that point at it
NEIGHBOURS = 32
BACK = 24
#: nodes of a group that are worked on together
BUCKET = 2048
#: vectors of a starting leaf, and how often all are dealt to leaves
LEAF = 128
DEALS = 3
ROUNDS = 7
#: rounds end when less than this share of edges is new
SETTLED = 0.02
#: the best nodes of a query that are kept and expanded
BREADTH = 160
SEED = 5

_EDGE = pa.schema([("node", pa.int64()), ("other", pa.int64()), ("d", pa.float32()), ("fresh", pa.bool_())])
_EDGE_DDL = "node long, other long, d float, fresh boolean"


def _bucket(node: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(node), F.lit(n)).cast("int")


def _coded(rows: list) -> tuple[list[bytes], list[float]]:
    """A byte for each component and a scale for each vector: near enough to build the graph."""
    m = matrix(rows)
    scale = np.abs(m).max(axis=1) / 127
    codes = np.rint(m / np.where(scale > 0, scale, 1)[:, None]).astype(np.int8)
    return [c.tobytes() for c in codes], scale.tolist()


def _decoded(codes: list[bytes], scale: np.ndarray) -> np.ndarray:
    width = max(map(len, codes))
    flat = b"".join([c.ljust(width, b"\0") for c in codes])
    return np.frombuffer(flat, np.int8).reshape(-1, width).astype(np.float32) * scale[:, None].astype(np.float32)


def _squares(m: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a small matrix."""
    own = (m * m).sum(axis=1)
    return np.maximum(own[:, None] + own - 2 * (m @ m.T), 0)


def _best(table: pa.Table, k: int) -> pa.Table:
    """The ``k`` nearest different others of each node; an edge that was there before is not fresh."""
    node, other, d, fresh = (table.column(c).to_numpy() for c in _EDGE.names)
    order = np.lexsort((fresh, d, other, node))
    node, other, d, fresh = node[order], other[order], d[order], fresh[order]
    first = np.ones(len(node), bool)
    first[1:] = (node[1:] != node[:-1]) | (other[1:] != other[:-1])
    # the same pair has the same distance; the old edge sorts first
    node, other, d, fresh = node[first], other[first], d[first], fresh[first]
    order = np.lexsort((other, d, node))
    node, other, d, fresh = node[order], other[order], d[order], fresh[order]
    starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    place = np.arange(len(node)) - np.repeat(starts, np.diff(np.r_[starts, len(node)]))
    keep = place < k
    return pa.table([pa.array(c[keep]) for c in (node, other, d, fresh)], schema=_EDGE)


def merged(edges: DataFrame, k: int, buckets: int) -> DataFrame:
    return (
        edges.withColumn("bucket", _bucket(F.col("node"), buckets))
        .groupBy("bucket")
        .applyInArrow(lambda t: _best(t, k), _EDGE_DDL)
    )


def first_edges(points: DataFrame, k: int, deal: int) -> DataFrame:
    """The nearest of each node within a leaf: nodes that lie together along random directions."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = _decoded(batch.column("code").to_pylist(), batch.column("scale").to_numpy())
            along = m @ np.random.default_rng([SEED, deal]).normal(size=(m.shape[1], 9))
            signs = (along[:, :8] > 0) @ (1 << np.arange(8))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("code"), batch.column("scale"), pa.array(signs), pa.array(along[:, 8])],
                ["node", "code", "scale", "sign", "along"],
            )

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for leaf in (batch.slice(i, LEAF) for i in range(0, batch.num_rows, LEAF)):
                ids = leaf.column("node").to_numpy()
                d = _squares(_decoded(leaf.column("code").to_pylist(), leaf.column("scale").to_numpy()))
                np.fill_diagonal(d, np.inf)
                near = np.argsort(d, axis=1)[:, : min(k, len(ids) - 1)]
                node = np.repeat(ids, near.shape[1])
                distance = np.take_along_axis(d, near, axis=1).ravel().astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node), pa.array(ids[near.ravel()]), pa.array(distance), pa.array(np.ones(len(node), bool))],
                    schema=_EDGE,
                )

    keys = points.select("node", "code", "scale").mapInArrow(
        keyed, "node long, code binary, scale double, sign long, along double"
    )
    lined = keys.repartitionByRange("sign", "along", "node").sortWithinPartitions("sign", "along", "node")
    return lined.drop("sign", "along").mapInArrow(leaves, _EDGE_DDL)


def _meet(table: pa.Table, k: int) -> pa.Table:
    """Proposals among the members of each centre, for pairs of which one is fresh."""
    centre = table.column("centre").to_numpy()
    order = np.argsort(centre, kind="stable")
    centre, member = centre[order], table.column("member").to_numpy()[order]
    fresh, limit = table.column("fresh").to_numpy()[order], table.column("limit").to_numpy()[order]
    m = _decoded(table.column("code").to_pylist(), table.column("scale").to_numpy())[order]
    ends = np.r_[np.flatnonzero(centre[1:] != centre[:-1]) + 1, len(centre)]
    out: list[list[np.ndarray]] = [[], [], []]
    lo = 0
    for hi in ends:
        ids = member[lo:hi]
        d = _squares(m[lo:hi])
        d[~(fresh[lo:hi, None] | fresh[lo:hi])] = np.inf
        d[ids[:, None] == ids] = np.inf
        # the nearest few of each member here; its other neighbours propose more
        few = min(6, len(ids))
        near = np.argpartition(d, few - 1, axis=1)[:, :few]
        found = np.take_along_axis(d, near, axis=1)
        row, column = np.nonzero(found < limit[lo:hi, None])
        out[0].append(ids[row])
        out[1].append(ids[near[row, column]])
        out[2].append(found[row, column])
        lo = hi
    node, other, d = (np.concatenate(c) for c in out)
    proposals = pa.table(
        [pa.array(node), pa.array(other), pa.array(d.astype(np.float32)), pa.array(np.ones(len(node), bool))], schema=_EDGE
    )
    # before the shuffle, no node needs more than k proposals of a bucket
    return _best(proposals, k)


def next_edges(edges: DataFrame, points: DataFrame, k: int, buckets: int) -> DataFrame:
    """One round: neighbours of neighbours join the edges where they are nearer."""
    forward = edges.select(F.col("node").alias("centre"), F.col("other").alias("member"), "fresh")
    some = Window.partitionBy("other").orderBy(F.desc("fresh"), F.xxhash64("node", "other"))
    backward = (
        edges.withColumn("place", F.row_number().over(some))
        .where(F.col("place") <= BACK)
        .select(F.col("other").alias("centre"), F.col("node").alias("member"), "fresh")
    )
    members = forward.unionByName(backward).groupBy("centre", "member").agg(F.max("fresh").alias("fresh"))
    limits = edges.groupBy("node").agg(
        F.when(F.count("*") >= k, F.max("d")).otherwise(F.lit(float("inf"))).cast("float").alias("limit")
    )
    carried = points.select("node", "code", "scale").join(limits, "node")
    met = (
        members.join(carried.withColumnRenamed("node", "member"), "member")
        .withColumn("bucket", _bucket(F.col("centre"), buckets))
        .groupBy("bucket")
        .applyInArrow(lambda t: _meet(t, k), _EDGE_DDL)
    )
    return merged(edges.withColumn("fresh", F.lit(False)).unionByName(met), k, buckets)


def build_graph(points: DataFrame, n: int, k: int = NEIGHBOURS, rounds: int = ROUNDS) -> DataFrame:
    """Edges (node, other, d, fresh): each node's ``k`` nearest found; all others if ``n`` is small."""
    buckets = max(1, -(-n // BUCKET))
    start = first_edges(points, k, 0)
    for deal in range(1, DEALS):
        start = start.unionByName(first_edges(points, k, deal))
    edges = stored(merged(start, k, buckets), "graph")
    for _ in range(rounds):
        edges = stored(next_edges(edges, points, k, buckets), "graph")
        total, new = edges.agg(F.count("*"), F.count_if("fresh")).first()
        if new < SETTLED * total:
            break
    return edges


def distances(asked: DataFrame, points: DataFrame, buckets: int) -> DataFrame:
    """(query, node, d) from (query, node, v, limit): exact distances up to ``limit``.

    A bucket's nodes meet the queries that ask for some of them, each with its vector once.
    """
    lists = (
        asked.withColumn("bucket", _bucket(F.col("node"), buckets))
        .groupBy("bucket", "query")
        .agg(F.collect_set("node").alias("nodes"), F.first("v").alias("v"), F.first("limit").alias("limit"))
    )
    schema = pa.schema([("query", pa.int64()), ("node", pa.int64()), ("d", pa.float64())])

    def measure(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = right.column("node").to_numpy()
        order = np.argsort(ids)
        ids, own = ids[order], matrix(right.column("v").to_pylist())[order] if len(ids) else None
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]]
        for row in (left.slice(i, 1).to_pylist()[0] for i in range(left.num_rows)):
            nodes = np.array(row["nodes"])
            v = np.array(row["v"])
            width = max(len(v), own.shape[1])
            found = np.pad(own[np.searchsorted(ids, nodes)], ((0, 0), (0, width - own.shape[1])))
            d = np.sqrt(((found - np.pad(v, (0, width - len(v)))) ** 2).sum(axis=1))
            near = d <= row["limit"]
            for column, part in zip(out, (np.full(near.sum(), row["query"]), nodes[near], d[near]), strict=True):
                column.append(part)
        return pa.table([pa.array(np.concatenate(c)) for c in out], schema=schema)

    held = points.select(_bucket(F.col("node"), buckets).alias("bucket"), "node", "v")
    return lists.groupBy("bucket").cogroup(held.groupBy("bucket")).applyInArrow(measure, "query long, node long, d double")


def greedy_search(
    queries: DataFrame, points: DataFrame, edges: DataFrame, n: int, breadth: int = BREADTH
) -> DataFrame:
    """(query, node, d): the ``breadth`` nearest nodes that each query (query, v) finds.

    A query is a node of the graph and starts from there; it does not find itself.
    """
    buckets = max(1, -(-n // BUCKET))
    near = edges.select(F.col("node").alias("at"), F.col("other").alias("node"))
    near = stored(near.unionByName(near.select(F.col("node").alias("at"), F.col("at").alias("node"))).distinct(), "graph-near")
    pool = queries.sparkSession.createDataFrame([], "query long, node long, d double, expanded boolean")
    front = queries.select("query", F.col("query").alias("at"))
    nearest = Window.partitionBy("query").orderBy("d", "node")
    while not front.isEmpty():
        limit = pool.groupBy("query").agg(
            F.when(F.count("*") >= breadth, F.max("d")).otherwise(F.lit(float("inf"))).alias("limit")
        )
        new = front.join(near, "at").where("node <> query").select("query", "node").distinct()
        unknown = new.join(pool.select("query", "node"), ["query", "node"], "left_anti")
        asked = unknown.join(queries, "query").join(limit, "query", "left").withColumn(
            "limit", F.coalesce("limit", F.lit(float("inf")))
        )
        found = distances(asked, points, buckets).withColumn("expanded", F.lit(False))
        both = pool.withColumn("expanded", F.lit(True)).unionByName(found)
        ranked = both.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= breadth)
        pool = stored(ranked.drop("place"), "graph-pool")
        front = pool.where(~F.col("expanded")).select("query", F.col("node").alias("at"))
    return pool.drop("expanded")


def nearest_neighbours(vectors: DataFrame, every: int, top: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest by Euclidean distance that each query finds.

    ``vectors`` has vec_id and embedding; other columns are left behind.  Queries are the ids
    divisible by ``every``, candidates all others; ties to smaller ids.  Null ids, null and zero
    vectors and those with null or non-finite components take no part; an id that repeats counts
    once; vectors of different lengths are filled up with zeros.  Equal vectors stand for each other:
    only the ``top`` + 1 smallest ids of a vector can be in a result.
    """
    good = one_per_id(vectors).where(F.exists("embedding", lambda x: x != 0))
    rows = stored(good, "nn-vectors")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes, scale = _coded(batch.column("v").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node"), batch.column("v"), pa.array(codes, pa.binary()), pa.array(scale)],
                    ["node", "v", "code", "scale"],
                )

    distinct = rows.groupBy(F.col("embedding").alias("v")).agg(F.min("vec_id").alias("node")).select("node", "v")
    points = stored(distinct.mapInArrow(code, "node long, v array<double>, code binary, scale double"), "nn-points")
    n = points.count()
    same = Window.partitionBy("embedding").orderBy("vec_id")
    members = (
        rows.withColumn("place", F.row_number().over(same))
        .where(F.col("place") <= top + 1)
        .join(points.select("node", F.col("v").alias("embedding")), "embedding")
        .select("node", "vec_id")
    )
    asked = (
        rows.where(F.col("vec_id") % every == 0)
        .join(points.select("node", F.col("v").alias("embedding")), "embedding")
        .select(F.col("vec_id").alias("query_id"), F.col("node").alias("query"))
    )
    asked = stored(asked, "nn-asked")
    starts = stored(asked.select("query").distinct().join(points.select(F.col("node").alias("query"), "v"), "query"), "nn-queries")
    edges = build_graph(points, n)
    found = greedy_search(starts, points, edges, n).unionByName(
        starts.select("query", F.col("query").alias("node"), F.lit(0.0).alias("d"))
    )
    closest = Window.partitionBy("query").orderBy("d", "node")
    few = found.withColumn("place", F.row_number().over(closest)).where(F.col("place") <= top + 1).drop("place")
    named = few.join(members, "node").select("query", "vec_id", F.col("d").alias("score"))
    ordered = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        asked.join(named, "query")
        .where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(ordered))
        .where(F.col("rank") <= top)
        .select("query_id", F.col("rank").cast("int"), "vec_id", "score")
    )


@query("op4_nearest_neighbours")
def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest found of every 100th vector."""
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), 100)
