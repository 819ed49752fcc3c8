"""Approximate nearest neighbours: NN-descent graphs and greedy graph search.

Vectors (equal ones once) are dealt to shards of about ``SHARD`` vectors by hash. In each
shard NN-descent builds a neighbour graph: Spark joins give every node its
neighbours and reverse neighbours, the neighbours of a node are compared with
each other (they are neighbours of neighbours), and every node keeps the ``DEGREE``
nearest it has met, until few edges change. A query is searched in every
shard by greedy search with a beam over the graph's edges, both ways; the
shards' nearest are scored anew on the original vectors and merged.

A task holds one shard's vectors (``SHARD`` times the dimension in single precision) and a block of its nodes or
queries. Reverse neighbours beyond ``DEGREE`` are left out by hash, as in NN-descent; edges the other way keep every node in reach.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components
take no part, neither as query nor as candidate; vectors are compared with those of the same length only; rows with null vec_id take no part;
equal vectors are one node, and results are spread to their smallest ids (ties go to the smaller vec_id);
a repeated vec_id counts once per different vector; an empty table gives an empty table; with fewer candidates
than asked for, all are returned.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from .common import cut, read_table, ship

#: Vectors in a shard, about.
SHARD = 32_768
#: Edges of a node.
DEGREE = 24
#: Tasks that a shard's nodes are dealt to in each round.
BLOCKS = 4
#: Rounds at most; they end when fewer than this share of edges changed.
ROUNDS, CHANGED = 10, 0.02
#: Nodes that a query keeps in view, and expands in a step.
BEAM, STEP = 400, 4
#: Queries searched together.
QUERIES = 256
#: Found nodes of each shard that are scored exactly.
KEPT = 24


# ---------------------------------------------------------------- in a task

def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def best_of(node: np.ndarray, other: np.ndarray, near: np.ndarray, k: int):
    """The k nearest different others of each node."""
    order = np.lexsort((other, -near, node))
    node, other, near = node[order], other[order], near[order]
    fresh = np.ones(len(node), bool)
    fresh[1:] = (node[1:] != node[:-1]) | (other[1:] != other[:-1])
    node, other, near = node[fresh], other[fresh], near[fresh]
    first = np.concatenate([[0], np.flatnonzero(node[1:] != node[:-1]) + 1]) if len(node) else np.zeros(0, int)
    rank = np.arange(len(node)) - np.repeat(first, np.diff(np.append(first, len(node))))
    return node[rank < k], other[rank < k], near[rank < k]


def local_join(lists: np.ndarray, fresh: np.ndarray, vectors: np.ndarray, least: np.ndarray, k: int = DEGREE):
    """Compare the members of each row of ``lists`` (-1: none) with each other, where one of the
    two is ``fresh``; what is nearer than a node's ``least`` comes back, k a node at most."""
    found = []
    for start in range(0, len(lists), 512):
        part, new = lists[start:start + 512], fresh[start:start + 512]
        v = vectors[part]
        near = np.matmul(v, v.transpose(0, 2, 1))
        ok = (new[:, :, None] | new[:, None, :]) & (part[:, :, None] >= 0) & (part[:, None, :] >= 0)
        ok &= (part[:, :, None] != part[:, None, :]) & (near > least[part][:, :, None])
        r, a, b = np.nonzero(ok)
        found.append(best_of(part[r, a], part[r, b], near[r, a, b], k))
    if not found:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.float32)
    return best_of(*(np.concatenate(x) for x in zip(*found, strict=True)), k)


def beam_search(queries: np.ndarray, entry: np.ndarray, edges: np.ndarray, vectors: np.ndarray,
                beam: int = BEAM, step: int = STEP, kept: int = KEPT) -> tuple[np.ndarray, np.ndarray]:
    """Greedy search for each query from its ``entry`` nodes; ``edges`` has -1 for none. Places and nearness."""
    n, q = len(vectors), len(queries)
    beam = min(beam, n)
    rows = np.arange(q)[:, None]
    seen = np.zeros((q, n + 1), bool)
    seen[:, n] = True  # stands for no node
    at = np.full((q, beam), n)
    near = np.full((q, beam), -np.inf, np.float32)
    todo = np.zeros((q, beam), bool)
    new = entry
    while True:
        new = np.where(new < 0, n, new)
        new = np.sort(new, axis=1)
        new[:, 1:][new[:, 1:] == new[:, :-1]] = n
        new = np.where(seen[rows, new], n, new)
        seen[rows, new] = True
        value = np.einsum("qmd,qd->qm", vectors[np.minimum(new, n - 1)], queries)
        value = np.where(new < n, value, -np.inf).astype(np.float32)
        at, near = np.concatenate([at, new], 1), np.concatenate([near, value], 1)
        todo = np.concatenate([todo, new < n], 1)
        top = np.argpartition(-near, beam - 1, axis=1)[:, :beam]
        at, near, todo = (np.take_along_axis(x, top, 1) for x in (at, near, todo))
        if not todo.any():
            break
        nearest = np.argpartition(np.where(todo, -near, np.inf), min(step, beam - 1), axis=1)[:, :step]
        open_ = np.take_along_axis(todo, nearest, 1)
        picked = np.where(open_, np.take_along_axis(at, nearest, 1), n)
        np.put_along_axis(todo, nearest, False, 1)
        new = np.concatenate([edges, np.full((1, edges.shape[1]), -1)])[picked].reshape(q, -1)
    order = np.argsort(-near, axis=1, kind="stable")[:, :kept]
    return np.take_along_axis(at, order, 1), np.take_along_axis(near, order, 1)


def _matrix(column, width: int | None = None) -> np.ndarray:
    """A list column as a matrix, -1 where a list is shorter."""
    column = column.combine_chunks()
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)
    width = int(sizes.max()) if width is None and len(sizes) else (width or 1)
    out = np.full((len(sizes), width), -1, flat.dtype)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _shard(table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the shard's rows by node, the nodes, and their vectors."""
    node = table["node"].to_numpy()
    order = np.argsort(node, kind="stable")
    return order, node[order], _matrix(table["v"])[order]


def _places(ids: np.ndarray, node: np.ndarray) -> np.ndarray:
    return np.where(ids < 0, -1, np.searchsorted(node, ids))


# ---------------------------------------------------------------- Spark

_EDGES = "shard long, node long, other long, near float"


def distinct_vectors(df: DataFrame, vec_id: str, embedding: str, ids: int) -> DataFrame:
    """One row per usable vector: v (double), node (its least id) and its ``ids`` least ids."""
    v = F.col(embedding).cast("array<double>")
    usable = df.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).where(
        "vec_id is not null and size(v) > 0 and not exists(v, x -> x is null or isnan(x) or abs(x) = double('infinity'))")
    usable = usable.withColumn("norm", F.expr("sqrt(aggregate(v, 0D, (a, x) -> a + x * x))")).where(
        "norm > 0 and norm < double('infinity')")
    first = Window.partitionBy("v").orderBy("vec_id")
    few = usable.distinct().withColumn("k", F.row_number().over(first)).where(F.col("k") <= ids)
    return (few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("norm").alias("norm"))
            .select(F.col("ids")[0].alias("node"), "ids", "v", "norm"))


def _with_shards(left: DataFrame, right: DataFrame, key: str, blocks: int, fn, schema: str) -> DataFrame:
    """``fn(left rows of a block, all rows of its shard)`` for every shard and block of ``key``."""
    ship(left.sparkSession)
    block = F.pmod(F.xxhash64(key), F.lit(blocks))
    # New names for the columns: both sides may come from the same table.
    each = right.select(*[F.col(c).alias(c) for c in right.columns]).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    from pyspark.sql.pandas.types import to_arrow_schema
    empty = to_arrow_schema(T._parse_datatype_string(schema)).empty_table()

    def both(rows, shard):
        return fn(rows, shard) if rows.num_rows and shard.num_rows else empty

    return left.withColumn("block", block).groupBy("shard", "block").cogroup(
        each.groupBy("shard", "block")).applyInArrow(both, schema)


def _table(shard: int, **columns):
    import pyarrow as pa
    n = len(next(iter(columns.values())))
    return pa.table({"shard": pa.array(np.full(n, shard, np.int64))} | {k: pa.array(v) for k, v in columns.items()})


def _random_edges(left, right):
    _, node, v = _shard(right)
    mine = left["node"].to_numpy()
    at = np.searchsorted(node, mine)
    picked = np.random.default_rng(int(mine.min())).integers(0, len(node), (len(mine), DEGREE))
    a, b = np.repeat(at, DEGREE), picked.ravel()
    a, b = a[a != b], b[a != b]
    a, b, near = best_of(a, b, np.einsum("ij,ij->i", v[a], v[b]), DEGREE)
    return _table(left["shard"][0].as_py(), node=node[a], other=node[b], near=near)


def _compare(left, right):
    order, node, v = _shard(right)
    least = right["least"].to_numpy()[order]
    lists = _places(_matrix(left["others"]), node)
    fresh = _matrix(left["fresh"], lists.shape[1]) == 1
    a, b, near = local_join(lists, fresh, v, least)
    return _table(left["shard"][0].as_py(), node=node[a], other=node[b], near=near)


def neighbour_graph(nodes: DataFrame) -> DataFrame:
    """Edges (shard, node, other, near) to the ``DEGREE`` nearest; ``nodes``: shard, node, v (unit, float)."""
    graph = cut(_with_shards(nodes.select("shard", "node"), nodes, "node", BLOCKS, _random_edges, _EDGES)
                .withColumn("fresh", F.lit(True)), "graph")
    for _ in range(ROUNDS):
        some = Window.partitionBy("shard", "node").orderBy(F.xxhash64("node", "other"))
        back = (graph.select("shard", F.col("other").alias("node"), F.col("node").alias("other"), "fresh")
                .withColumn("k", F.row_number().over(some)).where(F.col("k") <= DEGREE).drop("k"))
        lists = (graph.select("shard", "node", "other", "fresh").unionByName(back)
                 .groupBy("shard", "node").agg(F.collect_list(F.struct("other", "fresh")).alias("l"))
                 .select("shard", "node", F.col("l.other").alias("others"), F.col("l.fresh").cast("array<tinyint>").alias("fresh")))
        least = graph.groupBy("node").agg(F.when(F.count("*") >= DEGREE, F.min("near")).alias("least"))
        known = nodes.join(least, "node", "left").select(
            "shard", "node", "v", F.coalesce("least", F.lit(-2.0)).cast("float").alias("least"))
        new = _with_shards(lists, known, "node", BLOCKS, _compare, _EDGES).withColumn("fresh", F.lit(True))
        both = (graph.withColumn("fresh", F.lit(False)).unionByName(new)
                .groupBy("shard", "node", "other").agg(F.max("near").alias("near"), F.bool_and("fresh").alias("fresh")))
        top = Window.partitionBy("shard", "node").orderBy(F.desc("near"), "other")
        graph = cut(both.withColumn("k", F.row_number().over(top)).where(F.col("k") <= DEGREE).drop("k"), "graph")
        changed = graph.agg(F.avg(F.col("fresh").cast("int"))).first()[0]
        if changed is None or changed < CHANGED:
            break
    return graph.drop("fresh")


def _search(left, right):
    order, node, v = _shard(right)
    edges = _places(_matrix(right["others"])[order], node).astype(np.int64)
    query, q = left["query"].to_numpy(), _matrix(left["q"])
    rest = np.random.default_rng(len(node)).choice(len(node), min(QUERIES, len(node)), replace=False)
    found = []
    for start in range(0, len(query), QUERIES):
        own = np.searchsorted(node, query[start:start + QUERIES])
        own = np.where(node[np.minimum(own, len(node) - 1)] == query[start:start + QUERIES], own, -1)
        entry = np.concatenate([own[:, None], edges[np.maximum(own, 0)], np.tile(rest, (len(own), 1))], 1)
        at, near = beam_search(q[start:start + QUERIES], entry, edges, v)
        r, c = np.nonzero((at < len(node)) & np.isfinite(near))
        found.append((query[start:start + QUERIES][r], node[at[r, c]]))
    return _table(left["shard"][0].as_py(), query=np.concatenate([f[0] for f in found]),
                  node=np.concatenate([f[1] for f in found]))


def nearest_neighbours(df: DataFrame, queries, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of each query's k nearest by cosine; ``queries``: condition on vec_id."""
    vectors = cut(distinct_vectors(df, vec_id, embedding, k + 1), "vectors")
    shards = max(math.ceil(vectors.count() / SHARD), 1)
    unit_v = F.expr("transform(v, x -> cast(x / norm as float))")
    # Vectors of one length are in the shards of that length.
    nodes = cut(vectors.select(
        "node", unit_v.alias("v"), (F.size("v") * F.lit(shards) + F.pmod(F.xxhash64("node"), F.lit(shards))).alias("shard")), "nodes")
    graph = cut(neighbour_graph(nodes), "graph")
    edges = graph.select("node", "other").unionByName(
        graph.select(F.col("other").alias("node"), F.col("node").alias("other"))
        .withColumn("k", F.row_number().over(Window.partitionBy("node").orderBy(F.xxhash64("node", "other"))))
        .where(F.col("k") <= 2 * DEGREE).drop("k"))
    edges = edges.groupBy("node").agg(F.collect_set("other").alias("others"))
    known = nodes.join(edges, "node", "left").withColumn("others", F.coalesce("others", F.expr("cast(array() as array<long>)")))

    asked = df.select(F.col(vec_id).cast("long").alias("query_id"), F.col(embedding).cast("array<double>").alias("v")).where(
        queries).distinct().join(vectors.select("v", F.col("node").alias("query")), "v").select("query_id", "query")
    asked = cut(asked, "asked")
    searched = asked.select(F.col("query").alias("node")).distinct().join(nodes, "node")
    searched = searched.select(
        F.col("node").alias("query"), F.col("v").alias("q"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("s"), "shard").select(
        "query", "q", (F.col("shard") - F.col("shard") % shards + F.col("s")).cast("long").alias("shard"))
    blocks = max(math.ceil(asked.count() / (4 * QUERIES)), 1)
    found = _with_shards(searched, known, "query", blocks, _search, "shard long, query long, node long")
    found = cut(found.select("query", "node"), "found")

    exact = (found.join(vectors.select(F.col("node").alias("query"), F.col("v").alias("qv"), F.col("norm").alias("qn")), "query")
             .join(vectors, "node")
             .withColumn("score", F.expr("aggregate(zip_with(qv, v, (x, y) -> x * y), 0D, (a, x) -> a + x) / (qn * norm)")))
    pairs = (asked.join(exact.select("query", "score", F.explode("ids").alias("vec_id")), "query")
             .where("vec_id <> query_id"))
    best = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op4_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every vector whose id is divisible by 50."""
    return nearest_neighbours(read_table(spark, sf_dir, "embeddings"), F.expr("query_id % 50 = 0"))
