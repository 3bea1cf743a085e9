"""Approximate nearest neighbours by inner product: one navigable small-world graph per shard.

Vectors are dealt into shards by hash. Each shard becomes a hierarchical graph, kept as flat arrays in one
row of a Parquet table: per layer the nodes and a matrix of their neighbours, padded with -1. A node is
a distinct vector; the ids that carry it are listed behind it, so equal vectors cost one node a
shard and every row is indexed. A search takes every query through every shard, in blocks of queries,
and merges the shards' results.

Graphs are built and searched many nodes at a time. A beam keeps the ``width`` best nodes of each query and opens
the best unopened ones of all queries in one step, until all are open. Layers are built from the top;
nodes enter in batches that double, each linked to what its beam found and to the batch itself. Links are
chosen as usual: a candidate stays if it is nearer to the node than to any chosen one, and the
nearest of the others fill up.

The largest inner product becomes the nearest neighbour by one more coordinate,
sqrt(M^2 - |x|^2) with the shard's largest norm M, 0 for queries: then all nodes have one length. Graphs work
in single precision; what they find is scored in double precision on the original vectors, component by
component, so that scores do not depend on the shard.

Defined cases: vectors that are NULL, empty, zero or hold NULL or non-finite components take no part, nor do
rows without vec_id. A query's own rows, those with its vec_id, are not its neighbours. Equal rows count
each. A query row that is there several times is answered once. Vectors of different lengths are not
compared. A query with fewer than k candidates gets all. An empty table gives no rows. Other columns are not
looked at. Scores that do not fit a double are infinite and ordered as such.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldspark.session import work_path

# Bytes of vectors in a shard and in a block of queries, as doubles.
SHARD_BYTES, QUERY_BYTES = 16 << 20, 2 << 20
# Fewest vectors for which another shard is made only to use another task.
SPREAD_ROWS = 8_192
# Nodes that enter a layer, search or choose links at once.
BATCH = 512
# Nodes of each query that one step of a beam opens.
OPEN = 4


@dataclass(frozen=True)
class Shape:
    """Links of a node (twice as many in the lowest layer), and the beams of building and searching."""

    links: int = 16
    build_beam: int = 96
    search_beam: int = 256


INDEX_SCHEMA = (
    "width int, shard int, n_nodes long, vectors binary, id_starts binary, ids binary, copies binary, "
    "entry int, layer_nodes array<binary>, layer_links array<binary>"
)


class Graph:
    """Layers of flat neighbour arrays over rows of ``points``, which all have one length."""

    def __init__(self, points: np.ndarray, shape: Shape, layers=None, entry: int = 0):
        self.points, self.shape, self.entry = points, shape, entry
        # Per layer, lowest first: its nodes in rising order and their links.
        self.layers: list[tuple[np.ndarray, np.ndarray]] = layers or []

    @staticmethod
    def build(points: np.ndarray, shape: Shape, seed: int = 0) -> "Graph":
        n = len(points)
        draws = np.random.default_rng(seed).random(n)
        level = np.floor(-np.log(np.maximum(draws, 1e-300)) / np.log(shape.links)).astype(int)
        order = np.argsort(-level, kind="stable")
        graph = Graph(points, shape, entry=int(order[0]))
        for height in range(int(level.max()), -1, -1):
            entering = order[: int((level >= height).sum())]
            graph.layers.insert(0, graph._layer(entering, shape.links * (1 if height else 2)))
        return graph

    def _layer(self, entering: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        nodes = np.sort(entering)
        links = np.full((len(nodes), width), -1, np.int32)
        row_of = np.full(len(self.points), -1, np.int32)
        row_of[nodes] = np.arange(len(nodes), dtype=np.int32)
        linked = np.zeros(len(self.points), bool)
        inside = 0
        while inside < len(entering):
            batch = entering[inside:inside + min(max(inside, BATCH // 2), BATCH)]
            beam = self.shape.build_beam
            if inside:
                starts = self.descend(self.points[batch])
                # Nodes of the layer above enter first; until they are inside, the entry serves.
                starts = np.where(linked[starts], starts, self.entry).astype(np.int32)
                found, _ = self._beam(self.points[batch], starts, beam, links, row_of)
            else:
                found = np.empty((len(batch), 0), np.int32)
            mates = self.points[batch] @ self.points[batch].T
            np.fill_diagonal(mates, -np.inf)
            near = np.argsort(-mates, axis=1)[:, : min(beam, len(batch) - 1)]
            candidates = np.concatenate([found, batch[near].astype(np.int32)], axis=1)
            chosen = self._choose(batch, candidates, min(self.shape.links, width))
            links[row_of[batch], : chosen.shape[1]] = chosen
            self._link_back(batch, chosen, links, row_of)
            linked[batch] = True
            inside += len(batch)
        return nodes, links

    def _link_back(self, batch: np.ndarray, chosen: np.ndarray, links: np.ndarray, row_of: np.ndarray) -> None:
        """Links from the chosen nodes back to those of the batch; full lists are chosen anew."""
        width = links.shape[1]
        targets = np.unique(chosen[chosen >= 0])
        old = links[row_of[targets]]
        sources = np.concatenate([np.repeat(targets, width), chosen.ravel()])
        others = np.concatenate([old.ravel(), np.repeat(batch, chosen.shape[1])])
        real = (sources >= 0) & (others >= 0)
        pairs = np.unique(np.stack([sources[real], others[real]], axis=1), axis=0)
        counts = np.diff(np.append(np.searchsorted(pairs[:, 0], targets), len(pairs)))
        # Lists of like length together, so that a few long ones do not pad all others.
        for least, most in ((0, width), (width, 3 * width), (3 * width, len(self.points))):
            part = (counts > least) & (counts <= most)
            if part.any():
                each = counts[part]
                padded = np.full((len(each), int(each.max())), -1, np.int32)
                padded[np.arange(padded.shape[1]) < each[:, None]] = pairs[np.repeat(part, counts), 1]
                again = self._choose(targets[part], padded, width)
                links[row_of[targets[part]], : again.shape[1]] = again

    def _choose(self, nodes: np.ndarray, candidates: np.ndarray, limit: int) -> np.ndarray:
        """At most ``limit`` of each node's candidates: diverse ones first, then the nearest of the others."""
        chosen = np.full((len(nodes), min(limit, candidates.shape[1])), -1, np.int32)
        for first in range(0, len(nodes), BATCH // 2):
            part = candidates[first:first + BATCH // 2]
            base = self.points[nodes[first:first + BATCH // 2]]
            near = np.where(part >= 0, np.matmul(self.points[part], base[:, :, None])[:, :, 0], -np.inf)
            order = np.argsort(-near, axis=1, kind="stable")[:, : self.shape.build_beam]
            part, near = np.take_along_axis(part, order, 1), np.take_along_axis(near, order, 1)
            if part.shape[1] > limit:
                vectors = self.points[part]
                between = np.matmul(vectors, vectors.transpose(0, 2, 1))
                kept = np.zeros(part.shape, bool)
                for place in range(part.shape[1]):
                    covered = (kept & (between[:, place] >= near[:, place, None])).any(axis=1)
                    kept[:, place] = ~covered & (part[:, place] >= 0) & (kept.sum(axis=1) < limit)
                best = np.argsort(~kept, axis=1, kind="stable")[:, :limit]
                part = np.take_along_axis(part, best, 1)
            chosen[first:first + BATCH // 2] = part[:, : chosen.shape[1]]
        return chosen

    def _beam(self, queries, starts, width, links, row_of):
        """The ``width`` best nodes found for each query, best first (-1 where there are fewer), and their products."""
        n_queries = len(queries)
        ids = np.full((n_queries, width), -1, np.int32)
        near = np.full((n_queries, width), -np.inf, np.float32)
        opened = np.zeros((n_queries, width), bool)
        seen = np.zeros((n_queries, len(self.points)), bool)
        ids[:, 0] = starts
        near[:, 0] = np.einsum("qd,qd->q", self.points[starts], queries)
        seen[np.arange(n_queries), starts] = True
        active = np.arange(n_queries)
        while len(active):
            waiting = np.where(opened[active] | (ids[active] < 0), -np.inf, near[active])
            at = np.argsort(-waiting, axis=1, kind="stable")[:, : min(OPEN, width)]
            usable = np.take_along_axis(waiting, at, 1) > -np.inf
            going = usable[:, 0]
            active, at, usable = active[going], at[going], usable[going]
            if not len(active):
                break
            rows = active[:, None]
            opened[rows, at] |= usable
            nodes = np.where(usable, ids[rows, at], -1)
            next_to = links[row_of[nodes]]
            next_to[nodes < 0] = -1
            next_to = next_to.reshape(len(active), -1)
            next_to[seen[rows, next_to]] = -1
            # The same node can come from several opened ones.
            next_to.sort(axis=1)
            next_to[:, 1:][next_to[:, 1:] == next_to[:, :-1]] = -1
            fresh = next_to >= 0
            line, column = np.nonzero(fresh)
            seen[active[line], next_to[line, column]] = True
            products = np.full(next_to.shape, -np.inf, np.float32)
            products[line, column] = np.einsum("xd,xd->x", self.points[next_to[line, column]], queries[active[line]])
            all_near = np.concatenate([near[active], products], axis=1)
            all_ids = np.concatenate([ids[active], next_to], axis=1)
            all_opened = np.concatenate([opened[active], np.zeros(next_to.shape, bool)], axis=1)
            best = np.argpartition(-all_near, width - 1, axis=1)[:, :width]
            near[active] = np.take_along_axis(all_near, best, 1)
            ids[active] = np.take_along_axis(all_ids, best, 1)
            opened[active] = np.take_along_axis(all_opened, best, 1)
        order = np.argsort(-near, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)

    def descend(self, queries: np.ndarray, down_to: int = 0) -> np.ndarray:
        """The node from which each query enters the layer below those built so far."""
        starts = np.full(len(queries), self.entry, np.int32)
        for nodes, links in reversed(self.layers[down_to:]):
            row_of = np.full(len(self.points), -1, np.int32)
            row_of[nodes] = np.arange(len(nodes), dtype=np.int32)
            starts = self._beam(queries, starts, 4, links, row_of)[0][:, 0]
        return starts

    def search(self, queries: np.ndarray, width: int) -> np.ndarray:
        """The ``width`` best nodes found for each query, -1 where there are fewer."""
        nodes, links = self.layers[0]
        row_of = np.arange(len(self.points), dtype=np.int32)
        found = [
            self._beam(part, self.descend(part, 1), width, links, row_of)[0]
            for part in np.split(queries, range(BATCH // 2, len(queries), BATCH // 2))
        ]
        return np.concatenate(found)


def lifted(vectors: np.ndarray, top: float) -> np.ndarray:
    """Vectors over their shard's largest norm with the coordinate that gives all of them length 1."""
    scaled = vectors / top
    rest = np.sqrt(np.maximum(0.0, 1.0 - (scaled**2).sum(axis=1)))
    return np.column_stack([scaled, rest]).astype(np.float32)


def largest_norm(vectors: np.ndarray) -> float:
    """The largest Euclidean norm, also where squares would not fit."""
    biggest = np.abs(vectors).max()
    return float(biggest * np.sqrt(((vectors / biggest) ** 2).sum(axis=1).max()))


def products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, added component by component."""
    total = np.zeros(len(vectors))
    with np.errstate(over="ignore", invalid="ignore"):
        for place in range(vectors.shape[1]):
            total += vectors[:, place] * query[place]
    return total


def _matrix(rows: pa.Table) -> np.ndarray:
    flat = rows.column("vector").combine_chunks().flatten().to_numpy()
    return flat.reshape(rows.num_rows, -1)


def _build_shard(key, group: pa.Table, shape: Shape) -> pa.Table:
    vectors = _matrix(group)
    ids, copies = group.column("vec_id").to_numpy(), group.column("copies").to_numpy()
    # Equal vectors side by side, their ids rising: one node each.
    order = np.lexsort((ids, *vectors.T))
    vectors, ids, copies = vectors[order], ids[order], copies[order]
    new = np.ones(len(vectors), bool)
    new[1:] = (vectors[1:] != vectors[:-1]).any(axis=1)
    starts = np.append(np.flatnonzero(new), len(ids)).astype(np.int64)
    distinct = np.ascontiguousarray(vectors[new])
    graph = Graph.build(lifted(distinct, largest_norm(distinct)), shape)
    values = [
        key[0].as_py(), key[1].as_py(), len(distinct), distinct.tobytes(), starts.tobytes(), ids.astype(np.int64).tobytes(),
        copies.astype(np.int64).tobytes(), graph.entry,
        [nodes.astype(np.int32).tobytes() for nodes, _ in graph.layers], [links.tobytes() for _, links in graph.layers],
    ]
    binaries = pa.list_(pa.binary())
    types = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 4, pa.int32(), binaries, binaries]
    names = [column.split()[0] for column in INDEX_SCHEMA.split(", ")]
    return pa.table({name: pa.array([v], t) for name, v, t in zip(names, values, types, strict=True)})


def usable(vector: Column) -> Column:
    number = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(number & F.exists(vector, lambda x: x != 0), F.lit(False))


def _ready(vectors: DataFrame) -> DataFrame:
    """Rows (vec_id, vector) that take part, in double precision."""
    vector = F.col("embedding").cast("array<double>")
    return vectors.where(usable(vector) & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))


def write_index(vectors: DataFrame, path: str, shape: Shape = Shape()) -> None:
    """Index rows (vec_id, embedding): one graph for each vector length and shard, as a Parquet table."""
    ready = _ready(vectors).groupBy("vec_id", "vector").agg(F.count("*").alias("copies"))
    size = _ready(vectors).agg(F.count("*").alias("rows"), F.sum(F.size("vector")).alias("numbers")).first()
    spread = min(vectors.sparkSession.sparkContext.defaultParallelism, size["rows"] // SPREAD_ROWS)
    shards = max(1, spread, -(-8 * (size["numbers"] or 0) // SHARD_BYTES))
    dealt = ready.select(
        F.size("vector").alias("width"), F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)).cast("int").alias("shard"), "vec_id", "vector", "copies"
    )
    graphs = dealt.groupBy("width", "shard").applyInArrow(lambda key, group: _build_shard(key, group, shape), INDEX_SCHEMA)
    graphs.write.parquet(path)


def search_index(
    spark: SparkSession, path: str, queries: DataFrame, k: int = 20, shape: Shape = Shape(),
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k nearest rows found for each query row (vec_id, embedding)."""
    index = spark.read.schema(INDEX_SCHEMA).parquet(path)
    asked = _ready(queries).distinct()
    numbers = asked.agg(F.sum(F.size("vector"))).first()[0] or 0
    blocks = max(1, -(-8 * numbers // QUERY_BYTES))
    # Every block of queries meets every shard of its length.
    places = index.groupBy("width").agg(F.collect_set("shard").alias("shards"))
    dealt_queries = asked.select(
        F.size("vector").alias("width"), F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).cast("int").alias("block"), "vec_id", "vector"
    ).join(places, "width").withColumn("shard", F.explode("shards")).drop("shards")
    dealt_index = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    key = ["width", "shard", "block"]
    found = dealt_queries.groupBy(*key).cogroup(dealt_index.groupBy(*key)).applyInArrow(
        lambda asks, graphs: _search_shard(asks, graphs, k, shape), "query_id long, query binary, vec_id long, score double"
    )
    best = W.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search_shard(asks: pa.Table, graphs: pa.Table, k: int, shape: Shape) -> pa.Table:
    out: list[list] = [[], [], [], []]
    if asks.num_rows and graphs.num_rows:
        row = graphs.to_pylist()[0]
        vectors = np.frombuffer(row["vectors"], np.float64).reshape(row["n_nodes"], row["width"])
        starts, ids, copies = (np.frombuffer(row[name], np.int64) for name in ("id_starts", "ids", "copies"))
        layers = [
            (nodes := np.frombuffer(a, np.int32), np.frombuffer(b, np.int32).reshape(len(nodes), -1))
            for a, b in zip(row["layer_nodes"], row["layer_links"], strict=True)
        ]
        graph = Graph(lifted(vectors, largest_norm(vectors)), shape, layers, row["entry"])
        queries = _matrix(asks)
        scaled = queries / np.abs(queries).max(axis=1, keepdims=True)
        points = np.column_stack([scaled, np.zeros(len(scaled))]).astype(np.float32)
        found = graph.search(points, max(shape.search_beam, k + 1))
        for own, query, nodes in zip(asks.column("vec_id").to_pylist(), queries, found, strict=True):
            nodes = nodes[nodes >= 0]
            scores = products(vectors[nodes], query)
            # k + 1 nodes hold k other ids; nodes that score as the last of them can hold smaller ids.
            enough = np.sort(scores)[-(k + 1):][0]
            entries = []
            for node, score in zip(nodes[scores >= enough].tolist(), scores[scores >= enough].tolist(), strict=True):
                held = slice(starts[node], min(starts[node + 1], starts[node] + k + 1))
                for vec_id, times in zip(ids[held].tolist(), copies[held].tolist(), strict=True):
                    if vec_id != own:
                        entries += [(-score, vec_id)] * min(times, k)
            for negative, vec_id in sorted(entries)[:k]:
                for column, value in zip(out, (own, query.tobytes(), vec_id, -negative), strict=True):
                    column.append(value)
    types = (pa.int64(), pa.binary(), pa.int64(), pa.float64())
    return pa.table({n: pa.array(v, t) for n, v, t in zip(("query_id", "query", "vec_id", "score"), out, types, strict=True)})


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, shape: Shape = Shape()) -> DataFrame:
    """Index all rows, then search for the k nearest other rows of each row that ``is_query`` marks."""
    spark = vectors.sparkSession
    path = work_path(spark, "graphs")
    write_index(vectors, path, shape)
    return search_index(spark, path, vectors.where(F.coalesce(is_query, F.lit(False))), k, shape)
