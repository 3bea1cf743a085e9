"""Exact top-k by inner product with M-trees and best-first search.

Vectors are turned into integers, floor(256 * x). The largest inner products with a query are the
nearest neighbours once each candidate gets one coordinate more, sqrt(M^2 - |x|^2), M being the
largest norm: the squared distance to the query (with 0 there) is |q|^2 + M^2 - 2 q.x. On these
distances, which are a metric, candidates form M-trees: leaf pages of vectors below routing nodes with
a pivot, a covering radius, and the distance to the parent's pivot.

A query keeps its k best candidates and a heap of nodes by the least distance their contents can
have. From a node's parent distance and covering radius the triangle inequality often shows, without
computing the distance to its pivot, that the node cannot help; then it is left out. Bounds are
relaxed by more than the rounding of the distances, and scores are integers from exact arithmetic, so
the result is exact; equal scores go to the smaller vec_id, and a node is left out only if all it holds
scores strictly less.

Candidates and queries are dealt into blocks by hash. Each task builds the tree of one candidate block
and searches it for one query block, and the k best per query are merged. Blocks have about ``BLOCK``
rows however the vectors are distributed, also if a third of them are equal.

Defined cases: vectors that are NULL or hold NULL or non-finite components take no part, nor do rows
without vec_id. A query's own rows, those with its vec_id, are not its candidates; a query row that is
there several times is answered once. Vectors of different lengths are not compared. A query with
fewer than k candidates gets all, with none it has no rows. Components of 2^54 and more in size count as
non-finite. Scores beyond 64 bits are cut to that range.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK = 65_536
# Vectors of a leaf page and children of a routing node.
PAGE, FAN_OUT = 128, 16


class MTree:
    """Nodes in arrays; node i covers rows [first, last) of the reordered vectors."""

    def __init__(self, points: np.ndarray, seed: int = 0):
        self.points = points
        self.rng = np.random.default_rng(seed)
        self.pivots, self.radius, self.to_parent, self.children, self.span = [], [], [], [], []
        self.order = np.arange(len(points))
        self._grow(0, len(points), None)
        self.points = points[self.order]
        self.pivots = np.array(self.pivots)
        self.radius, self.to_parent = np.array(self.radius), np.array(self.to_parent)

    def _grow(self, first: int, last: int, parent: np.ndarray | None) -> int:
        members = self.points[self.order[first:last]]
        pivot = members[0] if parent is None else members[self._central(members)]
        distances = np.sqrt(((members - pivot) ** 2).sum(axis=1))
        node = len(self.radius)
        self.pivots.append(pivot)
        self.radius.append(float(distances.max()))
        self.to_parent.append(0.0 if parent is None else float(np.sqrt(((pivot - parent) ** 2).sum())))
        self.span.append((first, last))
        self.children.append([])
        # Equal vectors need no further nodes.
        if last - first > PAGE and self.radius[node] > 0:
            chosen = members[self.rng.choice(len(members), min(FAN_OUT, len(members)), replace=False)]
            squares = (chosen**2).sum(axis=1) - 2 * members @ chosen.T
            nearest = squares.argmin(axis=1)
            if len(np.unique(nearest)) == 1:  # all lie nearest to one: part them by distance instead
                nearest = (distances > np.median(distances)).astype(int)
            if len(np.unique(nearest)) > 1:
                sorting = np.argsort(nearest, kind="stable")
                self.order[first:last] = self.order[first:last][sorting]
                edges = first + np.concatenate([[0], np.flatnonzero(np.diff(nearest[sorting])) + 1, [last - first]])
                for low, high in zip(edges[:-1], edges[1:], strict=True):
                    self.children[node].append(self._grow(int(low), int(high), pivot))
        return node

    def _central(self, members: np.ndarray) -> int:
        return int(((members - members.mean(axis=0)) ** 2).sum(axis=1).argmin())


def search(tree: MTree, vectors: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int, square: float):
    """The k best (score, vec_id) of a query: larger scores first, then smaller ids.

    ``vectors`` and ``ids`` follow the tree's order; ``square`` is |q|^2 + M^2.
    """
    slack = 1e-6 * (1.0 + np.sqrt(square))
    point = np.append(query.astype(float), 0.0)
    best: list[tuple[int, int]] = []  # heap of (score, -id): the worst of the best on top

    def limit() -> float:
        """Largest distance at which a candidate can still get in, ties included."""
        return np.inf if len(best) < k else float(np.sqrt(max(0.0, square - 2.0 * float(best[0][0])))) + slack

    root = float(np.sqrt(((tree.pivots[0] - point) ** 2).sum()))
    waiting = [(max(0.0, root - tree.radius[0]), 0, root)]
    while waiting:
        least, node, distance = heapq.heappop(waiting)
        reach = limit()
        if least > reach:
            break
        if tree.children[node]:
            children = np.array(tree.children[node])
            # |d(q, parent) - d(child, parent)| never exceeds d(q, child).
            children = children[np.abs(distance - tree.to_parent[children]) - tree.radius[children] <= reach + slack]
            to_pivots = np.sqrt(((tree.pivots[children] - point) ** 2).sum(axis=1))
            for child, far in zip(children.tolist(), to_pivots.tolist(), strict=True):
                lower = max(0.0, far - tree.radius[child])
                if lower <= reach + slack:
                    heapq.heappush(waiting, (lower, child, far))
            continue
        first, last = tree.span[node]
        scores = vectors[first:last] @ query
        if len(best) >= k:
            useful = np.flatnonzero(scores >= best[0][0])
        else:
            useful = np.arange(last - first)
        if len(useful) > 4 * k:  # only the best of a page, by score and then id, can get in
            useful = useful[np.lexsort((ids[first + useful], -scores[useful]))[: 4 * k + int((ids[first:last] == own).sum())]]
        for place in useful.tolist():
            vec_id = int(ids[first + place])
            if vec_id == own:
                continue
            entry = (int(scores[place]), -vec_id)
            if len(best) < k:
                heapq.heappush(best, entry)
            elif entry > best[0]:
                heapq.heapreplace(best, entry)
    return sorted(((score, -negative) for score, negative in best), key=lambda x: (-x[0], x[1]))


def _block_search(group: pa.Table, k: int) -> pa.Table:
    """Answers of one query block in one candidate block; vectors are those of one length."""
    asks = group.column("asks")
    queries, candidates = group.filter(asks), group.filter(pc.invert(asks))
    rows: list[tuple] = []
    if queries.num_rows and candidates.num_rows:
        width = len(queries.column("vector")[0])
        exact = _matrix(candidates, width)
        wanted = _matrix(queries, width)
        largest = max(abs(int(m.max(initial=0))) if m.size else 0 for m in (np.abs(exact.astype(float)), np.abs(wanted.astype(float))))
        # Within these bounds doubles hold every sum exactly; beyond them Python's integers do.
        fits = width * (largest + 1) ** 2 < 2**53
        vectors, asked = (m.astype(float) if fits else m.astype(object) for m in (exact, wanted))
        floats = exact.astype(float)
        norms = (floats**2).sum(axis=1)
        top = float(norms.max(initial=0.0))
        tree = MTree(np.column_stack([floats, np.sqrt(np.maximum(0.0, top - norms))]))
        vectors = vectors[tree.order]
        ids = candidates.column("vec_id").to_numpy()[tree.order]
        edge = 2**63 - 1
        for query_id, query, plain in zip(queries.column("vec_id").to_pylist(), asked, wanted.astype(float), strict=True):
            square = float((plain**2).sum()) + top
            for score, vec_id in search(tree, vectors, ids, query, query_id, k, square):
                rows.append((query_id, plain.astype(np.int64).tobytes(), vec_id, max(-edge - 1, min(edge, score))))
    names, types = ["query_id", "query", "vec_id", "score"], [pa.int64(), pa.binary(), pa.int64(), pa.int64()]
    return pa.table({n: pa.array([row[i] for row in rows], t) for i, (n, t) in enumerate(zip(names, types, strict=True))})


def _matrix(rows: pa.Table, width: int) -> np.ndarray:
    flat = rows.column("vector").combine_chunks()
    return flat.flatten().to_numpy().reshape(rows.num_rows, width)


def quantised(vector: Column) -> Column:
    """floor(256 * x) of every component, x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 256.0))


def usable(vector: Column) -> Column:
    # Components of 2^54 and more would not fit a long after the multiplication.
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < 2.0**54))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, block: int = BLOCK) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k best other rows for each row that ``is_query`` marks."""
    ready = vectors.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("embedding")).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("wanted"),
    )
    counts = ready.agg(F.count("*").alias("all"), F.count_if("wanted").alias("queries")).first()
    # At least a few blocks, so that small tables use several tasks as well.
    spread = vectors.sparkSession.sparkContext.defaultParallelism
    columns = max(-(-counts["all"] // block), min(spread, -(-counts["all"] // 4_096)), 1)
    rows = max(-(-counts["queries"] // block), 1)

    def dealt(side: DataFrame, asks: bool) -> DataFrame:
        mine = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(rows if asks else columns)).cast("int")
        others = F.explode(F.sequence(F.lit(0), F.lit((columns if asks else rows) - 1)))
        row, column = (mine, others) if asks else (others, mine)
        return side.select(
            F.size("vector").alias("width"), row.alias("row"), column.alias("column"), F.lit(asks).alias("asks"), "vec_id", "vector"
        )

    queries = ready.where("wanted").select("vec_id", "vector").distinct()
    found = (
        dealt(queries, True).union(dealt(ready, False)).groupBy("width", "row", "column")
        .applyInArrow(lambda group: _block_search(group, k), "query_id long, query binary, vec_id long, score long")
    )
    # k rows per query and candidate block meet here.
    best = W.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
