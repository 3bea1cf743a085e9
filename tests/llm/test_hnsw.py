"""Nearest neighbours by graphs against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldspark.llm import hnsw
from fieldspark.llm.queries import registered

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k, is_query):
    """The k best (rank, vec_id, score) of every query: largest inner product, ties to smaller ids."""
    good = [
        (i, np.array(v, np.float32).astype(float)) for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    found = {}
    for own, query in good:
        if is_query(own):
            alike = [(i, v) for i, v in good if i != own and len(v) == len(query)]
            scores = hnsw.products(np.array([v for _, v in alike]), query) if alike else []
            scored = sorted(zip((-s for s in scores.tolist()), (i for i, _ in alike), strict=True)) if alike else []
            found[own] = [(rank, i, -negative) for rank, (negative, i) in enumerate(scored[:k], 1)]
    return found


def answers(frame):
    found = {}
    for r in frame.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return found


def recall(found, expected):
    pairs = {(q, i) for q, rows in found.items() for _, i, _ in rows}
    wanted = {(q, i) for q, rows in expected.items() for _, i, _ in rows}
    return len(pairs & wanted) / len(wanted)


def test_query_on_the_whole_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    found = answers(registered()["op12_nearest_neighbours"](spark, sf_dir))
    expected = brute(rows, 20, lambda i: i % 20 == 0)
    assert set(found) == set(expected) and all(len(v) == 20 for v in found.values())
    assert recall(found, expected) >= 0.95
    scores = {(q, i): s for q, v in brute(rows, len(rows), lambda i: i % 20 == 0).items() for _, i, s in v}
    assert all(scores[q, i] == s for q, v in found.items() for _, i, s in v)


@pytest.mark.parametrize("kind", ["uniform", "clusters", "long and short"])
def test_recall_over_many_shards(spark, monkeypatch, kind):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(4000, 24))
    if kind == "clusters":
        vectors = vectors * 0.05 + rng.normal(size=(40, 24))[rng.integers(0, 40, 4000)]
    if kind == "long and short":
        vectors *= np.exp(rng.normal(size=(4000, 1)))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    monkeypatch.setattr(hnsw, "SHARD_BYTES", 1000 * 24 * 8)
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    found = answers(hnsw.nearest(frame, F.col("vec_id") % 20 == 0, 10))
    assert recall(found, brute(rows, 10, lambda i: i % 20 == 0)) >= 0.95


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [2.0, 1.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
        (8, [None, 1.0]), (9, [1.0, 2.0, 3.0]), (None, [5.0, 5.0]), (10, [3e38, 3e38]), (11, [-1.0, 0.5]), (11, [-1.0, 0.5]),
        (20, [1.0, 2.0]), (20, [0.5, 0.5]), (12, [1e-30, 0.0]), (40, [2.0, 2.0, 2.0]), (60, [7.0]), (80, None),
    ]
    frame = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA).withColumn("score", F.lit("clash")).withColumn("rank", F.lit(1))
    expected = brute(rows, 20, lambda i: i % 20 == 0)
    # vec_id 20 asks with two vectors; each has its own answers.
    got = hnsw.nearest(frame, F.col("vec_id") % 20 == 0)
    found = answers(got.where("query_id <> 20"))
    assert found == {q: v for q, v in expected.items() if q != 20 and v}
    assert got.where("query_id = 20").groupBy("rank").count().where("count <> 2").count() == 0
    assert hnsw.nearest(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_equal_vectors_come_by_their_ids(spark):
    rows = [(i, [1.0, 1.0]) for i in range(5000)] + [(i, [float(i % 7), 0.5]) for i in range(5000, 5100)]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    found = answers(hnsw.nearest(frame, F.col("vec_id").isin(40, 5020)))
    assert found == brute(rows, 20, lambda i: i in (40, 5020))


def test_every_row_is_in_the_index(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.integers(0, 3, 4) + 1], 0) for i in range(3000)]
    path = str(tmp_path / "index")
    hnsw.write_index(spark.createDataFrame(rows, SCHEMA), path)
    ids = []
    for shard in spark.read.parquet(path).collect():
        ids += np.frombuffer(shard.ids, np.int64).tolist()
        nodes = np.frombuffer(shard.layer_nodes[0], np.int32)
        links = np.frombuffer(shard.layer_links[0], np.int32).reshape(len(nodes), -1)
        assert len(nodes) == shard.n_nodes and links.max() < shard.n_nodes
        # Each node can be reached from the entry.
        reached, border = {shard.entry}, {shard.entry}
        while border:
            border = {int(x) for n in border for x in links[n] if x >= 0} - reached
            reached |= border
        assert len(reached) == shard.n_nodes
    assert sorted(ids) == list(range(3000))
