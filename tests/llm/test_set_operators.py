import math
import os
from collections import Counter, defaultdict
from hashlib import md5

import helpers
import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldspark.llm import mixing, near_dups, topk

# Near-duplicates


def family(spark):
    """Groups with near misses, a chain, exact copies, and one doc_id with two texts."""
    base = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(base)) for k in (3, 1, 9)]
    rows += [(20 + k, " ".join([*base[:20 + k], f"new{k}", *base[21 + k:]])) for k in range(12)]
    rows += [(40 + k, " ".join(base[3 * k:] + [f"tail{j}" for j in range(3 * k)])) for k in range(12)]
    rows += [(60, "short text"), (61, "short text"), (62, "other words here"), (60, "other words here")]
    rows += [(70, None), (71, " "), (72, None), (None, " ".join(base)), (80, "single"), (81, "SINGLE")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def expected_components(rows, width):
    sets = defaultdict(list)
    for doc_id, text in rows:
        if doc_id is not None:
            sets[doc_id].append(helpers.shingles(text, width))
    # Rows of a doc_id are one node: give each row a node and tie them.
    nodes = {(doc_id, k): s for doc_id, own in sets.items() for k, s in enumerate(own)}
    labels = {node: node for node in nodes}
    changed = True
    while changed:
        changed = False
        for a in nodes:
            for b in nodes:
                both = len(nodes[a] & nodes[b])
                linked = a[0] == b[0] or (nodes[a] and nodes[b] and 100 * both >= 80 * (len(nodes[a]) + len(nodes[b]) - both))
                if linked and labels[a] < labels[b]:
                    labels[b], changed = labels[a], True
    return {node[0]: label[0] for node, label in labels.items()}


@pytest.mark.parametrize(("width", "crowded", "block"), [(2, 100_000, 256), (5, 100_000, 256), (2, 2, 3)])
def test_components_equal_all_pairs(spark, monkeypatch, width, crowded, block):
    monkeypatch.setattr(near_dups, "CROWDED", crowded)
    monkeypatch.setattr(near_dups, "BLOCK", block)
    rows, docs = family(spark)
    found = near_dups.near_duplicates(docs, near_dups.Banding(words=width)).collect()
    expected = expected_components(rows, width)
    assert len(found) == len(rows)
    for row in found:
        assert row.component_id == (None if row.doc_id is None else expected[row.doc_id])
        assert row.kept == (row.doc_id is None or row.doc_id == row.component_id)
    assert Counter((r.doc_id, r.n_shingles) for r in found) == Counter((i, len(helpers.shingles(t, width))) for i, t in rows)


def test_awkward_documents_and_none(spark):
    found = near_dups.near_duplicates(helpers.awkward(spark)).collect()
    assert len(found) == len(helpers.awkward_rows())
    sets = {r[0]: helpers.shingles(r[1], 5) for r in helpers.awkward_rows() if r[0] is not None}
    expected = helpers.brute_components(sets)
    assert {r.doc_id: r.component_id for r in found if r.doc_id is not None} == expected
    assert near_dups.near_duplicates(helpers.empty(spark)).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(100, 160)] + [(5, 160), (7, 7)], "a long, b long")
    assert {r.label for r in near_dups.components(links).where("id <> 7").collect()} == {5}


# Mixing


def brute_mix(rows, quality, weights=(5, 2, 1), most=3):
    sizes = [(d, s, len(helpers.WORD.findall(t or ""))) for d, t, s in rows]
    sources = sorted({s for _, s, _ in sizes}, key=lambda s: (s is None, s or ""))
    size_of = {s: sum(n for _, own, n in sizes if own == s) for s in sources}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(sources)}
    targets, free, rest = {}, list(sources), sum(size_of.values())
    while True:
        total = sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] >= most * size_of[s] * total]
        if not over:
            break
        for s in over:
            targets[s] = float(most * size_of[s])
        rest, free = rest - sum(most * size_of[s] for s in over), [s for s in free if s not in over]
    targets |= {s: rest * weight[s] / sum(weight[s] for s in free) for s in free}
    result = []
    for s in sources:
        epochs = int(targets[s] // size_of[s]) if size_of[s] else 0
        rest = targets[s] - epochs * size_of[s]

        def key(item):
            digest = md5(f"0:{'null' if item[0] is None else item[0]}:{item[1]}".encode()).hexdigest()
            return -math.log((int(digest[:13], 16) + 0.5) / 2**52) / quality.get(item[0], 1.0), item[0] is not None, item[0] or 0, item[1]

        items = Counter((d, n) for d, own, n in sizes if own == s)
        left, chosen = sorted((i for i in items if i[1]), key=key), set()
        for _ in range(8):
            most, found = rest / 2, 0
            for item in left:
                total = item[1] * items[item]
                if total <= most:
                    if found + total > rest:
                        break
                    found += total
                    chosen.add(item)
            rest -= found
            left = [item for item in left if item not in chosen]
        if left:
            last = min(left, key=lambda item: (abs(item[1] * items[item] - rest), key(item)))
            if abs(last[1] * items[last] - rest) < rest:
                chosen.add(last)
        for item, count in items.items():
            result += [(*item, size_of[s], round(targets[s], 6), item[1] * (epochs + (item in chosen)))] * count
    return Counter(result)


@pytest.mark.parametrize("buckets", [4_096, 3])
def test_mix_equals_a_plain_sort(spark, monkeypatch, buckets):
    monkeypatch.setattr(mixing, "BUCKETS", buckets)
    rng = np.random.default_rng(2)
    rows = [(int(k), "w " * int(rng.integers(0, 40)), [None, "a", "b", "B", "é", "tiny"][min(5, int(rng.integers(0, 12)) // 2)]) for k in range(400)]
    rows += [(None, "x y z", "a"), (7, "x y", "a"), (7, "x y", "a"), (900, None, None), (901, "", "blank"), (902, "one two", "single")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    weights = {3: 5.0, 10: 0.1, 20: 2.0}
    quality = spark.createDataFrame(list(weights.items()), "doc_id long, weight double")
    found = mixing.mix(docs, quality).collect()
    assert Counter((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in found) == brute_mix(rows, weights)
    assert all(r.taken <= 3 * r["size"] for r in found)
    assert mixing.mixed(docs, quality).columns == docs.columns
    assert sum(r["size"] for r in found) == pytest.approx(sum({r.source_size: r.target for r in found}.values()), rel=0.2)


def test_large_documents_do_not_keep_out_small_ones(spark):
    """A document of nearly the whole budget, first by its key or not, leaves the budget to the others."""
    rows = [(k, "w " * 20, "a") for k in range(400)] + [(1000, "w " * 900, "a")] + [(5000, "w " * 5000, "b")]
    for seed in range(2):
        found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), seed=seed).collect()
        target, size = next((r.target, r.source_size) for r in found if r.doc_id == 0)
        assert 900 < target - size < 1800
        assert abs(sum(r.taken for r in found if r.doc_id < 5000) - target) <= 10


def test_every_source_comes_near_its_target(spark, sf_dir):
    docs = spark.read.parquet(f"{os.path.dirname(sf_dir)}/sf0.01/documents.parquet")
    items = mixing.mixed_items(docs).collect()
    for source in {r.source for r in items}:
        own = [r for r in items if r.source == source]
        target, size = own[0].target, own[0].source_size
        budget = target - target // size * size
        smallest = min((r["size"] * r.rows for r in own if r["size"]), default=0)
        taken = sum(r["size"] * r.rows * r.copies for r in own)
        assert smallest >= budget / 100 or abs(taken - target) <= target / 100, source


def test_mix_of_nothing(spark):
    assert mixing.mix(helpers.empty(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, " ", "a")], "doc_id long, text string, source string")
    assert {(r.taken, r.target) for r in mixing.mix(blank).collect()} == {(0, 0.0)}
    assert mixing.mix(helpers.awkward(spark)).count() == len(helpers.awkward_rows())


def test_native_operators_use_no_python(spark, sf_dir):
    from fieldspark.llm import pii

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for frame in (mixing.mix(docs), pii.pseudonymise(docs, "k")):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


# Top-k


def brute_top(rows, wanted, k):
    whole = [
        (i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    result = []
    for query, q in {(i, tuple(v)) for i, v in whole if wanted(i)}:
        scored = [(-sum(a * b for a, b in zip(q, v, strict=True)), i) for i, v in whole if i != query and len(v) == len(q)]
        result += [(query, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return Counter(result)


@pytest.mark.parametrize(("page", "block"), [(128, 65_536), (4, 60)])
def test_top_k_equals_all_scores(spark, monkeypatch, page, block):
    monkeypatch.setattr(topk, "PAGE", page)
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in rng.normal(size=6) * rng.choice([0.1, 1, 3])]) for i in range(400)]
    rows += [(1_000 + i, [0.5] * 6) for i in range(150)]  # equal vectors
    rows += [rows[0], rows[5], (2_000, None), (2_050, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2_100, [float("nan")] * 6), (2_150, [float("inf")] * 6)]
    rows += [(None, [1.0] * 6), (3_000, [1.0, 2.0]), (3_001, [2.0, 2.0]), (3_050, [4.0]), (-50, [0.5] * 6), (3_100, [])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("clash"))
    rows = [(i, None if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    found = topk.top_k(vectors, F.col("vec_id") % 50 == 0, 5, block)
    assert Counter(map(tuple, found.collect())) == brute_top(rows, lambda i: i % 50 == 0, 5)
    assert topk.top_k(vectors.where("false"), F.col("vec_id") % 50 == 0).count() == 0


def test_the_tree_leaves_nodes_out(monkeypatch):
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(size=(500, 8)) + 40 * rng.normal(size=8) for _ in range(12)]).round()
    tree = topk.MTree(np.column_stack([points, np.sqrt((points**2).sum(1).max() - (points**2).sum(1))]))
    for node, children in enumerate(tree.children):
        first, last = tree.span[node]
        assert (np.sqrt(((tree.points[first:last] - tree.pivots[node]) ** 2).sum(1)) <= tree.radius[node] + 1e-9).all()
        assert not children or [tree.span[c][0] for c in children][0] == first
    read = []

    class Watched(np.ndarray):
        def __matmul__(self, other):
            read.append(len(self))
            return np.asarray(self) @ other

    vectors = points[tree.order].astype(float).view(Watched)
    topk.search(tree, vectors, np.arange(len(points)), points[0], -1, 5, float((points[0] ** 2).sum() + (points**2).sum(1).max()))
    assert sum(read) < len(points) / 2


def test_large_components_use_exact_integers(spark):
    rows = [(0, [3e6, 1.0]), (1, [3e6, 2.0]), (2, [3e6, 3.0]), (3, [2.0**50, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.top_k(vectors, F.col("vec_id") == 0, 3).collect()
    edge = 2**63 - 1
    assert [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r.rank)] == [
        (3, min(edge, 2**58 * 768_000_000 + 65_536)), (2, 768_000_000**2 + 3 * 65_536), (1, 768_000_000**2 + 2 * 65_536)
    ]
