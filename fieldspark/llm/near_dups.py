"""Near-duplicate documents by MinHash with tensored banding.

Ordinary banding hashes a document with ``tables * width`` minhashes. Here two small
collections of hash tuples are kept, ``left`` and ``right``, and the key of table (i, j) joins
left tuple i with right tuple j: 10 x 14 = 140 tables need 10*2 + 14*3 = 62 minhashes in place
of 700. Two documents of similarity s meet in some table with probability
(1 - (1 - s^2)^10) * (1 - (1 - s^3)^14), which is 0.9999 at 0.8 and more above.

1. one pass computes set size, set fingerprint and the hash tuples of each document;
2. documents with equal sets form a class; only the smallest doc_id of a class goes on;
3. in each table bucket the smallest member is the centre, and every member is compared with it
   on the full sets. Members in the centre's component need no comparison with each other. The
   others are compared with all members of that centre, block by block inside tasks, which give
   back only links that join components: rows never grow with the square of a bucket;
4. components come from label propagation with pointer jumping.

Sets hold 64-bit hashes of shingles and are compared whole.

Defined cases: a NULL, empty or blank text has the empty set and links with nothing. A text
with fewer words than a shingle has one shingle, the whole sequence. Rows that share a doc_id are
one document: a link of one row counts for all, and each row is returned. A NULL doc_id takes no
part: component_id is NULL and kept is true. An empty table gives no rows. Columns other than
doc_id and text are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldspark.llm.common import over_batches, texts, window_hashes, word_hashes
from fieldspark.session import stored

# Documents of one left tuple beyond which its rows are spread over the tasks.
CROWDED = 100_000
# Sets that one task compares with as many others.
BLOCK = 256
# Shingles hashed at once: bounds a task's memory, and keeps the arrays in the processor's cache.
CHUNK = 1 << 16


@dataclass(frozen=True)
class Banding:
    """Shingle width, similarity in percent, and the two tuple collections as (tuples, width)."""

    words: int = 5
    percent: int = 80
    left: tuple[int, int] = (10, 2)
    right: tuple[int, int] = (14, 3)

    @property
    def hashes(self) -> int:
        return self.left[0] * self.left[1] + self.right[0] * self.right[1]


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text, A-Z lower-cased."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(word_hashes(words), min(width, len(words))))


def near_duplicates(docs: DataFrame, banding: Banding = Banding()) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one per row of ``docs``."""
    rows = stored(_signatures(docs, banding), "near-dup-sets")
    # Rows without a set are classes of their own; keyed by doc_id they spread over the tasks.
    by_class = rows.withColumn("class", F.coalesce("set_id", F.encode(F.concat(F.lit("empty "), "doc_id"), "utf-8")))

    classes = (
        rows.where("set_id is not null and doc_id is not null")
        .groupBy("set_id").agg(F.min(F.struct("doc_id", "left", "right")).alias("c"))
        .select("set_id", F.col("c.doc_id").alias("id"), "c.left", "c.right")
    )
    classes = stored(classes, "near-dup-classes")
    links = _links(docs, classes.select("id", "left", "right"), banding)
    # Rows that share a doc_id tie the classes of their sets together.
    same_document = (
        rows.where("set_id is not null").join(classes.select("set_id", "id"), "set_id")
        .where("id <> doc_id").select(F.col("id").alias("a"), F.col("doc_id").alias("b"))
        .join(classes.select(F.col("id").alias("b")), "b", "left_semi").select("a", "b").distinct()
    )
    labels = components(stored(links.union(same_document), "near-dup-links"))

    return (
        by_class.join(classes.select(F.col("set_id").alias("class"), "id"), "class", "left")
        .withColumn("id", F.coalesce("id", "doc_id"))
        .join(labels, "id", "left")
        .select("doc_id", "n_shingles", F.coalesce("label", "id").alias("component_id"))
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _signatures(docs: DataFrame, banding: Banding) -> DataFrame:
    """doc_id, set size, set fingerprint (NULL for an empty set) and both tuple collections."""
    factors = np.random.default_rng(20240501).integers(0, 1 << 63, banding.hashes, np.uint64) * np.uint64(2) + np.uint64(1)

    def minhashes(sets: list[np.ndarray]) -> np.ndarray:
        flat = np.concatenate(sets)
        starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
        return np.stack([np.minimum.reduceat(flat * factor, starts) for factor in factors], axis=1)

    def tuples(mins: np.ndarray, first: int, count: int, width: int) -> np.ndarray:
        part = mins[:, first:first + count * width].reshape(len(mins), count, width)
        folded = np.zeros(part.shape[:2], np.uint64)
        for place in range(width):
            folded = (folded ^ part[:, :, place]) * np.uint64(0x9E3779B97F4A7C15)
            folded ^= folded >> np.uint64(29)
        return folded.view(np.int64)

    def as_lists(values: np.ndarray) -> pa.ListArray:
        offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1)))

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, prints, mins, pending, waiting = [], [], [], [], 0
            for text in texts(batch):
                found = shingle_set(text, banding.words)
                sizes.append(len(found))
                prints.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                # An empty set gets the hashes of a stand-in; without a fingerprint they are not used.
                pending.append(found if len(found) else np.zeros(1, np.uint64))
                waiting += len(found)
                if waiting >= CHUNK:
                    mins.append(minhashes(pending))
                    pending, waiting = [], 0
            if pending:
                mins.append(minhashes(pending))
            all_mins = np.concatenate(mins)
            (n_left, w_left), (n_right, w_right) = banding.left, banding.right
            return pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()),
                as_lists(tuples(all_mins, 0, n_left, w_left)),
                as_lists((tuples(all_mins, n_left * w_left, n_right, w_right) >> 32).astype(np.int32)),
            ], ["doc_id", "n_shingles", "set_id", "left", "right"])
        return step

    schema = "doc_id long, n_shingles long, set_id binary, left array<long>, right array<int>"
    return over_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), schema, start)


def _links(docs: DataFrame, classes: DataFrame, banding: Banding) -> DataFrame:
    """Links (a, b) between classes that connect all similar classes of a shared bucket."""
    members = stored(_members(classes), "near-dup-members")
    sets = stored(_sets(docs, members, banding.words), "near-dup-items")
    stars = stored(_compare_with_centres(members, sets, banding.percent), "near-dup-stars")
    return stars.union(_compare_rest(members, sets, components(stars), banding.percent))


def _members(classes: DataFrame) -> DataFrame:
    """Rows (centre, id): the members of all buckets with the bucket's smallest member.

    Rows travel once per left tuple, with all right tuples, and unfold to table keys where they
    arrive. Left tuples of very many documents are unfolded first: their keys spread over the tasks,
    and the join back to the centres can be split within a key.
    """
    packed = classes.select("id", F.posexplode("left").alias("i", "l"), "right").select(
        "id", F.xxhash64("i", "l").alias("left_key"), "right"
    )
    crowded = stored(packed.groupBy("left_key").count().where(F.col("count") > CROWDED).select("left_key"), "near-dup-crowded")
    together = packed.join(crowded, "left_key", "left_anti").repartition("left_key")
    apart = packed.join(crowded, "left_key", "left_semi")

    table_key = ["left_key", "j", "r"]

    def unfolded(rows: DataFrame) -> DataFrame:
        return rows.select("id", "left_key", F.posexplode("right").alias("j", "r"))

    # A left tuple's rows are together already and no more than CROWDED, so a window finds the centres in place.
    few = unfolded(together).withColumn("centre", F.min("id").over(W.partitionBy(*table_key)))
    keys = unfolded(apart)
    centres = keys.groupBy(*table_key).agg(F.min("id").alias("centre"), F.count("*").alias("n")).where("n > 1")
    many = keys.join(centres.drop("n"), table_key)
    return few.select("centre", "id").union(many.select("centre", "id")).where("id <> centre").distinct()


def _sets(docs: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """The whole sets (id, n, items) of all documents that share a bucket with another."""
    wanted = members.select("id").union(members.select("centre")).distinct()
    chosen = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(
        wanted.hint("merge"), "id", "left_semi"  # the ids grow with the corpus: never broadcast
    )

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [shingle_set(text, words) for text in texts(batch)]
            return pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array([len(s) for s in found], pa.int64()),
                pa.array([s.tobytes() for s in found], pa.binary()),
            ], ["id", "n", "items"])
        return step

    return over_batches(chosen, "id long, n long, items binary", start)


def _compare_with_centres(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between a bucket's centre a and its members."""
    of_centre = sets.select(F.col("id").alias("centre"), F.col("n").alias("n_c"), F.col("items").alias("of_centre"))
    # Sizes alone rule a pair out when even full containment stays below the threshold.
    sizes_allow = 100 * F.least("n", "n_c") >= percent * F.greatest("n", "n_c")
    sized = (
        members.join(sets.select("id", "n"), "id").join(of_centre.drop("of_centre"), "centre")
        .where(sizes_allow).select("centre", "id").distinct()
    )
    joined = sized.join(sets, "id").join(of_centre, "centre").select("centre", "id", "items", "of_centre")

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            similar = []
            for one, other in zip(batch.column("items"), batch.column("of_centre"), strict=True):
                x, y = (np.frombuffer(value.as_buffer(), np.uint64) for value in (one, other))
                both = len(np.intersect1d(x, y, assume_unique=True))
                similar.append(100 * both >= percent * (len(x) + len(y) - both))
            found = pa.RecordBatch.from_arrays([batch.column("centre"), batch.column("id")], ["a", "b"])
            return found.filter(pa.array(similar, pa.bool_()))
        return step

    return over_batches(joined, "a long, b long", start)


def _compare_rest(members: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members of a centre that are still in different components.

    Every member outside the centre's own component is compared with all members. Both sides
    are dealt into blocks; a task takes one block of each, whatever the size of the group.
    """
    label = F.coalesce("label", "id").alias("label")
    labelled = members.join(labels, "id", "left").select("centre", "id", label)
    home = labels.select(F.col("id").alias("centre"), F.col("label").alias("home"))
    labelled = labelled.join(home, "centre", "left").select(
        "centre", "id", "label", (F.col("label") == F.coalesce("home", "centre")).alias("at_home")
    )
    sizes = (
        labelled.groupBy("centre").agg(F.count("*").alias("n"), F.count_if(~F.col("at_home")).alias("n_away"))
        .where("n > 1 and n_away > 0")
    )

    def blocks(count):
        return F.ceil(F.col(count) / BLOCK).cast("int")

    open_groups = labelled.join(sizes, "centre").withColumn("rows", blocks("n_away")).withColumn("columns", blocks("n"))
    with_sets = open_groups.join(sets.select("id", "items"), "id")

    def dealt(side: DataFrame, own: str, other: str, asks: bool) -> DataFrame:
        mine = F.pmod(F.xxhash64("id"), F.col(own)).cast("int")
        others = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        row, column = (mine, others) if asks else (others, mine)
        return side.select("centre", row.alias("row"), column.alias("column"), F.lit(asks).alias("asks"), "id", "label", "items")

    away = dealt(with_sets.where("not at_home"), "rows", "columns", True)
    every = dealt(with_sets, "columns", "rows", False)

    def links(group: pa.Table) -> pa.Table:
        asks = group.column("asks")
        return _block_links(group.filter(asks), group.filter(pc.invert(asks)), percent)

    return away.union(every).groupBy("centre", "row", "column").applyInArrow(links, "a long, b long")


def _block_links(one: pa.Table, other: pa.Table, percent: int) -> pa.Table:
    """Links from rows of ``one`` to rows of ``other`` that join components with different labels."""
    found: list[tuple[int, int]] = []
    if one.num_rows and other.num_rows:
        sets = [np.frombuffer(value.as_buffer(), np.uint64) for value in other.column("items")]
        sizes = np.array([len(s) for s in sets])
        items = np.concatenate(sets)
        known, places = np.unique(items, return_inverse=True)
        starts = np.cumsum(sizes) - sizes
        other_ids, other_labels = other.column("id").to_pylist(), other.column("label").to_pylist()
        parent: dict[int, int] = {}

        def root(label: int) -> int:
            while parent.get(label, label) != label:
                label = parent[label]
            return label

        for a, label, value in zip(one.column("id").to_pylist(), one.column("label").to_pylist(), one.column("items"), strict=True):
            mine = np.frombuffer(value.as_buffer(), np.uint64)
            at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
            flags = np.zeros(len(known), np.int64)
            flags[at[known[at] == mine]] = 1
            both = np.add.reduceat(flags[places], starts)
            for k in np.flatnonzero(100 * both >= percent * (len(mine) + sizes - both)):
                x, y = root(label), root(other_labels[k])
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    found.append((a, other_ids[k]))
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def components(links: DataFrame) -> DataFrame:
    """Rows (id, label): the smallest id reachable over links (a, b); ids without links are left out."""
    both = stored(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "component-links")
    labels = stored(
        both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("label")), "component-labels"
    )
    while True:
        near = (
            both.join(labels.select(F.col("id").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        )
        stepped = labels.join(near, "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        # Pointer jumping: a label is itself an id, whose label may be smaller already.
        jumped = stepped.join(
            labels.select(F.col("id").alias("label"), F.col("label").alias("further")), "label", "left"
        ).select("id", "old", F.least("label", F.coalesce("further", "label")).alias("label"))
        moved = stored(jumped, "component-labels")
        labels = moved.select("id", "label")
        if moved.where("label <> old").isEmpty():
            return labels
