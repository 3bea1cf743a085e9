"""The trie of all conversation prefixes, by ROLLUP over positional turn ids.

A conversation is cut into blocks of ``BLOCK`` turns, one row a block with the ids of its turns in
columns t1, t2, ... A block is keyed by the node it continues from, so one GROUP BY over that node and
ROLLUP(t1, t2, ...) counts the members of all prefixes at once; grouping_id tells the depth. The blocks
of long conversations take part in the same grouping: the node before a block is known beforehand, as
its id is the exclusive or of one hash per (position, turn) of the prefix, a running aggregate.

A node's representative is its smallest member. Sums over a subtree count every node at its
representative only: with v(c, p) the value of node p of conversation c where c represents it, else 0,
the sum below a node of depth d is that of v(c, p) over its members c and p >= d. These are suffix
sums within a conversation, added up per node.

What may be hot is split: turns of one conversation lie across range partitions and slices of
``SLICE`` blocks, equal conversations meet in partial aggregates, a node's children find their parent by
a broadcast if it has more than a thousandth of all nodes, and the ids of the conversations that
end in a node are joined to pieces before one task hashes the pieces one by one.

Turns are told apart by 128 bits of their role and text, nodes by 128 bits of their turns.

Defined cases: a NULL role or text counts as empty. Turns follow turn (NULL first), role and text; equal
rows are turns of their own. Rows without conv_id take no part. An empty table has no nodes, not even
a root. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldspark.llm.turns import placed, with_positions
from fieldspark.session import stored

# Turns of a block, that is columns of the rollup.
BLOCK = 8
# Blocks of a conversation that one window task orders.
SLICE = 512
# Turns whose shift is looked up with one key.
STRETCH = 4_096
# Ids of ending conversations in one piece, and the longest head two conversations share.
PIECE, HEAD = 512, 8

TURN_IDS = [f"t{k}" for k in range(1, BLOCK + 1)]


def turns_of(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, pos, turn_id): turn_id holds 16 bytes of hash and 8 bytes of the text's size."""
    text = F.coalesce("text", F.lit(""))
    role = F.coalesce("role", F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")
    )
    told = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
    size = F.unhex(F.lpad(F.hex(F.octet_length("text").cast("long")), 16, "0"))
    ordered = placed(rows, ["conv_id", F.concat(told, size).alias("turn_id")], "trie-places")
    return stored(with_positions(ordered).select("conv_id", "pos", "turn_id"), "trie-turns")


def with_shared_heads(turns: DataFrame, group: int = 5, heads: int = HEAD + 1) -> DataFrame:
    """Conversations that share heads: h turns of the first one of each group, then the own ones after h.

    h is the CRC-32 of conv_id modulo ``heads``.
    """
    lengths = stored(turns.groupBy("conv_id").agg(F.max("pos").alias("length")), "trie-lengths")
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads))
    wanted = lengths.withColumn("h", h).withColumn("base", F.expr(f"conv_id - conv_id % {group}"))
    first = turns.where(F.col("pos") < heads).select(F.col("conv_id").alias("base"), "pos", "turn_id")
    borrowed = wanted.join(first, "base").where("pos <= h").select("conv_id", "pos", "turn_id")

    # A short first conversation moves the own turns forward. One key a stretch keeps long conversations apart.
    shifts = wanted.join(lengths.select(F.col("conv_id").alias("base"), F.col("length").alias("there")), "base", "left").select(
        "conv_id", (F.least("h", F.coalesce("there", F.lit(0))) - F.col("h")).alias("shift"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"length div {STRETCH}"))).alias("stretch"),
    )
    own = turns.where(F.col("pos") > h).withColumn("stretch", F.expr(f"pos div {STRETCH}")).join(shifts, ["conv_id", "stretch"])
    return borrowed.union(own.select("conv_id", (F.col("pos") + F.col("shift")).alias("pos"), "turn_id"))


def _node_hash(salt: int, pos: Column, turn_id: Column) -> Column:
    return F.xxhash64(F.lit(salt), pos.cast("long"), turn_id)


def _xor(columns: list[Column]) -> Column:
    result = F.lit(0).cast("long")
    for column in columns:
        result = result.bitwiseXOR(column)
    return result


def _running(blocks: DataFrame, fold, columns: dict[str, str], backwards: bool = False) -> DataFrame:
    """Fold ``columns`` over the blocks of a conversation before each one (after it if ``backwards``).

    Slices are folded first, so that no task orders more blocks than a slice has, or than there are slices.
    """
    def direction(name):
        return F.col(name).desc() if backwards else F.col(name).asc()

    none = F.lit(0).cast("long")
    sliced = blocks.withColumn("slice", F.expr(f"block div {SLICE}"))
    before = W.partitionBy("conv_id").orderBy(direction("slice")).rowsBetween(W.unboundedPreceding, -1)
    offsets = sliced.groupBy("conv_id", "slice").agg(*[fold(c).alias(c) for c in columns]).select(
        "conv_id", "slice", *[F.coalesce(fold(c).over(before), none).alias(f"{c}_offset") for c in columns]
    )
    within = W.partitionBy("conv_id", "slice").orderBy(direction("block")).rowsBetween(W.unboundedPreceding, -1)
    folded = {}
    for column, name in columns.items():
        inner = F.coalesce(fold(column).over(within), none)
        offset = F.col(f"{column}_offset")
        folded[name] = offset.bitwiseXOR(inner) if fold is F.bit_xor else offset + inner
    return sliced.join(offsets, ["conv_id", "slice"]).withColumns(folded).drop("slice", *[f"{c}_offset" for c in columns])


def prefix_trie(turns: DataFrame, conv_ids: DataFrame) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv_id, pos, turn_id).

    ``conv_ids`` are all conversations, those without turns included. Columns: conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    spark = turns.sparkSession
    slot = F.pmod(F.col("pos") - 1, F.lit(BLOCK)) + 1
    cut = turns.select(
        "conv_id", F.expr(f"(pos - 1) div {BLOCK}").alias("block"), slot.alias("slot"), "turn_id",
        _node_hash(1, F.col("pos"), F.col("turn_id")).alias("xa"), _node_hash(2, F.col("pos"), F.col("turn_id")).alias("xb"),
    ).groupBy("conv_id", "block").agg(
        *[F.max(F.when(F.col("slot") == k, F.col("turn_id"))).alias(name) for k, name in enumerate(TURN_IDS, 1)],
        F.bit_xor("xa").alias("xa"), F.bit_xor("xb").alias("xb"),
    )
    blocks = stored(_running(stored(cut, "trie-cut"), F.bit_xor, {"xa": "above_a", "xb": "above_b"}), "trie-blocks")

    nodes = stored(_count_members(spark, blocks), "trie-nodes")
    children = stored(
        nodes.groupBy(F.col("parent_a").alias("a"), F.col("parent_b").alias("b")).agg(F.count("*").alias("n_children")),
        "trie-children",
    )
    none = F.lit(None).cast("long")
    root = conv_ids.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"),
        none.alias("parent_a"), none.alias("parent_b"), "conv_id", "n_convs", F.lit(0).cast("long").alias("bytes"),
    )
    full = stored(
        nodes.unionByName(root).join(children, ["a", "b"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))),
        "trie-full",
    )
    sums = _subtree_sums(blocks, full)
    ends = _end_digests(conv_ids, blocks)
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        _with_parents(full, children).join(sums, ["a", "b"], "left").join(ends, ["a", "b"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
            # A root without children is its own and only leaf.
            F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
            F.coalesce("saved_tokens", F.lit(0)).cast("long").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        )
    )


def _count_members(spark, blocks: DataFrame) -> DataFrame:
    """All nodes but the root with their ids, their parents' ids, smallest member and number of members."""
    ids = ", ".join(TURN_IDS)
    grouped = spark.sql(
        f"""SELECT above_a, above_b, block, {ids}, grouping_id() AS grouping, min(conv_id) AS conv_id, count(*) AS n_convs
        FROM {{blocks}} GROUP BY above_a, above_b, block, ROLLUP({ids})""",
        blocks=blocks,
    )
    # Each rolled-up column sets one bit.
    level = F.lit(BLOCK) - F.bit_count("grouping")
    last = F.element_at(F.array(*TURN_IDS), F.col("level"))
    # A last turn that is NULL belongs to conversations that end before it.
    nodes = grouped.withColumn("level", level).where("level > 0").withColumn("last", last).where("last is not null")

    def node_id(salt: int, above: str, deep: Column) -> Column:
        hashes = [
            F.when(F.lit(k) <= deep, _node_hash(salt, F.col("block") * BLOCK + k, F.col(name))).otherwise(F.lit(0).cast("long"))
            for k, name in enumerate(TURN_IDS, 1)
        ]
        return F.col(above).bitwiseXOR(_xor(hashes))

    level = F.col("level")
    return nodes.select(
        (F.col("block") * BLOCK + level).cast("long").alias("depth"),
        node_id(1, "above_a", level).alias("a"), node_id(2, "above_b", level).alias("b"),
        node_id(1, "above_a", level - 1).alias("parent_a"), node_id(2, "above_b", level - 1).alias("parent_b"),
        "conv_id", "n_convs", F.conv(F.hex(F.substring("last", 17, 8)), 16, 10).cast("long").alias("bytes"),
    )


def _with_parents(full: DataFrame, children: DataFrame) -> DataFrame:
    """Add ``parent_conv_id``. At most a thousand nodes have more than a thousandth of all as children."""
    many = full.count() / 1_000
    parents = full.select(F.col("a").alias("parent_a"), F.col("b").alias("parent_b"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    hot = F.broadcast(parents.where(F.col("n_children") > many).drop("n_children"))
    rest = parents.where((F.col("n_children") > 0) & (F.col("n_children") <= many)).drop("n_children")
    key = ["parent_a", "parent_b"]
    return full.join(hot, key, "inner").unionByName(
        full.join(hot, key, "left_anti").join(rest, key, "left")
    )


def _subtree_sums(blocks: DataFrame, full: DataFrame) -> DataFrame:
    """Rows (a, b, n_leaves, saved_tokens) of all nodes with something below or at them."""
    level = F.pmod(F.col("depth") - 1, F.lit(BLOCK)) + 1
    valued = full.where("depth > 0").select(
        "conv_id", F.expr(f"(depth - 1) div {BLOCK}").alias("block"), level.alias("level"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"), (F.col("n_children") == 0).cast("long").alias("leaf"),
    )
    each = [
        F.sum(F.when(F.col("level") == k, F.col(column))).alias(f"{column}{k}")
        for k in range(1, BLOCK + 1) for column in ("saved", "leaf")
    ]
    represented = valued.groupBy("conv_id", "block").agg(*each, F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    # The nodes a conversation represents are its deepest ones; blocks before them need what comes after.
    here = blocks.join(represented, ["conv_id", "block"], "left").fillna(0, [c for c in represented.columns if c not in ("conv_id", "block")])
    after = _running(here, F.sum, {"saved": "saved_after", "leaf": "leaf_after"}, backwards=True)

    # What lies below a turn, itself included, from the last turn to the first; 0 stands for all of the block.
    below = {BLOCK + 1: (F.col("saved_after"), F.col("leaf_after"))}
    for k in range(BLOCK, 0, -1):
        below[k] = (below[k + 1][0] + F.col(f"saved{k}"), below[k + 1][1] + F.col(f"leaf{k}"))
    below[0] = below[1]
    a, b = F.col("above_a"), F.col("above_b")
    points = []
    for k in range(BLOCK + 1):
        if k:
            pos = F.col("block") * BLOCK + k
            a, b = (x.bitwiseXOR(_node_hash(salt, pos, F.col(f"t{k}"))) for x, salt in ((a, 1), (b, 2)))
        saved, leaf = below[k]
        # The point before the first turn stands for the root; in later blocks it is the end of the block before.
        there = F.col("block") == 0 if k == 0 else F.col(f"t{k}").isNotNull()
        points.append(F.when(there & (saved + leaf > 0), F.struct(a.alias("a"), b.alias("b"), saved.alias("saved"), leaf.alias("leaf"))))
    return (
        after.select(F.explode(F.array_compact(F.array(*points))).alias("x")).select("x.*")
        .groupBy("a", "b").agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    )


def _end_digests(conv_ids: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rows (a, b, ends_sha256) of the nodes in which conversations end."""
    none = F.lit(0).cast("long")
    ends = (
        conv_ids.select("conv_id", none.alias("a"), none.alias("b"))
        .union(blocks.select("conv_id", "xa", "xb")).groupBy("conv_id").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    )

    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            held: list[int] = []

            def close():
                if held:
                    for column, value in zip(out, (*node, held[0], ",".join(map(str, held))), strict=True):
                        column.append(value)
                    held.clear()

            node = None
            for a, b, conv_id in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "conv_id")), strict=True):
                if node != (a, b) or len(held) == PIECE:
                    close()
                    node = (a, b)
                held.append(conv_id)
            close()
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types, strict=True)], ["a", "b", "first", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, running = None, None
        for batch in batches:
            out: list[list] = [[], [], []]
            for a, b, ids in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("ids"), strict=True):
                if node != (a, b):
                    if node is not None:
                        for column, value in zip(out, (*node, running.hexdigest()), strict=True):
                            column.append(value)
                    node, running = (a, b), hashlib.sha256()
                else:
                    running.update(b",")
                running.update(ids.as_py().encode())
            yield _digest_batch(out)
        if node is not None:
            yield _digest_batch([[node[0]], [node[1]], [running.hexdigest()]])

    order = ["a", "b", "conv_id"]
    pieces = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(join_ids, "a long, b long, first long, ids string")
    return pieces.repartition("a", "b").sortWithinPartitions("a", "b", "first").mapInArrow(digests, "a long, b long, ends_sha256 string")


def _digest_batch(columns: list[list]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, types, strict=True)], ["a", "b", "ends_sha256"])
