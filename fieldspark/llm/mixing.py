"""Mixing sources to target weights by weighted sampling without replacement (Efraimidis-Spirakis).

Each document draws u in (0, 1) from a hash of its doc_id and size and waits for -ln(u) / quality weight:
sorted by that key, the documents of a source are a weighted sample at every length. A source takes as
many complete epochs of all its documents as fit its target; the rest of the target, its budget, goes to
the documents with the smallest keys.

A document that does not fit must not keep out those after it, so the budget is filled in rounds. A round
looks at the documents not taken yet of at most half the rest of the budget and takes them by key as
long as their running sum fits; so each round at least halves the rest, or runs out of such documents. After
the rounds the one document that brings the sum nearest to the budget follows.

No source is sorted as a whole. Keys fall into ``BUCKETS`` slices per source, whose sums are
pre-aggregated; their running sums show the one slice in which a round ends, and only the
documents of that slice are ordered among themselves. A round is remembered as its size limit and the
last key it took, which decide every document.

Targets: the sources in code point order, NULL last, get weights in turn and share the sum of all
sizes by weight. A target stops at ``max_epochs`` times its source's size; the excess goes to the
others by weight, until none is above. With sources ordered by size / weight, those at their stop
are the first ones, so one running sum finds them.

Everything is built from DataFrame functions.

Defined cases: a NULL or blank text has size 0 and takes nothing. A NULL source is a source of its
own. A NULL quality weight counts as 1; weights must be positive. Rows of one source that share doc_id and
size are one item: all are taken, or none. An empty table gives no rows. The result has no other columns
of ``docs``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldspark.llm.common import WORD_PATTERN
from fieldspark.session import stored

BUCKETS = 4_096
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
ROUNDS = 8


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def draw(seed: int) -> Column:
    """Uniform number in (0, 1) from the md5 of seed, doc_id and size: 52 bits, never 0 or 1."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), doc_id, F.lit(":"), F.col("size").cast("string")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Rows (source, source_size, target) from rows (source, source_size), one per source."""
    turn = W.orderBy(F.col("source").asc_nulls_last())
    turns = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(turn) - 1) % len(weights) + 1).cast("int"))
    weighed = sizes.withColumn("weight", turns.cast("long")).withColumn("stop", F.col("source_size") * max_epochs)

    # Before a source in this order, all are at their stop; it and those after it share the rest.
    fullness = W.orderBy(F.col("stop") / F.col("weight"), F.col("source").asc_nulls_last())
    all_rows = W.partitionBy()
    rest = F.sum("source_size").over(all_rows) - (F.sum("stop").over(fullness) - F.col("stop"))
    sharing = F.sum("weight").over(all_rows) - (F.sum("weight").over(fullness) - F.col("weight"))
    shared = weighed.withColumn("rest", rest).withColumn("sharing", sharing)
    shared = shared.withColumn("free", F.col("stop").cast("double") * F.col("sharing") > F.col("rest").cast("double") * F.col("weight"))
    # The first source below its stop sets the share of all that follow.
    first_free = F.min(F.when(F.col("free"), F.struct(
        F.col("stop") / F.col("weight"), F.col("source").isNull(), "source", "rest", "sharing"
    ))).over(all_rows)
    level = shared.withColumn("level", first_free)
    share = F.col("level.rest").cast("double") * F.col("weight") / F.col("level.sharing")
    target = F.least(F.col("stop").cast("double"), F.coalesce(share, F.col("stop").cast("double")))
    return level.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame, quality: DataFrame | None = None, weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS, seed: int = 0,
) -> DataFrame:
    """Rows (doc_id, size, source_size, target, taken, copies), one per row of ``docs``.

    ``quality``: rows (doc_id, weight), at most one per doc_id; without it all weigh 1.
    ``copies`` is how often the mix takes the document, ``taken`` its words, repeats counted.
    """
    items = mixed_items(docs, quality, weights, max_epochs, seed)
    return items.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )


def mixed_items(
    docs: DataFrame, quality: DataFrame | None = None, weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS, seed: int = 0,
) -> DataFrame:
    """Rows (source, doc_id, size, rows, source_size, target, copies), one per item."""
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count().alias("size"))
    # Equal rows meet in partial aggregates; what is left is one row of a few numbers per item, stored once.
    items = sized.groupBy("source", "doc_id", "size").agg(F.count("*").alias("rows"))
    if quality is not None:
        own = quality.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("weight").cast("double").alias("quality"))
        items = items.join(own, "doc_id", "left")
    else:
        items = items.withColumn("quality", F.lit(1.0))
    key = -F.log(draw(seed)) / F.coalesce("quality", F.lit(1.0))
    keyed = stored(items.withColumn("key", key).drop("quality").withColumn("total", F.col("rows") * F.col("size")).withColumn(
        "bucket", F.least(F.floor((1 - F.exp(-F.col("key"))) * BUCKETS), F.lit(BUCKETS - 1)).cast("int")
    ), "mixing-keys")

    slices = stored(keyed.groupBy("source", "bucket").agg(F.sum("total").alias("in_slice")), "mixing-slices")
    targets = source_targets(slices.groupBy("source").agg(F.sum("in_slice").alias("source_size")), weights, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    state = targets.withColumn("epochs", epochs).withColumn(
        "rest", F.col("target") - (F.col("epochs") * F.col("source_size")).cast("double")
    ).withColumn("rounds", F.expr(f"cast(array() as {_ROUND})"))
    state = stored(state, "mixing-state")
    for _ in range(ROUNDS):
        after = stored(_round(keyed, slices, state), "mixing-state")
        if after.where("took > 0").isEmpty():
            break
        state = after.drop("took")

    decided = _with_state(keyed, slices, state)
    nearest = (
        decided.where(~_taken() & (F.col("total") > 0)).groupBy("source")
        .agg(F.min(F.struct(F.abs(F.col("total") - F.col("rest")).alias("off"), *_order(), F.col("rest").alias("rest"))).alias("pick"))
        .where("pick.off < pick.rest").select("source", F.struct("pick.bucket", "pick.key", "pick.known", "pick.id", "pick.size").alias("last"))
    )
    last = _by_slice(slices, nearest).select("source", "bucket", "last")
    same = F.col("source").eqNullSafe(F.col("_of")) & (F.col("bucket") == F.col("_slice"))
    decided = decided.join(last.select(F.col("source").alias("_of"), F.col("bucket").alias("_slice"), "last"), same, "left")
    chosen = _taken() | F.coalesce(F.struct(*_order()) == F.col("last"), F.lit(False))
    return decided.select(
        "source", "doc_id", "size", "rows", "source_size", "target", (F.col("epochs") + chosen.cast("long")).alias("copies")
    )


_ROUND = "array<struct<most: double, upto: struct<bucket: int, key: double, known: boolean, id: bigint, size: bigint>>>"


def _order() -> list[Column]:
    """The order of a source's items; a NULL doc_id comes before others of the same key."""
    return [
        F.col("bucket").alias("bucket"), F.col("key").alias("key"), F.col("doc_id").isNotNull().alias("known"),
        F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"), F.col("size").cast("long").alias("size"),
    ]


def _taken() -> Column:
    """Whether one of the rounds so far took the item."""
    return F.exists("rounds", lambda r: (F.col("total") <= r["most"]) & (F.struct(*_order()) <= r["upto"]))


def _by_slice(slices: DataFrame, state: DataFrame) -> DataFrame:
    """A row per source as a row per slice, so that no key of a join has a whole source."""
    sources = state.withColumnRenamed("source", "_source")
    return slices.select("source", "bucket").join(sources, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def _with_state(keyed: DataFrame, slices: DataFrame, state: DataFrame) -> DataFrame:
    known = _by_slice(slices, state).withColumnRenamed("source", "_of").withColumnRenamed("bucket", "_slice")
    same = F.col("source").eqNullSafe(F.col("_of")) & (F.col("bucket") == F.col("_slice"))
    return keyed.join(known, same).drop("_of", "_slice")


def _round(keyed: DataFrame, slices: DataFrame, state: DataFrame) -> DataFrame:
    """``state`` after one more round, and how many words that took."""
    half = F.col("rest") / 2
    open_items = _with_state(keyed, slices, state).where(~_taken() & (F.col("total") > 0) & (F.col("total") <= half))
    open_items = open_items.select("source", *[c for c in ("bucket", "key", "doc_id", "size", "total", "rest")])
    sums = open_items.groupBy("source", "bucket").agg(F.sum("total").alias("in_slice"), F.first("rest").alias("rest"))
    upto = F.sum("in_slice").over(W.partitionBy("source").orderBy("bucket"))
    sums = sums.withColumn("before", upto - F.col("in_slice"))
    # The slice in which the running sum passes the rest, if there is one.
    end = sums.where((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("in_slice") > F.col("rest"))).select(
        F.col("source").alias("_of"), F.col("bucket").alias("_slice"), "before"
    )
    same = F.col("source").eqNullSafe(F.col("_of")) & (F.col("bucket") == F.col("_slice"))
    within = W.partitionBy("source", "bucket").orderBy("key", F.col("doc_id").asc_nulls_first(), "size").rowsBetween(W.unboundedPreceding, 0)
    running = open_items.join(end, same).withColumn("sum", F.col("before") + F.sum("total").over(within))
    fits = F.col("sum") <= F.col("rest")
    no_item = F.struct(
        F.col("bucket").alias("bucket"), F.lit(-1.0).alias("key"), F.lit(False).alias("known"),
        F.lit(0).cast("long").alias("id"), F.lit(0).cast("long").alias("size"),
    )
    # Without a fitting item the slices before it are all that is taken.
    ended = running.groupBy("source").agg(
        F.max(F.when(fits, F.struct(*_order())).otherwise(no_item)).alias("upto"),
        F.max(F.when(fits, F.col("sum")).otherwise(F.col("before"))).alias("took"),
    )
    all_items = F.struct(
        F.lit(BUCKETS).alias("bucket"), F.lit(0.0).alias("key"), F.lit(False).alias("known"),
        F.lit(0).cast("long").alias("id"), F.lit(0).cast("long").alias("size"),
    )
    whole = sums.groupBy("source").agg(F.sum("in_slice").alias("all"))
    result = state.join(
        whole.join(ended.withColumnRenamed("source", "_ended"), F.col("source").eqNullSafe(F.col("_ended")), "left").select(
            F.col("source").alias("_of"), F.coalesce("upto", all_items).alias("upto"), F.coalesce("took", "all").alias("took")
        ), F.col("source").eqNullSafe(F.col("_of")), "left",
    )
    done = F.array(F.struct((F.col("rest") / 2).alias("most"), F.col("upto").alias("upto")))
    took = F.coalesce("took", F.lit(0))
    return result.select(
        "source", "source_size", "target", "epochs", (F.col("rest") - took).alias("rest"),
        F.when(F.col("upto").isNull(), F.col("rounds")).otherwise(F.concat("rounds", done)).cast(_ROUND).alias("rounds"), took.alias("took"),
    )


def label_weights(labels: DataFrame) -> DataFrame:
    """Quality weights (doc_id, weight) from labels: good 2, bad 0.5; without a label a document weighs 1."""
    graded = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return graded.select("doc_id", F.when(F.col("quality") > 0, 2.0).otherwise(0.5).alias("weight"))


def mixed(docs: DataFrame, quality: DataFrame | None = None, **settings) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as the mix takes it."""
    items = mixed_items(docs, quality, **settings).select(
        F.col("source").alias("_source"), F.col("doc_id").alias("_id"), F.col("size").alias("_size"), F.col("copies").alias("_copies")
    ).where("_copies > 0")
    own = docs.select(F.struct(*[docs[name] for name in docs.columns]).alias("_row"), F.col("doc_id").cast("long").alias("_doc"),
                      F.col("source").alias("_from"), word_count().alias("_words"))
    # Most rows have their doc_id for themselves: it comes first in the key, NULL and repeated ones follow by size.
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_words") == F.col("_size")) & F.col("_from").eqNullSafe(F.col("_source"))
    repeated = own.join(items, same).withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_copies").cast("int"))))
    return repeated.select("_row.*")
