"""Exact interpolated percentiles that never gather a group in one task.

Spark's ``percentile`` keeps every distinct value of a group in one aggregation
buffer, which fails once one group holds a large share of a big table. Here each
group is narrowed around the wanted ranks first:

1. one aggregate over the rows as they are places a few cut points per group and column, by mergeable
   sketches (``percentile_approx``), and gives any plain statistics asked for;
2. another one counts the values up to each cut point: exactly which intervals hold wanted ranks;
3. only the values of those intervals, usually well below one percent, become rows of their own, collapsed
   to distinct values with their counts, and are stored;
4. an interval with still too many values for one task is narrowed again.

The cut points only decide how much is kept. The intervals cover the whole line and
their counts are exact, so the result is exact whatever the sketch says.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldspark.operators.joins import fits, null_safe, sized
from fieldspark.session import checkpointed, stored

# Relative error 0.1 %: a sketch stays at a few ten kilobytes, however large its group.
SKETCH_ACCURACY = 1_000
# Cut points around each wanted rank, in units of the sketch error.
CUT_STEPS = (-2, 2)
# Cut points of every further narrowing.
EVEN_CUTS = [i / 64 for i in range(1, 64)]
# Most distinct values one task has to order.
TASK_VALUES = 1_000_000


def exact_percentiles(
    df: DataFrame,
    keys: list[str],
    wanted: dict[str, tuple[str, float]],
    accuracy: int = SKETCH_ACCURACY,
    task_values: int = TASK_VALUES,
    stats: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per group: ``keys`` plus one column per entry of ``wanted``.

    ``wanted`` maps an output name to ``(column, p)``. NULLs are ignored, ranks are
    interpolated linearly (``percentile_cont``), and a group without values has no row.
    With ``stats``, aggregates by name, every group has a row with those columns as well.
    """
    ranks = sorted({p for _, p in wanted.values()})
    own = keys or ["_all"]
    rows = df if keys else df.withColumn("_all", F.lit(0))
    group = [*own, "_measure"]

    summary, values = _first_cut(rows, own, wanted, accuracy, stats or {})
    while _largest_interval(values, group) > task_values:
        values = _narrow(values, group, ranks, EVEN_CUTS, accuracy)

    upto = F.sum("_rows").over(W.partitionBy(*group, "_before").orderBy("_x")) + F.col("_before")
    ordered = values.withColumn("_end", upto).withColumn("_start", F.col("_end") - F.col("_rows"))
    result = ordered.groupBy(*own).agg(
        *[_interpolated(column, p).alias(name) for name, (column, p) in wanted.items()]
    )
    if stats is None:
        return result.select(*keys, *wanted)
    mine = summary.select(*[F.col(k).alias("_s_" + k) for k in own], *stats)
    return mine.join(result, null_safe(result, mine, own, "_s_"), "left").select(
        *[F.col("_s_" + k).alias(k) for k in keys], *stats, *wanted
    )


def _first_cut(
    df: DataFrame, keys: list[str], wanted: dict[str, tuple[str, float]], accuracy: int, stats: dict[str, Column]
) -> tuple[DataFrame, DataFrame]:
    """One row per group with statistics and cut points, and the values of the intervals that hold wanted ranks."""
    ranks_of: dict[str, list[float]] = {}
    for measure, p in wanted.values():
        ranks_of[measure] = sorted({*ranks_of.get(measure, []), p})
    points = {
        m: sorted({min(max(p + step / accuracy, 0.0), 1.0) for p in ranks for step in CUT_STEPS}) for m, ranks in ranks_of.items()
    }
    numbered = list(enumerate(ranks_of))
    value = {m: F.col(m).cast("double") for m in ranks_of}
    # Without keys there is one group, also without rows.
    grouped = df.groupBy() if keys == ["_all"] else df.groupBy(*keys)
    summary = checkpointed(grouped.agg(
        *[F.percentile_approx(value[m], F.array(*[F.lit(p) for p in points[m]]), accuracy).alias(f"_cuts{i}") for i, m in numbered],
        *[F.count(value[m]).alias(f"_n{i}") for i, m in numbered], *[column.alias(name) for name, column in stats.items()],
    ))
    if keys == ["_all"]:
        summary = summary.withColumn("_all", F.lit(0))
    cuts = summary.select(*[F.col(k).alias("_c_" + k) for k in keys], *[c for i, _ in numbered for c in (f"_cuts{i}", f"_n{i}")])
    small = fits(cuts)
    rows = df.select(*keys, *[value[m].alias(f"_x{i}") for i, m in numbered])

    def met(side: DataFrame) -> DataFrame:
        return rows.join(sized(side, small), null_safe(rows, side, keys, "_c_"))

    def cut(i: int, j: int) -> Column:
        return F.get(f"_cuts{i}", F.lit(j))

    upto = met(cuts).groupBy(*keys).agg(*[
        F.count_if(F.col(f"_x{i}") <= cut(i, j)).alias(f"_upto{i}_{j}") for i, m in numbered for j in range(len(points[m]))
    ]).select(*[F.col(k).alias("_p_" + k) for k in keys], *[f"_upto{i}_{j}" for i, m in numbered for j in range(len(points[m]))])
    # Where each interval with a wanted rank starts; NULL for the others.
    starts = cuts.join(sized(upto, small), _same(keys))
    needed = []
    for i, m in numbered:
        edges = [F.lit(0).cast("long"), *[F.col(f"_upto{i}_{j}") for j in range(len(points[m]))], F.col(f"_n{i}")]
        needed.append(F.array(*[
            F.when(_holds_any(ranks_of[m], low, high, f"_n{i}"), low) for low, high in zip(edges[:-1], edges[1:], strict=True)
        ]).alias(f"_needed{i}"))
    plan = starts.select(*["_c_" + k for k in keys], *[c for i, _ in numbered for c in (f"_cuts{i}", f"_n{i}")], *needed)

    found = []
    for i, m in numbered:
        piece = F.lit(0)
        for j in range(len(points[m])):
            piece = piece + F.when(F.col(f"_x{i}") > cut(i, j), 1).otherwise(0)
        start = F.when(F.col(f"_x{i}").isNotNull(), F.get(f"_needed{i}", piece))
        found.append(F.when(start.isNotNull(), F.struct(
            F.lit(m).alias("_measure"), start.alias("_before"), F.col(f"_x{i}").alias("_x"), F.col(f"_n{i}").alias("_n")
        )))
    kept = (
        met(plan).select(*[rows[k] for k in keys], F.inline(F.array_compact(F.array(*found))))
        .groupBy(*keys, "_measure", "_before", "_x").agg(F.count("*").alias("_rows"), F.first("_n").alias("_n"))
    )
    return summary, stored(kept, "percentile-values")


def _same(keys: list[str]) -> Column:
    condition = F.lit(True)
    for name in keys:
        condition = condition & F.col("_c_" + name).eqNullSafe(F.col("_p_" + name))
    return condition


def _narrow(values: DataFrame, group: list[str], ranks: list[float], points: list[float], accuracy: int) -> DataFrame:
    """Cut every interval and keep the distinct values of the pieces that hold a wanted rank.

    An interval is known by the number of rows of its group that lie before it.
    """
    interval = [*group, "_before"]
    cuts = checkpointed(values.groupBy(*interval).agg(
        F.percentile_approx("_x", F.array(*[F.lit(p) for p in points]), accuracy).alias("_cuts"),
        F.coalesce(F.max("_n"), F.sum("_rows")).alias("_total"),
    ))
    cuts = cuts.select(*[F.col(k).alias("_c_" + k) for k in interval], "_cuts", "_total")
    small = fits(cuts)

    pieces = (
        _in_pieces(values, sized(cuts, small), interval, len(points))
        .groupBy(*interval, "_piece")
        .agg(F.sum("_rows").alias("_rows"), F.first("_total").alias("_n"))
    )
    upto = F.sum("_rows").over(W.partitionBy(*interval).orderBy("_piece")) + F.col("_before")
    # At most one entry per cut point.
    needed = (
        pieces.withColumn("_start", upto - F.col("_rows"))
        .where(_holds_any(ranks, F.col("_start"), F.col("_start") + F.col("_rows")))
        .groupBy(*interval)
        .agg(F.map_from_entries(F.collect_list(F.struct("_piece", "_start"))).alias("_needed"))
    )
    plan = needed.select(*[F.col(k).alias("_p_" + k) for k in interval], "_needed").join(
        sized(cuts, small), _same(interval)
    ).select(*["_c_" + k for k in interval], "_cuts", "_total", "_needed")

    kept = (
        _in_pieces(values, sized(plan, small), interval, len(points), "_needed")
        .withColumn("_start", F.try_element_at("_needed", F.col("_piece")))
        .where(F.col("_start").isNotNull())
        .groupBy(*group, F.col("_start").alias("_before"), "_x")
        .agg(F.sum("_rows").alias("_rows"), F.first("_total").alias("_n"))
    )
    return stored(kept, "percentile-values")


def _in_pieces(values: DataFrame, side: DataFrame, interval: list[str], cut_count: int, *extra: str) -> DataFrame:
    """Attach the cut points and number the piece each value falls into."""
    piece = F.lit(0)
    for i in range(cut_count):
        piece = piece + F.when(F.col("_x") > F.get("_cuts", F.lit(i)), 1).otherwise(0)
    joined = values.join(side, null_safe(values, side, interval, "_c_"))
    return joined.select(*[values[k] for k in interval], "_x", "_rows", piece.alias("_piece"), "_total", *extra)


def _largest_interval(values: DataFrame, group: list[str]) -> int:
    sizes = values.groupBy(*group, "_before").count()
    return sizes.agg(F.max("count")).first()[0] or 0


def _positions(p: float, n: str = "_n"):
    position = F.lit(p) * (F.col(n) - 1)
    return position, F.floor(position), F.ceil(position)


def _holds_any(ranks: list[float], start, end, n: str = "_n"):
    condition = F.lit(False)
    for p in ranks:
        for rank in _positions(p, n)[1:]:
            condition = condition | ((rank >= start) & (rank < end))
    return condition


def _interpolated(measure: str, p: float):
    position, low_rank, high_rank = _positions(p)
    mine = F.col("_measure") == measure

    def value_at(rank):
        return F.max(F.when(mine & (rank >= F.col("_start")) & (rank < F.col("_end")), F.col("_x")))

    low, high = value_at(low_rank), value_at(high_rank)
    weight = F.max(F.when(mine, position - low_rank))
    return low + (high - low) * weight
