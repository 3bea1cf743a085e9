"""Order of the rows within conversations, however long one of them is.

No conversation is gathered for it: all rows are range-partitioned and sorted by conversation and
turn, so that a conversation with a third of all rows lies across many tasks, and each row gets a
place that rises over the partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldspark.session import stored

# Bits of monotonically_increasing_id below the partition number.
PARTITION_BITS = 33


def placed(rows: DataFrame, keep: list[Column], name: str) -> DataFrame:
    """``keep`` and ``place`` of rows (conv_id, turn, role, text), stored.

    ``place`` rises with conversation, turn (NULL first), role and text; rows equal in all four
    have neighbouring places.
    """
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(ordered.select(F.monotonically_increasing_id().alias("place"), *keep), name)


def partition_of(place: str = "place") -> Column:
    return F.shiftright(F.col(place), PARTITION_BITS)


def with_positions(rows: DataFrame) -> DataFrame:
    """Add ``pos``, from 1, to rows (conv_id, place, ...)."""
    parted = rows.withColumn("part", partition_of())
    # A conversation that continues from earlier partitions: at most one for each partition.
    whole = W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    continued = (
        parted.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
        .select("conv_id", "part", F.sum("n").over(whole).alias("before")).where("before is not null")
    )
    in_part = F.row_number().over(W.partitionBy("conv_id", "part").orderBy("place"))
    return (
        parted.withColumn("in_part", in_part).join(F.broadcast(continued), ["conv_id", "part"], "left")
        .withColumn("pos", (F.col("in_part") + F.coalesce("before", F.lit(0))).cast("long")).drop("in_part", "part", "before")
    )
