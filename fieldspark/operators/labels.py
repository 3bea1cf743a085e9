"""Label codes: position of each distinct value in sorted order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldspark.session import stored


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-NULL values with codes from 0 in ascending order.

    The distinct values are range-partitioned and stored with their partition, numbered within each
    partition, and moved up by the sizes of the partitions before: no task holds the vocabulary.
    """
    values = df.select(F.col(column).alias("label")).where("label is not null").distinct().repartitionByRange("label")
    values = stored(values.select("label", F.spark_partition_id().alias("part")), "labels")
    # One row per partition.
    sizes = values.groupBy("part").count()
    before = (F.sum("count").over(W.orderBy("part")) - F.col("count")).alias("before")
    place = F.row_number().over(W.partitionBy("part").orderBy("label")) - 1
    return values.join(sizes.select("part", before), "part").select(
        F.lit(column).alias("feature"), "label", (F.col("before") + place).alias("code")
    )
