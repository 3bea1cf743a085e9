"""Writers: appends, conflict-free appends, cursor copies, snapshots, exports."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldspark.session import stored

WEATHER_KEY = ["latitude", "longitude", "timestamp"]
NOTHING_COPIED = -1

CURSOR_STATE = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("last_id", T.LongType(), False),
    T.StructField("rows_copied", T.LongType(), False),
])


def append_rows(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Plain append; the first append creates the table from the frame's schema."""
    df.write.mode("append").partitionBy(*(partition_by or [])).parquet(path)


def without_conflicts(
    batch: DataFrame, existing: DataFrame | None, keys: list[str], order_by: str = "id"
) -> DataFrame:
    """Rows of ``batch`` whose key is new, one per key (the lowest ``order_by``).

    Copies collapse in each task before the shuffle (group limit), so a key that fills
    much of the batch meets the anti join as one row.
    """
    first = W.partitionBy(*keys).orderBy(order_by)
    fresh = batch.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")
    if existing is None:
        return fresh
    return fresh.join(existing.select(*keys), keys, "left_anti").select(*batch.columns)


def append_ignore_conflicts(
    batch: DataFrame, path: str, keys: list[str] = WEATHER_KEY, order_by: str = "id", time_key: str = "timestamp"
) -> None:
    """Append the rows whose key is in neither the table nor an earlier row of the batch.

    The batch is stored without its repeats first, so that a source which cannot be read twice
    the same way gives one set of rows. The key holds a timestamp: only table rows from the stored
    batch's own time span can conflict, and that span is pushed into the scan of the table. Key columns
    may not be NULL. Two writers at once are not safe: neither sees the other's rows.
    """
    fresh = stored(without_conflicts(batch, None, keys, order_by), "append-batch")
    if not fresh.where(" or ".join(f"`{key}` is null" for key in keys)).isEmpty():
        raise ValueError(f"NULL in a key column of {keys}")
    existing = read_if_present(batch.sparkSession, path)
    if existing is not None:
        first, last = fresh.agg(F.min(time_key), F.max(time_key)).first()
        existing = existing.where(F.col(time_key).between(first, last))
        fresh = fresh.join(existing.select(*keys), keys, "left_anti").select(*batch.columns)
    append_rows(fresh, path)


def read_cursor(spark: SparkSession, state_path: str, source: str) -> int:
    """Last committed id of a source; before the first copy, below every serial id."""
    state = read_if_present(spark, state_path)
    if state is None:
        return NOTHING_COPIED
    committed = state.where(F.col("source") == source).agg(F.max("last_id")).first()[0]
    return NOTHING_COPIED if committed is None else committed


def copy_increment(source: DataFrame, name: str, target_path: str, state_path: str) -> int:
    """Copy the rows beyond the cursor, then move the cursor; returns the new cursor.

    The rows go to a folder named after the cursor they start from. A run that fails
    before the cursor moved is repeated into the same folder and replaces it, so every
    row arrives exactly once. An empty increment leaves the cursor alone.
    """
    spark = source.sparkSession
    last = read_cursor(spark, state_path, name)
    folder = f"{target_path}/after_id={last}"
    source.where(F.col("id") > last).write.mode("overwrite").parquet(folder)
    newest, rows = spark.read.schema(source.schema).parquet(folder).agg(F.max("id"), F.count("*")).first()
    if not rows:
        return last
    moved = spark.createDataFrame([(name, newest, rows)], CURSOR_STATE)
    append_rows(moved.coalesce(1), state_path)
    return newest


def read_copied(spark: SparkSession, target_path: str) -> DataFrame:
    """Target of :func:`copy_increment`; ``after_id`` tells the increment."""
    return spark.read.option("basePath", target_path).parquet(f"{target_path}/after_id=*")


def lower_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def write_snapshot(df: DataFrame, path: str, stamp: str = "prediction_date") -> None:
    """Add a stamped batch below its own date folder, so the newest batch is a partition.

    A batch has one date, so every task writes one file and nothing is shuffled.
    """
    dated = df.withColumn("snapshot_date", F.to_date(stamp))
    append_rows(dated, path, ["snapshot_date"])


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def materialise(df: DataFrame, name: str, kind: str = "view") -> DataFrame:
    """Publish a model under a name: a view stays lazy, a table is written."""
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        df.write.mode("overwrite").saveAsTable(name)
    else:
        raise ValueError(f"unknown materialisation: {kind}")
    return df.sparkSession.table(name)


def read_if_present(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
