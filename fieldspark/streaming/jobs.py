"""Streaming transformations and the two ways their results are written.

The transformations reuse the batch operators; only time handling differs. Every run
uses ``availableNow``: it takes what has arrived, commits its progress to the
checkpoint and ends, so a scheduled job resumes where the last one stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldspark.operators import sensors
from fieldspark.sources.sinks import WEATHER_KEY, read_if_present

LATE_BY = "1 day"
# Versions of a live table that stay besides the newest one.
VERSIONS = 2


def _with_event_time(stream: DataFrame, column: str, late_by: str) -> DataFrame:
    """Watermarks need an instant; the session zone is UTC, so the wall clock stays."""
    return stream.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, late_by)


def _wall_clock(column: str):
    return F.col(column).cast("timestamp_ntz")


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of the parquet files that match ``path`` (a folder or a glob pattern)."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def without_repeats(readings: DataFrame, keys: list[str] = WEATHER_KEY, late_by: str = LATE_BY) -> DataFrame:
    """First arrival per key; state for a key is kept while a repeat may still arrive."""
    distinct = _with_event_time(readings, "timestamp", late_by).dropDuplicatesWithinWatermark(keys)
    return distinct.withColumn("timestamp", _wall_clock("timestamp"))


def unified_stream(weather: DataFrame, soil_daily: DataFrame) -> DataFrame:
    """Streamed weather joined with the stored soil record of its day."""
    return sensors.unify_readings(weather, soil_daily)


def alert_stream(unified: DataFrame) -> DataFrame:
    """Each reading with flags and alert, as it arrives."""
    return sensors.flag_readings(unified)


def daily_stream(unified: DataFrame, late_by: str = LATE_BY) -> DataFrame:
    """Daily roll-up in tumbling windows; in append mode readings later than ``late_by`` are dropped."""
    day = F.window("reading_timestamp", "1 day")
    timed = _with_event_time(unified, "reading_timestamp", late_by)
    rolled = timed.groupBy(day).agg(*sensors.daily_aggregates())
    return rolled.select(_wall_clock("window.start").alias("date"), *rolled.columns[1:])


def irrigation_stream(unified: DataFrame, late_by: str = LATE_BY) -> DataFrame:
    """Irrigation recommendation per two-hour window, sliding by the hour."""
    span = F.window("reading_timestamp", f"{sensors.IRRIGATION_HOURS} hours", "1 hour")
    timed = _with_event_time(unified, "reading_timestamp", late_by)
    rolled = timed.groupBy(span).agg(*sensors.irrigation_aggregates())
    return rolled.select(
        _wall_clock("window.start").alias("window_start"), "current_moisture", "current_temp",
        *sensors.irrigation_decision(),
    )


def append_available(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Append what has arrived to a parquet table; the file sink's log makes it exactly once."""
    query = (
        stream.writeStream.outputMode("append").format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.parquet(path)


def keep_current(stream: DataFrame, keys: list[str], path: str, checkpoint: str) -> DataFrame:
    """Keep a table equal to a windowed aggregate, open windows included.

    Each batch brings the windows it touched. They replace those of the newest version in a folder of the batch's own;
    the pointer to it is written last, so a reader between two batches, or after a failed one, sees a whole
    table. A repeated batch writes its folder again. The last ``VERSIONS`` versions stay for those who read them. The
    table has one row per window; the state holds the windows within the watermark.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = [v for v in _versions(spark, path) if v < batch_id]
        merged = batch
        if before:
            kept = spark.read.schema(batch.schema).parquet(f"{path}/version={before[-1]}")
            merged = kept.join(batch.select(*keys), keys, "left_anti").select(*batch.columns).union(batch)
        merged.write.mode("overwrite").parquet(f"{path}/version={batch_id}")
        spark.createDataFrame([(batch_id,)], "version long").coalesce(1).write.mode("append").parquet(f"{path}/pointer")
        for old in before[:-VERSIONS]:
            _remove(spark, f"{path}/version={old}")

    query = (
        stream.writeStream.outputMode("update").foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return read_current(stream.sparkSession, path)


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The newest whole version of a table kept by :func:`keep_current`."""
    return spark.read.parquet(f"{path}/version={_versions(spark, path)[-1]}")


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Versions the pointer names, rising: one small row a batch."""
    pointer = read_if_present(spark, f"{path}/pointer", T.StructType([T.StructField("version", T.LongType())]))
    return [] if pointer is None else [row["version"] for row in pointer.distinct().orderBy("version").collect()]


def _remove(spark: SparkSession, folder: str) -> None:
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
