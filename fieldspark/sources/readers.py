"""Readers: raw tables, landed JSON, seed CSV, SQL texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldspark.functions.columns import fahrenheit_to_celsius, kelvin_to_celsius, seconds_to_timestamp
from fieldspark.sources.schemas import CROP_YIELD, PH_DEPTHS, SOIL, SOIL_RECORD, WEATHER, WEATHER_DOCUMENT


def read_weather(spark: SparkSession, path: str, schema: T.StructType = WEATHER) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_soil(spark: SparkSession, path: str, schema: T.StructType = SOIL) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_crop_seed(spark: SparkSession, path: str) -> DataFrame:
    """Seed CSV with its declared column types."""
    return spark.read.schema(CROP_YIELD).option("header", True).csv(path)


def load_from_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header and inferred types (one extra pass over the file)."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def load_from_query(spark: SparkSession, query: str, tables: dict[str, DataFrame]) -> DataFrame:
    """Run a configured SQL text; ``tables`` become the views it may name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(query)


def read_weather_documents(spark: SparkSession, path: str, multi_line: bool = False, corrupt: str | None = None) -> DataFrame:
    """Landed weather documents: one JSON object per line, or with ``multi_line`` per file."""
    return _json(spark, path, WEATHER_DOCUMENT, multi_line, corrupt)


def _json(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool, corrupt: str | None) -> DataFrame:
    """JSON by schema. A malformed document ends the job; with ``corrupt``, the name of a column more,
    its text is kept there and its other columns are NULL, to be counted or put aside."""
    reader = spark.read.option("multiLine", multi_line)
    if corrupt is None:
        return reader.schema(schema).option("mode", "FAILFAST").json(path)
    kept = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    return reader.schema(kept).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt).json(path)


def flatten_weather(documents: DataFrame) -> DataFrame:
    """One row per document, day and hour; missing keys become NULL."""
    hours = (
        documents.select("latitude", "longitude", F.explode("days").alias("day"))
        .select("latitude", "longitude", F.explode("day.hours").alias("hour"))
    )
    return hours.select(
        "latitude", "longitude",
        seconds_to_timestamp("hour.datetimeEpoch").alias("timestamp"),
        fahrenheit_to_celsius("hour.temp").alias("temperature"),
        F.col("hour.humidity").alias("humidity"),
        F.col("hour.solarradiation").alias("solar_radiation"),
        F.col("hour.pressure").alias("pressure"),
    )


def read_soil_records(spark: SparkSession, path: str, multi_line: bool = False, corrupt: str | None = None) -> DataFrame:
    """Landed soil records: one JSON object per line, or with ``multi_line`` per file."""
    return _json(spark, path, SOIL_RECORD, multi_line, corrupt)


def flatten_soil(records: DataFrame, normalize_units: bool = False) -> DataFrame:
    """Soil rows from landed records, values stored as delivered.

    ``normalize_units`` turns Kelvin into °C and the moisture fraction into percent.
    """
    surface, depth, moisture = F.col("t0"), F.col("t10"), F.col("moisture")
    if normalize_units:
        surface, depth, moisture = kelvin_to_celsius(surface), kelvin_to_celsius(depth), moisture * 100
    return records.select(
        seconds_to_timestamp("dt").alias("timestamp"),
        surface.alias("t_0_cm"), depth.alias("t_10_cm"), moisture.alias("moisture"),
        *[F.col(f"`{key}`").alias(column) for key, column in PH_DEPTHS.items()],
    )
