"""Staged views of the raw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.functions.columns import ns_to_timestamp, timestamp_to_ns

SOIL_MEASURES = [
    "t_0_cm", "t_10_cm", "moisture",
    "ph_0_5cm", "ph_5_15cm", "ph_15_30cm", "ph_30_60cm", "ph_60_100cm", "ph_100_200cm",
]


def stg_weather(weather: DataFrame, since: Column | None = None) -> DataFrame:
    """Weather readings with decoded timestamps.

    ``since`` prunes on the raw nanosecond column, so it reaches the parquet scan.
    """
    return _since(weather, since).select(
        "id", "latitude", "longitude",
        ns_to_timestamp("timestamp").alias("timestamp"),
        *_as_doubles(["temperature", "humidity", "solar_radiation", "pressure"]),
        ns_to_timestamp("created_at").alias("created_at"),
    )


def stg_soil(soil: DataFrame, since: Column | None = None) -> DataFrame:
    """Soil readings with decoded timestamps."""
    return _since(soil, since).select(
        "id",
        ns_to_timestamp("timestamp").alias("timestamp"),
        *_as_doubles(SOIL_MEASURES),
        ns_to_timestamp("created_at").alias("created_at"),
    )


def stg_crop_yield(crop_yield: DataFrame) -> DataFrame:
    """Historical yields; only the rainfall column changes its name."""
    return crop_yield.select(
        "area", "item", "year", "hg_ha_yield",
        F.col("average_rain_fall_mm_per_year").alias("average_rainfall_mm_per_year"),
        "pesticides_tonnes", "avg_temp",
    )


def _as_doubles(columns: list[str]) -> list[Column]:
    """Measures are decimals in the raw tables and doubles from here on."""
    return [F.col(c).cast("double").alias(c) for c in columns]


def _since(raw: DataFrame, since: Column | None) -> DataFrame:
    return raw if since is None else raw.where(F.col("timestamp") >= timestamp_to_ns(since))
