"""Crop-yield features, training set, benchmarks and growing-season scenarios."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.functions.columns import moment
from fieldspark.operators.percentiles import exact_percentiles

# Scenario, rainfall factor, pesticide factor, temperature shift.
SCENARIOS = [
    ("baseline", 1.0, 1.0, 0.0),
    ("optimistic", 1.15, 1.10, -0.5),
    ("pessimistic", 0.75, 1.20, 1.5),
    ("conservative", 0.95, 0.80, 0.0),
]
SCENARIO_YEAR = 2025
BASE_YEARS_FROM = 2008
MODERN_FROM = 2010
MIN_SAMPLES = 10
LEAKAGE_COLUMNS = ["yield_efficiency", "pesticide_intensity"]


def year_features() -> list:
    year = F.col("year")
    return [
        (year % 10).alias("year_in_decade"),
        F.when(year >= MODERN_FROM, "modern").otherwise("historical").alias("era"),
    ]


def crop_yield_features(staged: DataFrame) -> DataFrame:
    """Staged yields with two ratios and a temperature class; a zero divisor gives NULL."""
    temp = F.col("avg_temp")
    return staged.select(
        "*",
        F.try_divide("hg_ha_yield", "average_rainfall_mm_per_year").alias("yield_per_mm_rain"),
        F.try_divide("pesticides_tonnes", "hg_ha_yield").alias("pesticides_per_yield_unit"),
        F.when(temp < 15, "cold").when(temp.between(15, 25), "optimal")
        .otherwise("hot").alias("temp_category"),
    )


def ml_training_dataset(features: DataFrame) -> DataFrame:
    """Target and model features for every row with a positive yield."""
    return features.where(F.col("hg_ha_yield") > 0).select(
        F.col("hg_ha_yield").alias("target_yield"),
        "area",
        F.col("item").alias("crop_type"),
        "year", "average_rainfall_mm_per_year", "pesticides_tonnes", "avg_temp",
        F.try_divide("hg_ha_yield", "average_rainfall_mm_per_year").alias("yield_efficiency"),
        F.try_divide("pesticides_tonnes", "average_rainfall_mm_per_year").alias("pesticide_intensity"),
        *year_features(),
    )


def drop_leakage(training: DataFrame) -> DataFrame:
    """Training set without the columns derived from the target."""
    return training.drop(*LEAKAGE_COLUMNS)


def base_scenarios(staged: DataFrame) -> DataFrame:
    """Mean conditions per area and crop since 2008."""
    return (
        staged.where(F.col("year") >= BASE_YEARS_FROM)
        .groupBy("area", F.col("item").alias("crop_type"))
        .agg(
            F.avg("average_rainfall_mm_per_year").alias("baseline_rainfall"),
            F.avg("pesticides_tonnes").alias("baseline_pesticides"),
            F.avg("avg_temp").alias("baseline_temp"),
        )
    )


def current_conditions(base: DataFrame, as_of=None) -> DataFrame:
    """Four scenarios per area and crop, expanded in one pass over the baselines."""
    variants = F.array(*[
        F.struct(
            F.lit(name).alias("scenario"),
            (F.col("baseline_rainfall") * rain).alias("average_rainfall_mm_per_year"),
            (F.col("baseline_pesticides") * pesticides).alias("pesticides_tonnes"),
            (F.col("baseline_temp") + shift).alias("avg_temp"),
        )
        for name, rain, pesticides, shift in SCENARIOS
    ])
    expanded = base.select("area", "crop_type", F.lit(SCENARIO_YEAR).alias("year"), F.inline(variants))
    return expanded.where(F.col("average_rainfall_mm_per_year") > 0).select(
        "*",
        F.try_divide("pesticides_tonnes", "average_rainfall_mm_per_year").alias("pesticide_intensity"),
        *year_features(),
        moment(as_of).alias("prediction_requested_at"),
    )


def crop_benchmarks(staged: DataFrame, min_samples: int = MIN_SAMPLES) -> DataFrame:
    """Yield statistics and typical conditions of each crop with enough samples."""
    stats = {
        "avg_yield": F.avg("hg_ha_yield"), "max_yield": F.max("hg_ha_yield"),
        "optimal_temp": F.avg("avg_temp"), "temp_stddev": F.stddev_samp("avg_temp"),
        "optimal_rainfall": F.avg("average_rainfall_mm_per_year"), "typical_pesticide_use": F.avg("pesticides_tonnes"),
        "sample_size": F.count("*"),
    }
    quartiles = {"p25_yield": ("hg_ha_yield", 0.25), "p75_yield": ("hg_ha_yield", 0.75)}
    by_crop = exact_percentiles(staged.withColumnRenamed("item", "crop_type"), ["crop_type"], quartiles, stats=stats)
    return by_crop.where(F.col("sample_size") >= min_samples).select(
        "crop_type", "avg_yield", "p25_yield", "p75_yield", "max_yield", "optimal_temp",
        "temp_stddev", "optimal_rainfall", "typical_pesticide_use", "sample_size",
    )
