"""The models from raw tables to reports, and the pipeline that writes them all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.functions.columns import timestamp_to_ns, truncate
from fieldspark.operators import crops, quality, sensors, staging
from fieldspark.operators.serving import latest_predictions
from fieldspark.session import stored

# Models built on the staged yields.
YIELD_MODELS = [
    "stg_crop_yield", "int_crop_yield_features", "fct_ml_training_dataset", "fct_current_conditions", "dim_crop_benchmarks",
]


def unified_readings(weather: DataFrame, soil: DataFrame, since=None) -> DataFrame:
    """Unified readings from the raw tables.

    ``since`` prunes both raw scans: weather from the start of that hour, soil from the
    start of that day, as the day's newest record is picked from the whole day.
    """
    if since is None:
        return sensors.sensor_readings_unified(staging.stg_weather(weather), staging.stg_soil(soil))
    hour, day = truncate("hour", since), truncate("day", since)
    return sensors.sensor_readings_unified(
        staging.stg_weather(weather, hour), staging.stg_soil(soil, day)
    )


def farm_summary(weather: DataFrame, soil: DataFrame) -> DataFrame:
    """Day-by-day farm summary from the raw tables."""
    return sensors.daily_farm_summary(sensors.daily_conditions(unified_readings(weather, soil)))


def monitoring(weather: DataFrame, soil: DataFrame, as_of=None) -> DataFrame:
    """Flagged readings of the last seven days; the time filter reaches the raw scans."""
    unified = unified_readings(weather, soil, since=sensors.monitoring_start(as_of))
    return sensors.sensor_monitoring(unified, as_of)


def irrigation(weather: DataFrame, soil: DataFrame, as_of=None) -> DataFrame:
    """Irrigation recommendation for the last two hours; reads only those hours."""
    unified = unified_readings(weather, soil, since=sensors.irrigation_start(as_of))
    return sensors.irrigation_recommendation(unified, as_of)


def live_status(weather: DataFrame, soil: DataFrame, start: str, end: str, as_of=None) -> DataFrame:
    """Newest reading of the range with its alerts."""
    in_range = sensors.readings_between(monitoring(weather, soil, as_of), start, end)
    tie_break = ["air_temp", "humidity", "soil_moisture", "ph_surface"]
    return sensors.active_alerts(sensors.latest_reading(in_range, *tie_break))


def readings_in_range(weather: DataFrame, soil: DataFrame, start: str, end: str) -> DataFrame:
    """Flagged readings of the inclusive date range; both bounds reach the raw scans.

    Readings meet the soil record of their own day, so whole days of both tables are enough.
    """
    since = F.lit(start).cast("date").cast("timestamp_ntz")
    beyond = F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz")
    unified = unified_readings(weather.where(F.col("timestamp") < timestamp_to_ns(beyond)),
                               soil.where(F.col("timestamp") < timestamp_to_ns(beyond)), since)
    return sensors.readings_between(sensors.flag_readings(unified), start, end)


def scenario_conditions(staged_yield: DataFrame, as_of=None) -> DataFrame:
    """Season scenarios per area and crop."""
    return crops.current_conditions(crops.base_scenarios(staged_yield), as_of)


def crop_forecast(predictions: DataFrame) -> DataFrame:
    """Newest prediction batch, for the forecast page."""
    return latest_predictions(predictions)


def farm_models(
    weather: DataFrame, soil: DataFrame, crop_yield: DataFrame, as_of=None, names=None
) -> dict[str, DataFrame]:
    """The models by name (all, or those asked for), lazily from the raw tables.

    Staged yields that several of them are built on, or that one reads more than once, are stored: the raw yields
    may be a join, which each model would repeat.
    """
    staged_yield = staging.stg_crop_yield(crop_yield)
    asked = YIELD_MODELS if names is None else [name for name in names if name in YIELD_MODELS]
    if len(asked) > 1 or "dim_crop_benchmarks" in asked:
        staged_yield = stored(staged_yield, "crop-yield")
    features = crops.crop_yield_features(staged_yield)

    def unified():
        return unified_readings(weather, soil)

    models = {
        "stg_weather": lambda: staging.stg_weather(weather),
        "stg_soil": lambda: staging.stg_soil(soil),
        "stg_crop_yield": lambda: staged_yield,
        "int_sensor_readings_unified": unified,
        "int_daily_conditions": lambda: sensors.daily_conditions(unified()),
        "int_crop_yield_features": lambda: features,
        "fct_ml_training_dataset": lambda: crops.ml_training_dataset(features),
        "fct_current_conditions": lambda: scenario_conditions(staged_yield, as_of),
        "fct_sensor_monitoring": lambda: monitoring(weather, soil, as_of),
        "dim_crop_benchmarks": lambda: crops.crop_benchmarks(staged_yield),
        "rpt_daily_farm_summary": lambda: farm_summary(weather, soil),
        "rpt_irrigation_recommendations": lambda: irrigation(weather, soil, as_of),
    }
    return {name: models[name]() for name in (names or models)}


def write_models(
    weather: DataFrame, soil: DataFrame, crop_yield: DataFrame, path: str, as_of=None
) -> dict[str, DataFrame]:
    """Write the models in dependency order, each built on the tables written before it.

    Staging stays a view. Time-stamped facts are laid out by day for later range queries;
    the rebalance splits days too large for one task and merges small ones.
    """
    spark = weather.sparkSession

    def written(name: str, df: DataFrame, day_of: str | None = None) -> DataFrame:
        out = f"{path}/{name}"
        if day_of:
            dated = df.withColumn("day", F.to_date(day_of))
            dated.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(out)
        else:
            df.write.mode("overwrite").parquet(out)
        return spark.read.parquet(out)

    tables = {
        "stg_weather": staging.stg_weather(weather),
        "stg_soil": staging.stg_soil(soil),
        "stg_crop_yield": written("stg_crop_yield", staging.stg_crop_yield(crop_yield)),
    }
    tables["int_sensor_readings_unified"] = unified = written(
        "int_sensor_readings_unified",
        sensors.sensor_readings_unified(tables["stg_weather"], tables["stg_soil"]), "reading_timestamp",
    )
    tables["int_daily_conditions"] = daily = written("int_daily_conditions", sensors.daily_conditions(unified))
    tables["int_crop_yield_features"] = features = written(
        "int_crop_yield_features", crops.crop_yield_features(tables["stg_crop_yield"])
    )
    tables["fct_ml_training_dataset"] = written("fct_ml_training_dataset", crops.ml_training_dataset(features))
    tables["fct_current_conditions"] = written(
        "fct_current_conditions", scenario_conditions(tables["stg_crop_yield"], as_of)
    )
    start = F.to_date(sensors.monitoring_start(as_of))
    tables["fct_sensor_monitoring"] = written(
        "fct_sensor_monitoring", sensors.sensor_monitoring(unified.where(F.col("day") >= start), as_of),
        "reading_timestamp",
    )
    tables["dim_crop_benchmarks"] = written("dim_crop_benchmarks", crops.crop_benchmarks(tables["stg_crop_yield"]))
    tables["rpt_daily_farm_summary"] = written("rpt_daily_farm_summary", sensors.daily_farm_summary(daily))
    tables["rpt_irrigation_recommendations"] = written(
        "rpt_irrigation_recommendations",
        sensors.irrigation_recommendation(
            unified.where(F.col("day") >= F.to_date(sensors.irrigation_start(as_of))), as_of
        ),
    )
    return tables


def check_models(tables: dict[str, DataFrame]) -> DataFrame:
    """All declared data tests over the written models."""
    return quality.run_declared_checks(tables)
