"""Sensor readings: unify, roll up, flag, recommend, chart data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldspark.functions.columns import moment, truncate

# Thresholds of the flags, alerts and recommendations.
TEMP_RANGE = (-50, 60)
MOISTURE_RANGE = (0, 100)
ALERT_MOISTURE = (20, 80)
MIN_DAILY_READINGS = 20
MONITOR_DAYS = 7
IRRIGATION_HOURS = 2

TREND_METRICS = ["air_temp", "humidity", "soil_moisture", "ph_surface"]


def soil_daily_latest(soil: DataFrame) -> DataFrame:
    """The newest soil record of each day; equal timestamps are settled by the higher id.

    The rank filter becomes a per-task group limit before the shuffle, so a day with a
    large share of the rows still sends one row per task.
    """
    newest = W.partitionBy("date_day").orderBy(F.desc("timestamp"), F.desc("id"))
    return (
        soil.select(
            truncate("day", "timestamp").alias("date_day"),
            "timestamp", "id",
            F.col("t_0_cm").alias("soil_temp_surface"),
            F.col("t_10_cm").alias("soil_temp_10cm"),
            F.col("moisture").alias("soil_moisture"),
            F.col("ph_0_5cm").alias("ph_surface"),
        )
        .withColumn("rn", F.row_number().over(newest))
        .where("rn = 1")
        .drop("rn", "timestamp", "id")
    )


def unify_readings(weather: DataFrame, soil_daily: DataFrame) -> DataFrame:
    """Hourly-stamped weather rows with the soil record of their day; days without soil drop out.

    ``soil_daily`` has one row per calendar day, and 64-bit nanosecond timestamps span
    213,504 days at most, so broadcasting its five columns is bounded by about 10 MB.
    """
    hourly = weather.select(
        truncate("hour", "timestamp").alias("reading_timestamp"),
        "latitude", "longitude",
        F.col("temperature").alias("air_temp"),
        "humidity", "solar_radiation", "pressure",
    )
    same_day = truncate("day", hourly["reading_timestamp"]) == soil_daily["date_day"]
    return hourly.join(F.broadcast(soil_daily), same_day).drop("date_day")


def sensor_readings_unified(weather: DataFrame, soil: DataFrame) -> DataFrame:
    """Unified readings from the two staged tables."""
    return unify_readings(weather, soil_daily_latest(soil))


def daily_aggregates() -> list[Column]:
    """The measures of the daily roll-up, shared by the batch and the streaming form."""
    return [
        F.avg("air_temp").alias("avg_daily_temp"),
        F.min("air_temp").alias("min_daily_temp"),
        F.max("air_temp").alias("max_daily_temp"),
        F.avg("humidity").alias("avg_humidity"),
        F.avg("soil_moisture").alias("avg_soil_moisture"),
        F.avg("ph_surface").alias("avg_ph"),
        F.sum("solar_radiation").alias("total_solar_radiation"),
        F.count("*").alias("reading_count"),
    ]


def daily_conditions(unified: DataFrame) -> DataFrame:
    """One row per day of readings."""
    return unified.groupBy(truncate("day", "reading_timestamp").alias("date")).agg(*daily_aggregates())


def daily_farm_summary(daily: DataFrame) -> DataFrame:
    """Daily summary with the change against the previous row, newest day first.

    The window has no partition, but runs on the daily roll-up: one row per calendar day.
    """
    previous = F.lag("avg_daily_temp").over(W.orderBy("date"))
    return daily.select(
        "date", "avg_daily_temp", "avg_humidity", "avg_soil_moisture", "avg_ph", "reading_count",
        (F.col("avg_daily_temp") - previous).alias("temp_change_24h"),
        F.when(F.col("reading_count") < MIN_DAILY_READINGS, "WARNING")
        .otherwise("HEALTHY").alias("sensor_status"),
    ).orderBy(F.desc("date"))


def rolling_7d_temp(daily: DataFrame) -> DataFrame:
    """Mean of the daily mean temperature over the last seven rows, on the daily roll-up."""
    last_seven = W.orderBy("date").rowsBetween(-6, 0)
    return daily.select("date", "avg_daily_temp", F.avg("avg_daily_temp").over(last_seven).alias("temp_7day_avg"))


def reading_flags() -> list[Column]:
    """Quality flags and irrigation alert; a NULL measure takes the last branch."""
    temp, moisture = F.col("air_temp"), F.col("soil_moisture")
    return [
        F.when((temp < TEMP_RANGE[0]) | (temp > TEMP_RANGE[1]), "ANOMALY")
        .otherwise("OK").alias("temp_flag"),
        F.when((moisture < MOISTURE_RANGE[0]) | (moisture > MOISTURE_RANGE[1]), "ANOMALY")
        .otherwise("OK").alias("moisture_flag"),
        F.when(moisture < ALERT_MOISTURE[0], "LOW_MOISTURE_ALERT")
        .when(moisture > ALERT_MOISTURE[1], "HIGH_MOISTURE_ALERT")
        .otherwise("NORMAL").alias("irrigation_alert"),
    ]


def flag_readings(unified: DataFrame) -> DataFrame:
    """Every reading with its flags (stateless, also used on streams)."""
    return unified.select(
        "reading_timestamp", "air_temp", "humidity", "soil_moisture", "ph_surface", *reading_flags()
    )


def monitoring_start(as_of=None) -> Column:
    return moment(as_of) - F.expr(f"INTERVAL {MONITOR_DAYS} DAYS")


def irrigation_start(as_of=None) -> Column:
    return moment(as_of) - F.expr(f"INTERVAL {IRRIGATION_HOURS} HOURS")


def sensor_monitoring(unified: DataFrame, as_of=None) -> DataFrame:
    """Flagged readings of the last seven days."""
    return flag_readings(unified.where(F.col("reading_timestamp") >= monitoring_start(as_of)))


def irrigation_aggregates() -> list[Column]:
    return [
        F.avg("soil_moisture").alias("current_moisture"),
        F.avg("air_temp").alias("current_temp"),
    ]


def irrigation_decision() -> list[Column]:
    """Recommendation and water need from mean moisture and temperature."""
    moisture, temp = F.col("current_moisture"), F.col("current_temp")
    return [
        F.when((moisture < 30) & (temp > 25), "IRRIGATE_NOW")
        .when((moisture < 40) & (temp > 20), "IRRIGATE_SOON")
        .when(moisture > 70, "SKIP_IRRIGATION")
        .otherwise("MONITOR").alias("recommendation"),
        F.when(moisture < 30, (40 - moisture) * 10).otherwise(0.0).alias("estimated_water_mm"),
    ]


def irrigation_recommendation(unified: DataFrame, as_of=None) -> DataFrame:
    """One row for the last two hours, also when no reading falls into them."""
    recent = unified.where(F.col("reading_timestamp") >= irrigation_start(as_of))
    return recent.agg(*irrigation_aggregates()).select(
        F.to_date(moment(as_of)).alias("recommendation_date"),
        "current_moisture", "current_temp", *irrigation_decision(),
    )


def readings_between(monitoring: DataFrame, start: str, end: str) -> DataFrame:
    """Readings of the inclusive date range, in no order."""
    day = F.to_date("reading_timestamp")
    return monitoring.where(day.between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def latest_reading(readings: DataFrame, *tie_break: str) -> DataFrame:
    """The newest reading; ``tie_break`` columns make the pick unique."""
    return readings.orderBy(F.desc("reading_timestamp"), *[F.desc(c) for c in tie_break]).limit(1)


def active_alerts(monitoring: DataFrame) -> DataFrame:
    """Readings with their alert texts joined by ", "; no alert gives an empty text."""
    messages = [
        F.when(F.col("temp_flag") == "ANOMALY",
               F.concat(F.lit("High Temp ("), F.col("air_temp").cast("string"), F.lit("°C)"))),
        F.when(F.col("moisture_flag") == "ANOMALY",
               F.concat(F.lit("Abnormal Moisture ("), F.col("soil_moisture").cast("string"), F.lit("%)"))),
        F.when(F.col("irrigation_alert") != "NORMAL", F.lit("Irrigation Needed")),
    ]
    return monitoring.withColumn("alerts", F.concat_ws(", ", *messages))


def trend_series(readings: DataFrame) -> DataFrame:
    """Long form of the four charted metrics."""
    return readings.unpivot("reading_timestamp", TREND_METRICS, "metric", "value")
