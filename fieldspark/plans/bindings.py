"""Farm-shaped tables derived from the given star-schema and event tables.

This is the only module that knows those tables. Each function keeps every row of
the events or line items it is built from: each event is either a weather or a soil reading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.functions.columns import hg_to_kg, hg_to_tonnes, timestamp_to_ns
from fieldspark.operators.staging import stg_crop_yield, stg_soil, stg_weather
from fieldspark.sources.schemas import PH_DEPTHS

WEATHER_EVENTS = ["view", "click"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def weather_from(events: DataFrame) -> DataFrame:
    """Raw weather readings; works on a static or a streaming frame."""
    user = F.col("user_id")
    return events.where(F.col("event_type").isin(WEATHER_EVENTS)).select(
        F.col("event_id").alias("id"),
        (user % 5 + 40).cast("double").alias("latitude"),
        (-(user % 3) - 120).cast("double").alias("longitude"),
        timestamp_to_ns("ts").alias("timestamp"),
        (F.col("value") - 60).alias("temperature"),
        (F.col("value") % 100).alias("humidity"),
        (F.col("value") * 2).alias("solar_radiation"),
        (user + 950).cast("double").alias("pressure"),
        timestamp_to_ns("ts").alias("created_at"),
    )


def soil_from(events: DataFrame) -> DataFrame:
    """Raw soil readings."""
    surface = (F.col("user_id") % 4) * F.lit(0.5).cast("double") + 5
    return events.where(~F.col("event_type").isin(WEATHER_EVENTS)).select(
        F.col("event_id").alias("id"),
        timestamp_to_ns("ts").alias("timestamp"),
        (F.col("value") / 3).alias("t_0_cm"),
        (F.col("value") / 4).alias("t_10_cm"),
        (F.col("value") - 5).alias("moisture"),
        surface.alias("ph_0_5cm"),
        *[
            (surface + k / 10).alias(name)
            for k, name in enumerate(
                ("ph_5_15cm", "ph_15_30cm", "ph_30_60cm", "ph_60_100cm", "ph_100_200cm"), start=1
            )
        ],
        timestamp_to_ns("ts").alias("created_at"),
    )


def _as_text(document: Column, broken: Column) -> Column:
    """Documents as lines of JSON; those ``broken`` end in the middle."""
    text = F.to_json(document)
    return F.when(broken, F.substring(text, 1, 60)).otherwise(text).alias("value")


def weather_documents(events: DataFrame) -> DataFrame:
    """A delivered weather document per weather event: the event's hour and the next one.

    Many events share place and hour. Some documents are broken, lack their latitude, or hold no
    temperature or a humidity beyond its column.
    """
    user, event = F.col("user_id"), F.col("event_id")
    start = F.unix_seconds(F.date_trunc("hour", "ts").cast("timestamp"))

    def hour(shift):
        return F.struct(
            (start + shift).alias("datetimeEpoch"),
            F.when(event % 7 != 0, F.col("value")).alias("temp"),
            F.when(event % 50 == 0, 100000.0).otherwise(F.col("value") % 100).alias("humidity"),
            (F.col("value") * 2).alias("solarradiation"),
            (user + 950).cast("double").alias("pressure"),
        )

    document = F.struct(
        F.when(event % 41 != 0, (user % 5 + 40).cast("double")).alias("latitude"),
        (-(user % 3) - 120).cast("double").alias("longitude"),
        F.array(F.struct(F.array(hour(0), hour(3600)).alias("hours"))).alias("days"),
    )
    return events.where(F.col("event_type").isin(WEATHER_EVENTS)).select(_as_text(document, event % 97 == 3))


def soil_documents(events: DataFrame) -> DataFrame:
    """A delivered soil record per soil event; some are broken, without time, or out of range."""
    event = F.col("event_id")
    surface = (F.col("user_id") % 4) * F.lit(0.5).cast("double") + 5
    record = F.struct(
        F.when(event % 43 != 0, F.unix_seconds(F.col("ts").cast("timestamp"))).alias("dt"),
        F.when(event % 60 == 5, -5000.0).otherwise(F.col("value")).alias("t10"),
        (F.col("value") + 1).alias("t0"),
        F.when(event % 3 != 0, F.col("value") % 100).alias("moisture"),
        *[(surface + k / 10).alias(key) for k, key in enumerate(PH_DEPTHS)],
    )
    return events.where(~F.col("event_type").isin(WEATHER_EVENTS)).select(_as_text(record, event % 97 == 3))


def weather(spark, sf_dir):
    return weather_from(events(spark, sf_dir))


def soil(spark, sf_dir):
    return soil_from(events(spark, sf_dir))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order, the customer's nation and the part."""
    read = lambda name: table(spark, sf_dir, name)
    return (
        read("lineitem")
        .join(read("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(read("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(read("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )


def crop_yield(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw yields: area × crop × year with rainfall, pesticides and temperature."""
    return sales(spark, sf_dir).select(
        F.col("n_name").alias("area"),
        F.col("p_type").alias("item"),
        (F.year("o_orderdate") + 12).alias("year"),
        F.col("l_extendedprice").alias("hg_ha_yield"),
        F.col("p_retailprice").alias("average_rain_fall_mm_per_year"),
        F.col("l_quantity").alias("pesticides_tonnes"),
        F.col("p_size").cast("double").alias("avg_temp"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic predictions beside their actual yields."""
    predicted = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    scenario = F.element_at(
        F.array(*[F.lit(s) for s in ("baseline", "optimistic", "pessimistic", "conservative")]),
        F.col("l_linenumber") % 4 + 1,
    )
    return sales(spark, sf_dir).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        "l_orderkey", "l_linenumber",
        F.col("n_name").alias("area"),
        F.col("p_type").alias("crop_type"),
        (F.year("o_orderdate") + 12).alias("year"),
        scenario.alias("scenario"),
        F.col("l_extendedprice").alias("actual"),
        predicted.alias("predicted"),
        predicted.alias("predicted_yield_hg_ha"),
        hg_to_kg(predicted).alias("predicted_yield_kg_ha"),
        hg_to_tonnes(predicted).alias("predicted_yield_tonnes_ha"),
        F.col("o_orderdate").alias("prediction_date"),
        F.col("l_tax").alias("tax"),
        F.col("l_discount").alias("discount"),
    )


def staged_weather(spark, sf_dir):
    return stg_weather(weather(spark, sf_dir))


def staged_soil(spark, sf_dir):
    return stg_soil(soil(spark, sf_dir))


def staged_crop_yield(spark, sf_dir):
    return stg_crop_yield(crop_yield(spark, sf_dir))
