"""Registered queries that run the streaming jobs over the whole event table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fieldspark.functions.columns import truncate
from fieldspark.operators.sensors import soil_daily_latest
from fieldspark.operators.staging import stg_weather
from fieldspark.plans import bindings as b
from fieldspark.session import work_path
from fieldspark.streaming import jobs


def _weather(spark, sf_dir) -> DataFrame:
    # The bracket makes the path a pattern, which a single-file table needs.
    arriving = jobs.file_stream(spark, f"{sf_dir}/[e]vents.parquet", b.events(spark, sf_dir).schema)
    return stg_weather(b.weather_from(arriving))


def _unified(spark, sf_dir) -> DataFrame:
    return jobs.unified_stream(_weather(spark, sf_dir), soil_daily_latest(b.staged_soil(spark, sf_dir)))


def _append(spark, stream, name):
    return jobs.append_available(stream, work_path(spark, name), work_path(spark, f"{name}-progress"))


def _keep(spark, stream, key, name):
    return jobs.keep_current(stream, [key], work_path(spark, name), work_path(spark, f"{name}-progress"))


def stream_ingest(spark, sf_dir):
    return _append(spark, _weather(spark, sf_dir), "stream-ingest")


def stream_dedupe(spark, sf_dir):
    hourly = _weather(spark, sf_dir).withColumn("timestamp", truncate("hour", "timestamp"))
    keys = jobs.without_repeats(hourly).select("latitude", "longitude", "timestamp")
    return _append(spark, keys, "stream-dedupe")


def stream_alerts(spark, sf_dir):
    return _append(spark, jobs.alert_stream(_unified(spark, sf_dir)), "stream-alerts")


def stream_unified(spark, sf_dir):
    return _append(spark, _unified(spark, sf_dir), "stream-unified")


def stream_daily_conditions(spark, sf_dir):
    return _keep(spark, jobs.daily_stream(_unified(spark, sf_dir)), "date", "stream-daily")


def stream_irrigation(spark, sf_dir):
    return _keep(spark, jobs.irrigation_stream(_unified(spark, sf_dir)), "window_start", "stream-irrigation")


STREAM_QUERIES = [
    stream_ingest, stream_dedupe, stream_alerts, stream_unified, stream_daily_conditions, stream_irrigation,
]
