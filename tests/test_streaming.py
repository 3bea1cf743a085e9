"""Streams over several files and batches against their batch forms."""

import os

import pytest
from pyspark.sql import functions as F

import compare
from fieldspark.functions.columns import truncate
from fieldspark.operators import sensors, staging
from fieldspark.plans import bindings as b
from fieldspark.plans.queries import SINGLE_PRECISION
from fieldspark.streaming import jobs


@pytest.fixture(scope="module")
def arriving(spark, sf_dir, tmp_path_factory):
    """The events as four files that arrived in time order, a minute apart."""
    path = tmp_path_factory.mktemp("arriving") / "events"
    b.events(spark, sf_dir).repartitionByRange(4, "event_id").write.parquet(str(path))
    for minute, file in enumerate(sorted(path.glob("part-*.parquet"))):
        os.utime(file, (1_700_000_000 + 60 * minute,) * 2)
    return str(path)


@pytest.fixture(scope="module")
def soil_daily(spark, sf_dir):
    return sensors.soil_daily_latest(b.staged_soil(spark, sf_dir))


def stream(spark, path):
    events = jobs.file_stream(spark, path, spark.read.parquet(path).schema, files_per_batch=1)
    return staging.stg_weather(b.weather_from(events))


def rows(df):
    return compare.rows_of(df.columns, [tuple(r) for r in df.collect()])


def test_ingest_resumes_where_it_stopped(spark, sf_dir, arriving, tmp_path):
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    for _ in range(2):
        landed = jobs.append_available(stream(spark, arriving), out, progress)
    assert rows(landed) == rows(b.staged_weather(spark, sf_dir))


def test_repeats_are_dropped_across_batches(spark, sf_dir, arriving, tmp_path):
    hourly = stream(spark, arriving).withColumn("timestamp", truncate("hour", "timestamp"))
    landed = jobs.append_available(jobs.without_repeats(hourly), str(tmp_path / "out"), str(tmp_path / "p"))
    keys = ["latitude", "longitude", "timestamp"]
    batch = b.staged_weather(spark, sf_dir).withColumn("timestamp", truncate("hour", "timestamp"))
    assert rows(landed.select(*keys)) == rows(batch.select(*keys).distinct())


def test_daily_roll_up_in_batches_equals_the_batch_form(spark, sf_dir, arriving, soil_daily, tmp_path):
    unified = jobs.unified_stream(stream(spark, arriving), soil_daily)
    rolled = jobs.keep_current(jobs.daily_stream(unified), ["date"], str(tmp_path / "out"), str(tmp_path / "p"))
    batch = sensors.daily_conditions(sensors.unify_readings(b.staged_weather(spark, sf_dir), soil_daily))
    # Means differ in their last bits with the order of arrival.
    means = {name: F.col(name).cast("float") for name in SINGLE_PRECISION["daily_conditions"]}
    assert rows(rolled.withColumns(means)) == rows(batch.withColumns(means))


def test_append_mode_closes_all_but_the_last_windows(spark, arriving, soil_daily, tmp_path):
    unified = jobs.unified_stream(stream(spark, arriving), soil_daily)
    closed = jobs.append_available(jobs.daily_stream(unified), str(tmp_path / "out"), str(tmp_path / "p"))
    assert 0 < closed.count() < 30
    assert closed.groupBy("date").count().where("count > 1").count() == 0


def test_readings_beyond_the_watermark_are_dropped(spark, tmp_path):
    path = str(tmp_path / "unified")
    schema = (
        "reading_timestamp timestamp_ntz, air_temp double, humidity double, soil_moisture double,"
        " ph_surface double, solar_radiation double"
    )

    def land(*stamps):
        values = [(stamp, 10.0, 1.0, 1.0, 1.0, 1.0) for stamp in stamps]
        frame = spark.createDataFrame(values, schema.replace("timestamp_ntz", "string"))
        frame.withColumn("reading_timestamp", F.col("reading_timestamp").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(path)

    out, progress = str(tmp_path / "out"), str(tmp_path / "p")
    land("2025-01-01 10:00:00", "2025-01-05 00:00:00")
    run = lambda: jobs.append_available(
        jobs.daily_stream(jobs.file_stream(spark, path, spark.read.parquet(path).schema)), out, progress
    )
    run()
    land("2025-01-01 11:00:00", "2025-01-09 00:00:00")
    counts = {str(r.date)[:10]: r.reading_count for r in run().collect()}
    assert counts["2025-01-01"] == 1
    assert "2025-01-09" not in counts


def test_a_reader_sees_whole_versions_only(spark, arriving, soil_daily, tmp_path):
    out, progress = str(tmp_path / "out"), str(tmp_path / "p")
    unified = jobs.unified_stream(stream(spark, arriving), soil_daily)
    final = rows(jobs.keep_current(jobs.daily_stream(unified), ["date"], out, progress))
    versions = jobs._versions(spark, out)
    assert len(versions) > 2 and len(list((tmp_path / "out").glob("version=*"))) <= jobs.VERSIONS + 1
    # A version without a pointer, as a failed batch leaves it, is not read.
    spark.read.parquet(f"{out}/version={versions[-1]}").limit(1).write.parquet(f"{out}/version={versions[-1] + 1}")
    assert rows(jobs.read_current(spark, out)) == final
    earlier = spark.read.parquet(f"{out}/version={versions[-2]}")
    assert earlier.groupBy("date").count().where("count > 1").isEmpty() and 0 < earlier.count() <= len(final)
