"""Physical plans: what reaches the scan, what is shuffled, what is broadcast."""

import re

import pytest

from fieldspark.operators import sensors, staging
from fieldspark.plans import bindings as b
from fieldspark.plans import queries as q
from fieldspark.plans import reports


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def raw(spark, sf_dir, tmp_path_factory):
    """Raw tables as they lie in storage, with nanosecond bigints."""
    base = tmp_path_factory.mktemp("raw")
    tables = {}
    for name, df in (("weather", b.weather(spark, sf_dir)), ("soil", b.soil(spark, sf_dir))):
        df.write.parquet(str(base / name))
        tables[name] = spark.read.parquet(str(base / name))
    return tables


def test_time_filter_reaches_both_raw_scans(raw):
    text = plan(reports.monitoring(raw["weather"], raw["soil"], q.MONITORING_AS_OF))
    pushed = re.findall(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(timestamp,(\d+)\)", text)
    assert len(pushed) == 2
    assert set(pushed) == {"1706054400000000000"}


def test_pruned_scans_lose_no_rows(raw):
    pruned = reports.monitoring(raw["weather"], raw["soil"], q.MONITORING_AS_OF)
    whole = sensors.sensor_monitoring(reports.unified_readings(raw["weather"], raw["soil"]), q.MONITORING_AS_OF)
    assert pruned.count() == whole.count() > 0
    assert pruned.exceptAll(whole).count() == 0


def test_both_bounds_of_a_range_reach_both_raw_scans(spark, raw):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # else the filters are cut off
    text = plan(reports.readings_in_range(raw["weather"], raw["soil"], *q.RANGE))
    for bound in ("GreaterThanOrEqual", "LessThan"):
        assert len(re.findall(rf"PushedFilters: \[[^\]]*{bound}\(timestamp,(\d+)\)", text)) == 2
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "rangepartitioning" not in text


def test_summary_reads_only_its_columns(raw):
    text = plan(reports.farm_summary(raw["weather"], raw["soil"]))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    weather_columns = next(s for s in schemas if "temperature" in s)
    assert "pressure" not in weather_columns and "latitude" not in weather_columns
    assert not any("ph_100_200cm" in s or "created_at" in s for s in schemas)


def test_weather_is_not_shuffled_for_the_join(raw):
    weather, soil = staging.stg_weather(raw["weather"]), staging.stg_soil(raw["soil"])
    text = plan(sensors.sensor_readings_unified(weather, soil))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert text.count("Exchange hashpartitioning") == 1  # the soil group limit only


def test_latest_record_is_limited_before_the_shuffle(raw):
    text = plan(sensors.soil_daily_latest(staging.stg_soil(raw["soil"])))
    assert re.search(r"WindowGroupLimit.*Partial", text)


def test_top_n_does_not_sort_everything(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(q.top_predictions(spark, sf_dir))


def test_no_python_in_the_operators(spark, sf_dir):
    for query in (q.daily_farm_summary, q.active_alerts, q.current_conditions, q.correlation_matrix, q.label_codes):
        text = plan(query(spark, sf_dir))
        assert "Python" not in text and "CartesianProduct" not in text and "BroadcastNestedLoop" not in text


def test_models_of_the_yields_share_their_joins(spark, sf_dir):
    tables = reports.farm_models(b.weather(spark, sf_dir), b.soil(spark, sf_dir), b.crop_yield(spark, sf_dir), q.MONITORING_AS_OF)
    for name in reports.YIELD_MODELS:
        read = {"lineitem" if "lineitem" in path else "stored" for path in tables[name].inputFiles() if "lineitem" in path or "crop-yield" in path}
        assert read <= {"stored"} and "lineitem" not in plan(tables[name]), name
