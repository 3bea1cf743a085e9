"""Branches of the sensor operators that the given tables do not reach."""

from datetime import datetime as dt

import pytest

from fieldspark.operators import sensors

SOIL = "id long, timestamp timestamp_ntz, t_0_cm double, t_10_cm double, moisture double, ph_0_5cm double"
WEATHER = (
    "id long, latitude double, longitude double, timestamp timestamp_ntz,"
    " temperature double, humidity double, solar_radiation double, pressure double"
)
UNIFIED = (
    "reading_timestamp timestamp_ntz, air_temp double, humidity double, soil_moisture double,"
    " ph_surface double, solar_radiation double"
)
AS_OF = "2025-03-08 12:00:00"


def unified(spark, rows):
    return spark.createDataFrame(rows, UNIFIED)


def reading(temp, moisture, when=dt(2025, 3, 8, 11)):
    return (when, temp, 50.0, moisture, 6.0, 1.0)


def test_latest_soil_record_ties_go_to_the_higher_id(spark):
    rows = [
        (1, dt(2025, 3, 1, 9), 1.0, 1.0, 10.0, 5.0),
        (3, dt(2025, 3, 1, 9), 3.0, 3.0, 30.0, 5.0),
        (2, dt(2025, 3, 1, 9), 2.0, 2.0, 20.0, 5.0),
        (9, dt(2025, 3, 1, 8), 9.0, 9.0, 90.0, 5.0),
        (4, dt(2025, 3, 2, 0), 4.0, 4.0, None, 5.0),
    ]
    latest = sensors.soil_daily_latest(spark.createDataFrame(rows, SOIL)).collect()
    assert {(r.date_day, r.soil_moisture) for r in latest} == {(dt(2025, 3, 1), 30.0), (dt(2025, 3, 2), None)}


def test_weather_on_days_without_soil_is_dropped(spark):
    soil = spark.createDataFrame([(1, dt(2025, 3, 1, 9), 1.0, 1.0, 10.0, 5.0)], SOIL)
    weather = spark.createDataFrame([
        (1, 1.0, 2.0, dt(2025, 3, 1, 23, 59, 59), 20.0, 50.0, 1.0, 1000.0),
        (2, 1.0, 2.0, dt(2025, 3, 2, 0, 0, 0), 21.0, 50.0, 1.0, 1000.0),
    ], WEATHER)
    rows = sensors.sensor_readings_unified(weather, soil).collect()
    assert [(r.reading_timestamp, r.air_temp, r.soil_moisture) for r in rows] == [(dt(2025, 3, 1, 23), 20.0, 10.0)]


@pytest.mark.parametrize("temp, moisture, expected", [
    (-50.0, 0.0, ("OK", "OK", "LOW_MOISTURE_ALERT")),
    (-50.1, -0.1, ("ANOMALY", "ANOMALY", "LOW_MOISTURE_ALERT")),
    (60.0, 100.0, ("OK", "OK", "HIGH_MOISTURE_ALERT")),
    (60.1, 100.1, ("ANOMALY", "ANOMALY", "HIGH_MOISTURE_ALERT")),
    (20.0, 20.0, ("OK", "OK", "NORMAL")),
    (20.0, 80.0, ("OK", "OK", "NORMAL")),
    (None, None, ("OK", "OK", "NORMAL")),
])
def test_flags_at_their_bounds(spark, temp, moisture, expected):
    row = sensors.flag_readings(unified(spark, [reading(temp, moisture)])).first()
    assert (row.temp_flag, row.moisture_flag, row.irrigation_alert) == expected


def test_monitoring_keeps_the_last_seven_days_without_upper_bound(spark):
    rows = [reading(1.0, 1.0, when) for when in (
        dt(2025, 3, 1, 11), dt(2025, 3, 1, 12), dt(2025, 3, 9, 0),
    )]
    kept = sensors.sensor_monitoring(unified(spark, rows), AS_OF).collect()
    assert sorted(r.reading_timestamp for r in kept) == [dt(2025, 3, 1, 12), dt(2025, 3, 9, 0)]


@pytest.mark.parametrize("moisture, temp, recommendation, water", [
    (29.5, 25.5, "IRRIGATE_NOW", 105.0),
    (29.5, 25.0, "IRRIGATE_SOON", 105.0),
    (30.0, 30.0, "IRRIGATE_SOON", 0.0),
    (39.5, 20.0, "MONITOR", 0.0),
    (40.0, 30.0, "MONITOR", 0.0),
    (70.0, 30.0, "MONITOR", 0.0),
    (70.5, 30.0, "SKIP_IRRIGATION", 0.0),
    (10.0, 5.0, "MONITOR", 300.0),
])
def test_irrigation_outcomes(spark, moisture, temp, recommendation, water):
    row = sensors.irrigation_recommendation(unified(spark, [reading(temp, moisture)]), AS_OF).first()
    assert (row.recommendation, row.estimated_water_mm) == (recommendation, water)
    assert str(row.recommendation_date) == "2025-03-08"


def test_irrigation_without_recent_readings_still_gives_a_row(spark):
    old = unified(spark, [reading(30.0, 10.0, dt(2025, 3, 8, 9))])
    assert [tuple(r)[1:] for r in sensors.irrigation_recommendation(old, AS_OF).collect()] == [
        (None, None, "MONITOR", 0.0)
    ]


def test_now_defaults_to_the_query_start(spark):
    assert sensors.irrigation_recommendation(unified(spark, [reading(30.0, 10.0)])).first().current_moisture is None


def test_daily_change_is_against_the_previous_row(spark):
    rows = [reading(10.0, 50.0, dt(2025, 3, 1, h)) for h in range(20)]
    rows += [reading(12.5, 50.0, dt(2025, 3, 4)), reading(None, None, dt(2025, 3, 4))]
    summary = sensors.daily_farm_summary(sensors.daily_conditions(unified(spark, rows))).collect()
    assert [(r.date, r.avg_daily_temp, r.temp_change_24h, r.reading_count, r.sensor_status) for r in summary] == [
        (dt(2025, 3, 4), 12.5, 2.5, 2, "WARNING"),
        (dt(2025, 3, 1), 10.0, None, 20, "HEALTHY"),
    ]


def test_rolling_mean_spans_seven_rows(spark):
    rows = [reading(float(day), 50.0, dt(2025, 3, day)) for day in range(1, 11)]
    rolled = sensors.rolling_7d_temp(sensors.daily_conditions(unified(spark, rows))).orderBy("date").collect()
    assert [r.temp_7day_avg for r in rolled][:2] == [1.0, 1.5]
    assert rolled[-1].temp_7day_avg == 7.0


def test_alert_texts(spark):
    frame = sensors.flag_readings(unified(spark, [reading(75.5, 101.25), reading(20.0, 50.0), reading(20.0, 5.0)]))
    alerts = sorted(r.alerts for r in sensors.active_alerts(frame).collect())
    assert alerts == [
        "", "High Temp (75.5°C), Abnormal Moisture (101.25%), Irrigation Needed", "Irrigation Needed",
    ]


def test_range_includes_both_days(spark):
    rows = [reading(1.0, 1.0, w) for w in (
        dt(2025, 3, 1, 23), dt(2025, 3, 2, 0), dt(2025, 3, 3, 23), dt(2025, 3, 4, 0),
    )]
    found = sensors.readings_between(sensors.flag_readings(unified(spark, rows)), "2025-03-02", "2025-03-03")
    assert sorted(r.reading_timestamp for r in found.collect()) == [dt(2025, 3, 2, 0), dt(2025, 3, 3, 23)]
    assert sensors.trend_series(found).count() == 8
