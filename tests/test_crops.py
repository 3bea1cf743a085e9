"""Crop features, scenarios and benchmarks on hand-made rows."""

import pytest

from fieldspark.operators import crops

STAGED = (
    "area string, item string, year int, hg_ha_yield double, average_rainfall_mm_per_year double,"
    " pesticides_tonnes double, avg_temp double"
)


def staged(spark, rows):
    return spark.createDataFrame(rows, STAGED)


def test_features_guard_divisions_and_classify(spark):
    rows = [
        ("A", "Wheat", 2010, 100.0, 0.0, 5.0, 14.9),
        ("B", "Wheat", 2010, 0.0, 50.0, 5.0, 15.0),
        ("C", "Wheat", 2010, 100.0, 50.0, 5.0, 25.0),
        ("D", "Wheat", 2010, 100.0, 50.0, 5.0, 25.1),
        ("E", "Wheat", 2010, None, 50.0, 5.0, None),
    ]
    got = {r.area: (r.yield_per_mm_rain, r.pesticides_per_yield_unit, r.temp_category)
           for r in crops.crop_yield_features(staged(spark, rows)).collect()}
    assert got == {
        "A": (None, 0.05, "cold"), "B": (0.0, None, "optimal"), "C": (2.0, 0.05, "optimal"),
        "D": (2.0, 0.05, "hot"), "E": (None, None, "hot"),
    }


def test_training_set_drops_yields_that_are_not_positive(spark):
    rows = [
        ("A", "Wheat", 2009, 10.0, 5.0, 1.0, 20.0), ("A", "Wheat", 2010, 10.0, 0.0, 1.0, 20.0),
        ("B", "Wheat", 2010, 0.0, 5.0, 1.0, 20.0), ("C", "Wheat", 2010, -1.0, 5.0, 1.0, 20.0),
        ("D", "Wheat", 2010, None, 5.0, 1.0, 20.0),
    ]
    got = crops.ml_training_dataset(crops.crop_yield_features(staged(spark, rows))).orderBy("year").collect()
    assert [(r.year, r.yield_efficiency, r.pesticide_intensity, r.year_in_decade, r.era) for r in got] == [
        (2009, 2.0, 0.2, 9, "historical"), (2010, None, None, 0, "modern"),
    ]


def test_scenarios_from_recent_years_with_rain(spark):
    rows = [
        ("A", "Wheat", 2007, 1.0, 9999.0, 1.0, 20.0),
        ("A", "Wheat", 2008, 1.0, 100.0, 10.0, 20.0),
        ("A", "Wheat", 2009, 1.0, 300.0, 30.0, 21.0),
        ("B", "Wheat", 2009, 1.0, 0.0, 30.0, 21.0),
        ("C", "Wheat", 2007, 1.0, 10.0, 30.0, 21.0),
    ]
    got = crops.current_conditions(crops.base_scenarios(staged(spark, rows)), "2025-01-01 00:00:00").collect()
    assert {r.area for r in got} == {"A"}
    values = {r.scenario: (r.average_rainfall_mm_per_year, r.pesticides_tonnes, r.avg_temp) for r in got}
    assert values["baseline"] == (200.0, 20.0, 20.5)
    assert values["optimistic"] == pytest.approx((230.0, 22.0, 20.0))
    assert values["pessimistic"] == pytest.approx((150.0, 24.0, 22.0))
    assert values["conservative"] == pytest.approx((190.0, 16.0, 20.5))
    assert {(r.year, r.year_in_decade, r.era) for r in got} == {(2025, 5, "modern")}


def test_benchmarks_need_ten_samples(spark):
    rows = [("A", "Wheat", 2000 + i, float(v), 10.0, 1.0, 20.0) for i, v in enumerate([1, 2, 3, 10] * 3)]
    rows += [("A", "Rice", 2000 + i, 1.0, 10.0, 1.0, 20.0) for i in range(9)]
    got = crops.crop_benchmarks(staged(spark, rows)).collect()
    assert [(r.crop_type, r.sample_size, r.avg_yield, r.p25_yield, r.p75_yield, r.max_yield, r.temp_stddev) for r in got] == [
        ("Wheat", 12, 4.0, 1.75, 4.75, 10.0, 0.0)
    ]
    single = crops.crop_benchmarks(staged(spark, rows[:1]), min_samples=1).first()
    assert single.temp_stddev is None and single.p25_yield == 1.0
