"""Profile, evaluation, serving and label operators on hand-made rows."""

import random

import pytest
from pyspark.sql import functions as F

from fieldspark.functions.columns import hash_bucket
from fieldspark.operators import evaluate, labels, profile, serving


def test_means_lose_no_digits(spark):
    tiny = spark.createDataFrame([(1e-5,), (2e-5,), (3e-5,)], "x double")
    assert profile.describe_numeric(tiny, ["x"]).first()["mean"] == pytest.approx(2e-5)
    rows = [("a", 1e-9, 5.0), ("a", 2.0, 3.0), ("b", float("nan"), 1.0)]
    errors = evaluate.prediction_errors(spark.createDataFrame(rows, "k string, actual double, predicted double"))
    means = {r.k: r.mean_ape for r in evaluate.mean_ape_by(errors, "k").collect()}
    assert means["a"] == pytest.approx((5e11 - 100 + 50) / 2) and means["b"] != means["b"]


def test_hash_bucket_is_stable(spark):
    df = spark.range(1000).select(hash_bucket(5, "id").alias("b"))
    counts = [r["count"] for r in df.groupBy("b").count().collect()]
    assert len(counts) == 5 and min(counts) > 150


def test_histogram_closes_its_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 9, 10, 10)] + [(None,), (float("nan"),)], "x double")
    got = {r.bin: (r.bin_start, r.n) for r in profile.histogram(df, "x", 5).collect()}
    assert got == {0: (0.0, 2), 1: (2.0, 1), 2: (4.0, 0), 3: (6.0, 0), 4: (8.0, 3)}
    flat = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert {r.bin: r.n for r in profile.histogram(flat, "x", 5).collect()} == {0: 0, 1: 0, 2: 2, 3: 0, 4: 0}


def test_profile_counts_nulls_and_distinct_values(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), (None, 1)], "k string, v int")
    nulls = {r.column_name: (r.null_count, r.has_nulls) for r in profile.null_profile(df).collect()}
    assert nulls == {"k": (1, True), "v": (1, True)}
    assert profile.distinct_counts(df, ["k", "v"]).first() == (3, 2, 1)
    assert profile.distinct_counts(df, ["k"], approximate=True).first() == (3, 2)
    assert {r.k for r in profile.distinct_values(df, "k").collect()} == {"a", "b", None}
    described = profile.describe_numeric(df.withColumn("w", F.lit(2.5)), ["v", "w"]).collect()
    assert {(r.column_name, r.n, r.mean, r.p50) for r in described} == {("v", 2, 1.0, 1.0), ("w", 3, 2.5, 2.5)}


def test_sample_is_repeatable(spark):
    df = spark.range(100)
    once = profile.sample_rows(df, 5, df.columns, seed=1).collect()
    assert once == profile.sample_rows(df.repartition(7), 5, df.columns, seed=1).collect()
    assert once != profile.sample_rows(df, 5, df.columns, seed=2).collect()


def test_errors_guard_a_zero_actual(spark):
    df = spark.createDataFrame([("a", 10.0, 8.0), ("a", 0.0, 5.0), ("b", 4.0, 5.0)], "crop string, actual double, predicted double")
    errors = evaluate.prediction_errors(df)
    got = {(r.actual, r.error, r.absolute_error, r.percentage_error) for r in errors.collect()}
    assert got == {(10.0, 2.0, 2.0, 20.0), (0.0, -5.0, 5.0, None), (4.0, -1.0, 1.0, 25.0)}
    by_crop = [tuple(r) for r in evaluate.errors_by(errors, "crop").collect()]
    assert by_crop == [("b", 25.0, 25.0, 1, 1.0, 1.0), ("a", 20.0, 20.0, 1, 3.5, 3.5)]
    within = {r.threshold_pct: (r.n_within, r.share_pct) for r in evaluate.error_thresholds(errors, (20, 30)).collect()}
    assert within == {20: (1, pytest.approx(100 / 3)), 30: (2, pytest.approx(200 / 3))}


def test_metrics_match_their_formulas(spark):
    actual, predicted = [1.0, 2.0, 3.0, 4.0], [1.5, 1.5, 3.5, 4.5]
    df = spark.createDataFrame([("m", a, p) for a, p in zip(actual, predicted)], "model string, actual double, predicted double")
    row = evaluate.regression_metrics(df, ["model"]).first()
    assert (row.rmse, row.mae, row.n) == (0.5, 0.5, 4)
    assert row.r2 == pytest.approx(1 - 1.0 / 5.0)
    ape = sorted(abs(a - p) / a * 100 for a, p in zip(actual, predicted))
    assert row.mean_ape == pytest.approx(sum(ape) / 4)
    assert row.median_ape == pytest.approx((ape[1] + ape[2]) / 2)


def test_models_rank_by_r2_with_change_against_the_baseline(spark):
    # Published hold-out metrics of three models.
    rows = [
        ("Gradient Boosting", 0.9609, 16831.29, 9832.79, 25.34, 11.94),
        ("Extra Trees", 0.9892, 8853.31, 3597.14, 8.77, 2.08),
        ("Random Forest", 0.9841, 10740.36, 4124.76, 8.58, 2.23),
    ]
    metrics = spark.createDataFrame(rows, "model string, r2 double, rmse double, mae double, mean_ape double, median_ape double")
    table = evaluate.model_comparison(metrics, "Random Forest").collect()
    assert [r.model for r in table] == ["Extra Trees", "Random Forest", "Gradient Boosting"]
    assert table[0].rmse_change_pct == pytest.approx((10740.36 - 8853.31) / 10740.36 * 100)
    assert (table[1].r2_change_pct, table[1].mae_change_pct) == (0.0, 0.0)


def test_labels_are_numbered_in_order_and_strict(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "a", "c", "a", None] * 20], "k string").repartition(8)
    codes = labels.label_codes(df, "k")
    assert {(r.label, r.code) for r in codes.collect()} == {("a", 0), ("b", 1), ("c", 2)}
    encoded = evaluate.encode_labels(df, codes, "k")
    decoded = evaluate.decode_labels(encoded, codes, "k_code", "name")
    assert decoded.where("k IS DISTINCT FROM name").count() == 0
    strange = spark.createDataFrame([("z",), ("a",)], "k string")
    with pytest.raises(Exception, match="unseen k: z"):
        evaluate.encode_labels(strange, codes, "k").collect()
    kept = {(r.k, r.k_code) for r in evaluate.encode_labels(strange, codes, "k", unseen="keep").collect()}
    assert kept == {("z", None), ("a", 0)}


def test_large_label_tables_are_joined_without_broadcast(spark):
    from fieldspark.operators.joins import broadcast_within

    side = spark.range(10)
    assert "ResolvedHint" in broadcast_within(side, 10)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in broadcast_within(side, 9)._jdf.queryExecution().analyzed().toString()


def test_scenario_figures(spark):
    rows = [("A", "Wheat", 2025, s, p) for s, p in (
        ("baseline", 25.0), ("baseline", 35.0), ("optimistic", 65.0), ("pessimistic", 15.0),
    )]
    scored = spark.createDataFrame(rows, "area string, crop_type string, year int, scenario string, prediction double")
    out = serving.prediction_output(scored, as_of="2025-05-01 06:00:00")
    first = out.where("predicted_yield_hg_ha = 65").first()
    assert (first.predicted_yield_kg_ha, first.predicted_yield_tonnes_ha, first.model_version) == (6.5, 0.0065, "v1.0")
    summary = {r.scenario: (r.mean_kg_ha, r.min_kg_ha, r.max_kg_ha) for r in serving.scenario_summary(out).collect()}
    assert summary == {"baseline": (3.0, 2.0, 4.0), "optimistic": (6.0, 6.0, 6.0), "pessimistic": (2.0, 2.0, 2.0)}
    assert serving.forecast_kpis(out).first() == (3.0, 6.5, "2025-05-01")
    bars = serving.yield_by_crop_scenario(out).first()
    assert (bars.baseline, bars.optimistic, bars.conservative) == (6.0, 6.5, None)


def test_only_the_newest_batch_is_served(spark):
    df = spark.createDataFrame([(1, "2025-01-01"), (2, "2025-01-02"), (3, "2025-01-02")], "id int, prediction_date string")
    assert {r.id for r in serving.latest_predictions(df).collect()} == {2, 3}
