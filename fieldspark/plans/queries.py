"""The registered queries: every operator over the whole given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldspark.functions.columns import hash_bucket, truncate
from fieldspark.operators import crops, evaluate, labels, profile, quality, sensors, serving, staging
from fieldspark.plans import bindings as b
from fieldspark.plans import reports
from fieldspark.session import configure, stored, work_path
from fieldspark.sources import readers, schemas, sinks

# Fixed "now" of the time-dependent queries; the events end on 2024-01-30.
MONITORING_AS_OF = "2024-01-31 00:00:00"
IRRIGATION_AS_OF = "2024-01-30 23:59:59"
RANGE = ("2024-01-10", "2024-01-20")
GROWTH_CUTOFF = "2024-01-16 00:00:00"

NUMERIC = [
    "target_yield", "year", "average_rainfall_mm_per_year", "pesticides_tonnes",
    "avg_temp", "yield_efficiency", "pesticide_intensity", "year_in_decade",
]
# The column names that a correlation matrix is asked for.
CORRELATED = [
    "target_yield", "yield_efficiency", "pesticide_intensity", "average_rainfall_mm_per_year", "avg_temp",
]
PREDICTION_KEYS = ["l_orderkey", "l_linenumber"]


# Sums and means of doubles depend on the order of their terms in the last bits. These columns are
# compared, and given, as single-precision numbers.
_DAILY = ["avg_daily_temp", "avg_humidity", "avg_soil_moisture", "avg_ph"]
_IRRIGATION = ["current_moisture", "current_temp", "estimated_water_mm"]
_CONDITIONS = ["average_rainfall_mm_per_year", "pesticides_tonnes", "avg_temp", "pesticide_intensity"]
SINGLE_PRECISION = {
    "daily_conditions": [*_DAILY, "total_solar_radiation"],
    "stream_daily_conditions": [*_DAILY, "total_solar_radiation"],
    "daily_farm_summary": [*_DAILY, "temp_change_24h"],
    "landing_farm_summary": [*_DAILY, "temp_change_24h"],
    "rolling_7d_temp": ["avg_daily_temp", "temp_7day_avg"],
    "irrigation_recommendation": _IRRIGATION,
    "stream_irrigation": _IRRIGATION,
    "base_scenarios": ["baseline_rainfall", "baseline_pesticides", "baseline_temp"],
    "current_conditions": _CONDITIONS,
    "sql_text_query": _CONDITIONS,
    "crop_benchmarks": ["avg_yield", "optimal_temp", "optimal_rainfall", "typical_pesticide_use"],
    "describe_numeric": ["mean"],
    "prediction_summary": ["avg_prediction"],
    "predictions_by_crop": ["avg_yield_kg_ha"],
    "forecast_kpis": ["baseline_avg_kg_ha"],
    "yield_by_crop_scenario": ["baseline", "optimistic", "pessimistic", "conservative"],
    "errors_by_crop": ["mean_ape", "mean_ae"],
    "errors_by_year": ["mean_ape"],
    "error_distribution": ["mean_ae", "mean_ape"],
    "regression_metrics": ["mae", "mean_ape"],
    "model_comparison": ["mae", "mean_ape"],
}


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Round the columns whose last bit depends on the engine."""
    return df.withColumns({name: F.round(name, n) for name, n in digits.items()})


# --- scans, sources, sinks ---------------------------------------------------

def _as_declared(df, schema):
    """Columns in their declared types. Numbers are cut, not rounded: engines differ in halves of the last digit."""
    def declared(field):
        value = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            value = F.floor(value * 10**field.dataType.scale) / 10**field.dataType.scale
        return value.cast(field.dataType).alias(field.name)

    return df.select(*[declared(field) for field in schema.fields])


def scan_weather(spark, sf_dir):
    path = work_path(spark, "raw-weather")
    _as_declared(b.weather(spark, sf_dir), schemas.WEATHER).write.parquet(path)
    return readers.read_weather(spark, path)


def scan_soil(spark, sf_dir):
    path = work_path(spark, "raw-soil")
    _as_declared(b.soil(spark, sf_dir), schemas.SOIL).write.parquet(path)
    return readers.read_soil(spark, path)


def scan_crop_yield(spark, sf_dir):
    path = work_path(spark, "crop-seed")
    sinks.export_csv(b.crop_yield(spark, sf_dir), path)
    return readers.read_crop_seed(spark, path)


def csv_roundtrip(spark, sf_dir):
    path = work_path(spark, "readings-csv")
    readings = sensors.flag_readings(_unified(spark, sf_dir))
    sinks.export_csv(readings, path)
    return readers.load_from_csv(spark, path).withColumn(
        "reading_timestamp", F.col("reading_timestamp").cast("timestamp_ntz")
    )


def parquet_roundtrip(spark, sf_dir):
    path = work_path(spark, "predictions")
    batch = serving.prediction_output(b.predictions(spark, sf_dir), "predicted", as_of=MONITORING_AS_OF)
    sinks.write_snapshot(batch, path)
    return spark.read.parquet(path)


def sql_text_query(spark, sf_dir):
    conditions = reports.scenario_conditions(b.staged_crop_yield(spark, sf_dir), MONITORING_AS_OF)
    query = "SELECT * EXCEPT (prediction_requested_at) FROM coming_season WHERE pesticide_intensity IS NOT NULL"
    return readers.load_from_query(spark, query, {"coming_season": conditions})


def flatten_weather_json(spark, sf_dir):
    """Each weather event becomes a landed document of two days and three hours."""
    def hour(shift):
        return F.struct(
            (F.unix_seconds(F.col("ts").cast("timestamp")) + shift).alias("datetimeEpoch"),
            F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("temp"),
            (F.col("value") % 100).alias("humidity"),
            (F.col("value") + shift).alias("solarradiation"),
            F.when(F.col("event_id") % 5 != 0, F.lit(950.0) + F.col("user_id")).alias("pressure"),
        )

    documents = b.events(spark, sf_dir).where(F.col("event_type").isin(b.WEATHER_EVENTS)).select(
        (F.col("user_id") % 5 + 40).cast("double").alias("latitude"),
        (-(F.col("user_id") % 3) - 120).cast("double").alias("longitude"),
        F.lit("UTC").alias("timezone"),
        F.array(
            F.struct(F.array(hour(0), hour(3600)).alias("hours")),
            F.struct(F.array(hour(86400)).alias("hours")),
        ).alias("days"),
    )
    path = work_path(spark, "weather-documents")
    documents.write.json(path)
    return readers.flatten_weather(readers.read_weather_documents(spark, path))


def flatten_soil_json(spark, sf_dir):
    surface = (F.col("user_id") % 4) * F.lit(0.5).cast("double") + 5
    records = b.events(spark, sf_dir).where(~F.col("event_type").isin(b.WEATHER_EVENTS)).select(
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("dt"),
        (F.col("value") + 273).alias("t10"),
        (F.col("value") + 274).alias("t0"),
        F.when(F.col("event_id") % 3 != 0, F.col("value") / 500).alias("moisture"),
        *[(surface + k / 10).alias(key) for k, key in enumerate(schemas.PH_DEPTHS)],
    )
    path = work_path(spark, "soil-records")
    records.write.json(path)
    return readers.flatten_soil(readers.read_soil_records(spark, path))


def _hourly_weather(spark, sf_dir) -> DataFrame:
    return b.staged_weather(spark, sf_dir).withColumn("timestamp", truncate("hour", "timestamp"))


def append_ignore_conflicts(spark, sf_dir):
    """Two overlapping batches land in one table keyed by place and hour."""
    path = work_path(spark, "weather")
    hourly = _hourly_weather(spark, sf_dir)
    sinks.append_ignore_conflicts(hourly.where(F.col("timestamp") < F.lit(GROWTH_CUTOFF).cast("timestamp_ntz")), path)
    sinks.append_ignore_conflicts(hourly, path)
    return spark.read.parquet(path)


def append_plain(spark, sf_dir):
    path = work_path(spark, "soil")
    soil = b.staged_soil(spark, sf_dir)
    cutoff = F.lit(GROWTH_CUTOFF).cast("timestamp_ntz")
    sinks.append_rows(soil.where(F.col("timestamp") < cutoff), path)
    sinks.append_rows(soil.where(F.col("timestamp") >= cutoff), path)
    return spark.read.parquet(path)


def incremental_batch(spark, sf_dir):
    """Copy a source, let it grow, copy again, then find nothing new."""
    target, state = work_path(spark, "weather-copy"), work_path(spark, "cursor")
    grown = b.staged_weather(spark, sf_dir)
    early = grown.where(F.col("timestamp") < F.lit(GROWTH_CUTOFF).cast("timestamp_ntz"))
    for source in (early, grown, grown):
        sinks.copy_increment(source, "weather", target, state)
    return sinks.read_copied(spark, target)


def incremental_cursor(spark, sf_dir):
    """Cursor table after copying the three sources."""
    state = work_path(spark, "cursor")
    predictions = b.predictions(spark, sf_dir).select("id", "area", "crop_type", "scenario", "predicted")
    for name, source in (
        ("weather", b.staged_weather(spark, sf_dir)),
        ("soil", b.staged_soil(spark, sf_dir)),
        ("predictions", predictions),
    ):
        sinks.copy_increment(source, name, work_path(spark, name), state)
    return spark.read.parquet(state)


def lowercase_columns(spark, sf_dir):
    predictions = b.predictions(spark, sf_dir)
    upper = predictions.select(
        *[F.col(c).alias(c.upper()) for c in ("area", "crop_type", "year", "scenario")], "predicted_yield_hg_ha"
    )
    return sinks.lower_case_columns(upper)


# --- staging, sensors --------------------------------------------------------

def _unified(spark, sf_dir) -> DataFrame:
    return reports.unified_readings(b.weather(spark, sf_dir), b.soil(spark, sf_dir))


def _daily(spark, sf_dir) -> DataFrame:
    return sensors.daily_conditions(_unified(spark, sf_dir))


def _monitoring(spark, sf_dir) -> DataFrame:
    return reports.monitoring(b.weather(spark, sf_dir), b.soil(spark, sf_dir), MONITORING_AS_OF)


def stg_weather(spark, sf_dir):
    return b.staged_weather(spark, sf_dir)


def stg_soil(spark, sf_dir):
    return b.staged_soil(spark, sf_dir)


def soil_daily_latest(spark, sf_dir):
    return sensors.soil_daily_latest(b.staged_soil(spark, sf_dir))


def sensor_unified(spark, sf_dir):
    return _unified(spark, sf_dir)


def daily_conditions(spark, sf_dir):
    return _daily(spark, sf_dir)


def daily_farm_summary(spark, sf_dir):
    return reports.farm_summary(b.weather(spark, sf_dir), b.soil(spark, sf_dir))


def rolling_7d_temp(spark, sf_dir):
    return sensors.rolling_7d_temp(_daily(spark, sf_dir))


def sensor_monitoring(spark, sf_dir):
    return _monitoring(spark, sf_dir)


def irrigation_recommendation(spark, sf_dir):
    return reports.irrigation(b.weather(spark, sf_dir), b.soil(spark, sf_dir), IRRIGATION_AS_OF)


def _in_range(spark, sf_dir) -> DataFrame:
    return reports.readings_in_range(b.weather(spark, sf_dir), b.soil(spark, sf_dir), *RANGE)


def sensor_range(spark, sf_dir):
    return _in_range(spark, sf_dir)


def latest_reading(spark, sf_dir):
    return sensors.latest_reading(_in_range(spark, sf_dir), "air_temp", "humidity", "soil_moisture", "ph_surface")


def active_alerts(spark, sf_dir):
    return sensors.active_alerts(_monitoring(spark, sf_dir))


def live_status(spark, sf_dir):
    return reports.live_status(
        b.weather(spark, sf_dir), b.soil(spark, sf_dir), "2024-01-25", "2024-01-30", MONITORING_AS_OF
    )


def trend_series(spark, sf_dir):
    return sensors.trend_series(_in_range(spark, sf_dir))


# --- crops -------------------------------------------------------------------

def _training(spark, sf_dir) -> DataFrame:
    return crops.ml_training_dataset(crops.crop_yield_features(b.staged_crop_yield(spark, sf_dir)))


def stg_crop_yield(spark, sf_dir):
    return b.staged_crop_yield(spark, sf_dir)


def crop_yield_features(spark, sf_dir):
    return crops.crop_yield_features(b.staged_crop_yield(spark, sf_dir))


def ml_training_dataset(spark, sf_dir):
    return _training(spark, sf_dir)


def base_scenarios(spark, sf_dir):
    return crops.base_scenarios(b.staged_crop_yield(spark, sf_dir))


def current_conditions(spark, sf_dir):
    return reports.scenario_conditions(b.staged_crop_yield(spark, sf_dir), MONITORING_AS_OF)


def crop_benchmarks(spark, sf_dir):
    # Read several times: store the seed instead of repeating its joins.
    seed = stored(b.staged_crop_yield(spark, sf_dir), "crop-yield")
    return rounded(crops.crop_benchmarks(seed), p25_yield=6, p75_yield=6, temp_stddev=4)


# --- data quality ------------------------------------------------------------

def _models(spark, sf_dir, names) -> dict[str, DataFrame]:
    return reports.farm_models(
        b.weather(spark, sf_dir), b.soil(spark, sf_dir), b.crop_yield(spark, sf_dir), MONITORING_AS_OF, names
    )


def dq_not_null(spark, sf_dir):
    tables = _models(spark, sf_dir, quality.NOT_NULL)
    return quality.combine([quality.not_null(tables[t], t, c) for t, c in quality.NOT_NULL.items()])


def dq_unique(spark, sf_dir):
    tables = _models(spark, sf_dir, quality.UNIQUE)
    return quality.combine([quality.unique(tables[t], t, [c]) for t, c in quality.UNIQUE.items()])


def dq_accepted_values(spark, sf_dir):
    tables = _models(spark, sf_dir, quality.ACCEPTED_VALUES)
    return quality.combine([
        quality.accepted_values(tables[t], t, values) for t, values in quality.ACCEPTED_VALUES.items()
    ])


def dq_relationships(spark, sf_dir):
    """The declared check, and one with orphans: orders of customers without a positive balance."""
    staged = stored(b.staged_crop_yield(spark, sf_dir), "crop-yield")
    training = crops.ml_training_dataset(crops.crop_yield_features(staged))
    solvent = b.table(spark, sf_dir, "customer").where("c_acctbal > 0")
    return quality.combine([
        quality.relationships(
            training, "fct_ml_training_dataset", "crop_type", crops.crop_benchmarks(staged), "crop_type", "warn"
        ),
        quality.relationships(
            b.table(spark, sf_dir, "orders"), "orders", "o_custkey", solvent, "c_custkey", "error"
        ),
    ])


def dq_composite_unique(spark, sf_dir):
    keys = ["latitude", "longitude", "timestamp"]
    return quality.combine([
        quality.unique(b.staged_weather(spark, sf_dir), "weather", keys),
        quality.unique(_hourly_weather(spark, sf_dir), "weather_hourly", keys),
    ])


def dq_recency(spark, sf_dir):
    daily = _daily(spark, sf_dir)
    return quality.combine([
        quality.recency(daily, "int_daily_conditions", "date", 7, MONITORING_AS_OF),
        quality.recency(daily, "int_daily_conditions", "date", 7, "2024-03-01 00:00:00", "error"),
        quality.recency(_monitoring(spark, sf_dir), "fct_sensor_monitoring", "reading_timestamp", 2, MONITORING_AS_OF),
    ])


def dq_equal_rowcount(spark, sf_dir):
    raw = b.crop_yield(spark, sf_dir)
    unified = _unified(spark, sf_dir)
    return quality.combine([
        quality.equal_rowcount(
            crops.crop_yield_features(staging.stg_crop_yield(raw)), "int_crop_yield_features", raw
        ),
        quality.equal_rowcount(unified, "int_sensor_readings_unified", sensors.daily_conditions(unified)),
    ])


def dq_expression(spark, sf_dir):
    return quality.combine([
        quality.expression_holds(_training(spark, sf_dir), "fct_ml_training_dataset", "target_yield > 0", "warn"),
        quality.expression_holds(
            _unified(spark, sf_dir), "int_sensor_readings_unified", "soil_moisture <= 100", "error"
        ),
    ])


def dq_faulty_rows(spark, sf_dir):
    """All kinds of checks on readings with missing, unknown, repeated and orphaned values."""
    event = F.col("event_id")
    readings = b.events(spark, sf_dir).select(
        event.alias("id"), F.when(event % 11 != 0, F.col("user_id")).alias("sensor"),
        F.when(event % 17 != 0, F.col("event_type")).alias("status"), F.when(event % 13 != 0, F.col("value")).alias("value"),
    )
    sensors_known = b.table(spark, sf_dir, "customer").where("c_acctbal > 0")
    return quality.check_table(readings, "readings", quality.TableChecks(
        ("id", "sensor", "status", "value"), {"status": ["view", "click", "purchase"]}, ("value >= 10", "value < 1000"),
        (("sensor",), ("id",)), {"sensor": (sensors_known, "c_custkey")}, {"expression": "warn"},
    ))


def dq_all_checks(spark, sf_dir):
    """Write all models, then run all declared tests on the written tables."""
    tables = reports.write_models(
        b.weather(spark, sf_dir), b.soil(spark, sf_dir), b.crop_yield(spark, sf_dir),
        work_path(spark, "models"), MONITORING_AS_OF,
    )
    return reports.check_models(tables)


# --- profile -----------------------------------------------------------------

def distinct_counts(spark, sf_dir):
    return profile.distinct_counts(_training(spark, sf_dir), ["area", "crop_type", "era"])


def distinct_values(spark, sf_dir):
    return profile.distinct_values(_training(spark, sf_dir), "crop_type")


def describe_numeric(spark, sf_dir):
    training = stored(_training(spark, sf_dir).select(*NUMERIC), "training", balanced=True)
    return rounded(profile.describe_numeric(training, NUMERIC), std=4, p25=6, p50=6, p75=6)


def null_profile(spark, sf_dir):
    daily = sensors.daily_farm_summary(_daily(spark, sf_dir))
    return profile.null_profile(daily)


def correlation_matrix(spark, sf_dir):
    return rounded(profile.correlation_matrix(_training(spark, sf_dir), CORRELATED), correlation=6)


def histogram_yield(spark, sf_dir):
    return rounded(profile.histogram(_training(spark, sf_dir), "target_yield", 30), bin_start=6)


def sample_rows(spark, sf_dir):
    keyed = b.predictions(spark, sf_dir).select(*PREDICTION_KEYS, "crop_type", "actual")
    return profile.sample_rows(keyed, 5, PREDICTION_KEYS)


def latest_n(spark, sf_dir):
    return profile.latest_n(b.staged_weather(spark, sf_dir), 10, "timestamp", "id")


def latest_soil(spark, sf_dir):
    return profile.latest_n(b.staged_soil(spark, sf_dir), 10, "timestamp", "id")


def latest_100_readings(spark, sf_dir):
    return profile.latest_n(
        _unified(spark, sf_dir), 100, "reading_timestamp", "latitude", "longitude", "pressure", "air_temp"
    )


# --- serving -----------------------------------------------------------------

def prediction_output(spark, sf_dir):
    return serving.prediction_output(b.predictions(spark, sf_dir), "predicted", as_of=MONITORING_AS_OF)


def scenario_summary(spark, sf_dir):
    return serving.scenario_summary(b.predictions(spark, sf_dir))


def prediction_summary(spark, sf_dir):
    return serving.prediction_summary(b.predictions(spark, sf_dir))


def _extreme(spark, sf_dir, largest):
    top = serving.extreme_predictions(b.predictions(spark, sf_dir), 5, largest, *PREDICTION_KEYS)
    return top.select(*PREDICTION_KEYS, "area", "crop_type", "scenario", "predicted_yield_kg_ha")


def top_predictions(spark, sf_dir):
    return _extreme(spark, sf_dir, True)


def bottom_predictions(spark, sf_dir):
    return _extreme(spark, sf_dir, False)


def predictions_by_crop(spark, sf_dir):
    return serving.predictions_by_crop(b.predictions(spark, sf_dir))


def forecast_kpis(spark, sf_dir):
    return serving.forecast_kpis(reports.crop_forecast(b.predictions(spark, sf_dir)))


def yield_by_crop_scenario(spark, sf_dir):
    return serving.yield_by_crop_scenario(b.predictions(spark, sf_dir))


def latest_predictions(spark, sf_dir):
    return reports.crop_forecast(b.predictions(spark, sf_dir))


# --- evaluation --------------------------------------------------------------

def _errors(spark, sf_dir) -> DataFrame:
    return evaluate.prediction_errors(b.predictions(spark, sf_dir))


def _stored_errors(spark, sf_dir, *columns) -> DataFrame:
    return stored(_errors(spark, sf_dir).select(*columns, "absolute_error", "percentage_error"), "errors")


def prediction_errors(spark, sf_dir):
    return _errors(spark, sf_dir).select(
        *PREDICTION_KEYS, "crop_type", "area", "year", "actual", "predicted",
        "error", "absolute_error", "percentage_error",
    )


def errors_by_crop(spark, sf_dir):
    return rounded(
        evaluate.errors_by(_stored_errors(spark, sf_dir, "crop_type"), "crop_type"),
        median_ape=6, median_ae=6,
    )


def errors_by_year(spark, sf_dir):
    return evaluate.mean_ape_by(_errors(spark, sf_dir), "year")


def error_distribution(spark, sf_dir):
    return rounded(
        evaluate.error_distribution(_stored_errors(spark, sf_dir)),
        median_ae=6, std_ae=4, median_ape=6, p75_ape=6, p95_ape=6,
    )


def error_thresholds(spark, sf_dir):
    # A percentage error of exactly 5 or 10 carries float noise; settle it before comparing.
    return evaluate.error_thresholds(rounded(_errors(spark, sf_dir), percentage_error=6))


def histogram_errors(spark, sf_dir):
    return rounded(
        profile.histogram(rounded(_errors(spark, sf_dir), error=4), "error", 50), bin_start=6
    )


def worst_errors(spark, sf_dir):
    worst = evaluate.worst_errors(_errors(spark, sf_dir), 5, *PREDICTION_KEYS)
    return worst.select(*PREDICTION_KEYS, "actual", "predicted", "error", "crop_type", "area")


def regression_metrics(spark, sf_dir):
    split = F.when(_bucket() == 0, "test").otherwise("train").alias("split")
    scored = stored(b.predictions(spark, sf_dir).select("actual", "predicted", split), "scored")
    return rounded(
        evaluate.regression_metrics(scored, ["split"]), rmse=4, r2=8, median_ape=6
    )


def model_comparison(spark, sf_dir):
    """Three predictors of the same rows: the discounted price, with tax added, and the middle of both."""
    discounted = F.col("predicted")
    taxed = F.col("predicted") * (F.col("tax") + 1)
    candidates = F.array(*[
        F.struct(F.lit(name).alias("model"), value.alias("value"))
        for name, value in (
            ("discounted", discounted), ("taxed", taxed), ("middle", (discounted + taxed) / 2),
        )
    ])
    long = stored(b.predictions(spark, sf_dir).select("actual", F.inline(candidates)), "scored")
    metrics = evaluate.regression_metrics(long, ["model"], predicted="value")
    return rounded(
        evaluate.model_comparison(metrics, "discounted"),
        r2=8, rmse=4, median_ape=6, r2_change_pct=4, rmse_change_pct=4, mae_change_pct=4,
    )


# --- labels, features, split -------------------------------------------------

def _bucket():
    return hash_bucket(5, *PREDICTION_KEYS)


def label_codes(spark, sf_dir):
    training = _training(spark, sf_dir)
    return quality.combine([labels.label_codes(training, c) for c in ("area", "crop_type", "era")])


def encode_labels(spark, sf_dir):
    predictions = b.predictions(spark, sf_dir).select(*PREDICTION_KEYS, "area", "crop_type")
    encoded = evaluate.encode_labels(predictions, labels.label_codes(predictions, "area"), "area")
    return evaluate.encode_labels(encoded, labels.label_codes(predictions, "crop_type"), "crop_type")


def decode_labels(spark, sf_dir):
    predictions = b.predictions(spark, sf_dir).select(*PREDICTION_KEYS, "crop_type")
    codes = labels.label_codes(predictions, "crop_type")
    coded = evaluate.encode_labels(predictions, codes, "crop_type").drop("crop_type")
    return evaluate.decode_labels(coded, codes, "crop_type_code", "crop_name")


def drop_leakage(spark, sf_dir):
    return crops.drop_leakage(_training(spark, sf_dir))


def feature_select(spark, sf_dir):
    from fieldspark.ml.features import FEATURES

    return _training(spark, sf_dir).select(*FEATURES)


def train_test_split(spark, sf_dir):
    from fieldspark.ml.features import with_split

    keyed = b.predictions(spark, sf_dir).select(*PREDICTION_KEYS, "crop_type", "actual")
    return with_split(keyed, PREDICTION_KEYS)


def split_counts(spark, sf_dir):
    from fieldspark.ml.features import split_counts as count_split, with_split

    return count_split(with_split(b.predictions(spark, sf_dir), PREDICTION_KEYS))


def standardize(spark, sf_dir):
    from fieldspark.ml.features import standardize as scale, with_split

    columns = ["actual", "predicted"]
    keyed = with_split(b.predictions(spark, sf_dir).select(*PREDICTION_KEYS, *columns), PREDICTION_KEYS)
    return rounded(scale(keyed, columns), actual_scaled=6, predicted_scaled=6)


SQL_QUERIES = [
    scan_weather, scan_soil, scan_crop_yield, csv_roundtrip, sql_text_query, flatten_weather_json,
    flatten_soil_json, parquet_roundtrip, append_ignore_conflicts, append_plain, incremental_batch,
    incremental_cursor, lowercase_columns,
    stg_weather, stg_soil, stg_crop_yield, crop_yield_features, ml_training_dataset, drop_leakage,
    feature_select, soil_daily_latest, sensor_unified, daily_conditions, daily_farm_summary,
    rolling_7d_temp, sensor_monitoring, irrigation_recommendation, sensor_range, latest_reading,
    active_alerts, live_status, trend_series, base_scenarios, current_conditions, crop_benchmarks,
    dq_not_null, dq_unique, dq_accepted_values, dq_relationships, dq_composite_unique, dq_recency,
    dq_equal_rowcount, dq_expression, dq_faulty_rows, dq_all_checks,
    distinct_counts, distinct_values, describe_numeric, null_profile, correlation_matrix,
    histogram_yield, latest_n, latest_soil, latest_100_readings, prediction_output, scenario_summary,
    prediction_summary, top_predictions, bottom_predictions, predictions_by_crop, forecast_kpis,
    yield_by_crop_scenario, latest_predictions, prediction_errors, errors_by_crop, errors_by_year,
    error_distribution, error_thresholds, histogram_errors, worst_errors, regression_metrics,
    model_comparison, label_codes, encode_labels, decode_labels, train_test_split, split_counts,
    standardize, sample_rows,
]


def registered() -> dict:
    """All registered queries by name."""
    from fieldspark.plans.job_queries import JOB_QUERIES
    from fieldspark.plans.learning_queries import LEARNING_QUERIES
    from fieldspark.plans.stream_queries import STREAM_QUERIES

    def bound(query):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            result = query(configure(spark), sf_dir)
            return result.withColumns({c: F.col(c).cast("float") for c in SINGLE_PRECISION.get(query.__name__, [])})

        run.__name__, run.__doc__ = query.__name__, query.__doc__
        return run

    everything = [*SQL_QUERIES, *STREAM_QUERIES, *LEARNING_QUERIES, *JOB_QUERIES]
    return {query.__name__: bound(query) for query in everything}
