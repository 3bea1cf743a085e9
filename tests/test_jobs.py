"""Landing, training and forecast jobs: once each, in order, with what does not fit put aside."""

import json
import os

import pytest
from pyspark.sql import functions as F

from fieldspark.ml import models
from fieldspark.operators import crops
from fieldspark.plans import bindings as b
from fieldspark.plans import jobs, reports
from fieldspark.session import work_path
from fieldspark.sources import landing, readers
from fieldspark.sources.schemas import SOIL, WEATHER

SMALL = models.ForestParams(trees=4, depth=5)
AS_OF = "2024-02-01 00:00:00"


def document(latitude, hours):
    return json.dumps({"latitude": latitude, "longitude": -120.5, "days": [{"hours": hours}], "ignored": 1})


def hour(epoch, temp=50.0, **more):
    return {"datetimeEpoch": epoch, "temp": temp, "humidity": 40.0, "solarradiation": 3.0, "pressure": 1000.0, **more}


def write_lines(spark, path, lines):
    spark.createDataFrame([(line,) for line in lines], "value string").repartition(2).write.text(str(path))
    return str(path)


def test_landing_numbers_rows_and_puts_the_rest_aside(spark, tmp_path):
    table, aside = str(tmp_path / "weather"), str(tmp_path / "aside")
    first = write_lines(spark, tmp_path / "d1", [
        document(40.0, [hour(7200), hour(3600, None), {"datetimeEpoch": 0}]),
        document(40.0, [hour(7200, 41.0), hour(None)]),
        document(41.0, [hour(3600, 5000.0, humidity=-1000.0)]),
        document(None, [hour(3600)]), document(400000.0, [hour(3600)]), '{"latitude": 40.0, "days": [', json.dumps({"latitude": 1.0}),
    ])
    for _ in range(2):
        landing.land_weather(spark, first, table, aside, "r1", AS_OF)
    rows = {r.id: r for r in readers.read_weather(spark, table).collect()}
    assert sorted(rows) == [1, 2, 3]
    # In order of time; the lower temperature of two readings of one hour; missing measures stay missing.
    assert [str(rows[k].temperature) for k in (1, 2, 3)] == ["None", "None", "5.00"]
    assert [rows[k].timestamp for k in (1, 2, 3)] == [0, 3600 * 10**9, 7200 * 10**9]
    assert readers.read_weather(spark, table).select(*WEATHER.names).schema.simpleString() == WEATHER.simpleString()
    reasons = sorted((r.reason, r.run_id) for r in landing.read_quarantine(spark, aside).collect())
    assert reasons == sorted((reason, "r1") for reason in (
        "NULL in timestamp", "temperature out of range, humidity out of range", "NULL in latitude", "latitude out of range", "corrupt document",
    ))
    kept = landing.read_quarantine(spark, aside).where("reason like 'temperature%'").first().record
    assert json.loads(kept)["humidity"] == -1000.0

    second = write_lines(spark, tmp_path / "d2", [document(40.0, [hour(7200, 20.0), hour(10800)]), document(39.0, [hour(10800)])])
    for _ in range(2):
        landing.land_weather(spark, second, table, aside, "r2", AS_OF)
    new = readers.read_weather(spark, table).where("run_id = 'r2'").orderBy("id").collect()
    assert [(r.id, str(r.latitude)) for r in new] == [(4, "39.00000"), (5, "40.00000")]
    assert readers.read_weather(spark, table).count() == 5


def test_landing_of_nothing(spark, tmp_path):
    path = write_lines(spark, tmp_path / "none", [])
    landing.land_weather(spark, path, str(tmp_path / "w"), str(tmp_path / "aside"), "r", AS_OF)
    landing.land_soil(spark, path, str(tmp_path / "s"), str(tmp_path / "aside"), "r", AS_OF)
    assert readers.read_weather(spark, str(tmp_path / "w")).count() == 0
    assert readers.read_soil(spark, str(tmp_path / "s")).count() == 0
    assert landing.read_quarantine(spark, str(tmp_path / "aside")).count() == 0


def test_equal_soil_records_are_rows_of_their_own(spark, tmp_path):
    record = json.dumps({"dt": 5, "t0": 280.5, "t10": 281.0, "moisture": 0.2, "0-5cm": 6.5})
    path = write_lines(spark, tmp_path / "d", [record, record, "{"])
    landing.land_soil(spark, path, str(tmp_path / "s"), str(tmp_path / "aside"), "r", AS_OF, normalize_units=True)
    rows = readers.read_soil(spark, str(tmp_path / "s"), SOIL).collect()
    assert sorted(r.id for r in rows) == [1, 2] and {(str(r.t_0_cm), str(r.moisture), str(r.ph_0_5cm)) for r in rows} == {("7.35", "20.00", "6.50")}


def test_serial_ids_follow_the_order_over_partitions(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k")).repartition(7)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        found = landing.serial_ids(rows, ["k"], 100).orderBy("k").collect()
    finally:
        spark.conf.set(coalesce, "true")
    assert [(r.k, r.id) for r in found] == [(k, k + 101) for k in range(5000)]


@pytest.fixture(scope="module")
def trained(spark, sf_dir, tmp_path_factory):
    store = jobs.ModelStore(str(tmp_path_factory.mktemp("models")))
    training = crops.ml_training_dataset(crops.crop_yield_features(b.staged_crop_yield(spark, sf_dir)))
    return store, training, jobs.train_yield_model(training, store, "v1", SMALL, as_of=AS_OF).first()


def test_training_job_logs_its_run(spark, trained):
    store, training, run = trained
    assert run.total_rows == training.count() == run.train_size + run.test_size
    assert run.param_trees == 4 and run.test_rmse > 0 and run.model_name == jobs.MODEL_NAME and run.version == "v1"
    jobs.train_yield_model(training, store, "v1", SMALL, as_of=AS_OF)
    assert spark.read.parquet(store.runs).count() == 1
    version, model = models.load_production(spark, store.registry, jobs.MODEL_NAME)
    assert version == "v1" and jobs.score_differences(training, store, "v1", model).count() == 0


def test_production_moves_and_moves_back(spark, trained):
    store, training, _ = trained
    jobs.train_yield_model(training, store, "v2", SMALL, stage="None")
    name = jobs.MODEL_NAME
    assert models.load_production(spark, store.registry, name)[0] == "v1"
    models.set_stage(spark, store.registry, name, "v2", "Production")
    assert models.load_production(spark, store.registry, name)[0] == "v2"
    assert {r["version"]: r["stage"] for r in models.current_versions(spark, store.registry, name)} == {"v1": "Archived", "v2": "Production"}
    models.set_stage(spark, store.registry, name, "v1", "Production")
    assert models.load_production(spark, store.registry, name)[0] == "v1"
    with pytest.raises(LookupError):
        models.set_stage(spark, store.registry, name, "v9", "Production")


def test_repeated_forecast_adds_nothing(spark, sf_dir, trained, tmp_path):
    store, _, _ = trained
    tables = jobs.ForecastTables(str(tmp_path))
    conditions = reports.scenario_conditions(b.staged_crop_yield(spark, sf_dir), AS_OF)
    n = conditions.count()
    for run, cursor in (("a", n), ("a", n), ("b", 2 * n)):
        done = jobs.forecast_season(conditions, store, tables, run, AS_OF)
        assert done.cursor == cursor and done.predictions.count() == n
    assert jobs.read_copied(spark, tables.copied).count() == 2 * n
    assert done.summary.first().n_predictions == n and done.by_scenario.count() == 4
    best, worst = done.best.collect(), done.worst.collect()
    assert len(best) == len(worst) == 5 and best[0].predicted_yield_kg_ha >= worst[0].predicted_yield_kg_ha
    everything = landing.read_runs(spark, tables.predictions, jobs.CROP_YIELD_PREDICTIONS)
    assert everything.select("id").distinct().count() == 2 * n
    assert everything.where("id > {}".format(n)).select("run_id").distinct().collect() == [("b",)]


def test_training_leaves_nothing_but_its_model_behind(spark, sf_dir, tmp_path):
    training = crops.ml_training_dataset(crops.crop_yield_features(b.staged_crop_yield(spark, sf_dir)))
    folder = os.path.dirname(work_path(spark, "any"))
    before = set(os.listdir(folder))
    store = jobs.ModelStore(str(tmp_path / "store"))
    run = jobs.train_yield_model(training, store, "v1", SMALL, as_of=AS_OF).first()
    assert run.total_rows == 6000 and run.test_rmse > 0
    assert not [name for name in set(os.listdir(folder)) - before if name.startswith(("training", "scored", "forest"))]
    assert jobs.models.load_production(spark, store.registry, jobs.MODEL_NAME)[1].stages[-1].nodes.count() > 4
