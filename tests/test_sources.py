"""Readers and writers, repeats and failures included."""

import json
from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldspark.operators import serving
from fieldspark.sources import readers, schemas, sinks

WEATHER = "id long, latitude double, longitude double, timestamp timestamp_ntz, temperature double"


def test_weather_document_flattens_to_hours(spark, tmp_path):
    noon = {"datetimeEpoch": 1_600_000_200, "temp": 50.0, "humidity": 41.5, "solarradiation": 7.25, "pressure": 990.5, "more": [1]}
    bare = {"datetimeEpoch": 1_600_003_800, "humidity": 43.0, "solarradiation": None}
    document = {"latitude": 11.5, "longitude": 22.5, "days": [{"hours": [noon, bare]}, {"hours": [noon]}, {"hours": []}]}
    path = tmp_path / "document.json"
    path.write_text(json.dumps(document))
    rows = readers.flatten_weather(readers.read_weather_documents(spark, str(path))).collect()
    first, second = dt(2020, 9, 13, 12, 30), dt(2020, 9, 13, 13, 30)
    assert sorted(tuple(r) for r in rows if r.temperature) == [(11.5, 22.5, first, 10.0, 41.5, 7.25, 990.5)] * 2
    assert [tuple(r) for r in rows if not r.temperature] == [(11.5, 22.5, second, None, 43.0, None, None)]


def test_soil_record(spark, tmp_path):
    record = {"dt": 1_600_041_600, "t0": 283.15, "t10": 280.5, "moisture": 0.25}
    record |= dict(zip(schemas.PH_DEPTHS, (6.75, 4.5, 5.25, 7.0, 6.0, 8.25), strict=True))
    path = tmp_path / "soil.json"
    path.write_text(json.dumps(record))
    records = readers.read_soil_records(spark, str(path))
    row = readers.flatten_soil(records).first()
    assert (row.timestamp, row.t_0_cm, row.t_10_cm, row.moisture) == (dt(2020, 9, 14), 283.15, 280.5, 0.25)
    assert (row.ph_0_5cm, row.ph_5_15cm, row.ph_100_200cm) == (6.75, 4.5, 8.25)
    normal = readers.flatten_soil(records, normalize_units=True).first()
    assert normal.t_0_cm == pytest.approx(10.0) and normal.moisture == pytest.approx(25.0)


def test_corrupt_and_spread_out_documents(spark, tmp_path):
    folder = tmp_path / "landed"
    folder.mkdir()
    (folder / "good.json").write_text(json.dumps({"dt": 1_600_041_600, "t0": 283.15}, indent=2))
    (folder / "bad.json").write_text('{"dt": 16')
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        readers.read_soil_records(spark, str(folder), multi_line=True).collect()
    kept = readers.read_soil_records(spark, str(folder), multi_line=True, corrupt="broken").cache()
    assert {(r.t0, r.broken) for r in kept.collect()} == {(283.15, None), (None, '{"dt": 16')}


def test_null_keys_are_refused(spark, tmp_path):
    rows = spark.createDataFrame([(1, None, 2.0, dt(2025, 1, 1), 3.0)], WEATHER)
    with pytest.raises(ValueError, match="NULL"):
        sinks.append_ignore_conflicts(rows, str(tmp_path / "table"))


def weather(spark, rows):
    return spark.createDataFrame([(i, 1.0, 2.0, dt(2025, 1, 1, h), t) for i, h, t in rows], WEATHER)


def test_conflicting_rows_are_skipped_within_and_across_batches(spark, tmp_path):
    path = str(tmp_path / "weather")
    sinks.append_ignore_conflicts(weather(spark, [(1, 0, 10.0), (2, 0, 11.0), (3, 1, 12.0)]), path)
    batch = weather(spark, [(9, 1, 90.0), (8, 2, 80.0), (7, 2, 70.0), *[(100 + i, 3, 1.0) for i in range(50)]])
    for _ in range(2):
        sinks.append_ignore_conflicts(batch.repartition(4), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 3, 7, 100]


def test_increments_arrive_once_and_failed_runs_are_repeated(spark, tmp_path, monkeypatch):
    target, state = str(tmp_path / "copy"), str(tmp_path / "state")
    assert sinks.read_cursor(spark, state, "weather") == sinks.NOTHING_COPIED
    assert sinks.copy_increment(weather(spark, [(0, 0, 1.0), (1, 1, 1.0)]), "weather", target, state) == 1
    assert sinks.copy_increment(weather(spark, [(0, 0, 1.0), (1, 1, 1.0)]), "weather", target, state) == 1

    grown = weather(spark, [(0, 0, 1.0), (1, 1, 1.0), (2, 2, 1.0), (5, 3, 1.0)])
    with monkeypatch.context() as broken:
        broken.setattr(sinks, "append_rows", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            sinks.copy_increment(grown, "weather", target, state)
    assert sinks.read_cursor(spark, state, "weather") == 1
    assert sinks.copy_increment(grown, "weather", target, state) == 5
    assert sorted(r.id for r in sinks.read_copied(spark, target).collect()) == [0, 1, 2, 5]
    assert sinks.read_cursor(spark, state, "soil") == sinks.NOTHING_COPIED


def test_snapshots_lie_below_their_date(spark, tmp_path):
    path = str(tmp_path / "predictions")
    for day in (1, 2):
        batch = spark.range(3).withColumn("prediction_date", F.lit(dt(2025, 1, day, 6)).cast("timestamp_ntz"))
        sinks.write_snapshot(batch, path)
    newest = serving.latest_predictions(spark.read.parquet(path))
    assert newest.count() == 3
    # The folder of the newest date is picked by a partition filter.
    assert "PartitionFilters: [isnotnull(snapshot_date" in newest._jdf.queryExecution().toString()


def test_models_are_published_as_view_or_table(spark):
    df = spark.range(3)
    assert sinks.materialise(df, "numbers_view").count() == 3
    assert sinks.materialise(df, "numbers_table", "table").count() == 3
    assert readers.load_from_query(spark, "SELECT count(*) AS n FROM numbers", {"numbers": df}).first().n == 3
    with pytest.raises(ValueError):
        sinks.materialise(df, "x", "cube")


def test_declared_types_reject_values_out_of_range(spark):
    raw = spark.createDataFrame([(1234.5,)], "temperature double")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        raw.select(F.col("temperature").cast(schemas.MEASURE)).collect()


def test_raw_tables_keep_their_declared_schema(spark, tmp_path):
    for name, schema, read in (("w", schemas.WEATHER, readers.read_weather), ("s", schemas.SOIL, readers.read_soil)):
        path = str(tmp_path / name)
        spark.createDataFrame([], schema).write.parquet(path)
        assert [f.dataType for f in read(spark, path).schema] == [f.dataType for f in schema]
