"""Distributed percentiles against Spark's own exact aggregate."""

import random

import pytest
from pyspark.sql import functions as F

from fieldspark.operators.percentiles import exact_percentiles


def make(spark, rows):
    return spark.createDataFrame(rows, "k string, a double, b double").repartition(4)


def expected(df):
    rows = df.groupBy("k").agg(
        F.percentile("a", 0.25).alias("a25"), F.percentile("a", 0.95).alias("a95"), F.percentile("b", 0.5).alias("b50")
    )
    return {r.k: (r.a25, r.a95, r.b50) for r in rows.collect()}


def actual(df, **kwargs):
    rows = exact_percentiles(df, ["k"], {"a25": ("a", 0.25), "a95": ("a", 0.95), "b50": ("b", 0.5)}, **kwargs)
    return {r.k: (r.a25, r.a95, r.b50) for r in rows.collect()}


def check(df, **kwargs):
    want, got = expected(df), actual(df, **kwargs)
    assert got.keys() == want.keys()
    for key, values in want.items():
        assert got[key] == pytest.approx(values, rel=1e-12, nan_ok=False), key


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(1)
    rows = [("hot", rng.lognormvariate(0, 3), rng.choice([1.0, 2.0, 5.0])) for _ in range(6000)]
    rows += [("same", 7.0, -3.0)] * 500
    rows += [("few", float(i), None) for i in (3, 1, 2)] + [("few", None, 4.0)]
    rows += [(None, float(i % 97), float(-i)) for i in range(800)]
    rows += [("one", 5.5, 6.5)]
    return make(spark, rows).cache()


def test_equals_spark_percentile(mixed):
    check(mixed)


def test_a_coarse_sketch_stays_exact(mixed):
    check(mixed, accuracy=5)


def test_large_intervals_are_narrowed_again(mixed):
    check(mixed, accuracy=50, task_values=5)


def test_group_without_values_has_no_row(spark):
    df = spark.createDataFrame([("x", None), ("y", 1.0)], "k string, a double")
    assert exact_percentiles(df, ["k"], {"m": ("a", 0.5)}).collect() == [("y", 1.0)]


def test_without_keys(spark):
    df = spark.range(11).select(F.col("id").cast("double").alias("v"))
    assert exact_percentiles(df, [], {"m": ("v", 0.5), "q": ("v", 0.25)}).collect() == [(5.0, 2.5)]
