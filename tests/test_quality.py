"""Data-quality checks: violations, severities, and the checks over written models."""

import pytest
from pyspark.sql import functions as F

from fieldspark.operators import quality


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].violations, rows[0].status


@pytest.fixture(scope="module")
def child(spark):
    rows = [("a", 1), ("a", 1), ("b", 2), (None, None), ("zz", None)]
    return spark.createDataFrame(rows, "k string, v int")


def test_not_null_counts_per_column(child):
    rows = {r.column_name: (r.violations, r.status) for r in quality.not_null(child, "t", ["k", "v"]).collect()}
    assert rows == {"k": (1, "fail"), "v": (2, "fail")}


def test_unique_ignores_nulls(child):
    assert one(quality.unique(child, "t", ["v"])) == (1, "fail")
    assert one(quality.unique(child.distinct(), "t", ["v"])) == (0, "pass")
    assert one(quality.unique(child, "t", ["k", "v"], "warn")) == (1, "warn")


def test_accepted_values_let_null_pass(child):
    assert one(quality.accepted_values(child, "t", {"k": ["a", "b"]})) == (1, "fail")


def test_relationships_count_rows_and_skip_null(spark, child):
    parent = spark.createDataFrame([("b",), ("c",)], "p string")
    assert one(quality.relationships(child, "t", "k", parent, "p", "warn")) == (3, "warn")
    assert one(quality.relationships(child.where("k = 'b'"), "t", "k", parent, "p")) == (0, "pass")


def test_recency(spark):
    days = spark.sql("SELECT timestamp_ntz'2025-01-10 00:00:00' AS d")
    assert one(quality.recency(days, "t", "d", 7, "2025-01-17 00:00:00")) == (0, "pass")
    assert one(quality.recency(days, "t", "d", 7, "2025-01-17 00:00:01")) == (1, "warn")
    assert one(quality.recency(days.where("false"), "t", "d", 7, "2025-01-17 00:00:00", "error")) == (1, "fail")


def test_row_counts_and_expressions(child):
    assert one(quality.equal_rowcount(child, "t", child)) == (0, "pass")
    assert one(quality.equal_rowcount(child, "t", child.limit(2))) == (3, "warn")
    assert one(quality.expression_holds(child, "t", "v > 1")) == (2, "fail")


def test_only_errors_raise(child):
    warned = quality.not_null(child, "t", ["k"], "warn")
    assert quality.raise_on_error(warned) is warned
    with pytest.raises(quality.QualityError, match="t.not_null.k"):
        quality.raise_on_error(quality.not_null(child, "t", ["k"]))


def test_all_declared_checks_are_run(spark, sf_dir):
    from fieldspark.plans.queries import dq_all_checks

    results = dq_all_checks(spark, sf_dir)
    counts = {r.check_name: r["count"] for r in results.groupBy("check_name").count().collect()}
    assert counts == {"not_null": 66, "unique": 3, "accepted_values": 7, "relationships": 1}
    assert results.where(F.col("status") == "fail").count() == 0


def test_a_tables_checks_run_together(spark):
    rows = [(1, "a", 5.0), (1, "b", None), (2, None, -1.0), (None, "c", 7.0), (None, "a", 8.0), (3, "a", 9.0)]
    df = spark.createDataFrame(rows, "k int, s string, x double")
    parents = spark.createDataFrame([(1,), (3,), (3,), (None,)], "id int")
    checks = quality.TableChecks(
        ("k", "s", "x"), {"s": ["a", "b"]}, ("x > 0",), (("k",), ("k", "s")), {"k": (parents, "id")}, {"expression": "warn"},
    )
    result = quality.check_table(df, "t", checks)
    found = {(r.check_name, r.column_name): (r.violations, r.status) for r in result.collect()}
    assert found == {
        ("not_null", "k"): (2, "fail"), ("not_null", "s"): (1, "fail"), ("not_null", "x"): (1, "fail"),
        ("accepted_values", "s"): (1, "fail"), ("expression", "x > 0"): (1, "warn"), ("unique", "k"): (1, "fail"),
        ("unique", "k,s"): (0, "pass"), ("relationships", "k"): (1, "fail"),
    }
    none = {(r.check_name, r.column_name): r.violations for r in quality.check_table(df.limit(0), "t", checks).collect()}
    assert set(none) == set(found) and set(none.values()) == {0}


def test_declared_checks_read_each_table_once(spark, tmp_path):
    path = str(tmp_path / "daily")
    spark.sql("select date'2024-01-01' as date, 1.0 as avg_daily_temp, 0.0 as min_daily_temp, 2.0 as max_daily_temp, 3L as reading_count").write.parquet(path)
    checks = quality.run_declared_checks({"int_daily_conditions": spark.read.parquet(path)})
    plan = checks._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert {r.check_name for r in checks.collect()} == {"not_null", "unique"}
