"""Data-quality checks: each yields rows (table, check, column, severity, violations, status)."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.functions.columns import moment

# The declared column tests.
NOT_NULL = {
    "stg_weather": ["id", "latitude", "longitude", "timestamp", "temperature", "humidity", "created_at"],
    "stg_soil": ["id", "timestamp", "t_0_cm", "t_10_cm", "moisture", "ph_0_5cm", "created_at"],
    "stg_crop_yield": ["area", "item", "year", "hg_ha_yield", "average_rainfall_mm_per_year"],
    "int_sensor_readings_unified": [
        "reading_timestamp", "latitude", "longitude", "air_temp", "humidity",
        "soil_temp_surface", "soil_temp_10cm", "soil_moisture", "ph_surface",
    ],
    "int_daily_conditions": ["date", "avg_daily_temp", "min_daily_temp", "max_daily_temp", "reading_count"],
    "int_crop_yield_features": ["area", "item", "year", "hg_ha_yield", "average_rainfall_mm_per_year"],
    "fct_ml_training_dataset": ["target_yield", "area", "crop_type", "year", "average_rainfall_mm_per_year"],
    "fct_current_conditions": ["area", "crop_type", "year", "scenario", "avg_temp", "prediction_requested_at"],
    "fct_sensor_monitoring": [
        "reading_timestamp", "air_temp", "humidity", "soil_moisture", "ph_surface",
        "temp_flag", "moisture_flag", "irrigation_alert",
    ],
    "dim_crop_benchmarks": ["crop_type", "avg_yield", "sample_size"],
    "rpt_daily_farm_summary": ["date", "reading_count"],
    "rpt_irrigation_recommendations": [
        "recommendation_date", "current_moisture", "recommendation", "estimated_water_mm",
    ],
}
UNIQUE = {
    "int_daily_conditions": "date",
    "rpt_daily_farm_summary": "date",
    "dim_crop_benchmarks": "crop_type",
}
ACCEPTED_VALUES = {
    "int_crop_yield_features": {"temp_category": ["cold", "optimal", "hot"]},
    "fct_ml_training_dataset": {"era": ["modern", "historical"]},
    "fct_sensor_monitoring": {
        "temp_flag": ["OK", "ANOMALY"],
        "moisture_flag": ["OK", "ANOMALY"],
        "irrigation_alert": ["LOW_MOISTURE_ALERT", "HIGH_MOISTURE_ALERT", "NORMAL"],
    },
    "rpt_daily_farm_summary": {"sensor_status": ["HEALTHY", "WARNING"]},
    "rpt_irrigation_recommendations": {
        "recommendation": ["IRRIGATE_NOW", "IRRIGATE_SOON", "SKIP_IRRIGATION", "MONITOR"],
    },
}


class QualityError(ValueError):
    """At least one check of severity "error" failed."""


def _result(table: str, check: str, column, severity: str, violations):
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        (F.lit(column) if isinstance(column, str) else column).alias("column_name"),
        F.lit(severity).alias("severity"),
        violations.cast("long").alias("violations"),
        F.when(violations > 0, "fail" if severity == "error" else "warn").otherwise("pass").alias("status"),
    )


def _column_checks(df: DataFrame, table: str, check: str, violations: dict, severity: str) -> DataFrame:
    """All checks of one kind on one table share a single aggregate."""
    counts = df.agg(*[F.count_if(rule).alias(column) for column, rule in violations.items()])
    return counts.select(F.inline(F.array(*[
        _result(table, check, column, severity, F.col(column)) for column in violations
    ])))


def not_null(df: DataFrame, table: str, columns: list[str], severity: str = "error") -> DataFrame:
    return _column_checks(df, table, "not_null", {c: F.col(c).isNull() for c in columns}, severity)


def accepted_values(df: DataFrame, table: str, values: dict[str, list[str]], severity: str = "error") -> DataFrame:
    """NULL passes, as in SQL's ``NOT IN``."""
    rules = {c: ~F.col(c).isin(allowed) for c, allowed in values.items()}
    return _column_checks(df, table, "accepted_values", rules, severity)


def expression_holds(df: DataFrame, table: str, expression: str, severity: str = "error") -> DataFrame:
    """Rows for which a SQL predicate is false."""
    counts = df.agg(F.count_if(~F.expr(expression)).alias("n"))
    return counts.select(_result(table, "expression", expression, severity, F.col("n")).alias("r")).select("r.*")


def unique(df: DataFrame, table: str, columns: list[str], severity: str = "error") -> DataFrame:
    """Number of key values (NULL keys apart) that occur more than once."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    repeated = df.where(present).groupBy(*columns).agg(F.count("*").alias("_rows")).where("_rows > 1")
    counts = repeated.agg(F.count("*").alias("n"))
    return counts.select(_result(table, "unique", ",".join(columns), severity, F.col("n")).alias("r")).select("r.*")


def relationships(
    child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str, severity: str = "error"
) -> DataFrame:
    """Child rows whose non-NULL value has no parent.

    Child values are counted first, so a frequent value reaches the join as one row.
    """
    values = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_rows"))
    keys = parent.select(F.col(parent_column).alias("_parent"))
    orphans = values.join(keys, F.col(column) == F.col("_parent"), "left_anti")
    counts = orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("n"))
    return counts.select(_result(table, "relationships", column, severity, F.col("n")).alias("r")).select("r.*")


@dataclass(frozen=True)
class TableChecks:
    """The checks of one table, to be run together.

    ``accepted`` maps columns to their values, ``expressions`` are SQL predicates, ``unique`` are lists of key
    columns, ``parents`` map a column to (table, column of the values it may hold).
    """

    not_null: tuple[str, ...] = ()
    accepted: dict[str, list[str]] = field(default_factory=dict)
    expressions: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    parents: dict[str, tuple[DataFrame, str]] = field(default_factory=dict)
    severity: dict[str, str] = field(default_factory=dict)

    def grade(self, check: str) -> str:
        return self.severity.get(check, "error")


def check_table(df: DataFrame, table: str, checks: TableChecks) -> DataFrame:
    """All checks of a table from one scan of it.

    Row checks are counters of one aggregate. A key that must be unique or have a parent groups that aggregate: its
    counters are summed per key first, and the keys counted beside them. Only checks on a second key
    need a scan of their own.
    """
    rules = [("not_null", c, F.col(c).isNull()) for c in checks.not_null]
    rules += [("accepted_values", c, ~F.col(c).isin(values)) for c, values in checks.accepted.items()]
    rules += [("expression", e, ~F.expr(e)) for e in checks.expressions]
    keys = [*checks.unique, *[(c,) for c in checks.parents]]
    counters = [F.count_if(rule).alias(f"_rule{i}") for i, (_, _, rule) in enumerate(rules)]
    results = [(check, column, F.col(f"_rule{i}")) for i, (check, column, _) in enumerate(rules)]
    others = []
    if keys:
        key = keys[0]
        counts = df.groupBy(*key).agg(F.count("*").alias("_rows"), *counters)
        sums = [F.coalesce(F.sum(f"_rule{i}"), F.lit(0)).alias(f"_rule{i}") for i in range(len(rules))]
        if key in checks.unique:
            present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
            sums.append(F.count_if(present & (F.col("_rows") > 1)).alias("_repeated"))
            results.append(("unique", ",".join(key), F.col("_repeated")))
        if len(key) == 1 and key[0] in checks.parents:
            parent, column = checks.parents[key[0]]
            known = parent.select(F.col(column).alias("_parent")).where("_parent is not null").distinct().withColumn("_known", F.lit(True))
            counts = counts.join(known, F.col(key[0]) == F.col("_parent"), "left")
            orphan = F.col(key[0]).isNotNull() & F.col("_known").isNull()
            sums.append(F.coalesce(F.sum(F.when(orphan, F.col("_rows"))), F.lit(0)).alias("_orphans"))
            results.append(("relationships", key[0], F.col("_orphans")))
        totals = counts.agg(*sums)
        others += [unique(df, table, list(k), checks.grade("unique")) for k in checks.unique if k != key]
        others += [
            relationships(df, table, c, parent, column, checks.grade("relationships"))
            for c, (parent, column) in checks.parents.items() if (c,) != key
        ]
    else:
        totals = df.agg(*counters)
    together = totals.select(F.inline(F.array(*[
        _result(table, check, column, checks.grade(check), count) for check, column, count in results
    ])))
    return combine([together, *others])


def recency(df: DataFrame, table: str, column: str, days: int, as_of=None, severity: str = "warn") -> DataFrame:
    """Violated when the newest value is older than ``days``, or there is none."""
    oldest = moment(as_of) - F.make_dt_interval(F.lit(days))
    stale = F.when(F.max(column) >= oldest, 0).otherwise(1)
    counts = df.agg(stale.alias("n"))
    return counts.select(_result(table, "recency", column, severity, F.col("n")).alias("r")).select("r.*")


def equal_rowcount(left: DataFrame, table: str, right: DataFrame, severity: str = "warn") -> DataFrame:
    """Difference between two row counts."""
    other = right.agg(F.count("*").alias("n")).scalar()
    counts = left.agg(F.count("*").alias("n")).select(F.abs(F.col("n") - other).alias("n"))
    return counts.select(_result(table, "equal_rowcount", "*", severity, F.col("n")).alias("r")).select("r.*")


def combine(results: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def run_declared_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Every declared test over the given tables (pass written tables: each is read once)."""
    results = []
    for table, df in tables.items():
        parents = {}
        if table == "fct_ml_training_dataset" and "dim_crop_benchmarks" in tables:
            parents = {"crop_type": (tables["dim_crop_benchmarks"], "crop_type")}
        checks = TableChecks(
            tuple(NOT_NULL.get(table, ())), ACCEPTED_VALUES.get(table, {}), (),
            ((UNIQUE[table],),) if table in UNIQUE else (), parents, {"relationships": "warn"},
        )
        if checks.not_null or checks.accepted or checks.unique or checks.parents:
            results.append(check_table(df, table, checks))
    return combine(results)


def raise_on_error(results: DataFrame) -> DataFrame:
    """Raise when an error-level check failed, naming all of them; warnings pass through.

    There is one row per declared check, whatever the size of the tables.
    """
    failed = results.where("status = 'fail'").select("table_name", "check_name", "column_name").collect()
    if failed:
        raise QualityError("; ".join(".".join(row) for row in failed))
    return results
