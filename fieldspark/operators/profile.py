"""Exploratory profile of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.operators.percentiles import exact_percentiles


def distinct_counts(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """Row count and number of distinct non-NULL values per column, in one row."""
    count = F.approx_count_distinct if approximate else F.countDistinct
    return df.agg(F.count("*").alias("row_count"), *[count(c).alias(f"n_{c}") for c in columns])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values, NULL included."""
    return df.select(column).distinct()


def describe_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max; one row per column."""
    stats = {}
    for c in columns:
        stats |= {
            f"{c}@n": F.count(c), f"{c}@mean": F.avg(c), f"{c}@std": F.stddev_samp(c),
            f"{c}@min": F.min(c).cast("double"), f"{c}@max": F.max(c).cast("double"),
        }
    quartiles = {f"{c}@{q}": (c, p) for c in columns for q, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))}
    figures = ("n", "mean", "std", "min", "p25", "p50", "p75", "max")
    return exact_percentiles(df, [], quartiles, stats=stats).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"`{c}@{figure}`").alias(figure) for figure in figures]) for c in columns
    ])))


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULL count and flag per column from one pass."""
    columns = columns or df.columns
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count"), (F.col(c) > 0).alias("has_nulls"))
        for c in columns
    ])))


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every ordered pair of columns, from one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    coefficients = df.agg(*[F.corr(a, b).alias(f"{a}~{b}") for a, b in pairs])

    def coefficient(a: str, b: str):
        low, high = sorted((a, b), key=columns.index)
        return F.col(f"`{low}~{high}`")

    return coefficients.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), coefficient(a, b).alias("correlation"))
        for a in columns for b in columns
    ])))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """All ``bins`` equal-width bins between minimum and maximum, empty ones with 0; the last is closed.

    NULL and NaN are left out. A constant column gets a range of one around its value, and a column
    without values no bins.
    """
    value = F.col(column).cast("double")
    values = df.select(value.alias("x")).where("x is not null and not isnan(x)")
    bounds = values.agg(F.min("x").alias("least"), F.max("x").alias("most"))
    margin = F.when(F.col("least") == F.col("most"), 0.5).otherwise(0.0)
    low, width = F.col("least") - margin, (F.col("most") - F.col("least") + margin * 2) / bins
    edges = bounds.where("least is not null").select(low.alias("low"), width.alias("width"))
    edge = edges.select(F.struct("low", "width").alias("edge")).scalar()
    bin_index = F.least(F.floor((F.col("x") - edge.getField("low")) / edge.getField("width")).cast("int"), F.lit(bins - 1))
    counted = values.groupBy(bin_index.alias("bin")).agg(F.count("*").alias("n"))
    every = edges.select("low", "width", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return every.join(counted, "bin", "left").select(
        "bin", (F.col("low") + F.col("bin") * F.col("width")).alias("bin_start"), F.coalesce("n", F.lit(0)).alias("n")
    )


def sample_rows(df: DataFrame, n: int, keys: list[str], seed: int = 42) -> DataFrame:
    """``n`` random rows, the same ones for the same keys and seed however the rows are spread.

    Rows that share their keys follow each other by all columns.
    """
    turn = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))).cast("binary"))
    return df.orderBy(turn, *df.columns).limit(n)


def latest_n(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The ``n`` rows that come first when every ``order`` column descends."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)
