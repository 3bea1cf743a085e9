"""Error analysis of predictions and model comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.operators.joins import broadcast_within
from fieldspark.operators.percentiles import exact_percentiles

THRESHOLDS = (5, 10, 20)


def prediction_errors(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Signed, absolute and absolute percentage error; a zero actual gives a NULL percentage."""
    error = F.col(actual) - F.col(predicted)
    return df.withColumns({
        "error": error,
        "absolute_error": F.abs(error),
        "percentage_error": F.abs(F.try_divide(error, F.col(actual))) * 100,
    })


def errors_by(errors: DataFrame, key: str) -> DataFrame:
    """Mean and median error per group, worst mean percentage first."""
    stats = {
        "mean_ape": F.avg("percentage_error"), "n": F.count("percentage_error"), "mean_ae": F.avg("absolute_error"),
    }
    medians = {"median_ape": ("percentage_error", 0.5), "median_ae": ("absolute_error", 0.5)}
    return exact_percentiles(errors, [key], medians, stats=stats).select(
        key, "mean_ape", "median_ape", "n", "mean_ae", "median_ae"
    ).orderBy(F.desc("mean_ape"), key)


def mean_ape_by(errors: DataFrame, key: str) -> DataFrame:
    """Mean absolute percentage error per group."""
    return errors.groupBy(key).agg(
        F.avg("percentage_error").alias("mean_ape"), F.count("percentage_error").alias("n")
    )


def error_distribution(errors: DataFrame) -> DataFrame:
    """One row: mean, median and deviation of the absolute error, percentiles of the percentage error."""
    stats = {
        "n": F.count("*"), "mean_ae": F.avg("absolute_error"), "std_ae": F.stddev_samp("absolute_error"),
        "mean_ape": F.avg("percentage_error"),
    }
    ranks = {
        "median_ae": ("absolute_error", 0.5), "median_ape": ("percentage_error", 0.5),
        "p75_ape": ("percentage_error", 0.75), "p95_ape": ("percentage_error", 0.95),
    }
    # A grouping without keys has one row, also without errors.
    return exact_percentiles(errors, [], ranks, stats=stats).select(
        "n", "mean_ae", "median_ae", "std_ae", "mean_ape", "median_ape", "p75_ape", "p95_ape"
    )


def error_thresholds(errors: DataFrame, thresholds: tuple[int, ...] = THRESHOLDS) -> DataFrame:
    """Count and share (%) of predictions within each percentage-error threshold."""
    within = {t: F.count_if(F.col("percentage_error") <= t) for t in thresholds}
    totals = errors.agg(F.count("*").alias("total"), *[c.alias(f"within_{t}") for t, c in within.items()])
    return totals.select(F.inline(F.array(*[
        F.struct(
            F.lit(t).alias("threshold_pct"),
            F.col(f"within_{t}").alias("n_within"),
            F.try_divide(F.col(f"within_{t}") * F.lit(100.0), F.col("total")).alias("share_pct"),
        )
        for t in thresholds
    ])))


def regression_metrics(
    df: DataFrame, by: list[str], actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """RMSE, MAE, R², mean and median APE per group."""
    errors = prediction_errors(df, actual, predicted)
    squared = F.avg(F.col("error") * F.col("error"))
    stats = {
        "n": F.count("*"), "rmse": F.sqrt(squared), "mae": F.avg("absolute_error"),
        "r2": 1 - F.try_divide(squared, F.var_pop(actual)), "mean_ape": F.avg("percentage_error"),
    }
    return exact_percentiles(errors, by, {"median_ape": ("percentage_error", 0.5)}, stats=stats).select(
        *by, "n", "rmse", "mae", "r2", "mean_ape", "median_ape"
    )


def model_comparison(metrics: DataFrame, baseline: str) -> DataFrame:
    """Models by falling R², each with its change (%) against the baseline model.

    R² counts as better when it rises, the errors when they fall.
    """
    reference = metrics.where(F.col("model") == baseline).agg(
        F.struct(*[F.max(c).alias(c) for c in ("r2", "rmse", "mae")]).alias("m")
    ).scalar()

    def change(column: str, sign: int):
        base = reference.getField(column)
        return (F.try_divide((F.col(column) - base) * sign, base) * 100).alias(f"{column}_change_pct")

    return metrics.select(
        "model", "r2", "rmse", "mae", "mean_ape", "median_ape",
        change("r2", 1), change("rmse", -1), change("mae", -1),
    ).orderBy(F.desc("r2"), "model")


def worst_errors(errors: DataFrame, n: int, *tie_break: str) -> DataFrame:
    """The ``n`` largest absolute errors."""
    return errors.orderBy(F.desc("absolute_error"), *tie_break).limit(n)


def encode_labels(df: DataFrame, labels: DataFrame, column: str, unseen: str = "error") -> DataFrame:
    """Replace label texts by their codes (``<column>_code``); an unseen text raises, or keeps NULL."""
    side = broadcast_within(labels.select(F.col("label").alias("_label"), F.col("code").alias("_code")))
    joined = df.join(side, F.col(column) == F.col("_label"), "left")
    code = F.col("_code")
    if unseen == "error":
        message = F.concat(F.lit(f"unseen {column}: "), F.col(column))
        code = F.when(code.isNull() & F.col(column).isNotNull(), F.raise_error(message).cast("long")).otherwise(code)
    return joined.withColumn(f"{column}_code", code).drop("_label", "_code")


def decode_labels(df: DataFrame, labels: DataFrame, code_column: str, name: str) -> DataFrame:
    """Attach the label text of a code; an unknown code gives NULL."""
    side = broadcast_within(labels.select(F.col("label").alias(name), F.col("code").alias("_code")))
    return df.join(side, F.col(code_column) == F.col("_code"), "left").drop("_code")
