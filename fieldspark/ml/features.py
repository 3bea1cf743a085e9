"""Feature preparation for the yield models."""

from __future__ import annotations

from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.functions.columns import ColumnOrName, hash_bucket

# Model features in their order, and the target.
FEATURES = [
    "area", "crop_type", "year", "average_rainfall_mm_per_year",
    "pesticides_tonnes", "avg_temp", "year_in_decade", "era",
]
CATEGORICAL = ["area", "crop_type", "era"]
TARGET = "target_yield"
# A yield panel has one observation per area, crop and year: no observation lies on both sides of a split.
PANEL_KEY = ["area", "crop_type", "year"]


def with_split(df: DataFrame, keys: list[ColumnOrName], test_share: int = 5) -> DataFrame:
    """Add ``split``: one row in ``test_share`` is "test", decided by a hash of its keys."""
    return df.withColumn(
        "split", F.when(hash_bucket(test_share, *keys) == 0, "test").otherwise("train")
    )


def row_bucket(buckets: int, columns: list[str], salt: str = "") -> Column:
    """Bucket of a whole row: a binary hash, far cheaper than hashing texts of many columns."""
    return F.pmod(F.xxhash64(F.lit(salt), *columns), F.lit(buckets))


def with_row_split(df: DataFrame, test_share: int = 5) -> DataFrame:
    """As :func:`with_split` for tables without a key: equal rows stay on the same side."""
    return df.withColumn("split", F.when(row_bucket(test_share, df.columns) == 0, "test").otherwise("train"))


def split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("n"))


def standardize(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``<column>_scaled`` with mean and population deviation of the training rows.

    A column without spread keeps scale 1.
    """
    train = df.where("split = 'train'")
    moments = train.agg(F.struct(*[
        F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in columns
    ]).alias("m")).scalar()

    def scaled(column):
        mean, std = (moments.getField(column).getField(part) for part in ("mean", "std"))
        return (F.col(column) - mean) / F.when(std == 0, 1.0).otherwise(std)

    return df.withColumns({f"{c}_scaled": scaled(c) for c in columns})


def feature_stages(extra: list[str] | None = None, handle_invalid: str = "error") -> list:
    """Pipeline stages from training columns to a feature vector.

    Codes are ordinal numbers: the SQL step drops the indexer's category metadata, so
    trees split on code order and need no bin per category.
    """
    indexer = StringIndexer(
        inputCols=CATEGORICAL, outputCols=[f"{c}_index" for c in CATEGORICAL],
        stringOrderType="alphabetAsc", handleInvalid=handle_invalid,
    )
    codes = ", ".join(f"{c}_index + 0D AS {c}_code" for c in CATEGORICAL)
    ordered = [f"{f}_code" if f in CATEGORICAL else f for f in FEATURES] + (extra or [])
    return [
        indexer,
        SQLTransformer(statement=f"SELECT *, {codes} FROM __THIS__"),
        VectorAssembler(inputCols=ordered, outputCol="features"),
    ]


def feature_names(extra: list[str] | None = None) -> list[str]:
    return FEATURES + (extra or [])
