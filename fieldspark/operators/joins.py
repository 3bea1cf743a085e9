"""Joining against side tables of a checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# 100,000 rows of a few short columns stay far below an executor's broadcast budget.
SMALL_SIDE_ROWS = 100_000


def fits(side: DataFrame, max_rows: int = SMALL_SIDE_ROWS) -> bool:
    """Whether a side has at most ``max_rows`` rows; counting stops one row later."""
    return side.limit(max_rows + 1).count() <= max_rows


def sized(side: DataFrame, small: bool) -> DataFrame:
    """Broadcast a side found small. A larger one gets no hint: Spark then shuffles both
    sides and AQE splits skewed keys."""
    return F.broadcast(side) if small else side


def broadcast_within(side: DataFrame, max_rows: int = SMALL_SIDE_ROWS) -> DataFrame:
    """Check a side's size and hint accordingly."""
    return sized(side, fits(side, max_rows))


def null_safe(left: DataFrame, right: DataFrame, names: list[str], prefix: str):
    """Join condition that lets NULL group keys meet; right columns carry ``prefix``."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[prefix + name])
    return condition
