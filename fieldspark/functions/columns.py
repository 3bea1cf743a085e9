"""Time, unit and arithmetic expressions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ns_to_timestamp(value: str) -> Column:
    """Epoch nanoseconds to a zone-less timestamp (integer arithmetic, no float rounding)."""
    return F.timestamp_micros(F.expr(f"`{value}` div 1000")).cast("timestamp_ntz")


def seconds_to_timestamp(value: ColumnOrName) -> Column:
    """Epoch seconds to a zone-less UTC timestamp."""
    return F.timestamp_seconds(_col(value)).cast("timestamp_ntz")


def timestamp_to_ns(value: ColumnOrName) -> Column:
    """Zone-less timestamp to epoch nanoseconds, as the raw tables store it."""
    return F.unix_micros(_col(value).cast("timestamp")) * F.lit(1000).cast("long")


def truncate(unit: str, value: ColumnOrName) -> Column:
    """``date_trunc`` that keeps the zone-less type."""
    return F.date_trunc(unit, _col(value)).cast("timestamp_ntz")


def moment(as_of: Column | datetime | str | None) -> Column:
    """The "now" of a query: a given instant, else the query's own start time."""
    if as_of is None:
        return F.localtimestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("timestamp_ntz")


def fahrenheit_to_celsius(value: ColumnOrName) -> Column:
    return (_col(value) - 32) * 5.0 / 9.0


def kelvin_to_celsius(value: ColumnOrName) -> Column:
    return _col(value) - 273.15


def hg_to_kg(value: ColumnOrName) -> Column:
    return _col(value) / 10


def hg_to_tonnes(value: ColumnOrName) -> Column:
    return _col(value) / 10000


def hash_bucket(buckets: int, *keys: ColumnOrName) -> Column:
    """Stable bucket 0 … buckets-1 from key values; does not depend on partitioning."""
    text = F.concat_ws("|", *[_col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % buckets
