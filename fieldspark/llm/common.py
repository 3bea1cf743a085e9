"""Shared pieces of the text operators: table access, Arrow batches, word hashes."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# What separates words everywhere in this subpackage: space and the control characters 9 to 13.
# bytes.split() without arguments separates at exactly these.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

SLICE = 2_000

# Functions of this subpackage travel to the executors by value, so that those need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__package__])

_MIX_A, _MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_HALF = np.uint64(32)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _keeper() -> ModuleType:
    """Where a worker process keeps things: a module, as functions travel by value and a global of theirs would be new in every task."""
    keeper = sys.modules.setdefault("_kept_by_text_operators", ModuleType("_kept_by_text_operators"))
    if not hasattr(keeper, "kept"):
        keeper.kept, keeper.asked = {}, set()
    return keeper


def kept_in_process(key: tuple, make: Callable[[], object]) -> object:
    """What ``make`` gives, made once in a worker process: workers are reused by later tasks.

    It is kept until a task of :func:`over_batches` starts that does not ask for it.
    """
    keeper = _keeper()
    keeper.asked.add(key)
    if key not in keeper.kept:
        keeper.kept[key] = make()
    return keeper.kept[key]


def over_batches(
    df: DataFrame, schema: str | StructType, start: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
    rows: int = SLICE,
) -> DataFrame:
    """Run a batch function over a DataFrame's Arrow batches; ``start`` makes it once per task.

    Batches are handled in slices of at most ``rows`` rows, which bounds what a task holds. A worker process outlives its
    task: what other operators kept there, and memory that is free again, is given back.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keeper = _keeper()
        keeper.asked = set()
        step = start()
        for key in keeper.kept.keys() - keeper.asked:
            del keeper.kept[key]
        for batch in batches:
            for first in range(0, batch.num_rows, rows):
                yield step(batch.slice(first, rows))
        del step
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[str | None]:
    """The texts of a batch one by one, so that only one lives as a Python string."""
    for value in batch.column(name):
        yield value.as_py()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of every word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of every run of ``width`` words, in order."""
    count = len(hashes) - width + 1
    result = np.full(count, width, np.uint64)
    for place in range(width):
        result = (result ^ hashes[place:place + count]) * _MIX_A
        result ^= result >> _HALF
        result *= _MIX_B
        result ^= result >> _HALF
    return result


def hashed_share(key, share):
    """Condition that keeps about ``share`` of the rows, always the same ones."""
    return F.pmod(F.xxhash64(key, F.lit("share")), F.lit(1_000_000)) < share * 1_000_000
