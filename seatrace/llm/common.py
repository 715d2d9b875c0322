"""Helpers shared by the operators: word rules, sizes, checkpoints and Python tasks."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seatrace.session import ensure_checkpoint_dir

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = r"[\x20\x09-\x0D]+"


def ships_by_value(module: str) -> None:
    """Let executors run this module's functions without having the package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def quoted(name: str) -> str:
    """A column's name as an expression, whatever it contains."""
    return "`" + name.replace("`", "``") + "`"


def words(text: Column) -> Column:
    """Array of the words of a text; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def worker_memory() -> dict:
    """What a Python worker keeps from task to task. Functions that travel by value get new
    globals with every task; this lives as long as the process."""
    return sys.modules.setdefault("_seatrace_worker", ModuleType("_seatrace_worker")).__dict__


def text_slices(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive slices of a string or binary column with about ``size`` bytes."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < len(ends):
        before = int(ends[begin - 1]) if begin else 0
        stop = min(int(np.searchsorted(ends, before + size)) + 1, len(ends))
        yield begin, stop
        begin = stop


MAX_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of an Arrow batch sent to Python, and rows up to which a side is broadcast.
BATCH_BYTES = 4 << 20
BROADCAST_ROWS = 100_000


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, as texts may be long; a value set by the user stays."""
    if MAX_BATCH not in spark.conf.getAll:
        spark.conf.set(MAX_BATCH, BATCH_BYTES)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, whose rows are short and already stored, to be broadcast if it has few of them."""
    few = df.select(F.lit(1)).limit(rows + 1).count() <= rows
    return F.broadcast(df) if few else df


def checkpointed(df: DataFrame) -> DataFrame:
    """Rows written to ``spark.checkpoint.dir``, so that no later loss of an executor
    has to recompute what came before."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, path: str) -> DataFrame:
    """Rows written as Parquet over what is at ``path`` and read again, for the rounds of a loop.

    A checkpoint keeps the size that Spark estimated for its plan, for a join the product of both
    sides, so with every round that number has some times as many digits. Files have their own size.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


ships_by_value(__name__)
