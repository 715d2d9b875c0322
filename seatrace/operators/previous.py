"""Previous row of the same key, without one task per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_SECONDS = 600


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str,
    columns: Sequence[str],
    tie_breakers: Sequence[str] = (),
    where: Column | None = None,
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Add ``prev_<name>`` of each column from the preceding row; null on a key's first row.

    ``where`` may test the new columns; only rows that pass it are returned.

    A plain ``lag`` over the key puts all rows of a busy vessel in one task. Here the
    window runs per (key, time slice). Only the first row of each slice misses its
    predecessor, which is the last row of the key's previous slice: a second window brings
    it in. Rows that fail ``where`` leave before that second shuffle; of the others, those
    already complete stay spread by slice, and a key's own group holds one row per slice.
    """
    condition = F.lit(True) if where is None else where
    micros = F.unix_micros(order_by)
    slice_start = micros - F.pmod(micros, F.lit(slice_seconds * 1_000_000))
    in_slice = Window.partitionBy(*keys, "__slice").orderBy(order_by, *tie_breakers)
    whole_slice = in_slice.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    marked = df.withColumn("__slice", slice_start).withColumns(
        {
            "__place": F.row_number().over(in_slice),
            **{f"prev_{c}": F.lag(c).over(in_slice) for c in columns},
            **{f"__last_{c}": F.last(c).over(whole_slice) for c in columns},
        }
    )
    is_first = F.col("__place") == 1
    kept = marked.filter(is_first | condition).withColumn(
        "__group", F.when(~is_first, F.col("__slice"))
    )
    across = Window.partitionBy(*keys, "__group").orderBy("__slice")
    complete = kept.withColumns(
        {
            f"prev_{c}": F.when(is_first, F.lag(f"__last_{c}").over(across)).otherwise(
                F.col(f"prev_{c}")
            )
            for c in columns
        }
    )
    return complete.filter(condition).select(*df.columns, *[f"prev_{c}" for c in columns])
