"""Previous row of the same key over range partitions (W1, W2), whatever the keys' sizes.

``with_previous`` gives a task one key's slice of time, which is too much where a key sends
most of its rows within one slice. Here rows are range-partitioned by key and time, so tasks
have equal shares of the rows and a key may run over many of them. A task knows the previous
row of all but its first row; that one is the last row of the partition before, which is
carried over: one row per partition, however many rows there are.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from seatrace.session import ensure_checkpoint_dir

#: Marks of the rows that a task returns: rows with their own previous row, its first row,
#: and its last row, which is returned once more for the partition that follows.
PLAIN, FIRST, CARRY = 0, 1, 2


def _with_previous_in_task(
    batches: Iterator[pa.RecordBatch], keys: int, carried: list[int], names: list[str]
) -> Iterator[pa.RecordBatch]:
    """Rows of one partition, in order, each with the row before it of the same key."""
    part, before = TaskContext.get().partitionId(), None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        whole = batch if before is None else pa.Table.from_batches([before, batch]).combine_chunks().to_batches()[0]
        start = whole.num_rows - n
        # with nothing before it, the first row sees itself, and is marked
        previous = pa.array([max(0, start - 1), *range(start, whole.num_rows - 1)], pa.int64())
        same = pa.array([True] * n)
        for i in range(keys):
            column = whole.column(i)
            own, other = column.slice(start), column.take(previous)
            equal = pc.fill_null(pc.equal(own, other), False)
            same = pc.and_(same, pc.or_(equal, pc.and_(own.is_null(), other.is_null())))
        marks = pa.array([PLAIN if start else FIRST] + [PLAIN] * (n - 1), pa.int32())
        olds = [pc.if_else(same, whole.column(i).take(previous), None) for i in carried]
        yield pa.RecordBatch.from_arrays([*batch.columns, *olds, pa.array([part] * n, pa.int32()), marks], names=names)
        before = batch.slice(n - 1)
    if before is not None:
        empty = [pa.nulls(1, before.schema.field(i).type) for i in carried]
        yield pa.RecordBatch.from_arrays(
            [*before.columns, *empty, pa.array([part], pa.int32()), pa.array([CARRY], pa.int32())], names=names
        )


def with_previous_ranged(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str,
    columns: Sequence[str],
    tie_breakers: Sequence[str] = (),
    where: Column | None = None,
) -> DataFrame:
    """``with_previous`` for keys of any size: add ``prev_<name>`` of each column from the
    preceding row, null on a key's first row; only rows that pass ``where`` are returned.

    Null keys are a key of their own. Rows that pass, and two rows for each partition, are
    written to the checkpoint folder, so that all of what follows sees one partitioning.
    """
    condition = F.lit(True) if where is None else where
    rest = [c for c in df.columns if c not in keys]
    ranged = df.select(*keys, *rest).repartitionByRange(*keys, order_by, *tie_breakers)
    ordered = ranged.sortWithinPartitions(*keys, order_by, *tie_breakers)
    names = ordered.columns
    carried = [names.index(c) for c in columns]
    schema = StructType(list(ordered.schema.fields))
    for c in columns:
        schema = schema.add(f"prev_{c}", ordered.schema[c].dataType)
    schema = schema.add("__part", IntegerType()).add("__mark", IntegerType())
    fields = schema.names
    marked = ordered.mapInArrow(
        lambda batches: _with_previous_in_task(batches, len(keys), carried, fields), schema
    )
    ensure_checkpoint_dir(df.sparkSession)
    stored = marked.filter((F.col("__mark") != PLAIN) | condition).checkpoint()

    # two rows per partition: a first row's predecessor is the carry of the one before
    edges = stored.filter(F.col("__mark") != PLAIN)
    in_order = Window.orderBy("__part", "__mark")
    known = [F.lag(c).over(in_order).eqNullSafe(F.col(c)) for c in keys]
    same_key = known[0]
    for equal in known[1:]:
        same_key = same_key & equal
    bridged = edges.withColumns(
        {"__same": same_key, **{f"__old_{c}": F.lag(c).over(in_order) for c in columns}}
    ).withColumns({f"prev_{c}": F.when(F.col("__same"), F.col(f"__old_{c}")) for c in columns})
    out = [*df.columns, *[f"prev_{c}" for c in columns]]
    firsts = bridged.filter((F.col("__mark") == FIRST) & condition).select(*out)
    return stored.filter(F.col("__mark") == PLAIN).select(*out).unionByName(firsts)


# executors need not have the package installed: its Python tasks travel by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])
