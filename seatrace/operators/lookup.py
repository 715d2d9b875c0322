"""Equi-join against a table with one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def lookup_join(
    rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join rows to a keyed table when one key may hold a large share of the rows.

    The table is taken as it is: Spark broadcasts it where its measured size allows, and
    otherwise adaptive execution splits the rows of a heavy key over several tasks, each
    with that key's one table row. Null keys match nothing.
    """
    return rows.join(table, list(keys), how)
