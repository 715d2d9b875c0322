"""Latest row per key (B1, I7) and its expiry."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatrace.functions.times import python_text

LATEST_TTL_SECONDS = 300
# Fixed value: prefix of the key under which a vessel's latest position is published.
KEY_PREFIX = "vessel:"

LATEST_COLUMNS = [
    "ship_name",
    "latitude",
    "longitude",
    "speed",
    "course",
    "heading",
    "nav_status",
]


def newest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_by`` of each key.

    An aggregate, so every task first reduces its own rows to one per key. The other
    columns follow in the ordering, which makes equal ``order_by`` values come out the
    same on every run.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    newest = df.groupBy(*keys).agg(F.max(F.struct(*order_by, *rest)).alias("__newest"))
    return newest.select(*keys, "__newest.*").select(*df.columns)


def latest_positions(positions: DataFrame) -> DataFrame:
    """One row per vessel, stamped ``updated_at`` (B1); of equal times the last to arrive,
    where ``arrival`` is known (Q3)."""
    arrival = [name for name in positions.columns if name == "arrival"]
    rows = positions.filter(F.col("mmsi").isNotNull()).select(
        "mmsi", *LATEST_COLUMNS, F.col("recorded_at").alias("updated_at"), *arrival
    )
    return newest_per_key(rows, ["mmsi"], ["updated_at", *arrival]).drop("arrival")


def unexpired(
    latest: DataFrame, as_of: datetime | str, ttl_seconds: int = LATEST_TTL_SECONDS
) -> DataFrame:
    """Latest positions that have not run out at ``as_of``."""
    now = F.lit(str(as_of)).cast("timestamp")
    return latest.filter(F.col("updated_at") > now - F.make_dt_interval(secs=F.lit(ttl_seconds)))


def to_key_value(latest: DataFrame) -> DataFrame:
    """Latest positions as (key, JSON value), for a key-value store."""
    value = F.struct("mmsi", *LATEST_COLUMNS, python_text(F.col("updated_at")).alias("updated_at"))
    return latest.select(
        F.concat(F.lit(KEY_PREFIX), F.col("mmsi").cast("string")).alias("key"),
        F.to_json(value, {"ignoreNullFields": "false"}).alias("value"),
    )
