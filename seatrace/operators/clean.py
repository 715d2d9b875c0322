"""Cleaning rules of the position scan (A4, C3 to C9) and retention."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_ISLAND_DELTA = 0.001
RETENTION_DAYS = 30


def with_date(df: DataFrame) -> DataFrame:
    """Add the UTC ``date`` of ``recorded_at`` unless the table already stores it."""
    return df if "date" in df.columns else df.withColumn("date", F.to_date("recorded_at"))


def on_date(df: DataFrame, target_date: date | str) -> DataFrame:
    """Rows of one day (C4). On a stored table this prunes partitions."""
    return with_date(df).filter(F.col("date") == F.lit(str(target_date)).cast("date"))


def clean_positions(
    df: DataFrame,
    target_date: date | str | None = None,
    *,
    require_speed: bool = False,
    null_island_delta: float = NULL_ISLAND_DELTA,
    enforce_global_bounds: bool = False,
    select_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Drop rows without vessel or coordinates and rows at null island (A4)."""
    lat, lon = F.col("latitude"), F.col("longitude")
    delta = null_island_delta
    kept = df if target_date is None else on_date(df, target_date)
    kept = kept.filter(
        F.col("mmsi").isNotNull()
        & lat.isNotNull()
        & lon.isNotNull()
        & ~(lat.between(-delta, delta) & lon.between(-delta, delta))
    )
    if require_speed:
        kept = kept.filter(F.col("speed").isNotNull())
    if enforce_global_bounds:
        kept = kept.filter(lat.between(-90, 90) & lon.between(-180, 180))
    return kept.select(*select_columns) if select_columns else kept


def expire_positions(
    df: DataFrame, as_of: datetime | str | Column, days: int = RETENTION_DAYS
) -> DataFrame:
    """Rows not older than ``days`` at ``as_of`` (B11); the date test prunes partitions."""
    now = as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("timestamp")
    oldest = now - F.make_dt_interval(days=F.lit(days))
    return with_date(df).filter(
        (F.col("date") >= F.to_date(oldest)) & (F.col("recorded_at") >= oldest)
    )
