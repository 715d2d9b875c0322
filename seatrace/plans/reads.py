"""Reads over the stored tables (R1 to R5, R7; R6 is in operators.latest).

Arguments left out mean "all". The top-k reads rank within each date; Spark keeps at most
k rows per date in every task before the shuffle, so a large date is no hot group.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _equal(df: DataFrame, **wanted) -> DataFrame:
    for name, value in wanted.items():
        if value is not None:
            df = df.filter(F.col(name) == F.lit(value))
    return df


def _first_per(df: DataFrame, group: str, order: list[Column], k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("place", place).filter(F.col("place") <= k)


def top_routes(routes: DataFrame, k: int, on: date | None = None) -> DataFrame:
    """The k most travelled segments of each date."""
    order = [F.desc("count"), F.col("cell_from"), F.col("cell_to")]
    return _first_per(_equal(routes, window_date=on), "window_date", order, k)


def hottest_tiles(
    tiles: DataFrame, on: date | None = None, precision: int | None = None
) -> DataFrame:
    """Tiles of a date and precision, hottest first (R2)."""
    return _equal(tiles, date=on, precision=precision).orderBy(
        "date", "precision", F.desc("intensity"), "cell"
    )


def tiles_in_box(
    tiles: DataFrame, lat_lo: float, lat_hi: float, lon_lo: float, lon_hi: float
) -> DataFrame:
    """Tiles whose centre lies in the box."""
    return tiles.filter(
        F.col("lat").between(lat_lo, lat_hi) & F.col("lon").between(lon_lo, lon_hi)
    )


def zone_hours(hourly: DataFrame, zone: str | None = None, on: date | None = None) -> DataFrame:
    """Hourly traffic of a zone and date in time order."""
    return _equal(hourly, zone=zone, date=on).orderBy("zone", "hour")


def busiest_zones(daily: DataFrame, k: int, on: date | None = None) -> DataFrame:
    """The k zones with most vessels of each date."""
    return _first_per(_equal(daily, date=on), "date", [F.desc("vessel_count"), F.col("zone")], k)


def vessel_track(
    positions: DataFrame, mmsi: int | None = None, on: date | None = None
) -> DataFrame:
    """Trajectory of a vessel on a day, newest first."""
    return _equal(positions, mmsi=mmsi, date=on).orderBy("mmsi", "date", F.desc("recorded_at"))


def zone_trend(daily: DataFrame) -> DataFrame:
    """Change of the vessel count against the zone's previous day in the table.

    The window holds one row per date of a zone.
    """
    by_day = Window.partitionBy("zone").orderBy("date")
    before = F.lag("vessel_count").over(by_day)
    return daily.select(
        "zone",
        "date",
        "vessel_count",
        before.alias("previous_count"),
        (F.col("vessel_count") - before).alias("change"),
    )
