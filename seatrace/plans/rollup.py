"""Zone traffic of any period from stored hours (G3, G4, G5), without reading positions again.

Distinct vessels do not add up, sets of vessels do. An hour's vessels are exact bitmaps, one
for each bucket of 32,768 consecutive vessel numbers that occurs; bitmaps of the same bucket
unite by a bitwise or, and buckets are disjoint, so their counts add up. A stored hour thus
has as many rows as its vessels have buckets, however often they reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatrace.functions.numbers import round_exact

#: Periods by name: the day on which one begins, from the date of an hour.
PERIODS = {"day": lambda date: date, "week": lambda date: F.trunc(date, "week"), "month": lambda date: F.trunc(date, "month")}


def _united(bitmap: Column) -> list[Column]:
    return [
        bitmap.alias("vessels"),
        F.sum("speed_sum").alias("speed_sum"),
        F.max("max_speed").alias("max_speed"),
        F.sum("message_count").alias("message_count"),
    ]


def zone_hours(rows: DataFrame) -> DataFrame:
    """Hours per zone and vessel bucket, from ``sightings`` or ``vessel_hours``."""
    return (
        rows.withColumn("bucket", F.bitmap_bucket_number("mmsi"))
        .groupBy("zone", "date", "hour", "bucket")
        .agg(*_united(F.bitmap_construct_agg(F.bitmap_bit_position("mmsi"))))
    )


def _counted(sets: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key of rows that hold a bitmap for each key and bucket."""
    return sets.groupBy(*keys).agg(
        F.sum(F.bitmap_count("vessels")).alias("vessel_count"),
        F.sum("speed_sum").alias("speed_sum"),
        F.max("max_speed").alias("max_speed"),
        F.sum("message_count").alias("message_count"),
    )


def rolled_up(hours: DataFrame, period: str) -> DataFrame:
    """Traffic per zone and period from ``zone_hours``, with its busiest hour.

    Distinct vessels are exact. Of hours with the same number of vessels the earliest is the
    busiest. The period is named by the day it begins on.
    """
    begins = hours.withColumn("period_start", PERIODS[period](F.col("date")))
    keys = ["zone", "period_start"]
    total = _counted(
        begins.groupBy(*keys, "bucket").agg(*_united(F.bitmap_or_agg("vessels"))), keys
    )
    # an hour's buckets are disjoint already
    per_hour = _counted(begins, [*keys, "hour"])
    busiest = per_hour.groupBy(*keys).agg(
        F.min(F.struct((-F.col("vessel_count")).alias("fewer"), "hour")).alias("peak")
    )
    average = F.col("speed_sum") / F.col("message_count")
    return total.join(busiest, keys).select(
        "zone",
        F.lit(period).alias("period"),
        "period_start",
        "vessel_count",
        round_exact(average, 2).alias("avg_speed"),
        round_exact(F.col("max_speed"), 2).alias("max_speed"),
        "message_count",
        F.col("peak.hour").alias("peak_hour"),
        (-F.col("peak.fewer")).alias("peak_count"),
    )


def zone_rollup(hours: DataFrame, periods=("day", "week")) -> DataFrame:
    """``rolled_up`` for several periods, one below the other."""
    layers = [rolled_up(hours, period) for period in periods]
    out = layers[0]
    for layer in layers[1:]:
        out = out.unionByName(layer)
    return out
