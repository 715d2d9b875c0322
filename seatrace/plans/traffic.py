"""Zone traffic: time-window statistics (P2) and hourly/daily tables (P5)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatrace.functions.numbers import round_exact
from seatrace.functions.zones import NO_COORDINATE
from seatrace.operators.clean import clean_positions, with_date
from seatrace.operators.zone_join import with_zone

ZONE_WINDOW = "10 seconds"


def zone_stats(
    positions: DataFrame, window: str = ZONE_WINDOW, approx_vessels: bool = False
) -> DataFrame:
    """Average speed and message count per zone and tumbling window (G1).

    Runs on a batch table and on a stream. ``vessel_count`` counts messages; the optional
    ``approx_vessels`` estimates distinct vessels, which a stream cannot count exactly.
    The zone ``unknown`` leaves before the shuffle.
    """
    measures = [
        F.coalesce(F.avg("speed"), F.lit(0.0)).alias("avg_speed"),
        F.count("mmsi").alias("vessel_count"),
    ]
    names = ["avg_speed", "vessel_count"]
    if approx_vessels:
        measures.append(F.approx_count_distinct("mmsi").alias("approx_vessels"))
        names.append("approx_vessels")
    located = with_zone(positions.filter(F.col("mmsi").isNotNull())).filter(
        F.col("zone") != NO_COORDINATE
    )
    return (
        located.groupBy(F.window("recorded_at", window).alias("w"), "zone")
        .agg(*measures)
        .select(
            "zone",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            *names,
            F.col("w.end").alias("timestamp"),
        )
    )


#: log2 of the registers of a vessel sketch; its estimates are off by 1.04 / sqrt(registers).
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)

WINDOW_KEY = ["zone", "window_start", "window_end"]


def zone_sums(positions: DataFrame, window: str = ZONE_WINDOW) -> DataFrame:
    """What ``zone_stats`` needs per zone and window, in a form that adds up (G1).

    Sums and counts of speeds, messages, the newest event time, and a sketch of the vessels.
    Sums of parts of the rows, or of shorter windows, unite to those of all.
    """
    located = with_zone(positions.filter(F.col("mmsi").isNotNull())).filter(
        F.col("zone") != NO_COORDINATE
    )
    return (
        located.groupBy("zone", F.window("recorded_at", window).alias("w"))
        .agg(
            F.coalesce(F.sum("speed"), F.lit(0.0)).alias("speed_sum"),
            F.count("speed").alias("speed_count"),
            F.count("mmsi").alias("messages"),
            F.max("recorded_at").alias("newest"),
            F.hll_sketch_agg("mmsi", SKETCH_BITS).alias("vessels"),
        )
        .select(
            "zone",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "speed_sum",
            "speed_count",
            "messages",
            "newest",
            "vessels",
        )
    )


def united(extra: Sequence[str] = ()) -> list[Column]:
    """Aggregates that unite rows of ``zone_sums``; ``extra`` are more counts to add up."""
    added = ["speed_sum", "speed_count", "messages", *extra]
    return [
        *[F.sum(name).alias(name) for name in added],
        F.max("newest").alias("newest"),
        F.hll_union_agg("vessels").alias("vessels"),
    ]


def longer_windows(sums: DataFrame, window: str) -> DataFrame:
    """Sums of windows of which the stored ones are parts: seconds add up to hours."""
    longer = sums.withColumn("w", F.window("window_start", window)).withColumns(
        {"window_start": F.col("w.start"), "window_end": F.col("w.end")}
    )
    return longer.groupBy(*WINDOW_KEY).agg(*united())


def stats_of_sums(sums: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """The columns of ``zone_stats``, with ``approx_vessels`` and ``extra``, of united sums."""
    speed = F.when(F.col("speed_count") > 0, F.col("speed_sum") / F.col("speed_count")).otherwise(0.0)
    return sums.select(
        *WINDOW_KEY,
        speed.alias("avg_speed"),
        F.col("messages").alias("vessel_count"),
        F.hll_sketch_estimate("vessels").alias("approx_vessels"),
        *extra,
        F.col("window_end").alias("timestamp"),
    )


def sightings(positions: DataFrame, target_date: date | str | None = None) -> DataFrame:
    """Cleaned, located positions as rows to add up, zone ``unknown`` left out."""
    cleaned = with_date(clean_positions(positions, target_date, require_speed=True))
    return (
        with_zone(cleaned)
        .filter(F.col("zone") != NO_COORDINATE)
        .select(
            "zone",
            "date",
            F.date_trunc("hour", "recorded_at").alias("hour"),
            "mmsi",
            F.col("speed").alias("speed_sum"),
            F.col("speed").alias("max_speed"),
            F.lit(1).cast("bigint").alias("message_count"),
        )
    )


def _added_up() -> list[Column]:
    return [
        F.sum("speed_sum").alias("speed_sum"),
        F.max("max_speed").alias("max_speed"),
        F.sum("message_count").alias("message_count"),
    ]


def vessel_hours(rows: DataFrame) -> DataFrame:
    """Sightings added up to one row per (zone, hour, vessel), of the same columns.

    The common input when both traffic tables are built: positions are then read and
    shuffled once. Map-side combining leaves a busy vessel with one row per task, zone
    and hour, so it is no hot key.
    """
    return rows.groupBy("zone", "date", "hour", "mmsi").agg(*_added_up())


def _shaped(df: DataFrame) -> DataFrame:
    average = F.col("speed_sum") / F.col("message_count")
    return df.withColumn("avg_speed", average).withColumns(
        {name: round_exact(F.col(name), 2) for name in ("avg_speed", "max_speed")}
    )


def hourly_traffic(rows: DataFrame) -> DataFrame:
    """Per zone and hour (G3), from ``sightings`` or ``vessel_hours``."""
    hourly = rows.groupBy("zone", "date", "hour").agg(
        F.count_distinct("mmsi").alias("vessel_count"), *_added_up()
    )
    return _shaped(hourly).select(
        "zone", "hour", "date", "vessel_count", "avg_speed", "max_speed", "message_count"
    )


def daily_traffic(rows: DataFrame) -> DataFrame:
    """Per zone and date with the hour of day that saw most vessels.

    From ``sightings`` or ``vessel_hours``. A vessel's hours in a zone are kept as 24 bits
    of one integer, so a single aggregate per vessel yields the distinct vessels of the
    day and of each of its hours; no second reading, ranking or join. Of hours with equal
    counts the earliest is the peak.
    """
    vessel_days = rows.groupBy("zone", "date", "mmsi").agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1), F.hour("hour"))).alias("hours"),
        *_added_up(),
    )
    vessels_by_hour = [
        F.sum(F.shiftright("hours", hour).bitwiseAND(F.lit(1))).alias(f"h{hour}")
        for hour in range(24)
    ]
    daily = vessel_days.groupBy("zone", "date").agg(
        F.count("*").alias("vessel_count"), *_added_up(), *vessels_by_hour
    )
    counts = F.array(*[F.col(f"h{hour}") for hour in range(24)])
    return (
        _shaped(daily)
        .withColumn("peak_count", F.array_max(counts))
        .select(
            "zone",
            "date",
            "vessel_count",
            "avg_speed",
            "max_speed",
            "message_count",
            (F.array_position(counts, F.col("peak_count")) - 1).cast("int").alias("peak_hour"),
            "peak_count",
        )
    )


def zone_traffic(
    positions: DataFrame, target_date: date | str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(hourly, daily) traffic tables (P5); every date present when none is given."""
    rows = sightings(positions, target_date)
    return hourly_traffic(rows), daily_traffic(rows)
