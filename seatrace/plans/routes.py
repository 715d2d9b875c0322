"""Route segments between grid cells."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatrace.functions.cells import cell_center, cell_id, cell_text
from seatrace.functions.geo import haversine_km
from seatrace.functions.numbers import round_exact
from seatrace.operators.clean import clean_positions, with_date
from seatrace.operators.previous import SLICE_SECONDS, with_previous
from seatrace.operators.ranged import with_previous_ranged

ROUTE_PRECISION = 5
MIN_CROSSINGS = 2


def cell_moves(
    positions: DataFrame,
    target_date: date | str | None = None,
    precision: int = ROUTE_PRECISION,
    max_segment_km: float | None = None,
    slice_seconds: int | None = SLICE_SECONDS,
) -> DataFrame:
    """Each change of cell by a vessel within a day.

    ``max_segment_km`` also drops jumps longer than that (W2, W5). Without ``slice_seconds``
    rows are dealt out by ranges of vessel and time instead of by vessel and slice, for
    tables in which one vessel's minutes hold a large share of the rows.
    """
    cleaned = with_date(clean_positions(positions, target_date, enforce_global_bounds=True))
    cell = cell_id(F.col("latitude"), F.col("longitude"), precision).alias("cell_id")
    carried = ["cell_id"] if max_segment_km is None else ["cell_id", "latitude", "longitude"]
    cells = cleaned.select("mmsi", "date", "recorded_at", "speed", cell, *carried[1:])
    moved = F.col("prev_cell_id") != F.col("cell_id")
    if max_segment_km is not None:
        jump = haversine_km(
            F.col("prev_latitude"), F.col("prev_longitude"), F.col("latitude"), F.col("longitude")
        )
        moved = moved & (jump <= max_segment_km)
    # rows of one instant that agree in all carried columns and speed are interchangeable
    keys, ties = ["mmsi", "date"], [*carried, "speed"]
    if slice_seconds is None:
        moves = with_previous_ranged(cells, keys, "recorded_at", carried, ties, moved)
    else:
        moves = with_previous(cells, keys, "recorded_at", carried, ties, moved, slice_seconds)
    return moves.select(
        "date", F.col("prev_cell_id").alias("from_id"), F.col("cell_id").alias("to_id"), "speed"
    )


def route_segments(
    positions: DataFrame,
    target_date: date | str | None = None,
    precision: int = ROUTE_PRECISION,
    max_segment_km: float | None = None,
    slice_seconds: int | None = SLICE_SECONDS,
) -> DataFrame:
    """Moves counted per (cell_from, cell_to, window_date), one-off crossings dropped."""
    counted = (
        cell_moves(positions, target_date, precision, max_segment_km, slice_seconds)
        .groupBy("date", "from_id", "to_id")
        .agg(F.count("*").alias("count"), F.avg("speed").alias("avg_speed"))
        .filter(F.col("count") >= MIN_CROSSINGS)
    )
    lat_from, lon_from = cell_center(F.col("from_id"), precision)
    lat_to, lon_to = cell_center(F.col("to_id"), precision)
    return counted.select(
        cell_text(F.col("from_id"), precision).alias("cell_from"),
        cell_text(F.col("to_id"), precision).alias("cell_to"),
        lat_from.alias("lat_from"),
        lon_from.alias("lon_from"),
        lat_to.alias("lat_to"),
        lon_to.alias("lon_to"),
        "count",
        round_exact(F.col("avg_speed"), 2).alias("avg_speed"),
        F.col("date").alias("window_date"),
    )
