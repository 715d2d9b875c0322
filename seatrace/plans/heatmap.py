"""Heatmap tiles."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatrace.functions.cells import cell_center, cell_id, cell_text, parent_cell
from seatrace.functions.numbers import round_exact
from seatrace.operators.clean import clean_positions, with_date

PRECISIONS = (5, 6)


def vessel_cells(
    positions: DataFrame, precision: int, target_date: date | str | None = None
) -> DataFrame:
    """Messages per (date, cell, vessel); a busy cell or vessel shrinks map-side (C14).

    The cell is null only where a coordinate is, and the cleaning drops those rows.
    """
    cleaned = with_date(
        clean_positions(positions, target_date, enforce_global_bounds=True)
    ).select("date", "mmsi", "latitude", "longitude")
    return (
        cleaned.withColumn("cell_id", cell_id(F.col("latitude"), F.col("longitude"), precision))
        .groupBy("date", "cell_id", "mmsi")
        .agg(F.count("*").alias("messages"))
    )


def coarser_cells(cells: DataFrame, finest: int, precision: int) -> DataFrame:
    """``vessel_cells`` at a lower precision; a coarser cell is a prefix of the finer one."""
    if precision == finest:
        return cells
    parent = parent_cell(F.col("cell_id"), finest, finest - precision)
    return (
        cells.withColumn("cell_id", parent)
        .groupBy("date", "cell_id", "mmsi")
        .agg(F.sum("messages").alias("messages"))
    )


def tiles(cells: DataFrame, precision: int) -> DataFrame:
    """Tiles from ``vessel_cells`` of the same precision."""
    counted = cells.groupBy("date", "cell_id").agg(
        F.sum("messages").alias("count"), F.count("*").alias("vessels")
    )
    # ``vessels`` never exceeds ``count``; asking for it too lets both uses of ``counted``
    # read one shuffle. (A filter for that would start dynamic partition pruning, which
    # runs the aggregate once more.) One row per calendar day of the input, at most 366 a
    # year: safe to broadcast.
    hottest = counted.groupBy("date").agg(
        F.greatest(F.max("count"), F.max("vessels")).alias("max_count")
    )
    scaled = counted.join(F.broadcast(hottest), "date")
    lat, lon = cell_center(F.col("cell_id"), precision)
    return scaled.select(
        F.lit(precision).alias("precision"),
        cell_text(F.col("cell_id"), precision).alias("cell"),
        # a centre is never halfway between two 6-digit decimals
        F.round(lat, 6).alias("lat"),
        F.round(lon, 6).alias("lon"),
        "count",
        "vessels",
        # counts are at least 1, so the denominator is never 0
        round_exact(F.log1p("count") / F.log1p("max_count"), 4).alias("intensity"),
        "date",
    )


def heatmap_tiles(
    positions: DataFrame, precision: int, target_date: date | str | None = None
) -> DataFrame:
    return tiles(vessel_cells(positions, precision, target_date), precision)


def heatmap_pyramid(
    positions: DataFrame, target_date: date | str | None = None, precisions=PRECISIONS
) -> DataFrame:
    """Tiles of all precisions from one reading of the positions."""
    finest = max(precisions)
    cells = vessel_cells(positions, finest, target_date)
    layers = [tiles(coarser_cells(cells, finest, p), p) for p in sorted(precisions)]
    pyramid = layers[0]
    for layer in layers[1:]:
        pyramid = pyramid.unionByName(layer)
    return pyramid
