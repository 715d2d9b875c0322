"""Box reads of tiles by ranges of the cell text.

A cell's text orders cells along a Z curve: the bits of its number are those of longitude
and latitude in turns. Tiles stored in that order have narrow ranges of the text in every
row group, and a box is a few ranges, so the statistics of one column skip most of what lies
outside the box in either direction.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatrace.functions.cells import DIGITS, LAT_LIMIT, LON_LIMIT
from seatrace.plans.heatmap import PRECISIONS
from seatrace.plans.reads import tiles_in_box

#: Ranges into which a box is cut at most; more ranges hold less that is not in the box.
RANGES = 24


def cell_ranges(
    lat_lo: float, lat_hi: float, lon_lo: float, lon_hi: float, precision: int, most: int = RANGES
) -> list[tuple[str, str]]:
    """First and last cell text of ranges that cover all cells that meet the box.

    Halving the globe, longitude first, gives the nodes of the curve; the largest node that
    lies only partly in the box is halved until there are ``most`` of them.
    """
    bits = 5 * precision
    whole: list[tuple[int, int]] = []
    open_nodes = [(0, 0, -LAT_LIMIT, LAT_LIMIT, -LON_LIMIT, LON_LIMIT)]
    while open_nodes:
        depth, prefix, south, north, west, east = heapq.heappop(open_nodes)
        if north < lat_lo or south > lat_hi or east < lon_lo or west > lon_hi:
            continue
        inside = lat_lo <= south and north <= lat_hi and lon_lo <= west and east <= lon_hi
        if inside or depth == bits or len(whole) + len(open_nodes) + 1 >= most:
            below = bits - depth
            whole.append((prefix << below, (prefix + 1 << below) - 1))
        elif depth % 2:
            middle = (south + north) / 2
            heapq.heappush(open_nodes, (depth + 1, 2 * prefix, south, middle, west, east))
            heapq.heappush(open_nodes, (depth + 1, 2 * prefix + 1, middle, north, west, east))
        else:
            middle = (west + east) / 2
            heapq.heappush(open_nodes, (depth + 1, 2 * prefix, south, north, west, middle))
            heapq.heappush(open_nodes, (depth + 1, 2 * prefix + 1, south, north, middle, east))
    merged: list[list[int]] = []
    for low, high in sorted(whole):
        if merged and merged[-1][1] + 1 == low:
            merged[-1][1] = high
        else:
            merged.append([low, high])
    return [(_text(low, precision), _text(high, precision)) for low, high in merged]


def _text(number: int, precision: int) -> str:
    return "".join(DIGITS[number >> 5 * (precision - 1 - i) & 31] for i in range(precision))


def in_ranges(
    lat_lo: float, lat_hi: float, lon_lo: float, lon_hi: float, precisions=PRECISIONS, most: int = RANGES
) -> Column:
    """Whether a tile's cell lies in a range of the box; reaches the scan as a filter."""
    found = [
        _any([F.col("cell").between(*ends) for ends in cell_ranges(lat_lo, lat_hi, lon_lo, lon_hi, p, most)])
        & (F.col("precision") == p)
        for p in precisions
    ]
    return _any(found)


def _any(conditions: list[Column]) -> Column:
    """Their disjunction as a balanced tree, which stays shallow however many there are."""
    if len(conditions) < 2:
        return conditions[0] if conditions else F.lit(False)
    half = len(conditions) // 2
    return _any(conditions[:half]) | _any(conditions[half:])


def tiles_in_box_by_range(
    tiles: DataFrame, lat_lo: float, lat_hi: float, lon_lo: float, lon_hi: float,
    precisions=PRECISIONS, most: int = RANGES,
) -> DataFrame:
    """``tiles_in_box`` of tables whose precisions are ``precisions``, by cell ranges."""
    ranged = tiles.filter(in_ranges(lat_lo, lat_hi, lon_lo, lon_hi, precisions, most))
    return tiles_in_box(ranged, lat_lo, lat_hi, lon_lo, lon_hi)


def write_tiles(tiles: DataFrame, path: str, row_group_bytes: int | None = None) -> None:
    """Tiles along the curve: files of a date and precision hold ranges of cells, in order."""
    ordered = tiles.repartitionByRange("precision", "date", "cell").sortWithinPartitions(
        "precision", "date", "cell"
    )
    writer = ordered.write.mode("overwrite").partitionBy("precision", "date")
    if row_group_bytes is not None:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)
