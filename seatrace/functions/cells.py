"""Geohash grid cells as integer arithmetic on Columns (H7, H8).

Inside a plan a cell is one bigint: its row number on the latitude axis above its column
number on the longitude axis. That takes two divisions per position, and long keys stay
in the hash aggregate's fixed-width buffers. The two numbers are interleaved into the
geohash text only on result rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The geohash digits.
DIGITS = "0123456789bcdefghjkmnpqrstuvwxyz"

LAT_LIMIT = 90.0
LON_LIMIT = 180.0


def axis_bits(precision: int) -> tuple[int, int]:
    """(latitude bits, longitude bits) of a cell text of this length."""
    if not 1 <= precision <= 12:
        raise ValueError("precision must be 1 to 12")
    total = 5 * precision
    return total // 2, total - total // 2


def _axis_index(x: Column, limit: float, bits: int) -> Column:
    """Number of the cell (low, high] holding x: a point on a border belongs to the lower cell.

    Borders are multiples of the cell width and exact in double. The quotient may round
    onto a border from above; comparing x with that border undoes it.
    """
    width = 2 * limit / 2**bits
    border = F.ceil(x / width)
    index = border - F.when(x <= border * width, 1).otherwise(0) + 2 ** (bits - 1)
    return F.when(x <= -limit, 0).when(x > limit, 2**bits - 1).otherwise(index).cast("bigint")


def cell_id(lat: Column, lon: Column, precision: int) -> Column:
    """Cell of a point; null where a coordinate is null."""
    lat_bits, lon_bits = axis_bits(precision)
    row = _axis_index(lat, LAT_LIMIT, lat_bits)
    column = _axis_index(lon, LON_LIMIT, lon_bits)
    return F.shiftleft(row, lon_bits) + column


def _row_and_column(cell: Column, precision: int) -> tuple[Column, Column]:
    lon_bits = axis_bits(precision)[1]
    return F.shiftright(cell, lon_bits), cell.bitwiseAND(F.lit(2**lon_bits - 1))


def parent_cell(cell: Column, precision: int, levels: int) -> Column:
    """The enclosing cell whose text is ``levels`` characters shorter."""
    lat_bits, lon_bits = axis_bits(precision)
    lat_left, lon_left = axis_bits(precision - levels)
    row, column = _row_and_column(cell, precision)
    return F.shiftleft(F.shiftright(row, lat_bits - lat_left), lon_left) + F.shiftright(
        column, lon_bits - lon_left
    )


def _text_bits(precision: int) -> list[int]:
    """Position in the cell id of each bit of the text, first bit first.

    The axes take turns, longitude first.
    """
    lat_bits, lon_bits = axis_bits(precision)
    columns = range(lon_bits - 1, -1, -1)
    rows = range(lon_bits + lat_bits - 1, lon_bits - 1, -1)
    return [(rows if bit % 2 else columns)[bit // 2] for bit in range(5 * precision)]


def cell_text(cell: Column, precision: int) -> Column:
    bits = _text_bits(precision)
    digits = []
    for place in range(precision):
        value = sum(
            F.shiftright(cell, position) % 2 * 2 ** (4 - i)
            for i, position in enumerate(bits[5 * place : 5 * place + 5])
        )
        digits.append(F.substr(F.lit(DIGITS), (value + 1).cast("int"), F.lit(1)))
    return F.concat(*digits)


def cell_id_of_text(text: Column, precision: int) -> Column:
    bits = _text_bits(precision)
    digits = [
        (F.instr(F.lit(DIGITS), F.substr(text, F.lit(place + 1), F.lit(1))) - 1).cast("bigint")
        for place in range(precision)
    ]
    return sum(
        F.shiftright(digits[i // 5], 4 - i % 5) % 2 * F.lit(2**position).cast("bigint")
        for i, position in enumerate(bits)
    )


def cell_center(cell: Column, precision: int) -> tuple[Column, Column]:
    """(latitude, longitude) of the middle of the cell; exact in double."""
    lat_bits, lon_bits = axis_bits(precision)
    row, column = _row_and_column(cell, precision)
    return (
        (row.cast("double") + 0.5) * (2 * LAT_LIMIT / 2**lat_bits) - LAT_LIMIT,
        (column.cast("double") + 0.5) * (2 * LON_LIMIT / 2**lon_bits) - LON_LIMIT,
    )


def with_cell(
    df: DataFrame, precision: int, lat: str = "latitude", lon: str = "longitude", name: str = "cell"
) -> DataFrame:
    """Add the cell text of each point."""
    return (
        df.withColumn("__cell_id", cell_id(F.col(lat), F.col(lon), precision))
        .withColumn(name, cell_text(F.col("__cell_id"), precision))
        .drop("__cell_id")
    )


def with_cell_center(
    df: DataFrame, precision: int, cell: str = "cell", lat: str = "lat", lon: str = "lon"
) -> DataFrame:
    """Add the centre of the cell named by a text column."""
    keyed = df.withColumn("__cell_id", cell_id_of_text(F.col(cell), precision))
    center_lat, center_lon = cell_center(F.col("__cell_id"), precision)
    return keyed.withColumns({lat: center_lat, lon: center_lon}).drop("__cell_id")
