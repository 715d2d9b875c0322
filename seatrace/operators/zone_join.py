"""Zone assignment: fixed boxes, or a table of boxes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatrace.functions.zones import NO_COORDINATE, OUTSIDE, SEA_ZONES, Zone, zone_of
from seatrace.operators.lookup import lookup_join

# Sides of the grid's cells in degrees. A box lies on the finest grid whose cells are no
# smaller than the box, so it meets at most four cells but on the coarsest.
CELL_SIDES = (1 / 256, 1 / 16, 1.0, 16.0)


def with_zone(df: DataFrame, zones: Sequence[Zone] = SEA_ZONES) -> DataFrame:
    return df.withColumn("zone", zone_of(F.col("latitude"), F.col("longitude"), zones))


def with_zone_table(df: DataFrame, zones: DataFrame) -> DataFrame:
    """Zone of each point from a table ``(priority, zone, lat_lo, lat_hi, lon_lo, lon_hi)``.

    On each grid the lookup is an equi-join with at most one match per point, and only the
    boxes of that cell are tried, so a degree full of small boxes is not searched as a
    whole. No row is multiplied. Grids without boxes drop out while the query runs. Missing
    coordinates match no cell. A box with lon_lo > lon_hi crosses the 180th meridian; one
    with lat_lo > lat_hi is an error.
    """
    zones = _unwrapped(zones)
    side = F.greatest(F.col("lat_hi") - F.col("lat_lo"), F.col("lon_hi") - F.col("lon_lo"))
    lat, lon = F.col("latitude"), F.col("longitude")
    joined, hits = df, []
    for level, cell in enumerate(CELL_SIDES):
        on_level = side <= cell
        if level:
            on_level &= side > CELL_SIDES[level - 1]
        if cell == CELL_SIDES[-1]:
            on_level = side > CELL_SIDES[-2]
        keys = [f"__gy{level}", f"__gx{level}"]
        grid = (
            zones.filter(on_level)
            .withColumn(keys[0], F.explode(_cells("lat_lo", "lat_hi", cell)))
            .withColumn(keys[1], F.explode(_cells("lon_lo", "lon_hi", cell)))
            .groupBy(*keys)
            .agg(F.array_sort(F.collect_list(F.struct(*Zone._fields))).alias(f"__boxes{level}"))
        )
        points = joined.withColumns(
            {keys[0]: F.floor(lat / F.lit(cell)), keys[1]: F.floor(lon / F.lit(cell))}
        )
        joined = lookup_join(points, grid, keys, "left").drop(*keys)
        inside = F.filter(
            f"__boxes{level}",
            lambda b: lat.between(b["lat_lo"], b["lat_hi"]) & lon.between(b["lon_lo"], b["lon_hi"]),
        )
        hits.append(F.get(inside, 0))
    first = F.array_min(F.filter(F.array(*hits), lambda hit: hit.isNotNull()))
    zone = F.when(lat.isNull() | lon.isNull(), NO_COORDINATE).otherwise(
        F.coalesce(first["zone"], F.lit(OUTSIDE))
    )
    return joined.withColumn("zone", zone).drop(*[f"__boxes{i}" for i in range(len(CELL_SIDES))])


def _unwrapped(zones: DataFrame) -> DataFrame:
    """Boxes that cross the 180th meridian as two of the same priority and name."""
    lo, hi = F.col("lon_lo"), F.col("lon_hi")
    message = F.concat(F.lit("zone "), F.col("zone"), F.lit(": lat_lo is above lat_hi"))
    checked = F.when(F.col("lat_lo") > F.col("lat_hi"), F.raise_error(message).cast("double")).otherwise(F.col("lat_lo"))
    parts = F.when(
        lo > hi, F.array(F.struct(lo.alias("lo"), F.lit(180.0).alias("hi")), F.struct(F.lit(-180.0).alias("lo"), hi.alias("hi")))
    ).otherwise(F.array(F.struct(lo.alias("lo"), hi.alias("hi"))))
    cut = zones.withColumn("lat_lo", checked).withColumn("__lon", F.explode(parts))
    return cut.withColumns({"lon_lo": F.col("__lon.lo"), "lon_hi": F.col("__lon.hi")}).drop("__lon")


def _cells(low: str, high: str, cell: float):
    return F.sequence(F.floor(F.col(low) / F.lit(cell)), F.floor(F.col(high) / F.lit(cell)))
