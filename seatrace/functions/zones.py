"""Sea zones as box lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Zone(NamedTuple):
    priority: int
    zone: str
    lat_lo: float
    lat_hi: float
    lon_lo: float
    lon_hi: float


# The sea zones, in the order they are tried.
SEA_ZONES = [
    Zone(1, "gibraltar", 35.0, 42.0, -6.0, 0.0),
    Zone(2, "alboran", 36.0, 40.0, 0.0, 5.0),
    Zone(3, "balearic", 37.0, 41.0, 5.0, 12.0),
    Zone(4, "central", 36.0, 42.0, 12.0, 20.0),
    Zone(5, "eastern", 35.0, 40.0, 20.0, 27.0),
    Zone(6, "levant", 30.0, 36.0, 30.0, 37.0),
]
OUTSIDE = "other"
NO_COORDINATE = "unknown"


def unwrapped(zones: Sequence[Zone]) -> list[Zone]:
    """Boxes that cross the 180th meridian (lon_lo > lon_hi) as two, on either side of it.

    Both parts keep the box's priority and name, so they count as one zone. A box whose
    latitudes are the wrong way round is an error.
    """
    out = []
    for zone in zones:
        if zone.lat_lo > zone.lat_hi:
            raise ValueError(f"zone {zone.zone}: lat_lo {zone.lat_lo} is above lat_hi {zone.lat_hi}")
        if zone.lon_lo <= zone.lon_hi:
            out.append(zone)
        else:
            out += [zone._replace(lon_hi=180.0), zone._replace(lon_lo=-180.0)]
    return out


def zone_of(lat: Column, lon: Column, zones: Sequence[Zone] = SEA_ZONES) -> Column:
    """Name of the first box holding the point; bounds are inclusive on both ends, and a box
    with lon_lo > lon_hi crosses the 180th meridian.

    Stays one codegen expression, so it costs no join and no worker hop.
    """
    missing = F.when(lat.isNull() | lon.isNull(), NO_COORDINATE)
    chain = reduce(
        lambda acc, z: acc.when(
            lat.between(z.lat_lo, z.lat_hi) & lon.between(z.lon_lo, z.lon_hi), z.zone
        ),
        sorted(unwrapped(zones)),
        missing,
    )
    return chain.otherwise(OUTSIDE)
