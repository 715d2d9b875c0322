"""Zones, cells, rounding and times against plain models."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from seatrace.functions import cells, times
from seatrace.functions.numbers import round_exact
from seatrace.functions.zones import SEA_ZONES
from seatrace.operators.zone_join import with_zone, with_zone_table

ZONE_CASES = [
    (38.0, 0.0, "gibraltar"),
    (38.0, 5.0, "alboran"),
    (38.0, 12.0, "balearic"),
    (38.0, 20.0, "central"),
    (35.0, -6.0, "gibraltar"),
    (36.0, 30.0, "levant"),
    (38.0, 28.0, "other"),
    (91.0, 500.0, "other"),
    (None, 5.0, "unknown"),
    (38.0, None, "unknown"),
]


def test_zones(spark):
    points = spark.createDataFrame(ZONE_CASES, "latitude double, longitude double, expected string")
    table = spark.createDataFrame(SEA_ZONES)
    for located in (with_zone(points), with_zone_table(points, table)):
        assert located.count() == len(ZONE_CASES)
        assert located.filter(~F.col("zone").eqNullSafe(F.col("expected"))).collect() == []


def bisect_cell(lat, lon, precision):
    """Textbook geohash: halve the ranges in turn, a point on the middle goes low."""
    ranges = [[-180.0, 180.0], [-90.0, 90.0]]
    value = [lon, lat]
    number = 0
    for bit in range(5 * precision):
        axis = bit % 2
        low, high = ranges[axis]
        middle = (low + high) / 2
        above = value[axis] > middle
        ranges[axis][0 if above else 1] = middle
        number = number * 2 + above
    text = ""
    for _ in range(precision):
        number, digit = divmod(number, 32)
        text = cells.DIGITS[digit] + text
    return text, sum(ranges[1]) / 2, sum(ranges[0]) / 2


def cell_points():
    rng = random.Random(7)
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(3000)]
    for bits in (12, 13, 15):
        for _ in range(300):
            lat = -90 + 180 / 2**bits * rng.randrange(2**bits + 1)
            lon = -180 + 360 / 2**bits * rng.randrange(2**bits + 1)
            nudge = rng.choice([0.0, 1e-12, -1e-12])
            points.append((min(max(lat + nudge, -90), 90), min(max(lon + nudge, -180), 180)))
    tiny = [0.0, 1e-17, -1e-17, 5e-324, -5e-324, 45.0, 90.0, -90.0]
    points += [(a, b) for a in tiny for b in [*tiny, 180.0, -180.0]]
    return points


@pytest.mark.parametrize("precision", [1, 5, 6, 12])
def test_cells_match_bisection(spark, precision):
    expected = [
        (lat, lon, *bisect_cell(lat, lon, precision)) for lat, lon in cell_points()
    ]
    rows = spark.createDataFrame(
        expected, "latitude double, longitude double, cell0 string, lat0 double, lon0 double"
    )
    found = cells.with_cell_center(cells.with_cell(rows, precision), precision)
    wrong = [r for r in found.collect() if (r.cell, r.lat, r.lon) != (r.cell0, r.lat0, r.lon0)]
    assert wrong == []


def test_cell_known_value_parent_and_null(spark):
    points = spark.createDataFrame(
        [(42.605, -5.603), (None, 1.0), (1.0, None)], "latitude double, longitude double"
    )
    texts = [r.cell for r in cells.with_cell(points, 5).select("cell").collect()]
    assert texts == ["ezs42", None, None]


@pytest.mark.parametrize("levels", [0, 1, 3])
def test_parent_cell_is_text_prefix(spark, levels):
    points = spark.createDataFrame(cell_points(), "latitude double, longitude double")
    fine = cells.cell_id(F.col("latitude"), F.col("longitude"), 6)
    rows = points.select(
        cells.cell_text(fine, 6).alias("fine"),
        cells.cell_text(cells.parent_cell(fine, 6, levels), 6 - levels).alias("parent"),
    ).collect()
    assert all(r.fine[: 6 - levels] == r.parent for r in rows)


def test_round_exact_equals_python(spark):
    rng = random.Random(3)
    values = [rng.uniform(-200, 200) for _ in range(3000)]
    values += [n / 40 for n in range(-2000, 2000)]  # many decimal ties, few of them exact
    values += [n / 8 + 0.0 for n in range(-200, 200)]
    values += [2.675, 1.005, 0.125, 0.375, 0.0, 1e-9, 12345.675]
    rows = [(v, round(v, 2), round(v, 4), round(v, 6)) for v in values]
    df = spark.createDataFrame(rows, "x double, r2 double, r4 double, r6 double")
    for digits in (2, 4, 6):
        assert df.filter(round_exact(F.col("x"), digits) != F.col(f"r{digits}")).collect() == []


def test_round_exact_of_large_and_odd_values(spark):
    rng = random.Random(4)
    values = [rng.uniform(-1, 1) * 10 ** rng.uniform(9, 18) for _ in range(2000)]
    values += [float("nan"), float("inf"), float("-inf"), 1e300, 2.0**52 + 1, 123456789012.345, None]
    rows = [(v, *([None] * 2 if v is None else [round(v, d) for d in (2, 4)])) for v in values]
    df = spark.createDataFrame(rows, "x double, r2 double, r4 double")
    for digits in (2, 4):
        same = round_exact(F.col("x"), digits).eqNullSafe(F.col(f"r{digits}"))
        assert df.filter(~same).collect() == []


def test_many_boxes_in_one_degree(spark):
    """Small boxes by the thousand, a few large ones, missing and odd coordinates."""
    rng = random.Random(8)
    boxes = []
    for i in range(3000):
        lat, lon = 40 + rng.random(), 5 + rng.random()
        side = rng.choice([0.002, 0.004, 0.05])
        boxes.append((i, f"z{i}", lat, lat + side, lon, lon + side))
    boxes += [(5000, "degree", 40.0, 41.0, 5.0, 6.0), (6000, "sea", -30.0, 60.0, -170.0, 170.0)]
    points = [(40 + rng.random(), 5 + rng.random()) for _ in range(3000)]
    points += [(None, 5.0), (40.5, None), (0.0, 0.0), (89.0, 0.0), (40.0, 5.0), (41.0, 6.0)]
    table = spark.createDataFrame(boxes, "priority int, zone string, lat_lo double, lat_hi double, lon_lo double, lon_hi double")
    df = spark.createDataFrame(points, "latitude double, longitude double")
    found = with_zone_table(df, table)
    assert found.columns == ["latitude", "longitude", "zone"]

    def first(lat, lon):
        if lat is None or lon is None:
            return "unknown"
        return next((b[1] for b in boxes if b[2] <= lat <= b[3] and b[4] <= lon <= b[5]), "other")

    assert sorted(map(str, found.collect())) == sorted(
        f"Row(latitude={lat}, longitude={lon}, zone={first(lat, lon)!r})" for lat, lon in points
    )


def test_event_time(spark):
    texts = [
        ("2024-01-15 14:00:00.123456789 +0000 UTC", datetime(2024, 1, 15, 14, 0, 0, 123456)),
        ("2024-01-15 14:00:00 +0000 UTC", datetime(2024, 1, 15, 14)),
        ("2024-01-15 14:00:00.5", datetime(2024, 1, 15, 14, 0, 0, 500000)),
        ("2024-01-15T14:00:00Z", datetime(2024, 1, 15, 14)),
        ("soon", None),
        (None, None),
    ]
    rows = spark.createDataFrame(texts, "t string, expected timestamp")
    assert [r[0] for r in rows.select(times.event_time(F.col("t"))).collect()] == [e for _, e in texts]


def test_python_text(spark):
    stamps = [datetime(2024, 1, 15, 14), datetime(2024, 1, 15, 14, 0, 0, 500), datetime(2024, 1, 1, 0, 0, 0, 120000)]
    rows = spark.createDataFrame([(s, str(s)) for s in stamps], "t timestamp, expected string")
    assert rows.filter(times.python_text(F.col("t")) != F.col("expected")).collect() == []
