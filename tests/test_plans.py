"""Batch plans on small rows with known answers, and on skewed rows against plain models."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from seatrace.functions.geo import haversine_km
from seatrace.operators.clean import clean_positions, expire_positions
from seatrace.operators.latest import latest_positions, to_key_value, unexpired
from seatrace.operators.previous import with_previous
from seatrace.plans import reads
from seatrace.plans.alerts import detect_alerts, speed_alerts, stopped_alerts
from seatrace.plans.heatmap import heatmap_pyramid, heatmap_tiles
from seatrace.plans.profiles import vessel_profiles
from seatrace.plans.routes import route_segments
from seatrace.plans.traffic import daily_traffic, hourly_traffic, sightings, vessel_hours, zone_stats, zone_traffic

START = datetime(2024, 1, 15)
SCHEMA = (
    "mmsi int, ship_name string, latitude double, longitude double, speed double, "
    "course double, heading int, nav_status int, recorded_at timestamp"
)


def positions(spark, rows):
    """Rows as (mmsi, seconds, lat, lon, speed[, nav_status])."""
    full = [
        (r[0], f"V{r[0]}", r[2], r[3], r[4], 0.0, 0, r[5] if len(r) > 5 else 0, START + timedelta(seconds=r[1]))
        for r in rows
    ]
    return spark.createDataFrame(full, SCHEMA)


def test_null_island_and_bounds(spark):
    points = [(0.0, 0.0), (0.001, -0.001), (0.0, 5.0), (0.0011, 0.0), (90.0, 180.0), (-90.0, -180.0), (91.0, 0.0), (0.5, 180.5), (None, 1.0)]
    df = positions(spark, [(i, i, lat, lon, None) for i, (lat, lon) in enumerate(points)])
    ids = lambda d: sorted(r.mmsi for r in d.collect())
    assert ids(clean_positions(df)) == [2, 3, 4, 5, 6, 7]
    assert ids(clean_positions(df, enforce_global_bounds=True)) == [2, 3, 4, 5]
    assert ids(clean_positions(df, null_island_delta=0.01)) == [2, 4, 5, 6, 7]
    assert ids(clean_positions(df, require_speed=True)) == []
    assert ids(clean_positions(df, "2024-01-16")) == []
    assert clean_positions(df, "2024-01-15", select_columns=["mmsi"]).columns == ["mmsi"]


def test_retention_bound(spark):
    df = positions(spark, [(1, 0, 1.0, 1.0, 1.0), (2, 1, 1.0, 1.0, 1.0)])
    as_of = START + timedelta(days=30, seconds=1)
    assert [r.mmsi for r in expire_positions(df, as_of).collect()] == [2]
    assert expire_positions(df, START + timedelta(days=30)).count() == 2


def test_traffic(spark):
    rows = [(m, h * 3600 + i, 38.0, -1.0, 4.0 * i) for h in (3, 5) for m in (1, 2) for i in range(3)]
    rows += [(3, 9 * 3600, 38.0, -1.0, 30.0), (4, 60, 50.0, 50.0, 1.0), (5, 60, 38.0, -1.0, None)]
    rows += [(1, 86400 + 7200, 38.0, -1.0, 2.0)]
    df = positions(spark, rows)
    hourly, daily = zone_traffic(df)
    by_hour = {(r.zone, r.hour.day, r.hour.hour): r for r in hourly.collect()}
    assert set(by_hour) == {("gibraltar", 15, 3), ("gibraltar", 15, 5), ("gibraltar", 15, 9), ("other", 15, 0), ("gibraltar", 16, 2)}
    three = by_hour["gibraltar", 15, 3]
    assert (three.vessel_count, three.avg_speed, three.max_speed, three.message_count) == (2, 4.0, 8.0, 6)
    first = next(r for r in daily.collect() if r.zone == "gibraltar" and r.date.day == 15)
    # two hours tie with two vessels each: the earlier one
    assert (first.vessel_count, first.message_count, first.peak_hour, first.peak_count) == (3, 13, 3, 2)
    hours = vessel_hours(sightings(df))
    for one, other in ((hourly, hourly_traffic(hours)), (daily, daily_traffic(hours))):
        assert sorted(one.collect()) == sorted(other.collect())
    total = {r.zone: r.n for r in hourly.groupBy("zone").agg(F.sum("message_count").alias("n")).collect()}
    assert total == {r.zone: r.n for r in daily.groupBy("zone").agg(F.sum("message_count").alias("n")).collect()}


def test_zone_stats(spark):
    df = positions(spark, [(1, 0, 38.0, 1.0, 2.0), (1, 9, 38.0, 1.0, 4.0), (2, 10, 38.0, 1.0, None), (3, 1, 0.0, 0.0, 1.0), (4, 1, None, 1.0, 1.0)])
    found = {(r.zone, r.window_start.second): r for r in zone_stats(df, approx_vessels=True).collect()}
    assert set(found) == {("alboran", 0), ("alboran", 10), ("other", 0)}  # null island counts as other
    assert (found["alboran", 0].vessel_count, found["alboran", 0].avg_speed, found["alboran", 0].approx_vessels) == (2, 3.0, 1)
    assert found["alboran", 10].avg_speed == 0.0
    assert found["alboran", 0].timestamp == found["alboran", 0].window_end


def test_routes_small(spark):
    a, b = (38.0, 1.0), (38.0, 2.0)
    rows = [(1, 0, *a, 1.0), (1, 60, *a, 9.0), (1, 700, *b, 2.0), (1, 90000, *a, 5.0)]  # next day starts anew
    rows += [(2, 0, *a, 1.0), (2, 60, *b, 4.5), (2, 120, *a, 1.0)]  # b to a only once
    rows += [(3, 0, *a, 1.0), (3, 30, *a, 1.0)]
    found = route_segments(positions(spark, rows)).collect()
    assert [(r["count"], r.avg_speed, r.window_date.day) for r in found] == [(2, 3.25, 15)]
    assert abs(found[0].lat_from - 38.0) < 0.03 and abs(found[0].lon_to - 2.0) < 0.03
    assert route_segments(positions(spark, rows), max_segment_km=80.0).count() == 0
    assert route_segments(positions(spark, rows), max_segment_km=100.0).count() == 1
    assert route_segments(positions(spark, rows), "2024-01-16").count() == 0


def test_haversine(spark):
    point = spark.range(1).select(haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0))).first()[0]
    assert abs(point - 10007.557) < 0.01


@pytest.mark.parametrize("slice_seconds", [1, 60, 600, 86400])
def test_previous_with_a_hot_key(spark, slice_seconds):
    """One vessel holds most rows; gaps, ties and slice borders all occur."""
    rng = random.Random(slice_seconds)
    rows = [(1, rng.randrange(5000), rng.randrange(4)) for _ in range(3000)]
    rows += [(m, rng.randrange(86400), rng.randrange(4)) for m in range(2, 40) for _ in range(10)]
    df = spark.createDataFrame([(m, START + timedelta(seconds=t), c) for m, t, c in rows], "mmsi int, at timestamp, cell int")
    expected = []
    last = {}
    for m, t, c in sorted(rows):
        expected.append((m, t, c, last.get(m)))
        last[m] = c
    seconds = (F.unix_seconds("at") - F.unix_seconds(F.lit(START).cast("timestamp"))).alias("t")
    key = lambda r: (r[0], r[1], r[2], -1 if r[3] is None else r[3])
    for where, keep in ((None, lambda r: True), (F.col("prev_cell") != F.col("cell"), lambda r: r[3] is not None and r[3] != r[2])):
        found = with_previous(df, ["mmsi"], "at", ["cell"], ["cell"], where, slice_seconds)
        got = [tuple(r) for r in found.select("mmsi", seconds, "cell", "prev_cell").collect()]
        assert sorted(got, key=key) == sorted(filter(keep, expected), key=key)


def test_heatmap(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(5), i, rng.choice([38.0, 38.02, 38.04, 39.0]), rng.choice([1.0, 1.03]), 1.0) for i in range(300)]
    rows.append((1, 90000, 38.0, 1.0, 1.0))
    df = positions(spark, rows)
    fine, coarse = heatmap_tiles(df, 6), heatmap_tiles(df, 5)
    assert sorted(heatmap_pyramid(df).collect()) == sorted(fine.collect() + coarse.collect())
    for tiles in (fine, coarse):
        for day in (15, 16):
            assert max(r.intensity for r in tiles.collect() if r.date.day == day) == 1.0
    summed = {(r.c, r.date): r.n for r in fine.groupBy(F.substring("cell", 1, 5).alias("c"), "date").agg(F.sum("count").alias("n")).collect()}
    assert summed == {(r.cell, r.date): r["count"] for r in coarse.collect()}
    assert heatmap_tiles(df.limit(0), 5).collect() == []


def test_stopped(spark):
    df = positions(spark, [(1, 0, 1.0, 1.0, 0.0, 0), (2, 0, 1.0, 1.0, 0.0, None), (3, 0, 1.0, 1.0, 0.0, 1), (4, 0, 1.0, 1.0, 0.0, 5), (5, 0, 1.0, 1.0, None, 0)])
    assert sorted(r.mmsi for r in stopped_alerts(df).collect()) == [1, 2]


def test_abnormal(spark):
    rows = [(1, 0, 1.0, 1.0, 5.0), (1, 1, 1.0, 1.0, 14.0), (1, 2, 1.0, 1.0, 14.5), (2, 0, 1.0, 1.0, 99.0), (3, 0, 1.0, 1.0, 25.0), (3, 1, 1.0, 1.0, 25.25), (4, 0, 1.0, 1.0, 0.0)]
    profiles = spark.createDataFrame([(1, 10.0, 2.0), (3, None, None), (4, 1.0, None)], "mmsi int, avg_speed double, speed_std_dev double")
    df = positions(spark, rows)
    found = {(r.mmsi, r.speed): r.expected_speed for r in speed_alerts(df, profiles).collect()}
    assert found == {(1, 14.5): 10.0, (3, 25.25): 15.0}
    both = detect_alerts(df, profiles)
    apart = stopped_alerts(df).unionByName(speed_alerts(df, profiles))
    assert sorted(both.collect(), key=str) == sorted(apart.collect(), key=str) and both.count() == 3


def test_alert_id_text(spark):
    import hashlib

    df = positions(spark, [(7, 0, 1.0, 1.0, 0.0)])
    expected = hashlib.sha256(f"7_{START}_stopped".encode()).hexdigest()
    assert stopped_alerts(df).first().alert_id == expected


def test_profile_of_a_single_point(spark):
    row = vessel_profiles(positions(spark, [(1, 0, 1.0, 1.0, 8.0), (1, 1, 1.0, 1.0, None)])).first()
    assert (row.avg_speed, row.speed_std_dev) == (8.0, None)


def test_latest(spark):
    df = positions(spark, [(1, 10, 1.0, 1.0, 1.0), (1, 20, 2.0, 1.0, None), (2, 5, 0.0005, 1.0, 1.0), (None, 99, 1.0, 1.0, 1.0)])
    latest = latest_positions(df)
    assert {(r.mmsi, r.latitude, r.speed) for r in latest.collect()} == {(1, 2.0, None), (2, 0.0005, 1.0)}
    assert [r.mmsi for r in unexpired(latest, START + timedelta(seconds=305)).collect()] == [1]
    import json

    value = json.loads(to_key_value(latest).filter("key = 'vessel:1'").first().value)
    assert value == {
        "mmsi": 1, "ship_name": "V1", "latitude": 2.0, "longitude": 1.0, "speed": None, "course": 0.0,
        "heading": 0, "nav_status": 0, "updated_at": str(START + timedelta(seconds=20)),
    }


def test_reads_prune_and_limit(spark):
    daily = spark.createDataFrame([("a", START.date(), 3), ("b", START.date(), 3), ("c", START.date(), 9)], "zone string, date date, vessel_count bigint")
    assert [r.zone for r in reads.busiest_zones(daily, 2, START.date()).orderBy("place").collect()] == ["c", "a"]
    plan = reads.busiest_zones(daily, 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
