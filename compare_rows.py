"""Compare native plans with the same work done by row UDFs and a driver-side collect.

``python compare_rows.py POSITIONS_DIR`` where the folder holds a position table.
The row-at-a-time variants are written here only to be measured against.
"""

from __future__ import annotations

import math
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bench import build_session
from seatrace.functions.cells import DIGITS
from seatrace.functions.zones import SEA_ZONES
from seatrace.operators.clean import clean_positions
from seatrace.plans.alerts import stopped_alerts
from seatrace.plans.heatmap import heatmap_pyramid
from seatrace.plans.routes import route_segments
from seatrace.plans.traffic import sightings, vessel_hours, hourly_traffic, daily_traffic

RUNS = 3


def zone_name(lat, lon):
    if lat is None or lon is None:
        return "unknown"
    for z in SEA_ZONES:
        if z.lat_lo <= lat <= z.lat_hi and z.lon_lo <= lon <= z.lon_hi:
            return z.zone
    return "other"


def cell_name(precision: int) -> Callable:
    def name(lat, lon):
        ranges, value, number = [[-180.0, 180.0], [-90.0, 90.0]], (lon, lat), 0
        for bit in range(5 * precision):
            low, high = ranges[bit % 2]
            middle = (low + high) / 2
            above = value[bit % 2] > middle
            ranges[bit % 2] = [middle, high] if above else [low, middle]
            number = number * 2 + above
        return "".join(DIGITS[number >> 5 * i & 31] for i in range(precision - 1, -1, -1))

    return name


def traffic_rows(positions: DataFrame) -> int:
    zone = F.udf(zone_name, "string")
    rows = (
        clean_positions(positions, require_speed=True)
        .withColumn("zone", zone("latitude", "longitude"))
        .withColumn("hour", F.date_trunc("hour", "recorded_at"))
        .filter("zone <> 'unknown'")
    )
    measures = [F.count_distinct("mmsi").alias("v"), F.avg("speed"), F.max("speed"), F.count("mmsi")]
    hourly = rows.groupBy("zone", "hour").agg(*measures)
    daily = rows.groupBy("zone", "date").agg(*measures)
    by_hour = rows.groupBy("zone", "date", F.hour("hour").alias("h")).agg(F.count_distinct("mmsi").alias("n"))
    place = F.row_number().over(Window.partitionBy("zone", "date").orderBy(F.desc("n"), "h"))
    peak = by_hour.withColumn("place", place).filter("place = 1")
    return len(hourly.collect()) + len(daily.join(peak, ["zone", "date"], "left").collect())


def tile_rows(positions: DataFrame) -> int:
    rows = clean_positions(positions, enforce_global_bounds=True).select("mmsi", "date", "latitude", "longitude").cache()
    total = 0
    for precision in (5, 6):
        cell = F.udf(cell_name(precision), "string")
        tiles = rows.withColumn("cell", cell("latitude", "longitude")).groupBy("date", "cell").agg(
            F.count("mmsi").alias("n"), F.count_distinct("mmsi")
        ).collect()
        top = {}
        for r in tiles:
            top[r.date] = max(top.get(r.date, 0), r.n)
        total += len([math.log1p(r.n) / math.log1p(top[r.date]) for r in tiles])
    rows.unpersist()
    return total


def route_rows(positions: DataFrame) -> int:
    cell = F.udf(cell_name(5), "string")
    rows = clean_positions(positions, enforce_global_bounds=True).withColumn("cell", cell("latitude", "longitude"))
    before = F.lag("cell").over(Window.partitionBy("mmsi", "date").orderBy("recorded_at"))
    moves = rows.withColumn("before", before).filter("before <> cell")
    counted = moves.groupBy("date", "before", "cell").agg(F.count("*").alias("n"), F.avg("speed"))
    return len(counted.filter("n >= 2").collect())


def stopped_rows(positions: DataFrame) -> int:
    found = 0
    for r in positions.select("mmsi", "speed", "nav_status").filter("mmsi is not null").toLocalIterator():
        found += r.speed == 0 and r.nav_status not in (1, 5)
    return found


def written(*results: DataFrame) -> None:
    for df in results:
        df.write.format("noop").mode("overwrite").save()


def native_traffic(positions: DataFrame) -> None:
    hours = vessel_hours(sightings(positions)).persist()
    written(hourly_traffic(hours), daily_traffic(hours))
    hours.unpersist()


CASES = {
    "zone_traffic hourly + daily": (traffic_rows, native_traffic),
    "heatmap_tiles p5 + p6": (tile_rows, lambda p: written(heatmap_pyramid(p))),
    "route_segments": (route_rows, lambda p: written(route_segments(p))),
    "alerts_stopped": (stopped_rows, lambda p: written(stopped_alerts(p))),
}


def median(run: Callable, positions: DataFrame) -> float:
    run(positions)
    taken = []
    for _ in range(RUNS):
        started = time.perf_counter()
        run(positions)
        taken.append(time.perf_counter() - started)
    return statistics.median(taken)


def main() -> None:
    spark: SparkSession = build_session()
    for name, (by_row, native) in CASES.items():
        positions = spark.read.parquet(sys.argv[1])
        print(f"{name}: rows {median(by_row, positions):.2f} s, native {median(native, positions):.2f} s", flush=True)


if __name__ == "__main__":
    main()
