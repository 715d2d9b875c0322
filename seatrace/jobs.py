"""Daily batch jobs: read the position table, merge into a result table, log the run.

``python -m seatrace.jobs routes --positions DIR --tables DIR [--date 2024-01-15]``
The date defaults to ``BATCH_DATE`` or yesterday; ``--all-dates`` takes every date.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence
from datetime import date, datetime, timedelta, timezone
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from seatrace import schema
from seatrace.operators.clean import RETENTION_DAYS, clean_positions, on_date, with_date
from seatrace.plans.heatmap import heatmap_pyramid
from seatrace.plans.profiles import merged_profiles, speed_moments
from seatrace.plans.rollup import zone_hours, zone_rollup
from seatrace.plans.routes import route_segments
from seatrace.plans.traffic import daily_traffic, hourly_traffic, sightings, vessel_hours
from seatrace.session import build_session
from seatrace.settings import batch_date
from seatrace.sources.tables import expire_dates, read_table, upsert

RUN_LOG = "job_runs"


Counted = Callable[[DataFrame], DataFrame]


class Output(NamedTuple):
    table: str
    partition_by: list[str]
    sort_by: list[str]


# Layout follows the reads: a date is a folder, hot rows come first in it.
ROUTES = Output("route_segments", ["window_date"], ["cell_from", "cell_to"])
HOURLY = Output("zone_traffic_hourly", ["date"], ["zone", "hour"])
DAILY = Output("zone_traffic_daily", ["date"], ["zone"])
HOURS = Output("zone_hours", ["date"], ["zone", "hour", "bucket"])
ROLLUP = Output("zone_rollup", ["period", "period_start"], ["zone"])
# the cell's text follows a Z curve, so a box is a few ranges of it (plans/boxes.py)
TILES = Output("heatmap_tiles", ["precision", "date"], ["cell"])
MOMENTS = Output("speed_moments", ["date"], ["mmsi"])
PROFILES = Output("vessel_profiles", ["part"], ["mmsi"])


POSITION_COLUMNS = ["mmsi", "date", "recorded_at", "latitude", "longitude", "speed"]


def _routes(positions: DataFrame, target: date | None, counted: Counted, tables: str):
    rows = clean_positions(
        with_date(positions), target, enforce_global_bounds=True, select_columns=POSITION_COLUMNS
    )
    yield ROUTES, route_segments(counted(rows))


def _traffic(positions: DataFrame, target: date | None, counted: Counted, tables: str):
    rows = clean_positions(
        with_date(positions), target, require_speed=True, select_columns=POSITION_COLUMNS
    )
    hours = vessel_hours(sightings(counted(rows))).persist()
    try:
        yield HOURLY, hourly_traffic(hours)
        yield DAILY, daily_traffic(hours)
    finally:
        hours.unpersist()


def _rollup(positions: DataFrame, target: date | None, counted: Counted, tables: str):
    """Hours of the day with their vessels as bitmaps, then the periods that the day is part
    of, from stored hours alone: positions of other days are not read again."""
    rows = clean_positions(
        with_date(positions), target, require_speed=True, select_columns=POSITION_COLUMNS
    )
    yield HOURS, zone_hours(sightings(counted(rows)))
    stored = read_table(positions.sparkSession, f"{tables}/{HOURS.table}")
    if stored is not None:
        if target is not None:
            monday = target - timedelta(days=target.weekday())
            stored = stored.filter(F.col("date").between(monday, monday + timedelta(days=6)))
        yield ROLLUP, zone_rollup(stored)


def _heatmap(positions: DataFrame, target: date | None, counted: Counted, tables: str):
    rows = clean_positions(
        with_date(positions),
        target,
        enforce_global_bounds=True,
        select_columns=["date", "mmsi", "latitude", "longitude"],
    )
    yield TILES, heatmap_pyramid(counted(rows))


def _profiles(positions: DataFrame, target: date | None, counted: Counted, tables: str):
    """Moments of the day's speeds, then profiles from all stored days: positions of other
    days are not read again. Days that ``expire`` removes leave the profiles."""
    rows = with_date(positions) if target is None else on_date(positions, target)
    yield MOMENTS, speed_moments(counted(rows.select("mmsi", "date", "speed").dropna(subset=["mmsi"])))
    stored = read_table(positions.sparkSession, f"{tables}/{MOMENTS.table}")
    if stored is not None:
        yield PROFILES, merged_profiles(stored).withColumn("part", F.pmod("mmsi", F.lit(64)))


JOBS: dict[str, Callable] = {
    "routes": _routes,
    "zone_traffic": _traffic,
    "zone_rollup": _rollup,
    "heatmap": _heatmap,
    "vessel_profiles": _profiles,
}


def run_job(
    spark: SparkSession, name: str, positions: DataFrame, tables: str, target: date | None = None
) -> dict:
    """Run one job, merge its outputs under ``tables`` and log the run.

    Row counts are observed while the job runs, not counted by extra passes; rows are
    counted after cleaning, so the count does not keep filters from the scan. A failed
    run is logged as such and raised.
    """
    started = datetime.now(timezone.utc)
    read = Observation()

    def counted(rows: DataFrame) -> DataFrame:
        return rows.observe(read, F.count(F.lit(1)).alias("n"))

    run = {"job_name": name, "run_date": target or started.date(), "started_at": started}
    written = 0
    try:
        for output, result in JOBS[name](positions, target, counted, tables):
            wrote = Observation()
            stamped = result.withColumn("updated_at", F.lit(started)).observe(
                wrote, F.count(F.lit(1)).alias("n")
            )
            upsert(
                stamped,
                f"{tables}/{output.table}",
                schema.KEYS[output.table],
                output.partition_by,
                output.sort_by,
            )
            written += wrote.get["n"]
        run.update(status="succeeded", rows_read=read.get["n"], rows_written=written)
    except Exception:
        run["status"] = "failed"
        raise
    finally:
        run["finished_at"] = datetime.now(timezone.utc)
        _log_run(spark, run, f"{tables}/{RUN_LOG}")
    return run


def expire(spark: SparkSession, positions: str, tables: str, as_of: date, days: int = RETENTION_DAYS) -> dict:
    """Remove date folders past retention from the position table and the moments."""
    return {path: expire_dates(spark, path, as_of, days) for path in (positions, f"{tables}/{MOMENTS.table}")}


def _log_run(spark: SparkSession, run: dict, path: str) -> None:
    columns = (
        "job_name string, run_date date, started_at timestamp, finished_at timestamp, "
        "status string, rows_read bigint, rows_written bigint"
    )
    names = ["job_name", "run_date", "started_at", "finished_at", "status", "rows_read", "rows_written"]
    row = spark.createDataFrame([tuple(run.get(name) for name in names)], columns)
    row = row.withColumn("month", F.trunc("run_date", "month"))
    upsert(row, path, schema.KEYS[RUN_LOG], ["month"])


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run a daily batch job.")
    parser.add_argument("job", choices=[*sorted(JOBS), "expire"])
    parser.add_argument("--positions", required=True, help="position table, partitioned by date")
    parser.add_argument("--tables", required=True, help="folder of the result tables")
    parser.add_argument("--date", type=date.fromisoformat, default=None)
    parser.add_argument("--all-dates", action="store_true")
    options = parser.parse_args(arguments)
    target = None if options.all_dates else options.date or batch_date()
    spark = build_session(f"vessel positions: {options.job}")
    if options.job == "expire":
        today = options.date or datetime.now(timezone.utc).date()
        print(expire(spark, options.positions, options.tables, today))
        return
    positions = spark.read.parquet(options.positions)
    print(run_job(spark, options.job, positions, options.tables, target))


if __name__ == "__main__":
    main()
