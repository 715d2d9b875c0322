"""Zone traffic of days and weeks from stored hours, held against direct counts."""

import random
from datetime import date

from pyspark.sql import functions as F

from seatrace import jobs
from seatrace.operators.clean import with_date
from seatrace.plans.rollup import rolled_up, zone_hours, zone_rollup
from seatrace.plans.traffic import daily_traffic, sightings, vessel_hours
from seatrace.session import ensure_checkpoint_dir
from seatrace.sources.tables import read_table
from tests.test_plans import positions

DAY = 86400


def some(spark, seed=1, n=800):
    """Vessel numbers around bucket borders, hours shared by many."""
    rng = random.Random(seed)
    vessels = [1, 2, 32768, 32769, 65536, 65537, 200000001, 999999999]
    return positions(
        spark,
        [(rng.choice(vessels), rng.randrange(9 * DAY), 38.0, rng.choice([1.0, 7.0]), rng.randrange(80) / 4) for _ in range(n)],
    )


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_days_equal_the_direct_counts(spark):
    found = sightings(some(spark))
    days = rolled_up(zone_hours(found), "day").select(
        "zone", F.col("period_start").alias("date"), "vessel_count", "avg_speed", "max_speed", "message_count",
        F.hour("peak_hour").alias("peak_hour"), "peak_count",
    )
    assert rows(days) == rows(daily_traffic(found))


def test_weeks_and_months_equal_distinct_counts(spark):
    found = sightings(some(spark, 2))
    for period in ("week", "month"):
        direct = found.groupBy("zone", F.trunc("date", period).alias("start")).agg(
            F.count_distinct("mmsi"), F.sum("message_count"), F.max("max_speed")
        )
        got = rolled_up(zone_hours(vessel_hours(found)), period)
        assert rows(got.select("zone", "period_start", "vessel_count", "message_count", "max_speed")) == rows(direct)


def test_a_tie_takes_the_earliest_hour(spark):
    df = positions(spark, [(m, h * 3600, 38.0, 1.0, 4.0) for h in (5, 3, 9) for m in (1, 2)])
    row = rolled_up(zone_hours(sightings(df)), "day").first()
    assert (row.peak_hour.hour, row.peak_count, row.vessel_count) == (3, 2, 2)


def test_no_rows(spark):
    assert zone_rollup(zone_hours(sightings(some(spark).filter("false")))).collect() == []


def test_a_day_brings_its_week_up_to_date_without_reading_others(spark, tmp_path):
    """Days one by one, one of them twice with more rows; positions of other days are gone."""
    ensure_checkpoint_dir(spark)
    df, tables = with_date(some(spark, 3)).checkpoint(), str(tmp_path / "tables")
    days = [date(2024, 1, d) for d in range(15, 24)]
    early = df.filter(F.col("mmsi") < 100)
    jobs.run_job(spark, "zone_rollup", early.filter(F.col("date") == days[2]), tables, days[2])
    for day in days:
        jobs.run_job(spark, "zone_rollup", df.filter(F.col("date") == day), tables, day)
    stored = read_table(spark, f"{tables}/zone_rollup").drop("updated_at")
    expected = zone_rollup(zone_hours(sightings(df)))
    assert rows(stored.select(expected.columns)) == rows(expected)


def test_an_hour_has_a_row_per_bucket_however_often_its_vessels_report(spark):
    df = positions(spark, [(1 + m, i % 3600, 38.0, 1.0, 4.0) for i in range(500) for m in range(3)])
    assert zone_hours(sightings(df)).count() == 1
