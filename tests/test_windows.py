"""Zone windows as sums: late rows, replays, folding, longer windows."""

import random
import shutil

import pytest
from pyspark.sql import functions as F

from seatrace.plans.traffic import (
    SKETCH_ERROR,
    WINDOW_KEY,
    longer_windows,
    stats_of_sums,
    united,
    zone_stats,
    zone_sums,
)
from seatrace.streaming import windows
from tests.test_plans import positions
from tests.test_streaming import ONCE, Feed, same

DAY = 86400


def some_rows(seed=3, days=4, n=300):
    rng = random.Random(seed)
    return [
        (rng.randrange(1, 6), rng.randrange(days * DAY), 38.0, rng.choice([1.0, 7.0, 15.0]), rng.randrange(80) / 4)
        for _ in range(n)
    ]


@pytest.fixture
def run(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in")

    def deliver(*parts, checkpoint="c", window="1 hour"):
        for part in parts:
            feed.send(part)
            windows.start_zone_windows(
                feed.stream(), str(tmp_path / "log"), str(tmp_path / checkpoint), ONCE, window
            ).awaitTermination()
        return str(tmp_path / "log")

    return deliver


def stats(spark, log):
    return windows.read_zone_windows(spark, log).drop("approx_vessels", windows.LATE)


def test_rows_in_any_order_count(spark, run):
    everything = some_rows()
    parts = [everything[i::5] for i in range(5)]
    log = run(*parts)
    same(stats(spark, log), zone_stats(positions(spark, everything), "1 hour"))


def test_folding_changes_nothing(spark, run, tmp_path):
    everything = some_rows(4)
    parts = [everything[i::6] for i in range(6)]
    expected = zone_stats(positions(spark, everything), "1 hour")
    log = run(*parts[:2])
    assert windows.fold_windows(spark, log) == 1 and windows.fold_windows(spark, log) == 0
    run(*parts[2:4])
    late = windows.read_zone_windows(spark, log).agg(F.sum(windows.LATE)).first()[0]
    assert windows.fold_windows(spark, log) == 2
    assert windows.read_zone_windows(spark, log).agg(F.sum(windows.LATE)).first()[0] == late > 0
    run(*parts[4:])
    same(stats(spark, log), expected)
    assert windows.fold_windows(spark, log) == 2
    same(stats(spark, log), expected)


def test_a_crash_between_folding_and_removal_counts_once(spark, run, tmp_path):
    everything = some_rows(5)
    log = run(everything[::3], everything[1::3])
    shutil.copytree(f"{log}/batches", tmp_path / "kept")
    assert windows.fold_windows(spark, log) == 1
    shutil.copytree(tmp_path / "kept", f"{log}/batches", dirs_exist_ok=True)
    expected = zone_stats(positions(spark, everything[::3] + everything[1::3]), "1 hour")
    same(stats(spark, log), expected)
    assert windows.fold_windows(spark, log) == 1  # again, with nothing new in it
    same(stats(spark, log), expected)
    run(everything[2::3])
    same(stats(spark, log), zone_stats(positions(spark, everything), "1 hour"))


def test_a_replayed_batch_replaces_its_sums(spark, run, tmp_path):
    everything = some_rows(6)
    log = run(everything[::2], everything[1::2])
    before = sorted(spark.read.parquet(f"{log}/batches").drop("written_at", "vessels").collect(), key=str)
    commits = tmp_path / "c" / "commits"
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    (commits / str(last)).unlink()
    (commits / f".{last}.crc").unlink(missing_ok=True)
    run([])
    after = spark.read.parquet(f"{log}/batches").drop("written_at", "vessels")
    assert sorted(after.collect(), key=str) == before


def test_a_second_query_adds_to_the_first(spark, run):
    everything = some_rows(7)
    log = run(everything[::2])
    windows.fold_windows(spark, log)
    run([], checkpoint="other")  # reads the same files again, as a query of its own
    doubled = positions(spark, everything[::2] * 2)
    same(stats(spark, log), zone_stats(doubled, "1 hour"))


def test_late_windows_are_corrected_and_only_their_days_opened(spark, run):
    on_time = [(1, d * DAY + h * 3600, 38.0, 1.0, 4.0) for d in range(20) for h in range(24)]
    late = [(2, 3 * DAY + 7200, 38.0, 1.0, 8.0), (2, 3 * DAY + 7300, 38.0, 7.0, 2.0)]
    log = run(on_time, late, [(1, 20 * DAY, 38.0, 1.0, 4.0)])
    found = windows.read_late_windows(spark, log)
    everything = zone_stats(positions(spark, on_time + late), "1 hour")
    touched = everything.join(found.select("zone", "window_start"), ["zone", "window_start"], "left_semi")
    same(found.drop("approx_vessels", windows.LATE), touched)
    assert {(r.zone, r.vessel_count, r.late_messages) for r in found.collect()} == {
        ("alboran", 2, 1), ("balearic", 1, 1)
    }
    opened = [f for part in windows.late_folders(spark, log) for f in part]
    assert len(opened) == 2 and all("2024-01-18" in f or "date=" in f for f in opened)
    assert len({f.rpartition("date=")[2] for f in opened}) == 1
    # days on time add no folder
    assert len(list(spark.read.parquet(f"{log}/batches").select("date").distinct().collect())) == 21


def test_nothing_late_and_nothing_at_all(spark, run, tmp_path):
    assert windows.read_zone_windows(spark, str(tmp_path / "none")) is None
    assert windows.fold_windows(spark, str(tmp_path / "none")) == 0
    log = run([(1, 10, 38.0, 1.0, 4.0)], [(1, 20, 38.0, 1.0, 4.0)])
    assert windows.read_late_windows(spark, log) is None


def test_lateness_is_known_after_a_restart(spark, run):
    """The newest time comes from the log, folded or not, not from the process."""
    log = run([(1, 5 * DAY, 38.0, 1.0, 4.0)])
    run([(1, 6 * DAY, 38.0, 1.0, 4.0)])
    windows.fold_windows(spark, log)
    run([(2, 0, 38.0, 1.0, 4.0)])
    assert windows.read_late_windows(spark, log).first()[windows.LATE] == 1


def test_sums_of_parts_and_longer_windows_unite(spark):
    rows = positions(spark, some_rows(8, days=1, n=500))
    parts = [rows.filter(f"mmsi % 2 = {k}") for k in (0, 1)]
    both = zone_sums(parts[0], "10 seconds").union(zone_sums(parts[1], "10 seconds"))
    one = both.groupBy(*WINDOW_KEY).agg(*united())
    same(stats_of_sums(one).drop("approx_vessels"), zone_stats(rows, "10 seconds"))
    same(stats_of_sums(longer_windows(one, "1 hour")).drop("approx_vessels"), zone_stats(rows, "1 hour"))


def test_sketches_of_many_vessels_stay_within_their_error(spark):
    rows = spark.range(60_000).select(
        (F.col("id") % 30_000).cast("int").alias("mmsi"),
        (F.lit("2024-01-15").cast("timestamp") + F.make_dt_interval(secs=F.col("id") % 3600)).alias("recorded_at"),
        F.lit(38.0).alias("latitude"), F.lit(1.0).alias("longitude"), F.lit(1.0).alias("speed"),
    )
    hour = stats_of_sums(longer_windows(zone_sums(rows), "1 hour")).first()
    assert abs(hour.approx_vessels - 30_000) <= 3 * SKETCH_ERROR * 30_000
