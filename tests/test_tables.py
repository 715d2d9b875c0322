"""Sinks: upsert, logs, settled positions, daily jobs."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from seatrace import jobs, schema
from seatrace.operators.lookup import lookup_join
from seatrace.plans.profiles import merged_profiles, speed_moments, vessel_profiles
from seatrace.sources import tables
from seatrace.sources.folders import folders
from seatrace.sources.tables import (
    drop_batch,
    expire_dates,
    fold_log,
    read_log,
    read_positions_for_date,
    read_table,
    settle_positions,
    upsert,
    write_batch,
)
from tests.test_plans import START, positions

DAY1, DAY2 = date(2024, 1, 15), date(2024, 1, 16)


def table(spark, rows):
    return spark.createDataFrame(rows, "zone string, date date, n int")


def plain(df):
    return sorted(tuple(r) for r in df.select("zone", "date", "n").collect())


def test_upsert(spark, tmp_path):
    path, keys = str(tmp_path / "t"), ["zone", "date"]
    assert read_table(spark, path) is None
    first = [("a", DAY1, 1), ("b", DAY1, 2), ("a", DAY2, 3)]
    upsert(table(spark, first), path, keys, ["date"], ["zone"])
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "date=2024-01-16").iterdir()}
    rerun = [("a", DAY1, 9), ("c", DAY1, 4)]
    for _ in range(2):  # the second run changes nothing
        upsert(table(spark, rerun), path, keys, ["date"], ["zone"])
        assert plain(read_table(spark, path)) == [("a", DAY1, 9), ("a", DAY2, 3), ("b", DAY1, 2), ("c", DAY1, 4)]
    assert untouched == {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "date=2024-01-16").iterdir()}
    upsert(table(spark, []), path, keys, ["date"])
    assert read_table(spark, path).count() == 4


def test_upsert_reads_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(table(spark, [("a", DAY1, 1), ("a", DAY2, 3)]), path, ["zone", "date"], ["date"])
    (tmp_path / "t" / "date=2024-01-16" / "part-broken.parquet").write_bytes(b"not parquet")
    read = lambda: spark.read.schema("zone string, n int, date date").parquet(path)
    with pytest.raises(Exception):
        read().collect()
    upsert(table(spark, [("a", DAY1, 2)]), path, ["zone", "date"], ["date"])
    assert read().filter(F.col("date") == DAY1).first().n == 2


def test_upsert_refuses_repeated_keys_and_missing_columns(spark, tmp_path):
    path, keys = str(tmp_path / "t"), ["zone", "date"]
    upsert(table(spark, [("a", DAY1, 1)]), path, keys, ["date"])
    with pytest.raises(ValueError, match="repeat"):
        upsert(table(spark, [("b", DAY1, 1), ("b", DAY1, 2)]), path, keys, ["date"])
    with pytest.raises(ValueError, match="columns"):
        upsert(table(spark, [("b", DAY1, 1)]).drop("n"), path, keys, ["date"])
    assert plain(read_table(spark, path)) == [("a", DAY1, 1)]


def test_upsert_that_dies_while_replacing_loses_nothing(spark, tmp_path, monkeypatch):
    path, keys = str(tmp_path / "t"), ["zone", "date"]
    upsert(table(spark, [("a", DAY1, 1), ("b", DAY1, 2)]), path, keys, ["date"])
    real = tables._overwrite_partitions

    def dies(df, where, partition_by):
        for file in (tmp_path / "t" / "date=2024-01-15").iterdir():
            file.unlink()  # the old partition is gone, the new one not there yet
        raise RuntimeError("lost")

    monkeypatch.setattr(tables, "_overwrite_partitions", dies)
    with pytest.raises(RuntimeError):
        upsert(table(spark, [("a", DAY1, 5), ("c", DAY1, 3)]), path, keys, ["date"])
    monkeypatch.setattr(tables, "_overwrite_partitions", real)
    upsert(table(spark, [("d", DAY2, 4)]), path, keys, ["date"])
    assert plain(read_table(spark, path)) == [("a", DAY1, 5), ("b", DAY1, 2), ("c", DAY1, 3), ("d", DAY2, 4)]


def test_log_replay_and_versions(spark, tmp_path):
    path, keys = str(tmp_path / "log"), ["zone", "date"]
    assert read_log(spark, path, keys) is None
    write_batch(table(spark, [("a", DAY1, 1), ("b", DAY1, 2)]), path, 9, ["date"])
    write_batch(table(spark, [("a", DAY1, 5)]), path, 10, ["date"])
    for _ in range(2):
        assert plain(read_log(spark, path, keys)) == [("a", DAY1, 5), ("b", DAY1, 2)]
        write_batch(table(spark, [("a", DAY1, 5)]), path, 10, ["date"])
    # a query with a new checkpoint counts from 0 again
    write_batch(table(spark, [("c", DAY1, 3)]), path, 9, ["date"], "other")
    assert plain(read_log(spark, path, keys)) == [("a", DAY1, 5), ("b", DAY1, 2), ("c", DAY1, 3)]


def test_replays_that_shrink_or_turn_out_empty(spark, tmp_path):
    path, keys = str(tmp_path / "log"), ["zone", "date"]
    write_batch(table(spark, [("a", DAY1, 1), ("a", DAY2, 2)]), path, 0, ["date"])
    write_batch(table(spark, [("a", DAY2, 2)]), path, 0, ["date"])
    assert plain(read_log(spark, path, keys)) == [("a", DAY2, 2)]
    write_batch(table(spark, [("b", DAY2, 2)]), path, 1, ["date"])
    write_batch(table(spark, []), path, 0, ["date"])
    assert plain(read_log(spark, path, keys)) == [("b", DAY2, 2)]
    drop_batch(spark, path, 1)
    assert read_log(spark, path, keys) is None or read_log(spark, path, keys).count() == 0


def test_folding_keeps_rows_and_bounds_folders(spark, tmp_path):
    path, keys = str(tmp_path / "log"), ["zone", "date"]
    expected = {}
    for query in ("one", "two"):
        for batch in range(7):
            rows = [(z, d, batch + 10 * (query == "two")) for z in "ab" for d in (DAY1, DAY2) if batch % 3]
            write_batch(table(spark, rows), path, batch, ["date"], query)
            expected |= {r[:2]: r[2] for r in rows}
            if batch % 3 == 2:
                fold_log(spark, path, keys, ["date"])
                assert len(folders(spark, f"{path}/batches/*/*")) <= 2
            if expected:
                assert {r[:2]: r[2] for r in plain(read_log(spark, path, keys))} == expected
    fold_log(spark, path, keys, ["date"])
    assert len(folders(spark, f"{path}/batches/*/*")) == 2
    assert {r[:2]: r[2] for r in plain(read_log(spark, path, keys))} == expected
    # a late replay of a batch that stayed
    write_batch(table(spark, [("a", DAY1, 99)]), path, 6, ["date"], "two")
    assert ("a", DAY1, 99) in plain(read_log(spark, path, keys))


def test_profiles_from_daily_moments(spark, tmp_path):
    rows = [(m, t * 5000, 38.0, 1.0, 1e6 + (m * t * 37 % 100) / 4) for m in (1, 2, 3) for t in range(60)]
    df = positions(spark, rows + [(4, 0, 38.0, 1.0, 5.0), (5, 0, 38.0, 1.0, None)])
    dated = df.withColumn("date", F.to_date("recorded_at"))
    whole = {r.mmsi: r for r in vessel_profiles(df).collect()}
    merged = {r.mmsi: r for r in merged_profiles(speed_moments(dated)).collect()}
    assert merged.keys() == whole.keys() == {1, 2, 3, 4}
    for mmsi, r in whole.items():
        assert merged[mmsi].avg_speed == pytest.approx(r.avg_speed, rel=1e-12)
        assert merged[mmsi].speed_std_dev == (None if mmsi == 4 else pytest.approx(r.speed_std_dev, rel=1e-9))


def test_expired_dates_are_removed(spark, tmp_path):
    path = str(tmp_path / "p")
    days = [DAY1 + timedelta(days=i) for i in range(4)]
    spark.createDataFrame([(1, d) for d in days], "n int, date date").write.partitionBy("date").parquet(path)
    as_of = datetime(2024, 2, 16, 12)
    assert expire_dates(spark, path, as_of) == ["2024-01-15", "2024-01-16"]
    assert sorted(r.date for r in spark.read.parquet(path).collect()) == days[2:]


def test_settled_positions(spark, tmp_path):
    log, path = str(tmp_path / "log"), str(tmp_path / "positions")
    rows = positions(spark, [(m, t, 38.0, 1.0, float(t)) for m in (1, 2) for t in range(50)]).withColumn("date", F.lit(DAY1))
    write_batch(rows.withColumn("speed", F.lit(0.0)).limit(30), log, 0, ["date"])
    write_batch(rows, log, 1, ["date"])
    settled = settle_positions(spark, log, path, DAY1)
    assert settled.count() == 100 == settled.select(*schema.KEYS["positions"]).distinct().count()
    assert settled.agg(F.sum("speed")).first()[0] == 2 * sum(range(50))
    scan = read_positions_for_date(spark, path, DAY1, require_speed=True)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and scan.count() == 100
    assert read_positions_for_date(spark, path, DAY2).count() == 0


def test_lookup_join_with_a_hot_key(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), "id")
    keyed = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    found = {r.id: r.v for r in lookup_join(rows, keyed, ["k"], "left").collect()}
    assert found == {i: 2 if i % 3 == 0 else (2 * i if i < 4000 else None) for i in range(5000)}


def test_lookup_join_repeats_no_table_row_and_splits_a_hot_key(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = spark.range(200_000, numPartitions=8).select(
            F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("x")
        )
        keyed = spark.range(300_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        joined = lookup_join(rows, keyed, ["k"], "left")
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan and "Generate" not in plan and "Broadcast" not in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_daily_jobs(spark, tmp_path):
    rows = [(m, t * 600, 38.0, 1.0 + (t % 2), 4.0) for m in (1, 2, 3) for t in range(20)]
    rows += [(1, 86400 + t * 600, 38.0, 1.0 + (t % 2), 4.0) for t in range(20)] + [(9, 0, 0.0, 0.0, 1.0)]
    stored = positions(spark, rows).withColumn("date", F.to_date("recorded_at"))
    stored.write.partitionBy("date").parquet(str(tmp_path / "positions"))
    table_of = lambda name: spark.read.parquet(f"{tmp_path}/tables/{name}")
    source = spark.read.parquet(str(tmp_path / "positions"))
    for day in (DAY1, DAY2, DAY1):
        for name in jobs.JOBS:
            run = jobs.run_job(spark, name, source, str(tmp_path / "tables"), day)
            read = (60 if day == DAY1 else 20) + (name == "vessel_profiles" and day == DAY1)
            assert (run["status"], run["rows_read"]) == ("succeeded", read)
    for name, keys in schema.KEYS.items():
        if name in ("route_segments", "zone_traffic_hourly", "zone_traffic_daily", "heatmap_tiles", "vessel_profiles", "speed_moments", "zone_hours", "zone_rollup", "job_runs"):
            df = table_of(name)
            assert 0 < df.count() == df.select(*keys).distinct().count(), name
    assert {r.window_date for r in table_of("route_segments").collect()} == {DAY1, DAY2}
    runs = table_of("job_runs")
    expected = 2 * len(jobs.JOBS)
    assert runs.count() == expected and runs.filter("status = 'succeeded'").count() == expected
    written = runs.filter("job_name = 'heatmap'").agg(F.sum("rows_written")).first()[0]
    assert written == table_of("heatmap_tiles").count()


def test_failed_job_is_logged_and_raised(spark, tmp_path):
    broken = spark.range(1).select(F.lit(1).alias("mmsi"))
    with pytest.raises(Exception):
        jobs.run_job(spark, "routes", broken, str(tmp_path), DAY1)
    log = spark.read.parquet(f"{tmp_path}/job_runs").first()
    assert (log.status, log.rows_written) == ("failed", None)


def test_command_line(spark, tmp_path, capsys):
    stored = positions(spark, [(1, 0, 38.0, 1.0, 4.0)]).withColumn("date", F.lit(DAY1))
    stored.write.partitionBy("date").parquet(str(tmp_path / "p"))
    jobs.main(["zone_traffic", "--positions", str(tmp_path / "p"), "--tables", str(tmp_path / "t"), "--date", "2024-01-15"])
    assert "succeeded" in capsys.readouterr().out
    assert spark.read.parquet(f"{tmp_path}/t/zone_traffic_hourly").count() == 1
    jobs.main(["expire", "--positions", str(tmp_path / "p"), "--tables", str(tmp_path / "t"), "--date", "2024-03-01"])
    assert not list((tmp_path / "p").glob("date=*"))
