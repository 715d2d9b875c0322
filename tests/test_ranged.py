"""Previous rows over range partitions: keys of any size, and tasks of equal size."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from seatrace.operators.previous import with_previous
from seatrace.operators.ranged import with_previous_ranged
from seatrace.plans.routes import route_segments
from seatrace.session import ensure_checkpoint_dir
from tests.test_plans import START, positions

SCHEMA = "mmsi int, port string, at timestamp, x int"


def made(seed, n):
    rng = random.Random(seed)
    return [
        (rng.choice([None, 1, 1, 1, 1, 2, 3]), rng.choice([None, "a", "b"]), START + timedelta(seconds=rng.randrange(5000)), i)
        for i in range(n)
    ]


def expected(rows, where=lambda x, old: True):
    out, before = [], {}
    for mmsi, port, at, x in sorted(rows, key=lambda r: (r[2], r[3])):
        old = before.get((mmsi, port))
        if where(x, old):
            out.append((mmsi, port, at, x, old))
        before[mmsi, port] = x
    return sorted(out, key=repr)


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = with_previous_ranged(df, ["mmsi", "port"], "at", ["x"], ["x"], **options)
    assert got.columns == ["mmsi", "port", "at", "x", "prev_x"]
    return sorted(map(tuple, got.collect()), key=repr)


@pytest.mark.parametrize("n", [0, 1, 2, 9, 400])
@pytest.mark.parametrize("batch", ["10000", "7"])
def test_equals_the_sequential_walk(spark, n, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        rows = made(n, n)
        assert found(spark, rows) == expected(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")


def test_where_sees_rows_at_the_edges(spark):
    rows = made(5, 600)
    assert found(spark, rows, where=F.col("prev_x") > F.col("x")) == expected(
        rows, lambda x, old: old is not None and old > x
    )


def test_partitions_without_rows(spark):
    """More partitions than rows: carries pass over the empty ones."""
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = made(6, 12)
        assert found(spark, rows) == expected(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_one_vessels_ten_minutes_hold_most_rows(spark):
    """Nine tenths of the rows in one slice of the other operator: tasks have equal shares,
    and routes come out the same."""
    rng = random.Random(7)
    rows = [(1, rng.random() * 600, 38.0, rng.choice([1.0, 1.2, 1.4]), 5.0) for _ in range(9000)]
    rows += [(rng.randrange(2, 40), rng.random() * 80000, 38.0, rng.choice([1.0, 1.2]), 5.0) for _ in range(1000)]
    ensure_checkpoint_dir(spark)
    df = positions(spark, rows).withColumn("date", F.to_date("recorded_at")).checkpoint()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ranged = with_previous_ranged(df, ["mmsi", "date"], "recorded_at", ["longitude"])
        share = [r["count"] for r in ranged.groupBy(F.spark_partition_id()).count().collect() if r["count"] > 8]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(share) >= 9900 and max(share) <= 2 * sorted(share)[len(share) // 2]
    plain = with_previous(df, ["mmsi", "date"], "recorded_at", ["longitude"])
    key = lambda d: sorted(map(str, d.select("mmsi", "recorded_at", "prev_longitude").collect()))
    assert key(ranged) == key(plain)
    assert sorted(route_segments(df, slice_seconds=None).collect()) == sorted(route_segments(df).collect())
