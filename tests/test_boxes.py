"""Box reads along the Z curve, and zones over the 180th meridian."""

import random

import pytest
from pyspark.sql import functions as F

from seatrace.functions.cells import cell_id, cell_text
from seatrace.functions.zones import Zone
from seatrace.operators.zone_join import with_zone, with_zone_table
from seatrace.plans.boxes import cell_ranges, in_ranges, tiles_in_box_by_range, write_tiles
from seatrace.plans.reads import tiles_in_box
from seatrace.session import ensure_checkpoint_dir


def tiles(spark, n=4000):
    rng = random.Random(3)
    points = spark.createDataFrame(
        [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(n)], "lat double, lon double"
    )
    layers = [
        points.select(
            F.lit(p).alias("precision"), cell_text(cell_id(F.col("lat"), F.col("lon"), p), p).alias("cell"),
            "lat", "lon", F.lit("2024-01-15").cast("date").alias("date"),
        )
        for p in (5, 6)
    ]
    return layers[0].union(layers[1])


@pytest.fixture(scope="module")
def table(spark):
    ensure_checkpoint_dir(spark)
    return tiles(spark).checkpoint()


BOXES = [
    (36.0, 41.0, -6.0, 14.0), (-90.0, 90.0, -180.0, 180.0), (0.0, 0.0, 0.0, 0.0), (-1.0, 1.0, -1.0, 1.0),
    (89.9, 90.0, 179.9, 180.0), (10.0, 5.0, 0.0, 1.0), (-33.3, 44.4, 100.1, 100.2),
]


@pytest.mark.parametrize("box", BOXES)
@pytest.mark.parametrize("most", [1, 7, 60])
def test_ranges_hold_every_cell_of_the_box(spark, table, box, most):
    expected = sorted(tiles_in_box(table, *box).collect())
    assert sorted(tiles_in_box_by_range(table, *box, most=most).collect()) == expected
    for precision in (5, 6):
        ranges = cell_ranges(*box, precision, most)
        assert len(ranges) <= most
        assert all(a <= b for a, b in ranges) and all(b < c for (_, b), (c, _) in zip(ranges, ranges[1:]))


def test_more_ranges_hold_less(spark, table):
    held = [table.filter(in_ranges(36.0, 41.0, -6.0, 14.0, most=n)).count() for n in (1, 4, 16, 64)]
    assert held == sorted(held, reverse=True) and held[-1] < held[0] / 4


def test_row_groups_are_skipped(spark, tmp_path):
    """Rows that leave the scan, as it counts them: most row groups are never read."""
    path = str(tmp_path / "tiles")
    write_tiles(tiles(spark, 200_000), path, row_group_bytes=16_384)
    stored = spark.read.parquet(path)
    box = (36.0, 41.0, -6.0, 14.0)
    found = tiles_in_box_by_range(stored, *box)
    assert "cell" in str(found._jdf.queryExecution().executedPlan().toString()).split("PushedFilters")[1]
    rows = found.collect()
    assert sorted(rows) == sorted(tiles_in_box(stored, *box).collect()) and rows

    def scanned(df):
        plan = df._jdf.queryExecution().executedPlan()
        df.collect()
        scan = plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
        leaf = scan.collectLeaves().head()
        return leaf.metrics().apply("numOutputRows").value()

    # without codegen's vectorised reader rows are counted as they leave the row groups
    assert scanned(found.select("cell")) < 0.25 * stored.count()


@pytest.mark.parametrize("points", [[(0.0, x) for x in (-180.0, -175.0, -170.0, -169.0, 0.0, 169.0, 170.0, 175.0, 180.0, None)]])
def test_boxes_over_the_meridian(spark, points):
    zones = [Zone(2, "date line", -10.0, 10.0, 170.0, -170.0), Zone(1, "east", -5.0, 5.0, 178.0, 180.0)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i int, latitude double, longitude double")
    expected = ["date line"] * 3 + ["other"] * 3 + ["date line"] * 2 + ["east", "unknown"]
    for found in (with_zone(df, zones), with_zone_table(df, spark.createDataFrame(zones))):
        assert [r.zone for r in found.orderBy("i").collect()] == expected


def test_forms_agree_on_random_boxes(spark):
    rng = random.Random(5)
    corner = lambda limit: rng.choice([rng.uniform(-limit, limit), float(round(rng.uniform(-limit, limit)))])
    zones = []
    for i in range(25):
        lat = sorted((corner(90), corner(90)))
        zones.append(Zone(i, f"z{i}", *lat, corner(180), corner(180)))
    rows = [(i, corner(90), corner(180)) for i in range(500)]
    df = spark.createDataFrame(rows, "i int, latitude double, longitude double")
    one = sorted(with_zone(df, zones).collect())
    assert one == sorted(with_zone_table(df, spark.createDataFrame(zones)).select(with_zone(df, zones).columns).collect())
    assert len({r.zone for r in one}) > 5


def test_latitudes_the_wrong_way_round_raise(spark):
    wrong = [Zone(1, "upside down", 10.0, -10.0, 0.0, 5.0)]
    df = spark.createDataFrame([(0.0, 1.0)], "latitude double, longitude double")
    with pytest.raises(ValueError, match="upside down"):
        with_zone(df, wrong)
    with pytest.raises(Exception, match="upside down"):
        with_zone_table(df, spark.createDataFrame(wrong)).collect()
