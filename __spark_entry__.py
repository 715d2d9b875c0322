"""

The position queries run over the whole ``events`` table, read as vessel positions
(fixtures.py); the training-data queries come from a subpackage that may be absent.
"""

from __future__ import annotations

import sys
import uuid
import warnings
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracles
from fixtures import load_positions
from seatrace import jobs, schema
from seatrace.functions.cells import with_cell, with_cell_center
from seatrace.functions.zones import SEA_ZONES, Zone
from seatrace.operators.clean import clean_positions, expire_positions, with_date
from seatrace.operators.latest import latest_positions, to_key_value, unexpired
from seatrace.operators.messages import (
    filter_messages,
    flatten_positions,
    parse_messages,
    to_messages,
)
from seatrace.operators.zone_join import with_zone, with_zone_table
from seatrace.plans import reads
from seatrace.plans.alerts import detect_alerts, emitted_alerts, speed_alerts, stopped_alerts
from seatrace.plans.boxes import tiles_in_box_by_range, write_tiles
from seatrace.plans.heatmap import heatmap_pyramid, heatmap_tiles
from seatrace.plans.profiles import vessel_profiles
from seatrace.plans.routes import route_segments
from seatrace.plans.traffic import (
    SKETCH_ERROR,
    WINDOW_KEY,
    daily_traffic,
    hourly_traffic,
    longer_windows,
    sightings,
    stats_of_sums,
    zone_stats,
)
from seatrace.session import work_dir
from seatrace.settings import DEFAULT_BOXES
from seatrace.sources.streams import read_message_files
from seatrace.sources.tables import (
    read_log_rows,
    read_table,
    settle_positions,
    upsert,
    write_batch,
)
from seatrace.streaming import jobs as streams
from seatrace.streaming import windows
from seatrace.streaming.alerts import start_alerts_state
from seatrace.streaming.profiles import StoredProfiles
from seatrace.streaming.run_log import StreamRunLog, counted, read_stream_runs

try:  # the training-data operators are a part of their own
    import corpus_pipeline
    from seatrace.llm import registry as training
except ImportError as error:
    if (Path(__file__).resolve().parent / "seatrace/llm/__init__.py").exists():
        warnings.warn(f"no training-data queries: {error}", stacklevel=1)
    training = None

Query = Callable[[SparkSession, str], DataFrame]

ONCE = {"availableNow": True}
DAY = 86400


def _fresh(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _on_positions(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(load_positions(spark, sf_dir))


def _hourly(positions: DataFrame) -> DataFrame:
    return hourly_traffic(sightings(positions))


def _daily(positions: DataFrame) -> DataFrame:
    return daily_traffic(sightings(positions))



def _parsed(positions: DataFrame) -> DataFrame:
    return parse_messages(to_messages(positions, F.col("message_type")))


def _zone_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = load_positions(spark, sf_dir).select("event_id", "latitude", "longitude")
    return with_zone_table(points, spark.createDataFrame(SEA_ZONES))


def _cells(precision: int) -> Query:
    def build(positions: DataFrame) -> DataFrame:
        cleaned = clean_positions(positions, enforce_global_bounds=True)
        return with_cell(cleaned, precision).select("event_id", "cell")

    return _on_positions(build)


def _cell_centers(positions: DataFrame) -> DataFrame:
    cleaned = clean_positions(positions, enforce_global_bounds=True)
    cells = with_cell(cleaned, 6).select("cell").distinct()
    return with_cell_center(cells, 6)


def _speed_alerts(positions: DataFrame) -> DataFrame:
    return speed_alerts(positions, vessel_profiles(positions))


def _alert_ids(positions: DataFrame) -> DataFrame:
    return detect_alerts(positions, vessel_profiles(positions)).select(
        "alert_id", "type", "severity", "mmsi", "timestamp", "resolved"
    )



def _live(positions: DataFrame) -> DataFrame:
    as_of = "2024-01-20 12:00:00"
    seen = positions.filter(F.col("recorded_at") <= F.lit(as_of).cast("timestamp"))
    return unexpired(latest_positions(seen), as_of, 6 * 3600)


def _track(positions: DataFrame) -> DataFrame:
    known = with_date(positions).filter(F.col("mmsi").isNotNull())
    return reads.vessel_track(known.select("mmsi", "date", *schema.POSITION_COLUMNS[1:]))


def _settled_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping batches of the trajectory log, settled, then scanned."""
    log, table = _fresh(spark, "track-log"), _fresh(spark, "positions")
    rows = with_date(load_positions(spark, sf_dir)).filter(F.col("mmsi").isNotNull())
    rows = rows.select(*schema.POSITION_COLUMNS, "date")
    last_days = F.col("date") >= F.lit("2024-01-29").cast("date")
    write_batch(rows.filter(last_days), log, 0, ["date"])
    write_batch(rows, log, 1, ["date"])
    return clean_positions(settle_positions(spark, log, table), enforce_global_bounds=True)


def _upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily traffic of all days, then a rerun of the second half that saw fast vessels only."""
    positions = load_positions(spark, sf_dir)
    table = _fresh(spark, "daily")
    keys = schema.KEYS["zone_traffic_daily"]
    upsert(_daily(positions), table, keys, ["date"])
    late = with_date(positions).filter(F.col("date") >= F.lit("2024-01-15").cast("date"))
    rerun = late.filter((F.col("speed") > 20) & (F.col("longitude") < 12))
    upsert(_daily(rerun), table, keys, ["date"])
    return read_table(spark, table)


def _zone_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days and weeks from stored hours; the hours came in two halves that share a week."""
    positions, tables = with_date(load_positions(spark, sf_dir)), _fresh(spark, "tables")
    half = F.lit("2024-01-17").cast("date")
    for part in (F.col("date") < half, F.col("date") >= half):
        jobs.run_job(spark, "zone_rollup", positions.filter(part), tables)
    return read_table(spark, f"{tables}/zone_rollup").drop("updated_at")


def _job_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run log after all daily jobs over every date."""
    tables = _fresh(spark, "tables")
    positions = load_positions(spark, sf_dir)
    for name in sorted(jobs.JOBS):
        jobs.run_job(spark, name, positions, tables)
    return read_table(spark, f"{tables}/{jobs.RUN_LOG}").select(
        "job_name", "status", "rows_read", "rows_written"
    )


#: Rows of a micro-batch, one after the other: spans of days of January, in order.
SPANS = [
    f"day between {first} and {last}"
    for first, last in ((1, 5), (6, 10), (11, 15), (16, 20), (21, 25), (26, 31))
]


class Feed:
    """Positions as a stream that went through message text; a micro-batch for each delivery.

    A delivery is as many files as the rows are read in, and a query over all there is takes
    them in one micro-batch. The positions are derived once and stored by day, so a delivery of
    some days reads those alone.
    """

    def __init__(
        self, spark: SparkSession, sf_dir: str, positions: DataFrame | None = None, keep: Sequence[str] = ()
    ) -> None:
        self.spark, self.folder = spark, _fresh(spark, "feed")
        rows = load_positions(spark, sf_dir) if positions is None else positions
        known = rows.withColumns({"day": F.dayofmonth("recorded_at"), "number": F.col("event_id")})
        stored = _fresh(spark, "feed-positions")
        known.write.partitionBy("day").parquet(stored)
        table = spark.read.schema(known.schema).parquet(stored)
        self.messages = to_messages(table, None, ["day", "number", *keep])

    def send(self, condition: str) -> None:
        self.messages.filter(condition).select("value").write.mode("append").text(self.folder)

    def positions(self, **options) -> DataFrame:
        return flatten_positions(parse_messages(read_message_files(self.spark, self.folder, **options)))

    def deliver(self, parts: list[str], *starts: Callable[[DataFrame], StreamingQuery], **options) -> None:
        """Send part by part, each followed by a run of every query on its own checkpoint."""
        for part in parts:
            self.send(part)
            for start in starts:
                start(self.positions(**options)).awaitTermination()


def _stream_zone_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, checkpoint = _fresh(spark, "zone-stats"), _fresh(spark, "checkpoint")
    Feed(spark, sf_dir).deliver(SPANS, lambda rows: streams.start_zone_stats(rows, log, checkpoint, ONCE))
    return streams.read_zone_stats(spark, log)


def _stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second half of the month comes under a new checkpoint; both logs are folded."""
    log = _fresh(spark, "zone-stats")
    for spans in (SPANS[:3], SPANS[3:]):
        checkpoint = _fresh(spark, "checkpoint")
        Feed(spark, sf_dir).deliver(
            spans, lambda rows, at=checkpoint: streams.start_zone_stats(rows, log, at, ONCE)
        )
    streams.fold(spark, "zone_stats", log)
    return streams.read_zone_stats(spark, log)


def _stream_zone_stats_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days come in reverse, so most rows are behind the watermark; then days are settled."""
    track, latest, log, one, two = (_fresh(spark, name) for name in ("track", "latest", "zone-stats", "c", "c"))
    backwards = SPANS[::-1]
    Feed(spark, sf_dir).deliver(
        backwards,
        lambda rows: streams.start_zone_stats(rows, log, one, ONCE),
        lambda rows: streams.start_live_positions(rows, track, latest, two, ONCE),
    )
    streams.settle_zone_stats(spark, track, log, 0)
    return streams.read_zone_stats(spark, log)


#: Two deliveries: most rows, then a seventh of the rows of all days, nearly all of them late.
LATE_LAST = ["number % 7 != 0", "number % 7 = 0"]


def _zone_windows(spark: SparkSession, sf_dir: str, parts: list[str], window: str, fold: bool = False) -> str:
    """Log of zone windows after the parts, folded halfway if asked for."""
    log, checkpoint = _fresh(spark, "zone-windows"), _fresh(spark, "checkpoint")
    feed = Feed(spark, sf_dir)
    start = lambda rows: windows.start_zone_windows(rows, log, checkpoint, ONCE, window)
    for at in range(0, len(parts), 3):
        feed.deliver(parts[at : at + 3], start)
        if fold:
            windows.fold_windows(spark, log)
    return log


def _stream_zone_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days come in reverse, and nothing has to be settled."""
    log = _zone_windows(spark, sf_dir, SPANS[::-1], "10 seconds", fold=True)
    return windows.read_zone_windows(spark, log).drop("approx_vessels", windows.LATE)


def _stream_late_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours that late rows have touched, corrected, with the number of late messages."""
    log = _zone_windows(spark, sf_dir, LATE_LAST, "1 hour")
    return windows.read_late_windows(spark, log).drop("approx_vessels")


def _stream_zone_vessels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vessels per zone and hour from the sketches of 10-second windows, held against the
    distinct vessels of the table: within three standard errors of the sketch."""
    log = _zone_windows(spark, sf_dir, SPANS, "10 seconds")
    sums = windows.read_zone_sums(spark, log).select(*WINDOW_KEY, "speed_sum", "speed_count", "messages", "newest", "vessels")
    hours = stats_of_sums(longer_windows(sums, "1 hour"))
    located = with_zone(load_positions(spark, sf_dir).filter(F.col("mmsi").isNotNull()))
    exact = located.groupBy("zone", F.window("recorded_at", "1 hour").alias("w")).agg(
        F.count_distinct("mmsi").alias("vessels")
    )
    exact = exact.select("zone", F.col("w.start").alias("window_start"), "vessels")
    off = F.abs(F.col("approx_vessels") - F.col("vessels"))
    return hours.join(exact, ["zone", "window_start"]).select(
        "zone", "window_start", "vessel_count", "avg_speed", "vessels",
        (off <= F.greatest(F.lit(1.0), 3 * SKETCH_ERROR * F.col("vessels"))).alias("within_bound"),
    )


def _stream_alerts_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quiet period is state of the stream; its log is only written."""
    log, checkpoint, stored = _fresh(spark, "alerts"), _fresh(spark, "checkpoint"), _fresh(spark, "profiles")
    vessel_profiles(load_positions(spark, sf_dir)).write.parquet(stored)
    profiles = lambda: spark.read.parquet(stored)
    Feed(spark, sf_dir).deliver(
        SPANS, lambda rows: start_alerts_state(rows, profiles, log, checkpoint, ONCE, quiet_seconds=DAY)
    )
    return streams.read_alerts(spark, log)


def _stream_latest_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All positions come twice, the second time from later files and faster: of equal times
    the later file wins."""
    track, latest, checkpoint = (_fresh(spark, name) for name in ("track", "latest", "checkpoint"))
    rows = load_positions(spark, sf_dir).withColumn("copy", F.lit(0))
    faster = rows.withColumns({"speed": F.col("speed") + 1, "copy": F.lit(1)})
    feed = Feed(spark, sf_dir, rows.union(faster), ["copy"])
    feed.deliver(
        ["copy = 0", "copy = 1"],
        lambda rows: streams.start_live_positions(rows, track, latest, checkpoint, ONCE),
        arrival=True,
    )
    return streams.read_latest(spark, latest)


def _stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of which some are cut short, blank or without a vessel: each one ends in the
    track or among the rejects. Rows: what became of it, and how many."""
    names = ("track", "latest", "rejects", "checkpoint", "feed")
    track, latest, rejects, checkpoint, folder = (_fresh(spark, name) for name in names)
    rows = load_positions(spark, sf_dir)
    messages = to_messages(rows, None, ["event_id"])
    cut = F.expr("substr(value, 1, length(value) div 2)")
    text = F.when(F.col("event_id") % 53 == 0, cut).when(F.col("event_id") % 59 == 0, " ").otherwise(F.col("value"))
    messages.select(text.alias("value")).write.text(folder)
    streams.start_live_messages(
        read_message_files(spark, folder), track, latest, rejects, checkpoint, ONCE
    ).awaitTermination()
    kept = read_log_rows(spark, track).select(F.lit("position").alias("became"))
    gone = streams.read_rejects(spark, rejects).select(F.col("reason").cast("string").alias("became"))
    return kept.unionByName(gone).groupBy("became").agg(F.count("*").alias("messages"))


def _stream_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that each micro-batch of the zone windows took in, as a listener logged them."""
    log, checkpoint, runs = (_fresh(spark, name) for name in ("zone-windows", "checkpoint", "runs"))
    listener = StreamRunLog(spark, runs)
    spark.streams.addListener(listener)

    def start(rows: DataFrame) -> StreamingQuery:
        query = windows.start_zone_windows(counted(rows), log, checkpoint, ONCE)
        query.awaitTermination()
        listener.wait(query.runId)
        return query

    try:
        Feed(spark, sf_dir).deliver(SPANS, start)
    finally:
        spark.streams.removeListener(listener)
    return read_stream_runs(spark, runs).select("batch_id", "rows_in", "state_rows")


def _tiles_box_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The box of ``tiles_bbox``, read by cell ranges from tiles stored along the curve."""
    table = _fresh(spark, "tiles")
    write_tiles(heatmap_tiles(load_positions(spark, sf_dir), 6), table)
    return tiles_in_box_by_range(spark.read.parquet(table), 36.0, 41.0, -6.0, 14.0, precisions=[6])


#: Two boxes that cross the 180th meridian: all but the Mediterranean's middle, and less.
WRAPPING = [
    Zone(1, "far", 30.0, 38.0, 18.0, -2.0),
    Zone(2, "wide", 30.0, 45.0, 9.0, 1.0),
    Zone(3, "rest", 30.0, 45.0, 0.0, 20.0),
]


def _zone_lookup_wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones over the 180th meridian, by the fixed and by the table form."""
    points = load_positions(spark, sf_dir).select("event_id", "latitude", "longitude")
    fixed = with_zone(points, WRAPPING).withColumnRenamed("zone", "fixed")
    return with_zone_table(fixed, spark.createDataFrame(WRAPPING))


def _stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    track, latest, checkpoint = (_fresh(spark, name) for name in ("track", "latest", "checkpoint"))
    Feed(spark, sf_dir).deliver(
        SPANS, lambda rows: streams.start_live_positions(rows, track, latest, checkpoint, ONCE)
    )
    streams.fold(spark, "latest", latest)
    return streams.read_latest(spark, latest)


def _stream_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    track, latest, checkpoint = (_fresh(spark, name) for name in ("track", "latest", "checkpoint"))
    Feed(spark, sf_dir).deliver(
        SPANS, lambda rows: streams.start_live_positions(rows, track, latest, checkpoint, ONCE)
    )
    streams.fold(spark, "track", track)
    return streams.read_track(spark, track)


def _stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, checkpoint = _fresh(spark, "alerts"), _fresh(spark, "checkpoint")
    profiles = StoredProfiles(
        spark, _fresh(spark, "profiles"), lambda: vessel_profiles(load_positions(spark, sf_dir))
    )
    Feed(spark, sf_dir).deliver(
        SPANS, lambda rows: streams.start_alerts(rows, profiles, log, checkpoint, ONCE, quiet_seconds=DAY)
    )
    return streams.read_alerts(spark, log)


def _job(name: str, table: str) -> Query:
    """A result table as the job stores it, after a run over every date and a rerun."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = _fresh(spark, "tables")
        for _ in range(2):
            jobs.run_job(spark, name, load_positions(spark, sf_dir), tables)
        return read_table(spark, f"{tables}/{table}").drop("updated_at", "part")

    return query


def _rounded_profiles(profiles: DataFrame) -> DataFrame:
    return profiles.select(
        "mmsi", oracles.spark_round6("avg_speed"), oracles.spark_round6("speed_std_dev")
    )


def _rounded_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn("expected_speed", oracles.spark_round6("expected_speed"))


def _key_values(positions: DataFrame) -> DataFrame:
    """Keys and the JSON values, parsed: two engines print a small double in two ways."""
    fields = (
        "mmsi int, ship_name string, latitude double, longitude double, speed double, "
        "course double, heading int, nav_status int, updated_at string"
    )
    pairs = to_key_value(latest_positions(positions))
    return pairs.select("key", F.from_json("value", fields).alias("v")).select("key", "v.*")


def queries() -> dict[str, Query]:
    found = position_queries()
    if training:
        found |= training.queries() | {"pipeline": corpus_pipeline.run}
    return found


def position_queries() -> dict[str, Query]:
    return {
        "clean_positions": _on_positions(clean_positions),
        "clean_positions_strict": _on_positions(
            lambda p: clean_positions(
                p,
                require_speed=True,
                enforce_global_bounds=True,
                select_columns=["event_id", "mmsi", "latitude", "longitude", "speed"],
            )
        ),
        "settled_position_scan": _settled_scan,
        "parse_flatten": _on_positions(lambda p: flatten_positions(_parsed(p))),
        "filter_messages_bbox": _on_positions(
            lambda p: flatten_positions(
                filter_messages(_parsed(p), DEFAULT_BOXES, ["PositionReport"])
            )
        ),
        "zone_lookup": _on_positions(
            lambda p: with_zone(p.select("event_id", "latitude", "longitude"))
        ),
        "zone_lookup_table": _zone_table,
        "zone_lookup_wrapped": _zone_lookup_wrapped,
        "zone_window_stats": _on_positions(zone_stats),
        "zone_window_stats_1h": _on_positions(lambda p: zone_stats(p, "1 hour")),
        "zone_traffic_hourly": _on_positions(_hourly),
        "zone_traffic_daily": _on_positions(_daily),
        "cell_snap_p5": _cells(5),
        "cell_snap_p6": _cells(6),
        "cell_centers": _on_positions(_cell_centers),
        "heatmap_tiles_p5": _on_positions(lambda p: heatmap_tiles(p, 5)),
        "heatmap_tiles_p6": _on_positions(lambda p: heatmap_tiles(p, 6)),
        "heatmap_pyramid": _on_positions(heatmap_pyramid),
        "route_segments": _on_positions(route_segments),
        "route_segments_max_jump": _on_positions(
            lambda p: route_segments(p, max_segment_km=500.0)
        ),
        "route_segments_ranged": _on_positions(lambda p: route_segments(p, slice_seconds=None)),
        "zone_traffic_rollup": _zone_rollup,
        "vessel_profiles": _on_positions(
            lambda p: _rounded_profiles(vessel_profiles(p))
        ),
        "alerts_stopped": _on_positions(stopped_alerts),
        "alerts_abnormal_speed": _on_positions(
            lambda p: _rounded_alerts(_speed_alerts(p))
        ),
        "alert_ids": _on_positions(_alert_ids),
        "alerts_suppressed": _on_positions(
            lambda p: _rounded_alerts(emitted_alerts(p, vessel_profiles(p), DAY))
        ),
        "alerts_suppressed_5min": _on_positions(
            lambda p: _rounded_alerts(emitted_alerts(p, vessel_profiles(p)))
        ),
        "latest_positions": _on_positions(latest_positions),
        "latest_positions_live": _on_positions(_live),
        "latest_key_values": _on_positions(_key_values),
        "expire_positions": _on_positions(
            lambda p: expire_positions(p, "2024-01-31 00:00:00", 10).drop("date")
        ),
        "top_routes": _on_positions(lambda p: reads.top_routes(route_segments(p), 5)),
        "tiles_hottest": _on_positions(lambda p: reads.hottest_tiles(heatmap_tiles(p, 6))),
        "tiles_bbox": _on_positions(
            lambda p: reads.tiles_in_box(heatmap_tiles(p, 6), 36.0, 41.0, -6.0, 14.0)
        ),
        "tiles_box_ranges": _tiles_box_ranges,
        "zone_hours": _on_positions(lambda p: reads.zone_hours(_hourly(p))),
        "busiest_zones": _on_positions(lambda p: reads.busiest_zones(_daily(p), 3)),
        "zone_trend": _on_positions(lambda p: reads.zone_trend(_daily(p))),
        "vessel_track": _on_positions(_track),
        "upsert_merge": _upsert_merge,
        "job_run_log": _job_runs,
        "job_route_segments": _job("routes", "route_segments"),
        "job_zone_traffic_hourly": _job("zone_traffic", "zone_traffic_hourly"),
        "job_zone_traffic_daily": _job("zone_traffic", "zone_traffic_daily"),
        "job_heatmap_tiles": _job("heatmap", "heatmap_tiles"),
        "job_vessel_profiles": lambda spark, sf_dir: _rounded_profiles(
            _job("vessel_profiles", "vessel_profiles")(spark, sf_dir)
        ),
        "stream_zone_stats": _stream_zone_stats,
        "stream_restart": _stream_restart,
        "stream_zone_stats_late": _stream_zone_stats_late,
        "stream_zone_windows": _stream_zone_windows,
        "stream_late_windows": _stream_late_windows,
        "stream_zone_vessels": _stream_zone_vessels,
        "stream_latest": _stream_latest,
        "stream_track": _stream_track,
        "stream_latest_ties": _stream_latest_ties,
        "stream_rejects": _stream_rejects,
        "stream_run_log": _stream_run_log,
        "stream_alerts_state": lambda spark, sf_dir: _rounded_alerts(_stream_alerts_state(spark, sf_dir)),
        "stream_alerts": lambda spark, sf_dir: _rounded_alerts(_stream_alerts(spark, sf_dir)),
    }


def oracle_sql() -> dict[str, str]:
    found = oracles.statements()
    if training:
        found |= training.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def entry(spark: SparkSession, sf_dir: str = "/root/testdata/sf0.001") -> DataFrame:
    """Hourly traffic per zone."""
    return _hourly(load_positions(spark, sf_dir))
