"""The three streaming jobs (P1 to P3) over flat positions.

Each returns its StreamingQuery (I9); trigger and checkpoint folder are the caller's
(I1, I2). Sinks are logs keyed by query and micro-batch, so a replayed batch changes
nothing, a new checkpoint overwrites nothing, and a failing write fails the batch instead
of losing it. ``fold`` keeps the logs short.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from seatrace import schema
from seatrace.operators.clean import with_date
from seatrace.operators.messages import split_messages
from seatrace.operators.latest import LATEST_TTL_SECONDS, latest_positions, newest_per_key, unexpired
from seatrace.operators.suppress import QUIET_SECONDS, suppress_after
from seatrace.plans.alerts import detect_alerts
from seatrace.plans.traffic import ZONE_WINDOW, zone_stats
from seatrace.sources.tables import (
    NEWER,
    STAMPS,
    drop_batch,
    fold_log,
    read_log,
    read_log_rows,
    write_batch,
)
from seatrace.streaming.profiles import StoredProfiles

# Fixed value: how often the streaming jobs start a micro-batch.
TRIGGER = {"processingTime": "10 seconds"}
WATERMARK = "1 minute"
#: Folders over which the folded latest positions are spread by vessel.
LATEST_PARTS = 16


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark wrote to the checkpoint before the first batch."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def start_batches(
    stream: DataFrame,
    sink: Callable[[DataFrame, int, str], None],
    logs: list[str],
    checkpoint: str,
    trigger: dict | None,
    mode: str = "append",
) -> StreamingQuery:
    """A query whose micro-batches go to ``sink`` with their number and the query's id.

    A batch without rows removes what an earlier try may have left in ``logs``.
    """
    known: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not known:
            known.append(_query_id(spark, checkpoint))
        batch.persist()
        try:
            if batch.isEmpty():
                for log in logs:
                    drop_batch(spark, log, batch_id, known[0])
            else:
                sink(batch, batch_id, known[0])
        finally:
            batch.unpersist()

    return (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or TRIGGER))
        .start()
    )


def start_live_positions(
    positions: DataFrame, track_log: str, latest_log: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Trajectory history and latest position per vessel from one reading."""

    def sink(batch: DataFrame, batch_id: int, query_id: str) -> None:
        _write_live(batch, track_log, latest_log, batch_id, query_id)

    return start_batches(positions, sink, [track_log, latest_log], checkpoint, trigger)


def _write_live(positions: DataFrame, track_log: str, latest_log: str, batch_id: int, query_id: str) -> None:
    write_batch(with_date(positions).drop("arrival"), track_log, batch_id, ["date"], query_id)
    newest = latest_positions(positions).withColumns(
        {
            "hour": F.date_format("updated_at", "yyyy-MM-dd-HH"),
            "part": F.pmod("mmsi", F.lit(LATEST_PARTS)),
        }
    )
    write_batch(newest, latest_log, batch_id, ["hour"], query_id)


def start_live_messages(
    raw: DataFrame, track_log: str, latest_log: str, reject_log: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """``start_live_positions`` from raw messages, with a log of those that make no position.

    Every message is in the track or among the rejects, which keep its text and the reason.
    """

    def sink(batch: DataFrame, batch_id: int, query_id: str) -> None:
        positions, rejects = split_messages(batch)
        _write_live(positions, track_log, latest_log, batch_id, query_id)
        write_batch(rejects, reject_log, batch_id, ["reason"], query_id)

    return start_batches(raw, sink, [track_log, latest_log, reject_log], checkpoint, trigger)


def read_rejects(spark: SparkSession, reject_log: str) -> DataFrame | None:
    """Rejected messages with the reason."""
    rows = read_log_rows(spark, reject_log)
    return None if rows is None else rows.drop(*STAMPS)


def read_latest(spark: SparkSession, latest_log: str) -> DataFrame | None:
    """Latest position of every vessel; late data never moves a vessel back (Q3)."""
    log = read_log_rows(spark, latest_log)
    return None if log is None else _newest(log)


def read_live(
    spark: SparkSession, latest_log: str, as_of: datetime, ttl_seconds: int = LATEST_TTL_SECONDS
) -> DataFrame | None:
    """Unexpired positions (R6); of the batches, opens only the hours that can hold one."""
    log = read_log_rows(spark, latest_log)
    if log is None:
        return None
    oldest = (as_of - timedelta(seconds=ttl_seconds)).strftime("%Y-%m-%d-%H")
    return unexpired(_newest(log.filter(F.col("hour") >= oldest)), as_of, ttl_seconds)


def _newest(log: DataFrame) -> DataFrame:
    version = ["updated_at", *NEWER]
    return newest_per_key(log.drop("hour", "part"), schema.KEYS["latest_positions"], version).drop(*STAMPS)


def read_track(spark: SparkSession, track_log: str) -> DataFrame | None:
    """Trajectory history, one row per (mmsi, date, recorded_at)."""
    return read_log(spark, track_log, schema.KEYS["positions"])


def start_zone_stats(
    positions: DataFrame,
    log: str,
    checkpoint: str,
    trigger: dict | None = None,
    window: str = ZONE_WINDOW,
    watermark: str = WATERMARK,
    approx_vessels: bool = False,
) -> StreamingQuery:
    """Zone statistics per tumbling event-time window.

    Changed windows are emitted on every trigger; state older than the watermark is freed.
    Rows behind it do not reach the state: ``settle_zone_stats`` brings them in from the
    trajectory log.
    """
    stats = zone_stats(positions.withWatermark("recorded_at", watermark), window, approx_vessels)

    def sink(batch: DataFrame, batch_id: int, query_id: str) -> None:
        dated = batch.withColumn("date", F.to_date("window_start"))
        write_batch(dated, log, batch_id, ["date"], query_id)

    return start_batches(stats, sink, [log], checkpoint, trigger, mode="update")


def read_zone_stats(spark: SparkSession, log: str) -> DataFrame | None:
    """Current statistics per (zone, window_start)."""
    stats = read_log(spark, log, schema.KEYS["zone_stats"])
    return None if stats is None else stats.drop("date")


def settle_zone_stats(
    spark: SparkSession, track_log: str, log: str, run_id: int, target_date: date | str | None = None,
    window: str = ZONE_WINDOW,
) -> None:
    """Statistics of finished days from the trajectory log, late rows included.

    They are written as a batch of their own and so replace what the stream had counted.
    ``run_id`` must grow from run to run; a rerun of the same one replaces it.
    """
    track = read_track(spark, track_log)
    if track is None:
        return
    if target_date is not None:
        track = track.filter(F.col("date") == F.lit(str(target_date)).cast("date"))
    settled = zone_stats(track, window).withColumn("date", F.to_date("window_start"))
    write_batch(settled, log, run_id, ["date"], "settled")


def start_alerts(
    positions: DataFrame,
    profiles: Callable[[], DataFrame],
    log: str,
    checkpoint: str,
    trigger: dict | None = None,
    quiet_seconds: int = QUIET_SECONDS,
) -> StreamingQuery:
    """Alerts with a quiet period that spans micro-batches.

    ``profiles`` is called per batch, so a refreshed profile table is seen; ``StoredProfiles``
    are asked for those of the batch's vessels alone. The state of
    the quiet period is the alert log itself: alerts of earlier batches suppress, those of
    this batch do not count, so a replay emits the same rows.
    """

    def sink(batch: DataFrame, batch_id: int, query_id: str) -> None:
        spark = batch.sparkSession
        known = profiles.for_batch(batch) if isinstance(profiles, StoredProfiles) else profiles()
        found = detect_alerts(batch, known).persist()
        try:
            earlier = earlier_alerts(spark, log, batch_id, query_id, _oldest(batch, quiet_seconds))
            emitted = suppress_after(found, earlier, quiet_seconds=quiet_seconds)
            dated = emitted.withColumn("date", F.to_date("timestamp"))
            write_batch(dated, log, batch_id, ["date"], query_id)
        finally:
            found.unpersist()

    return start_batches(positions, sink, [log], checkpoint, trigger)


def _oldest(batch: DataFrame, quiet_seconds: int):
    first = batch.agg(F.min("recorded_at")).first()[0]
    return None if first is None else (first - timedelta(seconds=quiet_seconds)).date()


def earlier_alerts(
    spark: SparkSession, log: str, batch_id: int, query_id: str, since: date | None = None
) -> DataFrame:
    """(mmsi, type, kept_at) of alerts before this batch; opens dates from ``since`` on."""
    alerts = read_log_rows(spark, log)
    if alerts is None:
        return spark.createDataFrame([], "mmsi int, type string, kept_at timestamp")
    before = alerts.filter((F.col("query_id") != query_id) | (F.col("batch_id") < batch_id))
    if since is not None:
        before = before.filter(F.col("date") >= F.lit(since))
    return before.select("mmsi", "type", F.col("timestamp").alias("kept_at"))


def read_alerts(spark: SparkSession, log: str) -> DataFrame | None:
    """All emitted alerts, unique on alert_id."""
    alerts = read_log(spark, log, schema.KEYS["alerts"])
    return None if alerts is None else alerts.drop("date")


#: How each kind of log folds: keys, folders, order in a folder, and what is newer.
FOLDS = {
    "track": (schema.KEYS["positions"], ["date"], ["mmsi", "recorded_at"], NEWER),
    "latest": (schema.KEYS["latest_positions"], ["part"], ["mmsi"], ["updated_at", *NEWER]),
    "zone_stats": ([*schema.KEYS["zone_stats"], "date"], ["date"], ["zone"], NEWER),
    "alerts": ([*schema.KEYS["alerts"], "date"], ["date"], ["mmsi"], NEWER),
}


def fold(spark: SparkSession, kind: str, log: str) -> int:
    """Merge the closed batches of a log of this kind and remove them; returns how many."""
    keys, partition_by, sort_by, version = FOLDS[kind]
    return fold_log(spark, log, keys, partition_by, sort_by, version)
