"""Movement alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatrace.functions.times import python_text
from seatrace.operators.lookup import lookup_join
from seatrace.operators.suppress import QUIET_SECONDS, suppress
from seatrace.session import ensure_checkpoint_dir

# Alert names, severities, id suffixes, thresholds and profile defaults.
STOPPED = ("vessel_stopped_at_sea", "high", "stopped")
ABNORMAL = ("abnormal_speed", "medium", "speed")
ANCHORED_OR_MOORED = (1, 5)
MIN_SPEED = 5.0
MAX_DEVIATIONS = 2.0
DEFAULT_SPEED = 15.0
DEFAULT_STD_DEV = 5.0

POSITION_FIELDS = ["mmsi", "ship_name", "latitude", "longitude", "speed"]


def _is_stopped() -> Column:
    """Speed 0 without a status that explains it; an unknown status qualifies."""
    status = F.col("nav_status")
    return (F.col("speed") == 0) & (status.isNull() | ~status.isin(*ANCHORED_OR_MOORED))


def _is_abnormal() -> Column:
    """Speed far from the vessel's own mean, both bounds strict; false without profile."""
    deviation = F.abs(F.col("speed") - F.col("expected_speed"))
    return (F.col("speed") > MIN_SPEED) & (deviation > MAX_DEVIATIONS * F.col("std_dev"))


def _expectations(profiles: DataFrame) -> DataFrame:
    return profiles.select(
        "mmsi",
        F.coalesce("avg_speed", F.lit(DEFAULT_SPEED)).alias("expected_speed"),
        F.coalesce("speed_std_dev", F.lit(DEFAULT_STD_DEV)).alias("std_dev"),
    )


def _alerts(rows: DataFrame, kind: Column, expected_speed: Column) -> DataFrame:
    """Shape rows as alerts; rows whose ``kind`` is null raise none."""
    identity = F.concat_ws(
        "_", F.col("mmsi"), python_text(F.col("recorded_at")), F.col("kind.suffix")
    )
    return (
        rows.withColumn("kind", kind)
        .filter(F.col("kind").isNotNull())
        .select(
            F.sha2(identity, 256).alias("alert_id"),
            F.col("kind.type").alias("type"),
            F.col("kind.severity").alias("severity"),
            *POSITION_FIELDS,
            expected_speed.cast("double").alias("expected_speed"),
            F.col("recorded_at").alias("timestamp"),
            F.lit(False).alias("resolved"),
        )
    )


def _kind(parts: tuple[str, str, str]) -> Column:
    return F.struct(
        *[F.lit(part).alias(name) for part, name in zip(parts, ("type", "severity", "suffix"))]
    )


def stopped_alerts(positions: DataFrame) -> DataFrame:
    known = positions.filter(F.col("mmsi").isNotNull() & _is_stopped())
    return _alerts(known, _kind(STOPPED), F.lit(None))


def speed_alerts(positions: DataFrame, profiles: DataFrame) -> DataFrame:
    """Slow rows leave before the lookup, vessels without profile in it."""
    moving = positions.filter(F.col("speed") > MIN_SPEED).select(*POSITION_FIELDS, "recorded_at")
    abnormal = lookup_join(moving, _expectations(profiles), ["mmsi"]).filter(_is_abnormal())
    return _alerts(abnormal, _kind(ABNORMAL), F.col("expected_speed"))


def detect_alerts(positions: DataFrame, profiles: DataFrame) -> DataFrame:
    """Every alert the positions give rise to, before the quiet period.

    No row is both stopped and fast, so one reading and one lookup serve both rules.
    """
    candidates = positions.filter(
        F.col("mmsi").isNotNull() & (_is_stopped() | (F.col("speed") > MIN_SPEED))
    ).select(*POSITION_FIELDS, "nav_status", "recorded_at")
    checked = lookup_join(candidates, _expectations(profiles), ["mmsi"], "left")
    kind = F.when(_is_stopped(), _kind(STOPPED)).when(_is_abnormal(), _kind(ABNORMAL))
    return _alerts(checked, kind, F.when(~_is_stopped(), F.col("expected_speed")))


def emitted_alerts(
    positions: DataFrame, profiles: DataFrame, quiet_seconds: int = QUIET_SECONDS
) -> DataFrame:
    """Alerts that outlive the quiet period per (mmsi, type).

    The quiet period reads the found alerts twice, so they are written once instead of
    scanning all positions again.
    """
    ensure_checkpoint_dir(positions.sparkSession)
    found = detect_alerts(positions, profiles).checkpoint()
    return suppress(found, quiet_seconds=quiet_seconds)
