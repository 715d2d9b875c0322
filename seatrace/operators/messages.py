"""From raw messages to flat position rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatrace import schema
from seatrace.functions.times import event_time


def parse_messages(raw: DataFrame) -> DataFrame:
    """Parse ``value`` into MetaData, Message and MessageType, keeping other columns.

    A field of the wrong type turns null and its siblings survive; text that is not JSON
    turns into nulls. ``inline`` keeps later filters from being pushed below the parser,
    which would parse each message once per filter.
    """
    others = [F.col(name) for name in raw.columns if name != "value"]
    message = F.from_json(F.col("value").cast("string"), schema.MESSAGE)
    return raw.select(F.inline(F.array(message)), *others)


#: Column in which the parser keeps the text of a message that is not JSON.
CORRUPT = "__corrupt"


def split_messages(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Flat positions, and the messages that make none: value, reason and other columns.

    Reasons: ``empty`` (null or blank text), ``not json``, and ``no vessel`` (no vessel
    number, or one of the wrong type). Each message is in exactly one of the two.
    """
    others = [F.col(name) for name in raw.columns if name != "value"]
    text = F.col("value").cast("string")
    message = F.from_json(
        text, f"{schema.MESSAGE}, {CORRUPT} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    # finished before any filter, so that no message is parsed once per filter
    parsed = raw.select(F.inline(F.array(F.struct(text.alias("value"), message.alias("m")))), *others)
    parsed = parsed.select("value", "m.*", *[F.col(c) for c in raw.columns if c != "value"])
    reason = (
        F.when(F.coalesce(F.trim("value"), F.lit("")) == "", "empty")
        .when(F.col(CORRUPT).isNotNull() & F.col("MetaData").isNull() & F.col("Message").isNull(), "not json")
        .when(F.col("MetaData.MMSI").isNull(), "no vessel")
    )
    judged = parsed.withColumn("reason", reason)
    rejects = judged.filter(F.col("reason").isNotNull()).select(
        "value", "reason", *[c for c in raw.columns if c != "value"]
    )
    return flatten_positions(judged.filter(F.col("reason").isNull())), rejects


def filter_messages(
    parsed: DataFrame,
    boxes: Sequence[Sequence[Sequence[float]]] | None = None,
    types: Sequence[str] | None = None,
) -> DataFrame:
    """Keep messages inside any box and of any listed type; None or empty means no filter.

    A box is two opposite corners ``[[lat, lon], [lat, lon]]``.
    """
    kept = parsed
    if boxes:
        kept = kept.filter(reduce(Column.__or__, [_in_box(box) for box in boxes]))
    if types:
        kept = kept.filter(F.col("MessageType").isin(list(types)))
    return kept


def _in_box(box: Sequence[Sequence[float]]) -> Column:
    (lat_a, lon_a), (lat_b, lon_b) = box
    lat, lon = F.col("MetaData.latitude"), F.col("MetaData.longitude")
    return lat.between(min(lat_a, lat_b), max(lat_a, lat_b)) & lon.between(
        min(lon_a, lon_b), max(lon_a, lon_b)
    )


#: How far a message's own clock may run ahead of its arrival.
CLOCK_TOLERANCE_SECONDS = 300


def flatten_positions(
    parsed: DataFrame, extra: Sequence[str] = (), tolerance_seconds: int = CLOCK_TOLERANCE_SECONDS
) -> DataFrame:
    """One flat row per message that names a vessel.

    ``recorded_at`` is the message's own time. Where that is unreadable, or later than the
    arrival by more than the tolerance, it is the arrival: the broker's ``timestamp`` if the
    source has one, else the time of processing (Q1). The broker's ``offset``, if there is
    one, stays as ``arrival`` and orders messages of equal time. One wrong clock thus moves neither the
    watermark nor its vessel's latest position into the future.
    """
    received = F.col("timestamp") if "timestamp" in parsed.columns else F.current_timestamp()
    own = event_time(F.col("MetaData.time_utc"))
    believed = F.when(own <= received + F.make_dt_interval(secs=F.lit(tolerance_seconds)), own)
    return parsed.select(
        F.col("MetaData.MMSI").alias("mmsi"),
        F.col("MetaData.ShipName").alias("ship_name"),
        F.col("MetaData.latitude").alias("latitude"),
        F.col("MetaData.longitude").alias("longitude"),
        F.col("Message.PositionReport.Sog").alias("speed"),
        F.col("Message.PositionReport.Cog").alias("course"),
        F.col("Message.PositionReport.TrueHeading").alias("heading"),
        F.col("Message.PositionReport.NavigationalStatus").alias("nav_status"),
        F.coalesce(believed, received).alias("recorded_at"),
        *[F.col("offset").alias("arrival") for name in parsed.columns if name == "offset"],
        *[F.col(name) for name in extra],
    ).filter(F.col("mmsi").isNotNull())


def to_messages(
    positions: DataFrame, message_type: Column | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """The message text that parses back into these positions (tests, replays), and ``keep``."""
    time_text = F.concat(
        F.date_format("recorded_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(" +0000 UTC")
    )
    message = F.struct(
        F.struct(
            F.col("mmsi").alias("MMSI"),
            F.col("ship_name").alias("ShipName"),
            "latitude",
            "longitude",
            time_text.alias("time_utc"),
        ).alias("MetaData"),
        F.struct(
            F.struct(
                F.col("speed").alias("Sog"),
                F.col("course").alias("Cog"),
                F.col("heading").alias("TrueHeading"),
                F.col("nav_status").alias("NavigationalStatus"),
            ).alias("PositionReport")
        ).alias("Message"),
        (F.lit("PositionReport") if message_type is None else message_type).alias("MessageType"),
    )
    return positions.select(F.to_json(message).alias("value"), *keep)
