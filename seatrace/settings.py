"""Run-time settings taken from the environment."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from datetime import date, datetime, timedelta, timezone

# Topic name, environment names and defaults that existing deployments use.
DEFAULT_TOPIC = "ais.raw.positions"
DEFAULT_BROKER = "kafka:9092"
DEFAULT_BOXES = [[[30.0, -6.0], [47.0, 37.0]]]
DEFAULT_MESSAGE_TYPES = "PositionReport"


def stream_settings(job: str, env: Mapping[str, str] = os.environ) -> dict[str, object]:
    """Broker, starting offsets and what to do about lost data, for a streaming job (A2).

    Positions are history: a new job begins with all that the broker still has, unless the
    environment says otherwise, and goes on where the broker has dropped some. Zone
    statistics and alerts are about now: they begin with what comes next.
    """
    settings: dict[str, object] = {"broker": env.get("KAFKA_BROKER", DEFAULT_BROKER)}
    if job == "positions":
        settings["starting_offsets"] = env.get("KAFKA_STARTING_OFFSETS", "earliest")
        settings["fail_on_data_loss"] = False
    else:
        settings["starting_offsets"] = "latest"
    return settings


def batch_date(env: Mapping[str, str] = os.environ, now: datetime | None = None) -> date:
    """``BATCH_DATE`` or yesterday in UTC."""
    if env.get("BATCH_DATE"):
        return date.fromisoformat(env["BATCH_DATE"])
    return ((now or datetime.now(timezone.utc)) - timedelta(days=1)).date()


def bounding_boxes(env: Mapping[str, str] = os.environ) -> list:
    """Subscription boxes; text that is not JSON falls back to the default box."""
    try:
        return json.loads(env["AIS_BOUNDING_BOXES_JSON"])
    except (KeyError, json.JSONDecodeError):
        return DEFAULT_BOXES


def message_types(env: Mapping[str, str] = os.environ) -> list[str]:
    """Comma list of message types; an empty list means no filter."""
    listed = env.get("AIS_FILTER_MESSAGE_TYPES", DEFAULT_MESSAGE_TYPES)
    return [name.strip() for name in listed.split(",") if name.strip()]
