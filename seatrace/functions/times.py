"""Event-time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_time(text: Column) -> Column:
    """Timestamp of a ``2024-01-15 14:00:00.123456789 +0000 UTC`` text; null if unreadable (Q1).

    The cast knows the numeric offset but not the zone name behind it.
    """
    return F.regexp_replace(text, r"([+-]\d{2}:?\d{2}) [A-Z]+$", "$1").try_cast("timestamp")


def python_text(ts: Column) -> Column:
    """Timestamp as text with six fractional digits, or none on a whole second (Q10)."""
    return F.regexp_replace(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"), r"\.000000$", "")
