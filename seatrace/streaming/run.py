"""Command line of the streams.

``python -m seatrace.streaming.run zone_stats --logs DIR --checkpoint DIR [--files DIR]``

Broker, boxes, message types and where positions start come from the environment. With
``--files`` messages are read from a folder of text files instead of the broker.
``fold`` merges the closed batches of all logs.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from seatrace.operators.messages import filter_messages, flatten_positions, parse_messages
from seatrace.session import build_session
from seatrace.settings import bounding_boxes, message_types, stream_settings
from seatrace.sources.streams import read_message_files, read_topic
from seatrace.streaming import jobs
from seatrace.streaming.profiles import StoredProfiles


def positions(spark: SparkSession, job: str, files: str | None) -> DataFrame:
    """Flat positions of the subscribed boxes and message types."""
    raw = read_message_files(spark, files, arrival=True) if files else read_topic(spark, **stream_settings(job))
    kept = filter_messages(parse_messages(raw), bounding_boxes(), message_types())
    return flatten_positions(kept)


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run a stream, or fold its logs.")
    parser.add_argument("job", choices=["positions", "zone_stats", "alerts", "fold"])
    parser.add_argument("--logs", required=True, help="folder of the logs")
    parser.add_argument("--checkpoint", help="checkpoint folder of the stream")
    parser.add_argument("--profiles", help="vessel profile table, for alerts")
    parser.add_argument("--files", help="folder of message files instead of the broker")
    parser.add_argument("--once", action="store_true", help="stop when all there is has been read")
    options = parser.parse_args(arguments)
    spark = build_session(f"vessel positions: {options.job}")
    logs = options.logs.rstrip("/")
    if options.job == "fold":
        print({kind: jobs.fold(spark, kind, f"{logs}/{kind}") for kind in jobs.FOLDS})
        return
    if not options.checkpoint or (options.job == "alerts" and not options.profiles):
        parser.error("a stream needs --checkpoint, and alerts need --profiles")
    trigger = {"availableNow": True} if options.once else None
    rows = positions(spark, options.job, options.files)
    if options.job == "positions":
        query = jobs.start_live_positions(
            rows, f"{logs}/track", f"{logs}/latest", options.checkpoint, trigger
        )
    elif options.job == "zone_stats":
        query = jobs.start_zone_stats(rows, f"{logs}/zone_stats", options.checkpoint, trigger)
    else:
        query = jobs.start_alerts(
            rows,
            StoredProfiles(spark, f"{logs}/profiles", lambda: spark.read.parquet(options.profiles)),
            f"{logs}/alerts",
            options.checkpoint,
            trigger,
        )
    query.awaitTermination()


if __name__ == "__main__":
    main()
