"""Streaming sources of raw messages (A1, A2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatrace.settings import DEFAULT_TOPIC


def broker_options(
    broker: str,
    topic: str = DEFAULT_TOPIC,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool | None = None,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": broker,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if fail_on_data_loss is not None:
        options["failOnDataLoss"] = str(fail_on_data_loss).lower()
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_topic(spark: SparkSession, broker: str, **options) -> DataFrame:
    """Subscribe to one topic (A1); the connector package must be on the cluster.

    Keeps the broker's own ``timestamp`` as fallback event time and its ``offset`` as order of
    arrival; messages of a vessel share a partition.
    """
    reader = spark.readStream.format("kafka").options(**broker_options(broker, **options))
    return reader.load().select("value", "timestamp", "offset")


def read_message_files(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None, arrival: bool = False
) -> DataFrame:
    """The same messages from a folder of text files, one JSON document per line.

    With ``arrival``, a message has what the broker would add, from its file: the time of the
    file's last change as ``timestamp``, and that time, the file's name and the place of the
    block in it as ``offset``, the order of arrival. A later file thus arrives later.
    """
    reader = spark.readStream.schema("value string").format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    messages = reader.load(path)
    if not arrival:
        return messages
    changed = F.col("_metadata.file_modification_time")
    return messages.select(
        "value",
        changed.alias("timestamp"),
        F.struct(
            changed.alias("changed"),
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("start"),
        ).alias("offset"),
    )
