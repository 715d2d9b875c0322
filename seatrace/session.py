"""Session builder and the shared work folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app_name: str, configs: dict[str, str] | None = None) -> SparkSession:
    """Session pinned to UTC with adaptive execution.

    Dates, hours and windows are all defined in UTC, so the zone must not depend on
    the host. Cluster sizing (master, memory, shuffle partitions) is left to
    spark-submit; ``configs`` wins over the values here.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    settings.update(configs or {})
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode session (tests)
    may fall back to a folder of this machine.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_DIR} must name a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="seatrace-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable without replacing a folder already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_dir(spark))
