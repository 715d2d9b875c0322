"""Parquet tables: the position scan (A3, A4) and the sinks' write paths.

Two kinds of table:

* A *log* takes what a stream emits. Each micro-batch owns a folder, named by the query's
  id and the batch's number, and overwrites it as a whole: a replay replaces the batch even
  if it has shrunk, and a query with a new checkpoint touches nothing of an older one.
  ``fold_log`` merges closed batches into a keyed table beside them and removes them, so
  that a reader lists few folders however long the stream has run.
* A *keyed table* holds one row per key, partitioned by date; batch jobs merge into it.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatrace.operators.clean import RETENTION_DAYS, clean_positions, on_date
from seatrace.operators.latest import newest_per_key
from seatrace.schema import KEYS
from seatrace.sources.folders import delete, exists, folders

#: Columns of a log that tell its batches apart, and what makes one row newer than another.
STAMPS = ["query_id", "batch_id", "written_at"]
NEWER = ["written_at", "batch_id"]


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None if nothing has been written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_positions_for_date(
    spark: SparkSession, path: str, target_date: date | str, **rules
) -> DataFrame:
    """Cleaned positions of one day (A3, A4); only that day's partition is opened."""
    return clean_positions(spark.read.parquet(path), target_date, **rules)


def _overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def _batch_folder(path: str, batch_id: int, query_id: str) -> str:
    return f"{path}/batches/query_id={query_id}/batch_id={batch_id}"


def write_batch(
    df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = (), query_id: str = "q"
) -> None:
    """Write one micro-batch to a log; writing the same batch again replaces it as a whole."""
    stamped = df.withColumn("written_at", F.current_timestamp())
    (
        stamped.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*partition_by)
        .parquet(_batch_folder(path, batch_id, query_id))
    )


def drop_batch(spark: SparkSession, path: str, batch_id: int, query_id: str = "q") -> None:
    """Remove a micro-batch that a replay found to be empty."""
    delete(spark, _batch_folder(path, batch_id, query_id))


def read_log_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """All stored versions of a log: the folded table and the batches since."""
    parts = []
    for part in (read_table(spark, f"{path}/folded"), read_table(spark, f"{path}/batches")):
        if part is not None:
            parts.append(
                part.withColumns(
                    {"query_id": F.col("query_id").cast("string"), "batch_id": F.col("batch_id").cast("bigint")}
                )
            )
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)


def read_log(
    spark: SparkSession, path: str, keys: Sequence[str], version: Sequence[str] = NEWER
) -> DataFrame | None:
    """Newest version of every key in a log (B9: last write wins)."""
    log = read_log_rows(spark, path)
    return None if log is None else newest_per_key(log, keys, version).drop(*STAMPS)


def closed_batches(spark: SparkSession, path: str) -> list[str]:
    """Folders of a log's batches but the last one of each query, which may be replayed."""
    closed: list[str] = []
    for query in folders(spark, f"{path}/batches/query_id=*"):
        batches = folders(spark, f"{query}/batch_id=*")
        batches.sort(key=lambda folder: int(re.search(r"batch_id=(\d+)", folder)[1]))
        closed += batches[:-1]
    return closed


def read_batches(spark: SparkSession, path: str, some: Sequence[str]) -> DataFrame | None:
    """Rows of these folders below a log's batches; None if all of them are empty."""
    try:
        rows = spark.read.option("basePath", f"{path}/batches").parquet(*some)
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None
    return rows.withColumns(
        {"query_id": F.col("query_id").cast("string"), "batch_id": F.col("batch_id").cast("bigint")}
    )


def fold_log(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    sort_by: Sequence[str] = (),
    version: Sequence[str] = NEWER,
) -> int:
    """Merge the closed batches of a log into its keyed table, remove them, return how many.

    The last batch of each query stays, as it may be replayed. Rows that a crash leaves both
    folded and in their batch are one version, so reading resolves them. ``partition_by``
    must not change for a key.
    """
    closed = closed_batches(spark, path)
    if not closed:
        return 0
    rows = read_batches(spark, path, closed)
    if rows is not None:
        upsert(
            newest_per_key(rows, keys, version), f"{path}/folded", keys, partition_by, sort_by, version
        )
    for folder in closed:
        delete(spark, folder)
    return len(closed)


def upsert(
    new: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    sort_by: Sequence[str] = (),
    version: Sequence[str] = (),
) -> None:
    """Replace the rows of ``new``'s keys, add the others, delete nothing.

    ``new`` must be unique on ``keys``, which is checked, and a key must not move between
    partitions. With ``version``, the row with the greater version stays. Only the
    partitions that ``new`` touches are read and rewritten. The merged rows are complete in
    a staging folder before a partition is replaced; whatever run comes after a crash in
    between first finishes the replacement.
    """
    spark = new.sparkSession
    finish_upsert(spark, path, partition_by, sort_by)
    incoming, staged = f"{path}.incoming", f"{path}.staged"
    new.write.mode("overwrite").parquet(incoming)
    rows = spark.read.schema(new.schema).parquet(incoming)
    if rows.isEmpty():
        delete(spark, incoming)
        return
    twice = rows.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if twice:
        delete(spark, incoming)
        raise ValueError(f"{path}: rows repeat the key {twice[0]}")
    existing = read_table(spark, path)
    if existing is not None and set(existing.columns) - set(rows.columns):
        delete(spark, incoming)
        raise ValueError(f"{path}: columns {sorted(existing.columns)} are stored, not {sorted(rows.columns)}")
    merged = rows
    if existing is not None:
        # one row per touched folder, as a filter that prunes the scan of the table
        touched = rows.select(*partition_by).distinct().collect()
        if len(partition_by) == 1:
            in_touched = F.col(partition_by[0]).isin([row[0] for row in touched])
        else:
            in_touched = F.struct(*partition_by).isin([F.struct(*map(F.lit, row)) for row in touched])
        stored = existing.filter(in_touched)
        if version:
            both = stored.unionByName(rows, allowMissingColumns=True)
            merged = newest_per_key(both, keys, version)
        else:
            merged = stored.join(rows, list(keys), "left_anti").unionByName(rows, allowMissingColumns=True)
    merged.write.mode("overwrite").parquet(staged)
    finish_upsert(spark, path, partition_by, sort_by)
    delete(spark, incoming)


def finish_upsert(
    spark: SparkSession, path: str, partition_by: Sequence[str], sort_by: Sequence[str] = ()
) -> None:
    """Replace partitions by staged rows, if staging is complete; incomplete staging goes."""
    staged = f"{path}.staged"
    if exists(spark, f"{staged}/_SUCCESS"):
        rows = spark.read.parquet(staged)
        _overwrite_partitions(_laid_out(rows, partition_by, sort_by), path, partition_by)
    delete(spark, staged)


def _laid_out(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str]) -> DataFrame:
    """Rows of a partition together, a large partition split over several files."""
    gathered = df.hint("rebalance", *partition_by)
    return gathered.sortWithinPartitions(*partition_by, *sort_by) if sort_by else gathered


def settle_positions(
    spark: SparkSession, log_path: str, path: str, target_date: date | str | None = None
) -> DataFrame | None:
    """Finished days of the trajectory log as keyed partitions (B2, W6); None means all days.

    Unique on (mmsi, date, recorded_at). Files cover ranges of (mmsi, recorded_at), so
    neither a busy vessel nor the day is bound to one task or file, and a vessel's track
    is found by file statistics. Returns the settled rows as stored.
    """
    rows = read_log_rows(spark, log_path)
    if rows is None:
        return None
    if target_date is not None:
        rows = on_date(rows, target_date)
    unique = newest_per_key(rows, KEYS["positions"], NEWER).drop(*STAMPS)
    ordered = unique.repartitionByRange("date", "mmsi", "recorded_at").sortWithinPartitions(
        "date", "mmsi", F.desc("recorded_at")
    )
    _overwrite_partitions(ordered, path, ["date"])
    settled = spark.read.parquet(path)
    return settled if target_date is None else on_date(settled, target_date)


def expire_dates(
    spark: SparkSession, path: str, as_of: datetime | date, days: int = RETENTION_DAYS
) -> list[str]:
    """Remove the date folders of a table that hold nothing younger than ``days``.

    Reads no rows. The folder in which the limit falls stays; queries filter its rows.
    """
    limit = as_of - timedelta(days=days)
    oldest = limit.date() if isinstance(limit, datetime) else limit
    gone = []
    for folder in folders(spark, f"{path}/date=*"):
        day = re.search(r"date=(\d{4}-\d{2}-\d{2})$", folder)
        if day and date.fromisoformat(day[1]) < oldest:
            delete(spark, folder)
            gone.append(day[1])
    return gone
