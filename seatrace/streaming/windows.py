"""Zone windows of a stream as sums that add up, late rows included.

``start_zone_stats`` keeps open windows in Spark's state and drops what comes behind the
watermark. Here a micro-batch writes the sums of its own rows per zone and window, and a
window is the union of what the batches have for it: nothing is dropped, there is no state
to lose, and a replayed batch replaces its sums. Rows behind the watermark go to folders of
their own, so the windows that they touch are found, and corrected, without reading others.

``fold_windows`` merges closed batches into one row per window. A folded row says up to which
batch of each query it holds sums, so a batch that a crash leaves both folded and in the log
counts once.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from seatrace.plans.traffic import WINDOW_KEY, ZONE_WINDOW, stats_of_sums, united, zone_sums
from seatrace.sources.folders import delete, folders
from seatrace.sources.tables import closed_batches, read_batches, read_table, upsert, write_batch
from seatrace.streaming.jobs import WATERMARK, start_batches

KEY = [*WINDOW_KEY, "date"]
LATE = "late_messages"


def start_zone_windows(
    positions: DataFrame,
    log: str,
    checkpoint: str,
    trigger: dict | None = None,
    window: str = ZONE_WINDOW,
    watermark: str = WATERMARK,
) -> StreamingQuery:
    """Sums per zone and window of each micro-batch; ``late`` ones in folders of their own.

    A window is late in a batch if it ended more than ``watermark`` before the newest event
    time of the query's earlier batches, which the log itself tells after a restart.
    """
    newest: dict[str, datetime | None] = {}

    def sink(batch: DataFrame, batch_id: int, query_id: str) -> None:
        spark = batch.sparkSession
        if "at" not in newest:
            newest["at"] = _newest_before(spark, log, batch_id, query_id)
        limit = F.lit(newest["at"]).cast("timestamp") - F.expr(f"INTERVAL {watermark}")
        sums = zone_sums(batch, window).withColumns(
            {
                "date": F.to_date("window_start"),
                "late": F.coalesce(F.col("window_end") <= limit, F.lit(False)),
            }
        )
        seen = Observation()
        write_batch(sums.observe(seen, F.max("newest").alias("at")), log, batch_id, ["late", "date"], query_id)
        newest["at"] = max(filter(None, (newest["at"], seen.get["at"])), default=None)

    return start_batches(positions, sink, [log], checkpoint, trigger)


def _newest_before(spark: SparkSession, log: str, batch_id: int, query_id: str) -> datetime | None:
    """Newest event time in the query's batches before this one, folded ones included."""
    found = []
    batches = read_table(spark, f"{log}/batches")
    if batches is not None:
        own = (F.col("query_id") == query_id) & (F.col("batch_id") < batch_id)
        found.append(batches.filter(own).agg(F.max("newest")).first()[0])
    folded = read_table(spark, f"{log}/folded")
    if folded is not None:
        found.append(folded.filter(F.array_contains(F.map_keys("through"), query_id)).agg(F.max("newest")).first()[0])
    return max(filter(None, found), default=None)


def _counted(batches: DataFrame) -> DataFrame:
    """Rows of batches with the messages that were late in them."""
    late = F.when(F.col("late").cast("boolean"), F.col("messages")).otherwise(0)
    return batches.withColumn(LATE, late.cast("bigint"))


def _united(batches: DataFrame | None, folded: DataFrame | None) -> DataFrame | None:
    """One row per window of batch rows and folded rows; what is folded counts once."""
    columns = [*KEY, "speed_sum", "speed_count", "messages", "newest", "vessels", LATE]
    if batches is None:
        return None if folded is None else folded.select(*columns)
    rows = _counted(batches)
    if folded is not None:
        through = folded.select(*KEY, "through")
        done = F.coalesce(F.element_at("through", F.col("query_id")), F.lit(-1))
        rows = rows.join(through, KEY, "left").filter(F.col("batch_id") > done)
        rows = rows.select(*columns).unionByName(folded.select(*columns))
    return rows.groupBy(*KEY).agg(*united([LATE]))


def read_zone_sums(spark: SparkSession, log: str) -> DataFrame | None:
    """Sums per zone and window, with the number of ``late_messages`` in them."""
    return _united(read_table(spark, f"{log}/batches"), read_table(spark, f"{log}/folded"))


def read_zone_windows(spark: SparkSession, log: str) -> DataFrame | None:
    """Statistics per zone and window of all rows, however late."""
    sums = read_zone_sums(spark, log)
    return None if sums is None else stats_of_sums(sums, [LATE])


def late_folders(spark: SparkSession, log: str) -> tuple[list[str], list[str]]:
    """Folders that hold late sums, and folders of all other sums of the same dates."""
    late = folders(spark, f"{log}/batches/query_id=*/batch_id=*/late=true/date=*")
    dates = sorted({folder.rpartition("/")[2] for folder in late})
    others = [
        folder
        for date in dates
        for folder in folders(spark, f"{log}/batches/query_id=*/batch_id=*/late=false/{date}")
    ]
    return late, others


def read_late_windows(spark: SparkSession, log: str) -> DataFrame | None:
    """Corrected statistics of the windows that batches not yet folded have late rows for.

    Opens the late rows, and of everything else the dates of their windows only: the cost
    follows the late rows, not the days in the log.
    """
    late, others = late_folders(spark, log)
    if not late:
        return None
    touched = read_batches(spark, log, late).select(*KEY).distinct()
    batches = read_batches(spark, log, [*late, *others]).join(touched, KEY, "left_semi")
    folded = read_table(spark, f"{log}/folded")
    if folded is not None:
        dates = [folder.rpartition("date=")[2] for folder in late]
        folded = folded.filter(F.col("date").isin(sorted(set(dates)))).join(touched, KEY, "left_semi")
    return stats_of_sums(_united(batches, folded).drop("date"), [LATE])


def fold_windows(spark: SparkSession, log: str) -> int:
    """Merge closed batches into one row per window and remove them; returns how many.

    Only the dates that the batches touch are rewritten.
    """
    closed = closed_batches(spark, log)
    if not closed:
        return 0
    batches = read_batches(spark, log, closed)
    if batches is not None:
        folded = read_table(spark, f"{log}/folded")
        ends = batches.groupBy(*KEY, "query_id").agg(F.max("batch_id").alias("last"))
        last = ends.groupBy(*KEY).agg(
            F.map_from_entries(F.collect_list(F.struct("query_id", "last"))).alias("new")
        )
        merged = _united(batches, _touched(folded, last)).join(last, KEY)
        if folded is None:
            merged = merged.withColumnRenamed("new", "through")
        else:
            before = folded.select(*KEY, F.col("through").alias("old"))
            merged = merged.join(before, KEY, "left").withColumn("through", _latest("old", "new")).drop("old", "new")
        upsert(merged, f"{log}/folded", KEY, ["date"], ["zone", "window_start"])
    for folder in closed:
        delete(spark, folder)
    return len(closed)


def _touched(folded: DataFrame | None, keys: DataFrame) -> DataFrame | None:
    return None if folded is None else folded.join(keys, KEY, "left_semi")


def _latest(old: str, new: str):
    """Per query, the later of two batches."""
    empty = F.create_map().cast("map<string,bigint>")
    return F.map_zip_with(
        F.coalesce(old, empty), new, lambda _, a, b: F.greatest(F.coalesce(a, F.lit(-1)), F.coalesce(b, F.lit(-1)))
    )
