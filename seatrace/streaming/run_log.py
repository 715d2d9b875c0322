"""Run log of streams: one row per micro-batch with the rows that went in.

Rows are counted where they pass, by ``observe``, and reported with the progress of each
batch; a listener writes them down. Nothing is read twice for it.
"""

from __future__ import annotations

import threading
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from seatrace.sources.tables import read_log_rows, write_batch

ROWS_IN = "rows_in"
COLUMNS = (
    "job_name string, run_id string, started_at timestamp, rows_in bigint, source_rows bigint, "
    "state_rows bigint, duration_ms bigint"
)


def counted(stream: DataFrame) -> DataFrame:
    """The stream, with its rows counted in each micro-batch."""
    return stream.observe(ROWS_IN, F.count(F.lit(1)).alias("n"))


class StreamRunLog(StreamingQueryListener):
    """Writes a row per micro-batch of the session's queries to a log at ``path``.

    A batch owns a folder, so one that is replayed after a restart has one row. Queries are
    named by ``names`` (query id to name) or by their own name. A row that cannot be written
    is kept in ``failed``, as a listener must not break the streams it listens to.
    """

    def __init__(self, spark: SparkSession, path: str, names: dict[str, str] | None = None) -> None:
        self.spark, self.path, self.names = spark, path, names or {}
        self.failed: list[tuple[int, str]] = []
        self._ended: dict[str, threading.Event] = {}

    def _end_of(self, run_id: str) -> threading.Event:
        return self._ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end_of(str(event.runId))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if not progress.numInputRows:
            return  # a trigger that found nothing
        seen = progress.observedMetrics.get(ROWS_IN)
        query = str(progress.id)
        row = (
            self.names.get(query) or progress.name or query,
            str(progress.runId),
            datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00")),
            None if seen is None else int(seen["n"]),
            int(progress.numInputRows),
            sum(int(state.numRowsTotal) for state in progress.stateOperators),
            int(progress.batchDuration),
        )
        try:
            rows = self.spark.createDataFrame([row], COLUMNS)
            write_batch(rows, self.path, int(progress.batchId), query_id=query)
        except Exception as error:
            self.failed.append((int(progress.batchId), str(error)))

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()

    def wait(self, run_id: str, seconds: float = 60) -> bool:
        """Wait until a run has ended and all its batches are written down."""
        return self._end_of(str(run_id)).wait(seconds)


def read_stream_runs(spark: SparkSession, path: str) -> DataFrame | None:
    """One row per query and micro-batch."""
    rows = read_log_rows(spark, path)
    return None if rows is None else rows.drop("written_at")
