"""Alerts whose quiet period is kept as state of the stream.

``start_alerts`` reads the alert log on every trigger; here Spark keeps, for each vessel and
kind of alert that is in its quiet period, the time of the last alert. It leaves the state
when event time has passed its quiet period, so the state holds the vessels that were quiet
lately, not all that ever raised an alert.

A row of the state is a part of the vessels. Calling Python costs some milliseconds a group
and batch, for alerts as for timeouts: with parts, their number bounds that, not the vessels.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from seatrace.operators.suppress import QUIET_SECONDS
from seatrace.plans.alerts import detect_alerts
from seatrace.sources.tables import write_batch
from seatrace.streaming.jobs import WATERMARK, start_batches

KEYS = ["mmsi", "type"]
NEVER = np.iinfo(np.int64).min // 2
#: Parts that the vessels are dealt to; a prime, as vessel numbers often end in zeros. Spark
#: finds a checkpoint's state by part, so a change needs a new checkpoint.
PARTS = 4093
STATE = "mmsi array<int>, type array<string>, last array<bigint>"


def let_through(times: np.ndarray, last: int, quiet: int) -> list[int]:
    """Places in sorted ``times`` that lie more than ``quiet`` after the one let through
    before, the first of them after ``last``."""
    places, at = [], int(np.searchsorted(times, last + quiet, side="right"))
    while at < len(times):
        places.append(at)
        at = int(np.searchsorted(times, times[at] + quiet, side="right"))
    return places


def _quiet_period(quiet_seconds: int):
    quiet = quiet_seconds * 1_000_000

    def ends(last: int) -> int:
        """The first whole millisecond at which a row at the watermark would be let through."""
        return (last + quiet) // 1000 + 1

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = {(mmsi, kind): last for mmsi, kind, last in zip(*state.get)} if state.exists else {}
        if not state.hasTimedOut:
            rows = pd.concat(list(parts), ignore_index=True)
            # rows of one instant: the first by its other columns suppresses the others
            rows = rows.sort_values([*KEYS, "at", "order"], kind="stable", ignore_index=True)
            times, places = rows["at"].to_numpy(np.int64), []
            keys = [rows[name].to_numpy() for name in KEYS]
            changes = np.logical_or.reduce([key[1:] != key[:-1] for key in keys])
            starts = [0, *(np.flatnonzero(changes) + 1).tolist()]
            for begin, end in zip(starts, [*starts[1:], len(rows)]):
                one = (int(keys[0][begin]), keys[1][begin])
                through = let_through(times[begin:end], known.get(one, NEVER), quiet)
                if through:
                    known[one] = int(times[begin + through[-1]])
                    places += [begin + at for at in through]
            yield rows.iloc[places].drop(columns=["part", "at", "order"])
        # only now: rows of this batch may lie behind the watermark that ends quiet periods
        watermark = state.getCurrentWatermarkMs()
        known = {one: last for one, last in known.items() if ends(last) > watermark}
        if known:
            mmsi, kinds = zip(*known)
            state.update((list(mmsi), list(kinds), list(known.values())))
            state.setTimeoutTimestamp(min(map(ends, known.values())))
        elif state.exists:
            state.remove()

    return step


def quiet_alerts(found: DataFrame, quiet_seconds: int = QUIET_SECONDS, watermark: str = WATERMARK) -> DataFrame:
    """Alerts of a stream that the quiet period lets through.

    Equals the sequential walk for alerts that come no later than the watermark allows;
    Spark drops the others. A group holds the alerts of one of ``PARTS`` parts of the vessels
    in one batch.
    """
    rest = [c for c in found.columns if c not in KEYS]
    marked = found.filter(
        F.col("mmsi").isNotNull() & F.col("type").isNotNull() & F.col("timestamp").isNotNull()
    ).withColumns(
        {
            "part": F.pmod("mmsi", F.lit(PARTS)),
            "at": F.unix_micros("timestamp"),
            "order": F.to_json(F.struct(*rest)),
        }
    )
    schema = found.schema
    return (
        marked.withWatermark("timestamp", watermark)
        .groupBy("part")
        .applyInPandasWithState(
            _quiet_period(quiet_seconds), schema, STATE, "append", GroupStateTimeout.EventTimeTimeout
        )
    )


def start_alerts_state(
    positions: DataFrame,
    profiles: Callable[[], DataFrame],
    log: str,
    checkpoint: str,
    trigger: dict | None = None,
    quiet_seconds: int = QUIET_SECONDS,
    watermark: str = WATERMARK,
) -> StreamingQuery:
    """Alerts with a quiet period that spans micro-batches, without reading the alert log.

    ``profiles`` is called once; a stored table is read anew by Spark in every batch.
    """
    emitted = quiet_alerts(detect_alerts(positions, profiles()), quiet_seconds, watermark)

    def sink(batch: DataFrame, batch_id: int, query_id: str) -> None:
        dated = batch.withColumn("date", F.to_date("timestamp"))
        write_batch(dated, log, batch_id, ["date"], query_id)

    return start_batches(emitted, sink, [log], checkpoint, trigger)


# executors need not have the package installed: its Python tasks travel by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])
