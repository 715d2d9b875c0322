"""Quiet period after an emitted alert.

Rule, per key in time order: a row is kept when it lies more than the quiet period after
the last *kept* row. Each decision depends on the one before, yet a key with very many
rows must not end up in one task. So time is cut into slices and days:

1. Each slice is summed up as a step function "last kept time on entry -> last kept time
   on exit". A slice can be entered only through its first quiet period, so the function
   has few steps, however many rows the slice has.
2. The functions of a day's slices are composed into one for the day, and a key's days
   are walked in order. That gives the entry state of every day, then of every slice.
3. Each slice, knowing its entry state, keeps its rows. This is one pass in the JVM.

The result equals the plain sequential walk. One group holds the rows of one key and one
slice, or the step functions of one key's day, or of one key's days.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatrace.operators.lookup import lookup_join

QUIET_SECONDS = 300
SLICE_SECONDS = 3600
DAY_SECONDS = 86400
NEVER = -(1 << 62)

STEPS = "struct<until:array<bigint>,exit:array<bigint>>"


def suppress(
    rows: DataFrame,
    keys: Sequence[str] = ("mmsi", "type"),
    time: str = "timestamp",
    quiet_seconds: int = QUIET_SECONDS,
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Keep the rows of each key that the quiet period lets through."""
    keys = list(keys)
    kept = _kept_times(rows, keys, time, quiet_seconds, slice_seconds)
    stamped = rows.withColumn("__t", F.unix_micros(time))
    surviving = stamped.join(kept, [*keys, "__t"], "left_semi")
    rest = [c for c in rows.columns if c not in keys]
    # rows of one key at one instant: the first suppresses the others
    single = surviving.groupBy(*keys, "__t").agg(F.min(F.struct(*rest)).alias("__row"))
    return single.select(*keys, "__row.*").select(*rows.columns)


def suppress_after(
    rows: DataFrame,
    earlier: DataFrame,
    keys: Sequence[str] = ("mmsi", "type"),
    time: str = "timestamp",
    quiet_seconds: int = QUIET_SECONDS,
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """As ``suppress``, following rows kept before: ``earlier`` has keys and ``kept_at``.

    A row is held back by an earlier kept row at or up to the quiet period before it; one
    that is later than the row does not count, so a late row is not lost. Rows and earlier
    rows meet in intervals of a quiet period, of which a row can only need two.
    """
    keys = list(keys)
    length = max(1, quiet_seconds * 1_000_000)
    known = (
        earlier.select(*keys, F.unix_micros("kept_at").alias("__kept"))
        .withColumn("__interval", F.floor(F.col("__kept") / length))
        .groupBy(*keys, "__interval")
        .agg(F.array_sort(F.collect_set("__kept")).alias("__at"))
    )
    t = F.unix_micros(time)
    found = rows.withColumn("__interval", F.floor(t / length))
    before = known.select(
        *keys, (F.col("__interval") + 1).alias("__interval"), F.col("__at").alias("__before")
    )
    met = lookup_join(
        lookup_join(found, known, [*keys, "__interval"], "left"), before, [*keys, "__interval"], "left"
    )

    def holds_back(times: str) -> Column:
        hit = F.exists(times, lambda kept: (kept <= t) & (t <= kept + quiet_seconds * 1_000_000))
        return F.coalesce(hit, F.lit(False))

    open_rows = met.filter(~holds_back("__at") & ~holds_back("__before")).select(*rows.columns)
    return suppress(open_rows, keys, time, quiet_seconds, slice_seconds)


def _kept_times(
    rows: DataFrame, keys: list[str], time: str, quiet_seconds: int, slice_seconds: int
) -> DataFrame:
    if DAY_SECONDS % slice_seconds:
        raise ValueError("slices must divide a day")
    quiet = quiet_seconds * 1_000_000
    slice_us, day_us = slice_seconds * 1_000_000, DAY_SECONDS * 1_000_000
    # Nulls are ruled out here, by filter and in the types: the joins below then infer no
    # filters of their own, and every use of ``slices`` reads one shuffle.
    known = F.col(time).isNotNull()
    for key in keys:
        known = known & F.col(key).isNotNull()
    t = F.coalesce(F.unix_micros(time), F.lit(NEVER))
    slices = (
        rows.filter(known)
        .select(
            *keys, _start(t, day_us).alias("day"), _start(t, slice_us).alias("slice"), t.alias("t")
        )
        .groupBy(*keys, "day", "slice")
        .agg(F.sort_array(F.collect_set("t")).alias("times"))
    )
    summed = slices.select(*keys, "day", "slice", _sum_up(quiet)("slice", "times").alias("steps"))
    slice_lists = _in_order(summed, [*keys, "day"], "slice")
    days = slice_lists.select(*keys, "day", _compose(quiet)("parts").alias("steps"))
    day_lists = _in_order(days, keys, "day").withColumn("entry", F.lit(NEVER))
    day_entry = _entries(day_lists, keys, "day", quiet)
    slice_entry = _entries(slice_lists.join(day_entry, [*keys, "day"]), [*keys, "day"], "slice", quiet)
    entered = slices.join(slice_entry, [*keys, "day", "slice"])
    return entered.select(*keys, F.explode(_walk("times", "entry", quiet)).alias("__t"))


def _in_order(steps: DataFrame, keys: list[str], order: str) -> DataFrame:
    part = F.struct(F.col(order).alias("start"), "steps.until", "steps.exit")
    return steps.groupBy(*keys).agg(F.array_sort(F.collect_list(part)).alias("parts"))


def _entries(lists: DataFrame, keys: list[str], order: str, quiet: int) -> DataFrame:
    states = _thread(quiet)("entry", "parts")
    return lists.select(*keys, F.explode(F.arrays_zip("parts.start", states.alias("state"))).alias("p")).select(
        *keys,
        F.coalesce("p.start", F.lit(NEVER)).alias(order),
        F.col("p.state").alias("entry"),
    )


def _start(t: Column, length: int) -> Column:
    """Start of the interval of this length that holds t."""
    return F.coalesce(t - F.pmod(t, F.lit(length)), F.lit(NEVER))


def _walk(times: str, entry: str, quiet: int) -> Column:
    """Times of a sorted array that lie more than ``quiet`` after the one kept before."""
    start = F.struct(
        F.col(entry).alias("last"), F.array().cast("array<bigint>").alias("kept")
    )
    return F.aggregate(
        times,
        start,
        lambda acc, t: F.when(
            t > acc["last"] + quiet,
            F.struct(t.alias("last"), F.concat(acc["kept"], F.array(t)).alias("kept")),
        ).otherwise(acc),
        lambda acc: acc["kept"],
    )


# The helpers below work on a whole Arrow batch at once. Rows are lifted into disjoint
# ranges of one long axis (row number times a span no row exceeds), so that one binary
# search serves all rows.


def _sum_up(quiet: int):
    @F.arrow_udf(STEPS)
    def udf(start: pa.Array, times: pa.Array) -> pa.Array:
        t = _numbers(times.flatten())
        return _steps(*compose_steps(_lengths(times), t, t, _numbers(start), quiet))

    return udf


def _compose(quiet: int):
    @F.arrow_udf(STEPS)
    def udf(parts: pa.Array) -> pa.Array:
        part_count, start, step_count, until, exits = _parts(parts)
        first = np.cumsum(part_count) - part_count
        counts = np.add.reduceat(step_count, first)
        return _steps(*compose_steps(counts, until, exits, start[first], quiet))

    return udf


def _thread(quiet: int):
    @F.arrow_udf("array<bigint>")
    def udf(entry: pa.Array, parts: pa.Array) -> pa.Array:
        part_count, start, step_count, until, exits = _parts(parts)
        states = entry_states(
            _numbers(entry), part_count, start, step_count, until, exits, quiet
        )
        return _list(part_count, states)

    return udf


def _numbers(array: pa.Array) -> np.ndarray:
    return array.to_numpy(zero_copy_only=False)


def _lengths(array: pa.Array) -> np.ndarray:
    return _numbers(pc.list_value_length(array)).astype(np.int64)


def _parts(parts: pa.Array) -> tuple[np.ndarray, ...]:
    """Parts per row; start and steps per part; until and exit per step."""
    start, until, exits = parts.flatten().flatten()
    return (
        _lengths(parts),
        _numbers(start),
        _lengths(until),
        _numbers(until.flatten()),
        _numbers(exits.flatten()),
    )


def _list(counts: np.ndarray, values: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _steps(counts: np.ndarray, until: np.ndarray, exits: np.ndarray) -> pa.Array:
    return pa.StructArray.from_arrays([_list(counts, until), _list(counts, exits)], ["until", "exit"])


def compose_steps(
    counts: np.ndarray, until: np.ndarray, exits: np.ndarray, start: np.ndarray, quiet: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row, one step function for the consecutive parts whose steps are given in order.

    A row has ``counts`` steps and its first part begins at ``start``. Step i says: an
    entry state whose quiet period ends before ``until[i]``, and not before ``until[i-1]``,
    leaves with ``exit[i]``, at or after ``until[i]``, as last kept time. A single time t is
    the step (t, t).
    """
    row = np.repeat(np.arange(len(counts)), counts)
    base = start[row]
    span = int((exits - base).max()) + quiet + 2
    lift = row * span - base
    ends = np.cumsum(counts)[row]
    lifted = until + lift
    after = np.searchsorted(lifted, exits + lift + quiet, side="right")
    place = np.arange(len(until))
    while True:
        step = after[place]
        moving = step < ends
        if not moving.any():
            break
        place = np.where(moving, step, place)
    exits = exits[place]
    # an entry state lies before the start: steps past the first quiet period are unused
    reach = np.searchsorted(lifted, np.arange(len(counts)) * span + quiet, side="left")
    used = np.flatnonzero(np.arange(len(until)) <= reach[row])
    row, until, exits = row[used], until[used], exits[used]
    # neighbours with the same exit act as one step
    kept = np.append((exits[1:] != exits[:-1]) | (row[1:] != row[:-1]), True)
    return np.bincount(row[kept], minlength=len(counts)), until[kept], exits[kept]


def entry_states(
    entry: np.ndarray,
    part_count: np.ndarray,
    start: np.ndarray,
    step_count: np.ndarray,
    until: np.ndarray,
    exits: np.ndarray,
    quiet: int,
) -> np.ndarray:
    """Last kept time on entry to each part, for rows of consecutive parts.

    Any time more than the quiet period before a row's start stands for "never".
    """
    rows = len(entry)
    part_end = np.cumsum(part_count)
    first_part = part_end - part_count
    part = np.repeat(np.arange(len(step_count)), step_count)
    row = np.repeat(np.arange(rows), part_count)[part]
    step_end = np.cumsum(step_count)[part_end - 1]
    first_step = np.append(0, step_end[:-1])
    base = start[first_part] - quiet - 1
    span = int((exits - base[row]).max()) + quiet + 2
    if rows > 1 and rows * span >= 1 << 62:
        half = rows // 2
        cut_part, cut_step = first_part[half], first_step[half]
        return np.concatenate(
            [
                entry_states(
                    entry[:half], part_count[:half], start[:cut_part], step_count[:cut_part],
                    until[:cut_step], exits[:cut_step], quiet,
                ),
                entry_states(
                    entry[half:], part_count[half:], start[cut_part:], step_count[cut_part:],
                    until[cut_step:], exits[cut_step:], quiet,
                ),
            ]
        )
    lift = np.arange(rows) * span - base
    lifted_until, lifted_exit = until + lift[row], exits + lift[row]
    state = np.maximum(entry, base) + lift
    states = np.repeat(np.arange(rows) * span, part_count)
    states[first_part] = state
    moving = np.arange(rows)
    while len(moving):
        step = np.searchsorted(lifted_until, state[moving] + quiet, side="right")
        found = step < step_end[moving]
        moving, step = moving[found], step[found]
        state[moving] = lifted_exit[step]
        following = part[step] + 1
        inside = following < part_end[moving]
        states[following[inside]] = state[moving[inside]]
    return np.maximum.accumulate(states) - np.repeat(lift, part_count)


# executors need not have the package installed: its Python tasks travel by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])
