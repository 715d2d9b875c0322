"""Quiet period against the plain sequential walk."""

import random
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from seatrace.operators import suppress as S

START = datetime(2024, 1, 1)


def walk(times, quiet, last=None):
    kept = []
    for t in sorted(times):
        if last is None or t > last + quiet:
            kept.append(t)
            last = t
    return kept


def rows_of(spark, times_by_key):
    rows = [
        (mmsi, kind, START + timedelta(microseconds=t), f"{mmsi}{kind}{t}")
        for (mmsi, kind), times in times_by_key.items()
        for t in times
    ]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "mmsi int, type string, timestamp timestamp, alert_id string").repartition(5)


def kept_of(df):
    epoch = int(START.replace(tzinfo=timezone.utc).timestamp() * 1_000_000)
    found = {}
    for r in df.select("mmsi", "type", F.unix_micros("timestamp").alias("t")).collect():
        found.setdefault((r.mmsi, r.type), []).append(r.t - epoch)
    return {key: sorted(times) for key, times in found.items()}


def random_keys(seed):
    rng = random.Random(seed)
    second = 1_000_000
    keys = {}
    # sparse, bursts, dense at one second, and odd microseconds
    keys[1, "a"] = {rng.randrange(5 * 86400 * second) for _ in range(200)}
    keys[1, "b"] = {rng.randrange(3600) * second + b * 90000 * second for b in range(4) for _ in range(150)}
    keys[2, "a"] = {s * second for s in range(0, 30000, 7)}
    keys[2, "b"] = {rng.randrange(90 * second) for _ in range(300)}
    keys[3, "a"] = {86400 * second - 1, 86400 * second, 2 * 86400 * second}
    return {key: sorted(times) for key, times in keys.items()}


@pytest.mark.parametrize("quiet,slice_seconds", [(300, 3600), (86400, 3600), (20, 60), (7201, 1800)])
def test_equals_sequential_walk(spark, quiet, slice_seconds):
    keys = random_keys(quiet)
    df = rows_of(spark, keys)
    found = kept_of(S.suppress(df, quiet_seconds=quiet, slice_seconds=slice_seconds))
    assert found == {key: walk(times, quiet * 1_000_000) for key, times in keys.items()}


def test_bound_is_inclusive_and_suppressed_rows_do_not_extend(spark):
    minute = 60_000_000
    times = [0, 3 * minute, 5 * minute, 5 * minute + 1]
    found = kept_of(S.suppress(rows_of(spark, {(1, "a"): times})))
    assert found == {(1, "a"): [0, 5 * minute + 1]}


def test_same_instant_keeps_one_row_with_all_columns(spark):
    df = rows_of(spark, {(1, "a"): [0, 0, 0]})
    kept = S.suppress(df)
    assert kept.columns == df.columns
    assert [r.alert_id for r in kept.collect()] == ["1a0"]


def test_after_earlier_rows(spark):
    minute = 60_000_000
    df = rows_of(spark, {(1, "a"): [0, 5 * minute, 6 * minute, 10 * minute], (2, "a"): [0]})
    last = spark.createDataFrame(
        [(1, "a", START)], "mmsi int, type string, kept_at timestamp"
    )
    found = kept_of(S.suppress_after(df, last))
    assert found == {(1, "a"): [6 * minute], (2, "a"): [0]}


def test_late_rows_are_held_back_only_by_earlier_ones(spark):
    minute = 60_000_000
    df = rows_of(spark, {(1, "a"): [0, 100 * minute, 118 * minute, 121 * minute, 126 * minute]})
    kept_at = [START + timedelta(minutes=m) for m in (98, 120, 200)]
    earlier = spark.createDataFrame(
        [(1, "a", t) for t in kept_at], "mmsi int, type string, kept_at timestamp"
    )
    found = kept_of(S.suppress_after(df, earlier))
    assert found == {(1, "a"): [0, 118 * minute, 126 * minute]}


def test_nulls_are_left_out(spark):
    df = spark.createDataFrame(
        [(None, "a", START), (1, "a", None)], "mmsi int, type string, timestamp timestamp"
    ).withColumn("alert_id", F.lit("x"))
    assert S.suppress(df).collect() == []


def test_step_functions_answer_every_entry_state():
    rng = random.Random(5)
    for _ in range(200):
        quiet, length = rng.choice([(10, 30), (25, 30), (70, 30)])
        rows = []
        for _ in range(rng.randrange(1, 4)):
            begin = rng.randrange(3) * 300
            slices = [
                sorted(rng.sample(range(s, s + length), rng.randrange(1, 12)))
                for s in range(begin, begin + 5 * length, length)
                if rng.random() < 0.8
            ] or [[begin]]
            rows.append((begin, slices))
        parts = [p for _, slices in rows for p in slices]
        flat = np.array([t for p in parts for t in p])
        starts = np.array([t[0] - t[0] % length for t in parts])
        counts, until, exits = S.compose_steps(np.array([len(p) for p in parts]), flat, flat, starts, quiet)
        part_count = np.array([len(slices) for _, slices in rows])
        first = np.cumsum(part_count) - part_count
        entry = np.array([rng.choice([S.NEVER, begin - 1 - rng.randrange(80)]) for begin, _ in rows])
        states = S.entry_states(entry, part_count, starts, counts, until, exits, quiet)
        whole = S.compose_steps(np.add.reduceat(counts, first), until, exits, starts[first], quiet)
        cuts = np.cumsum(whole[0])
        for i, (_, slices) in enumerate(rows):
            last = None if entry[i] == S.NEVER else int(entry[i])
            for p, times in enumerate(slices):
                known = int(states[first[i] + p])
                assert walk(times, quiet, known) == walk(times, quiet, last)
                last = (walk(times, quiet, last) or [last])[-1]
            u, x = whole[1][cuts[i] - whole[0][i] : cuts[i]], whole[2][cuts[i] - whole[0][i] : cuts[i]]
            step = int(np.searchsorted(u, int(entry[i]) + quiet, side="right"))
            expected = walk([t for p in slices for t in p], quiet, int(entry[i]))
            assert ([int(x[step])] if step < len(u) else []) == expected[-1:]


def test_entry_states_over_a_span_too_long_to_lift():
    century = 100 * 365 * 86400 * 1_000_000
    quiet = 10
    times = np.array([0, 5, century, century + 5, century + 11])
    rows = 2000
    until = np.tile(times, rows)
    ones = np.full(rows * 5, 1)
    args = (np.full(rows, S.NEVER), np.full(rows, 5), until, ones, until, until, quiet)
    states = S.entry_states(*args).reshape(rows, 5)
    assert (states[:, 0] < -quiet).all()
    assert (states[:, 1:] == [0, 0, century, century]).all()
