"""Alerts with the quiet period as state, and stored profiles."""

import random
from datetime import timedelta

import numpy as np
import pytest

from seatrace.plans.alerts import emitted_alerts
from seatrace.plans.profiles import vessel_profiles
from seatrace.streaming import jobs as streams
from seatrace.streaming.alerts import PARTS, let_through, start_alerts_state
from seatrace.streaming.profiles import StoredProfiles
from tests.test_plans import START, positions
from tests.test_streaming import ONCE, Feed, rows, same


@pytest.mark.parametrize("seed", range(5))
def test_let_through_equals_the_walk(seed):
    rng = random.Random(seed)
    times = sorted(rng.choices(range(200), k=60))
    quiet, last = rng.choice([0, 1, 7, 50]), rng.choice([-10_000, 5, 90])
    kept, at = [], last
    for i, t in enumerate(times):
        if t > at + quiet:
            kept.append(i)
            at = t
    assert let_through(np.array(times), last, quiet) == kept


def start(spark, feed, tmp_path, quiet=300):
    known = str(tmp_path / "profiles")
    if not (tmp_path / "profiles").exists():
        vessel_profiles(positions(spark, rows())).write.parquet(known)
    return start_alerts_state(
        feed.stream(), lambda: spark.read.parquet(known), str(tmp_path / "log"), str(tmp_path / "c"), ONCE, quiet
    )


@pytest.mark.parametrize("quiet", [300, 50])
def test_equals_the_batch_walk_over_restarts(spark, tmp_path, quiet):
    """Each part is a run of its own on the checkpoint, so the state comes from there."""
    feed, everything = Feed(spark, tmp_path / "in"), rows()
    for i in range(0, len(everything), 120):
        feed.send(everything[i : i + 120])
        start(spark, feed, tmp_path, quiet).awaitTermination()
    expected = emitted_alerts(positions(spark, everything), vessel_profiles(positions(spark, everything)), quiet)
    assert {r.type for r in expected.collect()} == {"vessel_stopped_at_sea", "abnormal_speed"}
    same(streams.read_alerts(spark, str(tmp_path / "log")), expected)


def test_state_leaves_after_the_quiet_period(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in")

    def run(some):
        feed.send(some)
        query = start(spark, feed, tmp_path)
        query.awaitTermination()
        return [p.stateOperators[0].numRowsTotal for p in query.recentProgress][-1]

    stopped = [(m, 0, 38.0, 1.0, 0.0, 0) for m in range(1, 41)]
    assert run(stopped) == 40
    assert run([(50, 200, 38.0, 1.0, 0.0, 0)]) == 41  # still quiet
    assert run([(51, 3600, 38.0, 1.0, 0.0, 0)]) <= 2  # an hour later only the last ones are
    assert run([(m, 3700, 38.0, 1.0, 0.0, 0) for m in range(1, 4)]) <= 4
    times = [(r.mmsi, r.timestamp) for r in streams.read_alerts(spark, str(tmp_path / "log")).collect()]
    assert sorted(t for m, t in times if m == 1) == [START, START + timedelta(seconds=3700)]


def test_vessels_of_a_part_share_a_call_and_a_row_of_state(spark, tmp_path):
    """Twenty vessels of one part, each with a quiet period of its own."""
    feed = Feed(spark, tmp_path / "in")

    def run(some):
        feed.send(some)
        query = start(spark, feed, tmp_path)
        query.awaitTermination()
        return [p.stateOperators[0].numRowsTotal for p in query.recentProgress][-1]

    crowd = [1 + PARTS * i for i in range(20)]
    assert run([(m, 10 * i, 38.0, 1.0, 0.0, 0) for i, m in enumerate(crowd)]) == 1
    # 390 s: the first nine, quiet for 300 s from 0 to 80 s on, raise alerts again
    assert run([(m, 390 + i // 10, 38.0, 1.0, 0.0, 0) for i, m in enumerate(crowd)]) == 1
    assert run([(2, 3600, 38.0, 1.0, 0.0, 0)]) == 1  # the crowd's quiet periods are over
    found = streams.read_alerts(spark, str(tmp_path / "log")).filter("mmsi != 2").collect()
    times = sorted((r.mmsi, (r.timestamp - START).total_seconds()) for r in found)
    again = [(m, 390) for m in crowd[:9]]
    assert times == sorted([(m, 10 * i) for i, m in enumerate(crowd)] + again)


def test_profiles_are_computed_once_per_refresh(spark, tmp_path):
    """Six micro-batches within the refresh time: one computation, and few folders opened."""
    feed, computed, now = Feed(spark, tmp_path / "in"), [], [1_700_000_000.0]
    everything = rows()

    def compute():
        computed.append(1)
        return vessel_profiles(positions(spark, everything))

    profiles = StoredProfiles(spark, str(tmp_path / "profiles"), compute, clock=lambda: now[0])
    for i in range(0, len(everything), 60):
        feed.send(everything[i : i + 60])
    query = streams.start_alerts(feed.stream(), profiles, str(tmp_path / "log"), str(tmp_path / "c"), ONCE)
    query.awaitTermination()
    assert query.lastProgress.batchId >= 5 and len(computed) == 1
    expected = emitted_alerts(positions(spark, everything), vessel_profiles(positions(spark, everything)))
    same(streams.read_alerts(spark, str(tmp_path / "log")), expected)
    # another process within the time uses what is stored; after it, there is one more
    StoredProfiles(spark, str(tmp_path / "profiles"), compute, clock=lambda: now[0] + 299)()
    assert len(computed) == 1
    for late in (300, 400, 601, 1000):
        StoredProfiles(spark, str(tmp_path / "profiles"), compute, clock=lambda at=late: now[0] + at)()
    assert len(computed) == 4  # at 0, 300, 601 and 1000
    assert len(list((tmp_path / "profiles").glob("version=*"))) == 2


def test_a_batch_opens_the_folders_of_its_vessels(spark, tmp_path):
    everything = positions(spark, [(m, t, 38.0, 1.0, float(m % 7)) for m in range(1, 201) for t in (0, 60)])
    profiles = StoredProfiles(spark, str(tmp_path / "p"), lambda: vessel_profiles(everything))
    few = everything.filter("mmsi in (3, 67, 5)")  # 3 and 67 share a folder
    opened = profiles.folders_of(few)
    assert sorted(path.rpartition("/")[2] for path in opened) == ["part=3", "part=5"]
    assert {r.mmsi for r in profiles.for_batch(few).collect()} >= {3, 67, 5}
    assert profiles.for_batch(everything.filter("mmsi is null")).collect() == []
    assert profiles().count() == 200


def test_an_incomplete_version_is_not_used(spark, tmp_path):
    computed = []

    def compute():
        computed.append(1)
        return vessel_profiles(positions(spark, rows()))

    clock = lambda: 1_700_000_000.0
    profiles = StoredProfiles(spark, str(tmp_path / "p"), compute, clock=clock)
    (tmp_path / "p" / "version=1699999999000").mkdir(parents=True)
    assert profiles().count() == 3 and len(computed) == 1
