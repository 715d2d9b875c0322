"""Streams over message files: same tables as the batch plans, restarts, late rows."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from seatrace.operators.latest import latest_positions
from seatrace.operators.messages import flatten_positions, parse_messages, to_messages
from seatrace.plans.alerts import emitted_alerts
from seatrace.plans.profiles import vessel_profiles
from seatrace.plans.traffic import zone_stats
from seatrace.sources.streams import read_message_files
from seatrace.streaming import jobs as streams
from seatrace.streaming import run
from tests.test_plans import START, positions

ONCE = {"availableNow": True}


def rows():
    found = []
    for t in range(0, 1800, 20):
        for m in (1, 1, 2, 3):  # vessel 1 sends twice
            speed = 0.0 if (m == 1 and t < 1200) else 3.0 * m + (40.0 if t == 600 and m == 3 else 0.0)
            found.append((m, t + (7 if found and found[-1][:2] == (m, t) else 0), 38.0, 1.0 + m, speed, 0))
    return found


class Feed:
    """A folder of message files and the stream over it, three files a batch or fewer."""

    def __init__(self, spark, path):
        self.spark, self.path, self.sent = spark, path, 0
        path.mkdir()

    def send(self, some):
        lines = to_messages(positions(self.spark, some)).collect()
        (self.path / f"{self.sent:04d}.txt").write_text("\n".join(r.value for r in lines) + "\n")
        self.sent += 1

    def stream(self, **options):
        raw = read_message_files(self.spark, str(self.path), max_files_per_trigger=1, **options)
        return flatten_positions(parse_messages(raw))


@pytest.fixture
def feed(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in")
    everything = rows()
    for i in range(0, len(everything), 90):
        feed.send(everything[i : i + 90])
    return feed


def same(one, other):
    assert sorted(one.select(other.columns).collect(), key=str) == sorted(other.collect(), key=str)


def test_zone_stats(spark, feed, tmp_path):
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")
    run = lambda: streams.start_zone_stats(feed.stream(), log, checkpoint, ONCE, window="1 minute").awaitTermination()
    run()
    expected = zone_stats(positions(spark, rows()), "1 minute")
    same(streams.read_zone_stats(spark, log), expected)
    run()  # nothing new
    same(streams.read_zone_stats(spark, log), expected)
    feed.send([(9, 1795, 38.0, 2.0, 8.0), (9, 3600, 38.0, 2.0, 8.0)])  # changes an open window
    run()
    more = positions(spark, rows() + [(9, 1795, 38.0, 2.0, 8.0), (9, 3600, 38.0, 2.0, 8.0)])
    same(streams.read_zone_stats(spark, log), zone_stats(more, "1 minute"))
    feed.send([(9, 0, 38.0, 2.0, 8.0)])  # an hour behind the watermark
    run()
    same(streams.read_zone_stats(spark, log), zone_stats(more, "1 minute"))


def test_live_positions(spark, feed, tmp_path):
    track, latest, checkpoint = (str(tmp_path / n) for n in ("track", "latest", "checkpoint"))
    run = lambda: streams.start_live_positions(feed.stream(), track, latest, checkpoint, ONCE).awaitTermination()
    run()
    everything = positions(spark, rows())
    same(streams.read_latest(spark, latest), latest_positions(everything))
    same(streams.read_track(spark, track), everything.withColumn("date", F.to_date("recorded_at")))
    late = [(1, 3, 40.0, 4.0, 1.0, 0)]
    feed.send(late + [(2, 1770 + 400, 38.5, 1.0, 2.0, 0)])
    run()
    found = {r.mmsi: r for r in streams.read_latest(spark, latest).collect()}
    assert found[2].latitude == 38.5 and found[1].latitude == 38.0  # no step back in time
    assert streams.read_track(spark, track).count() == everything.count() + 2
    now = START + timedelta(seconds=2170 + 60)
    assert [r.mmsi for r in streams.read_live(spark, latest, now).collect()] == [2]


@pytest.mark.parametrize("quiet", [300, 50])
def test_alerts(spark, feed, tmp_path, quiet):
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")
    everything = positions(spark, rows())
    profiles = lambda: vessel_profiles(positions(spark, rows()))
    query = streams.start_alerts(feed.stream(), profiles, log, checkpoint, ONCE, quiet)
    query.awaitTermination()
    expected = emitted_alerts(everything, profiles(), quiet)
    assert {r.type for r in expected.collect()} == {"vessel_stopped_at_sea", "abnormal_speed"}
    same(streams.read_alerts(spark, log), expected)


def test_alert_replay_emits_the_same_rows(spark, feed, tmp_path):
    log = str(tmp_path / "log")
    profiles = lambda: vessel_profiles(positions(spark, rows()))
    checkpoint = tmp_path / "checkpoint"
    streams.start_alerts(feed.stream(), profiles, log, str(checkpoint), ONCE).awaitTermination()
    stored = lambda: sorted(spark.read.parquet(f"{log}/batches").drop("written_at").collect(), key=str)
    before = stored()
    last = max(int(p.name) for p in (checkpoint / "commits").iterdir() if p.name.isdigit())
    # the sink wrote the last batch, but its commit was lost
    (checkpoint / "commits" / str(last)).unlink()
    (checkpoint / "commits" / f".{last}.crc").unlink(missing_ok=True)
    streams.start_alerts(feed.stream(), profiles, log, str(checkpoint), ONCE).awaitTermination()
    assert stored() == before


def test_a_new_checkpoint_keeps_the_old_log(spark, tmp_path):
    log, track, latest = (str(tmp_path / n) for n in ("log", "track", "latest"))
    old, new = Feed(spark, tmp_path / "old"), Feed(spark, tmp_path / "new")
    old.send([(1, 0, 38.0, 1.0, 4.0), (2, 60, 38.0, 1.0, 4.0)])
    new.send([(3, 120, 38.0, 1.0, 4.0)])
    for feed in (old, new):
        name = feed.path.name
        streams.start_zone_stats(feed.stream(), log, str(tmp_path / f"z-{name}"), ONCE).awaitTermination()
        streams.start_live_positions(feed.stream(), track, latest, str(tmp_path / f"p-{name}"), ONCE).awaitTermination()
    assert streams.read_zone_stats(spark, log).count() == 3
    assert streams.read_track(spark, track).count() == 3
    assert streams.read_latest(spark, latest).count() == 3


def test_folded_streams_read_the_same(spark, feed, tmp_path):
    names = ("track", "latest", "zone_stats")
    track, latest, stats = (str(tmp_path / n) for n in names)
    streams.start_live_positions(feed.stream(), track, latest, str(tmp_path / "c1"), ONCE).awaitTermination()
    streams.start_zone_stats(feed.stream(), stats, str(tmp_path / "c2"), ONCE).awaitTermination()
    reads = {"track": streams.read_track, "latest": streams.read_latest, "zone_stats": streams.read_zone_stats}
    for name, path in zip(names, (track, latest, stats)):
        before = sorted(reads[name](spark, path).collect(), key=str)
        assert streams.fold(spark, name, path) >= 2 and streams.fold(spark, name, path) == 0
        assert sorted(reads[name](spark, path).collect(), key=str) == before
        assert len(list((tmp_path / name / "batches").glob("*/*"))) == 1


def test_a_clock_in_the_far_future_moves_nothing(spark, tmp_path):
    feed, log = Feed(spark, tmp_path / "in"), str(tmp_path / "log")
    century = 75 * 365 * 86400
    for t in (0, 60, century, 120, 180):
        feed.send([(1 if t == century else 2, t, 38.0, 1.0, 4.0)])
    # arrival is the file's time, which both streams see, however long one runs before the other
    track, latest = str(tmp_path / "track"), str(tmp_path / "latest")
    streams.start_live_positions(feed.stream(arrival=True), track, latest, str(tmp_path / "p"), ONCE).awaitTermination()
    found = {r.mmsi: r.updated_at for r in streams.read_latest(spark, latest).collect()}
    assert found[1] < START + timedelta(days=3650) and found[2] == START + timedelta(seconds=180)
    # its arrival is years after the other messages' time, so those windows come by settling
    streams.start_zone_stats(feed.stream(arrival=True), log, str(tmp_path / "z"), ONCE).awaitTermination()
    streams.settle_zone_stats(spark, track, log, 0)
    assert streams.read_zone_stats(spark, log).count() == 5


def test_late_windows_are_settled(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in")
    everything = [(m, t, 38.0, 1.0, float(m)) for t in range(0, 1200, 60) for m in (1, 2)]
    for i in range(0, len(everything), 10):
        feed.send(everything[::-1][i : i + 10])
    log, track, latest = (str(tmp_path / n) for n in ("log", "track", "latest"))
    streams.start_zone_stats(feed.stream(), log, str(tmp_path / "z"), ONCE).awaitTermination()
    expected = zone_stats(positions(spark, everything))
    assert streams.read_zone_stats(spark, log).count() < expected.count()
    streams.start_live_positions(feed.stream(), track, latest, str(tmp_path / "p"), ONCE).awaitTermination()
    streams.settle_zone_stats(spark, track, log, 0)
    same(streams.read_zone_stats(spark, log), expected)


def test_a_late_alert_is_emitted(spark, tmp_path):
    feed, log = Feed(spark, tmp_path / "in"), str(tmp_path / "log")
    for t in (7200, 0, 7260):
        feed.send([(1, t, 38.0, 1.0, 0.0, 0)])
    profiles = lambda: vessel_profiles(positions(spark, rows()))
    streams.start_alerts(feed.stream(), profiles, log, str(tmp_path / "c"), ONCE).awaitTermination()
    times = sorted(r.timestamp for r in streams.read_alerts(spark, log).collect())
    assert times == [START, START + timedelta(seconds=7200)]


def test_command_line(spark, feed, tmp_path, monkeypatch):
    monkeypatch.setenv("AIS_BOUNDING_BOXES_JSON", "[[[30, -6], [47, 37]]]")
    logs = str(tmp_path / "logs")
    for job in ("positions", "zone_stats"):
        run.main([job, "--logs", logs, "--checkpoint", str(tmp_path / job), "--files", str(feed.path), "--once"])
    run.main(["fold", "--logs", logs])
    same(streams.read_latest(spark, f"{logs}/latest"), latest_positions(positions(spark, rows())))
    same(streams.read_zone_stats(spark, f"{logs}/zone_stats"), zone_stats(positions(spark, rows())))


def test_failing_sink_fails_the_query(spark, feed, tmp_path):
    def broken():
        raise RuntimeError("no profiles")

    query = streams.start_alerts(feed.stream(), broken, str(tmp_path / "log"), str(tmp_path / "c"), ONCE)
    with pytest.raises(Exception, match="no profiles"):
        query.awaitTermination()
