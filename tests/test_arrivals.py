"""Order of arrival from files, rejected messages, the run log of streams."""

import os

from pyspark.sql import functions as F

from seatrace.operators.messages import flatten_positions, parse_messages, split_messages, to_messages
from seatrace.sources.streams import read_message_files
from seatrace.streaming import jobs as streams
from seatrace.streaming import windows
from seatrace.streaming.run_log import StreamRunLog, counted, read_stream_runs
from tests.test_plans import positions
from tests.test_streaming import ONCE, Feed, rows


def test_of_equal_times_the_later_file_wins(spark, tmp_path):
    """Also within one micro-batch, and whatever the names of the files."""
    folder = tmp_path / "in"
    folder.mkdir()
    for name, speed, changed in (("z", 1.0, 1_000), ("a", 2.0, 3_000), ("m", 3.0, 2_000)):
        line = to_messages(positions(spark, [(1, 0, 38.0, 1.0, speed), (2, int(speed), 38.0, 1.0, speed)])).collect()
        file = folder / f"{name}.txt"
        file.write_text("\n".join(r.value for r in line) + "\n")
        os.utime(file, (1_800_000_000 + changed, 1_800_000_000 + changed))
    track, latest = str(tmp_path / "track"), str(tmp_path / "latest")
    stream = flatten_positions(parse_messages(read_message_files(spark, str(folder), arrival=True)))
    streams.start_live_positions(stream, track, latest, str(tmp_path / "c"), ONCE).awaitTermination()
    found = {r.mmsi: r.speed for r in streams.read_latest(spark, latest).collect()}
    assert found == {1: 2.0, 2: 3.0}  # the last file to change; the latest time
    assert "arrival" not in streams.read_track(spark, track).columns


MESSAGES = [
    ('{"MetaData":{"MMSI":1,"latitude":38.0},"Message":{"PositionReport":{"Sog":2.0}}}', None),
    ('{"MetaData":{"MMSI":2},"Message":null}', None),
    ('{"MetaData":{"MMSI":3,"latitude":"x"},"Message":{}}', None),
    ("not json", "not json"),
    ('{"MetaData":{"MMSI":1', "not json"),
    ("", "empty"),
    ("   ", "empty"),
    (None, "empty"),
    ('{"MetaData":{"MMSI":"x"}}', "no vessel"),
    ('{"MetaData":{"MMSI":4294967296}}', "no vessel"),
    ("{}", "no vessel"),
    ('{"other":1}', "no vessel"),
    ("null", None),
    ("17", None),
    ("[1]", None),
]


def test_every_message_is_a_position_or_a_reject(spark):
    raw = spark.createDataFrame([(text, i) for i, (text, _) in enumerate(MESSAGES)], "value string, number int")
    kept, rejects = split_messages(raw)
    assert kept.count() + rejects.count() == len(MESSAGES)
    found = {r.number: r.reason for r in rejects.collect()}
    assert {i: found.get(i) for i in range(12)} == {i: reason for i, (_, reason) in enumerate(MESSAGES[:12])}
    assert set(range(12, 15)) <= set(found)
    assert {r.number: r.value for r in rejects.collect()}[3] == "not json"
    plain = flatten_positions(parse_messages(raw.select("value")))
    assert sorted(kept.drop("recorded_at").collect(), key=str) == sorted(plain.drop("recorded_at").collect(), key=str)


def test_rejects_of_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    texts = [text for text, _ in MESSAGES if text is not None]
    (tmp_path / "in" / "0.txt").write_text("\n".join(texts) + "\n")
    names = [str(tmp_path / name) for name in ("track", "latest", "rejects", "c")]
    raw = read_message_files(spark, str(tmp_path / "in"))
    streams.start_live_messages(raw, *names, ONCE).awaitTermination()
    rejected = streams.read_rejects(spark, names[2])
    assert streams.read_track(spark, names[0]).count() + rejected.count() == len(texts)
    assert {r.reason for r in rejected.collect()} == {"not json", "empty", "no vessel"}


def test_run_log_has_a_row_per_batch(spark, tmp_path):
    feed, runs = Feed(spark, tmp_path / "in"), str(tmp_path / "runs")
    listener = StreamRunLog(spark, runs)
    spark.streams.addListener(listener)
    everything = rows()
    try:
        for part in (everything[:100], everything[100:130], []):
            if part:
                feed.send(part)
            query = windows.start_zone_windows(
                counted(feed.stream()), str(tmp_path / "log"), str(tmp_path / "c"), ONCE
            )
            query.awaitTermination()
            assert listener.wait(query.runId)
            listener.names[str(query.id)] = "windows"
    finally:
        spark.streams.removeListener(listener)
    found = read_stream_runs(spark, runs).orderBy("batch_id").collect()
    assert [(r.batch_id, r.rows_in, r.source_rows) for r in found] == [(0, 100, 100), (1, 30, 30)]
    assert found[0].query_id == found[1].query_id == str(query.id) and found[1].job_name == "windows"
    assert found[0].run_id != found[1].run_id and all(r.duration_ms > 0 for r in found) and not listener.failed
    assert read_stream_runs(spark, str(tmp_path / "none")) is None


def test_a_log_that_cannot_be_written_breaks_no_stream(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in")
    feed.send(rows()[:50])
    (tmp_path / "runs").write_text("a file where the folder should be")
    listener = StreamRunLog(spark, str(tmp_path / "runs"))
    spark.streams.addListener(listener)
    try:
        query = windows.start_zone_windows(counted(feed.stream()), str(tmp_path / "log"), str(tmp_path / "c"), ONCE)
        query.awaitTermination()
        listener.wait(query.runId)
    finally:
        spark.streams.removeListener(listener)
    assert [batch for batch, _ in listener.failed] == [0]
    assert windows.read_zone_sums(spark, str(tmp_path / "log")).agg(F.sum("messages")).first()[0] == 50
