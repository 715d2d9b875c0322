"""The feed of the stream queries: positions derived once, stored by day."""

from datetime import datetime

import pytest

import __spark_entry__ as registered
from fixtures import load_positions
from pyspark.sql import functions as F
from seatrace.operators.messages import to_messages


@pytest.fixture
def sf_dir(spark, tmp_path):
    events = [
        (i, datetime(2024, 1, 1 + i % 31, 5, 0, i % 60) if i % 17 else None, i % 9, "view", float(i % 50), "{}")
        for i in range(300)
    ]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(events, schema).write.parquet(str(tmp_path / "sf/events.parquet"))
    return str(tmp_path / "sf")


def values(rows):
    return sorted(r.value for r in rows.collect())


def test_a_delivery_reads_its_days_of_the_stored_positions_only(spark, sf_dir):
    feed = registered.Feed(spark, sf_dir)
    assert not any("events.parquet" in name for name in feed.messages.inputFiles())
    part = feed.messages.filter("day between 6 and 10").withColumn("file", F.input_file_name())
    days = {r.file.rpartition("/day=")[2].partition("/")[0] for r in part.collect()}
    assert days == {"6", "7", "8", "9", "10"}
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_deliveries_are_the_messages_of_their_rows(spark, sf_dir):
    feed = registered.Feed(spark, sf_dir)
    rows = load_positions(spark, sf_dir).withColumn("day", F.dayofmonth("recorded_at"))
    direct = to_messages(rows, None, ["day", "event_id"])
    feed.send("day between 1 and 5")
    assert values(spark.read.text(feed.folder)) == values(direct.filter("day between 1 and 5"))
    feed.send("number % 7 = 0")
    expected = direct.filter("day between 1 and 5").union(direct.filter("event_id % 7 = 0"))
    assert values(spark.read.text(feed.folder)) == values(expected)


def test_each_delivery_starts_every_query(spark, sf_dir):
    feed, seen = registered.Feed(spark, sf_dir), []

    class Done:
        def awaitTermination(self):
            pass

    def start(name):
        return lambda rows: seen.append((name, spark.read.text(feed.folder).count())) or Done()

    feed.deliver(["number < 10", "number >= 10"], start("a"), start("b"))
    assert seen == [("a", 10), ("b", 10), ("a", 300), ("b", 300)]
