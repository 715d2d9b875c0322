"""Parsing, message filters, sources and settings."""

import json
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from seatrace import settings
from seatrace.operators.messages import (
    filter_messages,
    flatten_positions,
    parse_messages,
    to_messages,
)
from seatrace.sources.streams import broker_options, read_message_files, read_topic


def message(**changes):
    meta = {"MMSI": 7, "ShipName": "A", "latitude": 36, "longitude": 1.5, "time_utc": "2024-01-15 14:00:00.5 +0000 UTC"}
    report = {"Sog": 3, "Cog": 90.5, "TrueHeading": 91, "NavigationalStatus": 0}
    meta.update(changes)
    return json.dumps({"MetaData": meta, "Message": {"PositionReport": report}, "MessageType": "PositionReport"})


def parse(spark, *values):
    raw = spark.createDataFrame([(v,) for v in values], "value string")
    return parse_messages(raw.select(F.col("value").cast("binary").alias("value")))


def test_good_message(spark):
    row = flatten_positions(parse(spark, message())).collect()[0]
    assert row.asDict() == {
        "mmsi": 7, "ship_name": "A", "latitude": 36.0, "longitude": 1.5, "speed": 3.0, "course": 90.5,
        "heading": 91, "nav_status": 0, "recorded_at": datetime(2024, 1, 15, 14, 0, 0, 500000),
    }


@pytest.mark.parametrize("mmsi", ["x", 1.5, 4294967296, None])
def test_bad_field_turns_null_and_siblings_survive(spark, mmsi):
    row = parse(spark, message(MMSI=mmsi)).collect()[0]
    assert row.MetaData.MMSI is None and row.MetaData.ShipName == "A"


def test_rows_without_vessel_leave(spark):
    lower = message().replace("MMSI", "mmsi")
    assert flatten_positions(parse(spark, "not json", lower, "", None, "{}")).count() == 0
    no_report = json.dumps({"MetaData": {"MMSI": 5}})
    row = flatten_positions(parse(spark, no_report)).collect()[0]
    assert (row.mmsi, row.speed, row.nav_status) == (5, None, None)


def test_unreadable_time_falls_back_to_received(spark):
    received = datetime(2024, 2, 1)
    raw = spark.createDataFrame([(message(time_utc="?"), received)], "value string, timestamp timestamp")
    assert flatten_positions(parse_messages(raw)).collect()[0].recorded_at == received
    assert flatten_positions(parse(spark, message(time_utc=None))).collect()[0].recorded_at is not None


def test_message_is_parsed_once(spark):
    plan = flatten_positions(parse(spark, message()))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_filters(spark):
    inside, outside = message(), message(latitude=29.9)
    parsed = parse(spark, inside, outside, inside.replace('"PositionReport"}', '"Other"}'))
    assert filter_messages(parsed).count() == 3
    assert filter_messages(parsed, settings.DEFAULT_BOXES).count() == 2
    assert filter_messages(parsed, [[[47, 37], [30, -6]], [[0, 0], [29.9, 2]]], ["PositionReport"]).count() == 2


def test_settings():
    assert settings.bounding_boxes({}) == settings.DEFAULT_BOXES
    assert settings.bounding_boxes({"AIS_BOUNDING_BOXES_JSON": "[[1"}) == settings.DEFAULT_BOXES
    assert settings.bounding_boxes({"AIS_BOUNDING_BOXES_JSON": "[[[0,1],[2,3]]]"}) == [[[0, 1], [2, 3]]]
    assert settings.message_types({}) == ["PositionReport"]
    assert settings.message_types({"AIS_FILTER_MESSAGE_TYPES": " A, ,B"}) == ["A", "B"]
    assert settings.message_types({"AIS_FILTER_MESSAGE_TYPES": ""}) == []
    now = datetime(2024, 3, 1, 1, tzinfo=timezone.utc)
    assert settings.batch_date({}, now) == date(2024, 2, 29)
    assert settings.batch_date({"BATCH_DATE": "2024-01-15"}) == date(2024, 1, 15)


def test_where_a_stream_starts():
    """Positions read the backlog and go on over gaps; the others begin with what comes next."""
    env = {"KAFKA_STARTING_OFFSETS": "latest", "KAFKA_BROKER": "b:1"}
    assert settings.stream_settings("positions", {}) == {
        "broker": settings.DEFAULT_BROKER, "starting_offsets": "earliest", "fail_on_data_loss": False
    }
    assert settings.stream_settings("positions", env)["starting_offsets"] == "latest"
    for job in ("zone_stats", "alerts"):
        assert settings.stream_settings(job, env | {"KAFKA_STARTING_OFFSETS": "earliest"}) == {
            "broker": "b:1", "starting_offsets": "latest"
        }
        assert "failOnDataLoss" not in broker_options(**settings.stream_settings(job, env))
    options = broker_options(**settings.stream_settings("positions", {}))
    assert (options["startingOffsets"], options["failOnDataLoss"]) == ("earliest", "false")


def test_broker_options(spark):
    plain = broker_options("b:1")
    assert plain["startingOffsets"] == "latest" and "failOnDataLoss" not in plain
    assert broker_options("b:1", fail_on_data_loss=False)["failOnDataLoss"] == "false"
    with pytest.raises(Exception, match="kafka"):  # the connector is not on this machine
        read_topic(spark, "b:1")


def test_file_source_round_trip(spark, tmp_path):
    positions = flatten_positions(parse(spark, message(), message(MMSI=8)))
    to_messages(positions).write.text(str(tmp_path / "in"))
    stream = flatten_positions(parse_messages(read_message_files(spark, str(tmp_path / "in"), 1)))
    query = stream.writeStream.format("memory").queryName("back").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(spark.table("back").collect()) == sorted(positions.collect())
