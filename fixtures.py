"""Test positions derived from the driver's ``events`` table (FIXTURES.md section 3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# One text for Spark and DuckDB.
POSITIONS_SQL = """
SELECT event_id,
 CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST(200000000 + user_id AS INT) END AS mmsi,
 concat('VESSEL ', user_id) AS ship_name,
 CASE WHEN event_id % 97 = 0 THEN NULL
      WHEN event_id % 89 = 0 THEN CAST(0.0005 AS DOUBLE)
      WHEN event_id % 83 = 0 THEN CAST(91 AS DOUBLE)
      ELSE CAST(wlat AS DOUBLE) + (event_id % 5)*CAST(0.03125 AS DOUBLE) END AS latitude,
 CASE WHEN event_id % 97 = 0 THEN NULL
      WHEN event_id % 89 = 0 THEN CAST(-0.0005 AS DOUBLE)
      ELSE CAST(wlon AS DOUBLE) + (event_id % 3)*CAST(0.03125 AS DOUBLE) END AS longitude,
 CASE WHEN event_id % 11 = 0 THEN NULL
      WHEN event_type = 'error' THEN CAST(0 AS DOUBLE)
      ELSE CAST(CAST(floor(value*4) AS BIGINT) % 100 AS DOUBLE)/4 END AS speed,
 CAST((event_id*13) % 3600 AS DOUBLE)/10 AS course,
 CAST((event_id*13) % 360 AS INT) AS heading,
 CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(event_id % 9 AS INT) END AS nav_status,
 ts AS recorded_at,
 CASE WHEN event_type = 'signup' THEN 'ShipStaticData' ELSE 'PositionReport' END AS message_type
FROM events JOIN (VALUES
  (0,35.5,-5.5),(1,37.25,-1.0),(2,36.5,1.5),(3,38.75,4.25),(4,37.5,6.5),(5,40.25,9.75),
  (6,38.0,13.5),(7,41.5,18.25),(8,35.75,22.5),(9,37.9375,25.25),(10,31.25,32.5),
  (11,34.5,35.25),(12,43.25,8.5),(13,33.5,15.5)) AS w(k,wlat,wlon)
  ON k = (event_id*7+user_id*3) % 14
"""


def positions_of(events: DataFrame) -> DataFrame:
    """Flat positions of an ``events`` DataFrame, batch or stream.

    ``inline`` finishes each row before a query filters it. A stored position table has
    plain columns; without this, every filter would repeat the CASE expressions and the
    generated code would grow past what the JVM compiles.
    """
    text = POSITIONS_SQL.replace("FROM events", "FROM {events}")
    rows = events.sparkSession.sql(text, events=events)
    typed = rows.withColumn("recorded_at", F.col("recorded_at").cast("timestamp"))
    return typed.select(F.inline(F.array(F.struct("*"))))


def load_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions_of(spark.read.parquet(f"{sf_dir}/events.parquet"))
