"""SQL twins of the registered queries, for DuckDB over the same ``events`` table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fixtures import POSITIONS_SQL

# Written out here, so that a wrong value in the package does not agree with itself.
DIGITS = "0123456789bcdefghjkmnpqrstuvwxyz"


def spark_round6(name: str) -> Column:
    """Six digits, halves up on the decimal value: both engines agree on it."""
    return F.round(F.col(name).cast("decimal(18,8)"), 6).cast("double").alias(name)


def _round6(expr: str) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(18,8)), 6) AS DOUBLE)"


def _round(column: str, digits: int) -> str:
    """The decimal text of the exact binary value, ties to even."""
    return f"CAST(printf('%.{digits}f', {column}) AS DOUBLE)"


def _zone(lat: str = "latitude", lon: str = "longitude") -> str:
    return f"""CASE WHEN {lat} IS NULL OR {lon} IS NULL THEN 'unknown'
   WHEN {lat} BETWEEN 35 AND 42 AND {lon} BETWEEN -6 AND 0 THEN 'gibraltar'
   WHEN {lat} BETWEEN 36 AND 40 AND {lon} BETWEEN 0 AND 5 THEN 'alboran'
   WHEN {lat} BETWEEN 37 AND 41 AND {lon} BETWEEN 5 AND 12 THEN 'balearic'
   WHEN {lat} BETWEEN 36 AND 42 AND {lon} BETWEEN 12 AND 20 THEN 'central'
   WHEN {lat} BETWEEN 35 AND 40 AND {lon} BETWEEN 20 AND 27 THEN 'eastern'
   WHEN {lat} BETWEEN 30 AND 36 AND {lon} BETWEEN 30 AND 37 THEN 'levant'
   ELSE 'other' END"""


def _axis(x: str, low: int, span: int, bits: int) -> str:
    """Cell number by halving: the count of borders below x, found bit by bit."""
    width = f"(CAST({span} AS DOUBLE)/{2**bits})"
    guess = f"CAST(greatest(0, least({2**bits - 1}, floor(({x}-({low}))/{width}))) AS BIGINT)"
    return (
        f"({guess} - CASE WHEN {guess}>0 AND {x}<=({low})+{guess}*{width} THEN 1 ELSE 0 END)"
    )


def _cell(precision: int, y: str, x: str) -> str:
    """Text of the cell whose row and column numbers are in columns y and x."""
    lat_bits, lon_bits = 5 * precision // 2, (5 * precision + 1) // 2
    digits = []
    for place in range(precision):
        terms = []
        for i in range(5):
            bit = 5 * place + i
            axis, bits = (y, lat_bits) if bit % 2 else (x, lon_bits)
            terms.append(f"(({axis}>>{bits - 1 - bit // 2})&1)*{2 ** (4 - i)}")
        digits.append(f"substr('{DIGITS}', CAST(1+{'+'.join(terms)} AS BIGINT), 1)")
    return "||".join(digits)


def _celled(precision: int, source: str = "bounded") -> str:
    """Common table: ``source`` with y, x, cell and the cell's centre."""
    lat_bits, lon_bits = 5 * precision // 2, (5 * precision + 1) // 2
    return f"""indexed{precision} AS (
  SELECT *, {_axis('latitude', -90, 180, lat_bits)} AS y, {_axis('longitude', -180, 360, lon_bits)} AS x
  FROM {source}),
celled{precision} AS (
  SELECT *, {_cell(precision, 'y', 'x')} AS cell,
    (y+0.5)*(CAST(180 AS DOUBLE)/{2**lat_bits})-90 AS center_lat,
    (x+0.5)*(CAST(360 AS DOUBLE)/{2**lon_bits})-180 AS center_lon
  FROM indexed{precision})"""


POSITIONS = f"positions AS ({POSITIONS_SQL})"
CLEAN = """cleaned AS (
  SELECT * FROM positions
  WHERE mmsi IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL
    AND NOT (latitude BETWEEN -0.001 AND 0.001 AND longitude BETWEEN -0.001 AND 0.001)),
bounded AS (
  SELECT *, CAST(recorded_at AS DATE) AS date FROM cleaned
  WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180)"""
FLAT = "mmsi, ship_name, latitude, longitude, speed, course, heading, nav_status, recorded_at"

LOCATED = f"""located AS (
  SELECT *, {_zone()} AS zone, CAST(recorded_at AS DATE) AS date,
    date_trunc('hour', recorded_at) AS hour
  FROM cleaned WHERE speed IS NOT NULL)"""
MEASURES = """count(DISTINCT mmsi) AS vessel_count, avg(speed) AS avg_raw, max(speed) AS max_raw,
    count(mmsi) AS message_count"""
TRAFFIC = f"""{CLEAN}, {LOCATED},
hourly AS (
  SELECT zone, CAST(hour AS TIMESTAMP) AS hour, date, vessel_count,
    {_round('avg_raw', 2)} AS avg_speed, {_round('max_raw', 2)} AS max_speed, message_count
  FROM (SELECT zone, date, hour, {MEASURES} FROM located WHERE zone <> 'unknown' GROUP BY ALL)),
peaks AS (
  SELECT zone, date, CAST(hour(hour) AS INTEGER) AS peak_hour, vessel_count AS peak_count,
    row_number() OVER (PARTITION BY zone, date ORDER BY vessel_count DESC, hour) AS place
  FROM hourly),
daily AS (
  SELECT d.zone, d.date, d.vessel_count, {_round('d.avg_raw', 2)} AS avg_speed,
    {_round('d.max_raw', 2)} AS max_speed, d.message_count, p.peak_hour, p.peak_count
  FROM (SELECT zone, date, {MEASURES} FROM located WHERE zone <> 'unknown' GROUP BY ALL) d
  LEFT JOIN peaks p ON p.zone = d.zone AND p.date = d.date AND p.place = 1)"""


def _tiles(precision: int) -> str:
    return f"""{_celled(precision)},
counted{precision} AS (
  SELECT date, cell, center_lat, center_lon, count(mmsi) AS n, count(DISTINCT mmsi) AS vessels
  FROM celled{precision} GROUP BY ALL),
scaled{precision} AS (
  SELECT *, ln(1.0+n)/ln(1.0+max(n) OVER (PARTITION BY date)) AS raw FROM counted{precision}),
tiles{precision} AS (
  SELECT CAST({precision} AS INTEGER) AS precision, cell, {_round('center_lat', 6)} AS lat,
    {_round('center_lon', 6)} AS lon, n AS count, vessels, {_round('raw', 4)} AS intensity, date
  FROM scaled{precision})"""


DISTANCE = """2*6371.0088*asin(least(1.0, sqrt(power(sin(radians(latitude-prev_lat)/2),2)
    + cos(radians(prev_lat))*cos(radians(latitude))*power(sin(radians(longitude-prev_lon)/2),2))))"""


def _routes(condition: str = "") -> str:
    return f"""{CLEAN}, {_celled(5)},
steps AS (
  SELECT date, cell, speed, latitude, longitude, center_lat, center_lon,
    lag(cell) OVER w AS prev_cell, lag(latitude) OVER w AS prev_lat,
    lag(longitude) OVER w AS prev_lon, lag(center_lat) OVER w AS prev_center_lat,
    lag(center_lon) OVER w AS prev_center_lon
  FROM celled5 WINDOW w AS (PARTITION BY mmsi, date ORDER BY recorded_at)),
counted AS (
  SELECT date, prev_cell, cell, prev_center_lat, prev_center_lon, center_lat, center_lon,
    count(*) AS n, avg(speed) AS avg_raw
  FROM steps WHERE prev_cell IS NOT NULL AND prev_cell <> cell {condition} GROUP BY ALL),
routes AS (
  SELECT prev_cell AS cell_from, cell AS cell_to, prev_center_lat AS lat_from,
    prev_center_lon AS lon_from, center_lat AS lat_to, center_lon AS lon_to, n AS count,
    {_round('avg_raw', 2)} AS avg_speed, date AS window_date
  FROM counted WHERE n >= 2)"""


PROFILES = """profiles AS (
  SELECT mmsi, avg(speed) AS avg_speed, stddev_samp(speed) AS speed_std_dev
  FROM positions WHERE mmsi IS NOT NULL AND speed IS NOT NULL GROUP BY mmsi)"""


def _alert(kind: str, severity: str, suffix: str, expected: str) -> str:
    stamp = "regexp_replace(strftime(recorded_at, '%Y-%m-%d %H:%M:%S.%f'), '\\.000000$', '')"
    return f"""SELECT sha256(mmsi || '_' || {stamp} || '_{suffix}') AS alert_id, '{kind}' AS type,
    '{severity}' AS severity, mmsi, ship_name, latitude, longitude, speed,
    {expected} AS expected_speed, recorded_at AS timestamp, false AS resolved"""


ALERTS = f"""{PROFILES},
stopped AS (
  {_alert('vessel_stopped_at_sea', 'high', 'stopped', 'CAST(NULL AS DOUBLE)')}
  FROM positions
  WHERE mmsi IS NOT NULL AND speed = 0 AND (nav_status IS NULL OR nav_status NOT IN (1, 5))),
abnormal AS (
  {_alert('abnormal_speed', 'medium', 'speed', 'expected')}
  FROM (SELECT p.*, coalesce(f.avg_speed, 15) AS expected, coalesce(f.speed_std_dev, 5) AS std_dev
        FROM positions p JOIN profiles f USING (mmsi))
  WHERE speed > 5 AND abs(speed - expected) > 2 * std_dev),
alerts AS (SELECT * FROM stopped UNION ALL SELECT * FROM abnormal)"""


def _suppressed(quiet: str) -> str:
    return f"""WITH RECURSIVE {POSITIONS}, {ALERTS},
emitted AS (
  SELECT mmsi, type, min(timestamp) AS timestamp FROM alerts GROUP BY mmsi, type
  UNION ALL
  SELECT a.mmsi, a.type, min(a.timestamp) AS timestamp
  FROM emitted e JOIN alerts a
    ON a.mmsi = e.mmsi AND a.type = e.type AND a.timestamp > e.timestamp + INTERVAL {quiet}
  GROUP BY a.mmsi, a.type)
SELECT a.* REPLACE ({_round6('expected_speed')} AS expected_speed)
FROM alerts a JOIN emitted USING (mmsi, type, timestamp)"""


def _window(seconds: int) -> str:
    start = f"make_timestamp(CAST(floor(epoch_us(recorded_at)/{seconds}e6) AS BIGINT)*{seconds}000000)"
    return f"""WITH {POSITIONS},
windows AS (
  SELECT {_zone()} AS zone, {start} AS window_start, speed
  FROM positions WHERE mmsi IS NOT NULL)
SELECT zone, window_start, window_start + INTERVAL {seconds} SECOND AS window_end,
  coalesce(avg(speed), 0) AS avg_speed, count(*) AS vessel_count,
  window_start + INTERVAL {seconds} SECOND AS timestamp
FROM windows WHERE zone <> 'unknown' GROUP BY zone, window_start"""


def _late_windows() -> str:
    """Hours that hold a row of the late part whose hour had ended a minute before the newest
    row of the first part."""
    return f"""WITH {POSITIONS},
located AS (
  SELECT {_zone()} AS zone, CAST(date_trunc('hour', recorded_at) AS TIMESTAMP) AS window_start, speed,
    recorded_at, event_id % 7 = 0 AS second
  FROM positions WHERE mmsi IS NOT NULL),
known AS (SELECT * FROM located WHERE zone <> 'unknown'),
high AS (SELECT max(recorded_at) - INTERVAL 1 MINUTE AS mark FROM known WHERE NOT second),
marked AS (SELECT known.*, second AND window_start + INTERVAL 1 HOUR <= mark AS late FROM known, high)
SELECT zone, window_start, window_start + INTERVAL 1 HOUR AS window_end, coalesce(avg(speed), 0) AS avg_speed,
  count(*) AS vessel_count, count(*) FILTER (late) AS late_messages, window_start + INTERVAL 1 HOUR AS timestamp
FROM marked GROUP BY zone, window_start HAVING bool_or(late)"""


def _zone_vessels() -> str:
    return f"""WITH {POSITIONS},
located AS (
  SELECT {_zone()} AS zone, CAST(date_trunc('hour', recorded_at) AS TIMESTAMP) AS window_start, speed, mmsi
  FROM positions WHERE mmsi IS NOT NULL)
SELECT zone, window_start, count(*) AS vessel_count, coalesce(avg(speed), 0) AS avg_speed,
  count(DISTINCT mmsi) AS vessels, true AS within_bound
FROM located WHERE zone <> 'unknown' GROUP BY zone, window_start"""


def _rollup() -> str:
    """Days and weeks counted from the positions themselves."""
    layers = "\nUNION ALL\n".join(
        f"""SELECT t.zone, '{period}' AS period, CAST(t.start AS DATE) AS period_start, t.vessel_count,
  {_round('t.avg_raw', 2)} AS avg_speed, {_round('t.max_raw', 2)} AS max_speed, t.message_count,
  h.hour AS peak_hour, h.n AS peak_count
FROM (SELECT zone, date_trunc('{period}', date) AS start, {MEASURES} FROM located WHERE zone <> 'unknown' GROUP BY ALL) t
JOIN (SELECT zone, start, hour, n, row_number() OVER (PARTITION BY zone, start ORDER BY n DESC, hour) AS place
      FROM (SELECT zone, date_trunc('{period}', date) AS start, CAST(hour AS TIMESTAMP) AS hour, count(DISTINCT mmsi) AS n
            FROM located WHERE zone <> 'unknown' GROUP BY ALL)) h
  ON h.zone = t.zone AND h.start = t.start AND h.place = 1"""
        for period in ("day", "week")
    )
    return f"WITH {POSITIONS}, {CLEAN}, {LOCATED}\n{layers}"


def _latest(source: str = "positions") -> str:
    columns = ["ship_name", "latitude", "longitude", "speed", "course", "heading", "nav_status"]
    newest = ", ".join(f"arg_max_null({c}, recorded_at) AS {c}" for c in columns)
    return f"SELECT mmsi, {newest}, max(recorded_at) AS updated_at FROM {source} WHERE mmsi IS NOT NULL GROUP BY mmsi"


def _message() -> str:
    """Message fields read back from JSON text that DuckDB itself wrote."""
    return f"""texts AS (
  SELECT to_json({{'MetaData': {{'MMSI': mmsi, 'ShipName': ship_name, 'latitude': latitude,
      'longitude': longitude, 'time_utc': strftime(recorded_at, '%Y-%m-%d %H:%M:%S.%f +0000 UTC')}},
    'Message': {{'PositionReport': {{'Sog': speed, 'Cog': course, 'TrueHeading': heading,
      'NavigationalStatus': nav_status}}}}, 'MessageType': message_type}}) AS value
  FROM positions),
messages AS (
  SELECT CAST(value->>'$.MetaData.MMSI' AS INT) AS mmsi, value->>'$.MetaData.ShipName' AS ship_name,
    CAST(value->>'$.MetaData.latitude' AS DOUBLE) AS latitude,
    CAST(value->>'$.MetaData.longitude' AS DOUBLE) AS longitude,
    CAST(value->>'$.Message.PositionReport.Sog' AS DOUBLE) AS speed,
    CAST(value->>'$.Message.PositionReport.Cog' AS DOUBLE) AS course,
    CAST(value->>'$.Message.PositionReport.TrueHeading' AS INT) AS heading,
    CAST(value->>'$.Message.PositionReport.NavigationalStatus' AS INT) AS nav_status,
    CAST(replace(value->>'$.MetaData.time_utc', ' +0000 UTC', '') AS TIMESTAMP) AS recorded_at,
    value->>'$.MessageType' AS message_type
  FROM texts)"""


def _key_values() -> str:
    return f"""WITH {POSITIONS}, latest AS ({_latest()})
SELECT 'vessel:' || mmsi AS key, mmsi, ship_name, latitude, longitude, speed, course, heading, nav_status,
    regexp_replace(strftime(updated_at, '%Y-%m-%d %H:%M:%S.%f'), '\\.000000$', '') AS updated_at
FROM latest"""


def statements() -> dict[str, str]:
    clean = f"WITH {POSITIONS}, {CLEAN}"
    traffic = f"WITH {POSITIONS}, {TRAFFIC}"
    tiles5, tiles6 = (f"{clean}, {_tiles(p)}" for p in (5, 6))
    routes = f"WITH {POSITIONS}, {_routes()}"
    alerts = f"WITH {POSITIONS}, {ALERTS}"
    latest = f"WITH {POSITIONS} {_latest()}"
    return {
        "clean_positions": f"{clean} SELECT * FROM cleaned",
        "clean_positions_strict": f"""{clean}
SELECT event_id, mmsi, latitude, longitude, speed FROM bounded WHERE speed IS NOT NULL""",
        "settled_position_scan": f"""{clean}
SELECT {FLAT}, date FROM bounded""",
        "parse_flatten": f"WITH {POSITIONS}, {_message()} SELECT {FLAT} FROM messages WHERE mmsi IS NOT NULL",
        "filter_messages_bbox": f"""WITH {POSITIONS}, {_message()}
SELECT {FLAT} FROM messages WHERE mmsi IS NOT NULL AND message_type = 'PositionReport'
  AND latitude BETWEEN 30 AND 47 AND longitude BETWEEN -6 AND 37""",
        "zone_lookup": f"WITH {POSITIONS} SELECT event_id, latitude, longitude, {_zone()} AS zone FROM positions",
        "zone_lookup_table": f"WITH {POSITIONS} SELECT event_id, latitude, longitude, {_zone()} AS zone FROM positions",
        "zone_lookup_wrapped": f"""WITH {POSITIONS},
found AS (
  SELECT event_id, latitude, longitude, CASE WHEN latitude IS NULL OR longitude IS NULL THEN 'unknown'
    WHEN latitude BETWEEN 30 AND 38 AND (longitude BETWEEN 18 AND 180 OR longitude BETWEEN -180 AND -2) THEN 'far'
    WHEN latitude BETWEEN 30 AND 45 AND (longitude BETWEEN 9 AND 180 OR longitude BETWEEN -180 AND 1) THEN 'wide'
    WHEN latitude BETWEEN 30 AND 45 AND longitude BETWEEN 0 AND 20 THEN 'rest' ELSE 'other' END AS zone
  FROM positions)
SELECT *, zone AS fixed FROM found""",
        "zone_window_stats": _window(10),
        "zone_window_stats_1h": _window(3600),
        "zone_traffic_hourly": f"{traffic} SELECT * FROM hourly",
        "zone_traffic_daily": f"{traffic} SELECT * FROM daily",
        "cell_snap_p5": f"{clean}, {_celled(5)} SELECT event_id, cell FROM celled5",
        "cell_snap_p6": f"{clean}, {_celled(6)} SELECT event_id, cell FROM celled6",
        "cell_centers": f"{clean}, {_celled(6)} SELECT DISTINCT cell, center_lat AS lat, center_lon AS lon FROM celled6",
        "heatmap_tiles_p5": f"{tiles5} SELECT * FROM tiles5",
        "heatmap_tiles_p6": f"{tiles6} SELECT * FROM tiles6",
        "heatmap_pyramid": f"{tiles5}, {_tiles(6)} SELECT * FROM tiles5 UNION ALL SELECT * FROM tiles6",
        "route_segments": f"{routes} SELECT * FROM routes",
        "route_segments_ranged": f"{routes} SELECT * FROM routes",
        "zone_traffic_rollup": _rollup(),
        "route_segments_max_jump": f"WITH {POSITIONS}, {_routes(f'AND {DISTANCE} <= 500')} SELECT * FROM routes",
        "vessel_profiles": f"""WITH {POSITIONS}, {PROFILES}
SELECT mmsi, {_round6('avg_speed')} AS avg_speed, {_round6('speed_std_dev')} AS speed_std_dev FROM profiles""",
        "alerts_stopped": f"{alerts} SELECT * FROM stopped",
        "alerts_abnormal_speed": f"""{alerts}
SELECT * REPLACE ({_round6('expected_speed')} AS expected_speed) FROM abnormal""",
        "alert_ids": f"{alerts} SELECT alert_id, type, severity, mmsi, timestamp, resolved FROM alerts",
        "alerts_suppressed": _suppressed("24 HOUR"),
        "alerts_suppressed_5min": _suppressed("5 MINUTE"),
        "latest_positions": latest,
        "latest_positions_live": f"""WITH {POSITIONS},
seen AS (SELECT * FROM positions WHERE recorded_at <= TIMESTAMP '2024-01-20 12:00:00'),
latest AS ({_latest('seen')})
SELECT * FROM latest WHERE updated_at > TIMESTAMP '2024-01-20 06:00:00'""",
        "latest_key_values": _key_values(),
        "expire_positions": f"""WITH {POSITIONS}
SELECT * FROM positions WHERE recorded_at >= TIMESTAMP '2024-01-21 00:00:00'""",
        "top_routes": f"""{routes}
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY window_date
  ORDER BY count DESC, cell_from, cell_to) AS INTEGER) AS place FROM routes) WHERE place <= 5""",
        "tiles_hottest": f"{tiles6} SELECT * FROM tiles6 ORDER BY date, precision, intensity DESC, cell",
        "tiles_bbox": f"""{tiles6}
SELECT * FROM tiles6 WHERE lat BETWEEN 36 AND 41 AND lon BETWEEN -6 AND 14""",
        "tiles_box_ranges": f"""{tiles6}
SELECT * FROM tiles6 WHERE lat BETWEEN 36 AND 41 AND lon BETWEEN -6 AND 14""",
        "zone_hours": f"{traffic} SELECT * FROM hourly ORDER BY zone, hour",
        "busiest_zones": f"""{traffic}
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY date
  ORDER BY vessel_count DESC, zone) AS INTEGER) AS place FROM daily) WHERE place <= 3""",
        "zone_trend": f"""{traffic}
SELECT zone, date, vessel_count, lag(vessel_count) OVER w AS previous_count,
  vessel_count - lag(vessel_count) OVER w AS change
FROM daily WINDOW w AS (PARTITION BY zone ORDER BY date)""",
        "vessel_track": f"""WITH {POSITIONS}
SELECT {FLAT}, CAST(recorded_at AS DATE) AS date FROM positions WHERE mmsi IS NOT NULL
ORDER BY mmsi, date, recorded_at DESC""",
        "upsert_merge": _merged(),
        "job_run_log": _job_runs(),
        "job_route_segments": f"{routes} SELECT * FROM routes",
        "job_zone_traffic_hourly": f"{traffic} SELECT * FROM hourly",
        "job_zone_traffic_daily": f"{traffic} SELECT * FROM daily",
        "job_heatmap_tiles": f"{tiles5}, {_tiles(6)} SELECT * FROM tiles5 UNION ALL SELECT * FROM tiles6",
        "job_vessel_profiles": f"""WITH {POSITIONS}, {PROFILES}
SELECT mmsi, {_round6('avg_speed')} AS avg_speed, {_round6('speed_std_dev')} AS speed_std_dev FROM profiles""",
        "stream_zone_stats": _window(10),
        "stream_restart": _window(10),
        "stream_zone_stats_late": _window(10),
        "stream_zone_windows": _window(10),
        "stream_late_windows": _late_windows(),
        "stream_zone_vessels": _zone_vessels(),
        "stream_latest": latest,
        "stream_track": f"""WITH {POSITIONS}
SELECT {FLAT}, CAST(recorded_at AS DATE) AS date FROM positions WHERE mmsi IS NOT NULL""",
        "stream_latest_ties": f"""WITH {POSITIONS},
later AS (SELECT * REPLACE (speed + 1 AS speed) FROM positions) {_latest('later')}""",
        "stream_rejects": f"""WITH {POSITIONS}
SELECT CASE WHEN event_id % 53 = 0 THEN 'not json' WHEN event_id % 59 = 0 THEN 'empty'
    WHEN mmsi IS NULL THEN 'no vessel' ELSE 'position' END AS became, count(*) AS messages
FROM positions GROUP BY became""",
        "stream_run_log": f"""WITH {POSITIONS}
SELECT CAST(least((day(recorded_at) - 1) // 5, 5) AS BIGINT) AS batch_id, count(*) AS rows_in,
  CAST(0 AS BIGINT) AS state_rows
FROM positions WHERE mmsi IS NOT NULL GROUP BY batch_id""",
        "stream_alerts_state": _suppressed("24 HOUR"),
        "stream_alerts": _suppressed("24 HOUR"),
    }


def _merged() -> str:
    """Both runs side by side; the rerun wins where it has the key."""
    rerun = TRAFFIC
    for name in ("cleaned", "bounded", "located", "hourly", "peaks", "daily"):
        rerun = rerun.replace(f"{name} AS (", f"{name}_2 AS (").replace(f"FROM {name}", f"FROM {name}_2")
    rerun = rerun.replace("JOIN peaks", "JOIN peaks_2").replace("FROM positions", "FROM late")
    return f"""WITH {POSITIONS}, {TRAFFIC},
late AS (SELECT * FROM positions WHERE recorded_at >= TIMESTAMP '2024-01-15 00:00:00'
  AND speed > 20 AND longitude < 12),
{rerun}
SELECT * FROM daily_2
UNION ALL
SELECT d.* FROM daily d WHERE NOT EXISTS (
  SELECT 1 FROM daily_2 r WHERE r.zone = d.zone AND r.date = d.date)"""


def _job_runs() -> str:
    counts = {
        "heatmap": ("bounded", "(SELECT count(*) FROM tiles5) + (SELECT count(*) FROM tiles6)"),
        "routes": ("bounded", "(SELECT count(*) FROM routes)"),
        "vessel_profiles": (
            "positions WHERE mmsi IS NOT NULL",
            "(SELECT count(*) FROM profiles) + (SELECT count(DISTINCT (mmsi, CAST(recorded_at AS DATE))) "
            "FROM positions WHERE mmsi IS NOT NULL AND speed IS NOT NULL)",
        ),
        "zone_traffic": (
            "cleaned WHERE speed IS NOT NULL",
            "(SELECT count(*) FROM hourly) + (SELECT count(*) FROM daily)",
        ),
        "zone_rollup": (
            "cleaned WHERE speed IS NOT NULL",
            "(SELECT count(DISTINCT (zone, hour, (mmsi - 1) // 32768)) FROM located WHERE zone <> 'unknown') + "
            "(SELECT count(*) FROM daily) + "
            "(SELECT count(DISTINCT (zone, date_trunc('week', date))) FROM located WHERE zone <> 'unknown')",
        ),
    }
    routes = _routes().split(",\nsteps AS", 1)[1].replace("counted AS", "moved AS").replace("FROM counted ", "FROM moved ")
    rows = "\nUNION ALL\n".join(
        f"SELECT '{job}' AS job_name, 'succeeded' AS status, (SELECT count(*) FROM {read}) AS rows_read, {written} AS rows_written"
        for job, (read, written) in counts.items()
    )
    return f"""WITH {POSITIONS}, {TRAFFIC}, {PROFILES}, {_tiles(5)}, {_tiles(6)},
steps AS{routes}
{rows}"""
