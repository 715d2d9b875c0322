"""Message and table schemas, as DDL."""

# Field names and types of the incoming JSON message.
MESSAGE = (
    "MetaData struct<MMSI:int, ShipName:string, latitude:double, longitude:double, time_utc:string>, "
    "Message struct<PositionReport:struct<Sog:double, Cog:double, TrueHeading:int, NavigationalStatus:int>>, "
    "MessageType string"
)

# Flat position row; the trajectory table adds nothing and is unique on (mmsi, date, recorded_at).
POSITION_COLUMNS = [
    "mmsi",
    "ship_name",
    "latitude",
    "longitude",
    "speed",
    "course",
    "heading",
    "nav_status",
    "recorded_at",
]

# Declared key of every stored table.
KEYS = {
    "positions": ["mmsi", "date", "recorded_at"],
    "latest_positions": ["mmsi"],
    "zone_stats": ["zone", "window_start"],
    "alerts": ["alert_id"],
    "route_segments": ["cell_from", "cell_to", "window_date"],
    "zone_traffic_hourly": ["zone", "hour"],
    "zone_traffic_daily": ["zone", "date"],
    "zone_hours": ["zone", "hour", "bucket"],
    "zone_rollup": ["zone", "period", "period_start"],
    "heatmap_tiles": ["precision", "cell", "date"],
    "speed_moments": ["mmsi", "date"],
    "vessel_profiles": ["mmsi"],
    "job_runs": ["job_name", "run_date"],
}
