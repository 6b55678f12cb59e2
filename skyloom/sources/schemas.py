"""Table schemas. Counters and times in raw JSON are read as doubles, because a
report may carry ``1700000001.0`` where a long is meant, and cast afterwards."""

# Field order of a raw state vector.
STATE_FIELDS = [
    ("icao24", "string"),
    ("callsign", "string"),
    ("origin_country", "string"),
    ("time_position", "bigint"),
    ("last_contact", "bigint"),
    ("longitude", "double"),
    ("latitude", "double"),
    ("baro_altitude", "double"),
    ("on_ground", "boolean"),
    ("velocity", "double"),
    ("true_track", "double"),
    ("vertical_rate", "double"),
    ("sensors", "string"),
    ("geo_altitude", "double"),
    ("squawk", "string"),
    ("spi", "boolean"),
    ("position_source", "int"),
]
STATE_NAMES = [name for name, _ in STATE_FIELDS]
WHOLE_NUMBERS = {name: kind for name, kind in STATE_FIELDS if kind in ("bigint", "int")}

STATE_STRUCT = ", ".join(
    f"{name}: {'double' if name in WHOLE_NUMBERS else kind}" for name, kind in STATE_FIELDS
)
BRONZE_SCHEMA = (
    "fetch_timestamp double, ingest_timestamp timestamp, aircraft_count int, "
    f"states array<struct<{STATE_STRUCT}>>"
)

SILVER_COLUMNS = [
    "aircraft_id", "callsign", "origin_country", "event_timestamp", "event_date",
    "latitude", "longitude", "baro_altitude", "geo_altitude", "on_ground", "velocity",
    "heading", "vertical_rate", "squawk", "position_source", "last_contact", "year", "month", "day",
]
SILVER_KEY = ["aircraft_id", "event_timestamp"]
SILVER_ORDER = ["last_contact"]
SILVER_PARTITIONS = ["year", "month", "day"]

AIRPORT_SCHEMA = "airport_code string, airport_name string, airport_lat double, airport_lon double"
