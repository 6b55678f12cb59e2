"""The registered queries in plain SQL, for comparison by another engine."""

from skyloom import constants as C
from skyloom.plans.telemetry import HUB_SQL, OTHER_EPOCH, STATE_SQL
from skyloom.sources.schemas import STATE_NAMES

ORACLES: dict[str, str] = {}
FAMILY_NAMES = ["lgbm", "xgboost", "catboost", "random_forest", "hgb"]  # in the order of operators.models


def r(*names):
    """Six places, no negative zero."""
    return ", ".join(f"round({n}, 6) + 0.0 AS {n}" for n in names)


def _km(lat1, lon1, lat2, lon2):
    return (
        f"{2 * C.EARTH_RADIUS_KM} * asin(sqrt(least(1.0, pow(sin(radians({lat2} - {lat1}) / 2), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"
    )


CTES = {}
NEEDS = {}


def cte(name, sql, *needs):
    CTES[name], NEEDS[name] = sql.strip(), needs


def with_(sql, *needs):
    """``sql`` after all the common tables it needs."""
    ordered = []

    def add(name):
        for other in NEEDS[name]:
            add(other)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        add(name)
    if not ordered:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in ordered) + "\n" + sql


def oracle(name, sql, *needs):
    ORACLES[name] = with_(sql.strip(), *needs)


STATES = ", ".join(f"{STATE_SQL[n].format(epoch=OTHER_EPOCH)} AS {n}" for n in STATE_NAMES)
cte("states", f"SELECT event_id, ts, user_id, {STATES} FROM events")
cte("hubs", "SELECT " + ", ".join(f"{sql} AS {n}" for n, sql in HUB_SQL.items()) + " FROM nation")

FLAT = (
    "icao24 AS aircraft_id, callsign, origin_country, time_position, last_contact, longitude, latitude, "
    "baro_altitude, on_ground, velocity, true_track AS heading, vertical_rate, geo_altitude, squawk, position_source"
)
GOOD = (
    "time_position IS NOT NULL AND aircraft_id IS NOT NULL AND baro_altitude BETWEEN -500 AND 15000 "
    "AND velocity BETWEEN 0 AND 400 AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180"
)
REST = (
    "callsign, origin_country, longitude, latitude, baro_altitude, on_ground, velocity, heading, "
    "vertical_rate, geo_altitude, squawk, position_source"
)
LATEST_FIRST = "last_contact DESC NULLS LAST, " + ", ".join(f"{c} DESC NULLS LAST" for c in REST.split(", "))
cte("flat", f"SELECT event_id, {FLAT} FROM states", "states")
cte("clean", f"SELECT * FROM flat WHERE {GOOD}", "flat")
cte(
    "silver",
    f"""SELECT * EXCLUDE (rn), TIMESTAMP '1970-01-01' + to_seconds(time_position) AS event_timestamp
    FROM (SELECT *, row_number() OVER (PARTITION BY aircraft_id, time_position ORDER BY {LATEST_FIRST}) AS rn FROM clean)
    WHERE rn = 1""",
    "clean",
)

RAW = ", ".join(STATE_NAMES)
SHORT = ", ".join(n if i < 7 else f"NULL AS {n}" for i, n in enumerate(STATE_NAMES))
PARSED = f"""SELECT event_id, last_contact AS fetch_timestamp, {RAW} FROM states
UNION ALL SELECT event_id, last_contact AS fetch_timestamp, {SHORT} FROM states"""
oracle("parse_states", PARSED, "states")
oracle(
    "validate_states",
    """SELECT event_id, icao24, latitude, longitude FROM states, (VALUES (1), (2)) AS twice(n)
    WHERE latitude IS NOT NULL AND longitude IS NOT NULL""",
    "states",
)
oracle(
    "land_bronze",
    """SELECT CAST(last_contact AS DOUBLE) AS fetch_timestamp,
    CAST(CASE WHEN longitude IS NULL THEN 0 ELSE 2 END AS INTEGER) AS aircraft_count,
    strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day FROM states""",
    "states",
)
for name, at in (("explode_flatten", "ts"), ("bronze_scan", "date_trunc('millisecond', ts)")):
    oracle(
        name,
        f"SELECT last_contact AS fetch_timestamp, {at} AS ingest_timestamp, {FLAT} FROM states",
        "states",
    )
oracle("silver_clean", f"SELECT event_id, aircraft_id, callsign, origin_country, time_position, last_contact, longitude, latitude, baro_altitude, on_ground, velocity, heading, vertical_rate, geo_altitude, squawk, position_source FROM clean", "clean")
cte(
    "rejected",
    """SELECT * FROM (SELECT event_id, aircraft_id, CASE
      WHEN time_position IS NULL THEN 'time_position missing'
      WHEN latitude IS NULL THEN 'latitude missing'
      WHEN longitude IS NULL THEN 'longitude missing'
      WHEN baro_altitude IS NULL THEN 'baro_altitude missing'
      WHEN aircraft_id IS NULL THEN 'aircraft_id missing'
      WHEN baro_altitude < -500 OR baro_altitude > 15000 THEN 'baro_altitude out of range'
      WHEN velocity IS NULL OR velocity < 0 OR velocity > 400 THEN 'velocity out of range'
      WHEN latitude < -90 OR latitude > 90 THEN 'latitude out of range'
      WHEN longitude < -180 OR longitude > 180 THEN 'longitude out of range' END AS reject_reason FROM flat)
    WHERE reject_reason IS NOT NULL""",
    "flat",
)
oracle("silver_quarantine", "SELECT * FROM rejected", "rejected")
oracle(
    "silver_dedup",
    f"""SELECT aircraft_id, time_position, last_contact, {REST}, poll FROM (
      SELECT *, row_number() OVER (PARTITION BY aircraft_id, time_position ORDER BY {LATEST_FIRST}) AS rn
      FROM (SELECT * REPLACE (last_contact + 10 * poll AS last_contact)
        FROM (SELECT clean.*, CAST(n AS INTEGER) AS poll FROM clean, (VALUES (0), (1), (2)) AS polls(n))))
    WHERE rn = 1""",
    "clean",
)
DATES = "CAST(year(event_timestamp) AS INTEGER) AS year, CAST(month(event_timestamp) AS INTEGER) AS month, CAST(day(event_timestamp) AS INTEGER) AS day"
for name, later in (("silver_table", 0), ("stream_merge", 0), ("stream_merge_batches", 20)):
    oracle(
        name,
        f"""SELECT last_contact + {later} AS last_contact, aircraft_id, callsign, origin_country, event_timestamp, CAST(event_timestamp AS DATE) AS event_date,
        latitude, longitude, baro_altitude, geo_altitude, on_ground, velocity, heading, vertical_rate, squawk,
        position_source, {DATES} FROM silver""",
        "silver",
    )
oracle(
    "silver_write_readback",
    f"""SELECT year, month, day, count(*) AS n, count(DISTINCT aircraft_id) AS aircraft
    FROM (SELECT aircraft_id, {DATES} FROM silver) GROUP BY ALL""",
    "silver",
)
oracle(
    "run_metrics",
    """SELECT 'bronze_to_silver' AS stage, 'success' AS status, metric, value FROM (
      SELECT 'states_read' AS metric, CAST((SELECT count(*) FROM flat) AS DOUBLE) AS value
      UNION ALL SELECT 'silver_rows', (SELECT count(*) FROM silver)
      UNION ALL SELECT 'rows_dropped', (SELECT count(*) FROM flat) - (SELECT count(*) FROM silver)
      UNION ALL SELECT 'null_latitude', 0 UNION ALL SELECT 'null_longitude', 0
      UNION ALL SELECT 'null_baro_altitude', 0 UNION ALL SELECT 'null_aircraft_id', 0)""",
    "flat", "silver",
)

# ---- features

cte(
    "airborne",
    "SELECT * FROM silver WHERE NOT on_ground AND velocity IS NOT NULL AND heading IS NOT NULL",
    "silver",
)
cte(
    "windowed",
    """SELECT *, lag(heading) OVER w AS prev_heading, lag(latitude) OVER w AS prev_lat, lag(longitude) OVER w AS prev_lon,
    avg(velocity) OVER (PARTITION BY aircraft_id ORDER BY time_position RANGE BETWEEN 900 PRECEDING AND CURRENT ROW) AS avg_speed_15m,
    avg(velocity) OVER (PARTITION BY aircraft_id ORDER BY time_position RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS avg_speed_day
    FROM airborne WINDOW w AS (PARTITION BY aircraft_id ORDER BY time_position)""",
    "airborne",
)
cte(
    "flights",
    f"""SELECT aircraft_id, callsign, origin_country, event_timestamp, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude,
    velocity AS speed_ms, baro_altitude AS altitude_m, vertical_rate AS vertical_rate_ms, heading AS heading_deg,
    least(abs(prev_heading - heading), CASE WHEN prev_heading IS NOT NULL THEN 360 - abs(prev_heading - heading) END) AS heading_change_5m,
    round(avg_speed_15m, 6) AS avg_speed_15m,
    round(coalesce({_km("latitude", "longitude", "prev_lat", "prev_lon")}, 0), 6) AS distance_10m_km,
    CAST(hour(event_timestamp) AS INTEGER) AS hour_of_day, CAST(isodow(event_timestamp) - 1 AS INTEGER) AS day_of_week,
    CAST(on_ground AS INTEGER) AS is_on_ground FROM windowed""".replace(
        # a fix without a predecessor has moved nothing; least() would skip the null
        "round(coalesce(", "round(coalesce(CASE WHEN prev_lat IS NOT NULL THEN "
    ).replace(", 0), 6) AS distance_10m_km", " END, 0), 6) AS distance_10m_km"),
    "windowed",
)
for name in ("flight_features", "flight_features_sliced", "flight_features_range"):
    oracle(name, "SELECT * FROM flights", "flights")
oracle(
    "heading_change",
    """SELECT aircraft_id, event_timestamp,
    CASE WHEN prev_heading IS NOT NULL THEN least(abs(prev_heading - heading), 360 - abs(prev_heading - heading)) END AS turn,
    abs(prev_heading - heading) AS raw_turn, CAST(dayofweek(event_timestamp) + 1 AS INTEGER) AS sunday_first FROM windowed""",
    "windowed",
)
oracle(
    "rolling_speed",
    f"SELECT aircraft_id, event_timestamp, {r('avg_speed_15m', 'avg_speed_day')} FROM windowed",
    "windowed",
)
cte(
    "near",
    f"""SELECT * FROM (SELECT s.*, h.airport_code, h.airport_name,
    {_km("latitude", "longitude", "airport_lat", "airport_lon")} AS dist_km FROM silver s CROSS JOIN hubs h)
    WHERE dist_km <= 50""",
    "silver", "hubs",
)
for name in ("congestion_join", "congestion_join_shuffled"):
    oracle(name, f"SELECT aircraft_id, event_timestamp, airport_code, {r('dist_km')} FROM near", "near")
PLACES = ", ".join(f"('{code}', CAST({lat} AS DOUBLE), CAST({lon} AS DOUBLE))" for code, _, lat, lon in C.AIRPORTS)
oracle(
    "airport_matches",
    f"""SELECT event_id, airport_code, {r('dist_km')} FROM (
      SELECT event_id, airport_code, {_km("latitude", "longitude", "airport_lat", "airport_lon")} AS dist_km
      FROM (SELECT event_id, CAST(event_id * 7 % 1801 - 900 AS DOUBLE) / 10 AS latitude, CAST(event_id * 11 % 3601 - 1800 AS DOUBLE) / 10 AS longitude FROM events)
      CROSS JOIN (VALUES {PLACES}) AS a(airport_code, airport_lat, airport_lon))
    WHERE dist_km <= 500""",
)


def counts_sql(bucket):
    return f"""SELECT airport_code, airport_name, {bucket} AS event_timestamp, count(*) AS aircraft_count_50km,
    count(*) FILTER (WHERE vertical_rate < -1) AS arrivals_last_30m, count(*) FILTER (WHERE vertical_rate > 1) AS departures_last_30m,
    avg(baro_altitude) AS avg_altitude_50km FROM near GROUP BY ALL"""


HOUR = "date_trunc('hour', event_timestamp)"
COUNTS = ["airport_code", "airport_name", "event_timestamp", "CAST(aircraft_count_50km AS BIGINT) AS aircraft_count_50km", "CAST(arrivals_last_30m AS BIGINT) AS arrivals_last_30m", "CAST(departures_last_30m AS BIGINT) AS departures_last_30m", r("avg_altitude_50km")]
cte("counts", counts_sql(HOUR), "near")
cte(
    "congestion",
    f"SELECT {', '.join(COUNTS)}, round(aircraft_count_50km / (max(aircraft_count_50km) OVER ()), 6) AS congestion_score FROM counts",
    "counts",
)
cte("halves", counts_sql("time_bucket(INTERVAL 30 MINUTE, event_timestamp)"), "near")
oracle("congestion_counts", f"SELECT {', '.join(COUNTS)} FROM counts", "counts")
oracle("congestion_half_hours", f"SELECT {', '.join(COUNTS)} FROM halves", "halves")
for name in ("congestion_features", "congestion_job_range"):
    oracle(name, "SELECT * FROM congestion", "congestion")
oracle(
    "congestion_job_emptied_day",
    """SELECT * REPLACE (round(CAST(aircraft_count_50km AS DOUBLE) / (SELECT max(aircraft_count_50km) FROM counts
    WHERE CAST(event_timestamp AS DATE) <> DATE '2024-01-13'), 6) + 0.0 AS congestion_score)
    FROM congestion WHERE CAST(event_timestamp AS DATE) <> DATE '2024-01-13'""",
    "congestion",
)
oracle(
    "quarantine_by_day",
    """SELECT CAST(ts AS DATE) AS ingest_date, reject_reason, count(*) AS rows
    FROM rejected JOIN events USING (event_id) GROUP BY ALL""",
    "rejected",
)
oracle(
    "congestion_unique_aircraft",
    f"SELECT airport_code, airport_name, {HOUR} AS event_timestamp, count(DISTINCT aircraft_id) AS unique_aircraft_50km FROM near GROUP BY ALL",
    "near",
)
cte(
    "routes",
    """SELECT route_id, max(event_timestamp) AS event_timestamp, count(*) AS route_density,
    round(avg(CASE WHEN baro_altitude > 5000 THEN velocity END), 6) AS avg_cruise_speed,
    round(avg(CASE WHEN baro_altitude > 3000 AND velocity < 100 THEN CAST(1 AS DOUBLE) ELSE 0 END), 6) AS historical_avg_delay_proxy,
    count(DISTINCT aircraft_id) AS unique_aircraft_count
    FROM (SELECT *, CASE WHEN length(callsign) >= 4 THEN substring(callsign, 1, 6) ELSE callsign END AS route_id
      FROM silver WHERE callsign IS NOT NULL AND NOT on_ground) GROUP BY route_id""",
    "silver",
)
for name in ("route_features", "routes_job_range", "routes_sketched_range"):
    oracle(name, "SELECT * FROM routes", "routes")
TEN_DAYS = "CAST(event_timestamp AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-17'"
oracle("routes_sketched_days", CTES["routes"].replace("FROM silver WHERE", f"FROM silver WHERE {TEN_DAYS} AND"), "silver")
oracle(
    "scalar_functions",
    f"""SELECT event_id, CASE WHEN longitude IS NOT NULL THEN round({_km("latitude", "longitude", "10", "20")}, 6) END AS dist_km,
    CASE WHEN length(callsign) >= 4 THEN substring(callsign, 1, 6) ELSE callsign END AS route_id,
    round(CASE WHEN velocity IS NOT NULL THEN greatest(0, least(1, (velocity - 50) / 100)) END, 6) AS clipped,
    CAST(t AS DATE) AS event_date, strftime(t, '%Y/%m/%d') AS folder, CAST(hour(t) AS INTEGER) AS hour,
    CAST(isodow(t) - 1 AS INTEGER) AS monday_first, date_trunc('hour', t) AS hour_start, CAST(on_ground AS INTEGER) AS is_on_ground
    FROM (SELECT *, TIMESTAMP '1970-01-01' + to_seconds(last_contact) AS t FROM states)""",
    "states",
)

# ---- data quality


def _suite(table, columns, lacking=()):
    rows = [
        f"SELECT 'columns_match_set' AS expectation_type, '{','.join(C.BRONZE_REQUIRED)}' AS column_name, "
        f"{len(C.BRONZE_REQUIRED)} AS evaluated_count, {len(lacking)} AS unexpected_count, {not lacking} AS success",
        f"SELECT 'not_null', 'icao24', count(*), count_if(icao24 IS NULL), count_if(icao24 IS NULL) = 0 FROM {table}",
    ]
    for name, (low, high) in C.BRONZE_BOUNDS.items():
        if name in lacking:
            rows.append(f"SELECT 'between', '{name}', NULL, NULL, false")
        else:
            bad = f"count(*) FILTER (WHERE NOT {name} BETWEEN {low} AND {high})"
            rows.append(
                f"SELECT 'between', '{name}', count({name}), {bad}, count({name}) - {bad} >= CAST(0.99 AS DOUBLE) * count({name}) FROM {table}"
            )
    union = " UNION ALL ".join(rows)
    return (
        f"SELECT 'bronze_suite' AS suite_name, (SELECT count(*) FROM {table}) AS row_count, CAST({columns} AS INTEGER) AS column_count, "
        "expectation_type, column_name, CAST(evaluated_count AS BIGINT) AS evaluated_count, "
        f"CAST(unexpected_count AS BIGINT) AS unexpected_count, success FROM ({union})"
    )


cte("suite", _suite("states", 1 + len(STATE_NAMES)), "states")
oracle("dq_bronze", "SELECT * REPLACE (CAST(column_count + 1 AS INTEGER) AS column_count) FROM suite", "suite")
oracle(
    "dq_summary",
    """SELECT suite_name, count(*) AS evaluated_expectations, CAST(count_if(success) AS BIGINT) AS successful_expectations,
    round(count_if(success) / count(*), 4) AS success_rate, bool_and(success) AS passed,
    max(row_count) AS row_count, max(column_count) AS column_count FROM suite GROUP BY suite_name""",
    "suite",
)
oracle(
    "dq_missing_column",
    "SELECT suite_name, expectation_type, column_name, evaluated_count, unexpected_count FROM ("
    + _suite("states", len(STATE_NAMES), ("velocity",)) + ") WHERE NOT success",
    "states",
)
oracle(
    "dq_null_ratio",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(avg(CAST({c} IS NULL AS INTEGER)), 6) AS null_ratio, avg(CAST({c} IS NULL AS INTEGER)) <= 0.3 AS passed FROM flat"
        for c in [*C.SILVER_NOT_NULL, "velocity", "vertical_rate", "callsign"]
    ),
    "flat",
)
oracle(
    "dq_silver_gates",
    """SELECT 'required_columns' AS gate, CAST(0 AS DOUBLE) AS observed, true AS passed
    UNION ALL SELECT 'min_rows', count(*), count(*) >= 50 FROM silver
    UNION ALL SELECT 'max_null_ratio', greatest(avg(CAST(latitude IS NULL AS INTEGER)), avg(CAST(aircraft_id IS NULL AS INTEGER))), true FROM silver""",
    "silver",
)
oracle(
    "dq_poll_gates",
    """SELECT CAST(last_contact // 86400 * 86400 AS BIGINT) AS fetch_timestamp, count(*) AS aircraft_count, count(*) >= 100 AS passed
    FROM states GROUP BY 1""",
    "states",
)

# ---- feature views

FLIGHT_FIELDS = (
    "CAST(speed_ms AS FLOAT) AS speed_ms, CAST(altitude_m AS FLOAT) AS altitude_m, CAST(vertical_rate_ms AS FLOAT) AS vertical_rate_ms, "
    "CAST(heading_deg AS FLOAT) AS heading_deg, CAST(heading_change_5m AS FLOAT) AS heading_change_5m, CAST(avg_speed_15m AS FLOAT) AS avg_speed_15m, "
    "CAST(distance_10m_km AS FLOAT) AS distance_10m_km, CAST(hour_of_day AS BIGINT) AS hour_of_day, CAST(day_of_week AS BIGINT) AS day_of_week, "
    "CAST(is_on_ground AS BIGINT) AS is_on_ground, latitude, longitude, callsign, origin_country"
)
CREATED = "event_timestamp + INTERVAL 5 MINUTE AS created_timestamp"
cte("flight_view", f"SELECT aircraft_id, event_timestamp, {CREATED}, {FLIGHT_FIELDS} FROM flights", "flights")
cte(
    "airport_view",
    f"""SELECT airport_code, event_timestamp, {CREATED}, aircraft_count_50km, arrivals_last_30m, departures_last_30m,
    CAST(avg_altitude_50km AS FLOAT) AS avg_altitude_50km, CAST(congestion_score AS FLOAT) AS congestion_score, airport_name FROM congestion""",
    "congestion",
)
oracle("feature_view_flight", "SELECT * FROM flight_view", "flight_view")
oracle("feature_view_airport", "SELECT airport_code, event_timestamp, created_timestamp, aircraft_count_50km, arrivals_last_30m, departures_last_30m, avg_altitude_50km, congestion_score, airport_name FROM airport_view", "airport_view")
oracle(
    "feature_view_route",
    f"""SELECT route_id, event_timestamp, {CREATED}, route_density, CAST(avg_cruise_speed AS FLOAT) AS avg_cruise_speed,
    CAST(historical_avg_delay_proxy AS FLOAT) AS historical_avg_delay_proxy, unique_aircraft_count FROM routes""",
    "routes",
)
LATEST = "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY aircraft_id ORDER BY event_timestamp DESC) AS rn FROM flight_view {where}) WHERE rn = 1"
oracle(
    "materialize_latest",
    LATEST.format(where="WHERE event_timestamp BETWEEN TIMESTAMP '2024-01-14 22:00:00' AND TIMESTAMP '2024-01-15 00:00:00'"),
    "flight_view",
)
oracle("materialize_all", LATEST.format(where=""), "flight_view")
oracle("stream_latest", LATEST.format(where=""), "flight_view")
oracle(
    "materialize_upsert",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY aircraft_id ORDER BY event_timestamp DESC) AS rn
    FROM flight_view WHERE event_timestamp BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-14'
    OR event_timestamp BETWEEN TIMESTAMP '2024-01-14 22:00:00' AND TIMESTAMP '2024-01-15') WHERE rn = 1""",
    "flight_view",
)
oracle(
    "asof_join",
    """SELECT o_orderkey, s.aircraft_id, t AS event_timestamp,
    CASE WHEN ok THEN f.event_timestamp END AS feature_event_timestamp, CASE WHEN ok THEN f.speed_ms END AS speed_ms,
    CASE WHEN ok THEN f.heading_deg END AS heading_deg
    FROM (SELECT s.*, f.event_timestamp >= t - INTERVAL 2 HOUR AS ok, f FROM
      (SELECT o_orderkey, CAST(o_custkey % 150 AS VARCHAR) AS aircraft_id, TIMESTAMP '1970-01-01' + to_seconds(1704067200 + o_orderkey * 7919 % 2592000) AS t FROM orders) s
      ASOF LEFT JOIN flight_view f ON s.aircraft_id = f.aircraft_id AND s.t >= f.event_timestamp) s""",
    "flight_view",
)
oracle(
    "asof_airport",
    """SELECT o_orderkey, s.airport_code, t AS event_timestamp,
    CASE WHEN ok THEN f.event_timestamp END AS feature_event_timestamp, CASE WHEN ok THEN f.aircraft_count_50km END AS aircraft_count_50km,
    CASE WHEN ok THEN f.congestion_score END AS congestion_score
    FROM (SELECT s.*, f.event_timestamp >= t - INTERVAL 1 HOUR AS ok, f FROM
      (SELECT o_orderkey, n_name AS airport_code, TIMESTAMP '1970-01-01' + to_seconds(1704067200 + (o_orderkey * 7919 % 2592000) // 600 * 600) AS t
       FROM orders JOIN nation ON o_custkey % 25 = n_nationkey) s
      ASOF LEFT JOIN airport_view f ON s.airport_code = f.airport_code AND s.t >= f.event_timestamp) s""",
    "airport_view",
)

# ---- labels, samples, splits

cte(
    "hourly",
    f"SELECT {HOUR} AS snapshot_hour, max(congestion_score) AS max_congestion_score FROM congestion GROUP BY 1",
    "congestion",
)
cte(
    "labels",
    f"""SELECT f.*, {HOUR.replace("event_timestamp", "f.event_timestamp")} AS snapshot_hour, coalesce(h.max_congestion_score, 0) AS max_congestion_score,
    CAST((altitude_m > 3000 AND speed_ms < 100) OR coalesce(h.max_congestion_score, 0) > 0.7 AS INTEGER) AS delay_risk
    FROM flights f LEFT JOIN hourly h ON date_trunc('hour', f.event_timestamp) = h.snapshot_hour""",
    "flights", "hourly",
)
oracle("hourly_congestion", "SELECT * FROM hourly", "hourly")
for name in ("delay_labels", "labels_job_range"):
    oracle(
        name,
        "SELECT aircraft_id, event_timestamp, altitude_m, speed_ms, snapshot_hour, max_congestion_score, delay_risk FROM labels",
        "labels",
    )
oracle(
    "label_summary",
    "SELECT count(*) AS total_rows, CAST(sum(delay_risk) AS BIGINT) AS delay_risk_count, round(avg(delay_risk), 6) AS delay_risk_rate FROM labels",
    "labels",
)
cte(
    "nearest",
    f"""SELECT l.*, n.airport_code, n.dist_km, coalesce(c.aircraft_count_50km, 0) AS aircraft_count_50km, coalesce(c.congestion_score, 0) AS congestion_score
    FROM labels l
    LEFT JOIN (SELECT aircraft_id, event_timestamp, airport_code, dist_km,
        row_number() OVER (PARTITION BY aircraft_id, event_timestamp ORDER BY dist_km, airport_code) AS rn FROM near) n
      ON n.rn = 1 AND n.aircraft_id = l.aircraft_id AND n.event_timestamp = l.event_timestamp
    LEFT JOIN congestion c ON c.airport_code = n.airport_code AND c.event_timestamp = date_trunc('hour', l.event_timestamp)""",
    "labels", "near", "congestion",
)
oracle(
    "nearest_congestion",
    f"SELECT aircraft_id, event_timestamp, airport_code, {r('dist_km')}, CAST(aircraft_count_50km AS BIGINT) AS aircraft_count_50km, congestion_score FROM nearest",
    "nearest",
)
COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in C.DELAY_FEATURES)
oracle(
    "training_frame",
    f"""SELECT aircraft_id, event_timestamp, speed_ms, altitude_m, vertical_rate_ms, heading_change_5m, avg_speed_15m,
    CAST(aircraft_count_50km AS BIGINT) AS aircraft_count_50km, congestion_score, hour_of_day, day_of_week, delay_risk
    FROM nearest WHERE {COMPLETE}""",
    "nearest",
)
oracle(
    "congestion_training_frame",
    """SELECT airport_code, event_timestamp, aircraft_count_50km, arrivals_last_30m, departures_last_30m, avg_altitude_50km,
    CAST(hour(event_timestamp) AS INTEGER) AS hour_of_day, CAST(isodow(event_timestamp) - 1 AS INTEGER) AS day_of_week, congestion_score FROM congestion""",
    "congestion",
)
def keyed(*columns):
    """Every value with its length; null as a mark of its own."""
    texts = [f"CAST({c} AS VARCHAR)" for c in columns]
    return "md5(concat_ws('|', " + ", ".join(f"coalesce(length({t}) || ':' || {t}, '~')" for t in texts) + ", '42'))"


HASH = keyed("event_id")
oracle("hash_sample", f"SELECT event_id, event_type, value FROM events ORDER BY {HASH} LIMIT 500")
oracle(
    "hash_sample_strata",
    f"""SELECT event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY {HASH}) AS rn FROM events) WHERE rn <= 100""",
)
for name, part in (("split_plain", ""), ("split_stratified", "PARTITION BY event_type")):
    oracle(
        name,
        f"""SELECT event_id, event_type, rn <= round(total * 0.15) AS is_test FROM (
          SELECT event_id, event_type, row_number() OVER ({part} ORDER BY {HASH}) AS rn, count(*) OVER ({part}) AS total FROM events)""",
    )
oracle(
    "fold_stratified",
    f"""SELECT event_id, event_type,
    CAST((row_number() OVER (PARTITION BY event_type ORDER BY {HASH}) - 1) % {C.CV_FOLDS} AS INTEGER) AS fold FROM events""",
)
oracle(
    "hash_sample_nulls",
    f"""SELECT * FROM (SELECT part, name, min(event_id) AS event_id FROM (
      SELECT event_id, nullif(event_id % 50, 7) AS part,
      CASE WHEN event_id % 3 = 0 THEN NULL ELSE concat(event_type, '|', CAST(event_id AS VARCHAR)) END AS name FROM events)
    GROUP BY ALL) ORDER BY {keyed('part', 'name')} LIMIT 300""",
)
oracle(
    "ingest_counts",
    """SELECT CAST(last_contact AS DOUBLE) AS fetch_timestamp,
    CAST(CASE WHEN longitude IS NULL THEN 0 ELSE 2 END AS INTEGER) AS aircraft_count,
    CAST(CASE WHEN longitude IS NULL THEN 2 ELSE 0 END AS INTEGER) AS dropped_count FROM states""",
    "states",
)
oracle("split_time", "SELECT event_id, ts, ts >= TIMESTAMP '2024-01-25' AS is_test FROM events")
oracle(
    "fold_assign",
    f"SELECT event_id, CAST(CAST('0x' || substring({HASH}, 1, 8) AS BIGINT) % 3 AS INTEGER) AS fold FROM events",
)
oracle(
    "standardize",
    """SELECT event_id, round((velocity - avg(velocity) OVER ()) / (stddev_pop(velocity) OVER ()), 6) + 0.0 AS velocity,
    round((baro_altitude - avg(baro_altitude) OVER ()) / (stddev_pop(baro_altitude) OVER ()), 6) + 0.0 AS baro_altitude,
    CAST(0 AS DOUBLE) AS constant FROM flat""",
    "flat",
)
oracle(
    "class_weights",
    """SELECT event_type, event_id, round((SELECT count(*) FROM events) / ((SELECT count(DISTINCT event_type) FROM events)
    * (count(*) OVER (PARTITION BY event_type))), 6) AS weight FROM events""",
)
oracle(
    "risk_band",
    """SELECT event_id, CASE WHEN p >= 0.7 THEN 'HIGH' WHEN p >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS risk,
    CASE WHEN p >= 0.9 THEN 'CRITICAL' WHEN p >= 0.7 THEN 'HIGH' WHEN p >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS congestion,
    event_id % 20 = 0 AS is_anomaly FROM (SELECT event_id, CAST(event_id % 101 AS DOUBLE) / 100 AS p FROM events)""",
)

# ---- metrics, trials, gates

cte(
    "scored",
    """SELECT event_id, CAST(event_id % 5 = 0 AS INTEGER) AS label,
    CAST(event_id * 37 % 701 + 299 * CAST(event_id % 5 = 0 AS INTEGER) AS DOUBLE) / 1000 AS score,
    CAST(event_id * 31 % 97 AS DOUBLE) / 10 AS target, CAST(event_id * 31 % 97 + event_id % 13 - 6 AS DOUBLE) / 10 AS prediction,
    CAST(event_id % 4 AS INTEGER) AS trial, CAST(event_id // 4 % 3 AS INTEGER) AS fold,
    CASE event_id % 4 WHEN 0 THEN 'lgbm' WHEN 1 THEN 'xgboost' ELSE 'hgb' END AS algorithm FROM events""",
)


def auc_sql(table, by=""):
    """Rank-sum form: mean rank of tied scores."""
    part = f"PARTITION BY {by}" if by else ""
    cols, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    ranked = f"""SELECT *, rank() OVER ({part} ORDER BY score) + (count(*) OVER (PARTITION BY {cols}score) - 1) / 2 AS mean_rank FROM {table}"""
    return f"""SELECT {cols}(sum(CASE WHEN label = 1 THEN mean_rank END) - sum(label) * (sum(label) + 1) / 2)
      / (CAST(sum(label) AS DOUBLE) * (count(*) - sum(label))) AS auc,
    CAST(sum(label) AS BIGINT) AS positives, CAST(count(*) - sum(label) AS BIGINT) AS negatives FROM ({ranked}) {group}"""


oracle("metric_auc", f"SELECT {r('auc')}, positives, negatives FROM ({auc_sql('scored')})", "scored")
oracle(
    "metric_auc_by_trial",
    f"SELECT trial, fold, {r('auc')}, positives, negatives FROM ({auc_sql('scored', 'trial, fold')})",
    "scored",
)


def confusion_sql(table, by):
    return f"""SELECT {by}, tp, fp, fn, tn, (tp + tn) / (tp + fp + fn + tn) AS accuracy,
    coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
    coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1
    FROM (SELECT {by}, CAST(count_if(score > 0.5 AND label = 1) AS BIGINT) AS tp, CAST(count_if(score > 0.5 AND label = 0) AS BIGINT) AS fp,
      CAST(count_if(score <= 0.5 AND label = 1) AS BIGINT) AS fn, CAST(count_if(score <= 0.5 AND label = 0) AS BIGINT) AS tn
      FROM {table} GROUP BY {by})"""


def regression_sql(table, by):
    return f"""SELECT {by}, count(*) AS n, sqrt(avg(pow(prediction - target, 2))) AS rmse, avg(abs(prediction - target)) AS mae,
    1 - avg(pow(prediction - target, 2)) / nullif(var_pop(target), 0) AS r2 FROM {table} GROUP BY {by}"""


oracle(
    "metric_confusion",
    f"SELECT trial, tp, fp, fn, tn, {r('accuracy', 'precision', 'recall', 'f1')} FROM ({confusion_sql('scored', 'trial')})",
    "scored",
)
oracle(
    "metric_regression",
    f"SELECT trial, n, {r('rmse', 'mae', 'r2')} FROM ({regression_sql('scored', 'trial')})",
    "scored",
)
oracle(
    "metric_anomaly",
    """SELECT CAST(count_if(score > 0.95) AS BIGINT) AS anomaly_count, round(avg(CAST(score > 0.95 AS INTEGER)), 6) AS anomaly_rate,
    round(avg(score), 6) AS mean_score, round(stddev_pop(score), 6) AS score_spread FROM scored""",
    "scored",
)
cte(
    "trials",
    f"SELECT trial, algorithm, coalesce(avg(auc), 0) AS score FROM ({auc_sql('scored', 'trial, algorithm, fold')}) GROUP BY trial, algorithm",
    "scored",
)
oracle("trial_scores", f"SELECT trial, algorithm, {r('score')} FROM trials", "trials")
oracle(
    "trial_summary",
    """SELECT a.algorithm, round(coalesce(max(score), 0), 4) AS best_score, round(coalesce(avg(score), 0), 4) AS mean_score,
    count(score) AS n_trials FROM (VALUES ('lgbm'), ('xgboost'), ('catboost'), ('random_forest'), ('hgb')) AS a(algorithm)
    LEFT JOIN trials t ON t.algorithm = a.algorithm GROUP BY a.algorithm""",
    "trials",
)
oracle("best_trial", f"SELECT trial, algorithm, {r('score')} FROM trials ORDER BY trials.score DESC, trial LIMIT 1", "trials")
oracle(
    "regression_trials",
    f"SELECT trial, algorithm, round(avg(r2), 6) AS score FROM ({regression_sql('scored', 'trial, algorithm, fold')}) GROUP BY trial, algorithm",
    "scored",
)
cte(
    "worse",
    "SELECT * REPLACE (CAST(event_id * 37 % 701 AS DOUBLE) / 700 AS score) FROM scored",
    "scored",
)
cte(
    "off",
    "SELECT * REPLACE (target + CAST(event_id % 29 - 14 AS DOUBLE) / 10 AS prediction) FROM scored",
    "scored",
)
oracle(
    "gate",
    f"""SELECT 'delay' AS model, round(c.auc, 6) AS candidate_metric, round(p.auc, 6) AS champion_metric,
      c.auc >= 0.62 AND f.f1 >= 0.5 AND c.auc > p.auc AS promote
      FROM ({auc_sql('scored')}) c, ({auc_sql('worse')}) p, (SELECT f1 FROM ({confusion_sql("(SELECT *, 1 AS one FROM scored)", "one")})) f
    UNION ALL SELECT 'congestion', round(c.r2, 6), round(p.r2, 6), c.r2 >= 0.4 AND c.r2 > p.r2
      FROM ({regression_sql("(SELECT *, 1 AS one FROM off)", "one")}) c, ({regression_sql("(SELECT *, 1 AS one FROM scored)", "one")}) p
    UNION ALL SELECT 'anomaly', round(c.m, 6), round(p.m, 6), true FROM (SELECT avg(score) AS m FROM scored) c, (SELECT avg(score) AS m FROM worse) p""",
    "scored", "worse", "off",
)
CONTRIBUTIONS = """SELECT event_id, CAST(0.02 AS DOUBLE) * (velocity - avg(velocity) OVER ()) AS velocity,
    CAST(-0.0005 AS DOUBLE) * (baro_altitude - avg(baro_altitude) OVER ()) AS baro_altitude,
    CAST(0.001 AS DOUBLE) * (heading - avg(heading) OVER ()) AS heading FROM clean"""
cte("contributions", CONTRIBUTIONS, "clean")
oracle(
    "contribution_map",
    f"SELECT event_id, {r('velocity', 'baro_altitude', 'heading')} FROM contributions",
    "contributions",
)
oracle(
    "feature_rank",
    """SELECT feature, round(mean_abs, 6) AS mean_abs FROM (
      SELECT 'velocity' AS feature, avg(abs(velocity)) AS mean_abs FROM contributions
      UNION ALL SELECT 'baro_altitude', avg(abs(baro_altitude)) FROM contributions
      UNION ALL SELECT 'heading', avg(abs(heading)) FROM contributions) t ORDER BY t.mean_abs DESC, feature LIMIT 2""",
    "contributions",
)

# ---- drift and rules


def _bin(column, edges):
    return " + ".join(f"CAST({column} >= {e} AS INTEGER)" for e in edges)


PSI_BINS = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, {_bin(f, edges)} AS bin, last_contact >= 1705276800 AS is_new FROM flat WHERE {f} IS NOT NULL"
    for f, edges in {
        "velocity": [10, 25, 50, 100],
        "baro_altitude": [2000, 6000, 10000],
        "vertical_rate": [-5, 0, 5],
    }.items()
)
oracle(
    "drift_psi",
    f"""SELECT feature, round(sum((p - q) * ln(p / q)), 6) AS psi, sum((p - q) * ln(p / q)) > 0.2 AS drifted FROM (
      SELECT feature, greatest(count_if(is_new) / sum(count_if(is_new)) OVER (PARTITION BY feature), 0.0001) AS p,
        greatest(count_if(NOT is_new) / sum(count_if(NOT is_new)) OVER (PARTITION BY feature), 0.0001) AS q
      FROM ({PSI_BINS}) GROUP BY feature, bin) GROUP BY feature""",
    "flat",
)
QUANTILE_BINS = " UNION ALL ".join(
    f"""SELECT '{f}' AS feature, list_sum(list_transform(cuts, lambda c: CAST({f} >= c AS INTEGER))) AS bin, last_contact >= 1705276800 AS is_new
    FROM flat, (SELECT quantile_disc({f}, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS cuts FROM flat WHERE last_contact < 1705276800) WHERE {f} IS NOT NULL"""
    for f in ("velocity", "baro_altitude", "heading")
)
oracle(
    "drift_decision",
    f"""SELECT count(*) AS features, CAST(count_if(drifted) AS BIGINT) AS drifted_features, avg(CAST(drifted AS INTEGER)) AS drifted_share,
    avg(CAST(drifted AS INTEGER)) > 0.3 AS retrain FROM (
    SELECT feature, sum((p - q) * ln(p / q)) > 0.2 AS drifted FROM (
      SELECT feature, greatest(count_if(is_new) / sum(count_if(is_new)) OVER (PARTITION BY feature), 0.0001) AS p,
        greatest(count_if(NOT is_new) / sum(count_if(NOT is_new)) OVER (PARTITION BY feature), 0.0001) AS q
      FROM ({QUANTILE_BINS}) GROUP BY feature, bin) GROUP BY feature)""",
    "flat",
)
SILVER_BINS = " UNION ALL ".join(
    f"""SELECT '{f}' AS feature, list_sum(list_transform(cuts, lambda c: CAST({f} >= c AS INTEGER))) AS bin, CAST(event_timestamp AS DATE) >= DATE '2024-01-15' AS is_new
    FROM silver, (SELECT quantile_disc({f}, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS cuts FROM silver WHERE CAST(event_timestamp AS DATE) < DATE '2024-01-15') WHERE {f} IS NOT NULL"""
    for f in ("velocity", "baro_altitude", "vertical_rate")
)
oracle(
    "drift_window",
    f"""SELECT feature, sum((p - q) * ln(p / q)) > 0.2 AS drifted, true AS close FROM (
      SELECT feature, greatest(count_if(is_new) / sum(count_if(is_new)) OVER (PARTITION BY feature), 0.0001) AS p,
        greatest(count_if(NOT is_new) / sum(count_if(NOT is_new)) OVER (PARTITION BY feature), 0.0001) AS q
      FROM ({SILVER_BINS}) GROUP BY feature, bin) GROUP BY feature""",
    "silver",
)
ORACLES["performance_drop"] = """
WITH RECURSIVE scored AS (
    SELECT CAST(ts AS DATE) AS day, CAST(event_id % 2 AS INTEGER) AS model, CAST(event_id * 31 % 97 AS DOUBLE) / 10 AS target,
        CAST(event_id * 31 % 97 + event_id % 13 - 6 + CAST(event_id % 2 = 1 AND ts >= TIMESTAMP '2024-01-20' AS INTEGER) * (event_id % 5) AS DOUBLE) / 10 AS prediction
    FROM events
), daily AS (
    SELECT model, day, sqrt(avg(pow(target - prediction, 2))) AS rmse, row_number() OVER (PARTITION BY model ORDER BY day) AS n FROM scored GROUP BY model, day
), base AS (
    SELECT model, avg(rmse) AS mean, CASE WHEN stddev_pop(rmse) > 0 THEN stddev_pop(rmse) ELSE 1 END AS spread FROM daily WHERE n <= 7 GROUP BY model
), worse AS (SELECT model, day, rmse, n, (rmse - mean) / spread - 0.5 AS z FROM daily JOIN base USING (model) WHERE n > 7),
steps AS (
    SELECT model, day, rmse, n, greatest(0, z) AS cusum FROM worse WHERE n = 8
    UNION ALL
    SELECT w.model, w.day, w.rmse, w.n, greatest(0, cusum + z) FROM steps s JOIN worse w ON w.model = s.model AND w.n = s.n + 1
)
SELECT model, day, round(rmse, 6) + 0.0 AS rmse, round(cusum, 6) + 0.0 AS cusum, cusum > 5 AS dropped FROM steps
"""
oracle(
    "anomaly_rules",
    """SELECT *, CAST(heading_jump AS INTEGER) + CAST(odd_speed AS INTEGER) + CAST(odd_climb AS INTEGER) + CAST(stalled AS INTEGER) AS signals FROM (
      SELECT aircraft_id, event_timestamp, coalesce(heading_change_5m > 90, false) AS heading_jump,
      altitude_m > 5000 AND NOT speed_ms BETWEEN 50 AND 320 AS odd_speed, coalesce(abs(vertical_rate_ms) > 25, false) AS odd_climb,
      altitude_m > 5000 AND distance_10m_km > 0 AND distance_10m_km < 1 AS stalled FROM flights)""",
    "flights",
)

# ---- local outlier factor

cte(
    "pairs",
    """SELECT a.vec_id AS p, b.vec_id AS o, sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding),
      lambda z: pow(CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE), 2)))) AS d
    FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id""",
)
cte(
    "knn",
    "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY d, o) AS rn FROM pairs) WHERE rn <= 5",
    "pairs",
)
cte(
    "density",
    """SELECT k.p, 1 / (avg(greatest(k.d, far.d)) + 1e-10) AS lrd FROM knn k
    JOIN (SELECT p, max(d) AS d FROM knn GROUP BY p) far ON far.p = k.o GROUP BY k.p""",
    "knn",
)
oracle(
    "lof",
    """SELECT k.p AS vec_id, round(avg(other.lrd) / max(own.lrd), 6) AS lof FROM knn k
    JOIN density other ON other.p = k.o JOIN density own ON own.p = k.p GROUP BY k.p""",
    "density",
)

SCALED = ", ".join(f"({f} - avg({f}) OVER ()) / (stddev_pop({f}) OVER ()) AS x{i}" for i, f in enumerate(C.ANOMALY_FEATURES))
APART = " + ".join(f"pow(a.x{i} - b.x{i}, 2)" for i in range(len(C.ANOMALY_FEATURES)))
FIX = keyed("aircraft_id", "event_timestamp")
cte(
    "fixes",
    f"""SELECT aircraft_id, event_timestamp, {SCALED}, row_number() OVER (ORDER BY {FIX}) AS n
    FROM flights WHERE {" AND ".join(f"{f} IS NOT NULL" for f in C.ANOMALY_FEATURES)}""",
    "flights",
)
cte(
    "fix_knn",
    f"""SELECT p, near.o AS o, near.d AS d FROM (
      SELECT a.n AS p, unnest(min({{'d': sqrt({APART}), 'o': b.n}}, {C.LOF_NEIGHBOURS})) AS near
      FROM fixes a JOIN fixes b ON a.n <> b.n GROUP BY a.n)""",
    "fixes",
)
cte(
    "fix_density",
    """SELECT k.p, 1 / (avg(greatest(k.d, far.d)) + 1e-10) AS lrd FROM fix_knn k
    JOIN (SELECT p, max(d) AS d FROM fix_knn GROUP BY p) far ON far.p = k.o GROUP BY k.p""",
    "fix_knn",
)
oracle(
    "flight_lof",
    """SELECT aircraft_id, event_timestamp, lof FROM fixes JOIN (
      SELECT k.p, round(avg(other.lrd) / max(own.lrd), 6) AS lof FROM fix_knn k
      JOIN fix_density other ON other.p = k.o JOIN fix_density own ON own.p = k.p GROUP BY k.p) ON p = n""",
    "fix_density",
)

cte(
    "novel",
    "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY d, o) AS rn FROM pairs WHERE o % 5 = 0) WHERE rn <= 5",
    "pairs",
)
cte(
    "novel_density",
    """SELECT k.p, 1 / (avg(greatest(k.d, far.d)) + 1e-10) AS lrd FROM novel k
    JOIN (SELECT p, max(d) AS d FROM novel WHERE p % 5 = 0 GROUP BY p) far ON far.p = k.o GROUP BY k.p""",
    "novel",
)
oracle(
    "lof_novelty",
    """SELECT k.p AS vec_id, round(avg(other.lrd) / max(own.lrd), 6) AS lof FROM novel k
    JOIN novel_density other ON other.p = k.o JOIN novel_density own ON own.p = k.p GROUP BY k.p""",
    "novel_density",
)

# Models are fitted by MLlib; what SQL can say about their results is checked.

HELD = """SELECT * FROM (SELECT *, row_number() OVER ({part} ORDER BY {key}) AS rn, count(*) OVER ({part}) AS total FROM {table})
    WHERE rn <= round(total * 0.15)"""
oracle(
    "delay_scores",
    f"""SELECT aircraft_id, event_timestamp, delay_risk, true AS in_range, true AS band_fits FROM
    ({HELD.format(part="PARTITION BY delay_risk", key=keyed("aircraft_id", "event_timestamp"), table=f"(SELECT * FROM nearest WHERE {COMPLETE})")})""",
    "nearest",
)
LOADED = " AND ".join(f"{c} IS NOT NULL" for c in (*C.CONGESTION_FEATURES, "congestion_score") if c not in ("hour_of_day", "day_of_week"))
oracle(
    "congestion_scores",
    f"""SELECT airport_code, event_timestamp, congestion_score, true AS in_range FROM
    ({HELD.format(part="", key=keyed("airport_code", "event_timestamp"), table=f"(SELECT * FROM congestion WHERE {LOADED})")})""",
    "congestion",
)
oracle("anomaly_scores", "SELECT count(*) AS rows_scored, true AS rate_as_expected, true AS sign_fits FROM fixes", "fixes")
FAMILIES = "(VALUES " + ", ".join(f"({i}, '{name}')" for i, name in enumerate(FAMILY_NAMES)) + ") AS t(n, algorithm)"
FOLDS = f"range({C.CV_FOLDS}) AS f(fold)"
for name, fact in (("trial_table", "above_floor"), ("congestion_trials", "within_range")):
    oracle(
        name,
        f"""SELECT CAST(n AS INTEGER) AS trial, algorithm, CAST(fold AS INTEGER) AS fold, true AS {fact}
        FROM {FAMILIES}, {FOLDS}""",
    )
oracle(
    "anomaly_trials",
    f"""SELECT CAST(n AS INTEGER) AS trial, CASE WHEN n % 2 = 0 THEN 'isolation_forest' ELSE 'lof' END AS algorithm,
    (SELECT count(*) FROM fixes) AS rows_scored, true AS rate_in_bounds
    FROM range({C.TRIALS}) AS t(n)""",
    "fixes",
)
LISTED = f"unnest([{', '.join(repr(f) for f in C.DELAY_FEATURES)}]) AS feature"
oracle("feature_importance", f"SELECT {LISTED}, true AS in_range, true AS sums_to_one")
oracle("permutation_importance", f"SELECT *, feature IN ('altitude_m', 'speed_ms') AS matters FROM (SELECT {LISTED})")

# ---- attributions, from the definition: all subsets of the inputs

EXPLAINED = ["velocity", "baro_altitude", "vertical_rate"]
EXPLAINED_TREES = [
    (([0, 1, 0, -1, -1, -1, -1], [50.0, 6000.0, 90.0, 0, 0, 0, 0], [1, 3, 5, 0, 0, 0, 0], [2, 4, 6, 0, 0, 0, 0], [0, 0, 0, 1.0, -0.5, 0.25, 2.0], [100, 60, 40, 20, 40, 10, 30])),
    (([2, -1, 0, -1, 1, -1, -1], [0.0, 0, 25.0, 0, 9000.0, 0, 0], [1, 0, 3, 0, 5, 0, 0], [2, 0, 4, 0, 6, 0, 0], [0, -1.0, 0, 0.5, 0, 3.0, -2.0], [64, 32, 32, 8, 24, 18, 6])),
]


def _game(tree, known, node=0):
    feature, threshold, left, right, value, cover = tree
    if feature[node] < 0:
        return f"{value[node]}::DOUBLE"
    a, b = _game(tree, known, left[node]), _game(tree, known, right[node])
    if feature[node] in known:
        return f"(CASE WHEN {EXPLAINED[feature[node]]} > {threshold[node]} THEN {b} ELSE {a} END)"
    return f"({a} * {cover[left[node]]} + {b} * {cover[right[node]]}) / {cover[node]}"


def _phi(f):
    terms = []
    others = [g for g in range(3) if g != f]
    for known, weight in ((set(), "1.0 / 3"), ({others[0]}, "1.0 / 6"), ({others[1]}, "1.0 / 6"), (set(others), "1.0 / 3")):
        terms += [f"({_game(t, known | {f})} - {_game(t, known)}) * {weight}" for t in EXPLAINED_TREES]
    return " + ".join(terms)


NOTHING_KNOWN = " + ".join(_game(t, set()) for t in EXPLAINED_TREES)
cte("explained", "SELECT event_id, " + ", ".join(f"{_phi(i)} AS {f}" for i, f in enumerate(EXPLAINED)) + f", 0.125::DOUBLE + {NOTHING_KNOWN} AS base FROM flat", "flat")
oracle("tree_contributions", f"SELECT event_id, {r(*EXPLAINED, 'base')} FROM explained", "explained")
oracle(
    "tree_feature_rank",
    "SELECT feature, round(avg(abs(v)), 6) + 0.0 AS mean_abs FROM (UNPIVOT explained ON velocity, baro_altitude, vertical_rate INTO NAME feature VALUE v) GROUP BY feature ORDER BY avg(abs(v)) DESC LIMIT 2",
    "explained",
)

# ---- boosting

BOOST_CUTS = {"velocity": [10.0, 25.0, 50.0, 100.0], "baro_altitude": [2000.0, 6000.0, 10000.0], "vertical_rate": [-5.0, 0.0, 5.0]}
UNIT = 1 << 20
cte(
    "boost_rows",
    "SELECT event_id, CAST(coalesce(velocity < 40, false) AS INTEGER) + 0.5::DOUBLE * CAST(coalesce(baro_altitude > 5000, false) AS INTEGER) "
    "* CAST(coalesce(vertical_rate > 0, false) AS INTEGER) + (event_id % 7)::DOUBLE / 10 AS y, "
    + ", ".join(
        f"CASE WHEN {name} IS NULL THEN 0 ELSE 1 + {' + '.join(f'CAST({name} > {c} AS INTEGER)' for c in cuts)} END AS b{j}"
        for j, (name, cuts) in enumerate(BOOST_CUTS.items())
    )
    + " FROM flat",
    "flat",
)


def boost_sql(growth, steps, depth, rate, l2, gamma, min_rows, rounds=2):
    """Rounds of trees, each grown in ``steps``: the best leaf, every leaf or a whole level is
    split. Nodes are numbered 1, 2 and 3, 4 to 7 and so on."""
    parts = [
        "base AS (SELECT round(avg(y), 9) AS base, pow(2, ceil(log2(greatest(max(y) - round(avg(y), 9), round(avg(y), 9) - min(y))))) AS unit FROM boost_rows)",
        "raw0 AS MATERIALIZED (SELECT boost_rows.*, base AS raw, unit FROM boost_rows, base)",
    ]
    score = f"({{g}} / {UNIT} * unit) * ({{g}} / {UNIT} * unit) / ({{n}} + {l2})"
    gain = f"0.5 * ({score.format(g='gl', n='nl')} + {score.format(g='(g - gl)', n='(n - nl)')} - {score.format(g='g', n='n')}) - {gamma}"
    small = f"nl < {min_rows} OR n - nl < {min_rows} OR nl = 0 OR nl = n"
    cuts = ", ".join(f"({j}, {c})" for j, cut in enumerate(BOOST_CUTS.values()) for c in range(len(cut) + 1))
    for t in range(rounds):
        parts.append(f"n{t}_0 AS MATERIALIZED (SELECT *, 1 AS node, CAST(round_even((raw - y) / unit * {UNIT}, 0) AS BIGINT) AS g FROM raw{t})")
        for k in range(steps):
            rows, name = f"n{t}_{k}", f"{t}_{k}"
            long = " UNION ALL ".join(f"SELECT node, unit, {j} AS f, b{j} AS b, sum(g) AS g, count(*) AS n FROM {rows} GROUP BY ALL" for j in range(3))
            parts.append(f"h{name} AS MATERIALIZED ({long})")
            parts.append(
                f"""c{name} AS (SELECT node, unit, f, c, sum(g) AS g, sum(n) AS n, coalesce(sum(g) FILTER (b <= c), 0) AS gl, coalesce(sum(n) FILTER (b <= c), 0) AS nl
                FROM h{name} JOIN (VALUES {cuts}) AS t(f, c) USING (f) WHERE node < {1 << depth} GROUP BY ALL)"""
            )
            parts.append(f"s{name} AS (SELECT node, f, c, CASE WHEN {small} THEN NULL ELSE {gain} END AS gain FROM c{name})")
            if growth == "symmetric":
                best = f"SELECT f, c FROM (SELECT f, c, sum(coalesce(gain, 0)) AS gain FROM s{name} WHERE node >= {1 << k} GROUP BY f, c) WHERE gain > 0 ORDER BY gain DESC, f, c LIMIT 1"
                best = f"SELECT node, f, c FROM (SELECT DISTINCT node FROM s{name} WHERE node >= {1 << k}), ({best})"
            else:
                best = f"SELECT node, f, c, gain FROM s{name} WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, c) = 1"
                if growth == "leaf":
                    best = f"SELECT * FROM ({best}) ORDER BY gain DESC, node LIMIT 1"
            parts.append(f"p{name} AS MATERIALIZED ({best})")
            side = "CASE p.f WHEN 0 THEN r.b0 WHEN 1 THEN r.b1 ELSE r.b2 END"
            parts.append(
                f"""n{t}_{k + 1} AS MATERIALIZED (SELECT r.* REPLACE (CASE WHEN p.node IS NULL THEN r.node ELSE 2 * r.node + CAST({side} > p.c AS INTEGER) END AS node)
                FROM {rows} r LEFT JOIN p{name} p ON p.node = r.node)"""
            )
        leaves = f"SELECT node, -(sum(g) / {UNIT} * any_value(unit)) / (count(*) + {l2}) * {rate} AS value FROM n{t}_{steps} GROUP BY node"
        parts.append(f"raw{t + 1} AS MATERIALIZED (SELECT r.* EXCLUDE (node, g) REPLACE (raw + value AS raw) FROM n{t}_{steps} r JOIN ({leaves}) USING (node))")
    return ",\n".join(parts) + f"\nSELECT event_id, round(raw, 6) + 0.0 AS score FROM raw{rounds}"


for name, arguments in (
    ("boosted_leafwise", ("leaf", 4, 3, 0.5, 0.5, 0.25, 20)),
    ("boosted_levelwise", ("level", 2, 2, 0.5, 2.0, 0.125, 20)),
    ("boosted_symmetric", ("symmetric", 2, 2, 0.5, 1.0, 0.0, 1)),
):
    ORACLES[name] = with_("", "boost_rows").rstrip() + ",\n" + boost_sql(*arguments)

# ---- streaming

oracle("stream_silver", f"SELECT aircraft_id, event_timestamp, {DATES} FROM silver", "silver")
oracle(
    "stream_late_rows",
    """SELECT 'stream_dedup' AS stage, 'success' AS status, 'rows_read' AS metric,
    CAST(count(*) + count(*) FILTER (event_timestamp < TIMESTAMP '2024-01-11') AS DOUBLE) AS value FROM silver
    UNION ALL SELECT 'stream_dedup', 'success', 'late_rows', CAST(count(*) AS DOUBLE) FROM silver WHERE event_timestamp < TIMESTAMP '2024-01-11'""",
    "silver",
)
oracle("stream_dedup", "SELECT aircraft_id, event_timestamp FROM silver", "silver")
oracle(
    "stream_congestion",
    f"""SELECT {', '.join(COUNTS)} FROM counts
    WHERE event_timestamp + INTERVAL 1 HOUR <= (SELECT max(event_timestamp) - INTERVAL 2 HOUR FROM silver)""",
    "counts", "silver",
)
oracle(
    "stream_tracks",
    "SELECT aircraft_id, event_timestamp, heading_change_5m, avg_speed_15m, distance_10m_km, false AS is_late FROM flights",
    "flights",
)
