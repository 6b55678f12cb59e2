"""Thresholds, feature lists and the airport table."""

# Airport code, name, latitude, longitude.
AIRPORTS = [
    ("YMML", "Melbourne", -37.673, 144.843),
    ("YSSY", "Sydney", -33.946, 151.177),
    ("YBBN", "Brisbane", -27.384, 153.117),
    ("YPER", "Perth", -31.940, 115.967),
    ("EGLL", "London Heathrow", 51.477, -0.461),
    ("EHAM", "Amsterdam", 52.308, 4.764),
    ("EDDF", "Frankfurt", 50.033, 8.571),
    ("LFPG", "Paris CDG", 49.009, 2.548),
    ("LEMD", "Madrid", 40.472, -3.561),
    ("LIRF", "Rome", 41.800, 12.239),
    ("KLAX", "Los Angeles", 33.943, -118.408),
    ("KJFK", "New York JFK", 40.640, -73.779),
    ("KORD", "Chicago O'Hare", 41.978, -87.904),
    ("KATL", "Atlanta", 33.640, -84.427),
    ("KDFW", "Dallas", 32.896, -97.038),
    ("KSFO", "San Francisco", 37.619, -122.375),
    ("KDEN", "Denver", 39.856, -104.674),
    ("KSEA", "Seattle", 47.449, -122.309),
    ("VHHH", "Hong Kong", 22.309, 113.915),
    ("ZBAA", "Beijing", 40.080, 116.584),
    ("ZSPD", "Shanghai Pudong", 31.144, 121.805),
    ("RJTT", "Tokyo Haneda", 35.549, 139.779),
    ("RKSI", "Seoul Incheon", 37.460, 126.440),
    ("WSSS", "Singapore", 1.359, 103.989),
    ("OMDB", "Dubai", 25.253, 55.364),
    ("OBBI", "Bahrain", 26.270, 50.634),
    ("HECA", "Cairo", 30.122, 31.406),
    ("FAOR", "Johannesburg", -26.133, 28.242),
    ("DNMM", "Lagos", 6.577, 3.321),
    ("HAAB", "Addis Ababa", 8.978, 38.799),
    ("VIDP", "Delhi", 28.556, 77.101),
    ("VABB", "Mumbai", 19.089, 72.868),
    ("VECC", "Kolkata", 22.655, 88.447),
    ("VOMM", "Chennai", 12.990, 80.169),
    ("WIDD", "Denpasar Bali", -8.748, 115.167),
    ("WADD", "Jakarta", -6.127, 106.656),
    ("VTBS", "Bangkok", 13.681, 100.747),
    ("VYYY", "Yangon", 16.907, 96.134),
    ("WMKK", "Kuala Lumpur", 2.745, 101.710),
    ("RPLL", "Manila", 14.508, 121.019),
    ("SBGR", "Sao Paulo", -23.432, -46.469),
    ("SBGL", "Rio de Janeiro", -22.810, -43.251),
    ("SKBO", "Bogota", 4.702, -74.147),
    ("SEQM", "Quito", -0.129, -78.358),
    ("MMMX", "Mexico City", 19.436, -99.072),
    ("MHTG", "Tegucigalpa", 14.061, -87.217),
    ("CYYZ", "Toronto", 43.677, -79.630),
    ("CYVR", "Vancouver", 49.194, -123.184),
    ("NZAA", "Auckland", -37.008, 174.792),
    ("NFFN", "Nadi Fiji", -17.755, 177.443),
]

# Geometry and windows.
EARTH_RADIUS_KM = 6371.0
AIRPORT_RADIUS_KM = 50.0
ROLLING_SECONDS = 900

# Silver bounds (inclusive) and gates.
SILVER_BOUNDS = {
    "baro_altitude": (-500.0, 15000.0),
    "velocity": (0.0, 400.0),
    "latitude": (-90.0, 90.0),
    "longitude": (-180.0, 180.0),
}
SILVER_NOT_NULL = ["latitude", "longitude", "baro_altitude", "aircraft_id"]
SILVER_REQUIRED = ["aircraft_id", "latitude", "longitude", "baro_altitude", "event_timestamp"]
MIN_SILVER_ROWS = 50
MIN_STATES_PER_POLL = 100
MAX_NULL_RATIO = 0.30

# Bronze expectations.
BRONZE_REQUIRED = [
    "icao24", "callsign", "origin_country", "longitude", "latitude", "baro_altitude",
    "on_ground", "velocity", "true_track", "vertical_rate", "time_position",
]
BRONZE_BOUNDS = {
    "velocity": (0.0, 600.0),
    "baro_altitude": (-500.0, 15000.0),
    "latitude": (-90.0, 90.0),
    "longitude": (-180.0, 180.0),
    "true_track": (0.0, 360.0),
}
BRONZE_MOSTLY = 0.99

# Climb thresholds, labels, bands.
ARRIVAL_RATE = -1.0
DEPARTURE_RATE = 1.0
CRUISE_ALTITUDE_M = 5000.0
DELAY_ALTITUDE_M = 3000.0
DELAY_SPEED_MS = 100.0
CONGESTION_HIGH = 0.70
RISK_BANDS = [(0.7, "HIGH"), (0.4, "MEDIUM"), (0.0, "LOW")]
# Our own cut points; none are published for the four-level band.
CONGESTION_BANDS = [(0.9, "CRITICAL"), (0.7, "HIGH"), (0.4, "MEDIUM"), (0.0, "LOW")]

# Model inputs, splits, floors.
DELAY_FEATURES = [
    "speed_ms", "altitude_m", "vertical_rate_ms", "heading_change_5m", "avg_speed_15m",
    "aircraft_count_50km", "congestion_score", "hour_of_day", "day_of_week",
]
CONGESTION_FEATURES = [
    "aircraft_count_50km", "arrivals_last_30m", "departures_last_30m", "avg_altitude_50km",
    "hour_of_day", "day_of_week",
]
ANOMALY_FEATURES = [
    "heading_change_5m", "speed_ms", "altitude_m", "vertical_rate_ms", "distance_10m_km",
]
SEED = 42
TEST_SIZE = 0.15
CV_FOLDS = 3
TRIALS = 10
SAMPLE_ROWS = 50_000
MIN_TRAIN_ROWS = 500
DELAY_MAX_ROWS = 500_000
CONGESTION_MAX_ROWS = 200_000
CONTAMINATION = 0.05
FOREST_TREES = 200
FOREST_SAMPLE = 256
LOF_NEIGHBOURS = 20
MIN_AUC = 0.62
MIN_F1 = 0.50
MIN_R2 = 0.40
DRIFT_SHARE = 0.30
EXPLAIN_TOP = 5
