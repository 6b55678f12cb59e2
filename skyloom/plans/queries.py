"""Every operator as a query over the test tables: name -> (spark, sf_dir) -> DataFrame."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom import constants as C
from skyloom.functions import flight as fx
from skyloom.functions.geo import haversine_km
from skyloom.operators import (
    anomaly, attributions, boosting, clean, congestion, drift, flights, gates, importance, isolation, labels, metrics, models,
    neighbours, quality, routes, sampling, spatial, trials, views,
)
from skyloom.plans import jobs, telemetry
from skyloom.sources import bronze, lake, upserts
from skyloom.sources.schemas import SILVER_COLUMNS, SILVER_KEY, SILVER_ORDER, SILVER_PARTITIONS
from skyloom.streaming import ingest
from skyloom.streaming.congestion import hourly_counts
from skyloom.streaming.latest import LatestTable
from skyloom.streaming.tracks import TrackFeatures

QUERIES = {}


def query(fn):
    """Register ``fn``; timestamps come out without zone and doubles with six places. Event
    times of the test tables carry no zone and are UTC, whatever the session's is."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with lake.utc(spark):
            return presented(fn(spark, sf_dir))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


def presented(df: DataFrame) -> DataFrame:
    columns = []
    for f in df.schema.fields:
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            value = value.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DoubleType):
            value = F.round(value, 6)
        columns.append(value.alias(f.name))
    return df.select(*columns)


# ---- sources and cleaning


@query
def parse_states(spark, sf):
    """Positional vectors -> named columns (short ones padded, null ones skipped)."""
    return bronze.parse_states(telemetry.raw_responses(spark, sf), keep=["event_id"])


@query
def validate_states(spark, sf):
    return bronze.validate_states(
        bronze.parse_states(telemetry.raw_responses(spark, sf), keep=["event_id"])
    ).select("event_id", "icao24", "latitude", "longitude")


@query
def land_bronze(spark, sf):
    """Parse responses, land them as JSON by ingest day, read one row per landed batch back."""
    path = lake.fresh_path(spark, "bronze")
    bronze.land_bronze(bronze.parse_batches(telemetry.raw_responses(spark, sf), "value", "run_time"), path)
    return spark.read.json(path, "fetch_timestamp double, aircraft_count int, year string, month string, day string")


@query
def bronze_scan(spark, sf):
    """Read landed JSON with the bronze schema and flatten it."""
    path = lake.fresh_path(spark, "bronze")
    bronze.land_bronze(telemetry.bronze(spark, sf), path)
    return clean.explode_states(bronze.read_bronze(spark, path))


@query
def explode_flatten(spark, sf):
    return clean.explode_states(telemetry.bronze(spark, sf))


@query
def silver_clean(spark, sf):
    return clean.clean(telemetry.flat_states(telemetry.states(spark, sf)))


@query
def silver_quarantine(spark, sf):
    """Rejected rows and why."""
    rejected = clean.quarantine(telemetry.flat_states(telemetry.states(spark, sf)))
    return rejected.select("event_id", "aircraft_id", "reject_reason")


@query
def silver_dedup(spark, sf):
    """Every state is seen by three polls; the latest contact stays."""
    seen = telemetry.flat_states(telemetry.states(spark, sf)).drop("event_id")
    polls = seen.withColumn("poll", F.explode(F.array(*[F.lit(i) for i in range(3)])))
    return clean.dedup(
        clean.clean(
            polls.withColumn("last_contact", F.col("last_contact") + 10 * F.col("poll"))
        )
    )


@query
def silver_table(spark, sf):
    return telemetry.silver(spark, sf)


@query
def silver_write_readback(spark, sf):
    """Publish silver twice (the second run must change nothing), count what is there by day."""
    path = lake.fresh_path(spark, "silver")
    new = lake.staged(telemetry.silver(spark, sf), "silver_new")
    lake.merge_partitioned(new, path, SILVER_PARTITIONS, SILVER_KEY, SILVER_ORDER)
    lake.merge_partitioned(new, path, SILVER_PARTITIONS, SILVER_KEY, SILVER_ORDER)
    table = lake.read_days(spark, path, None, None)
    return table.groupBy(*SILVER_PARTITIONS).agg(
        F.count("*").alias("n"), F.countDistinct("aircraft_id").alias("aircraft")
    )


@query
def run_metrics(spark, sf):
    """Counts a bronze-to-silver run records about itself."""
    root = lake.fresh_path(spark, "run")
    bronze.land_bronze(telemetry.bronze(spark, sf), f"{root}/bronze")
    jobs.bronze_to_silver(spark, f"{root}/bronze", f"{root}/silver", "run", f"{root}/metrics")
    recorded = spark.read.parquet(f"{root}/metrics")
    return recorded.select("stage", "status", F.explode("metrics").alias("metric", "value"))


RANGES = [(None, "2024-01-12"), ("2024-01-13", "2024-01-13"), ("2024-01-10", "2024-01-20"), ("2024-01-21", None)]


def _by_ranges(spark, sf, job, name, **given):
    """Path of a gold table made range by range, some days twice."""
    root = lake.fresh_path(spark, name)
    lake.write_partitioned(telemetry.silver(spark, sf), f"{root}/silver", SILVER_PARTITIONS)
    for first, last in RANGES:
        job(spark, f"{root}/silver", f"{root}/gold", "run", first_day=first, last_day=last, **given)
    return f"{root}/gold"


@query
def congestion_job_range(spark, sf):
    """Airport load from runs over ranges of days: the same as in one run."""
    path = _by_ranges(spark, sf, jobs.congestion_job, "congestion_range", airports=telemetry.hubs(spark, sf))
    return congestion.read_scored(spark, path).drop("created_timestamp", "event_date")


@query
def labels_job_range(spark, sf):
    """Labels made range by range after the flights and loads of the range: the same as in one
    run, though only days whose flights or loads changed are rebuilt."""
    root, hubs = lake.fresh_path(spark, "labels_range"), telemetry.hubs(spark, sf)
    lake.write_partitioned(telemetry.silver(spark, sf), f"{root}/silver", SILVER_PARTITIONS)
    for first, last in RANGES:
        days = {"first_day": first, "last_day": last}
        jobs.flights_job(spark, f"{root}/silver", f"{root}/flights", "run", **days)
        jobs.congestion_job(spark, f"{root}/silver", f"{root}/load", "run", airports=hubs, **days)
        jobs.labels_job(spark, f"{root}/flights", f"{root}/load", f"{root}/labels", "run", airports=hubs, **days)
    return spark.read.parquet(f"{root}/labels").select(
        "aircraft_id", "event_timestamp", "altitude_m", "speed_ms", "snapshot_hour", "max_congestion_score", "delay_risk"
    )


@query
def congestion_job_emptied_day(spark, sf):
    """Airport load after the reports of one day turn out to lie far from any airport: its old
    rows go when the day is run again."""
    root, hubs = lake.fresh_path(spark, "emptied"), telemetry.hubs(spark, sf)
    silver = lake.staged(telemetry.silver(spark, sf), "silver")
    lake.write_partitioned(silver, f"{root}/silver", SILVER_PARTITIONS)
    jobs.congestion_job(spark, f"{root}/silver", f"{root}/load", "run", airports=hubs)
    moved = silver.filter("event_date = DATE '2024-01-13'").withColumn("latitude", F.lit(89.5))
    lake.write_partitioned(moved, f"{root}/silver", SILVER_PARTITIONS)
    jobs.congestion_job(spark, f"{root}/silver", f"{root}/load", "run", airports=hubs, first_day="2024-01-13", last_day="2024-01-13")
    return congestion.read_scored(spark, f"{root}/load").drop("created_timestamp", "event_date")


@query
def quarantine_by_day(spark, sf):
    """Rejected rows after runs over ranges of ingest days: each run replaces its own days only."""
    root = lake.fresh_path(spark, "quarantine")
    bronze.land_bronze(telemetry.bronze(spark, sf), f"{root}/bronze")
    for first, last in (("2024-01-01", "2024-01-14"), ("2024-01-13", "2024-01-20"), ("2024-01-21", None)):
        jobs.bronze_to_silver(
            spark, f"{root}/bronze", f"{root}/silver", "run", quarantine_path=f"{root}/rejected",
            first_ingest_day=first, last_ingest_day=last,
        )
    rejected = spark.read.parquet(f"{root}/rejected")
    return rejected.groupBy("ingest_date", "reject_reason").agg(F.count("*").alias("rows"))


@query
def routes_job_range(spark, sf):
    return routes.read_combined(spark, _by_ranges(spark, sf, jobs.routes_job, "routes_range"))


@query
def routes_sketched_range(spark, sf):
    """Routes of all days from the sketches of the range runs."""
    return routes.read_sketched(spark, _by_ranges(spark, sf, jobs.routes_job, "routes_sketched"))


@query
def routes_sketched_days(spark, sf):
    """Routes of ten days in the middle, from sketches by day."""
    path = lake.fresh_path(spark, "route_sketches")
    routes.day_sketches(routes.route_days(telemetry.silver(spark, sf))).write.parquet(f"{path}_sketches")
    return routes.read_sketched(spark, path, "2024-01-08", "2024-01-17")


@query
def flight_features_range(spark, sf):
    path = _by_ranges(spark, sf, jobs.flights_job, "flights_range")
    return spark.read.parquet(path).drop("created_timestamp", "event_date")


@query
def ingest_counts(spark, sf):
    """States landed and dropped of each poll."""
    return bronze.parse_batches(telemetry.raw_responses(spark, sf), "value", "run_time").select(
        F.col("fetch_timestamp"), "aircraft_count", "dropped_count"
    )


# ---- features


def _silver(spark, sf):
    """Silver as a table, which is what gold jobs read."""
    return lake.staged(telemetry.silver(spark, sf), "silver")


@query
def flight_features(spark, sf):
    return flights.flight_features(_silver(spark, sf))


@query
def flight_features_sliced(spark, sf):
    """The same with every aircraft treated as too busy for one task."""
    return flights.flight_features(_silver(spark, sf), busy_rows=0)


@query
def heading_change(spark, sf):
    """The turn with and without wrapping at 360 degrees."""
    fixes = flights.windowed(flights.airborne(_silver(spark, sf)))
    now, before = F.col("heading"), F.col("prev_heading")
    return fixes.select(
        "aircraft_id",
        "event_timestamp",
        fx.heading_change(before, now).alias("turn"),
        fx.heading_change(before, now, wrap=False).alias("raw_turn"),
        fx.day_of_week(F.col("event_timestamp"), monday_first=False).alias("sunday_first"),
    )


@query
def rolling_speed(spark, sf):
    """Mean speed over 15 minutes and over a day (which nearly every fix shares)."""
    fixes = flights.airborne(_silver(spark, sf))
    short = flights.windowed(fixes).select("aircraft_id", "event_timestamp", "avg_speed_15m")
    day = flights.windowed(fixes, 86_400, 86_400).select(
        "aircraft_id", "event_timestamp", F.col("avg_speed_15m").alias("avg_speed_day")
    )
    return short.join(day, ["aircraft_id", "event_timestamp"])


@query
def congestion_join(spark, sf):
    """Every (state, hub) pair within 50 km."""
    near = spatial.within_radius(telemetry.silver(spark, sf), telemetry.hubs(spark, sf))
    return near.select("aircraft_id", "event_timestamp", "airport_code", "dist_km")


@query
def congestion_join_shuffled(spark, sf):
    """The same with the hubs taken as too many to broadcast: joined by cells that split where
    many states are."""
    silver = lake.staged(telemetry.silver(spark, sf), "silver")
    near = spatial.within_radius(silver, telemetry.hubs(spark, sf), max_broadcast_cells=0, busy_rows=100)
    return near.select("aircraft_id", "event_timestamp", "airport_code", "dist_km")


@query
def airport_matches(spark, sf):
    """States near the built-in airports, over positions spread across the globe."""
    spread = telemetry.events(spark, sf).selectExpr(
        "event_id",
        "cast(event_id * 7 % 1801 - 900 as double) / 10 as latitude",
        "cast(event_id * 11 % 3601 - 1800 as double) / 10 as longitude",
    )
    near = spatial.within_radius(spread, lake.airports(spark), radius_km=500.0)
    return near.select("event_id", "airport_code", "dist_km")


@query
def congestion_counts(spark, sf):
    return congestion.airport_counts(telemetry.silver(spark, sf), telemetry.hubs(spark, sf))


@query
def congestion_half_hours(spark, sf):
    """The same measures over true 30-minute buckets."""
    silver = telemetry.silver(spark, sf)
    halves = silver.withColumn(
        "event_timestamp",
        F.timestamp_seconds(F.floor(F.col("event_timestamp").cast("bigint") / 1800) * 1800),
    )
    return congestion.airport_counts(halves, telemetry.hubs(spark, sf), bucket="minute")


@query
def congestion_features(spark, sf):
    return congestion.congestion_features(telemetry.silver(spark, sf), telemetry.hubs(spark, sf))


@query
def congestion_unique_aircraft(spark, sf):
    return congestion.unique_aircraft(telemetry.silver(spark, sf), telemetry.hubs(spark, sf))


@query
def route_features(spark, sf):
    return routes.route_features(telemetry.silver(spark, sf))


@query
def scalar_functions(spark, sf):
    """Distance, route, bands, clip, clock parts on every event."""
    rows = telemetry.states(spark, sf)
    at = F.timestamp_seconds("last_contact")
    return rows.select(
        "event_id",
        haversine_km(F.col("latitude"), F.col("longitude"), F.lit(10.0), F.lit(20.0)).alias("dist_km"),
        fx.route_id(F.col("callsign")).alias("route_id"),
        fx.clip01((F.col("velocity") - 50) / 100).alias("clipped"),
        F.to_date(at).alias("event_date"),
        F.date_format(at, "yyyy/MM/dd").alias("folder"),
        F.hour(at).alias("hour"),
        fx.day_of_week(at).alias("monday_first"),
        F.date_trunc("hour", at).alias("hour_start"),
        F.col("on_ground").cast("int").alias("is_on_ground"),
    )


# ---- data quality


@query
def dq_bronze(spark, sf):
    states = quality.validation_frame(telemetry.states(spark, sf))
    return quality.run_suite(states, quality.bronze_suite())


@query
def dq_summary(spark, sf):
    return quality.summarise(quality.run_suite(telemetry.states(spark, sf), quality.bronze_suite()))


@query
def dq_missing_column(spark, sf):
    """The suite on a table without velocity: two failures, no error."""
    lacking = telemetry.states(spark, sf).drop("velocity")
    return quality.failures(quality.run_suite(lacking, quality.bronze_suite()))


@query
def dq_null_ratio(spark, sf):
    states = telemetry.flat_states(telemetry.states(spark, sf))
    return quality.null_ratios(states, [*C.SILVER_NOT_NULL, "velocity", "vertical_rate", "callsign"])


@query
def dq_silver_gates(spark, sf):
    return quality.silver_gates(telemetry.silver(spark, sf))


@query
def dq_poll_gates(spark, sf):
    """Hours of events as polls, checked against the floor of states per poll."""
    polls = telemetry.states(spark, sf).groupBy(
        (F.floor(F.col("last_contact") / 86_400) * 86_400).alias("fetch_timestamp")
    ).agg(F.count("*").alias("aircraft_count"))
    return quality.poll_gates(polls)


# ---- feature views


def _created(df):
    return df.withColumn("created_timestamp", F.col("event_timestamp") + F.expr("interval 5 minutes"))


def _flight_source(spark, sf):
    """Gold flights with six places, so that narrow types agree to the bit."""
    return _created(_rounded(flights.flight_features(_silver(spark, sf))))


def _airport_source(spark, sf):
    return _created(_rounded(congestion.congestion_features(telemetry.silver(spark, sf), telemetry.hubs(spark, sf))))


def _rounded(df):
    return df.select(
        *[F.round(f.name, 6).alias(f.name) if f.dataType == T.DoubleType() else f.name for f in df.schema]
    )


@query
def feature_view_flight(spark, sf):
    return views.FLIGHT_VIEW.select(_flight_source(spark, sf))


@query
def feature_view_airport(spark, sf):
    return views.AIRPORT_VIEW.select(_airport_source(spark, sf))


@query
def feature_view_route(spark, sf):
    return views.ROUTE_VIEW.select(_created(_rounded(routes.route_features(telemetry.silver(spark, sf)))))


WINDOW_START, WINDOW_END = datetime(2024, 1, 14, 22), datetime(2024, 1, 15, 0)


@query
def materialize_latest(spark, sf):
    """Latest flight features per aircraft seen in a two-hour interval."""
    return views.materialise_latest(
        views.FLIGHT_VIEW, _flight_source(spark, sf),
        WINDOW_START.isoformat(" "), WINDOW_END.isoformat(" "),
    )


@query
def materialize_all(spark, sf):
    """Latest flight features of every aircraft over all time."""
    return views.materialise_latest(
        views.FLIGHT_VIEW, _flight_source(spark, sf), "2000-01-01 00:00:00", "2100-01-01 00:00:00"
    )


@query
def materialize_upsert(spark, sf):
    """Two intervals one after the other: aircraft not seen in the second keep their values."""
    root = lake.fresh_path(spark, "upsert")
    _flight_source(spark, sf).withColumn("event_date", F.to_date("event_timestamp")).write.parquet(f"{root}/flights")
    source = {views.FLIGHT_VIEW.name: f"{root}/flights"}
    for start, end in (("2024-01-01 00:00:00", "2024-01-14 00:00:00"), ("2024-01-14 22:00:00", "2024-01-15 00:00:00")):
        jobs.materialise_job(spark, source, f"{root}/latest", start, end, "run")
    return upserts.stored(spark, f"{root}/latest/{views.FLIGHT_VIEW.name}")


@query
def asof_join(spark, sf):
    """Each order looks up an aircraft's features as of a time in January."""
    spine = spark.read.parquet(f"{sf}/orders.parquet").selectExpr(
        "o_orderkey",
        "cast(o_custkey % 150 as string) as aircraft_id",
        "timestamp_seconds(1704067200 + o_orderkey * 7919 % 2592000) as event_timestamp",
    )
    source = lake.staged(_flight_source(spark, sf), "flight_features")
    found = views.as_of(views.FLIGHT_VIEW, spine, source)
    return found.select(
        "o_orderkey", "aircraft_id", "event_timestamp", "feature_event_timestamp", "speed_ms", "heading_deg"
    )


@query
def asof_airport(spark, sf):
    """The airport view (hourly values, one hour of lifetime) as of each order, every airport
    treated as too busy for one task."""
    spine = spark.read.parquet(f"{sf}/orders.parquet").join(
        F.broadcast(spark.read.parquet(f"{sf}/nation.parquet")), F.expr("o_custkey % 25 = n_nationkey")
    ).selectExpr(
        "o_orderkey",
        "n_name as airport_code",
        "timestamp_seconds(1704067200 + cast(floor(o_orderkey * 7919 % 2592000 / 600) as bigint) * 600) as event_timestamp",
    )
    source = lake.staged(_airport_source(spark, sf), "airport_features")
    found = views.as_of(views.AIRPORT_VIEW, spine, source, busy_rows=0)
    return found.select(
        "o_orderkey", "airport_code", "event_timestamp", "feature_event_timestamp", "aircraft_count_50km", "congestion_score"
    )


# ---- labels, samples, splits


def _gold(spark, sf):
    silver = _silver(spark, sf)
    hubs = telemetry.hubs(spark, sf)
    return flights.flight_features(silver), congestion.congestion_features(silver, hubs), hubs


def _labels(spark, sf):
    gold, load, _ = _gold(spark, sf)
    return labels.delay_labels(gold, labels.hourly_congestion(load))


def _delay_frame(spark, sf):
    gold, load, hubs = _gold(spark, sf)
    enriched = labels.with_nearest_congestion(gold, hubs, load)
    labelled = labels.delay_labels(enriched, labels.hourly_congestion(load))
    return labels.training_frame(
        labelled, C.DELAY_FEATURES, "delay_risk", ["aircraft_id", "event_timestamp"]
    )


@query
def hourly_congestion(spark, sf):
    return labels.hourly_congestion(
        congestion.congestion_features(telemetry.silver(spark, sf), telemetry.hubs(spark, sf))
    )


@query
def delay_labels(spark, sf):
    return _labels(spark, sf).select(
        "aircraft_id", "event_timestamp", "altitude_m", "speed_ms", "snapshot_hour", "max_congestion_score", "delay_risk"
    )


@query
def label_summary(spark, sf):
    return labels.label_summary(_labels(spark, sf))


@query
def nearest_congestion(spark, sf):
    gold, load, hubs = _gold(spark, sf)
    return labels.with_nearest_congestion(gold, hubs, load).select(
        "aircraft_id", "event_timestamp", "airport_code", "dist_km", "aircraft_count_50km", "congestion_score"
    )


@query
def training_frame(spark, sf):
    return _delay_frame(spark, sf)


@query
def congestion_training_frame(spark, sf):
    load = congestion.congestion_features(telemetry.silver(spark, sf), telemetry.hubs(spark, sf))
    return labels.training_frame(
        labels.congestion_training_columns(load), C.CONGESTION_FEATURES, "congestion_score",
        ["airport_code", "event_timestamp"],
    )


@query
def hash_sample(spark, sf):
    """A sample of a fixed size, whatever the table's."""
    rows = telemetry.events(spark, sf).select("event_id", "event_type", "value")
    return sampling.hash_sample(rows, ["event_id"], 500)


@query
def hash_sample_strata(spark, sf):
    rows = telemetry.events(spark, sf).select("event_id", "event_type", "value")
    return sampling.hash_sample(rows, ["event_id"], 100, strata="event_type")


@query
def split_plain(spark, sf):
    return sampling.split(telemetry.events(spark, sf).select("event_id", "event_type"), ["event_id"])


@query
def split_stratified(spark, sf):
    rows = telemetry.events(spark, sf).select("event_id", "event_type")
    return sampling.split(rows, ["event_id"], stratify="event_type")


@query
def split_time(spark, sf):
    rows = telemetry.events(spark, sf).select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return sampling.split_by_time(rows, "ts", "2024-01-25")


@query
def fold_assign(spark, sf):
    return sampling.folds(telemetry.events(spark, sf).select("event_id"), ["event_id"])


@query
def fold_stratified(spark, sf):
    rows = telemetry.events(spark, sf).select("event_id", "event_type")
    return sampling.folds(rows, ["event_id"], stratify="event_type")


@query
def hash_sample_nulls(spark, sf):
    """A sample by a key of two columns, either of which may be null."""
    rows = telemetry.events(spark, sf).selectExpr(
        "event_id",
        "nullif(event_id % 50, 7) as part",
        "case when event_id % 3 = 0 then null else concat(event_type, '|', cast(event_id as string)) end as name",
    )
    once = rows.groupBy("part", "name").agg(F.min("event_id").alias("event_id"))
    return sampling.hash_sample(lake.staged(once, "once"), ["part", "name"], 300)


@query
def standardize(spark, sf):
    rows = telemetry.flat_states(telemetry.states(spark, sf)).select(
        "event_id", "velocity", "baro_altitude", F.lit(3.0).alias("constant")
    )
    return sampling.standardise(rows, ["velocity", "baro_altitude", "constant"])


@query
def class_weights(spark, sf):
    return sampling.balanced_weights(telemetry.events(spark, sf).select("event_id", "event_type"), "event_type")


@query
def risk_band(spark, sf):
    """Bands of probabilities, cut points included."""
    p = F.col("event_id") % 101 / 100
    return telemetry.events(spark, sf).select(
        "event_id",
        fx.risk_band(p).alias("risk"),
        fx.congestion_band(p).alias("congestion"),
        fx.is_anomaly(F.when(F.col("event_id") % 20 == 0, -1).otherwise(1)).alias("is_anomaly"),
    )


# ---- metrics, trials, gates


def _scored(spark, sf):
    """Events as scored rows: label, a score that leans on it, tied scores, a target."""
    return telemetry.events(spark, sf).selectExpr(
        "event_id",
        "cast(event_id % 5 = 0 as int) as label",
        "cast(event_id * 37 % 701 + 299 * cast(event_id % 5 = 0 as int) as double) / 1000 as score",
        "cast(event_id * 31 % 97 as double) / 10 as target",
        "cast(event_id * 31 % 97 + event_id % 13 - 6 as double) / 10 as prediction",
        "cast(event_id % 4 as int) as trial",
        "cast(floor(event_id / 4) % 3 as int) as fold",
        "case cast(event_id % 4 as int) when 0 then 'lgbm' when 1 then 'xgboost' else 'hgb' end as algorithm",
    )


@query
def metric_auc(spark, sf):
    return metrics.auc(_scored(spark, sf))


@query
def metric_auc_by_trial(spark, sf):
    return metrics.auc(_scored(spark, sf), by=["trial", "fold"])


@query
def metric_confusion(spark, sf):
    return metrics.confusion(_scored(spark, sf), by=["trial"])


@query
def metric_regression(spark, sf):
    return metrics.regression(_scored(spark, sf), by=["trial"])


@query
def metric_anomaly(spark, sf):
    scored = _scored(spark, sf).withColumn("is_anomaly", F.col("score") > 0.95)
    return metrics.anomaly(scored, score="score")


@query
def trial_scores(spark, sf):
    return trials.trial_scores(_scored(spark, sf))


@query
def trial_summary(spark, sf):
    return trials.algorithm_summary(
        trials.trial_scores(_scored(spark, sf)), ["lgbm", "xgboost", "catboost", "random_forest", "hgb"]
    )


@query
def best_trial(spark, sf):
    return trials.best_trial(trials.trial_scores(_scored(spark, sf)))


@query
def regression_trials(spark, sf):
    return trials.regression_trial_scores(_scored(spark, sf))


@query
def gate(spark, sf):
    """All three decisions, candidate and champion scored on the same rows."""
    rows = _scored(spark, sf)
    worse = rows.withColumn("score", F.col("event_id") * 37 % 701 / 700)
    delay = _roles(rows, worse)
    off = rows.withColumn("prediction", F.col("target") + (F.col("event_id") % 29 - 14) / 10)
    load = _roles(off, rows)
    return gates.all_gates(
        gates.delay_gate(delay), gates.congestion_gate(load), gates.anomaly_gate(delay)
    )


def _roles(candidate, champion):
    return candidate.withColumn(gates.ROLE, F.lit(gates.CANDIDATE)).unionByName(
        champion.withColumn(gates.ROLE, F.lit(gates.CHAMPION))
    )


COEFFICIENTS = {"velocity": 0.02, "baro_altitude": -0.0005, "heading": 0.001}


def _contributions(spark, sf):
    rows = clean.clean(telemetry.flat_states(telemetry.states(spark, sf)))
    return importance.linear_contributions(rows.select("event_id", *COEFFICIENTS), COEFFICIENTS)


@query
def contribution_map(spark, sf):
    """Per-row contributions of a linear model, as a map, shown by key."""
    mapped = importance.contribution_map(_contributions(spark, sf), list(COEFFICIENTS))
    return mapped.select("event_id", *[F.col("contributions")[f].alias(f) for f in COEFFICIENTS])


@query
def feature_rank(spark, sf):
    ranked = trials.mean_contributions(_contributions(spark, sf), list(COEFFICIENTS))
    return trials.top_features(ranked, 2)


#: Two small trees over velocity, baro_altitude and vertical_rate: feature, threshold, left, right,
#: value, cover. The first tests velocity twice on one path.
EXPLAINED = ["velocity", "baro_altitude", "vertical_rate"]
EXPLAINED_TREES = [
    attributions.Nodes([0, 1, 0, -1, -1, -1, -1], [50.0, 6000.0, 90.0, 0, 0, 0, 0], [1, 3, 5, 0, 0, 0, 0], [2, 4, 6, 0, 0, 0, 0], [0, 0, 0, 1.0, -0.5, 0.25, 2.0], [100, 60, 40, 20, 40, 10, 30]),
    attributions.Nodes([2, -1, 0, -1, 1, -1, -1], [0.0, 0, 25.0, 0, 9000.0, 0, 0], [1, 0, 3, 0, 5, 0, 0], [2, 0, 4, 0, 6, 0, 0], [0, -1.0, 0, 0.5, 0, 3.0, -2.0], [64, 32, 32, 8, 24, 18, 6]),
]


def _explained(spark, sf):
    rows = telemetry.flat_states(telemetry.states(spark, sf)).select("event_id", *EXPLAINED)
    return attributions.tree_contributions(rows, EXPLAINED_TREES, EXPLAINED, 0.125)


@query
def tree_contributions(spark, sf):
    """What each input adds to the score of two trees, for every state; some inputs are missing."""
    return _explained(spark, sf)


@query
def tree_feature_rank(spark, sf):
    return trials.top_features(trials.mean_contributions(_explained(spark, sf), EXPLAINED), 2)


# ---- drift and rules


@query
def drift_psi(spark, sf):
    """Stability index between the first two weeks and the rest, on fixed bins."""
    rows = telemetry.flat_states(telemetry.states(spark, sf)).withColumn(
        "is_new", F.col("last_contact") >= 1705276800
    )
    edges = {
        "velocity": [10.0, 25.0, 50.0, 100.0],
        "baro_altitude": [2000.0, 6000.0, 10000.0],
        "vertical_rate": [-5.0, 0.0, 5.0],
    }
    return drift.psi(rows, "is_new", edges)


@query
def drift_window(spark, sf):
    """Index between the first two weeks and the rest from sketches by day, beside the exact one
    on the same bins: as near as the sketches' error, and the same decision."""
    rows = telemetry.silver(spark, sf)
    features = ["velocity", "baro_altitude", "vertical_rate"]
    sketches = lake.staged(drift.day_sketches(rows, "event_date", features), "day_sketches")
    old, new = (drift.window_sketch(sketches, *days) for days in (("2024-01-01", "2024-01-14"), ("2024-01-15", "2024-12-31")))
    found = drift.sketched_psi(old, new).withColumnRenamed("psi", "sketched")
    is_new = rows.withColumn("is_new", F.col("event_date") >= F.lit("2024-01-15").cast("date"))
    exact = drift.psi(is_new, "is_new", drift.quantile_edges(is_new.filter("not is_new"), features))
    close = F.abs(F.col("sketched") - F.col("psi")) <= 0.05
    return found.drop("drifted").join(exact, "feature").select("feature", "drifted", close.alias("close"))


def _daily(spark, sf):
    """Root mean square error of each model by day; from the twentieth the predictions of one get
    worse."""
    rows = telemetry.events(spark, sf).selectExpr(
        "cast(cast(ts as timestamp) as date) as day",
        "cast(event_id % 2 as int) as model",
        "cast(event_id * 31 % 97 as double) / 10 as target",
        "cast(event_id * 31 % 97 + event_id % 13 - 6 + cast(event_id % 2 = 1 and cast(ts as timestamp) >= timestamp '2024-01-20' as int) * (event_id % 5) as double) / 10 as prediction",
    )
    return metrics.regression(rows, by=["model", "day"])


@query
def performance_drop(spark, sf):
    """Which day's error says that a model has got worse?"""
    return drift.performance_drop(_daily(spark, sf), "rmse", "day", ["model"], higher_is_better=False).select(
        "model", "day", "rmse", "cusum", "dropped"
    )


@query
def drift_decision(spark, sf):
    """Quantile bins of the old slice; should the models be retrained?"""
    rows = telemetry.flat_states(telemetry.states(spark, sf)).withColumn(
        "is_new", F.col("last_contact") >= 1705276800
    )
    edges = drift.quantile_edges(rows.filter(~F.col("is_new")), ["velocity", "baro_altitude", "heading"])
    return drift.drift_decision(drift.psi(rows, "is_new", edges))


@query
def anomaly_rules(spark, sf):
    return drift.anomaly_rules(flights.flight_features(_silver(spark, sf))).select(
        "aircraft_id", "event_timestamp", "heading_jump", "odd_speed", "odd_climb", "stalled", "signals"
    )


# ---- models


KEYS = ["aircraft_id", "event_timestamp"]


def _between(column, low=0.0, high=1.0):
    return F.coalesce(F.col(column).between(low, high), F.lit(False))


@query
def delay_scores(spark, sf):
    """Fit on the stratified training part with the default settings, score all held-out rows:
    their keys and labels, and whether probability and band are as they must be."""
    frame = lake.staged(_delay_frame(spark, sf), "delay_frame")
    parts = lake.staged(sampling.split(frame, KEYS, stratify="delay_risk"), "delay_parts")
    model = models.fit_classifier(parts.filter("not is_test"), C.DELAY_FEATURES)
    scored = models.score_classifier(model, parts.filter("is_test"))
    p = F.col("delay_probability")
    band = F.when(p >= 0.7, "HIGH").when(p >= 0.4, "MEDIUM").otherwise("LOW")
    return scored.select(
        *KEYS, "delay_risk", _between("delay_probability").alias("in_range"), (fx.risk_band(p) == band).alias("band_fits")
    )


@query
def congestion_scores(spark, sf):
    keys = ["airport_code", "event_timestamp"]
    frame = lake.staged(congestion_training_frame(spark, sf), "load_frame")
    parts = lake.staged(sampling.split(frame, keys), "load_parts")
    model = models.fit_regressor(parts.filter("not is_test"), C.CONGESTION_FEATURES)
    scored = models.score_regressor(model, parts.filter("is_test"))
    return scored.select(*keys, "congestion_score", _between("prediction").alias("in_range"))


BOOST_EDGES = [[10.0, 25.0, 50.0, 100.0], [2000.0, 6000.0, 10000.0], [-5.0, 0.0, 5.0]]
BOOST_SETTINGS = {
    "leaf": boosting.Settings("squared", "leaf", rounds=2, rate=0.5, depth=3, leaves=5, min_rows=20, l2=0.5, gamma=0.25),
    "level": boosting.Settings("squared", "level", rounds=2, rate=0.5, depth=2, min_rows=20, l2=2.0, gamma=0.125),
    "symmetric": boosting.Settings("squared", "symmetric", rounds=2, rate=0.5, depth=2, l2=1.0),
}


def _boost_rows(spark, sf):
    """Events with three inputs, some missing, and a target that leans on them."""
    rows = telemetry.flat_states(telemetry.states(spark, sf))
    slow, high, climbs = (F.coalesce(c, F.lit(False)).cast("int") for c in (F.col("velocity") < 40, F.col("baro_altitude") > 5000, F.col("vertical_rate") > 0))
    y = slow + 0.5 * high * climbs + (F.col("event_id") % 7) / 10
    return rows.select("event_id", F.array("velocity", "baro_altitude", "vertical_rate").alias("x"), y.alias("y"), F.lit(1.0).alias("w"), F.col("event_id").alias("k"))


def _boosted(spark, sf, growth):
    rows = _boost_rows(spark, sf)
    model = boosting.fit(rows, BOOST_SETTINGS[growth], BOOST_EDGES)
    return boosting.raw_scores(rows, model, "x", "raw").select("event_id", F.col("raw").alias("score"))


@query
def boosted_leafwise(spark, sf):
    """Best-first second-order trees, fitted to all events and scoring them."""
    return _boosted(spark, sf, "leaf")


@query
def boosted_levelwise(spark, sf):
    return _boosted(spark, sf, "level")


@query
def boosted_symmetric(spark, sf):
    return _boosted(spark, sf, "symmetric")


def _anomaly_frame(spark, sf):
    frame = labels.training_frame(
        _rounded(flights.flight_features(_silver(spark, sf))), C.ANOMALY_FEATURES, keep=KEYS
    )
    frame = lake.staged(frame, "anomaly_frame")
    return sampling.standardise(frame, C.ANOMALY_FEATURES)


@query
def anomaly_scores(spark, sf):
    """Every fix scored by a forest of the default size; is the rate the one expected?"""
    frame = _anomaly_frame(spark, sf)
    forest = isolation.fit_forest(frame, KEYS, C.ANOMALY_FEATURES)
    flagged = isolation.flag_anomalies(isolation.forest_scores(frame, forest))
    rate = F.avg(F.col("is_anomaly").cast("double"))
    return flagged.agg(
        F.count("*").alias("rows_scored"),
        rate.between(0.03, 0.07).alias("rate_as_expected"),
        F.bool_and((F.col("anomaly_score") < 0) == F.col("is_anomaly")).alias("sign_fits"),
    )


@query
def lof(spark, sf):
    """Local outlier factor of every embedding."""
    return neighbours.local_outlier_factor(
        spark.read.parquet(f"{sf}/embeddings.parquet"), ["vec_id"], "embedding", k=5
    ).select("vec_id", "lof")


@query
def lof_novelty(spark, sf):
    """Every embedding against a reference of every fifth."""
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    found = neighbours.local_outlier_factor(table, ["vec_id"], "embedding", k=5, reference=table.filter("vec_id % 5 = 0"))
    return found.select("vec_id", "lof")


EFFORT = 0.02


@query
def trial_table(spark, sf):
    """A random search over every family with all rounds and trees drawn, every fold of the delay
    frame scored: is each fold's score above chance?"""
    frame = sampling.folds(_delay_frame(spark, sf), KEYS, C.CV_FOLDS, stratify="delay_risk")
    settings, scored = models.search(
        frame, C.DELAY_FEATURES, "delay_risk", trials=len(models.FAMILIES)
    )
    per_fold = metrics.auc(scored, by=["trial", "algorithm", "fold"])
    return per_fold.select("trial", "algorithm", "fold", (F.col("auc") > 0.5).alias("above_floor"))


@query
def congestion_trials(spark, sf):
    keys = ["airport_code", "event_timestamp"]
    frame = sampling.folds(congestion_training_frame(spark, sf), keys, C.CV_FOLDS)
    settings, scored = models.search(
        frame, C.CONGESTION_FEATURES, "congestion_score", "regressor", trials=len(models.FAMILIES), effort=EFFORT
    )
    per_fold = metrics.regression(scored, by=["trial", "algorithm", "fold"])
    return per_fold.select("trial", "algorithm", "fold", F.col("rmse").between(0.0, 1.0).alias("within_range"))


@query
def flight_lof(spark, sf):
    """Local outlier factor of flight fixes in feature space."""
    frame = _anomaly_frame(spark, sf).select(*KEYS, F.array(*C.ANOMALY_FEATURES).alias("x"))
    return neighbours.local_outlier_factor(frame, KEYS, "x").drop("x")


@query
def anomaly_trials(spark, sf):
    """A search over both detectors, the outlier factor against all rows: rows scored by each
    trial, and is the rate within the bounds drawn from?"""
    frame = lake.staged(_anomaly_frame(spark, sf), "scaled_frame")
    settings, scored = anomaly.search(frame, KEYS, C.ANOMALY_FEATURES)
    return scored.groupBy("trial", "algorithm").agg(
        F.count("*").alias("rows_scored"),
        F.avg(F.col("is_anomaly").cast("double")).between(0.0, 0.16).alias("rate_in_bounds"),
    )


@query
def feature_importance(spark, sf):
    """Of a forest with the default settings: no negative share, all adding up to one."""
    frame = lake.staged(_delay_frame(spark, sf), "delay_frame")
    model = models.fit_classifier(frame, C.DELAY_FEATURES, algorithm="random_forest")
    found = models.importances(model, C.DELAY_FEATURES, spark)
    total = found.agg(F.sum("importance")).scalar()
    return found.select("feature", _between("importance").alias("in_range"), (F.abs(total - 1) < 1e-9).alias("sums_to_one"))


@query
def permutation_importance(spark, sf):
    """With a fixed linear score of two inputs: only those two can matter."""
    frame = lake.staged(_delay_frame(spark, sf), "delay_frame")
    variants = importance.permuted_variants(frame, KEYS, C.DELAY_FEATURES)
    scored = variants.withColumn("score", 0.01 * F.col("altitude_m") - F.col("speed_ms"))
    dropped = importance.metric_drop(metrics.auc(scored, "delay_risk", "score", ["variant"]), "auc")
    return dropped.select("feature", (F.abs("importance") > 1e-9).alias("matters"))


# ---- streaming


CUTS = ["2024-01-01", "2024-01-11", "2024-01-21", "2030-01-01"]


FILE_ROWS = 100_000


def _files(parts):
    """Files to write of each of the stored ``parts``: with this many rows at least in every file
    none is empty, so all parts have as many files and a stream takes one part a batch."""
    return max(1, min(part.count() for part in parts) // FILE_ROWS)


def _in_batches(spark, rows, name, at="event_timestamp"):
    """Rows staged as some files for each third of the month, in time order, so that a stream of
    the files of one third a batch takes three batches."""
    path = lake.fresh_path(spark, name)
    parts = _thirds(lake.staged(rows, f"{name}_rows"), at)
    files = _files(parts)
    for part in parts:
        part.repartition(files).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)


def _land_stream(spark, sf, name):
    """Silver as a stream of three batches."""
    return _in_batches(
        spark,
        telemetry.silver(spark, sf).select(
            "aircraft_id", "callsign", "origin_country", "event_timestamp", "latitude", "longitude",
            "baro_altitude", "on_ground", "velocity", "heading", "vertical_rate",
        ),
        name,
    )


def _land_json(spark, parts, path):
    """Bronze envelopes as some JSON files for each part, streamed one part a batch."""
    files = _files(parts)
    for part in parts:
        part.drop("event_id").repartition(files).write.mode("append").json(path)
    return bronze.stream_bronze(spark, path, files)


def _thirds(rows, at):
    cuts = [F.lit(c).cast("timestamp") for c in CUTS]
    return [rows.filter((F.col(at) >= low) & (F.col(at) < high)) for low, high in zip(cuts, cuts[1:])]


@query
def stream_silver(spark, sf):
    """Landed JSON -> silver as a stream over three batches."""
    root = lake.fresh_path(spark, "stream_silver")
    source = _land_json(spark, _thirds(telemetry.bronze(spark, sf), "ingest_timestamp"), f"{root}/bronze")
    ingest.write_silver_stream(ingest.silver_stream(source), f"{root}/silver", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/silver").select("aircraft_id", "event_timestamp", "year", "month", "day")


def _merged(spark, parts, name):
    root = lake.fresh_path(spark, name)
    merge = ingest.SilverMerge(f"{root}/silver")
    merge.start(_land_json(spark, parts, f"{root}/bronze"), f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(merge.path).select(*SILVER_COLUMNS)


@query
def stream_merge(spark, sf):
    """Landed JSON -> silver, each batch merged into the days it touches."""
    return _merged(spark, _thirds(telemetry.bronze(spark, sf), "ingest_timestamp"), "stream_merge")


@query
def stream_merge_batches(spark, sf):
    """Three polls of every state, the newest contact first: later batches must not replace it."""
    rows = telemetry.bronze(spark, sf)

    def poll(seconds):
        later = lambda s: s.withField("last_contact", s["last_contact"] + seconds)
        return rows.withColumn("states", F.transform("states", later))

    return _merged(spark, [poll(20), poll(0), poll(10)], "stream_merge_batches")


@query
def stream_dedup(spark, sf):
    """Every state three times, streamed in three batches: each (aircraft, time) once."""
    rows = telemetry.silver(spark, sf).select("aircraft_id", "event_timestamp")
    polls = rows.withColumn("poll", F.explode(F.array(*[F.lit(i) for i in range(3)])))
    root = lake.fresh_path(spark, "stream_dedup")
    once = ingest.dedup_stream(_in_batches(spark, polls, "polls"))
    ingest.write_stream(once, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out").select("aircraft_id", "event_timestamp")


@query
def stream_late_rows(spark, sf):
    """What a deduplicating stream records about itself: the last batch brings the first third
    again, all of it late."""
    silver = telemetry.silver(spark, sf).select("aircraft_id", "event_timestamp")
    path = lake.fresh_path(spark, "late")
    first, second, third = _thirds(silver, "event_timestamp")
    for part in (first, second, third, first):
        part.coalesce(1).write.mode("append").parquet(path)
    source = spark.readStream.schema(silver.schema).option("maxFilesPerTrigger", 1).parquet(path)
    root = lake.fresh_path(spark, "stream_late")
    counts = ingest.StreamCounts(spark)
    query = ingest.write_stream(ingest.dedup_stream(source), f"{root}/out", f"{root}/checkpoint")
    query.awaitTermination()
    jobs.record_stream(spark, query, counts, "stream_dedup", "run", f"{root}/metrics")
    counts.close()
    recorded = spark.read.parquet(f"{root}/metrics")
    return recorded.select("stage", "status", F.explode("metrics").alias("metric", "value"))


@query
def stream_congestion(spark, sf):
    root = lake.fresh_path(spark, "stream_congestion")
    counts = hourly_counts(_land_stream(spark, sf, "stream_in"), telemetry.hubs(spark, sf))
    ingest.write_stream(counts, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(counts.schema).parquet(f"{root}/out")


@query
def stream_tracks(spark, sf):
    root = lake.fresh_path(spark, "stream_tracks")
    tracks = TrackFeatures(root)
    tracks.start(_land_stream(spark, sf, "stream_in"), f"{root}/checkpoint").awaitTermination()
    return tracks.read(spark).select(
        "aircraft_id", "event_timestamp", "heading_change_5m", "avg_speed_15m", "distance_10m_km", "is_late"
    )


@query
def stream_latest(spark, sf):
    root = lake.fresh_path(spark, "stream_latest")
    table = LatestTable(views.FLIGHT_VIEW, root)
    running = table.start(_in_batches(spark, _flight_source(spark, sf), "features"), f"{root}/checkpoint")
    running.awaitTermination()
    return table.read(spark)
