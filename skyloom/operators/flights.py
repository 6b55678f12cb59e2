"""Per-aircraft window features over silver.

Silver holds one row per aircraft and second. Most aircraft are one window group each. A
busy one (more rows than a task should sort) is cut into time slices, each a group of its
own: at most one row per second of the slice, plus the last ROLLING_SECONDS of the slice
before. What a slice needs from earlier is sent along as halo rows in the same shuffle: the
rows within the rolling range of its start, or, across a longer gap, the last fix of the
previous non-empty slice.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyloom import constants as C
from skyloom.functions.flight import day_of_week, heading_change
from skyloom.functions.geo import haversine_km
from skyloom.operators.keyed import BUSY_ROWS, busy_keys
from skyloom.sources.lake import broadcast_within, in_utc

SLICE_SECONDS = 6 * 3600
MAX_BUSY = 1_000_000
CARRIED = ["heading", "latitude", "longitude", "velocity"]


def airborne(silver: DataFrame) -> DataFrame:
    """In flight with speed, heading and altitude known; key and time present."""
    return silver.filter(~F.col("on_ground")).dropna(
        subset=["velocity", "heading", "baro_altitude", "aircraft_id", "event_timestamp"]
    )


def sliced(
    fixes: DataFrame,
    busy: DataFrame,
    slice_seconds: int = SLICE_SECONDS,
    reach: int = C.ROLLING_SECONDS,
) -> DataFrame:
    """``fixes`` with column ``second`` plus ``slice`` and, for the slices of the ``busy``
    aircraft, halo rows (``is_halo``). Other aircraft are one slice."""
    if slice_seconds < reach:
        raise ValueError("a slice must be at least as long as the rolling range")
    listed = broadcast_within(busy.select("aircraft_id", F.lit(True).alias("is_busy")), MAX_BUSY)
    number = F.floor(F.col("second") / slice_seconds)
    slice_end = (F.col("slice") + 1) * slice_seconds
    in_reach = F.col("second") >= slice_end - reach
    marked = (
        fixes.join(listed, "aircraft_id", "left")
        .withColumn("is_busy", F.coalesce("is_busy", F.lit(False)))
        .withColumn("slice", F.when(F.col("is_busy"), number).otherwise(F.lit(0)))
    )
    own = F.struct(F.col("slice").alias("slice"), F.lit(False).alias("is_halo"))
    ahead = F.struct((F.col("slice") + 1).alias("slice"), F.lit(True).alias("is_halo"))
    homes = F.when(F.col("is_busy") & in_reach, F.array(own, ahead)).otherwise(F.array(own))
    rows = marked.withColumn("home", F.explode(homes)).select(*fixes.columns, "home.*")
    # One ordering for all of them, so the values come from one row.
    per_slice = (
        marked.filter("is_busy")
        .groupBy("aircraft_id", "slice")
        .agg(F.max("second").alias("second"), *[F.max_by(c, "second").alias(c) for c in CARRIED])
    )
    by_slice = Window.partitionBy("aircraft_id").orderBy("slice")
    next_door = F.col("next_slice") == F.col("slice") + 1
    carried = (
        per_slice.withColumn("next_slice", F.lead("slice").over(by_slice))
        .filter(F.col("next_slice").isNotNull() & ~(next_door & in_reach))
        .select(
            "aircraft_id",
            "second",
            *CARRIED,
            F.col("next_slice").alias("slice"),
            F.lit(True).alias("is_halo"),
        )
    )
    return rows.unionByName(carried, allowMissingColumns=True)


def windowed(
    fixes: DataFrame,
    slice_seconds: int = SLICE_SECONDS,
    rolling_seconds: int = C.ROLLING_SECONDS,
    busy_rows: int = BUSY_ROWS,
) -> DataFrame:
    """Adds the previous heading and position and the rolling mean speed (both ends of the
    range included). One shuffle and one sort serve all of them. Counts the rows per aircraft
    first, so pass a stored or staged table."""
    timed = fixes.withColumn("second", F.col("event_timestamp").cast("bigint"))
    busy = busy_keys(fixes, "aircraft_id", busy_rows)
    if busy is None:
        rows, group = timed, ["aircraft_id"]
    else:
        rows, group = sliced(timed, busy, slice_seconds, rolling_seconds), ["aircraft_id", "slice"]
    by_time = Window.partitionBy(*group).orderBy("second")
    recent = by_time.rangeBetween(-rolling_seconds, 0)
    features = (
        rows.withColumn("prev_heading", F.lag("heading").over(by_time))
        .withColumn("prev_lat", F.lag("latitude").over(by_time))
        .withColumn("prev_lon", F.lag("longitude").over(by_time))
        .withColumn("avg_speed_15m", F.avg("velocity").over(recent))
    )
    if len(group) > 1:
        features = features.filter(~F.col("is_halo")).drop("slice", "is_halo")
    return features.drop("second")


@in_utc
def describe_fixes(
    fixes: DataFrame, wrap_heading: bool = True, monday_first: bool = True, keep: list[str] | None = None
) -> DataFrame:
    """Gold flight columns from windowed fixes, and those to ``keep``."""
    moved = haversine_km(
        F.col("latitude"), F.col("longitude"), F.col("prev_lat"), F.col("prev_lon")
    )
    at = F.col("event_timestamp")
    return fixes.select(
        "aircraft_id",
        "callsign",
        "origin_country",
        "event_timestamp",
        "latitude",
        "longitude",
        F.col("velocity").alias("speed_ms"),
        F.col("baro_altitude").alias("altitude_m"),
        F.col("vertical_rate").alias("vertical_rate_ms"),
        F.col("heading").alias("heading_deg"),
        heading_change(F.col("prev_heading"), F.col("heading"), wrap_heading).alias("heading_change_5m"),
        "avg_speed_15m",
        F.coalesce(moved, F.lit(0.0)).alias("distance_10m_km"),
        F.hour(at).alias("hour_of_day"),
        day_of_week(at, monday_first).alias("day_of_week"),
        F.col("on_ground").cast("int").alias("is_on_ground"),
        *(keep or []),
    )


def flight_features(
    silver: DataFrame,
    slice_seconds: int = SLICE_SECONDS,
    wrap_heading: bool = True,
    monday_first: bool = True,
    busy_rows: int = BUSY_ROWS,
) -> DataFrame:
    fixes = windowed(airborne(silver), slice_seconds, busy_rows=busy_rows)
    return describe_fixes(fixes, wrap_heading, monday_first)
