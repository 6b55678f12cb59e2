"""Proxy labels and the frames models train on."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom import constants as C
from skyloom.operators.spatial import nearest_place
from skyloom.sources.lake import broadcast_within, fits, in_utc

# A century of hours; a larger lookup is joined by shuffle instead.
MAX_LOOKUP_HOURS = 1_000_000


@in_utc
def hourly_congestion(congestion: DataFrame) -> DataFrame:
    """Worst score over all airports per hour."""
    return congestion.groupBy(
        F.date_trunc("hour", "event_timestamp").alias("snapshot_hour")
    ).agg(F.max("congestion_score").alias("max_congestion_score"))


@in_utc
def delay_labels(flights: DataFrame, hourly: DataFrame) -> DataFrame:
    """``delay_risk`` is 1 for slow flight at height, or any flight in an hour whose worst
    airport is above the high mark. Hours without a score count as 0. ``hourly`` is counted
    first, so pass a stored or staged table."""
    joined = flights.withColumn("snapshot_hour", F.date_trunc("hour", "event_timestamp")).join(
        broadcast_within(hourly, MAX_LOOKUP_HOURS), "snapshot_hour", "left"
    )
    held = (F.col("altitude_m") > C.DELAY_ALTITUDE_M) & (F.col("speed_ms") < C.DELAY_SPEED_MS)
    crowded = F.col("max_congestion_score") > C.CONGESTION_HIGH
    return joined.withColumn(
        "max_congestion_score", F.coalesce("max_congestion_score", F.lit(0.0))
    ).select(
        *flights.columns,
        "snapshot_hour",
        "max_congestion_score",
        (F.coalesce(held, F.lit(False)) | crowded).cast("int").alias("delay_risk"),
    )


@in_utc
def with_nearest_congestion(flights: DataFrame, airports: DataFrame, congestion: DataFrame) -> DataFrame:
    """Adds the load of the nearest airport in range in the same hour, 0 when there is none:
    the two delay-model inputs that labels alone do not carry."""
    placed = nearest_place(flights, airports).withColumn(
        "snapshot_hour", F.date_trunc("hour", "event_timestamp")
    )
    load = congestion.select(
        F.col("airport_code").alias("_airport"),
        F.date_trunc("hour", "event_timestamp").alias("_hour"),
        "aircraft_count_50km",
        "congestion_score",
    )
    small = fits(load, MAX_LOOKUP_HOURS)
    airport = F.col("airport_code")
    if not small:
        # Flights far from any airport match nothing; keep them from meeting in one partition.
        spread = F.concat(F.lit("~"), F.pmod(F.xxhash64(*flights.columns), F.lit(4096)))
        airport = F.coalesce(airport, spread)
    joined = placed.withColumn("_key", airport).join(
        F.broadcast(load) if small else load,
        (F.col("_key") == F.col("_airport")) & (F.col("snapshot_hour") == F.col("_hour")),
        "left",
    )
    return joined.select(
        *flights.columns,
        "airport_code",
        "dist_km",
        F.coalesce("aircraft_count_50km", F.lit(0)).alias("aircraft_count_50km"),
        F.coalesce("congestion_score", F.lit(0.0)).alias("congestion_score"),
    )


def label_summary(labels: DataFrame) -> DataFrame:
    """Rows, positives and rate; the rate of an empty table is 0."""
    return labels.agg(
        F.count("*").alias("total_rows"),
        F.coalesce(F.sum("delay_risk"), F.lit(0)).cast("bigint").alias("delay_risk_count"),
        F.coalesce(F.avg("delay_risk"), F.lit(0.0)).alias("delay_risk_rate"),
    )


def training_frame(
    df: DataFrame,
    features: list[str],
    target: str | None = None,
    keep: list[str] | None = None,
    allow_missing: bool = False,
) -> DataFrame:
    """Features, target and key columns of complete rows. A feature that is not there is an
    error, or left out and reported by ``missing_features`` with ``allow_missing``."""
    missing = missing_features(df, features)
    if missing and not allow_missing:
        raise ValueError(f"missing features: {missing}")
    used = [c for c in features if c in df.columns]
    needed = used + ([target] if target else [])
    return df.select(*(keep or []), *needed).dropna(subset=needed)


def missing_features(df: DataFrame, features: list[str]) -> list[str]:
    return [c for c in features if c not in df.columns]


@in_utc
def congestion_training_columns(congestion: DataFrame) -> DataFrame:
    """Adds the clock features of the congestion model (0 = Monday)."""
    return congestion.withColumn("hour_of_day", F.hour("event_timestamp")).withColumn(
        "day_of_week", F.weekday("event_timestamp")
    )
