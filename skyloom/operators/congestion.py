"""Airport load per hour, from states within the airport radius."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom import constants as C
from skyloom.operators.spatial import within_radius
from skyloom.sources.lake import in_utc, read_table, staged

KEYS = ["airport_code", "airport_name", "event_timestamp"]


@in_utc
def airport_counts(
    silver: DataFrame, airports: DataFrame, radius_km: float = C.AIRPORT_RADIUS_KM, bucket: str = "hour"
) -> DataFrame:
    """Raw measures per airport and time bucket. The count is of position reports; how many
    different aircraft sent them stands beside it. ``arrivals_last_30m`` and its twin keep
    their published names but cover the whole bucket."""
    near = within_radius(
        silver.filter(F.col("event_timestamp").isNotNull()).select(
            "aircraft_id", "event_timestamp", "latitude", "longitude", "baro_altitude", "vertical_rate"
        ),
        airports,
        radius_km,
    )
    climb = F.col("vertical_rate")
    return (
        near.withColumn("event_timestamp", F.date_trunc(bucket, "event_timestamp"))
        .groupBy(*KEYS)
        .agg(
            F.count("*").alias("aircraft_count_50km"),
            F.count_if(climb < C.ARRIVAL_RATE).alias("arrivals_last_30m"),
            F.count_if(climb > C.DEPARTURE_RATE).alias("departures_last_30m"),
            F.avg("baro_altitude").alias("avg_altitude_50km"),
        )
    )


@in_utc
def unique_aircraft(
    silver: DataFrame, airports: DataFrame, radius_km: float = C.AIRPORT_RADIUS_KM
) -> DataFrame:
    """Different aircraft per airport and hour (several polls of one count once)."""
    near = within_radius(
        silver.filter(F.col("event_timestamp").isNotNull()).select(
            "aircraft_id", "event_timestamp", "latitude", "longitude"
        ),
        airports,
        radius_km,
    )
    return (
        near.withColumn("event_timestamp", F.date_trunc("hour", "event_timestamp"))
        .groupBy(*KEYS)
        .agg(F.countDistinct("aircraft_id").alias("unique_aircraft_50km"))
    )


def normalise(counts: DataFrame) -> DataFrame:
    """Score in (0, 1]: the count over the largest count seen. Empty in, empty out.
    ``counts`` is read twice, so pass a stored or staged table."""
    busiest = counts.agg(F.max("aircraft_count_50km").cast("double")).scalar()
    return counts.withColumn(
        "congestion_score", F.col("aircraft_count_50km").cast("double") / busiest
    )


def congestion_features(
    silver: DataFrame, airports: DataFrame, radius_km: float = C.AIRPORT_RADIUS_KM
) -> DataFrame:
    """The counts are staged (one row per airport and hour), so silver is scanned once."""
    return normalise(staged(airport_counts(silver, airports, radius_km), "airport_counts"))


def read_scored(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts of all days with their scores: over the largest count stored."""
    return normalise(read_table(spark, path, "congestion feature"))
