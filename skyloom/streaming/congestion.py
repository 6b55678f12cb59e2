"""Airport load per closed hour of a silver stream."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom import constants as C
from skyloom.operators.spatial import within_radius
from skyloom.sources.lake import in_utc
from skyloom.streaming.ingest import LATENESS


@in_utc
def hourly_counts(silver: DataFrame, airports: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """The counts of ``airport_counts``, each hour once it is closed. Scores need the maximum
    over all hours, so ``normalise`` is applied when the stored counts are read."""
    near = within_radius(silver.withWatermark("event_timestamp", lateness), airports)
    climb = F.col("vertical_rate")
    return (
        near.groupBy("airport_code", "airport_name", F.window("event_timestamp", "1 hour").alias("w"))
        .agg(
            F.count("*").alias("aircraft_count_50km"),
            F.count_if(climb < C.ARRIVAL_RATE).alias("arrivals_last_30m"),
            F.count_if(climb > C.DEPARTURE_RATE).alias("departures_last_30m"),
            F.avg("baro_altitude").alias("avg_altitude_50km"),
        )
        .select(
            "airport_code",
            "airport_name",
            F.col("w.start").alias("event_timestamp"),
            "aircraft_count_50km",
            "arrivals_last_30m",
            "departures_last_30m",
            "avg_altitude_50km",
        )
    )
