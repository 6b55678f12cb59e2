"""Route aggregates in one pass over silver."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom import constants as C
from skyloom.functions.flight import delay_proxy, route_id
from skyloom.sources.lake import in_utc, read_table


def on_route(silver: DataFrame) -> DataFrame:
    """Airborne states that carry a callsign, with their route."""
    return silver.filter(F.col("callsign").isNotNull() & ~F.col("on_ground")).withColumn(
        "route_id", route_id(F.col("callsign"))
    )


def route_features(silver: DataFrame, approximate: bool = False) -> DataFrame:
    """Density, cruise speed, delay proxy and fleet per route, stamped with the slice's last
    event time. A route never seen in cruise has a null cruise speed."""
    altitude, speed = F.col("baro_altitude"), F.col("velocity")
    fleet = F.approx_count_distinct if approximate else F.countDistinct
    return (
        on_route(silver)
        .groupBy("route_id")
        .agg(
            F.max("event_timestamp").alias("event_timestamp"),
            F.count("*").alias("route_density"),
            F.avg(F.when(altitude > C.CRUISE_ALTITUDE_M, speed)).alias("avg_cruise_speed"),
            F.avg(delay_proxy(altitude, speed)).alias("historical_avg_delay_proxy"),
            fleet("aircraft_id").alias("unique_aircraft_count"),
        )
    )


@in_utc
def route_days(silver: DataFrame) -> DataFrame:
    """What a day adds to each route: sums and counts, and the aircraft seen. The features of
    any set of days come from these alone."""
    altitude, speed = F.col("baro_altitude"), F.col("velocity")
    cruise = F.when(altitude > C.CRUISE_ALTITUDE_M, speed)
    return (
        on_route(silver)
        .withColumn("event_date", F.to_date("event_timestamp"))
        .groupBy("route_id", "event_date", "aircraft_id")
        .agg(
            F.max("event_timestamp").alias("event_timestamp"),
            F.count("*").alias("reports"),
            F.sum(cruise).alias("cruise_sum"),
            F.count(cruise).alias("cruise_count"),
            F.sum(delay_proxy(altitude, speed)).alias("delay_sum"),
        )
    )


def combined(days: DataFrame, approximate: bool = False) -> DataFrame:
    """``route_features`` from per-day parts."""
    fleet = F.approx_count_distinct if approximate else F.countDistinct
    return days.groupBy("route_id").agg(
        F.max("event_timestamp").alias("event_timestamp"),
        F.sum("reports").alias("route_density"),
        F.try_divide(F.sum("cruise_sum"), F.sum("cruise_count")).alias("avg_cruise_speed"),
        (F.sum("delay_sum") / F.sum("reports")).alias("historical_avg_delay_proxy"),
        fleet("aircraft_id").alias("unique_aircraft_count"),
    )


#: A theta sketch counts exactly up to 2**bits aircraft, more than fly one route.
SKETCH_BITS = 16


def day_sketches(days: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """One row a route and day from ``route_days``: sums, counts and a sketch of the fleet. Sketches
    merge, so any set of days is read from one small row each; a fleet of up to 2**bits is counted
    exactly, a larger one is off by about 1 / sqrt(2**bits) of it (0.4 %)."""
    return days.groupBy("route_id", "event_date").agg(
        F.max("event_timestamp").alias("event_timestamp"),
        *[F.sum(c).alias(c) for c in ("reports", "cruise_sum", "cruise_count", "delay_sum")],
        F.theta_sketch_agg(F.concat(F.lit("a"), "aircraft_id"), bits).alias("fleet"),  # empty text is skipped
    )


def combined_sketches(sketches: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """``route_features`` from ``day_sketches`` of any days."""
    return sketches.groupBy("route_id").agg(
        F.max("event_timestamp").alias("event_timestamp"),
        F.sum("reports").alias("route_density"),
        F.try_divide(F.sum("cruise_sum"), F.sum("cruise_count")).alias("avg_cruise_speed"),
        (F.sum("delay_sum") / F.sum("reports")).alias("historical_avg_delay_proxy"),
        F.theta_sketch_estimate(F.theta_union_agg("fleet", bits)).alias("unique_aircraft_count"),
    )


def read_sketched(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Routes over the stored days [first, last], the fleet counted by sketch: no aircraft are
    counted again. ``path`` is that of the exact table."""
    days = read_table(spark, f"{path}_sketches", "route sketch")
    if first:
        days = days.filter(F.col("event_date") >= F.lit(first).cast("date"))
    if last:
        days = days.filter(F.col("event_date") <= F.lit(last).cast("date"))
    return combined_sketches(days)


def read_combined(spark: SparkSession, path: str) -> DataFrame:
    return combined(read_table(spark, path, "route_features"))
