"""Bronze to silver: flatten, clean, deduplicate."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.constants import SILVER_BOUNDS, SILVER_NOT_NULL
from skyloom.operators.keyed import last_per_key
from skyloom.sources.lake import in_utc
from skyloom.sources.schemas import SILVER_COLUMNS, STATE_FIELDS, WHOLE_NUMBERS

RENAMED = {"icao24": "aircraft_id", "true_track": "heading"}
DROPPED = ["sensors", "spi"]


def explode_states(bronze: DataFrame) -> DataFrame:
    """One row per state vector; batches with no vectors vanish."""
    fields = []
    for name, kind in STATE_FIELDS:
        if name in DROPPED:
            continue
        value = F.col(f"s.{name}")
        if name in WHOLE_NUMBERS:
            value = value.try_cast(kind)
        fields.append(value.alias(RENAMED.get(name, name)))
    return bronze.select(
        F.col("fetch_timestamp").try_cast("bigint").alias("fetch_timestamp"),
        "ingest_timestamp",
        F.explode("states").alias("s"),
    ).select("fetch_timestamp", "ingest_timestamp", *fields)


def reject_reason() -> Column:
    """First rule a flattened state breaks; null for a good one. Only the required
    columns and the bounds count, and an unknown velocity breaks its bound."""
    reason = F.when(F.col("time_position").isNull(), "time_position missing")
    for name in SILVER_NOT_NULL:
        reason = reason.when(F.col(name).isNull(), f"{name} missing")
    for name, (low, high) in SILVER_BOUNDS.items():
        inside = F.col(name).between(low, high)
        reason = reason.when(F.coalesce(~inside, F.lit(True)), f"{name} out of range")
    return reason


def clean(states: DataFrame) -> DataFrame:
    good = states.filter(F.col("time_position").isNotNull()).dropna(subset=SILVER_NOT_NULL)
    for name, (low, high) in SILVER_BOUNDS.items():
        good = good.filter(F.col(name).between(low, high))
    return good


def quarantine(states: DataFrame) -> DataFrame:
    """The rows ``clean`` leaves out, each with its reason."""
    return states.withColumn("reject_reason", reject_reason()).filter(
        F.col("reject_reason").isNotNull()
    )


def dedup(states: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per (aircraft, position time): the latest contact."""
    return last_per_key(states, keys or ["aircraft_id", "time_position"], ["last_contact"])


@in_utc
def to_silver(states: DataFrame) -> DataFrame:
    """Event time, date and partition columns; no other columns than silver's."""
    at = F.col("event_timestamp")
    return (
        # a cast saturates where timestamp_seconds would fail the job on one absurd value
        states.withColumn("event_timestamp", F.col("time_position").cast("timestamp"))
        .withColumn("event_date", F.to_date(at))
        .withColumn("year", F.year(at))
        .withColumn("month", F.month(at))
        .withColumn("day", F.dayofmonth(at))
        .select(*SILVER_COLUMNS)
    )


def bronze_to_silver(bronze: DataFrame) -> DataFrame:
    return to_silver(dedup(clean(explode_states(bronze))))
