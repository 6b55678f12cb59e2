"""The test tables as aircraft telemetry.

``events`` rows become state vectors and ``nation`` rows become hubs, by whole-number
arithmetic that gives the same values in any SQL engine. Some fields are null or out of
bounds so that every cleaning rule has work.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.operators.clean import RENAMED, DROPPED, clean, dedup, to_silver
from skyloom.sources.schemas import STATE_NAMES

# {epoch} stands for the engine's own "whole seconds of ts".
STATE_SQL = {
    "icao24": "case when event_id % 101 = 0 then null else cast(user_id as string) end",
    "callsign": "case when event_id % 61 = 0 then null else concat(upper(substring(event_type, 1, 3)), "
    "cast(user_id % 40 as string), '0', cast(event_id % 3 as string)) end",
    "origin_country": "concat('C', cast(user_id % 12 as string))",
    "time_position": "case when event_id % 103 = 0 then null else {epoch} end",
    "last_contact": "{epoch} + event_id % 7",
    "longitude": "case when event_id % 97 = 0 then null "
    "else cast(-17000 + 1300 * (user_id % 25) + event_id * 53 % 101 - 50 as double) / 100 end",
    "latitude": "cast(-6000 + 500 * (user_id % 25) + event_id * 37 % 101 - 50 as double) / 100",
    "baro_altitude": "case when event_id % 89 = 0 then null else cast(event_id * 7919 % 16400 - 700 as double) end",
    "on_ground": "event_type = 'signup'",
    # quarters: their sums are exact, so averages do not depend on the order of rows
    "velocity": "case when event_id % 83 = 0 then null else cast(floor(value * 4) as double) / 4 end",
    "true_track": "cast(event_id * 17 % 360 as double)",
    "vertical_rate": "case when event_id % 71 = 0 then null else cast(event_id % 21 - 10 as double) end",
    "sensors": "case when event_id % 2 = 0 then null else concat('[', cast(event_id % 9 as string), ']') end",
    "geo_altitude": "cast(event_id * 7919 % 16400 - 650 as double)",
    "squawk": "cast(event_id * 13 % 7777 as string)",
    "spi": "event_id % 50 = 0",
    "position_source": "cast(event_id % 4 as int)",
}
HUB_SQL = {
    "airport_code": "n_name",
    "airport_name": "concat('Hub ', n_name)",
    "airport_lat": "cast(-60 as double) + 5 * n_nationkey",
    "airport_lon": "cast(-170 as double) + 13 * n_nationkey",
}
SPARK_EPOCH = "unix_timestamp(cast(ts as timestamp))"
OTHER_EPOCH = "cast(floor(epoch(ts)) as bigint)"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times carry no zone; callers read them inside ``lake.utc``."""
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def as_states(rows: DataFrame, keep: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """State vectors under their raw names."""
    return rows.selectExpr(
        *keep, *[f"{STATE_SQL[n].format(epoch=SPARK_EPOCH)} as {n}" for n in STATE_NAMES]
    )


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_states(events(spark, sf_dir))


def flat_states(raw: DataFrame) -> DataFrame:
    """States as they stand after flattening."""
    return raw.drop(*DROPPED).withColumnsRenamed(RENAMED)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(dedup(clean(flat_states(states(spark, sf_dir)).drop("event_id"))))


def hubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/nation.parquet").selectExpr(
        *[f"{sql} as {name}" for name, sql in HUB_SQL.items()]
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One envelope per event, with its state vector."""
    rows = as_states(events(spark, sf_dir), ("event_id", "cast(ts as timestamp) as ingest_timestamp"))
    state = F.struct(*[F.col(n).cast("double").alias(n) if n in ("time_position", "last_contact", "position_source") else F.col(n) for n in STATE_NAMES])
    return rows.select(
        "event_id",
        F.col("last_contact").cast("double").alias("fetch_timestamp"),
        "ingest_timestamp",
        F.lit(1).alias("aircraft_count"),
        F.array(state).alias("states"),
    )


def raw_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Response bodies as the feed sends them: per event a full vector, a null one and one of
    seven values, with padded callsigns."""
    rows = as_states(events(spark, sf_dir), ("event_id", "ts"))

    def text(name, kind="plain"):
        value = F.col(name).cast("string")
        if kind == "quoted":
            value = F.concat(F.lit('"'), value, F.lit('"'))
        elif kind == "padded":
            value = F.concat(F.lit('"  '), value, F.lit('   "'))
        return F.coalesce(value, F.lit("null"))

    kinds = {"icao24": "quoted", "callsign": "padded", "origin_country": "quoted", "squawk": "quoted"}
    parts = [text(n, kinds.get(n, "plain")) for n in STATE_NAMES]
    body = F.concat(
        F.lit('{"time": '), F.col("last_contact").cast("string"), F.lit(', "states": [['),
        F.concat_ws(", ", *parts), F.lit("], null, ["), F.concat_ws(", ", *parts[:7]), F.lit("]]}"),
    )
    return rows.select("event_id", F.col("ts").cast("timestamp").alias("run_time"), body.alias("value"))
