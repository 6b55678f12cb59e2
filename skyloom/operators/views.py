"""Feature views: declared columns, latest values, point-in-time lookups."""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyloom.operators.keyed import BUSY_ROWS, busy_keys, last_per_key
from skyloom.sources.lake import in_utc, read_table

FLOAT, DOUBLE, LONG, STRING = "float", "double", "bigint", "string"


@dataclass(frozen=True)
class FeatureView:
    """Typed columns of one entity, and how long a value stays valid."""

    name: str
    entity: str
    ttl_seconds: int
    fields: dict[str, str] = field(default_factory=dict)
    timestamp: str = "event_timestamp"
    created: str = "created_timestamp"
    folder: str = ""

    def read(self, spark, root: str) -> DataFrame:
        """The view's columns from its gold table under ``root``."""
        return self.select(read_table(spark, f"{root}/{self.folder or self.name}", self.name))

    def select(self, source: DataFrame) -> DataFrame:
        return source.select(
            F.col(self.entity),
            F.col(self.timestamp),
            *([F.col(self.created)] if self.created in source.columns else []),
            *[F.col(c).cast(kind).alias(c) for c, kind in self.fields.items()],
        )

    def order(self, rows: DataFrame) -> list[str]:
        """What makes one row newer than another."""
        return [c for c in (self.timestamp, self.created) if c in rows.columns]


# View fields, types and lifetimes.
FLIGHT_VIEW = FeatureView(
    "flight_state_features",
    "aircraft_id",
    2 * 3600,
    {
        "speed_ms": FLOAT,
        "altitude_m": FLOAT,
        "vertical_rate_ms": FLOAT,
        "heading_deg": FLOAT,
        "heading_change_5m": FLOAT,
        "avg_speed_15m": FLOAT,
        "distance_10m_km": FLOAT,
        "hour_of_day": LONG,
        "day_of_week": LONG,
        "is_on_ground": LONG,
        "latitude": DOUBLE,
        "longitude": DOUBLE,
        "callsign": STRING,
        "origin_country": STRING,
    },
    folder="flights",
)
AIRPORT_VIEW = FeatureView(
    "airport_congestion_features",
    "airport_code",
    3600,
    {
        "aircraft_count_50km": LONG,
        "arrivals_last_30m": LONG,
        "departures_last_30m": LONG,
        "avg_altitude_50km": FLOAT,
        "congestion_score": FLOAT,
        "airport_name": STRING,
    },
    folder="congestion",
)
ROUTE_VIEW = FeatureView(
    "route_features",
    "route_id",
    7 * 24 * 3600,
    {
        "route_density": LONG,
        "avg_cruise_speed": FLOAT,
        "historical_avg_delay_proxy": FLOAT,
        "unique_aircraft_count": LONG,
    },
    folder="routes",
)
VIEWS = [FLIGHT_VIEW, AIRPORT_VIEW, ROUTE_VIEW]


@in_utc
def materialise_latest(view: FeatureView, source: DataFrame, start, end) -> DataFrame:
    """Latest values per entity with event time in [start, end]. The interval reaches the
    parquet scan, and skips whole days of a table partitioned by ``event_date``."""
    low, high = (F.lit(t).cast("timestamp") for t in (start, end))
    inside = F.col(view.timestamp).between(low, high)
    if "event_date" in source.columns:
        inside &= F.col("event_date").between(F.to_date(low), F.to_date(high))
    rows = view.select(source.filter(inside))
    return last_per_key(rows, [view.entity], view.order(rows))


@in_utc
def as_of(
    view: FeatureView,
    spine: DataFrame,
    source: DataFrame,
    entity_time: str = "event_timestamp",
    busy_rows: int = BUSY_ROWS,
) -> DataFrame:
    """For every spine row (entity, time): the last features at or before that time and no
    older than the view's lifetime; nulls when there are none. The age limit is inclusive.
    Feature columns that the spine has too come out as ``feature_<name>``.

    Spine and features are put on one time line per entity, so one shuffle does. When an
    entity has too many rows for that, ``_as_of_sliced`` gives the same answer. Both sides
    are counted first, so pass stored or staged tables.
    """
    features = view.select(source).dropna(subset=[view.entity, view.timestamp])
    names = [c for c in features.columns if c != view.entity]
    order = view.order(features)
    found = F.struct(*order, *[c for c in names if c not in order])
    values = features.select(
        F.col(view.entity).alias("_entity"),
        F.col(view.timestamp).cast("timestamp").alias("_at"),
        found.alias("found"),
    )
    asked = spine.withColumns(
        {"_entity": F.col(view.entity), "_at": F.col(entity_time).cast("timestamp")}
    )
    calm = (
        busy_keys(values, "_entity", busy_rows) is None
        and busy_keys(asked, "_entity", busy_rows) is None
    )
    answered = (_as_of_window if calm else _as_of_sliced)(asked, values, view.ttl_seconds)
    taken = set(spine.columns)
    return answered.select(
        *spine.columns,
        *[F.col(f"found.{c}").alias(f"feature_{c}" if c in taken else c) for c in names],
    )


def _last_known(timeline: DataFrame, group: list[str], ttl_seconds: int) -> DataFrame:
    """The spine rows of ``timeline`` with the last value before or at their time."""
    # At equal times values come before questions, and the last created value last.
    until_now = (
        Window.partitionBy(*group)
        .orderBy("_at", F.col("_asks").cast("int"), "found")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    last = F.last(F.when(~F.col("_asks"), F.struct("_at", "found")), ignorenulls=True)
    age = F.unix_micros("_at") - F.unix_micros("_last._at")
    return (
        timeline.withColumn("_last", last.over(until_now))
        .filter("_asks")
        .withColumn("found", F.when(age <= ttl_seconds * 1_000_000, F.col("_last.found")))
        .drop("_last", "_asks")
    )


def _as_of_window(asked: DataFrame, values: DataFrame, ttl_seconds: int) -> DataFrame:
    timeline = asked.withColumn("_asks", F.lit(True)).unionByName(
        values.withColumn("_asks", F.lit(False)), allowMissingColumns=True
    )
    return _last_known(timeline, ["_entity"], ttl_seconds)


def _as_of_sliced(asked: DataFrame, values: DataFrame, ttl_seconds: int) -> DataFrame:
    """Per (entity, slice) with slices as long as the lifetime: a value can only come from its
    own slice or the one before, and of that only its last row is sent ahead. The windows see
    each distinct (entity, time) once, on both sides; answers are joined back on that pair,
    where adaptive execution can split a hot one."""
    number = F.floor(F.unix_micros("_at") / (ttl_seconds * 1_000_000))
    known = last_per_key(values, ["_entity", "_at"], ["found"]).withColumn("_slice", number)
    ahead = (
        known.groupBy("_entity", "_slice")
        .agg(F.max(F.struct("_at", "found")).alias("_v"))
        .select("_entity", "_v.*", (F.col("_slice") + 1).alias("_slice"))
    )
    times = asked.select("_entity", "_at").dropna().distinct().withColumn("_slice", number)
    timeline = (
        known.unionByName(ahead)
        .withColumn("_asks", F.lit(False))
        .unionByName(times.withColumn("_asks", F.lit(True)), allowMissingColumns=True)
    )
    answers = _last_known(timeline, ["_entity", "_slice"], ttl_seconds)
    complete = F.col("_entity").isNotNull() & F.col("_at").isNotNull()
    found = asked.filter(complete).join(
        answers.filter(F.col("found").isNotNull()).drop("_slice"), ["_entity", "_at"], "left"
    )
    # Rows without a key have no answer; joining them would gather them in one partition.
    return found.unionByName(asked.filter(~complete), allowMissingColumns=True)
