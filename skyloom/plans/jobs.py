"""Whole jobs: read, transform, check, write, and record what happened."""

import time
from contextlib import contextmanager, nullcontext
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skyloom import constants as C
from skyloom.operators import clean, congestion, flights, labels, quality, routes, views
from skyloom.operators.keyed import last_per_key
from skyloom.sources import bronze, lake
from skyloom.sources.schemas import SILVER_KEY, SILVER_ORDER, SILVER_PARTITIONS
from skyloom.sources.upserts import BUCKETS, BucketTable
from skyloom.streaming.ingest import StreamCounts

RUN_METRICS = (
    "stage string, run_id string, status string, started_at timestamp, seconds double, "
    "metrics map<string,double>, artifacts map<string,string>, error string"
)


@contextmanager
def stage(spark: SparkSession, name: str, run_id: str, metrics_path: str | None, keep_staged: bool = False):
    """Collects a stage's ``metrics`` and ``artifacts`` and appends one row about it, whether
    it succeeds or fails; a stage may set its own ``status``. Days are UTC inside, and what it
    staged is deleted at the end unless it gives a table back."""
    record = {"metrics": {}, "artifacts": {}, "status": "success"}
    started, clock = datetime.now(timezone.utc), time.monotonic()
    error = None
    try:
        with lake.utc(spark), nullcontext() if keep_staged else lake.scratch(spark):
            yield record
    except Exception as err:
        record["status"], error = "failed", str(err)
        raise
    finally:
        if metrics_path:
            row = (
                name, run_id, record["status"], started, round(time.monotonic() - clock, 3),
                {k: float(v) for k, v in record["metrics"].items() if v is not None},
                record["artifacts"], error,
            )
            spark.createDataFrame([row], RUN_METRICS).coalesce(1).write.mode("append").parquet(metrics_path)


def observed(df: DataFrame, name: str, *aggregates) -> tuple[DataFrame, Observation]:
    """Aggregates that are filled in by whatever action runs ``df``: no extra pass."""
    seen = Observation(name)
    return df.observe(seen, *aggregates), seen


def ingest(spark, raw: DataFrame, path: str, run_id: str, metrics_path: str | None = None, body: str = "value", run_time: str = "run_time") -> dict:
    """Raw responses -> landed bronze batches. The gate on the number of states of each looks
    at the staged batches, so a poll that fails it is not landed."""
    with stage(spark, "ingest", run_id, metrics_path) as record:
        batches = lake.staged(bronze.parse_batches(raw, body, run_time), "batches")
        found = batches.agg(
            F.count(F.lit(1)).alias("batches"),
            F.sum("aircraft_count").alias("states"),
            F.sum("dropped_count").alias("states_dropped"),
            F.min("aircraft_count").alias("smallest_batch"),
        ).first().asDict()
        record["metrics"].update(found)
        if found["smallest_batch"] is None or found["smallest_batch"] < C.MIN_STATES_PER_POLL:
            raise quality.QualityError(f"a poll has {found['smallest_batch']} states, fewer than {C.MIN_STATES_PER_POLL}")
        bronze.land_bronze(batches, path)
        record["artifacts"]["bronze"] = path
    return record


def bronze_to_silver(
    spark, bronze_path: str, silver_path: str, run_id: str, metrics_path: str | None = None,
    multi_line: bool = False, quarantine_path: str | None = None,
    first_ingest_day: str | None = None, last_ingest_day: str | None = None,
) -> dict:
    """Clean the batches landed on a range of ingest days (all, by default) and merge them into
    silver. One pass parses, counts and writes; the gates look at the counts before anything is
    published; rerunning changes nothing. Rejected rows go to ``quarantine_path``, if given, with
    the reason, by ``ingest_date``: the days of the range are replaced, others stay."""
    with stage(spark, "bronze_to_silver", run_id, metrics_path) as record:
        landed = bronze.read_bronze(spark, bronze_path, multi_line, first_ingest_day, last_ingest_day)
        raw = clean.explode_states(landed)
        if quarantine_path:  # both outputs come from one parse
            raw = lake.staged(raw, "states")
        states = raw
        raw, seen_raw = observed(states, f"raw_{run_id}", F.count(F.lit(1)).alias("states_read"))
        silver, seen = observed(
            clean.to_silver(clean.dedup(clean.clean(raw))),
            f"silver_{run_id}",
            *quality.silver_gate_metrics(),
        )
        new = lake.staged(silver, "silver")
        found = {**seen_raw.get, **seen.get}
        record["metrics"].update(found, rows_dropped=found["states_read"] - found["silver_rows"])
        quality.check_silver(new.columns, found)
        lake.merge_partitioned(new, silver_path, SILVER_PARTITIONS, SILVER_KEY, SILVER_ORDER)
        record["artifacts"]["silver"] = silver_path
        if quarantine_path:
            rejected = clean.quarantine(states).withColumn("ingest_date", F.to_date("ingest_timestamp"))
            lake.replace_days(rejected, quarantine_path, "ingest_date", first_ingest_day, last_ingest_day)
            record["artifacts"]["quarantine"] = quarantine_path
    return record


def _gold_days(spark, name, run_id, metrics_path, path, build, first_day, last_day) -> dict:
    """Writes a table by ``event_date``: only the days of the range are replaced, and those that
    came out empty are dropped."""
    with stage(spark, name, run_id, metrics_path) as record:
        table = build().withColumn("created_timestamp", F.current_timestamp())
        table, seen = observed(table, f"{name}_{run_id}", F.count(F.lit(1)).alias("rows_written"))
        lake.replace_days(table, path, "event_date", first_day, last_day)
        record["metrics"].update(seen.get)
        record["artifacts"]["path"] = path
    return record


def _day(text: str, days: int) -> str:
    return str(date.fromisoformat(text) + timedelta(days))


def last_fixes(spark, silver_path: str, path: str, before: str) -> DataFrame:
    """The last fix of each aircraft before the day ``before``, from the table of last fixes
    kept under ``path`` by day. The newest version that is old enough is brought forward over
    the days since, so that only these are read; the first time, all of silver is."""
    known = [d for d in lake.partition_values(spark, path, "before_day") if d <= before]
    start = max(known, default=None)
    if start == before:
        return spark.read.parquet(f"{path}/before_day={before}")
    fixes = flights.airborne(lake.read_days(spark, silver_path, start, _day(before, -1)))
    if start:
        fixes = fixes.unionByName(spark.read.schema(fixes.schema).parquet(f"{path}/before_day={start}"))
    last = last_per_key(fixes, ["aircraft_id"], ["event_timestamp"])
    last.write.mode("overwrite").parquet(f"{path}/before_day={before}")
    return spark.read.schema(fixes.schema).parquet(f"{path}/before_day={before}")


def flights_job(spark, silver_path, path, run_id, metrics_path=None, first_day=None, last_day=None) -> dict:
    """Flight features by day, for the whole of silver or a range of days; only the days
    computed are replaced. A range reads its days, the day before for the rolling window, the
    last fixes before that (a table beside the result, ``<path>_last_fixes``) and the day
    after, whose first fixes look back at a range that may have been corrected. Versions of the
    last fixes after the range are dropped, as they may stem from what was corrected."""
    with stage(spark, "flight_features", run_id, metrics_path) as record:
        if first_day:
            fixes_path = f"{path}_last_fixes"
            for day in lake.partition_values(spark, fixes_path, "before_day"):
                if day > first_day:
                    lake.remove(spark, f"{fixes_path}/before_day={day}")
            older = last_fixes(spark, silver_path, fixes_path, _day(first_day, -1))
            until = _day(last_day, 1) if last_day else None
            recent = flights.airborne(lake.read_days(spark, silver_path, _day(first_day, -1), until))
            rows = lake.staged(recent.unionByName(older.select(*recent.columns)), "range_fixes")
            gold = flights.flight_features(rows).filter(
                F.col("event_timestamp") >= F.lit(first_day).cast("timestamp")
            )
        else:
            gold = flights.flight_features(lake.read_days(spark, silver_path, None, last_day))
            first_day = None
        gold, seen = observed(
            gold.withColumn("created_timestamp", F.current_timestamp()).withColumn(
                "event_date", F.to_date("event_timestamp")
            ),
            f"flight_features_{run_id}",
            F.count(F.lit(1)).alias("rows_written"),
        )
        lake.replace_days(gold, path, "event_date", first_day, _day(last_day, 1) if first_day and last_day else None)
        record["metrics"].update(seen.get)
        record["artifacts"]["path"] = path
    return record


def congestion_job(spark, silver_path, path, run_id, metrics_path=None, airports=None, first_day=None, last_day=None) -> dict:
    """Airport counts of a range of days. Scores need the busiest hour of all days stored, so
    ``congestion.read_scored`` adds them when the table is read."""

    def build():
        places = lake.airports(spark) if airports is None else airports
        counts = congestion.airport_counts(lake.read_days(spark, silver_path, first_day, last_day), places)
        return counts.withColumn("event_date", F.to_date("event_timestamp"))

    return _gold_days(spark, "airport_congestion_features", run_id, metrics_path, path, build, first_day, last_day)


def routes_job(spark, silver_path, path, run_id, metrics_path=None, first_day=None, last_day=None) -> dict:
    """Partial route aggregates of a range of days; ``routes.read_combined`` combines all days
    stored when the table is read. ``<path>_sketches`` has one row a route and day, from which
    ``routes.read_sketched`` reads any range of days."""

    def build():
        return routes.route_days(lake.read_days(spark, silver_path, first_day, last_day))

    record = _gold_days(spark, "route_features", run_id, metrics_path, path, build, first_day, last_day)

    def sketch():
        days = lake.read_table(spark, path, "route_features").drop("created_timestamp")
        if first_day:
            days = days.filter(F.col("event_date") >= F.lit(first_day).cast("date"))
        if last_day:
            days = days.filter(F.col("event_date") <= F.lit(last_day).cast("date"))
        return routes.day_sketches(days)

    _gold_days(spark, "route_sketches", run_id, None, f"{path}_sketches", sketch, first_day, last_day)
    return record


def moved_days(spark, load: DataFrame, path: str) -> set[str]:
    """Days on which an airport's load is not what the table at ``path`` says it was."""
    old = spark.read.schema(load.schema).parquet(path)
    changed = load.exceptAll(old).unionByName(old.exceptAll(load))
    days = changed.select(F.to_date("event_timestamp").cast("string").alias("day")).distinct().limit(lake.MAX_DAYS).collect()
    return {r.day for r in days}


def labels_job(
    spark, flights_path, congestion_path, path, run_id, metrics_path=None, airports=None, first_day=None, last_day=None
) -> dict:
    """Labelled flights by ``event_date``, with the load of the nearest airport as further model
    inputs. A range names the days whose flights were made anew; besides these only the days are
    rebuilt on which an airport's load has moved since the last run (``<path>_load`` keeps it), and
    no other day's flights are read. A new largest count moves the load of every day."""
    with stage(spark, "labels", run_id, metrics_path) as record:
        scored = congestion.read_scored(spark, congestion_path).drop("created_timestamp", "event_date")
        load = lake.staged(scored, "load")
        places = lake.airports(spark) if airports is None else airports
        gold = lake.read_table(spark, flights_path, "flight feature").drop("created_timestamp")
        known = set(lake.partition_values(spark, flights_path, "event_date"))
        days = known
        if first_day and lake.exists(spark, f"{path}_load"):
            last = _day(last_day, 1) if last_day else "9999"
            before = set(lake.partition_values(spark, path, "event_date"))
            asked = {d for d in known | before if first_day <= d <= last}
            days = asked | moved_days(spark, load, f"{path}_load") | (known ^ before)
            gold = gold.filter(F.col("event_date").cast("string").isin(sorted(days & known)))
        hourly = lake.staged(labels.hourly_congestion(load), "hourly")
        labelled = labels.delay_labels(labels.with_nearest_congestion(gold.drop("event_date"), places, load), hourly)
        labelled, seen = observed(
            labelled.withColumn("event_date", F.to_date("event_timestamp")),
            f"labels_{run_id}",
            F.count(F.lit(1)).alias("total_rows"),
            F.sum("delay_risk").alias("delay_risk_count"),
            F.avg("delay_risk").alias("delay_risk_rate"),
        )
        lake.write_partitioned(labelled, path, ["event_date"])
        for day in set(lake.partition_values(spark, path, "event_date")) - known:
            lake.remove(spark, f"{path}/event_date={day}")
        lake.write_table(load, f"{path}_load")
        record["metrics"].update(seen.get, days_built=len(days & known))
        record["artifacts"]["path"] = path
    return record


def record_stream(spark, query, counts: StreamCounts, name: str, run_id: str, metrics_path: str) -> dict:
    """Record what a finished or running streaming query took in and dropped as late, over all
    its batches. ``counts`` was attached before the query started."""
    with stage(spark, name, run_id, metrics_path) as record:
        run = counts.settled(query)
        record["metrics"].update(rows_read=counts.rows[run], late_rows=counts.late[run])
        if query.exception():
            raise query.exception()
    return record


READERS = {
    views.AIRPORT_VIEW.name: congestion.read_scored,
    views.ROUTE_VIEW.name: routes.read_combined,
}


def materialise_job(spark, sources: dict[str, str], root: str, start, end, run_id, metrics_path=None, buckets: int = BUCKETS) -> dict:
    """Latest values of every view whose source path is given: those of the interval upserted
    into those stored, so a key not seen in the interval keeps its values and its bucket its
    files. ``upserts.stored`` reads a view. The metrics are the keys of the interval. A view that
    fails does not stop the others; the run is then ``partial``, or ``failed`` if none was written."""
    with stage(spark, "materialise", run_id, metrics_path) as record:
        for view in views.VIEWS:
            if view.name not in sources:
                continue
            try:
                reader = READERS.get(view.name, lambda spark, path: lake.read_table(spark, path, view.name))
                table = views.materialise_latest(view, reader(spark, sources[view.name]), start, end)
                table = lake.staged(table, view.name)
                target = BucketTable(spark, f"{root}/{view.name}", [view.entity], view.order(table), buckets)
                target.upsert(table)
                record["metrics"][view.name] = table.count()
            except Exception as err:
                record["artifacts"][f"{view.name}_error"] = str(err)
        failed = sum(name.endswith("_error") for name in record["artifacts"])
        if failed:
            record["status"] = "partial" if record["metrics"] else "failed"
    return record


def refresh(spark, bronze_path: str, root: str, run_id: str, airports: DataFrame | None = None) -> dict[str, str]:
    """Bronze to every gold table under ``root``; gives the tables' paths."""
    metrics_path = f"{root}/run_metrics"
    paths = {name: f"{root}/{name}" for name in ("silver", "flights", "congestion", "routes", "labels")}
    bronze_to_silver(spark, bronze_path, paths["silver"], run_id, metrics_path)
    flights_job(spark, paths["silver"], paths["flights"], run_id, metrics_path)
    congestion_job(spark, paths["silver"], paths["congestion"], run_id, metrics_path, airports)
    routes_job(spark, paths["silver"], paths["routes"], run_id, metrics_path)
    labels_job(spark, paths["flights"], paths["congestion"], paths["labels"], run_id, metrics_path, airports)
    return {**paths, "run_metrics": metrics_path}
