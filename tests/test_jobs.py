import dataclasses
import json
import os
from datetime import datetime

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from skyloom.operators import clean, congestion, quality, views
from skyloom.plans import jobs, retrain, telemetry
from skyloom.sources import bronze, lake, upserts
from skyloom.sources.schemas import SILVER_KEY, SILVER_ORDER, SILVER_PARTITIONS


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Bronze of the test tables and everything made from it."""
    root = str(tmp_path_factory.mktemp("lake"))
    bronze.land_bronze(telemetry.bronze(spark, SF_DIR), f"{root}/bronze")
    paths = jobs.refresh(spark, f"{root}/bronze", root, "run1", telemetry.hubs(spark, SF_DIR))
    return {**paths, "bronze": f"{root}/bronze", "root": root}


def test_silver_equals_the_plain_steps(spark, tables):
    got = spark.read.parquet(tables["silver"])
    want = telemetry.silver(spark, SF_DIR)
    assert got.select(*want.columns).exceptAll(want).count() == 0 == want.exceptAll(got.select(*want.columns)).count()


def test_rerun_changes_nothing(spark, tables):
    before = spark.read.parquet(tables["silver"]).count()
    record = jobs.bronze_to_silver(spark, tables["bronze"], tables["silver"], "run2")
    assert spark.read.parquet(tables["silver"]).count() == before == record["metrics"]["silver_rows"]
    assert record["metrics"]["rows_dropped"] == 1000 - before


def test_new_reports_merge_into_touched_days(spark, tables, tmp_path):
    path = str(tmp_path / "silver")
    silver = lake.staged(telemetry.silver(spark, SF_DIR), "silver")
    day = silver.filter("day = 10")
    merge = lambda new: lake.merge_partitioned(new, path, SILVER_PARTITIONS, SILVER_KEY, SILVER_ORDER)
    merge(silver)
    marked = day.limit(6).withColumn("velocity", F.lit(-1.0))
    later = F.pmod(F.xxhash64("aircraft_id", "event_timestamp"), F.lit(2)) * 2 - 1
    changed = lake.staged(marked.withColumn("last_contact", F.col("last_contact") + later), "changed")
    merge(changed)
    out = spark.read.parquet(path)
    newer = changed.join(silver.select(*SILVER_KEY, F.col("last_contact").alias("was")), SILVER_KEY).filter("last_contact > was")
    assert out.count() == silver.count() and out.filter("velocity = -1").count() == newer.count()


def test_a_merge_reads_only_the_days_it_touches(spark, tables):
    day = lake.staged(spark.read.parquet(tables["silver"]).filter("day = 10"), "one_day")
    days = lake.days_of(day, SILVER_PARTITIONS)
    old = lake.in_days(spark.read.schema(day.schema).parquet(tables["silver"]), SILVER_PARTITIONS, days)
    plan = old._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("\n")[0]
    assert len(days) == 1 and "= 10)" in filters
    assert files(old) and all("/day=10/" in f for f in files(old))


def files(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def test_jobs_under_another_zone_write_the_same(spark, tables, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        with lake.utc(spark):
            hubs = lake.staged(telemetry.hubs(spark, SF_DIR), "hubs")
        paths = jobs.refresh(spark, tables["bronze"], str(tmp_path), "run1", hubs)
        assert spark.conf.get("spark.sql.session.timeZone") == "America/Los_Angeles"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    for name in ("silver", "flights", "congestion", "routes", "labels"):
        got, want = (spark.read.parquet(p[name]).drop("created_timestamp") for p in (paths, tables))
        assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == want.count() > 0, name


def test_a_job_leaves_nothing_staged(spark, tables, tmp_path):
    root = lake.fresh_path(spark, "x").rsplit("/", 1)[0]
    before = set(os.listdir(root))
    jobs.congestion_job(spark, tables["silver"], str(tmp_path / "c"), "r", airports=telemetry.hubs(spark, SF_DIR))
    jobs.bronze_to_silver(spark, tables["bronze"], str(tmp_path / "s"), "r")
    assert set(os.listdir(root)) == before


def test_bronze_by_ingest_day(spark, tables, tmp_path):
    """Day by day gives the whole; only the folders of the days are read."""
    some = bronze.read_bronze(spark, tables["bronze"], first_day="2024-01-10", last_day="2024-01-11")
    assert {f.split("day=")[1][:2] for f in files(some)} <= {"10", "11"} and some.count() > 0
    path = str(tmp_path / "silver")
    for first, last in ((None, "2024-01-10"), ("2024-01-11", "2024-01-20"), ("2024-01-21", None)):
        jobs.bronze_to_silver(spark, tables["bronze"], path, "r", first_ingest_day=first, last_ingest_day=last)
    got, want = spark.read.parquet(path), spark.read.parquet(tables["silver"])
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == want.count()
    assert bronze.read_bronze(spark, tables["bronze"], first_day="2031-01-01").count() == 0


def test_corrected_fixes_reach_the_next_day(spark, tables, tmp_path):
    """Silver of a day changes; recomputing that day gives what computing all would."""
    silver, part, whole = str(tmp_path / "s"), str(tmp_path / "p"), str(tmp_path / "w")
    table = spark.read.parquet(tables["silver"])
    lake.write_partitioned(table, silver, SILVER_PARTITIONS)
    jobs.flights_job(spark, silver, part, "r")
    turned = table.filter("day = 12").withColumn("heading", F.col("heading") + 1)
    lake.write_partitioned(turned, silver, SILVER_PARTITIONS)
    last = table.select(F.max("event_date")).first()[0]
    jobs.flights_job(spark, silver, part, "r", first_day="2024-01-12", last_day=str(last))
    jobs.flights_job(spark, silver, whole, "r")
    got, want = (spark.read.parquet(p).drop("created_timestamp") for p in (part, whole))
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == want.count()


def test_a_range_reads_its_days_and_the_halo_only(spark, tables, tmp_path):
    path = str(tmp_path / "f")
    jobs.flights_job(spark, tables["silver"], path, "r", first_day="2024-01-12", last_day="2024-01-13")
    older = jobs.last_fixes(spark, tables["silver"], f"{path}_last_fixes", "2024-01-11")
    assert files(older) and all("before_day=2024-01-11" in f for f in files(older))
    forward = lake.read_days(spark, tables["silver"], "2024-01-11", "2024-01-12")
    assert {f.split("/day=")[1][:2] for f in files(forward)} == {"11", "12"}

def test_stages_are_recorded(spark, tables):
    recorded = {r.stage: r for r in spark.read.parquet(tables["run_metrics"]).collect()}
    assert {s: r.status for s, r in recorded.items()} == dict.fromkeys(
        ["bronze_to_silver", "flight_features", "airport_congestion_features", "route_features", "labels"], "success"
    )
    gold = spark.read.parquet(tables["flights"])
    assert gold.filter("event_date = '2024-01-10'").count() > 0
    assert recorded["flight_features"].metrics["rows_written"] == gold.count() > 0
    assert recorded["labels"].metrics["total_rows"] == gold.count()
    assert "created_timestamp" in gold.columns


def test_a_failed_gate_publishes_nothing_and_is_recorded(spark, tables, tmp_path):
    few = telemetry.bronze(spark, SF_DIR).limit(20)
    bronze.land_bronze(few, str(tmp_path / "bronze"))
    with pytest.raises(quality.QualityError):
        jobs.bronze_to_silver(spark, str(tmp_path / "bronze"), str(tmp_path / "silver"), "bad", str(tmp_path / "m"))
    assert not (tmp_path / "silver").exists()
    row = spark.read.parquet(str(tmp_path / "m")).first()
    assert row.status == "failed" and "fewer than 50" in row.error and row.metrics["states_read"] == 20


def test_ingest_gate(spark, tmp_path):
    vector = ["a", "C", "X", 1, 1, 1.0, 1.0]
    body = lambda n: json.dumps({"time": 1, "states": [vector] * n})
    raw = lambda n: spark.createDataFrame([(body(n), datetime(2024, 1, 1))], "value string, run_time timestamp")
    jobs.ingest(spark, raw(100), str(tmp_path / "b"), "ok")
    before = spark.read.json(str(tmp_path / "b")).count()
    with pytest.raises(quality.QualityError, match="99 states"):
        jobs.ingest(spark, raw(99), str(tmp_path / "b"), "few")
    assert spark.read.json(str(tmp_path / "b")).count() == before


def test_a_range_of_days_equals_the_whole(spark, tables, tmp_path):
    """Days replaced one range at a time end up as the whole table, long gaps included."""
    path = str(tmp_path / "f")
    jobs.flights_job(spark, tables["silver"], path, "r", last_day="2024-01-11")
    jobs.flights_job(spark, tables["silver"], path, "r", first_day="2024-01-12", last_day="2024-01-12")
    jobs.flights_job(spark, tables["silver"], path, "r", first_day="2024-01-12", last_day="2024-01-20")
    jobs.flights_job(spark, tables["silver"], path, "r", first_day="2024-01-21")
    parts = spark.read.parquet(path).drop("created_timestamp")
    whole = spark.read.parquet(tables["flights"]).drop("created_timestamp").select(*parts.columns)
    assert parts.count() == whole.count()
    assert parts.exceptAll(whole).count() == 0


def test_materialise_skips_days(spark, tables):
    latest = views.materialise_latest(views.FLIGHT_VIEW, spark.read.parquet(tables["flights"]), "2024-01-14 22:00:00", "2024-01-15 00:00:00")
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "PushedFilters: [IsNotNull(event_timestamp)" in plan


def test_partition_pruning(spark, tables):
    days = lake.read_days(spark, tables["silver"], "2024-01-12", None)
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "DataFilters: []" in plan and "PartitionFilters: [isnotnull(year" in plan
    assert min(r.day for r in days.select("day").distinct().collect()) == 12


def test_materialise_goes_on_after_a_failure(spark, tables, tmp_path):
    sources = {views.FLIGHT_VIEW.name: tables["flights"], views.ROUTE_VIEW.name: str(tmp_path / "none"), views.AIRPORT_VIEW.name: tables["congestion"]}
    record = jobs.materialise_job(spark, sources, str(tmp_path / "m"), "2024-01-01", "2024-02-01", "r", str(tmp_path / "rm"))
    assert set(record["metrics"]) == {"flight_state_features", "airport_congestion_features"}
    assert "no route_features files" in record["artifacts"]["route_features_error"]
    table = str(tmp_path / "m" / "flight_state_features")
    assert upserts.stored(spark, table).count() == record["metrics"]["flight_state_features"]
    assert spark.read.parquet(str(tmp_path / "rm")).first().status == "partial" == record["status"]
    keys = record["metrics"]["flight_state_features"]
    quiet = jobs.materialise_job(spark, sources, str(tmp_path / "m"), "2030-01-01", "2030-02-01", "r")
    assert quiet["metrics"]["flight_state_features"] == 0 and upserts.stored(spark, table).count() == keys
    assert jobs.materialise_job(spark, {views.ROUTE_VIEW.name: "none"}, str(tmp_path / "m"), "2024-01-01", "2024-02-01", "r")["status"] == "failed"


def test_retrain_and_decide(spark, tables, tmp_path):
    table = spark.read.parquet(tables["labels"])
    record, holdout = retrain.train(
        spark, retrain.DELAY, table, str(tmp_path / "delay"), "r", str(tmp_path / "m"), params={"maxIter": 3, "maxDepth": 3}
    )
    assert 0.5 < record["metrics"]["auc"] <= 1.0 and len(record["artifacts"]["top_features"].split(",")) == 5
    alone = retrain.decide(retrain.DELAY, holdout, str(tmp_path / "delay")).first()
    assert alone.champion_metric is None and alone.candidate_metric == pytest.approx(record["metrics"]["auc"])
    itself = retrain.decide(retrain.DELAY, holdout, str(tmp_path / "delay"), str(tmp_path / "delay")).first()
    assert not itself.promote and itself.champion_metric == itself.candidate_metric


def test_retrain_congestion(spark, tables, tmp_path):
    table = congestion.read_scored(spark, tables["congestion"])
    record, holdout = retrain.train(
        spark, retrain.CONGESTION, table, str(tmp_path / "c"), "r", params={"maxIter": 3, "maxDepth": 3}
    )
    assert record["metrics"]["r2"] > 0.4
    assert retrain.decide(retrain.CONGESTION, holdout, str(tmp_path / "c")).first().promote


def test_only_the_training_part_is_bounded(spark, tables):
    table = spark.read.parquet(tables["labels"])
    small = dataclasses.replace(retrain.DELAY, max_rows=120)
    whole, bounded = (lake.staged(retrain.prepare(t, table), "p") for t in (retrain.DELAY, small))
    assert bounded.filter("not is_test").count() == 120
    assert rows(bounded.filter("is_test")) == rows(whole.filter("is_test"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_tune(spark, tables):
    parts = retrain.prepare(retrain.DELAY, spark.read.parquet(tables["labels"]))
    algorithm, params, scores = retrain.tune(retrain.DELAY, parts, n_trials=1, effort=0.01)
    assert scores.count() == 1
    retrain.fit(retrain.DELAY, parts, algorithm, params)


def test_too_few_rows(spark, tables):
    with pytest.raises(lake.NotEnoughData, match="delay"):
        retrain.prepare(retrain.DELAY, spark.read.parquet(tables["labels"]).limit(100))


def test_train_anomaly(spark, tables, tmp_path):
    record, scores = retrain.train_anomaly(spark, spark.read.parquet(tables["flights"]), str(tmp_path / "a"), "r", trees=20)
    assert 0.03 <= record["metrics"]["anomaly_rate"] <= 0.07
    assert scores.columns == ["aircraft_id", "event_timestamp", "anomaly_score", "prediction", "is_anomaly"]


def test_shared_dir_is_the_configured_one(spark):
    assert lake.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_flattening_empty_batches(spark):
    empty = telemetry.bronze(spark, SF_DIR).limit(3).withColumn("states", F.expr("filter(states, s -> false)"))
    assert clean.explode_states(empty).count() == 0
