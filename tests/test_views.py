from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skyloom.operators.views import VIEWS, FeatureView, as_of, materialise_latest

T0 = datetime(2024, 1, 1, 12)
VIEW = FeatureView("v", "k", 3600, {"x": "float"})


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def features(spark, *rows):
    """(key, second, created second, value)"""
    data = [(k, at(s), at(c), v) for k, s, c, v in rows]
    return spark.createDataFrame(data, "k string, event_timestamp timestamp, created_timestamp timestamp, x double")


def spine(spark, *rows):
    return spark.createDataFrame([(k, at(s), i) for i, (k, s) in enumerate(rows)], "k string, event_timestamp timestamp, n int")


def look_up(spark, asked, known, busy_rows):
    out = as_of(VIEW, spine(spark, *asked), features(spark, *known), busy_rows=busy_rows)
    return [r.x for r in out.orderBy("n").collect()]


BOTH = pytest.mark.parametrize("busy_rows", [1_000_000, 0])


@BOTH
def test_as_of_edges(spark, busy_rows):
    known = [("a", 0, 0, 1.0), ("a", 100, 100, 2.0), ("b", 0, 0, 9.0)]
    asked = [("a", 0), ("a", 99), ("a", 100), ("a", 3700), ("a", 3701), ("a", -1), ("c", 5), ("b", 3600), ("b", 3601), (None, 5)]
    assert look_up(spark, asked, known, busy_rows) == [1.0, 1.0, 2.0, 2.0, None, None, None, 9.0, None, None]


@BOTH
def test_as_of_takes_the_last_created_and_keeps_copies(spark, busy_rows):
    known = [("a", 0, 50, 2.0), ("a", 0, 10, 1.0), ("a", 0, 20, 3.0)]
    assert look_up(spark, [("a", 7)] * 5, known, busy_rows) == [2.0] * 5


def test_as_of_forms_agree_with_brute_force(spark):
    known = [(f"k{i % 4}", i * 613 % 20_000, i, float(i)) for i in range(200)]
    asked = [(f"k{i % 5}", i * 389 % 25_000) for i in range(400)]
    want = []
    for k, t in asked:
        fits = [(s, c, v) for kk, s, c, v in known if kk == k and t - 3600 <= s <= t]
        want.append(max(fits)[2] if fits else None)
    assert look_up(spark, asked, known, 1_000_000) == want
    assert look_up(spark, asked, known, 0) == want


def test_as_of_marks_shared_names(spark):
    out = as_of(VIEW, spine(spark, ("a", 5)), features(spark, ("a", 0, 1, 1.0)))
    row = out.first()
    assert row.feature_event_timestamp == at(0) and row.created_timestamp == at(1)


def test_latest_interval_and_ties(spark):
    df = features(spark, ("a", 0, 0, 1.0), ("a", 10, 0, 2.0), ("a", 10, 5, 3.0), ("a", 99, 0, 4.0), ("b", -50, 0, 5.0))
    out = {r.k: r.x for r in materialise_latest(VIEW, df, at(0), at(10)).collect()}
    assert out == {"a": 3.0}


def test_interval_reaches_the_scan(spark, tmp_path):
    features(spark, ("a", 0, 0, 1.0)).write.parquet(str(tmp_path / "f"))
    plan = materialise_latest(VIEW, spark.read.parquet(str(tmp_path / "f")), at(0), at(1))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(event_timestamp" in plan


def test_declared_views(spark):
    assert [(v.name, v.entity, v.ttl_seconds, len(v.fields)) for v in VIEWS] == [
        ("flight_state_features", "aircraft_id", 7200, 14),
        ("airport_congestion_features", "airport_code", 3600, 6),
        ("route_features", "route_id", 604800, 4),
    ]
    out = VIEW.select(features(spark, ("a", 0, 0, 1.0)).withColumn("extra", F.lit(1)))
    assert out.dtypes == [("k", "string"), ("event_timestamp", "timestamp"), ("created_timestamp", "timestamp"), ("x", "float")]
