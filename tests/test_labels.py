from datetime import datetime

import pytest
from pyspark.sql import functions as F

from skyloom.operators import labels

H = datetime(2024, 1, 1, 5)


def flights(spark, *rows):
    data = [("a", H.replace(minute=i), alt, speed) for i, (alt, speed) in enumerate(rows)]
    return spark.createDataFrame(data, "aircraft_id string, event_timestamp timestamp, altitude_m double, speed_ms double")


def hourly(spark, score=None):
    rows = [] if score is None else [(H, score)]
    return spark.createDataFrame(rows, "snapshot_hour timestamp, max_congestion_score double")


@pytest.mark.parametrize(
    "score, want",
    [(None, [0, 0, 1, 0, 0]), (0.70, [0, 0, 1, 0, 0]), (0.71, [1, 1, 1, 1, 1])],
)
def test_strict_thresholds_and_missing_hours(spark, score, want):
    rows = flights(spark, (3000.0, 50.0), (5000.0, 100.0), (3000.1, 99.9), (None, 50.0), (5000.0, None))
    out = labels.delay_labels(rows, hourly(spark, score)).orderBy("event_timestamp").collect()
    assert [r.delay_risk for r in out] == want
    assert {r.max_congestion_score for r in out} == {score or 0.0}


def test_hourly_maximum(spark):
    rows = [("A", H, 0.2), ("B", H.replace(minute=30), 0.9), ("A", H.replace(hour=6), 0.1)]
    out = labels.hourly_congestion(spark.createDataFrame(rows, "airport_code string, event_timestamp timestamp, congestion_score double"))
    assert {(r.snapshot_hour.hour, r.max_congestion_score) for r in out.collect()} == {(5, 0.9), (6, 0.1)}


def test_summary_of_nothing(spark):
    empty = spark.createDataFrame([], "delay_risk int")
    assert tuple(labels.label_summary(empty).first()) == (0, 0, 0.0)


def test_missing_features_are_an_error(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (1.0, 2.0, 3.0)], "a double, y double, b double")
    with pytest.raises(ValueError, match="zz"):
        labels.training_frame(df, ["a", "zz"], "y")
    assert labels.training_frame(df, ["a", "zz"], "y", allow_missing=True).columns == ["a", "y"]
    assert labels.training_frame(df, ["a", "b"], "y").count() == 1


def test_clock_features_start_on_monday(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 7),)], "event_timestamp timestamp")
    row = labels.congestion_training_columns(df).first()
    assert (row.hour_of_day, row.day_of_week) == (7, 0)


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_nearest_load_by_broadcast_and_by_shuffle(spark, monkeypatch, limit):
    monkeypatch.setattr(labels, "MAX_LOOKUP_HOURS", limit)
    rows = [("a", H, 10.0, 10.1), ("b", H, 50.0, 50.0), ("c", H.replace(hour=9), 10.0, 10.0), ("d", H, None, None)]
    fixes = spark.createDataFrame(rows, "aircraft_id string, event_timestamp timestamp, latitude double, longitude double")
    places = spark.createDataFrame([("A", 10.0, 10.0)], "airport_code string, airport_lat double, airport_lon double")
    load = spark.createDataFrame([("A", H, 7, 0.5)], "airport_code string, event_timestamp timestamp, aircraft_count_50km bigint, congestion_score double")
    out = labels.with_nearest_congestion(fixes, places, load).orderBy("aircraft_id").collect()
    assert [(r.airport_code, r.aircraft_count_50km, r.congestion_score) for r in out] == [
        ("A", 7, 0.5), (None, 0, 0.0), ("A", 0, 0.0), (None, 0, 0.0),
    ]
