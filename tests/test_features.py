"""Congestion, routes, scalar functions."""

import pytest
from pyspark.sql import functions as F

from skyloom.functions import flight as fx
from skyloom.operators import congestion, routes

SILVER = (
    "aircraft_id string, callsign string, t bigint, latitude double, longitude double, baro_altitude double, "
    "on_ground boolean, velocity double, vertical_rate double"
)


def silver(spark, rows):
    return spark.createDataFrame(rows, SILVER).withColumn("event_timestamp", F.timestamp_seconds("t")).drop("t")


def places(spark):
    return spark.createDataFrame(
        [("A", "Alpha", 0.0, 0.0), ("B", "Beta", 30.0, 30.0)],
        "airport_code string, airport_name string, airport_lat double, airport_lon double",
    )


def test_counts_strict_limits_and_score(spark):
    near = [("x", "C", 10, 0.1, 0.0, alt, False, 5.0, rate) for alt, rate in ((100.0, None), (200.0, -1.0), (300.0, 1.0), (400.0, -1.5), (None, 2.0))]
    other = [("y", "C", 10, 30.0, 30.1, 50.0, True, 5.0, 0.0)]
    out = {r.airport_code: r for r in congestion.congestion_features(silver(spark, near + other), places(spark)).collect()}
    a = out["A"]
    assert (a.aircraft_count_50km, a.arrivals_last_30m, a.departures_last_30m, a.avg_altitude_50km) == (5, 1, 1, 250.0)
    assert a.congestion_score == 1.0 and out["B"].congestion_score == 0.2


def test_several_busiest_airports_and_empty_input(spark):
    rows = [("x", "C", 10, 0.0, 0.0, 1.0, False, 1.0, 0.0), ("x", "C", 10, 30.0, 30.0, 1.0, False, 1.0, 0.0)]
    assert {r.congestion_score for r in congestion.congestion_features(silver(spark, rows), places(spark)).collect()} == {1.0}
    assert congestion.congestion_features(silver(spark, rows).limit(0), places(spark)).count() == 0


def test_unique_aircraft_and_null_times(spark):
    rows = [("x", "C", t, 0.0, 0.0, 1.0, False, 1.0, 0.0) for t in (10, 20, None)]
    assert congestion.unique_aircraft(silver(spark, rows), places(spark)).first().unique_aircraft_50km == 1
    assert congestion.airport_counts(silver(spark, rows), places(spark)).first().aircraft_count_50km == 2


@pytest.mark.parametrize("callsign, route", [("ABC", "ABC"), ("ABCD", "ABCD"), ("ABC123", "ABC123"), ("ABC12345", "ABC123"), ("123456789", "123456"), ("", ""), (None, None)])
def test_route_id(spark, callsign, route):
    df = spark.createDataFrame([(callsign,)], "c string")
    assert df.select(fx.route_id(F.col("c"))).first()[0] == route


def route_rows(spark):
    rows = [
        ("x", "ABC123", 10, 0.0, 0.0, 6000.0, False, 90.0, 0.0),
        ("x", "ABC123", 20, 0.0, 0.0, 5000.0, False, 300.0, 0.0),
        ("y", "ABC12399", 30, 0.0, 0.0, 7000.0, False, None, 0.0),
        ("z", "LOW", 40, 0.0, 0.0, 100.0, False, 10.0, 0.0),
        ("z", "LOW", 50, 0.0, 0.0, 9000.0, True, 10.0, 0.0),
        ("z", None, 60, 0.0, 0.0, 9000.0, False, 10.0, 0.0),
    ]
    return silver(spark, rows)


def test_routes(spark):
    out = {r.route_id: r for r in routes.route_features(route_rows(spark)).collect()}
    abc, low = out["ABC123"], out["LOW"]
    assert (abc.route_density, abc.avg_cruise_speed, abc.unique_aircraft_count) == (3, 90.0, 2)
    assert abc.historical_avg_delay_proxy == pytest.approx(1 / 3)
    assert low.avg_cruise_speed is None and low.route_density == 1
    assert str(abc.event_timestamp) == "1970-01-01 00:00:30"


def test_days_combine_and_approximate_fleet(spark):
    df = route_rows(spark)
    assert sorted(map(str, routes.combined(routes.route_days(df)).collect())) == sorted(map(str, routes.route_features(df).collect()))
    assert {r.unique_aircraft_count for r in routes.route_features(df, approximate=True).collect()} == {1, 2}


def test_bands_and_clip(spark):
    df = spark.createDataFrame([(0.8,), (0.7,), (0.5,), (0.4,), (0.3,), (None,)], "p double")
    assert [r[0] for r in df.select(fx.risk_band(F.col("p"))).collect()] == ["HIGH", "HIGH", "MEDIUM", "MEDIUM", "LOW", None]
    clipped = spark.createDataFrame([(-1.0,), (0.5,), (2.0,), (None,)], "p double").select(fx.clip01(F.col("p")))
    assert [r[0] for r in clipped.collect()] == [0.0, 0.5, 1.0, None]
