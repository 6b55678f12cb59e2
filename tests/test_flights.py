import pytest
from pyspark.sql import functions as F

from skyloom.operators import flights
from skyloom.operators.flights import flight_features

SCHEMA = (
    "aircraft_id string, callsign string, origin_country string, t bigint, latitude double, longitude double, "
    "baro_altitude double, on_ground boolean, velocity double, heading double, vertical_rate double"
)


def silver(spark, *rows):
    """rows of (aircraft, second, velocity, heading[, latitude, longitude])"""
    data = []
    for row in rows:
        a, t, v, h, *at = row
        lat, lon = at or (0.0, 0.0)
        data.append((a, "C", "X", t, lat, lon, 9000.0, False, v, h, 0.0))
    return spark.createDataFrame(data, SCHEMA).withColumn("event_timestamp", F.timestamp_seconds("t")).drop("t")


def by_time(df):
    return df.orderBy("aircraft_id", "event_timestamp").collect()


@pytest.mark.parametrize("busy_rows", [1_000_000, 0])
def test_rolling_range_is_inclusive(spark, busy_rows):
    rows = by_time(flight_features(silver(spark, ("a", 0, 1.0, 0.0), ("a", 900, 3.0, 0.0), ("a", 901, 5.0, 0.0)), busy_rows=busy_rows))
    assert [r.avg_speed_15m for r in rows] == [1.0, 2.0, 4.0]


@pytest.mark.parametrize("wrap, turn", [(True, 20.0), (False, 340.0)])
def test_heading_wrap_and_first_fix(spark, wrap, turn):
    rows = by_time(flight_features(silver(spark, ("a", 0, 1.0, 350.0), ("a", 60, 1.0, 10.0)), wrap_heading=wrap))
    assert [r.heading_change_5m for r in rows] == [None, turn]
    assert rows[0].distance_10m_km == 0.0


def test_distance_and_calendar(spark):
    rows = by_time(flight_features(silver(spark, ("a", 1717675800, 1.0, 0.0, 0.0, 0.0), ("a", 1717675860, 1.0, 0.0, 0.0, 1.0))))
    assert rows[1].distance_10m_km == pytest.approx(111.194927, abs=1e-6)
    assert (rows[0].hour_of_day, rows[0].day_of_week, rows[0].is_on_ground) == (12, 3, 0)
    sunday_first = flight_features(silver(spark, ("a", 1717675800, 1.0, 0.0)), monday_first=False).first()
    assert sunday_first.day_of_week == 5


def test_grounded_and_incomplete_rows_are_left_out(spark):
    df = silver(spark, ("a", 0, 1.0, 0.0), ("a", 60, None, 0.0), ("a", 120, 1.0, None))
    grounded = df.withColumn("on_ground", F.lit(True))
    unknown = df.withColumn("on_ground", F.lit(None).cast("boolean"))
    timeless = df.withColumn("event_timestamp", F.lit(None).cast("timestamp"))
    assert flight_features(df.union(grounded).union(unknown).union(timeless)).count() == 1


@pytest.mark.parametrize("slice_seconds", [900, 1000, 21_600])
def test_slices_change_nothing(spark, slice_seconds):
    """Dense, sparse and gapped tracks, fixes on slice borders: same rows as whole windows."""
    rows = [("dense", 40 * i, float(i % 7), float(i * 37 % 360), i / 100, i / 50) for i in range(200)]
    rows += [("sparse", 5000 * i, float(i), float(i * 91 % 360), -i / 10, i / 10) for i in range(40)]
    rows += [("edge", t, float(t % 11), float(t % 360), 1.0, t / 1e4) for t in (0, 899, 900, 901, 999, 1000, 1799, 1800, 1900, 2000, 9000, 9899, 9900, 43_200, 43_199, 100_000)]
    df = silver(spark, *rows)
    whole = flight_features(df)
    cut = flight_features(df, slice_seconds, busy_rows=0)
    one_busy = flight_features(df, slice_seconds, busy_rows=100)
    assert by_time(cut) == by_time(whole) == by_time(one_busy)
    assert whole.count() == len(rows)


def test_partitioning_changes_nothing(spark):
    rows = [(f"a{i % 5}", 70 * i, float(i % 13), float(i * 17 % 360), i / 90, 0.5) for i in range(300)]
    df = silver(spark, *rows)
    assert by_time(flight_features(df.repartition(7))) == by_time(flight_features(df.coalesce(1)))


def test_one_shuffle_one_sort_no_python(spark, tmp_path):
    silver(spark, ("a", 0, 1.0, 0.0)).write.parquet(str(tmp_path / "s"))
    plan = flight_features(spark.read.parquet(str(tmp_path / "s")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1 and plan.count("Window [") == 1
    assert "Python" not in plan and "PushedFilters: [IsNotNull(on_ground)" in plan


def test_slice_must_cover_range(spark):
    with pytest.raises(ValueError):
        flights.windowed(silver(spark, ("a", 0, 1.0, 0.0)), 60, busy_rows=0)


def test_a_busy_aircraft_is_spread_over_bounded_groups(spark):
    rows = [("busy", t, 1.0, 0.0) for t in range(0, 20_000, 2)] + [("calm", 50 * t, 1.0, 0.0) for t in range(20)]
    timed = silver(spark, *rows).withColumn("second", F.col("event_timestamp").cast("bigint"))
    busy = spark.createDataFrame([("busy",)], "aircraft_id string")
    out = flights.sliced(timed, busy, 1800)
    sizes = {(r.aircraft_id, r.slice): r["count"] for r in out.groupBy("aircraft_id", "slice").count().collect()}
    assert max(sizes.values()) <= (1800 + 900) / 2 and sizes[("calm", 0)] == 20
    assert out.filter("not is_halo").count() == len(rows)
