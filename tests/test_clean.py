from pyspark.sql import functions as F

from skyloom.operators import clean

SCHEMA = (
    "aircraft_id string, time_position bigint, last_contact bigint, latitude double, longitude double, "
    "baro_altitude double, velocity double"
)
GOOD = dict(aircraft_id="a", time_position=10, last_contact=11, latitude=1.0, longitude=2.0, baro_altitude=100.0, velocity=50.0)


def frame(spark, *changes):
    names = list(GOOD)
    return spark.createDataFrame([tuple({**GOOD, **c}[n] for n in names) for c in changes], SCHEMA)


def test_bounds_are_inclusive(spark):
    edges = [
        {"baro_altitude": -500.0}, {"baro_altitude": 15000.0}, {"velocity": 0.0}, {"velocity": 400.0},
        {"latitude": -90.0}, {"latitude": 90.0}, {"longitude": -180.0}, {"longitude": 180.0},
    ]
    assert clean.clean(frame(spark, *edges)).count() == len(edges)


def test_rejects_and_reasons(spark):
    bad = {
        "time_position missing": {"time_position": None},
        "aircraft_id missing": {"aircraft_id": None},
        "latitude missing": {"latitude": None},
        "baro_altitude missing": {"baro_altitude": None},
        "baro_altitude out of range": {"baro_altitude": 15000.1},
        "velocity out of range": {"velocity": None},
        "longitude out of range": {"longitude": -180.5},
    }
    df = frame(spark, {}, *bad.values())
    assert clean.clean(df).count() == 1
    assert {r.reject_reason for r in clean.quarantine(df).collect()} == set(bad)


def test_latest_contact_survives(spark):
    df = frame(spark, {"last_contact": 12, "velocity": 1.0}, {"last_contact": 15, "velocity": 2.0}, {"last_contact": 13})
    (row,) = clean.dedup(df).collect()
    assert (row.last_contact, row.velocity) == (15, 2.0)


def test_ties_do_not_depend_on_partitioning(spark):
    rows = [{"velocity": float(v), "aircraft_id": str(v % 3)} for v in range(60)]
    df = frame(spark, *rows)
    results = {
        tuple(sorted(map(tuple, clean.dedup(df.repartition(n)).collect()))) for n in (1, 3, 7)
    }
    assert len(results) == 1


def test_copies_shrink_before_the_shuffle(spark):
    plan = clean.dedup(frame(spark, {}))._jdf.queryExecution().executedPlan().toString()
    partial, final = plan.rindex("row_number(), 1, Partial"), plan.index("row_number(), 1, Final")
    assert final < plan.index("Exchange hashpartitioning") < partial


def test_silver_columns(spark):
    rest = {c: F.lit(None).cast("string") for c in ("callsign", "origin_country", "squawk")}
    numbers = {c: F.lit(None).cast("double") for c in ("geo_altitude", "heading", "vertical_rate")}
    df = frame(spark, {"time_position": 1717675800}).withColumns({**rest, **numbers}).withColumn(
        "on_ground", F.lit(False)
    ).withColumn("position_source", F.lit(0))
    (row,) = clean.to_silver(df).collect()
    assert (row.year, row.month, row.day) == (2024, 6, 6) and str(row.event_timestamp) == "2024-06-06 12:10:00"


def test_an_absurd_time_does_not_fail_the_job(spark):
    df = spark.createDataFrame([(9_000_000_000_000_000_000,)], "time_position bigint")
    assert df.select(F.col("time_position").cast("timestamp").cast("bigint")).first()[0] > 4e9
