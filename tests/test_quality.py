import pytest
from pyspark.sql import functions as F

from skyloom.operators import quality
from skyloom.operators.quality import Expectation, QualityError, bronze_suite, run_suite, summarise


def bronze(spark, n=200):
    return spark.range(n).selectExpr(
        "concat('abc', id) icao24", "concat('FLT', id) callsign", "'GB' origin_country",
        "cast(id % 360 - 180 as double) longitude", "cast(id % 180 - 90 as double) latitude",
        "cast(1000 + id * 50 as double) baro_altitude", "false on_ground", "cast(50 + id as double) velocity",
        "cast(id % 360 as double) true_track", "cast(id % 20 - 10 as double) vertical_rate",
        "cast(1700000000 + 15 * id as double) time_position",
    )


def failed(df):
    return {(r.expectation_type, r.column_name) for r in quality.failures(run_suite(df, bronze_suite())).collect()}


def test_valid_frame_passes(spark):
    row = summarise(run_suite(bronze(spark), bronze_suite())).first()
    assert row.passed and (row.evaluated_expectations, row.successful_expectations) == (7, 7)
    assert (row.row_count, row.column_count, row.success_rate) == (200, 11, 1.0)


def test_missing_column(spark):
    kinds = {k for k, _ in failed(bronze(spark).drop("icao24"))}
    assert kinds == {"columns_match_set", "not_null"}


def test_all_null_key(spark):
    assert failed(bronze(spark).withColumn("icao24", F.lit(None).cast("string"))) == {("not_null", "icao24")}


def test_tenth_out_of_range(spark):
    df = bronze(spark, 50).withColumn("velocity", F.when(F.col("icao24").isin([f"abc{i}" for i in range(5)]), -10.0).otherwise(F.col("velocity")))
    assert failed(df) == {("between", "velocity")}


def test_one_percent_out_of_range_is_tolerated_and_nulls_do_not_count(spark):
    df = spark.range(300).selectExpr("case when id < 1 then 700.0D when id < 100 then 5.0D end velocity")
    (row,) = run_suite(df, [Expectation("between", "velocity", 0.0, 600.0, 0.99)]).collect()
    assert row.success and (row.evaluated_count, row.unexpected_count) == (100, 1)


def test_all_null_column_passes(spark):
    assert failed(bronze(spark).withColumn("velocity", F.lit(None).cast("double"))) == set()


def test_suite_is_one_pass(spark, tmp_path):
    bronze(spark).write.parquet(str(tmp_path / "b"))
    plan = run_suite(spark.read.parquet(str(tmp_path / "b")), bronze_suite())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


@pytest.mark.parametrize("good, total, rate", [(10, 10, 1.0), (8, 10, 0.8), (0, 0, 1.0)])
def test_success_rate(spark, good, total, rate):
    value = spark.range(1).select(quality.success_rate(F.lit(good), F.lit(total))).first()[0]
    assert value == pytest.approx(rate)


def test_timestamp_falls_back_to_last_contact(spark):
    df = spark.createDataFrame([(5,)], "last_contact bigint")
    assert quality.validation_frame(df).first().timestamp == 5
    kept = df.withColumn("timestamp", F.lit(9))
    assert quality.validation_frame(kept).first().timestamp == 9


def test_silver_gate():
    columns = ["aircraft_id", "latitude", "longitude", "baro_altitude", "event_timestamp"]
    fine = {"silver_rows": 50, **{f"null_{c}": 0 for c in columns}}
    quality.check_silver(columns, fine)
    with pytest.raises(QualityError, match="lacks"):
        quality.check_silver(columns[1:], fine)
    with pytest.raises(QualityError, match="fewer"):
        quality.check_silver(columns, {**fine, "silver_rows": 49})
    quality.check_silver(columns, {**fine, "null_latitude": 15})
    with pytest.raises(QualityError, match="null ratio"):
        quality.check_silver(columns, {**fine, "null_latitude": 16})


def test_null_ratios_of_an_empty_table(spark):
    (row,) = quality.null_ratios(spark.createDataFrame([], "a int"), ["a"]).collect()
    assert row.null_ratio == 0.0 and row.passed
