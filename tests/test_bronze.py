import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from skyloom.operators import clean
from skyloom.sources import bronze, lake

FULL = [
    "3c6444", "DLH2A   ", "Germany", 1717675800, 1717675805, 8.57, 50.03, 10972.8, False,
    231.5, 271.2, 0.0, [1, 2], 11277.6, "1000", False, 0,
]


def respond(spark, *bodies):
    rows = [(json.dumps(b), datetime(2026, 6, 6, 12, 30, 15)) for b in bodies]
    return spark.createDataFrame(rows, "value string, run_time timestamp")


def states(spark, body):
    return bronze.parse_states(respond(spark, body)).collect()


def test_full_vector(spark):
    (row,) = states(spark, {"time": 1, "states": [FULL]})
    assert (row.icao24, row.callsign, row.time_position, row.on_ground) == ("3c6444", "DLH2A", 1717675800, False)
    assert (row.velocity, row.sensors, row.position_source) == (231.5, "[1,2]", 0)


@pytest.mark.parametrize("body", [{}, {"states": None}, {"states": []}, {"states": [None]}])
def test_nothing_to_parse(spark, body):
    assert states(spark, body) == []


def test_null_vector_is_skipped(spark):
    assert len(states(spark, {"states": [FULL, None]})) == 1


def test_short_vector_is_padded(spark):
    short = ["abc", "   DLH2A   ", "DE", 5, 6, 1.5, 2.5]
    (row,) = states(spark, {"states": [short]})
    assert row.callsign == "DLH2A" and row.latitude == 2.5
    assert row.baro_altitude is None and row.position_source is None


def test_blank_callsign_is_empty_not_null(spark):
    (row,) = states(spark, {"states": [["abc", "        "]]})
    assert row.callsign == ""


def test_bad_scalars_become_null(spark):
    vector = ["abc", None, "DE", "soon", 1717675800.0, "east", 2.5]
    (row,) = states(spark, {"states": [vector]})
    assert row.time_position is None and row.longitude is None and row.last_contact == 1717675800


def test_batches_keep_only_positions(spark):
    lost = list(FULL)
    lost[5] = lost[6] = None
    (row,) = bronze.parse_batches(respond(spark, {"time": 77, "states": [FULL, lost, None]}), "value", "run_time").collect()
    assert (row.fetch_timestamp, row.aircraft_count, len(row.states)) == (77.0, 1, 1)
    assert row.states[0].callsign == "DLH2A"


def test_fetch_time_falls_back_to_run_time(spark):
    (row,) = bronze.parse_batches(respond(spark, {"states": [FULL]}), "value", "run_time").collect()
    assert row.fetch_timestamp == datetime(2026, 6, 6, 12, 30, 15, tzinfo=timezone.utc).timestamp()


def test_empty_response_is_an_empty_batch(spark):
    (row,) = bronze.parse_batches(respond(spark, {}), "value", "run_time").collect()
    assert row.aircraft_count == 0 and row.states == []


def test_landing_folders_and_read_back(spark, tmp_path):
    batches = bronze.parse_batches(respond(spark, {"time": 5, "states": [FULL]}), "value", "run_time")
    bronze.land_bronze(batches, str(tmp_path / "bronze"))
    assert list((tmp_path / "bronze").glob("year=2026/month=06/day=06/*.json"))
    (row,) = clean.explode_states(bronze.read_bronze(spark, str(tmp_path / "bronze"))).collect()
    assert (row.aircraft_id, row.heading, row.time_position, row.fetch_timestamp) == ("3c6444", 271.2, 1717675800, 5)


def test_batch_path():
    at = datetime(2026, 6, 6, 12, 30, 15)
    assert bronze.batch_path("bronze/x", at) == "bronze/x/year=2026/month=06/day=06/batch_20260606_123015.json"


def test_multi_line_files_and_floats_in_whole_number_fields(spark, tmp_path):
    state = {"icao24": "a", "time_position": 1700000001.0, "last_contact": "x", "position_source": 2.0, "latitude": 1.0}
    body = {"fetch_timestamp": 1, "ingest_timestamp": "2026-06-06T12:00:00+00:00", "aircraft_count": 1, "states": [state]}
    folder = tmp_path / "a" / "b"
    folder.mkdir(parents=True)
    (folder / "one.json").write_text(json.dumps(body, indent=2))
    (row,) = clean.explode_states(bronze.read_bronze(spark, str(tmp_path), multi_line=True)).collect()
    assert row.time_position == 1700000001 and row.position_source == 2 and row.last_contact is None
    assert row.ingest_timestamp == datetime(2026, 6, 6, 12)


def test_read_table_errors(spark, tmp_path):
    with pytest.raises(lake.NotEnoughData, match="no label files"):
        lake.read_table(spark, str(tmp_path / "none"), "label")
    spark.range(0).write.parquet(str(tmp_path / "empty"))
    with pytest.raises(lake.NotEnoughData, match="no label rows"):
        lake.read_table(spark, str(tmp_path / "empty"), "label")


def test_broadcast_only_within_bound(spark):
    small = spark.range(10)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(spark.range(100).join(lake.broadcast_within(small, 10), "id"))
    assert "broadcast" not in plan(spark.range(100).join(lake.broadcast_within(small, 9), "id"))


def test_airports(spark):
    places = lake.airports(spark)
    assert places.count() == 50 and places.select("airport_code").distinct().count() == 50
    assert places.filter(F.abs("airport_lat") > 90).count() == 0
