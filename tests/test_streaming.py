import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from skyloom.operators import congestion, flights, views
from skyloom.operators.keyed import last_per_key
from skyloom.plans import telemetry
from skyloom.sources import lake
from skyloom.streaming import ingest
from skyloom.streaming.congestion import hourly_counts
from skyloom.streaming.latest import LatestTable
from skyloom.streaming.tracks import TrackFeatures

COLUMNS = [
    "aircraft_id", "callsign", "origin_country", "event_timestamp", "latitude", "longitude",
    "baro_altitude", "on_ground", "velocity", "heading", "vertical_rate",
]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """Silver in four files, in time order by name and by modification time."""
    path = str(tmp_path_factory.mktemp("parts"))
    silver = telemetry.silver(spark, SF_DIR).select(*COLUMNS)
    cuts = [F.lit(f"2024-01-{d:02d}").cast("timestamp") for d in (1, 8, 16, 24, 31)]
    for low, high in zip(cuts, cuts[1:]):
        at = F.col("event_timestamp")
        silver.filter((at >= low) & (at < high)).coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, path, per_batch=1):
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def test_tracks_equal_batch(spark, parts, tmp_path):
    tracks = TrackFeatures(str(tmp_path / "t"))
    query = tracks.start(stream(spark, parts), str(tmp_path / "c"))
    query.awaitTermination()
    assert query.lastProgress["batchId"] == 3
    out = tracks.read(spark)
    assert out.filter("is_late").count() == 0
    want = flights.flight_features(spark.read.parquet(parts))
    assert rows(out.drop("is_late")) == rows(want)


def in_batches(spark, path, batches):
    """A stream of one batch for each of ``batches``."""
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(batches[0].schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_late_fixes_are_marked_and_not_folded_in(spark, parts, tmp_path):
    tracks = TrackFeatures(str(tmp_path / "t"))
    silver = spark.read.parquet(parts).filter("aircraft_id = '3'").orderBy("event_timestamp")
    everything = lake.staged(silver.filter(~F.col("on_ground")), "one_aircraft")
    middle = everything.approxQuantile("velocity", [0.5], 0.0)[0]  # any split that leaves gaps
    early, late = everything.filter(F.col("velocity") >= middle), everything.filter(F.col("velocity") < middle)
    newest = early.agg(F.max("event_timestamp")).first()[0]
    tracks.start(in_batches(spark, str(tmp_path / "in"), [early, late]), str(tmp_path / "c")).awaitTermination()
    out = tracks.read(spark)
    assert out.filter("is_late").count() == late.filter(F.col("event_timestamp") <= F.lit(newest)).count() > 0
    in_order = early.unionByName(late.filter(F.col("event_timestamp") > F.lit(newest)))
    assert rows(out.filter("not is_late").drop("is_late")) == rows(flights.flight_features(in_order))


def test_a_second_run_goes_on_from_the_state(spark, parts, tmp_path):
    """The first run ends after some batches; what it left is read from its checkpoint."""
    tracks, path = TrackFeatures(str(tmp_path / "t")), str(tmp_path / "in")
    silver = spark.read.parquet(parts)
    middle = F.lit("2024-01-16").cast("timestamp")
    first, second = silver.filter(F.col("event_timestamp") < middle), silver.filter(F.col("event_timestamp") >= middle)
    tracks.start(in_batches(spark, path, [first]), str(tmp_path / "c")).awaitTermination()
    before = tracks.read(spark).count()
    query = tracks.start(in_batches(spark, path, [second]), str(tmp_path / "c"))
    query.awaitTermination()
    assert rows(tracks.read(spark).drop("is_late")) == rows(flights.flight_features(silver)) and before > 0
    tracks.start(stream(spark, path), str(tmp_path / "c")).awaitTermination()  # nothing new
    assert tracks.read(spark).count() == flights.flight_features(silver).count()


def test_a_batch_writes_the_state_of_its_aircraft_only(spark, parts, tmp_path):
    silver = spark.read.parquet(parts)
    one = silver.filter("aircraft_id = '3'")
    last = one.agg(F.max("event_timestamp")).first()[0]
    more = one.limit(1).withColumn("event_timestamp", F.lit(last) + F.expr("interval 1 minute")).withColumn("on_ground", F.lit(False))
    tracks = TrackFeatures(str(tmp_path / "t"))
    query = tracks.start(in_batches(spark, str(tmp_path / "in"), [silver, more.fillna(1.0)]), str(tmp_path / "c"))
    query.awaitTermination()
    updated = [sum(op["numRowsUpdated"] for op in p["stateOperators"]) for p in query.recentProgress if p["numInputRows"]]
    aircraft = silver.filter("not on_ground").select("aircraft_id").distinct().count()
    assert updated[0] >= updated[1] and updated[1] <= 1 + 900 and aircraft > 5


def test_closed_hours_equal_batch(spark, parts, tmp_path):
    hubs = telemetry.hubs(spark, SF_DIR)
    counts = hourly_counts(stream(spark, parts), hubs)
    ingest.write_stream(counts, str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "o"))
    want = congestion.airport_counts(spark.read.parquet(parts), hubs)
    closed = spark.read.parquet(parts).agg(F.max("event_timestamp") - F.expr("interval 3 hours")).first()[0]
    done = want.filter(F.col("event_timestamp") <= F.lit(closed))
    assert rows(got.select(*done.columns)) == rows(done) and got.count() > 500


def test_dedup_drops_copies_across_batches_and_counts_late_rows(spark, tmp_path):
    day = 86_400
    batches = [
        [("a", 10), ("a", 10), ("b", 10)],
        [("a", 10), ("a", 50), ("a", 2 * day)],
        [("a", 2 * day + 1)],
        [("a", 60), ("a", 2 * day)],
    ]
    path = str(tmp_path / "in")
    schema = "aircraft_id string, t bigint"
    frame = lambda b: spark.createDataFrame(b, schema).withColumn("event_timestamp", F.timestamp_seconds("t")).coalesce(1)
    frame(batches[0]).write.parquet(path)
    for batch in batches[1:]:
        frame(batch).write.mode("append").parquet(path)
    once = ingest.dedup_stream(stream(spark, path))
    counts = ingest.StreamCounts(spark)
    query = ingest.write_stream(once, str(tmp_path / "o"), str(tmp_path / "c"))
    query.awaitTermination()
    kept = sorted((r.aircraft_id, r.t) for r in spark.read.parquet(str(tmp_path / "o")).collect())
    assert kept == [("a", 10), ("a", 50), ("a", 2 * day), ("a", 2 * day + 1), ("b", 10)]
    run = counts.settled(query)
    assert counts.late[run] == 1 and counts.rows[run] == 9 and counts.batches[run] >= 4
    counts.close()


def test_merging_batches_in_any_order_equals_batch(spark, tmp_path):
    """Copies across batches, old reports arriving last, one batch repeated."""
    source = telemetry.bronze(spark, SF_DIR)
    repeated = source.withColumn("fetch_timestamp", F.col("fetch_timestamp") + 10)
    merge = ingest.SilverMerge(str(tmp_path / "silver"))
    merge(repeated.filter("event_id % 3 > 0"), 0)
    merge(source.filter("event_id % 3 > 1"), 1)
    merge(source.filter("event_id % 3 = 0"), 2)
    merge(source.filter("event_id % 3 = 0"), 2)
    got = spark.read.parquet(merge.path)
    want = telemetry.silver(spark, SF_DIR)
    assert rows(got.select(*want.columns)) == rows(want)


def test_an_older_contact_in_a_later_batch_does_not_replace_a_newer(spark, tmp_path):
    source = telemetry.bronze(spark, SF_DIR)
    newer = source.withColumn(
        "states", F.transform("states", lambda s: s.withField("last_contact", s["last_contact"] + 60).withField("squawk", F.lit("new")))
    )
    merge = ingest.SilverMerge(str(tmp_path / "silver"))
    merge(newer, 0)
    merge(source, 1)
    got = spark.read.parquet(merge.path)
    assert got.count() == telemetry.silver(spark, SF_DIR).count() == got.filter("squawk = 'new'").count()


def test_latest_table_over_batches(spark, parts, tmp_path):
    view = views.FeatureView("v", "aircraft_id", 60, {"velocity": "float"})
    table = LatestTable(view, str(tmp_path / "t"))
    query = table.start(stream(spark, parts), str(tmp_path / "c"))
    query.awaitTermination()
    want = last_per_key(view.select(spark.read.parquet(parts)), ["aircraft_id"], ["event_timestamp"])
    assert rows(table.read(spark)) == rows(want)


def test_stream_parts_land_as_several_files_a_batch(spark, monkeypatch):
    """A part of a stream is written by several tasks and still taken in one batch."""
    from skyloom.plans import queries

    monkeypatch.setattr(queries, "FILE_ROWS", 20)
    rows = spark.range(600).selectExpr("id", "timestamp'2024-01-01' + make_dt_interval(int(id % 30)) as event_timestamp")
    seen = []
    stream = queries._in_batches(spark, rows, "parts")
    count = lambda batch, _: seen.append((batch.count(), batch.select(F.input_file_name()).distinct().count(), batch.selectExpr("min(event_timestamp)").first()[0].day))
    stream.writeStream.foreachBatch(count).trigger(availableNow=True).option("checkpointLocation", queries.lake.fresh_path(spark, "c")).start().awaitTermination()
    assert [(n, day) for n, _, day in seen] == [(200, 1), (200, 11), (200, 21)] and all(files == 10 for _, files, _ in seen)
