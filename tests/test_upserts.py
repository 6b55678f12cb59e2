import pytest
from pyspark.sql import functions as F

from skyloom.operators.keyed import last_per_key
from skyloom.sources import lake
from skyloom.sources.upserts import BucketTable

SCHEMA = "k string, at long, x double"


def batch(spark, rows):
    return lake.staged(spark.createDataFrame(rows, SCHEMA), "batch")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def files(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


@pytest.fixture
def table(spark, tmp_path):
    return BucketTable(spark, str(tmp_path / "t"), ["k"], ["at"], buckets=16)


def test_equals_the_last_row_per_key(spark, table):
    batches = [batch(spark, [(f"k{(i * 7 + n) % 40}", i + n * 5, float(i)) for i in range(30)]) for n in range(4)]
    for b in batches:
        table.upsert(b)
    everything = batches[0]
    for b in batches[1:]:
        everything = everything.unionByName(b)
    assert rows(table.read()) == rows(last_per_key(everything, ["k"], ["at"]))
    before = rows(table.read())
    table.upsert(batches[0])  # older rows do not replace newer ones
    assert rows(table.read()) == before


def test_only_touched_buckets_are_written(spark, table):
    table.upsert(batch(spark, [(f"k{i}", 1, 0.0) for i in range(200)]))
    before = files(table.read())
    manifest = table.upsert(batch(spark, [("k3", 2, 1.0), ("new", 1, 2.0), (None, 1, 3.0)]))
    after = files(table.read())
    assert len(before) == 16 and 1 <= len(after - before) <= 3
    assert sum(v == 1 for v in manifest["current"].values()) == len(after - before)
    found = {r.k: (r.at, r.x) for r in table.read().collect()}
    assert found["k3"] == (2, 1.0) and found["new"] == (1, 2.0) and found[None] == (1, 3.0) and len(found) == 202


def test_a_killed_write_leaves_the_version_before(spark, table, monkeypatch):
    table.upsert(batch(spark, [("a", 1, 0.0), ("b", 1, 0.0)]))
    before = rows(table.read())

    def killed(manifest):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(table, "_publish", killed)
        with pytest.raises(KeyboardInterrupt):
            table.upsert(batch(spark, [("a", 2, 9.0)]))
    assert rows(table.read()) == before and table.versions() == [0]
    table.upsert(batch(spark, [("b", 3, 4.0)]))
    assert rows(table.read()) == [("a", 1, 0.0), ("b", 3, 4.0)]


def test_repeated_batches_and_old_versions(spark, table):
    for n in range(5):
        table.upsert(batch(spark, [("a", n, float(n)), (f"k{n}", n, 0.0)]), batch=n)
    state = table.manifest()
    assert table.upsert(batch(spark, [("a", 99, 0.0)]), batch=4) == state and table.versions() == [3, 4]
    assert {r.at for r in table.read().filter("k = 'a'").collect()} == {4}
    assert {r.at for r in table.read(3).filter("k = 'a'").collect()} == {3}
    live = {f.split("/bucket=")[0][-1] for f in files(table.read())} | {f.split("/bucket=")[0][-1] for f in files(table.read(3))}
    kept = lake.partition_values(spark, f"{table.root}/data", "version")
    assert set(kept) == live


def test_empty(spark, table):
    with pytest.raises(lake.NotEnoughData):
        table.read()
    table.upsert(batch(spark, []))
    assert table.read().count() == 0 and table.read().columns == ["k", "at", "x"]


def test_two_writers_of_one_version(spark, table, monkeypatch):
    """The second to publish fails; its files are no part of the table."""
    table.upsert(batch(spark, [("a", 1, 0.0)]))
    other = BucketTable(spark, table.root, ["k"], ["at"], 16)
    stale = other.manifest()
    table.upsert(batch(spark, [("a", 2, 0.0)]))
    monkeypatch.setattr(other, "manifest", lambda version=None: stale)
    with pytest.raises(OSError, match="another writer"):
        other._publish(stale | {"version": 1})
    assert rows(table.read()) == [("a", 2, 0.0)]
