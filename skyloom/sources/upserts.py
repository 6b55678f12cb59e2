"""A keyed table in buckets, of which an upsert rewrites only those its keys fall into.

``<root>/data/version=V/bucket=B`` holds the rows of bucket B as version V left them, and
``<root>/manifest/V.json`` says which version of each bucket is current. The manifest is written
last and moved into place in one step: a write that is killed leaves files no manifest names, and
the version before stays readable. The manifest before is kept for readers that have it; files
that neither names are removed.
"""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.operators.keyed import last_per_key
from skyloom.sources.lake import NotEnoughData, exists, remove

BUCKETS = 64
KEPT = 2


class BucketTable:
    """The last row per key by ``order``. ``buckets`` is fixed when the table is made; choose it
    so that a bucket fits a task."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str], order: list[str], buckets: int = BUCKETS):
        self.spark, self.root, self.keys, self.order, self.buckets = spark, root, keys, order, buckets

    def _store(self, path: str):
        location = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return location.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), location

    def versions(self) -> list[int]:
        store, location = self._store(f"{self.root}/manifest")
        if not store.exists(location):
            return []
        names = [f.getPath().getName() for f in store.listStatus(location)]
        return sorted(int(n.split(".")[0]) for n in names if n.endswith(".json") and not n.startswith("_"))

    def manifest(self, version: int | None = None) -> dict:
        """The newest manifest, or that of ``version``; empty before the first write."""
        known = self.versions()
        if not known:
            return {"version": -1, "batch": None, "buckets": self.buckets, "current": {}, "schema": None}
        version = known[-1] if version is None else version
        lines = self.spark.read.text(f"{self.root}/manifest/{version}.json").collect()
        return json.loads("".join(r.value for r in lines))

    def _publish(self, manifest: dict) -> None:
        store, hidden = self._store(f"{self.root}/manifest/_{manifest['version']}.json")
        out = store.create(hidden, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        _, final = self._store(f"{self.root}/manifest/{manifest['version']}.json")
        if not store.rename(hidden, final):
            raise OSError(f"version {manifest['version']} was published by another writer")

    def _paths(self, manifest: dict, buckets=None) -> list[str]:
        current = manifest["current"].items()
        return [f"{self.root}/data/version={v}/bucket={b}" for b, v in current if buckets is None or int(b) in buckets]

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of the newest version, or of one of the two last."""
        manifest = self.manifest(version)
        if manifest["schema"] is None:
            raise NotEnoughData(f"no rows at {self.root}")
        schema = _schema(manifest["schema"])
        paths = self._paths(manifest)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def upsert(self, rows: DataFrame, batch: int | None = None) -> dict:
        """Rows replace those of their key that come before them by ``order``. Writing the same
        rows again changes nothing; a ``batch`` number that was written before is skipped. ``rows``
        is read twice, so pass a stored or staged table. Gives the manifest."""
        before = self.manifest()
        if batch is not None and before["batch"] is not None and batch <= before["batch"]:
            return before
        buckets, version = before["buckets"], before["version"] + 1
        bucketed = rows.withColumn("bucket", F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int"))
        touched = {r.bucket for r in bucketed.select("bucket").distinct().collect()}  # at most ``buckets``
        old = self._paths(before, touched)
        if old:
            stored = self.spark.read.schema(rows.schema).parquet(*old)
            stored = stored.withColumn("bucket", F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int"))
            bucketed = bucketed.unionByName(stored)
        path = f"{self.root}/data/version={version}"
        remove(self.spark, path)  # what a killed write may have left
        kept = last_per_key(bucketed, ["bucket", *self.keys], self.order)
        kept.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(path)
        current = before["current"] | {str(b): version for b in touched}
        manifest = {"version": version, "batch": batch if batch is not None else before["batch"], "buckets": buckets, "current": current, "schema": rows.schema.json()}
        self._publish(manifest)
        self._clean(manifest, before)
        return manifest

    def _clean(self, *kept: dict) -> None:
        """Drops manifests before the last KEPT and bucket versions that none of these name."""
        for version in self.versions()[:-KEPT]:
            remove(self.spark, f"{self.root}/manifest/{version}.json")
        named = {path for manifest in kept for path in self._paths(manifest)}
        store, location = self._store(f"{self.root}/data")
        if not store.exists(location):
            return
        for folder in store.listStatus(location):
            version = folder.getPath().getName()
            inside = [f.getPath().getName() for f in store.listStatus(folder.getPath()) if f.isDirectory()]
            live = [b for b in inside if f"{self.root}/data/{version}/{b}" in named]
            if not live:
                remove(self.spark, f"{self.root}/data/{version}")
            for bucket in set(inside) - set(live) if live else ():
                remove(self.spark, f"{self.root}/data/{version}/{bucket}")


def _schema(text: str):
    from pyspark.sql.types import StructType

    return StructType.fromJson(json.loads(text))


def stored(spark: SparkSession, root: str) -> DataFrame:
    """The rows of a table whose keys the reader need not know."""
    return BucketTable(spark, root, [], []).read()


def is_table(spark: SparkSession, root: str) -> bool:
    return exists(spark, f"{root}/manifest")
