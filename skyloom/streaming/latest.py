"""Continuous materialisation of a feature view."""

from pyspark.sql import DataFrame

from skyloom.operators.keyed import last_per_key
from skyloom.operators.views import FeatureView
from skyloom.sources.lake import scratch, staged
from skyloom.sources.upserts import BUCKETS, BucketTable


class LatestTable:
    """``foreachBatch`` body: the newest row per entity of the batch and the table so far. A batch
    rewrites only the buckets its entities fall into, and a repeated one is skipped."""

    def __init__(self, view: FeatureView, root: str, buckets: int = BUCKETS):
        self.view, self.root, self.buckets = view, root, buckets

    def start(self, source: DataFrame, checkpoint: str, **trigger):
        return (
            source.writeStream.foreachBatch(self)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )

    def table(self, spark, rows: DataFrame | None = None) -> BucketTable:
        order = [] if rows is None else self.view.order(rows)
        return BucketTable(spark, self.root, [self.view.entity], order, self.buckets)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with scratch(batch.sparkSession):
            rows = self.view.select(batch)
            rows = staged(last_per_key(rows, [self.view.entity], self.view.order(rows)), "latest_batch")
            self.table(batch.sparkSession, rows).upsert(rows, batch_id)

    def read(self, spark, version: int | None = None) -> DataFrame:
        return self.table(spark).read(version)
