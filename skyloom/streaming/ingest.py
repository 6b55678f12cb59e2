"""Incremental bronze to silver.

``silver_stream`` appends within the lateness it allows, and suits short batches.
``SilverMerge`` rewrites the days a batch touches: nothing is too late for it, the latest contact
of a position stays whichever batch brings it, and copies combine before they are shuffled.
"""

import time
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

from skyloom.operators.clean import bronze_to_silver, clean, explode_states, to_silver
from skyloom.sources.lake import in_utc, merge_partitioned, scratch, staged
from skyloom.sources.schemas import SILVER_KEY, SILVER_ORDER, SILVER_PARTITIONS

LATENESS = "2 hours"


@in_utc
def silver_stream(bronze: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Cleaned states, each (aircraft, position time) once. State is kept for ``lateness``;
    rows later than that are dropped by the watermark and show in the query's progress.
    Of several contacts with one position the first to arrive stays, since a row already
    written cannot be taken back."""
    return dedup_stream(to_silver(clean(explode_states(bronze))), lateness)


def dedup_stream(silver: DataFrame, lateness: str = LATENESS) -> DataFrame:
    return silver.withWatermark("event_timestamp", lateness).dropDuplicatesWithinWatermark(
        ["aircraft_id", "event_timestamp"]
    )


class SilverMerge:
    """``foreachBatch`` body that merges each batch of bronze into the silver table. A
    repeated batch changes nothing."""

    def __init__(self, path: str):
        self.path = path

    def start(self, bronze: DataFrame, checkpoint: str, **trigger):
        return (
            bronze.writeStream.foreachBatch(self)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )

    @in_utc
    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with scratch(batch.sparkSession):
            new = staged(bronze_to_silver(batch), "silver_batch")
            merge_partitioned(new, self.path, SILVER_PARTITIONS, SILVER_KEY, SILVER_ORDER)


def write_stream(
    df: DataFrame, path: str, checkpoint: str, partitions: list[str] | None = None, **trigger
):
    """Append to a parquet table, by default all that is there now and then stop."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    return writer.partitionBy(*partitions).start() if partitions else writer.start()


def write_silver_stream(df: DataFrame, path: str, checkpoint: str, **trigger):
    return write_stream(df, path, checkpoint, SILVER_PARTITIONS, **trigger)


class StreamCounts(StreamingQueryListener):
    """Rows read and dropped as late by each query of a session, from all its progress reports;
    a query object itself keeps only the last ones. Attach before the query starts."""

    def __init__(self, spark: SparkSession):
        self.rows, self.late, self.batches, self.ended = Counter(), Counter(), Counter(), set()
        self.streams = spark.streams
        self.streams.addListener(self)

    def close(self) -> None:
        self.streams.removeListener(self)

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        run, progress = str(event.progress.runId), event.progress
        self.rows[run] += progress.numInputRows
        self.late[run] += sum(o.numRowsDroppedByWatermark for o in progress.stateOperators)
        self.batches[run] += 1

    def onQueryTerminated(self, event):
        self.ended.add(str(event.runId))

    def settled(self, query, seconds: float = 30.0) -> str:
        """Run id of a query once all reports of it are in, if it has ended."""
        run, until = str(query.runId), time.monotonic() + seconds
        while not query.isActive and run not in self.ended and time.monotonic() < until:
            time.sleep(0.05)
        return run
