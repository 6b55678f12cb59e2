"""Flight features as a stream, with what an aircraft leaves behind kept as its state.

Per aircraft the state is the last fix and the fixes within the rolling range of it, so a batch
reads and writes only the aircraft it saw. Results are appended by the file sink, each batch once
however often it is tried. State is kept for good: only so are the features those of the batch
job after any pause. It is at most one fix a second of the rolling range.
"""

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from skyloom import constants as C
from skyloom.operators.flights import CARRIED, airborne, describe_fixes
from skyloom.sources.lake import utc

# Executors get this module's functions with the task, not from an installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGES = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
WINDOWED = ["prev_heading", "prev_lat", "prev_lon", "avg_speed_15m"]


def rolling_mean(seconds: np.ndarray, values: np.ndarray, reach: int) -> np.ndarray:
    """Mean of the values of the last ``reach`` seconds, both ends included, at each of the
    ascending ``seconds``."""
    first = np.searchsorted(seconds, seconds - reach, side="left")
    after = np.searchsorted(seconds, seconds, side="right")
    sums = np.concatenate([[0.0], np.cumsum(values)])
    return (sums[after] - sums[first]) / (after - first)


class Tracks(StatefulProcessor):
    """Rows of one aircraft (airborne fixes with ``second``) get the window values of the batch
    job. A fix that is not after the last one folded in is passed on as late, without them."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "second long, heading double, latitude double, longitude double")
        self.recent = handle.getListState("recent", "second long, velocity double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values("second", kind="stable")
        last = self.last.get()
        late = batch["second"] <= last[0] if last else np.zeros(len(batch), bool)
        fresh = batch[~late]
        if late.any():
            yield batch[late].assign(**{c: None for c in WINDOWED}, is_late=True)
        if fresh.empty:
            return
        seconds, speeds = fresh["second"].to_numpy(), fresh["velocity"].to_numpy()
        kept = list(self.recent.get()) if last else []
        before = np.array([s for s, _ in kept], np.int64)
        together, values = np.concatenate([before, seconds]), np.concatenate([[v for _, v in kept], speeds])
        mean = rolling_mean(together, values, C.ROLLING_SECONDS)[len(before) :]
        previous = {}
        for name, column, old in zip(WINDOWED, ("heading", "latitude", "longitude"), last[1:] if last else (None,) * 3):
            previous[name] = fresh[column].shift(1)
            previous[name].iloc[0] = old
        yield fresh.assign(**previous, avg_speed_15m=mean, is_late=False)
        end = fresh.iloc[-1]
        self.last.update((int(end["second"]), *(float(end[c]) for c in CARRIED[:3])))
        inside = together >= together[-1] - C.ROLLING_SECONDS
        self.recent.put(list(zip(together[inside].tolist(), values[inside].tolist())))

    def close(self) -> None:
        pass


class TrackFeatures:
    """The stream that writes features to <root>/features. ``checkpoint`` holds its progress and
    state."""

    def __init__(self, root: str, wrap_heading: bool = True):
        self.root = root
        self.wrap_heading = wrap_heading

    def features(self, silver: DataFrame) -> DataFrame:
        with utc(silver.sparkSession):
            fixes = airborne(silver).withColumn("second", F.col("event_timestamp").cast("bigint"))
        schema = ", ".join(f"{c} {kind}" for c, kind in fixes.dtypes)
        schema += "".join(f", {c} double" for c in WINDOWED) + ", is_late boolean"
        found = fixes.groupBy("aircraft_id").transformWithStateInPandas(Tracks(), schema, "Append", "None")
        return describe_fixes(found, self.wrap_heading, keep=["is_late"])

    def start(self, silver: DataFrame, checkpoint: str, **trigger):
        """State lives in RocksDB, whose checkpoints are the changes of each batch; other streams
        keep the session's store."""
        spark = silver.sparkSession
        before = {k: spark.conf.get(k, None) for k in (STORE, CHANGES)}
        spark.conf.set(STORE, ROCKS)
        spark.conf.set(CHANGES, "true")
        try:
            with utc(spark):
                return (
                    self.features(silver)
                    .writeStream.format("parquet")
                    .option("path", f"{self.root}/features")
                    .option("checkpointLocation", checkpoint)
                    .trigger(**(trigger or {"availableNow": True}))
                    .start()
                )
        finally:
            for key, value in before.items():
                spark.conf.unset(key) if value is None else spark.conf.set(key, value)

    def read(self, spark) -> DataFrame:
        return spark.read.parquet(f"{self.root}/features")
