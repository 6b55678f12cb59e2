"""Reading and writing tables: shared staging, partitioned parquet, size-checked broadcast."""

import functools
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skyloom.constants import AIRPORTS
from skyloom.operators.keyed import last_per_key
from skyloom.sources.schemas import AIRPORT_SCHEMA, SILVER_PARTITIONS

MAX_DAYS = 100_000
MAX_BROADCAST_BYTES = 64 << 20

_local_dirs: dict[str, str] = {}
_open_scratch: list[list[str]] = []


class NotEnoughData(Exception):
    """A job's input or output is missing or below its floor."""


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. Only a session that is one process may fall back to a
    temporary one; a cluster of processes, on one machine too, may not."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="skyloom-")
    return _local_dirs[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/skyloom/{app}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, survives lost
    executors, and gives the planner true sizes."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    if _open_scratch:
        _open_scratch[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession):
    """Deletes what was staged inside when it ends. For jobs that return no table."""
    _open_scratch.append([])
    try:
        yield
    finally:
        for path in _open_scratch.pop():
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(location, True)


@contextmanager
def utc(spark: SparkSession):
    """Days and hours are UTC whatever the session's zone. Spark binds the zone when an
    expression is analysed, so tables described inside keep it."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def in_utc(build):
    """Decorates a function of a DataFrame (or of ``self`` and one) that describes a table."""

    @functools.wraps(build)
    def wrapped(*args, **kwargs):
        df = next(a for a in args if isinstance(a, DataFrame))
        with utc(df.sparkSession):
            return build(*args, **kwargs)

    return wrapped


def broadcast_within(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint only after measuring that ``df`` has at most ``max_rows`` rows and
    MAX_BROADCAST_BYTES. Call it on tables that are cheap to read (dimensions, staged tables)."""
    return F.broadcast(df) if fits(df, max_rows) else df


def fits(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether rows and bytes (of text; eight for any other value) are within the bounds."""
    width = F.lit(0)
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            width += F.coalesce(F.octet_length(column), F.lit(0))
        elif kind.startswith(("array", "map", "struct")):
            width += F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
        width += 8
    found = df.limit(max_rows + 1).agg(F.count("*").alias("n"), F.sum(width).alias("size")).first()
    return found.n <= max_rows and (found.size or 0) <= max_bytes


def airports(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(AIRPORTS, AIRPORT_SCHEMA)


def exists(spark: SparkSession, path: str) -> bool:
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(location)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the first-level partition ``column``, from the folder names."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(location):
        return []
    names = [f.getPath().getName() for f in store.listStatus(location) if f.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


def read_table(spark: SparkSession, path: str, name: str = "table") -> DataFrame:
    """Parquet directory; a missing or empty one is an error with the table's name."""
    if not exists(spark, path):
        raise NotEnoughData(f"no {name} files at {path}")
    df = spark.read.parquet(path)
    if df.isEmpty():
        raise NotEnoughData(f"no {name} rows at {path}")
    return df


def read_days(spark: SparkSession, path: str, first: str | None, last: str | None) -> DataFrame:
    """Silver rows of the days [first, last] (yyyy-MM-dd), pruned by partition."""
    df = read_table(spark, path, "silver")
    day_number = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
    if first:
        df = df.filter(day_number >= int(first.replace("-", "")))
    if last:
        df = df.filter(day_number <= int(last.replace("-", "")))
    return df


def write_partitioned(df: DataFrame, path: str, partitions: list[str]) -> None:
    """Replace exactly the partitions present in ``df``; rerunning a batch is harmless. Rows
    are gathered by partition first, and adaptive execution splits a large one over tasks, so
    that neither tiny files nor one giant task come of it."""
    (
        df.hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def replace_days(df: DataFrame, path: str, column: str, first: str | None, last: str | None) -> None:
    """Write ``df`` by the date ``column`` and drop the stored days of [first, last] (all, where a
    side is open) that it has no rows for. Days outside that ``df`` has are replaced too."""
    spark = df.sparkSession
    seen = Observation()
    days = F.collect_set(F.col(column).cast("string")).alias("days")
    write_partitioned(df.observe(seen, days), path, [column])
    for day in set(partition_values(spark, path, column)) - set(seen.get["days"]):
        if (first or "") <= day <= (last or "9999"):
            remove(spark, f"{path}/{column}={day}")


def append_partitioned(df: DataFrame, path: str, partitions: list[str] | None = None) -> None:
    partitions = partitions or SILVER_PARTITIONS
    df.hint("rebalance", *partitions).write.mode("append").partitionBy(*partitions).parquet(path)


def days_of(new: DataFrame, partitions: list[str]) -> list:
    """The distinct partitions of a staged table: as many as the days a batch touches."""
    found = new.select(*partitions).distinct().limit(MAX_DAYS + 1).collect()
    if len(found) > MAX_DAYS:
        raise ValueError(f"a batch touches more than {MAX_DAYS} partitions")
    return found


def in_days(df: DataFrame, partitions: list[str], days: list) -> DataFrame:
    """The rows of ``days``, as literal predicates, so that no other partition is listed."""
    *outer, inner = partitions
    groups: dict[tuple, list] = {}
    for day in days:
        groups.setdefault(tuple(day[c] for c in outer), []).append(day[inner])
    wanted = F.lit(False)
    for values, inners in groups.items():
        one = F.col(inner).isin(inners)
        for column, value in zip(outer, values):
            one &= F.col(column) == value
        wanted |= one
    return df.filter(wanted)


def merge_partitioned(new: DataFrame, path: str, partitions: list[str], keys: list[str], order: list[str]) -> None:
    """Rows of ``new`` and the rows already there in the partitions it touches: of each key the
    greatest by ``order`` stays, whichever came first. ``new`` must be staged; merging it again
    changes nothing."""
    spark = new.sparkSession
    if not exists(spark, path):
        write_partitioned(last_per_key(new, keys, order), path, partitions)
        return
    old = in_days(spark.read.schema(new.schema).parquet(path), partitions, days_of(new, partitions))
    merged = last_per_key(new.unionByName(old.select(*new.columns)), keys, order)
    write_partitioned(staged(merged, "merge"), path, partitions)


def write_table(df: DataFrame, path: str) -> None:
    """Overwrite a gold table. Adaptive execution sizes the output files."""
    df.write.mode("overwrite").parquet(path)
