"""Raw position reports: parsing positional vectors, landing batches, reading them back."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.sources.lake import in_utc, partition_values
from skyloom.sources.schemas import BRONZE_SCHEMA, STATE_FIELDS, WHOLE_NUMBERS


def read_bronze(
    spark: SparkSession, path: str, multi_line: bool = False,
    first_day: str | None = None, last_day: str | None = None,
) -> DataFrame:
    """JSON batches under any depth of folders, or those landed on the ingest days
    [first_day, last_day] (yyyy-MM-dd), of which only the folders are listed. A bad scalar
    becomes null and its row stays. Landed files are JSON lines, which Spark can split;
    ``multi_line`` reads one pretty-printed object per file instead."""
    reader = _bronze_reader(spark.read, multi_line)
    if first_day is None and last_day is None:
        return reader.json(path)
    folders = [
        f"{path}/year={y}/month={m}/day={d}"
        for y in partition_values(spark, path, "year")
        for m in partition_values(spark, f"{path}/year={y}", "month")
        for d in partition_values(spark, f"{path}/year={y}/month={m}", "day")
        if (first_day or "") <= f"{y}-{m}-{d}" <= (last_day or "9999-99-99")
    ]
    return reader.json(folders) if folders else spark.createDataFrame([], BRONZE_SCHEMA)


def stream_bronze(
    spark: SparkSession, path: str, files_per_batch: int = 1000, multi_line: bool = False
) -> DataFrame:
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    return _bronze_reader(reader, multi_line).json(path)


def _bronze_reader(reader, multi_line):
    return (
        reader.schema(BRONZE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("multiLine", str(multi_line).lower())
    )


def parse_states(raw: DataFrame, body: str = "value", keep: list[str] | None = None) -> DataFrame:
    """One row per state vector of each raw response in column ``body``.

    Values go by position; short vectors are padded with nulls, null vectors and responses
    without vectors give no rows, and callsigns lose their padding.
    """
    kept = [F.col(c) for c in keep or []]
    reply = F.from_json(body, "time double, states array<array<string>>")
    vectors = raw.select(*kept, reply.alias("reply")).select(
        *kept,
        F.col("reply.time").cast("bigint").alias("fetch_timestamp"),
        F.explode("reply.states").alias("v"),
    )
    return vectors.filter(F.col("v").isNotNull()).select(
        *kept, "fetch_timestamp", *_fields(F.col("v"))
    )


def parse_batches(raw: DataFrame, body: str, run_time: str) -> DataFrame:
    """One bronze envelope per raw response: parsed states that carry a position, their
    number, how many others were dropped, and the response's time (the run's when it has none). Works inside each row,
    so a response is never taken apart and regrouped."""
    reply = F.from_json(body, "time double, states array<array<string>>")
    parsed = F.transform(
        F.filter(F.coalesce("reply.states", F.array().cast("array<array<string>>")), F.isnotnull),
        lambda v: F.struct(*_fields(v)),
    )
    placed = F.filter(
        parsed, lambda s: s["latitude"].isNotNull() & s["longitude"].isNotNull()
    )
    run_seconds = F.unix_timestamp(run_time).cast("double")
    return raw.withColumn("reply", reply).select(
        F.coalesce("reply.time", run_seconds).alias("fetch_timestamp"),
        F.col(run_time).alias("ingest_timestamp"),
        F.size(placed).alias("aircraft_count"),
        (F.size(parsed) - F.size(placed)).alias("dropped_count"),
        placed.alias("states"),
    )


def _fields(vector):
    return [_field(vector, i, name, kind) for i, (name, kind) in enumerate(STATE_FIELDS)]


def _field(vector, position, name, kind):
    text = F.try_element_at(vector, F.lit(position + 1))
    if name == "callsign":
        return F.trim(text).alias(name)
    if kind == "string":
        return text.alias(name)
    if name in WHOLE_NUMBERS:
        return text.try_cast("double").try_cast(kind).alias(name)
    return text.try_cast(kind).alias(name)


def validate_states(states: DataFrame) -> DataFrame:
    """States that carry a position."""
    return states.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


@in_utc
def land_bronze(batches: DataFrame, path: str) -> None:
    """JSON lines under zero-padded year=/month=/day= folders of the ingest time."""
    at = F.col("ingest_timestamp")
    (
        batches.select(
            "fetch_timestamp", "ingest_timestamp", "aircraft_count", "states",
            F.date_format(at, "yyyy").alias("year"),
            F.date_format(at, "MM").alias("month"),
            F.date_format(at, "dd").alias("day"),
        )
        .write.mode("append").partitionBy("year", "month", "day").json(path)
    )


def batch_path(root: str, at) -> str:
    """Folder-and-file name of one landed batch, for single-file writers."""
    return f"{root}/year={at:%Y}/month={at:%m}/day={at:%d}/batch_{at:%Y%m%d_%H%M%S}.json"
