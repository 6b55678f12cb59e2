"""One row per key, and finding keys too busy for one task."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of one key that a single task may sort.
BUSY_ROWS = 1_000_000


def last_per_key(df: DataFrame, keys: list[str | Column], order: list[str]) -> DataFrame:
    """The row of each key that is greatest by ``order``; full ties go to the greatest of the
    remaining columns, so the choice does not depend on partitioning.

    Spark applies the rank limit before the shuffle as well (WindowGroupLimit): however many
    copies a key has, each task sends one row of it.
    """
    named = {k for k in keys if isinstance(k, str)}
    ties = [c for c in df.columns if c not in order and c not in named]
    ranked = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in [*order, *ties]])
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def busy_keys(df: DataFrame, key: str, limit: int = BUSY_ROWS) -> DataFrame | None:
    """Keys with more than ``limit`` rows, staged (at most rows / limit of them), or None. The
    count combines before its shuffle and reads nothing but the key."""
    from skyloom.sources.lake import staged

    counts = df.groupBy(key).agg(F.count("*").alias("_rows"))
    busy = staged(counts.filter(F.col("_rows") > limit).select(key), "busy")
    return None if busy.isEmpty() else busy
