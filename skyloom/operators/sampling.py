"""Seeded samples, splits and folds from a hash of the row key.

The hash does not depend on partitioning or on what else is in the table, so a rerun or a
retried task makes the same choice. Keys must identify rows.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom import constants as C
from skyloom.functions.flight import key_hash
from skyloom.sources.lake import broadcast_within, fits, staged

PREFIX = 4  # hex digits of the histogram: 65,536 buckets
MAX_STRATA = 10_000


def mark_smallest(
    df: DataFrame, keys: list[str], wanted_of, seed: int = C.SEED, strata: str | None = None
) -> DataFrame:
    """``df`` plus boolean ``picked``: the rows with the smallest hashes of each stratum, as
    many as ``wanted_of(count column)`` says.

    A histogram over hash prefixes finds the bucket of the last row wanted. Only that bucket,
    1/65,536 of its stratum, is sorted to find the exact hash to cut at. ``df`` is read three
    times, so pass a stored or staged table.
    """
    stratum = stratum_of(strata) if strata else F.lit("")
    keyed = df.withColumns({"_stratum": stratum, "_hash": key_hash(keys, seed)})
    prefix = F.substring("_hash", 1, PREFIX).alias("_prefix")
    histogram = staged(
        keyed.groupBy("_stratum", prefix).agg(F.count("*").alias("_n")), "hash_histogram"
    )
    # What is joined back below has one row per stratum.
    few = not strata or fits(histogram.select("_stratum").distinct(), MAX_STRATA)
    small = F.broadcast if few else (lambda table: table)
    whole = Window.partitionBy("_stratum")
    total = F.sum("_n").over(whole)
    wanted = F.least(total, wanted_of(total)).cast("bigint")
    upto = F.sum("_n").over(whole.orderBy("_prefix"))
    edge = (
        histogram.withColumns({"_wanted": wanted, "_upto": upto})
        .filter((F.col("_upto") >= F.col("_wanted")) & (F.col("_upto") - F.col("_n") < F.col("_wanted")))
        .select("_stratum", "_prefix", (F.col("_wanted") - F.col("_upto") + F.col("_n")).alias("_place"))
    )
    cutoffs = (
        keyed.select("_stratum", "_hash", prefix)
        .join(small(edge), ["_stratum", "_prefix"])
        .withColumn("_rank", F.row_number().over(whole.orderBy("_hash")))
        .filter(F.col("_rank") == F.col("_place"))
        .select("_stratum", F.col("_hash").alias("_cutoff"))
    )
    return (
        keyed.join(small(cutoffs), "_stratum", "left")
        .withColumn("picked", F.coalesce(F.col("_hash") <= F.col("_cutoff"), F.lit(False)))
        .drop("_stratum", "_hash", "_cutoff")
    )


def hash_sample(
    df: DataFrame, keys: list[str], rows: int, seed: int = C.SEED, strata: str | None = None
) -> DataFrame:
    """Exactly ``rows`` rows (all, if there are fewer), in total or per stratum."""
    marked = mark_smallest(df, keys, lambda total: F.lit(rows), seed, strata)
    return marked.filter("picked").drop("picked")


def split(
    df: DataFrame,
    keys: list[str],
    test_size: float = C.TEST_SIZE,
    seed: int = C.SEED,
    stratify: str | None = None,
) -> DataFrame:
    """``df`` plus ``is_test``; with ``stratify`` every class gives the same share, to the row."""
    # decimal arithmetic, so that e.g. 15 % of 20 rows is 3
    share = F.lit(str(test_size)).cast("decimal(10,9)")
    marked = mark_smallest(df, keys, lambda total: F.round(total * share), seed, stratify)
    return marked.withColumnRenamed("picked", "is_test")


def split_by_time(df: DataFrame, at: str, first_test_day: str) -> DataFrame:
    """Rows of ``first_test_day`` and later are the test part: no look into the future."""
    return df.withColumn("is_test", F.col(at) >= F.lit(first_test_day).cast("timestamp"))


def folds(
    df: DataFrame, keys: list[str], k: int = C.CV_FOLDS, seed: int = C.SEED, stratify: str | None = None
) -> DataFrame:
    """``df`` plus ``fold`` in 0..k-1. Plain folds go by each row's own hash. With ``stratify``
    the sizes of a class (null is one) differ by one row at most: rows take turns in the order
    of their hashes. A class is ordered bucket by bucket, and only bucket totals are added up."""
    if stratify is None:
        number = F.conv(F.substring(key_hash(keys, seed), 1, 8), 16, 10).cast("bigint")
        return df.withColumn("fold", F.pmod(number, F.lit(k)).cast("int"))
    rows = df.withColumns({"_stratum": stratum_of(stratify), "_hash": key_hash(keys, seed)})
    rows = rows.withColumn("_bucket", F.substring("_hash", 1, PREFIX))
    sizes = staged(rows.groupBy("_stratum", "_bucket").agg(F.count("*").alias("_n")), "fold_buckets")
    before = Window.partitionBy("_stratum").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_stratum", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_stratum", "_bucket").orderBy("_hash")) - 1
    numbered = rows.withColumn("_place", place).join(starts, ["_stratum", "_bucket"])
    return numbered.withColumn("fold", F.pmod(F.col("_start") + F.col("_place"), F.lit(k)).cast("int")).select(
        *df.columns, "fold"
    )


def stratum_of(column: str) -> Column:
    """A class as text; null is a class of its own, told apart from every text."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def fold_count(positives: int, wanted: int = C.CV_FOLDS) -> int:
    """Fewer folds when there are few positives, never fewer than two."""
    return min(wanted, max(2, positives))


def scaling_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: mean and population deviation per column, 1 in place of a zero deviation."""
    stats = []
    for c in columns:
        spread = F.stddev_pop(c)
        stats.append(
            F.struct(
                F.avg(c).alias("mean"),
                F.when(spread > 0, spread).otherwise(F.lit(1.0)).alias("spread"),
            ).alias(c)
        )
    return df.agg(F.struct(*stats).alias("stats"))


def standardise(df: DataFrame, columns: list[str], stats: DataFrame | None = None) -> DataFrame:
    """(x - mean) / deviation. Pass stored ``stats`` to scale new rows like the old ones."""
    found = (scaling_stats(df, columns) if stats is None else stats).scalar()
    scaled = {c: (F.col(c) - F.col("_s")[c]["mean"]) / F.col("_s")[c]["spread"] for c in columns}
    return df.withColumn("_s", found).withColumns(scaled).drop("_s")


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """Adds ``weight`` = rows / (classes * rows of the class). Null is a class of its own."""
    counts = staged(df.groupBy(F.col(label).alias("_label")).agg(F.count("*").alias("class_rows")), "class_counts")
    total = counts.agg(F.sum("class_rows")).scalar()
    classes = counts.agg(F.count("*")).scalar()
    return (
        df.join(broadcast_within(counts, MAX_STRATA), F.col(label).eqNullSafe(F.col("_label")))
        .withColumn("weight", total / (classes * F.col("class_rows")))
        .drop("class_rows", "_label")
    )
