"""What a model leans on: permutation importance and linear contributions."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyloom import constants as C
from skyloom.operators.sampling import scaling_stats
from skyloom.sources.lake import staged

BLOCK_ROWS = 10_000
WHOLE = "(none)"


def permuted(df: DataFrame, keys: list[str], features: list[str], seed: int = C.SEED) -> DataFrame:
    """``df`` plus ``other``, the features of another random row. Rows fall into blocks of
    about BLOCK_ROWS by a hash of their (unique) key; in a block, in hash order, each row
    takes the next one's values and the last takes the first one's."""
    blocks = max(1, df.count() // BLOCK_ROWS)
    h = F.xxhash64(*keys, F.lit(seed))
    in_block = Window.partitionBy("_block").orderBy("_h", *keys)
    whole = in_block.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    values = F.struct(*features)
    return (
        df.withColumn("_h", h)
        .withColumn("_block", F.pmod("_h", F.lit(blocks)))
        .withColumn("other", F.coalesce(F.lead(values).over(in_block), F.first(values).over(whole)))
        .drop("_h", "_block")
    )


def permuted_variants(df: DataFrame, keys: list[str], features: list[str], seed: int = C.SEED) -> DataFrame:
    """Each row once as it is (``variant`` = WHOLE) and once per feature with that feature
    permuted, so that one scoring pass serves all of them."""
    variants = F.explode(F.array(*[F.lit(v) for v in [WHOLE, *features]]))
    swapped = {
        f: F.when(F.col("variant") == f, F.col(f"other.{f}")).otherwise(F.col(f)) for f in features
    }
    return (
        permuted(df, keys, features, seed)
        .withColumn("variant", variants)
        .withColumns(swapped)
        .drop("other")
    )


def metric_drop(per_variant: DataFrame, metric: str) -> DataFrame:
    """Importance = metric on untouched rows minus metric with the feature permuted."""
    per_variant = staged(per_variant.select("variant", metric), "variant_metrics")
    base = per_variant.filter(F.col("variant") == WHOLE).select(metric).scalar()
    return per_variant.filter(F.col("variant") != WHOLE).select(
        F.col("variant").alias("feature"), (base - F.col(metric)).alias("importance")
    )


def linear_contributions(df: DataFrame, coefficients: dict[str, float]) -> DataFrame:
    """Replaces each feature by its contribution: coefficient * (value - mean)."""
    means = scaling_stats(df, list(coefficients)).scalar()
    parts = {
        f: F.lit(float(w)) * (F.col(f) - F.col("_s")[f]["mean"]) for f, w in coefficients.items()
    }
    return df.withColumn("_s", means).withColumns(parts).drop("_s")


def contribution_map(contributions: DataFrame, features: list[str], digits: int = 6) -> DataFrame:
    """Adds ``contributions``: feature name -> rounded contribution."""
    pairs = F.map_from_arrays(
        F.array(*[F.lit(f) for f in features]),
        F.transform(F.array(*[F.col(f) for f in features]), lambda v: F.round(v, digits)),
    )
    return contributions.withColumn("contributions", pairs)


def linear_coefficients(model, features: list[str]) -> dict[str, float]:
    """Coefficients of a fitted linear pipeline by feature."""
    return dict(zip(features, (float(v) for v in model.stages[-1].coefficients)))
