"""Feature drift between two time slices, and rule-based anomaly signals."""

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyloom import constants as C

PSI_DRIFTED = 0.2
PSI_FLOOR = 1e-4


def quantile_edges(reference: DataFrame, features: list[str], bins: int = 10) -> dict[str, list[float]]:
    """Inner bin edges of each feature at the reference slice's quantiles."""
    probabilities = [i / bins for i in range(1, bins)]
    found = reference.approxQuantile(features, probabilities, 0.001)
    return {f: sorted(set(cuts)) for f, cuts in zip(features, found)}


def psi(
    df: DataFrame, is_current: str, edges: dict[str, list[float]], threshold: float = PSI_DRIFTED
) -> DataFrame:
    """Population stability index per feature: sum of (p - q) ln(p / q) over its bins, shares
    floored at PSI_FLOOR. Nulls are left out. Rows with ``is_current`` are the new slice.

    All features are binned in one pass and counted together; what is shuffled is one row per
    feature and bin.
    """
    features = list(edges)
    binned = df
    for f in features:
        splits = [float("-inf"), *edges[f], float("inf")]
        binned = Bucketizer(
            splits=splits, inputCol=f, outputCol=f"bin_{f}", handleInvalid="keep"
        ).transform(binned.withColumn(f, F.col(f).cast("double")))
    long = binned.select(
        is_current,
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(f).alias("feature"), F.when(F.col(f).isNotNull(), F.col(f"bin_{f}")).alias("bin"))
                    for f in features
                ]
            )
        ),
    ).filter(F.col("bin").isNotNull())
    counts = long.groupBy("feature", "bin").agg(
        F.count_if(F.col(is_current)).alias("current"),
        F.count_if(~F.col(is_current)).alias("reference"),
    )
    totals = counts.groupBy("feature").agg(
        F.sum("current").alias("all_current"),
        F.sum("reference").alias("all_reference"),
        F.collect_list(F.struct("current", "reference")).alias("bins"),
    )
    # A feature's bins are at most the number of its edges + 1.
    share = lambda part, whole: F.greatest(
        F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0)), F.lit(PSI_FLOOR)
    )
    terms = totals.select("feature", "all_current", "all_reference", F.explode("bins").alias("b")).select(
        "feature",
        share(F.col("b.current"), F.col("all_current")).alias("p"),
        share(F.col("b.reference"), F.col("all_reference")).alias("q"),
    )
    return terms.groupBy("feature").agg(
        F.sum((F.col("p") - F.col("q")) * F.ln(F.col("p") / F.col("q"))).alias("psi")
    ).withColumn("drifted", F.col("psi") > threshold)


def drift_decision(per_feature: DataFrame, share: float = C.DRIFT_SHARE) -> DataFrame:
    """Whether enough features drifted to ask for retraining."""
    drifted = F.avg(F.col("drifted").cast("int"))
    return per_feature.agg(
        F.count("*").alias("features"),
        F.count_if("drifted").alias("drifted_features"),
        drifted.alias("drifted_share"),
        F.coalesce(drifted > share, F.lit(False)).alias("retrain"),
    )


SKETCH_K = 1024


def day_sketches(df: DataFrame, day: str, features: list[str], k: int = SKETCH_K) -> DataFrame:
    """(day, feature, rows, sketch): a quantile sketch of every feature and day, nulls left out.
    Sketches merge, so a window of days is read from one small row a day and feature."""
    values = F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]))
    return (
        df.select(F.col(day).alias("day"), values)
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("day", "feature")
        .agg(F.count("*").alias("rows"), F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch"))
    )


def window_sketch(sketches: DataFrame, first: str, last: str, k: int = SKETCH_K) -> DataFrame:
    """(feature, rows, sketch) of the days [first, last]."""
    inside = F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    merged = F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch")
    return sketches.filter(inside).groupBy("feature").agg(F.sum("rows").alias("rows"), merged)


def sketched_psi(reference: DataFrame, current: DataFrame, bins: int = 10, threshold: float = PSI_DRIFTED) -> DataFrame:
    """``psi`` between two window sketches over bins at the reference's quantiles. A share is off
    by the rank error of the sketches (about 2.3 / k for each end of a bin)."""
    cuts = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    edges = reference.select("feature", F.kll_sketch_get_quantile_double("sketch", cuts).alias("edges")).collect()  # a row a feature
    both = reference.select("feature", F.col("sketch").alias("old")).join(
        current.select("feature", F.col("sketch").alias("new")), "feature"
    )
    own = F.lit(None).cast("struct<old: array<double>, new: array<double>>")
    for row in edges:
        found = F.array(*[F.lit(e) for e in sorted(set(row.edges))])
        ranks = F.struct(*[F.kll_sketch_get_rank_double(s, found).alias(s) for s in ("old", "new")])
        own = F.when(F.col("feature") == row.feature, ranks).otherwise(own)
    both = both.select("feature", own.alias("ranks"))

    def shares(ranks):
        upto = F.concat(F.array(F.lit(0.0)), ranks, F.array(F.lit(1.0)))
        return F.transform(F.sequence(F.lit(1), F.size(upto) - 1), lambda i: F.greatest(upto[i] - upto[i - 1], F.lit(PSI_FLOOR)))

    terms = F.zip_with(shares(F.col("ranks.new")), shares(F.col("ranks.old")), lambda p, q: (p - q) * F.ln(p / q))
    total = F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)
    return both.select("feature", total.alias("psi")).withColumn("drifted", F.col("psi") > threshold)


def performance_drop(
    daily: DataFrame, metric: str, day: str, by: list[str] | None = None, burn_in: int = 7,
    slack: float = 0.5, alarm: float = 5.0, higher_is_better: bool = True,
) -> DataFrame:
    """Sequential test (one-sided CUSUM; Page, 1954) of a metric's drop below its first ``burn_in``
    days. Each later day adds by how many of their standard deviations, less ``slack``, it is worse
    than their mean; the sum never falls below 0 and ``dropped`` is true where it exceeds ``alarm``.

    Adds ``cusum`` and ``dropped`` to the days after the burn-in (one row a day and ``by``). The
    running sum less its least value so far is the recursion in closed form. Days without a metric
    are left out; a burn-in without spread counts as one of spread 1."""
    groups = by or []
    in_time = Window.partitionBy(*groups).orderBy(day)
    so_far = in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*groups)
    known = daily.filter(F.col(metric).isNotNull()).withColumn("_n", F.row_number().over(in_time))
    first = F.when(F.col("_n") <= burn_in, F.col(metric))
    spread = F.stddev_pop(first).over(whole)
    known = known.withColumns({"_mean": F.avg(first).over(whole), "_spread": F.when(spread > 0, spread).otherwise(F.lit(1.0))})
    worse = (F.col("_mean") - F.col(metric)) * (1 if higher_is_better else -1) / F.col("_spread") - slack
    late = known.filter(F.col("_n") > burn_in).withColumn("_sum", F.sum(worse).over(so_far))
    cusum = F.col("_sum") - F.least(F.lit(0.0), F.min("_sum").over(so_far))
    out = late.withColumn("cusum", cusum).withColumn("dropped", F.col("cusum") > alarm)
    return out.drop("_n", "_mean", "_spread", "_sum")


# Only the 90 degree jump is a published figure; the other limits are ours.
HEADING_JUMP = 90.0
SPEED_LIMITS = (50.0, 320.0)
CLIMB_LIMIT = 25.0
STALL_DISTANCE_KM = 1.0


def anomaly_rules(flights: DataFrame) -> DataFrame:
    """Heuristic flags per fix and how many fired; unknown values raise no flag."""
    cruising = F.col("altitude_m") > C.CRUISE_ALTITUDE_M
    moved = F.col("distance_10m_km")
    rules = {
        "heading_jump": F.col("heading_change_5m") > HEADING_JUMP,
        "odd_speed": cruising & ~F.col("speed_ms").between(*SPEED_LIMITS),
        "odd_climb": F.abs("vertical_rate_ms") > CLIMB_LIMIT,
        "stalled": cruising & (moved > 0) & (moved < STALL_DISTANCE_KM),
    }
    flagged = flights.withColumns(
        {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}
    )
    fired = sum((F.col(name).cast("int") for name in rules), F.lit(0))
    return flagged.withColumn("signals", fired)
