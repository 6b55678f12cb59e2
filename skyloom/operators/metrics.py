"""Model metrics over scored rows, per group of columns ``by`` (none for the whole table)."""

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyloom.sources.lake import staged

RANGES = 256


def auc(
    scored: DataFrame, label: str = "label", score: str = "score", by: list[str] | None = None
) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; null where a class is missing.

    Rows collapse to one per distinct score first, and these are staged, so scoring runs
    once. Distinct scores are cut at their
    quantiles into RANGES ranges, each range is summed up on its own, and the ranges'
    totals (at most RANGES rows per group) are put in order last.
    """
    by = by or []
    known = scored.filter(F.col(label).isNotNull() & F.col(score).isNotNull() & ~F.isnan(score))
    counts = known.groupBy(*by, F.col(score).cast("double").alias("s")).agg(
        F.count_if(F.col(label) == 1).cast("double").alias("pos"),
        F.count_if(F.col(label) == 0).cast("double").alias("neg"),
    )
    per_score = staged(counts, "scores")
    probabilities = [i / RANGES for i in range(1, RANGES)]
    cuts = sorted(set(per_score.approxQuantile("s", probabilities, 0.5 / RANGES)))
    edges = [float("-inf"), *cuts, float("inf")]
    ranged = Bucketizer(splits=edges, inputCol="s", outputCol="range").transform(per_score)
    upward = Window.partitionBy(*by, "range").orderBy("s")
    before = F.sum("neg").over(upward.rowsBetween(Window.unboundedPreceding, -1))
    per_range = (
        ranged.withColumn("below", F.coalesce(before, F.lit(0.0)))
        .groupBy(*by, "range")
        .agg(
            F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2)).alias("won"),
            F.sum("pos").alias("pos"),
            F.sum("neg").alias("neg"),
        )
    )
    over_ranges = Window.partitionBy(*(by or [F.lit(0)])).orderBy("range")
    earlier = F.sum("neg").over(over_ranges.rowsBetween(Window.unboundedPreceding, -1))
    total = (
        per_range.withColumn("earlier", F.coalesce(earlier, F.lit(0.0)))
        .groupBy(*by)
        .agg(
            F.sum(F.col("won") + F.col("pos") * F.col("earlier")).alias("won"),
            F.sum("pos").alias("positives"),
            F.sum("neg").alias("negatives"),
        )
    )
    return total.select(
        *by,
        F.try_divide("won", F.col("positives") * F.col("negatives")).alias("auc"),
        F.col("positives").cast("bigint").alias("positives"),
        F.col("negatives").cast("bigint").alias("negatives"),
    )


def confusion(
    scored: DataFrame,
    label: str = "label",
    score: str = "score",
    threshold: float = 0.5,
    by: list[str] | None = None,
) -> DataFrame:
    """Accuracy, precision, recall and F1; 0 where a denominator is empty."""
    said = F.col(score) > threshold
    true = F.col(label) == 1
    counts = scored.groupBy(*(by or [])).agg(
        F.count_if(said & true).alias("tp"),
        F.count_if(said & ~true).alias("fp"),
        F.count_if(~said & true).alias("fn"),
        F.count_if(~said & ~true).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        *(by or []), "tp", "fp", "fn", "tn",
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def regression(
    scored: DataFrame, target: str = "target", prediction: str = "prediction", by: list[str] | None = None
) -> DataFrame:
    """RMSE, MAE and R² of one pass; R² is null when the target does not vary."""
    error = F.col(prediction) - F.col(target)
    sums = scored.groupBy(*(by or [])).agg(
        F.count("*").alias("n"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(target).alias("spread"),
    )
    return sums.select(
        *(by or []), "n", F.sqrt("mse").alias("rmse"), "mae",
        (F.lit(1.0) - F.try_divide("mse", "spread")).alias("r2"),
    )


def anomaly(
    scored: DataFrame, flag: str = "is_anomaly", score: str = "anomaly_score", by: list[str] | None = None
) -> DataFrame:
    """Flagged rows and their share, mean score and its population deviation."""
    return scored.groupBy(*(by or [])).agg(
        F.count_if(flag).alias("anomaly_count"),
        F.avg(F.col(flag).cast("int")).alias("anomaly_rate"),
        F.avg(score).alias("mean_score"),
        F.stddev_pop(score).alias("score_spread"),
    )


def fold_mean(per_fold: DataFrame, score: str, by: list[str], empty: float = 0.0) -> DataFrame:
    """Mean over folds; folds without a value (one class only, NaN) do not count, and a trial
    with none gets ``empty``."""
    value = F.when(~F.isnan(score), F.col(score))
    return per_fold.groupBy(*by).agg(F.coalesce(F.avg(value), F.lit(empty)).alias(score))


def _ratio(top, bottom):
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))
