"""Summaries over scored trials: per fold, per trial, per algorithm."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.operators import metrics


def trial_scores(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Mean fold AUC of each (trial, algorithm) from rows carrying trial, algorithm, fold."""
    per_fold = metrics.auc(scored, label, score, ["trial", "algorithm", "fold"])
    return metrics.fold_mean(per_fold, "auc", ["trial", "algorithm"]).withColumnRenamed("auc", "score")


def regression_trial_scores(scored: DataFrame, empty: float = -999.0) -> DataFrame:
    per_fold = metrics.regression(scored, by=["trial", "algorithm", "fold"])
    return metrics.fold_mean(per_fold, "r2", ["trial", "algorithm"], empty).withColumnRenamed("r2", "score")


def algorithm_summary(trials: DataFrame, algorithms: list[str], empty: float = 0.0) -> DataFrame:
    """Best and mean score and number of trials of every algorithm, tried or not."""
    names = trials.sparkSession.createDataFrame([(a,) for a in algorithms], "algorithm string")
    tried = trials.groupBy("algorithm").agg(
        F.max("score").alias("best_score"),
        F.avg("score").alias("mean_score"),
        F.count("*").alias("n_trials"),
    )
    return names.join(tried, "algorithm", "left").select(
        "algorithm",
        F.round(F.coalesce("best_score", F.lit(empty)), 4).alias("best_score"),
        F.round(F.coalesce("mean_score", F.lit(empty)), 4).alias("mean_score"),
        F.coalesce("n_trials", F.lit(0)).alias("n_trials"),
    )


def best_trial(trials: DataFrame) -> DataFrame:
    """The trial with the highest score, the earliest of equals."""
    best = F.max_by(F.struct("trial", "algorithm", "score"), F.struct("score", -F.col("trial")))
    return trials.agg(best.alias("best")).select("best.*")


def mean_contributions(contributions: DataFrame, features: list[str]) -> DataFrame:
    """Mean absolute contribution per feature column."""
    return contributions.agg(*[F.avg(F.abs(f)).alias(f) for f in features]).unpivot(
        [], features, "feature", "mean_abs"
    )


def top_features(ranked: DataFrame, n: int) -> DataFrame:
    return ranked.orderBy(F.desc("mean_abs"), "feature").limit(n)
