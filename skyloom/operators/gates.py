"""Promotion decisions from hold-out rows scored by candidate and champion."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom import constants as C
from skyloom.operators import metrics

ROLE = "role"
CANDIDATE, CHAMPION = "candidate", "champion"


def promote(candidate: Column, champion: Column, floors: Column) -> Column:
    """Meets the floors, and strictly beats the champion if there is one."""
    return F.coalesce(floors, F.lit(False)) & F.coalesce(candidate > champion, champion.isNull())


def delay_gate(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """``scored`` holds the same hold-out rows once per role."""
    quality = metrics.auc(scored, label, score, [ROLE]).join(
        metrics.confusion(scored, label, score, by=[ROLE]), ROLE
    )
    sides = _sides(quality, ["auc", "f1"])
    floors = (F.col("candidate_auc") >= C.MIN_AUC) & (F.col("candidate_f1") >= C.MIN_F1)
    return _decision(sides, "delay", "auc", floors)


def congestion_gate(scored: DataFrame, target: str = "target", prediction: str = "prediction") -> DataFrame:
    sides = _sides(metrics.regression(scored, target, prediction, [ROLE]), ["r2"])
    return _decision(sides, "congestion", "r2", F.col("candidate_r2") >= C.MIN_R2)


def anomaly_gate(scored: DataFrame) -> DataFrame:
    """Always promoted: unsupervised scores have no floor. The mean score is reported."""
    sides = _sides(scored.groupBy(ROLE).agg(F.avg("score").alias("mean")), ["mean"])
    return sides.select(
        F.lit("anomaly").alias("model"),
        F.col("candidate_mean").alias("candidate_metric"),
        F.col("champion_mean").alias("champion_metric"),
        F.lit(True).alias("promote"),
    )


def all_gates(delay: DataFrame, congestion: DataFrame, anomaly: DataFrame) -> DataFrame:
    return delay.unionByName(congestion).unionByName(anomaly)


def _sides(quality, names):
    picks = [
        F.max(F.when(F.col(ROLE) == role, F.col(n))).alias(f"{role}_{n}")
        for role in (CANDIDATE, CHAMPION)
        for n in names
    ]
    return quality.agg(*picks)


def _decision(sides, model, metric, floors):
    candidate, champion = F.col(f"{CANDIDATE}_{metric}"), F.col(f"{CHAMPION}_{metric}")
    return sides.select(
        F.lit(model).alias("model"),
        candidate.alias("candidate_metric"),
        champion.alias("champion_metric"),
        promote(candidate, champion, floors).alias("promote"),
    )
