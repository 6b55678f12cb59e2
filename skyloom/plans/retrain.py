"""Retraining: sample, split, search, fit, score the hold-out, decide on promotion.

Labels are a rule on speed, height and airport load, and the congestion score is a share of
the aircraft count, so models that see those inputs score close to 1; that says nothing
about delays.
"""

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom import constants as C
from skyloom.operators import (
    anomaly, attributions, gates, importance, isolation, labels, metrics, models, sampling, trials,
)
from skyloom.plans.jobs import stage
from skyloom.sources import lake

FLIGHT_KEYS = ["aircraft_id", "event_timestamp"]
AIRPORT_KEYS = ["airport_code", "event_timestamp"]


@dataclass(frozen=True)
class Task:
    """One model product."""

    name: str
    kind: str
    features: list[str]
    target: str
    keys: list[str]
    max_rows: int
    stratify: bool


DELAY = Task("delay", "classifier", C.DELAY_FEATURES, "delay_risk", FLIGHT_KEYS, C.DELAY_MAX_ROWS, True)
CONGESTION = Task(
    "congestion", "regressor", C.CONGESTION_FEATURES, "congestion_score", AIRPORT_KEYS, C.CONGESTION_MAX_ROWS, False
)


def prepare(task: Task, table: DataFrame, allow_missing: bool = False) -> DataFrame:
    """Complete rows marked ``is_test``; staged. The whole table is split first: the hold-out is
    all of its share, and so is a regressor's training part. Of a classifier's training part
    ``max_rows`` rows are kept."""
    if task is CONGESTION:
        table = labels.congestion_training_columns(table)
    frame = labels.training_frame(table, task.features, task.target, task.keys, allow_missing)
    frame = lake.staged(frame, f"{task.name}_frame")
    if frame.limit(C.MIN_TRAIN_ROWS).count() < C.MIN_TRAIN_ROWS:
        raise lake.NotEnoughData(f"fewer than {C.MIN_TRAIN_ROWS} complete rows for {task.name}")
    marked = sampling.split(frame, task.keys, stratify=task.target if task.stratify else None)
    parts = lake.staged(marked, f"{task.name}_parts")
    if task.kind != "classifier":
        return parts
    train = sampling.hash_sample(parts.filter("not is_test"), task.keys, task.max_rows, C.SEED + 1)
    return lake.staged(train.unionByName(parts.filter("is_test")), f"{task.name}_bounded")


def tune(task: Task, parts: DataFrame, n_trials: int = C.TRIALS, effort: float = 1.0, rungs: int = 2):
    """(best algorithm, its settings, scores of the trials fitted in full) over the training part.
    The search halves over ``rungs``; with 0 every trial is fitted in full."""
    train = lake.staged(parts.filter("not is_test").drop("is_test"), "tune_rows")
    k, stratify = C.CV_FOLDS, None
    if task.kind == "classifier":
        k = sampling.fold_count(train.filter(F.col(task.target) == 1).count())
        stratify = task.target
    used = [c for c in task.features if c in train.columns]
    folded = sampling.folds(train, task.keys, k, stratify=stratify)
    settings, scored = models.search(folded, used, task.target, task.kind, trials=n_trials, effort=effort, rungs=rungs)
    whole = settings.filter(F.col("rung") == rungs).select("trial")
    scored = scored.join(F.broadcast(whole), "trial")
    score = trials.trial_scores if task.kind == "classifier" else trials.regression_trial_scores
    scores = lake.staged(score(scored), "trial_scores")
    best = trials.best_trial(scores).first()
    drawn = settings.filter(F.col("trial") == best.trial).first().params
    return best.algorithm, {k: _number(v) for k, v in drawn.items()}, scores


def _number(text: str):
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            continue
    return text


def fit(task: Task, parts: DataFrame, algorithm: str = "lgbm", params: dict | None = None) -> PipelineModel:
    train = parts.filter("not is_test")
    used = [c for c in task.features if c in parts.columns]
    fitter = models.fit_classifier if task.kind == "classifier" else models.fit_regressor
    return fitter(train, used, task.target, models.resolve(algorithm), params)


def scored(task: Task, model: PipelineModel, rows: DataFrame) -> DataFrame:
    """label/score or target/prediction beside the keys."""
    if task.kind == "classifier":
        out = models.score_classifier(model, rows)
        return out.select(*task.keys, F.col(task.target).alias("label"), F.col("delay_probability").alias("score"))
    out = models.score_regressor(model, rows)
    return out.select(*task.keys, F.col(task.target).alias("target"), "prediction")


def train(
    spark, task: Task, table: DataFrame, model_path: str, run_id: str, metrics_path: str | None = None,
    algorithm: str = "lgbm", params: dict | None = None, explain: bool = True,
) -> tuple[dict, DataFrame]:
    """Fit on the training part, save the pipeline, record hold-out metrics and what the model
    leans on. Gives (record, hold-out rows)."""
    with stage(spark, f"train_{task.name}", run_id, metrics_path, keep_staged=True) as record:
        parts = prepare(task, table)
        model = fit(task, parts, algorithm, params)
        model.write().overwrite().save(model_path)
        holdout = parts.filter("is_test").drop("is_test")
        rows = lake.staged(scored(task, model, holdout), f"{task.name}_scored")
        if task.kind == "classifier":
            found = metrics.auc(rows).first().asDict() | metrics.confusion(rows).first().asDict()
        else:
            found = metrics.regression(rows).first().asDict()
        record["metrics"].update(found)
        if explain:
            ranked = explained(task, model, holdout)
            top = trials.top_features(ranked.withColumnRenamed("importance", "mean_abs"), C.EXPLAIN_TOP)
            record["artifacts"]["top_features"] = ",".join(r.feature for r in top.collect())
        record["artifacts"]["model"] = model_path
    return record, holdout


def reasons(task: Task, model: PipelineModel, rows: DataFrame) -> DataFrame | None:
    """``rows`` with each feature replaced by what it adds to the row's score, and ``base``; for
    a boosted model the score is the raw one. None for a model that is not of trees."""
    used = [c for c in task.features if c in rows.columns]
    if not hasattr(model.stages[-1], "featureImportances"):
        return None
    trees, start = attributions.trees_of(model, rows.sparkSession)
    return attributions.tree_contributions(rows, trees, used, start)


def explained(task: Task, model: PipelineModel, rows: DataFrame) -> DataFrame:
    """(feature, importance) on the hold-out rows: the mean size of the contributions for models
    of trees, else the drop in AUC or R² when the feature is permuted."""
    used = [c for c in task.features if c in rows.columns]
    contributions = reasons(task, model, rows)
    if contributions is not None:
        return trials.mean_contributions(contributions, used).withColumnRenamed("mean_abs", "importance")
    variants = importance.permuted_variants(rows, task.keys, used)
    if task.kind == "classifier":
        out = models.score_classifier(model, variants)
        per_variant = metrics.auc(out, task.target, "delay_probability", ["variant"])
        return importance.metric_drop(per_variant, "auc")
    out = models.score_regressor(model, variants)
    return importance.metric_drop(metrics.regression(out, task.target, by=["variant"]), "r2")


def decide(task: Task, holdout: DataFrame, candidate_path: str, champion_path: str | None = None) -> DataFrame:
    """Gate row: both models on the same hold-out rows."""
    sides = None
    for role, path in ((gates.CANDIDATE, candidate_path), (gates.CHAMPION, champion_path)):
        if path is None:
            continue
        rows = scored(task, PipelineModel.load(path), holdout).withColumn(gates.ROLE, F.lit(role))
        sides = rows if sides is None else sides.unionByName(rows)
    sides = lake.staged(sides, f"{task.name}_sides")
    return gates.delay_gate(sides) if task.kind == "classifier" else gates.congestion_gate(sides)


def train_anomaly(
    spark, flights: DataFrame, model_path: str, run_id: str, metrics_path: str | None = None,
    trees: int = C.FOREST_TREES, contamination: float = C.CONTAMINATION,
) -> tuple[dict, DataFrame]:
    """Scale, fit an isolation forest, save both, score all rows. Gives (record, scores)."""
    with stage(spark, "train_anomaly", run_id, metrics_path, keep_staged=True) as record:
        frame = lake.staged(
            labels.training_frame(flights, C.ANOMALY_FEATURES, keep=FLIGHT_KEYS), "anomaly_frame"
        )
        scaling = lake.staged(sampling.scaling_stats(frame, C.ANOMALY_FEATURES), "scaling")
        ready = sampling.standardise(frame, C.ANOMALY_FEATURES, scaling)
        forest = isolation.fit_forest(ready, FLIGHT_KEYS, C.ANOMALY_FEATURES, trees)
        isolation.save_forest(forest, scaling, model_path)
        flagged = isolation.flag_anomalies(
            isolation.forest_scores(ready, forest), contamination=contamination
        ).select(*FLIGHT_KEYS, "anomaly_score", "prediction", "is_anomaly")
        record["metrics"].update(metrics.anomaly(flagged).first().asDict())
        record["artifacts"]["model"] = model_path
    return record, flagged


def tune_anomaly(frame: DataFrame, n_trials: int = C.TRIALS, effort: float = 1.0, reference: DataFrame | None = None) -> DataFrame:
    """Scores of detector settings over all rows of a stored, standardised frame. ``reference``
    are the rows the outlier factor compares with, if not all."""
    _, found = anomaly.search(
        frame, FLIGHT_KEYS, C.ANOMALY_FEATURES, trials=n_trials, effort=effort, reference=reference
    )
    return anomaly.trial_scores(found)
