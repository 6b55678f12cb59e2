"""Delay classifier and congestion regressor as pipelines, and their search."""

import math
import random
from functools import partial
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom import constants as C
from skyloom.functions.flight import clip01
from skyloom.operators.boosting import BoostedClassifier, BoostedRegressor
from skyloom.operators.sampling import balanced_weights
from skyloom.operators.trials import regression_trial_scores, trial_scores
from skyloom.sources.lake import fresh_path, staged

CLASSIFIERS = {
    "leafwise": partial(BoostedClassifier, growth="leaf"),
    "levelwise": partial(BoostedClassifier, growth="level"),
    "symmetric": partial(BoostedClassifier, growth="symmetric"),
    "boosted": GBTClassifier,
    "random_forest": RandomForestClassifier,
    "linear": LogisticRegression,
}
REGRESSORS = {
    "leafwise": partial(BoostedRegressor, growth="leaf"),
    "levelwise": partial(BoostedRegressor, growth="level"),
    "symmetric": partial(BoostedRegressor, growth="symmetric"),
    "boosted": GBTRegressor,
    "random_forest": RandomForestRegressor,
    "linear": LinearRegression,
}
# Five published families. Three grow second-order trees in different ways, one is
# MLlib's first-order boosting and one its forest.
FAMILIES = {
    "lgbm": "leafwise",
    "xgboost": "levelwise",
    "catboost": "symmetric",
    "random_forest": "random_forest",
    "hgb": "boosted",
}
# Search bounds, as (low, high, scale) or a list of choices.
SEARCH_SPACE = {
    "lgbm": {
        "maxIter": (100, 800, "int"),
        "stepSize": (0.01, 0.3, "log"),
        "maxLeaves": (20, 150, "int"),
        "maxDepth": (3, 12, "int"),
        "minInstancesPerNode": (10, 100, "int"),
        "subsamplingRate": (0.5, 1.0, "real"),
        "regAlpha": (1e-4, 10.0, "log"),
        "regLambda": (1e-4, 10.0, "log"),
    },
    "xgboost": {
        "maxIter": (100, 800, "int"),
        "stepSize": (0.01, 0.3, "log"),
        "maxDepth": (3, 10, "int"),
        "minChildWeight": (1, 20, "int"),
        "subsamplingRate": (0.5, 1.0, "real"),
        "featureRate": (0.5, 1.0, "real"),
        "minSplitGain": (0.0, 5.0, "real"),
        "regAlpha": (1e-4, 10.0, "log"),
        "regLambda": (1e-4, 10.0, "log"),
        "positiveWeight": (1.0, 10.0, "real"),
    },
    "catboost": {
        "maxIter": (100, 600, "int"),
        "stepSize": (0.01, 0.3, "log"),
        "maxDepth": (3, 10, "int"),
        "regLambda": (1e-3, 10.0, "log"),
        "maxBins": (32, 255, "int"),
        "baggingTemperature": (0.0, 1.0, "real"),
    },
    "random_forest": {
        "numTrees": (100, 500, "int"),
        "maxDepth": (3, 20, "int"),
        "minInstancesPerNode": (1, 10, "int"),
        "featureSubsetStrategy": ["sqrt", "log2", "0.5"],
    },
    "hgb": {
        "maxIter": (100, 500, "int"),
        "stepSize": (0.01, 0.3, "log"),
        "maxDepth": (3, 12, "int"),
        "minInstancesPerNode": (10, 100, "int"),
        "maxBins": (64, 255, "int"),
    },
}
BALANCED = {"lgbm", "catboost", "random_forest", "hgb"}


def draw_params(algorithm: str, rng: random.Random, effort: float = 1.0) -> dict:
    """One random setting. ``effort`` scales the numbers of rounds and trees, because distributed
    boosting runs its rounds one after another."""
    params = {}
    for name, bounds in SEARCH_SPACE[algorithm].items():
        if isinstance(bounds, list):
            params[name] = rng.choice(bounds)
            continue
        low, high, scale = bounds
        if scale == "int":
            value = rng.randint(low, high)
            if name in ("maxIter", "numTrees"):
                value = max(1, round(value * effort))
            params[name] = value
        elif scale == "log":
            params[name] = math.exp(rng.uniform(math.log(low), math.log(high)))
        else:
            params[name] = rng.uniform(low, high)
    return params


def resolve(algorithm: str, default: str = "lgbm") -> str:
    return algorithm if algorithm in FAMILIES else default


def estimator(registry: dict, algorithm: str, label: str, params: dict, weight: str | None = None):
    family = FAMILIES.get(algorithm, algorithm)
    built = registry[family](labelCol=label, featuresCol="features")
    if "seed" in {p.name for p in built.params}:
        params = {"seed": C.SEED, **params}
    built = built.setParams(**params)
    return built.setWeightCol(weight) if weight else built


def fit_classifier(
    train: DataFrame,
    features: list[str],
    label: str = "delay_risk",
    algorithm: str = "lgbm",
    params: dict | None = None,
    balanced: bool | None = None,
) -> PipelineModel:
    """Assembler and classifier as one saveable model; classes weigh the same if ``balanced``."""
    if balanced if balanced is not None else algorithm in BALANCED:
        train, weight = balanced_weights(train, label), "weight"
    else:
        weight = None
    return _fit(train, features, estimator(CLASSIFIERS, algorithm, label, params or {}, weight))


def fit_regressor(
    train: DataFrame,
    features: list[str],
    target: str = "congestion_score",
    algorithm: str = "lgbm",
    params: dict | None = None,
) -> PipelineModel:
    return _fit(train, features, estimator(REGRESSORS, algorithm, target, params or {}))


def _fit(train, features, model) -> PipelineModel:
    pipeline = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"), model])
    fitted = pipeline.fit(train)
    if not getattr(fitted.stages[-1], "hasSummary", False):
        return fitted
    # A training summary holds the session, which cannot travel to the executors once the
    # session has observed metrics. A saved model has none.
    path = fresh_path(train.sparkSession, "model")
    fitted.write().save(path)
    return PipelineModel.load(path)


def score_classifier(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` plus ``delay_probability`` of the positive class."""
    probability = vector_to_array("probability")[1]
    return model.transform(df).select(*df.columns, probability.alias("delay_probability"))


def score_regressor(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` plus ``prediction`` clipped to [0, 1]."""
    return model.transform(df).select(*df.columns, clip01(F.col("prediction")).alias("prediction"))


def importances(model: PipelineModel, features: list[str], spark) -> DataFrame | None:
    """Impurity importance per feature; None for a model that has none."""
    found = getattr(model.stages[-1], "featureImportances", None)
    if found is None:
        return None
    values = [float(v) for v in found.toArray()]
    return spark.createDataFrame(list(zip(features, values)), "feature string, importance double")


#: Parameters that count rounds or trees, and the share of trials that a rung promotes.
BUDGETS = ("maxIter", "numTrees")
PROMOTED = 1 / 3


def search(
    frame: DataFrame,
    features: list[str],
    target: str,
    kind: str = "classifier",
    algorithms: list[str] | None = None,
    trials: int = C.TRIALS,
    seed: int = C.SEED,
    effort: float = 1.0,
    parallelism: int = 4,
    rungs: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """Random settings, every family having its turn before one comes up again, each fitted once per fold of ``frame``'s column
    ``fold``. Gives (settings, scored): every held-out row scored once per trial, with
    columns trial, algorithm, fold and label/score or target/prediction.

    With ``rungs`` the search halves (Jamieson and Talwalkar, 2016): all trials are fitted with a
    3**-rungs share of their rounds or trees, and the best third by mean fold score goes on with
    three times as many, until those left are fitted in full. ``settings`` says the last ``rung``
    of each trial (the full fits have the greatest), and the scored rows of a trial are those of
    it; compare trials of the greatest rung only.

    A trial's scored rows go straight to a staged table; what meets in the driver is the
    list of settings and, between rungs, a score of each trial.
    """
    spark = frame.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        # MLlib's boosting cuts its lineage there, which otherwise grows with every round.
        spark.sparkContext.setCheckpointDir(fresh_path(spark, "search_rounds"))
    frame = staged(frame, "search_frame")
    fold_numbers = [r[0] for r in frame.select("fold").distinct().orderBy("fold").collect()]
    rng = random.Random(seed)
    names = algorithms or list(FAMILIES)
    settings = []
    for number in range(trials):
        algorithm = names[number % len(names)]
        settings.append((number, algorithm, draw_params(algorithm, rng, effort)))
    root = fresh_path(spark, "trial_scores")

    def run(job):
        (number, algorithm, params), fold, rung = job
        share = 3.0 ** (rung - rungs)
        params = {k: max(1, math.ceil(v * share)) if k in BUDGETS else v for k, v in params.items()}
        train, held = frame.filter(F.col("fold") != fold), frame.filter(F.col("fold") == fold)
        if kind == "classifier":
            model = fit_classifier(train, features, target, algorithm, params)
            rows = score_classifier(model, held).select(
                F.col(target).alias("label"), F.col("delay_probability").alias("score")
            )
        else:
            model = fit_regressor(train, features, target, algorithm, params)
            rows = score_regressor(model, held).select(F.col(target).alias("target"), "prediction")
        rows.select(
            F.lit(number).alias("trial"), F.lit(algorithm).alias("algorithm"), F.lit(fold).alias("fold"), "*"
        ).write.parquet(f"{root}/rung-{rung}-trial-{number}-fold-{fold}")

    def paths(which, rung):
        return [f"{root}/rung-{rung}-trial-{s[0]}-fold-{fold}" for s in which for fold in fold_numbers]

    going, last = settings, {}
    for rung in range(rungs + 1):
        with ThreadPool(parallelism) as pool:
            pool.map(inheritable_thread_target(spark)(run), [(s, fold, rung) for s in going for fold in fold_numbers])
        last.update({s[0]: rung for s in going})
        if rung < rungs and len(going) > 1:
            score = trial_scores if kind == "classifier" else regression_trial_scores
            found = {r.trial: r.score for r in score(spark.read.parquet(*paths(going, rung))).collect()}
            ranked = sorted(going, key=lambda s: (-found.get(s[0], -math.inf), s[0]))
            going = sorted(ranked[: max(1, math.ceil(len(going) * PROMOTED))])
    table = spark.createDataFrame(
        [(n, a, {k: str(v) for k, v in p.items()}, last[n]) for n, a, p in settings],
        "trial int, algorithm string, params map<string,string>, rung int",
    )
    return table, spark.read.parquet(*[p for s in settings for p in paths([s], last[s[0]])])
