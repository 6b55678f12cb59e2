from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.operators import attributions as a
from skyloom.operators import importance, models, trials


def game(tree, x, known, node=0):
    """The tree's value when only ``known`` features are: both branches by cover where not."""
    f = tree.feature[node]
    if f < 0:
        return tree.value[node]
    left, right = tree.left[node], tree.right[node]
    if f in known:
        return game(tree, x, known, right if x[f] > tree.threshold[node] else left)
    total = tree.cover[node]
    return sum(game(tree, x, known, c) * tree.cover[c] / total for c in (left, right) if tree.cover[c])


def brute(tree, x, features):
    out = np.zeros(features)
    for f in range(features):
        others = [g for g in range(features) if g != f]
        for k in range(features):
            for known in combinations(others, k):
                weight = factorial(k) * factorial(features - k - 1) / factorial(features)
                out[f] += weight * (game(tree, x, {*known, f}) - game(tree, x, set(known)))
    return out


def random_tree(rng, features, depth):
    tree = a.Nodes([], [], [], [], [], [])

    def add(cover, left):
        node = len(tree.feature)
        for name, value in (("feature", -1), ("threshold", 0.0), ("left", 0), ("right", 0), ("value", float(rng.normal())), ("cover", float(cover))):
            getattr(tree, name).append(value)
        if left and cover > 1 and rng.random() < 0.85:
            tree.feature[node], tree.threshold[node] = int(rng.integers(features)), float(np.round(rng.normal(), 1))
            part = int(rng.integers(0, cover + 1))
            tree.left[node] = add(part, left - 1)
            tree.right[node] = add(cover - part, left - 1)
        return node

    add(200, depth)
    return tree


@pytest.mark.parametrize("seed", range(8))
def test_equals_brute_force_over_subsets(seed):
    """Six features, repeated on paths, branches without rows, missing values."""
    rng = np.random.default_rng(seed)
    trees = [random_tree(rng, 6, 6) for _ in range(3)]
    x = np.round(rng.normal(size=(12, 6)), 1)
    x[rng.random(x.shape) < 0.1] = np.nan
    found = a.attributions(trees, x, 6)
    for row, phi in zip(x, found):
        assert np.allclose(phi, sum(brute(t, row, 6) for t in trees), atol=1e-9)
        assert abs(phi.sum() + a.base_value(trees) - sum(game(t, row, set(range(6))) for t in trees)) < 1e-9
    assert abs(a.base_value(trees) - sum(game(t, x[0], set()) for t in trees)) < 1e-9


NAMES = list("abcdef")


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 6)).round(2)
    rows = [(i, *map(float, r), int(r[0] + r[1] * r[2] > 0.2)) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, e double, f double, risk int")


@pytest.mark.parametrize("algorithm", list(models.FAMILIES))
def test_rows_sum_to_their_score(spark, frame, algorithm):
    params = {"numTrees": 5, "maxDepth": 4} if algorithm == "random_forest" else {"maxIter": 5, "maxDepth": 4}
    model = models.fit_classifier(frame, NAMES, "risk", algorithm, params)
    trees, start = a.trees_of(model, spark)
    found = a.tree_contributions(frame, trees, NAMES, start).orderBy("id").toPandas()
    p = models.score_classifier(model, frame).orderBy("id").toPandas()["delay_probability"].to_numpy()
    total = found[NAMES].sum(axis=1).to_numpy() + found["base"].to_numpy()
    if algorithm == "hgb":  # MLlib's probability is that of twice the raw score
        p = np.log(p / (1 - p)) / 2
    elif algorithm != "random_forest":
        p = np.log(p / (1 - p))
    assert np.allclose(total, p, atol=1e-9)
    ranked = trials.top_features(trials.mean_contributions(a.tree_contributions(frame, trees, NAMES, start), NAMES), 3)
    assert {r.feature for r in ranked.collect()} == {"a", "b", "c"}
    mapped = importance.contribution_map(a.tree_contributions(frame, trees, NAMES, start), NAMES).first()
    assert set(mapped.contributions) == set(NAMES)


def test_regressors(spark, frame):
    df = frame.withColumn("y", F.col("a") * 2 + F.col("b"))
    for algorithm in ("lgbm", "random_forest", "hgb"):
        params = {"numTrees": 3, "maxDepth": 3} if algorithm == "random_forest" else {"maxIter": 3, "maxDepth": 3}
        model = models.fit_regressor(df, NAMES, "y", algorithm, params)
        trees, start = a.trees_of(model, spark)
        found = a.tree_contributions(df, trees, NAMES, start).orderBy("id").toPandas()
        score = model.transform(df).orderBy("id").toPandas()["prediction"]
        assert np.allclose(found[NAMES].sum(axis=1) + found["base"], score, atol=1e-9)


def test_edges(spark, frame):
    stump = a.Nodes([-1], [0.0], [0], [0], [2.5], [10.0])
    row = a.tree_contributions(frame.limit(1), [stump], NAMES, 1.0).first()
    assert row.base == 3.5 and all(row[n] == 0.0 for n in NAMES)
    assert a.tree_contributions(frame.limit(0), [stump], NAMES).count() == 0
    nulls = frame.limit(2).withColumn("a", F.lit(None).cast("double"))
    tree = a.Nodes([0, -1, -1], [1.0, 0, 0], [1, 0, 0], [2, 0, 0], [0.0, 1.0, 3.0], [4.0, 1.0, 3.0])
    assert [r.a for r in a.tree_contributions(nulls, [tree], NAMES).collect()] == [1.0 - 2.5] * 2
