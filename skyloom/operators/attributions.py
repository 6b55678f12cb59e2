"""Why a tree model scored a row as it did: path-dependent Shapley values (Lundberg et al., 2018).

A tree's value for a set S of known features follows the row's branch at nodes on a feature of S
and else averages both branches by the rows they held in training. The Shapley values of this
game are sums over leaves. For one leaf the game is a product over the features on its path: a
feature that is known passes (1) or fails (0) all its conditions, one that is not known passes a
share z. Rows that pass the same features have the same values there, so each leaf has a small
table by pass pattern, found in polynomial time, and a row adds up its entries. Trees go to the
tasks with the plan; nothing is shuffled.
"""

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from math import factorial

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.operators.boosting import BoostedModel
from skyloom.sources.lake import fresh_path, remove

# Executors get this module's functions with the task, not from an installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class Nodes:
    """One tree: a leaf has feature -1; values above ``threshold`` go right, missing ones left.
    ``value`` of a leaf is what it adds to the score; ``cover`` is the weight that reached a node."""

    feature: list[int]
    threshold: list[float]
    left: list[int]
    right: list[int]
    value: list[float]
    cover: list[float]


@dataclass
class Leaf:
    """``z`` of each feature on the way, and the interval (above, up to] a known one must lie in;
    missing values count as below all."""

    value: float
    features: np.ndarray
    z: np.ndarray
    above: np.ndarray
    upto: np.ndarray


def leaves(tree: Nodes) -> list[Leaf]:
    out = []

    def walk(node: int, path: dict):
        f = tree.feature[node]
        if f < 0:
            names = sorted(path)
            parts = np.array([path[n] for n in names], float).reshape(-1, 3)
            out.append(Leaf(tree.value[node], np.array(names, int), parts[:, 0], parts[:, 1], parts[:, 2]))
            return
        z, above, upto = path.get(f, (1.0, -np.inf, np.inf))
        for child, low, high in ((tree.left[node], above, min(upto, tree.threshold[node])), (tree.right[node], max(above, tree.threshold[node]), upto)):
            share = tree.cover[child] / tree.cover[node] if tree.cover[node] else 0.0
            walk(child, path | {f: (z * share, low, high)})

    walk(0, {})
    return out


def passes(leaf: Leaf, x: np.ndarray) -> np.ndarray:
    """Whether each row (features on the way x rows) meets each feature's conditions."""
    column = x[:, leaf.features].T
    missing = np.isnan(column)
    fits = (column > leaf.above[:, None]) & (column <= leaf.upto[:, None])
    return np.where(missing, np.isneginf(leaf.above)[:, None], fits)


def shares(one: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Shapley values of the product game for pass patterns ``one`` (patterns x features): for
    each feature, (one - z) times the mean over the orders of the product of the others."""
    many = len(z)
    weights = np.array([factorial(k) * factorial(many - k - 1) / factorial(many) for k in range(many)])
    out = np.empty(one.shape)
    for f in range(many):
        # coefficient k: products with k of the other features known
        known = np.zeros((len(one), many))
        known[:, 0] = 1.0
        for j in range(many):
            if j != f:
                shifted = np.zeros_like(known)
                shifted[:, 1:] = known[:, :-1] * one[:, j : j + 1]
                known = known * z[j] + shifted
        out[:, f] = (one[:, f] - z[f]) * (known @ weights)
    return out


def base_value(trees: list[Nodes], start: float = 0.0) -> float:
    """The score with nothing known: the mean over the training rows."""
    return start + sum(leaf.value * float(leaf.z.prod()) for tree in trees for leaf in leaves(tree))


def attributions(trees: list[Nodes], x: np.ndarray, features: int) -> np.ndarray:
    """Shapley values (rows x features) of rows of values; NaN is missing."""
    out = np.zeros((len(x), features))
    for tree in trees:
        for leaf in leaves(tree):
            if not len(leaf.features):
                continue
            one = passes(leaf, x)
            code = (1 << np.arange(len(one), dtype=object)) @ one if len(one) > 62 else (1 << np.arange(len(one))) @ one
            _, first, back = np.unique(code, return_index=True, return_inverse=True)
            found = leaf.value * shares(one[:, first].T.astype(float), leaf.z)
            out[:, leaf.features] += found[back]
    return out


def trees_of(model, spark) -> tuple[list[Nodes], float]:
    """Trees of the last stage of a fitted pipeline and the score they start from. A boosted
    model's score is its raw one (log odds); MLlib boosting adds up its weighted trees, a forest
    averages the shares of class 1 or the predictions of its trees."""
    stage = model.stages[-1]
    if isinstance(stage, BoostedModel):
        own = stage.trees
        found = []
        for t in own.trees:
            cuts = [own.edges[f][b - 1] if f >= 0 and b > 0 else -np.inf for f, b in zip(t.feature, t.bin)]
            found.append(Nodes(t.feature, cuts, t.left, t.right, t.value, t.cover))
        return found, own.base
    path = fresh_path(spark, "trees")
    stage.write().save(path)
    meta = json.loads(spark.read.text(f"{path}/metadata").first()[0])
    rows = spark.read.parquet(f"{path}/data")
    kinds = dict(rows.dtypes)
    if "nodeData" in kinds:
        rows = rows.select("treeID", "nodeData.*")
    rows = rows.select("treeID", "id", "prediction", "impurityStats", "leftChild", "rightChild", "split").collect()
    forest = "RandomForest" in meta["class"]
    weights = list(stage.treeWeights)
    remove(spark, path)
    by_tree: dict[int, list] = {}
    for row in rows:  # as many as the model has nodes
        by_tree.setdefault(row.treeID, []).append(row)
    found = []
    for number in sorted(by_tree):
        nodes = sorted(by_tree[number], key=lambda r: r.id)
        tree = Nodes([], [], [], [], [], [])
        for r in nodes:
            split, stats = r.split, r.impurityStats
            if split.numCategories >= 0:
                raise ValueError("categorical splits have no threshold")
            inner = r.leftChild >= 0
            classes = forest and "Classification" in meta["class"]
            value = stats[1] / sum(stats) if classes else r.prediction
            share = 1.0 / len(by_tree) if forest else weights[number]
            # a class has its own count; a variance keeps (weight, sum, sum of squares)
            tree.cover.append(float(sum(stats) if classes else stats[0]))
            tree.feature.append(split.featureIndex if inner else -1)
            tree.threshold.append(split.leftCategoriesOrThreshold[0] if inner else 0.0)
            tree.left.append(r.leftChild if inner else 0)
            tree.right.append(r.rightChild if inner else 0)
            tree.value.append(float(value) * share)
        found.append(tree)
    return found, 0.0


def tree_contributions(df: DataFrame, trees: list[Nodes], features: list[str], start: float = 0.0) -> DataFrame:
    """``df`` with each of ``features`` replaced by what it adds to the row's score, and ``base``:
    they sum to the score. A null feature is a missing value and has its contribution too."""
    base = base_value(trees, start)

    @F.pandas_udf("array<double>")
    def explain(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.array([np.asarray(v, float) for v in batch]).reshape(len(batch), len(features))
            yield pd.Series(list(attributions(trees, x, len(features))), dtype=object)

    rows = df.withColumn("_phi", explain(F.array(*[F.col(f).cast("double") for f in features])))
    return rows.withColumns({f: F.col("_phi")[i] for i, f in enumerate(features)}).withColumn("base", F.lit(base)).drop("_phi")
