import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from skyloom.operators import boosting as b
from skyloom.operators import models


def data(n=2000, features=5, seed=0, kind="logistic"):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 40, (n, features)) / 4.0
    x[rng.random(x.shape) < 0.05] = np.nan
    z = np.nan_to_num(x, nan=3.0)
    target = z[:, 0] - 2 * (z[:, 1] > 4) * z[:, 2] + rng.normal(size=n)
    y = (target > np.median(target)).astype(float) if kind == "logistic" else target
    return x, y, rng.integers(1, 4, n).astype(float)


EDGES = [[1.0, 2.5, 4.0, 5.25, 7.0, 9.0]] * 5


def plain_gradients(raw, y, w, s):
    if s.kind == "squared":
        return (raw - y) * w, w
    p = 1 / (1 + np.exp(-raw))
    return (p - y) * w, p * (1 - p) * w


def plain_best(x, g, h, rows, s):
    """The best split of a node, trying every cut of every feature one by one."""
    def score(g, h):
        return max(abs(g) - s.l1, 0) ** 2 / (h + s.l2)

    best = (0.0, None, None)
    for f in range(x.shape[1]):
        for cut in [None, *EDGES[f]]:
            left = np.isnan(x[rows, f]) | (False if cut is None else x[rows, f] <= cut)
            a, c = rows[left], rows[~left]
            if min(len(a), len(c)) < s.min_rows or min(h[a].sum(), h[c].sum()) < s.min_hessian:
                continue
            gain = 0.5 * (score(g[a].sum(), h[a].sum()) + score(g[c].sum(), h[c].sum()) - score(g[rows].sum(), h[rows].sum())) - s.gamma
            if gain > best[0] + 1e-9:
                best = (gain, a, c)
    return best


def plain_boosting(x, y, w, s, base):
    """Strict growth, a leaf or a level at a time. Gives the scores after all rounds and the
    values of the leaves in the order of their rows."""
    raw, values = np.full(len(y), base), []
    for _ in range(s.rounds):
        g, h = plain_gradients(raw, y, w, s)
        leaves = [(np.arange(len(y)), 0)]
        if s.growth == "leaf":
            while len(leaves) < s.leaves:
                found = [(plain_best(x, g, h, rows, s), k) for k, (rows, d) in enumerate(leaves) if d < s.depth]
                (gain, a, c), k = max(found, key=lambda z: z[0][0])
                if gain <= 0:
                    break
                d = leaves.pop(k)[1]
                leaves += [(a, d + 1), (c, d + 1)]
        else:
            for _ in range(s.depth):
                fresh = []
                for rows, d in leaves:
                    gain, a, c = plain_best(x, g, h, rows, s)
                    fresh += [(a, d + 1), (c, d + 1)] if gain > 0 else [(rows, s.depth)]
                leaves = fresh
        for rows, _ in leaves:
            total = g[rows].sum()
            value = -np.sign(total) * max(abs(total) - s.l1, 0) / (h[rows].sum() + s.l2) * s.rate
            raw[rows] += value
            values.append(value)
    return raw, values


def fitted(spark, x, y, w, s, edges=EDGES):
    rows = [(i, [None if np.isnan(v) else float(v) for v in r], float(t), float(u), i) for i, (r, t, u) in enumerate(zip(x, y, w))]
    df = spark.createDataFrame(rows, "id long, x array<double>, y double, w double, k long").repartition(5)
    return b.fit(df, s, edges), df


@pytest.mark.parametrize("kind", ["logistic", "squared"])
@pytest.mark.parametrize("growth", ["leaf", "level"])
def test_trees_equal_a_plain_version(spark, kind, growth):
    x, y, w = data(kind=kind)
    s = b.Settings(kind, growth, rounds=3, rate=0.3, depth=3, leaves=6, min_rows=15, l2=0.7, l1=0.2, gamma=0.05)
    model, df = fitted(spark, x, y, w, s)
    raw, values = plain_boosting(x, y, w, s, model.base)
    assert np.allclose(model.raw(x), raw, atol=1e-4)
    ours = sorted(t.value[n] for t in model.trees for n, f in enumerate(t.feature) if f < 0)
    assert np.allclose(ours, sorted(values), atol=1e-4)
    scored = b.raw_scores(df, model, "x", "raw").orderBy("id").select("raw").toPandas()["raw"]
    assert np.allclose(scored, raw, atol=1e-4)
    for t in model.trees:
        assert t.cover[0] == len(y) and all(t.cover[n] == t.cover[t.left[n]] + t.cover[t.right[n]] for n, f in enumerate(t.feature) if f >= 0)


def test_symmetric_trees_split_a_level_alike(spark):
    x, y, w = data()
    model, _ = fitted(spark, x, y, w, b.Settings(growth="symmetric", rounds=2, depth=3))
    for t in model.trees:
        level, seen = [0], 0
        while any(t.feature[n] >= 0 for n in level):
            assert len({(t.feature[n], t.bin[n]) for n in level}) == 1
            level, seen = [c for n in level for c in (t.left[n], t.right[n])], seen + 1
        assert seen == 3
    g, h = plain_gradients(np.full(len(y), model.base), y, w, model.settings)
    gains = {}
    for f in range(5):
        for bin, cut in enumerate([None, *EDGES[f]]):
            left = np.isnan(x[:, f]) | (False if cut is None else x[:, f] <= cut)
            gains[f, bin] = sum(g[part].sum() ** 2 / (h[part].sum() + 1) for part in (left, ~left))
    assert (model.trees[0].feature[0], model.trees[0].bin[0]) == max(gains, key=gains.get)


@pytest.mark.parametrize("growth", ["leaf", "level", "symmetric"])
def test_many_tasks_give_the_trees_of_one(spark, monkeypatch, growth):
    """To the bit, with random rows, features and weights."""
    x, y, w = data(800)
    s = b.Settings(growth=growth, rounds=4, depth=4, leaves=9, rows=0.7, features=0.6, temperature=0.5, positive=2.0)
    one, _ = fitted(spark, x, y, w, s)
    monkeypatch.setattr(b, "TASK_CELLS", 0)
    monkeypatch.setattr(b, "KEPT_TREES", 2)
    monkeypatch.setattr(b, "GROUP_NODES", 3)
    many, _ = fitted(spark, x, y, w, s)
    assert one.dumps() == many.dumps()


def test_edge_cases(spark):
    nothing = spark.createDataFrame([], "x array<double>, y double, w double, k long")
    with pytest.raises(ValueError, match="no rows"):
        b.fit(nothing, b.Settings())
    rows = [([1.0, None], 1.0, 1.0, 1), ([float("nan"), 2.0], None, 1.0, 2), ([3.0, 4.0], 0.0, 0.0, 3)]
    model = b.fit(spark.createDataFrame(rows, nothing.schema), b.Settings(rounds=2))
    assert [len(t.feature) for t in model.trees] == [1, 1] and model.importances().sum() == 0
    same = [([1.0], float(i % 2), 1.0, i) for i in range(20)]
    model = b.fit(spark.createDataFrame(same, nothing.schema), b.Settings(rounds=1, growth="symmetric"))
    assert model.trees[0].feature == [-1] and model.base == 0.0
    big = [([float(i)], 1e9 * (i % 2), 1.0, i) for i in range(40)]
    model = b.fit(spark.createDataFrame(big, nothing.schema), b.Settings("squared", rounds=30, rate=0.5, l2=0.0, bins=40))
    assert np.allclose(model.raw(np.array([[4.0], [5.0]])), [0.0, 1e9], rtol=1e-2, atol=1e7)


def test_missing_values_go_left(spark):
    rows = [([None if i % 2 else 5.0], float(i % 2), 1.0, i) for i in range(200)]
    model = b.fit(spark.createDataFrame(rows, "x array<double>, y double, w double, k long"), b.Settings(rounds=1), [[1.0]])
    assert model.trees[0].bin[0] == 0
    low, high = model.raw(np.array([[5.0], [np.nan]]))
    assert low < 0 < high


@pytest.mark.parametrize("algorithm", ["lgbm", "xgboost", "catboost"])
def test_families_differ_and_survive_saving(spark, tmp_path, algorithm):
    x, y, _ = data(1500)
    z = np.nan_to_num(x, nan=3.0)
    df = spark.createDataFrame([(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(z, y))], "id long, a double, b double, c double, d double, e double, risk int")
    model = models.fit_classifier(df, list("abcde"), "risk", algorithm, {"maxIter": 5, "maxDepth": 4})
    assert model.stages[-1].trees.settings.growth == {"lgbm": "leaf", "xgboost": "level", "catboost": "symmetric"}[algorithm]
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    a, c = (models.score_classifier(m, df).orderBy("id").select("delay_probability").collect() for m in (model, again))
    assert a == c
    right = sum((r[0] > 0.5) == (t > 0.5) for r, t in zip(a, y)) / len(y)
    assert right > 0.8
    ranked = models.importances(model, list("abcde"), spark).orderBy(F.desc("importance")).collect()
    assert {r.feature for r in ranked[:3]} == {"a", "b", "c"} and abs(sum(r.importance for r in ranked) - 1) < 1e-9


def test_rows_travel_in_blocks(monkeypatch):
    """A task's small batches become few blocks, which hold every row with its bins."""
    import pandas as pd

    monkeypatch.setattr(b, "BLOCK_ROWS", 25)
    rows = pd.DataFrame({"x": [[i / 2, None, -i] for i in range(70)], "y": np.arange(70.0), "w": 2.0, "k": range(70)})
    edges = [[3.0, 9.0], [1.0], [-20.0]]
    stored = pd.concat(list(b.blocks((rows[i : i + 10] for i in range(0, 70, 10)), edges)))
    held = list(b.opened(stored, 3, 0.5))
    assert [len(h["y"]) for h in held] == [30, 30, 10]
    assert np.concatenate([h["k"] for h in held]).tolist() == list(range(70))
    expected = b.bins_of(np.array([[i / 2, np.nan, -i] for i in range(70)]), edges)
    assert (np.concatenate([h["x"] for h in held], axis=1) == expected).all()
    assert all((h["raw"] == 0.5).all() and (h["w"] == 2).all() for h in held)
