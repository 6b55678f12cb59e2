import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from skyloom import constants as C
from skyloom.operators import anomaly, importance, isolation, metrics, models, neighbours, sampling, trials


@pytest.fixture(scope="module")
def delay(spark):
    """Seeded uniform inputs and a target that leans on two of them."""
    df = spark.range(600).select(
        "id",
        *[(F.rand(i) * 300).alias(c) for i, c in enumerate(C.DELAY_FEATURES)],
    )
    risky = (F.col("speed_ms") < 120) & (F.col("altitude_m") > 60)
    df = df.withColumn("delay_risk", risky.cast("int"))
    return spark.createDataFrame(df.toPandas())


SMALL = {name: {"maxIter": 3, "maxDepth": 3, "stepSize": 0.5} for name in models.FAMILIES.values()}
SMALL["random_forest"] = {"numTrees": 3, "maxDepth": 4}


@pytest.mark.parametrize("algorithm", list(models.FAMILIES))
def test_classifiers(spark, delay, algorithm):
    model = models.fit_classifier(delay, C.DELAY_FEATURES, algorithm=algorithm, params=SMALL[models.FAMILIES[algorithm]])
    out = models.score_classifier(model, delay)
    assert out.filter(~F.col("delay_probability").between(0, 1)).count() == 0 and out.count() == 600
    assert metrics.auc(out, "delay_risk", "delay_probability").first().auc > 0.8
    ranked = models.importances(model, C.DELAY_FEATURES, spark).orderBy(F.desc("importance")).limit(2).collect()
    assert {r.feature for r in ranked} == {"speed_ms", "altitude_m"}


def test_model_survives_saving(spark, delay, tmp_path):
    model = models.fit_classifier(delay, C.DELAY_FEATURES, params=SMALL["boosted"])
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    a, b = (models.score_classifier(m, delay).orderBy("id").select("delay_probability").collect() for m in (model, again))
    assert a == b


@pytest.mark.parametrize("algorithm", ["lgbm", "random_forest"])
def test_regressors_are_clipped(spark, delay, algorithm):
    df = delay.withColumn("congestion_score", F.col("aircraft_count_50km") / 300)
    model = models.fit_regressor(df, ["aircraft_count_50km", "speed_ms"], algorithm=algorithm, params=SMALL[models.FAMILIES[algorithm]])
    out = models.score_regressor(model, df)
    assert out.filter(~F.col("prediction").between(0, 1)).count() == 0
    assert metrics.regression(out, "congestion_score").first().r2 > 0.5


def test_linear_model_contributions(spark, delay):
    df = delay.withColumn("y", 2 * F.col("speed_ms") - 3 * F.col("altitude_m"))
    model = models.fit_regressor(df, ["speed_ms", "altitude_m"], "y", "linear")
    weights = importance.linear_coefficients(model, ["speed_ms", "altitude_m"])
    assert weights == pytest.approx({"speed_ms": 2.0, "altitude_m": -3.0}, abs=1e-3)
    parts = importance.linear_contributions(df, weights)
    assert importance.contribution_map(parts, list(weights)).first().contributions.keys() == weights.keys()
    ranked = trials.top_features(trials.mean_contributions(parts, list(weights)), 1).collect()
    assert [r.feature for r in ranked] == ["altitude_m"]
    assert models.importances(model, ["speed_ms", "altitude_m"], spark) is None


def test_search_scores_every_row_once_per_trial(spark, delay):
    frame = sampling.folds(delay, ["id"], 2)
    settings, scored = models.search(frame, C.DELAY_FEATURES, "delay_risk", algorithms=["lgbm", "random_forest"], trials=2, effort=0.01)
    assert scored.count() == 2 * 600
    best = trials.best_trial(trials.trial_scores(scored)).first()
    assert best.score > 0.6 and settings.filter(F.col("trial") == best.trial).first().params


def test_halving_finds_what_the_full_search_finds(spark, delay):
    """Six trials, a third of which go on at each rung; the last one left is the best of all."""
    frame = sampling.folds(delay, ["id"], 2)
    asked = dict(features=C.DELAY_FEATURES, target="delay_risk", algorithms=["lgbm", "xgboost", "catboost"], trials=6, effort=0.06)
    settings, scored = models.search(frame, **asked)
    full = {r.trial: r.score for r in trials.trial_scores(scored).collect()}
    halved, rows = models.search(frame, **asked, rungs=2)
    rung = {r.trial: r.rung for r in halved.collect()}
    assert sorted(rung.values()) == [0, 0, 0, 0, 1, 2] and {r.rung for r in settings.collect()} == {0}
    assert rows.groupBy("trial").count().filter("count != 600").count() == 0
    (left,) = [t for t, r in rung.items() if r == 2]
    last = {r.trial: r.score for r in trials.trial_scores(rows.filter(F.col("trial") == left)).collect()}
    assert last[left] == pytest.approx(full[left]) and full[left] >= max(full.values()) - 0.01


def test_drawn_params_fit_mllib():
    import random

    rng = random.Random(0)
    for name in models.FAMILIES:
        params = models.draw_params(name, rng)
        assert set(params) == set(models.SEARCH_SPACE[name])
    assert models.resolve("nonsense") == "lgbm" and models.resolve("hgb") == "hgb"


def test_permutation_finds_the_inputs_that_matter(spark, delay):
    model = models.fit_classifier(delay, C.DELAY_FEATURES, params=SMALL["boosted"])
    variants = importance.permuted_variants(delay, ["id"], C.DELAY_FEATURES)
    assert variants.count() == 600 * (1 + len(C.DELAY_FEATURES))
    per_variant = metrics.auc(models.score_classifier(model, variants), "delay_risk", "delay_probability", ["variant"])
    ranked = importance.metric_drop(per_variant, "auc").orderBy(F.desc("importance")).collect()
    assert {r.feature for r in ranked[:2]} == {"speed_ms", "altitude_m"} and ranked[-1].importance == 0.0


@pytest.mark.parametrize("block_rows", [10_000, 50])
def test_permuting_keeps_each_column_whole(spark, delay, monkeypatch, block_rows):
    monkeypatch.setattr(importance, "BLOCK_ROWS", block_rows)
    out = importance.permuted(delay, ["id"], ["speed_ms"]).select("speed_ms", F.col("other.speed_ms").alias("o")).collect()
    assert sorted(r.speed_ms for r in out) == sorted(r.o for r in out)
    assert sum(r.speed_ms != r.o for r in out) > 550


@pytest.fixture(scope="module")
def normal(spark):
    rng = np.random.default_rng(42)
    x = rng.normal(size=(1000, 5))
    x[0] = 9.0
    rows = [(i, *map(float, v)) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "id bigint, a double, b double, c double, d double, e double")


FEATURES = list("abcde")


def test_forest_rate_and_planted_outlier(spark, normal, tmp_path):
    forest = isolation.fit_forest(normal, ["id"], FEATURES, trees=50)
    out = isolation.flag_anomalies(isolation.forest_scores(normal, forest))
    row = metrics.anomaly(out).first()
    assert 0.03 <= row.anomaly_rate <= 0.07
    assert out.orderBy("anomaly_score").first().id == 0
    assert {r.prediction for r in out.select("prediction").distinct().collect()} == {-1, 1}
    scaling = sampling.scaling_stats(normal, FEATURES)
    isolation.save_forest(forest, scaling, str(tmp_path / "f"))
    again, stats = isolation.load_forest(spark, str(tmp_path / "f"))
    a, b = (isolation.forest_scores(normal, f).orderBy("id").select("isolation_score").collect() for f in (forest, again))
    assert a == b and stats.first() == scaling.first()


def test_forest_does_not_depend_on_partitioning(spark, normal):
    a, b = (
        isolation.forest_scores(normal, isolation.fit_forest(normal.repartition(n), ["id"], FEATURES, trees=5)).orderBy("id").select("isolation_score").collect()
        for n in (1, 6)
    )
    assert a == b


def test_forest_tree_shape():
    x = np.random.default_rng(0).normal(size=(256, 3))
    nodes = isolation.grow(x, np.arange(3), np.random.default_rng(1))
    leaves = [n for n in nodes if n[1] < 0]
    assert len(nodes) == 2 * len(leaves) - 1 and max(n[5] for n in leaves) < 20
    assert isolation.grow(np.ones((9, 2)), np.arange(2), np.random.default_rng(1))[0][1] == -1
    assert isolation.average_path(256) == pytest.approx(10.2448, abs=1e-4)


def brute_lof(x, k, distance):
    d = distance(x)
    np.fill_diagonal(d, np.inf)
    near = np.argsort(d, axis=1, kind="stable")[:, :k]
    away = np.take_along_axis(d, near, 1)
    lrd = 1 / (np.maximum(away[:, -1][near], away).mean(1) + 1e-10)
    return lrd[near].mean(1) / lrd


@pytest.mark.parametrize("metric, distance", [
    ("euclidean", lambda x: np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))),
    ("manhattan", lambda x: np.abs(x[:, None] - x[None]).sum(2)),
])
def test_lof_equals_brute_force(spark, normal, metric, distance):
    df = normal.limit(200).select("id", F.array(*FEATURES).alias("x"))
    out = neighbours.local_outlier_factor(df, ["id"], "x", k=5, metric=metric).orderBy("id").collect()
    want = brute_lof(np.array([r.x for r in out]), 5, distance)
    assert [r.lof for r in out] == pytest.approx(want.tolist())
    assert int(np.argmax(want)) == 0


def test_lof_against_a_sample(spark, normal):
    df = normal.select("id", F.array(*FEATURES).alias("x"))
    out = neighbours.local_outlier_factor(df, ["id"], "x", reference=df.filter("id % 2 = 0"))
    assert out.count() == 1000 and out.orderBy(F.desc("lof")).first().id == 0


def test_lof_with_many_copies(spark):
    df = spark.range(60).select("id", F.array(F.when(F.col("id") < 40, 1.0).otherwise(F.col("id").cast("double"))).alias("x"))
    out = neighbours.local_outlier_factor(df, ["id"], "x", k=5).filter("id < 40").select("lof").distinct().collect()
    assert [r.lof for r in out] == pytest.approx([1.0])


def test_lof_refuses(spark, normal):
    df = normal.select("id", F.array(*FEATURES).alias("x"))
    with pytest.raises(ValueError, match="metric"):
        neighbours.local_outlier_factor(df, ["id"], "x", metric="cosine")
    with pytest.raises(ValueError, match="neighbours"):
        neighbours.local_outlier_factor(df, ["id"], "x", k=20, reference=df.limit(20))


def test_equal_distances_go_to_the_smaller_ids(spark, monkeypatch):
    """More rows at one distance than any shortlist holds, over several blocks."""
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 16)
    ring = spark.range(1, 101).select("id", F.array(F.cos(F.col("id") * 0), F.lit(0.0)).alias("x"))
    base = neighbours.staged(ring.unionByName(spark.range(200, 201).select("id", F.array(F.lit(9.0), F.lit(0.0)).alias("x"))), "p")
    row = neighbours.staged(spark.range(500, 501).select("id", F.array(F.lit(0.0), F.lit(0.0)).alias("x")), "r")
    found = neighbours.neighbours(row, base, 5, "euclidean").collect()
    assert sorted(r.other for r in found) == [1, 2, 3, 4, 5] and {r.away for r in found} == {1.0}


def test_blocks_change_nothing(spark, normal, monkeypatch):
    df = normal.limit(150).select("id", F.array(*FEATURES).alias("x"))
    whole = neighbours.local_outlier_factor(df, ["id"], "x", k=5).orderBy("id").collect()
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 40)
    parts = neighbours.local_outlier_factor(df, ["id"], "x", k=5).orderBy("id").collect()
    assert [r.lof for r in parts] == pytest.approx([r.lof for r in whole])


def test_comparisons_grow_slower_than_rows(spark):
    """Ten times the rows of five features: a row is compared with far fewer than ten times."""
    shares = []
    for n in (2_000, 20_000):
        x = np.random.default_rng(3).normal(size=(n, 5))
        base = neighbours.staged(spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], "id long, x array<double>"), "p")
        shares.append(neighbours.compared(base, base, 5, "euclidean").agg(F.avg("compared")).first()[0])
    assert shares[1] < 5 * shares[0] and shares[1] < 0.5 * 20_000


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_index_finds_what_all_pairs_find(spark, monkeypatch, metric):
    """Dense groups, copies, far points, ties on a grid; small blocks so that tiles are split."""
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 50)
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.integers(0, 6, (300, 2)), rng.normal(2, 0.01, (300, 2)), np.full((200, 2), 3.0), rng.normal(size=(20, 2)) * 1e3])
    rows = [(int(i), list(map(float, v))) for i, v in zip(rng.permutation(len(x)), x)]
    base = neighbours.staged(spark.createDataFrame(rows, "id long, x array<double>"), "p")
    found = {}
    for r in neighbours.neighbours(base, base, 4, metric).collect():
        found.setdefault(r.id, []).append((r.away, r.other))
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    away = neighbours.distances(x, x, metric)
    for k, i in enumerate(ids):
        order = [j for j in np.lexsort((ids, away[k])) if j != k][:4]
        assert sorted(found[i]) == [(away[k, j], ids[j]) for j in order]


def test_outlier_factor_keeps_all_columns(spark, normal):
    df = normal.limit(50).select("id", F.array(*FEATURES).alias("x"), F.lit(7).alias("_id"), F.lit("t").alias("tile"))
    out = neighbours.local_outlier_factor(df, ["id"], "x", k=3)
    assert out.columns == ["id", "x", "_id", "tile", "lof"] and out.filter("_id = 7 and lof > 0").count() == 50


def test_trials_of_a_metric_share_a_search(spark, normal, monkeypatch):
    """Five outlier factors by three names of two metrics: two searches, and the flags of each trial alone."""
    frame = neighbours.staged(normal.limit(150), "f")
    searches, plain = [], neighbours.compared
    monkeypatch.setattr(neighbours, "compared", lambda rows, base, k, metric: searches.append(k) or plain(rows, base, k, metric))
    settings, scored = anomaly.search(frame, ["id"], FEATURES, ["lof"], trials=5)
    drawn = [{**r.params, "k": int(r.params["k"]), "contamination": float(r.params["contamination"])} for r in settings.orderBy("trial").collect()]
    assert len(searches) == len({p["metric"] == "manhattan" for p in drawn}) and max(searches) == max(p["k"] for p in drawn)
    found = {(r.trial, round(r.anomaly_score, 9)): r.n for r in scored.groupBy("trial", F.round("anomaly_score", 9).alias("anomaly_score")).agg(F.count("*").alias("n")).collect()}
    for trial in (0, 4):
        alone = anomaly.detect(frame, ["id"], FEATURES, "lof", drawn[trial]).collect()
        assert {(trial, round(r.anomaly_score, 9)) for r in alone} == {key for key in found if key[0] == trial}


def test_anomaly_trials_draws_all_settings(spark, monkeypatch):
    """The query leaves the number of trials as it is by default."""
    from skyloom.plans import queries

    asked = []
    monkeypatch.setattr(queries, "_anomaly_frame", lambda spark, sf: spark.createDataFrame([(1,)], "a int"))
    monkeypatch.setattr(queries.anomaly, "search", lambda *a, **named: asked.append(named) or (None, spark.createDataFrame([(0, "lof", True)], "trial int, algorithm string, is_anomaly boolean")))
    queries.anomaly_trials(spark, "nowhere")
    assert [named.get("trials", C.TRIALS) for named in asked] == [C.TRIALS]


def test_trial_table_runs_all_rounds(spark, monkeypatch):
    """The query leaves the rounds and trees as they are drawn."""
    from skyloom.plans import queries

    asked = []
    row = spark.createDataFrame([(0, "lgbm", 0, 1, 0.5), (0, "lgbm", 0, 0, 0.1)], "trial int, algorithm string, fold int, label int, score double")
    monkeypatch.setattr(queries, "_delay_frame", lambda spark, sf: None)
    monkeypatch.setattr(queries.sampling, "folds", lambda *a, **named: None)
    monkeypatch.setattr(queries.models, "search", lambda *a, **named: asked.append(named) or (None, row))
    assert queries.trial_table(spark, "nowhere").count() == 1
    assert [(named.get("effort", 1.0), named["trials"]) for named in asked] == [(1.0, len(models.FAMILIES))]


def test_rows_go_down_trees_in_blocks(monkeypatch):
    """Scores of rows dealt in blocks are those of each row walked alone, missing values too."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 3))
    x[7, 1] = np.nan
    parts = [isolation.grow(x[rng.choice(7, 6)] if t else x[:1], np.arange(3), rng) for t in range(4)]
    nodes = isolation.pd.concat([isolation.pd.DataFrame(p, columns=["node", "feature", "threshold", "left", "right", "depth"]).assign(tree=t) for t, p in enumerate(parts)])
    forest = isolation.assemble(nodes, list("abc"), 6)
    monkeypatch.setattr(isolation, "BLOCK_ROWS", 64)
    total = np.zeros(len(x))
    for i, row in enumerate(x):
        for at in forest.roots:
            while forest.feature[at] >= 0:
                at = forest.left[at] if row[forest.feature[at]] < forest.threshold[at] else forest.right[at]
            total[i] += forest.depth[at]
    assert isolation.path_scores(x, *forest[1:]).tolist() == (2.0 ** (-total / 4 / isolation.average_path(6))).tolist()


def test_detector_search_honours_its_arguments(spark, normal):
    settings, scored = anomaly.search(normal, ["id"], FEATURES, ["isolation_forest"], trials=1, effort=0.05)
    assert settings.count() == 1 and scored.count() == 1000
    row = anomaly.trial_scores(scored).first()
    assert row.separation > 1 and row.score_spread > 0


def test_wide_vectors_move_in_bounded_pieces(spark, monkeypatch):
    """In 64 dimensions nothing is excluded: a row goes to few tiles, a piece at a time, and finds
    what all pairs find."""
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 500)
    monkeypatch.setattr(neighbours, "STEP_CELLS", 4_000)
    x = np.random.default_rng(5).normal(size=(2_000, 64))
    base = neighbours.staged(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, x array<double>"), "p")
    _, tiles = neighbours.tiled(base, "euclidean")
    assert len(tiles.rows) == 4 and tiles.rows.sum() == 2_000
    batch = base.toPandas().assign(bound=np.inf)
    pieces = [len(row) for row, _ in tiles.visits(batch)]
    assert sum(pieces) == 3 * 2_000 and max(pieces) <= 4_000
    found = {}
    for r in neighbours.neighbours(base, base, 5, "euclidean").filter("id < 50").collect():
        found.setdefault(r.id, []).append((r.away, r.other))
    away = neighbours.distances(x[:50], x, "euclidean")
    for i in range(50):
        order = [j for j in np.argsort(away[i], kind="stable") if j != i][:5]
        assert sorted(found[i]) == [(away[i, j], j) for j in order]


def test_reference_ids_with_a_step(spark, monkeypatch):
    """Ids with a step in common are dealt to all groups; a group without a visitor gives no rows."""
    monkeypatch.setattr(neighbours, "SIDE_ROWS", 16)
    x = np.random.default_rng(6).normal(size=(320, 3))
    table = neighbours.staged(spark.createDataFrame([(64 * i, v.tolist()) for i, v in enumerate(x)], "id long, x array<double>"), "p")
    found = neighbours.local_outlier_factor(table, ["id"], "x", k=5, reference=table.filter("id % 320 = 0"))
    assert found.filter("lof > 0").count() == 320
    sides = neighbours.dealt(np.arange(0, 64_000, 64), np.full(1000, 20))
    assert np.bincount(sides, minlength=20).min() > 20


def test_rows_and_boxes_are_measured_together(monkeypatch):
    """Far fewer calls than boxes; ties, copies and rows near nothing as when all are compared."""
    calls = []
    for owner, name in ((neighbours, "estimates"), (neighbours.Leaves, "cells")):
        plain = getattr(owner, name)
        monkeypatch.setattr(owner, name, lambda *a, plain=plain: calls.append(1) or plain(*a))
    rng = np.random.default_rng(7)
    ref = np.concatenate([rng.integers(0, 9, (3_000, 3)), rng.normal(4, 0.1, (1_000, 3)), np.full((9, 3), 2.0)]).astype(float)
    ids = rng.permutation(len(ref))
    some = np.concatenate([np.arange(0, 4_009, 9), [4_008]])
    x, own = np.vstack([ref[some], [[1e6, 0.0, 0.0]]]), np.append(ids[some], -1)
    for metric in ("euclidean", "manhattan"):
        row, other, away, tried = neighbours.nearest(x, own, np.full(len(x), np.inf), ref, ids, 7, metric)
        far = neighbours.distances(x, ref, metric)
        for i in range(len(x)):
            order = [j for j in np.lexsort((ids, far[i])) if ids[j] != own[i]][:7]
            assert other[row == i].tolist() == ids[order].tolist() and away[row == i].tolist() == far[i, order].tolist()
        assert tried.max() <= len(ref)
    assert len(calls) < 60
