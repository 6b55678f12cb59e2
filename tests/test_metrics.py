import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from skyloom.operators import drift, gates, metrics, trials

SCORED = "label int, score double"


def pairwise(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.9, 1.0])), min_size=1, max_size=40))
def test_auc_with_ties(spark, rows):
    found = metrics.auc(spark.createDataFrame(rows, SCORED)).first().auc
    assert found == (None if pairwise(rows) is None else pytest.approx(pairwise(rows)))


@pytest.mark.parametrize("squeeze", [1.0, 1e-6])
def test_auc_many_scores_many_ranges(spark, monkeypatch, squeeze):
    """More distinct scores than ranges, evenly spread or crowded into a sliver."""
    rng = random.Random(1)
    rows = [(int(rng.random() < 0.3), rng.random() ** 3 * squeeze) for _ in range(1500)]
    monkeypatch.setattr(metrics, "RANGES", 16)
    assert metrics.auc(spark.createDataFrame(rows, SCORED)).first().auc == pytest.approx(pairwise(rows))


def test_auc_skips_unknown_scores(spark):
    rows = [(1, 0.9), (0, 0.1), (1, None), (None, 0.5), (0, float("nan"))]
    row = metrics.auc(spark.createDataFrame(rows, SCORED)).first()
    assert (row.auc, row.positives, row.negatives) == (1.0, 1, 1)


def test_confusion_with_empty_denominators(spark):
    row = metrics.confusion(spark.createDataFrame([(0, 0.2), (0, 0.5)], SCORED)).first()
    assert (row.tn, row.accuracy, row.precision, row.recall, row.f1) == (2, 1.0, 0.0, 0.0, 0.0)


def test_regression(spark):
    rows = [(1.0, 1.5), (2.0, 2.0), (4.0, 3.0)]
    row = metrics.regression(spark.createDataFrame(rows, "target double, prediction double")).first()
    assert row.rmse == pytest.approx(math.sqrt(1.25 / 3)) and row.mae == pytest.approx(0.5)
    assert row.r2 == pytest.approx(1 - 1.25 / (14 / 3))


def test_regression_of_a_constant_target_far_from_zero(spark):
    rows = [(1e9 + 0.1, 1e9)] * 3
    assert metrics.regression(spark.createDataFrame(rows, "target double, prediction double")).first().r2 is None


def test_fold_mean_skips_useless_folds(spark):
    rows = [(1, 0, 0.8), (1, 1, None), (1, 2, float("nan")), (2, 0, None)]
    out = metrics.fold_mean(spark.createDataFrame(rows, "trial int, fold int, auc double"), "auc", ["trial"])
    assert {r.trial: r.auc for r in out.collect()} == {1: 0.8, 2: 0.0}


def test_best_trial_prefers_the_earlier(spark):
    rows = [(0, "a", 0.5), (2, "c", 0.9), (1, "b", 0.9)]
    assert tuple(trials.best_trial(spark.createDataFrame(rows, "trial int, algorithm string, score double")).first()) == (1, "b", 0.9)


def test_untried_algorithms_are_listed(spark):
    rows = [(0, "lgbm", 0.51234), (1, "lgbm", 0.6)]
    out = trials.algorithm_summary(spark.createDataFrame(rows, "trial int, algorithm string, score double"), ["lgbm", "hgb"])
    assert {tuple(r) for r in out.collect()} == {("lgbm", 0.6, 0.5562, 2), ("hgb", 0.0, 0.0, 0)}


GATE_CASES = [
    # candidate auc, f1, champion auc, promoted
    (0.80, 0.75, None, True),
    (0.88, 0.75, 0.84, True),
    (0.80, 0.72, 0.85, False),
    (0.85, 0.72, 0.85, False),
    (0.50, 0.72, None, False),
    (0.80, 0.40, None, False),
    (None, 0.72, None, False),
]


@pytest.mark.parametrize("auc, f1, champion, want", GATE_CASES)
def test_delay_decision(spark, auc, f1, champion, want):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(auc, f1, champion)], "a double, f double, c double")
    floors = (F.col("a") >= 0.62) & (F.col("f") >= 0.50)
    assert df.select(gates.promote(F.col("a"), F.col("c"), floors)).first()[0] is want


def sided(spark, rows, schema):
    return spark.createDataFrame(rows, f"role string, {schema}")


def test_gates_over_scored_rows(spark):
    good = [("candidate", y, s) for y, s in ((1, 0.9), (1, 0.8), (0, 0.1), (0, 0.2))]
    poor = [("champion", y, s) for y, s in ((1, 0.9), (1, 0.1), (0, 0.1), (0, 0.6))]
    assert gates.delay_gate(sided(spark, good, SCORED)).first().promote
    assert gates.delay_gate(sided(spark, good + poor, SCORED)).first().promote
    turned = [("champion" if r == "candidate" else "candidate", y, s) for r, y, s in good + poor]
    assert not gates.delay_gate(sided(spark, turned, SCORED)).first().promote
    flat = [("candidate", float(i), 2.0) for i in range(5)]
    assert not gates.congestion_gate(sided(spark, flat, "target double, prediction double")).first().promote
    close = [("candidate", float(i), i + 0.1) for i in range(5)]
    assert gates.congestion_gate(sided(spark, close + [("champion", t, p + 1) for _, t, p in close], "target double, prediction double")).first().promote


def test_drift_by_quantile_bins(spark):
    df = spark.range(4000).selectExpr("id % 2 = 1 as is_new", "cast(id % 100 as double) steady", "cast(id % 100 + if(id % 2 = 1, 60, 0) as double) moved")
    edges = drift.quantile_edges(df.filter("not is_new"), ["steady", "moved"])
    out = {r.feature: r for r in drift.psi(df, "is_new", edges).collect()}
    assert not out["steady"].drifted and out["steady"].psi < 0.01 and out["moved"].drifted
    decision = drift.drift_decision(drift.psi(df, "is_new", edges)).first()
    assert (decision.features, decision.drifted_features, decision.drifted_share, decision.retrain) == (2, 1, 0.5, True)


def test_rules_on_unknown_values(spark):
    row = drift.anomaly_rules(
        spark.createDataFrame([(None, None, None, None, None)], "heading_change_5m double, altitude_m double, speed_ms double, vertical_rate_ms double, distance_10m_km double")
    ).first()
    assert row.signals == 0
