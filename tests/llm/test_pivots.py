import numpy as np
import pytest

from skyloom.llm import pivots

from .conftest import stored


def plain(rows):
    """(vec_id, n_links, component_id) by brute force; rows are in order of ids."""
    good = [
        v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows
    ]
    linked = np.zeros((len(rows), len(rows)), bool)
    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows):
            if i != j and good[i] and good[j] and len(a) == len(b):
                a_, b_ = np.array(a, float), np.array(b, float)
                linked[i, j] = a_ @ b_ / np.sqrt(a_ @ a_) / np.sqrt(b_ @ b_) >= 0.95
    label = list(range(len(rows)))
    while True:
        new = [min([label[i], *(label[j] for j in np.flatnonzero(linked[i]))]) for i in range(len(rows))]
        if new == label:
            return [(r[0], int(linked[i].sum()), rows[label[i]][0]) for i, r in enumerate(rows)]
        label = new


def found(spark, rows, kind="float"):
    df = stored(spark, spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3))
    out = pivots.linked_vectors(df.selectExpr("*", "vec_id as n_links", "'x' as vector")).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    return sorted((r.vec_id, r.n_links, r.component_id) for r in out)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_planted_groups(spark, kind):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(150, 32))
    near = base[rng.integers(0, 40, 200)] + rng.normal(size=(200, 32)) * 0.12
    dense = base[0] + rng.normal(size=(120, 32)) * 0.05
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(np.concatenate([base, near, dense, base[:9]]))]
    assert found(spark, rows, kind) == plain(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 0.0]),
        (8, [2.0, 0.0]), (9, [1.0, 0.0]), (10, [1.0, 0.0, 0.0]), (11, [1e-30, 0.0]), (12, [1e30, -0.0]), (13, [0.0, 1.0]),
    ]
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == []
    assert found(spark, [(1, None)]) == [(1, 0, 1)]


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 1.0])]
    assert found(spark, rows) == [(1, 1, 1), (1, 1, 1), (1, 1, 1), (2, 1, 1)]


def test_long_lists_are_compared_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.ones(8) + rng.normal(size=(150, 8)) * 0.3)]
    whole = found(spark, rows, "double")
    monkeypatch.setattr(pivots, "BLOCK", 16)
    assert found(spark, rows, "double") == whole


def test_recall(spark):
    """Pairs right at the limit, in as many dimensions as the test tables have."""
    rng = np.random.default_rng(5)
    a = rng.normal(size=(400, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.normal(size=a.shape)
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.951 * a + np.sqrt(1 - 0.951**2) * side
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.concatenate([a, b]))]
    assert sum(n for _, n, _ in found(spark, rows, "double")) >= 0.97 * 800


def test_no_link_is_lost_in_a_dense_group(spark):
    """A third of 20,000 vectors around one centre, with many pairs near the limit."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(20_000, 64))
    x[:6_600] = x[0] / np.linalg.norm(x[0]) * 8 + rng.normal(size=(6_600, 64)) * 0.2
    x[:6_600] *= rng.uniform(0.5, 2, (6_600, 1))
    x = x.astype(np.float32).astype(float)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = np.concatenate([(u[at : at + 1000] @ u.T >= 0.95).sum(axis=1) - 1 for at in range(0, len(u), 1000)])
    assert want[:6_600].mean() > 500
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    assert [n for _, n, _ in found(spark, rows)] == want.tolist()
