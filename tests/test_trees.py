"""Tree learners against a brute-force split search, and their rules one by one."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import trees


def _data(spark, n=300, seed=1):
    rng = np.random.default_rng(seed)
    X = np.column_stack([rng.integers(0, 12, n), rng.integers(0, 4, n) / 4, rng.choice([-3.0, 0.0, 1.5, 9.0, 40.0], n)])
    y = (rng.random(n) < 1 / (1 + np.exp(-(X[:, 0] - 6) / 2 - (X[:, 1] > 0.4) + (X[:, 2] > 1)))).astype(int)
    df = spark.createDataFrame([(i, *map(float, x), int(t)) for i, (x, t) in enumerate(zip(X, y))], "row_key long, a double, b double, c double, churn int")
    return df, X, y


def _cuts(X):
    return [(lambda v: (v[:-1] + v[1:]) / 2)(np.unique(X[:, f])) for f in range(X.shape[1])]


def _grow(X, rows, depth, cuts, score, ok, leaf, splits):
    """Exact greedy search; returns a function of a row."""
    whole = score(rows)
    best = None
    if depth > 0 and splits(rows):
        for f, cs in enumerate(cuts):
            for c in cs:
                left, right = rows[X[rows, f] <= c], rows[X[rows, f] > c]
                if len(left) and len(right) and ok(left) and ok(right):
                    gain = round(score(left) + score(right) - whole, trees.GAIN_PLACES)
                    if best is None or gain > best[0]:
                        best = gain, f, c, left, right
    if best is None or not splits(rows, best[0]):
        value = leaf(rows)
        return lambda x: value
    _, f, c, left, right = best
    lo, hi = (_grow(X, part, depth - 1, cuts, score, ok, leaf, splits) for part in (left, right))
    return lambda x: lo(x) if x[f] <= c else hi(x)


@pytest.mark.parametrize("lam,alpha,least", [(0.0, 0.0, 1.0), (1.0, 0.0, 1.0), (2.0, 0.0, 1.0), (1.0, 1.5, 0.5), (2.0, 0.5, 5.0)])
def test_boosted_equals_brute_force(spark, lam, alpha, least):
    df, X, y = _data(spark)
    m, eta = np.zeros(len(y)), 0.3
    cuts = _cuts(X)
    for _ in range(4):
        p = 1 / (1 + np.exp(-m))
        g, h = p - y, p * (1 - p)
        pull = lambda r: max(abs(g[r].sum()) - alpha, 0)
        tree = _grow(X, np.arange(len(y)), 3, cuts, lambda r: pull(r) ** 2 / (h[r].sum() + lam), lambda r: h[r].sum() >= least,
                     lambda r: -eta * math.copysign(pull(r), g[r].sum()) / (h[r].sum() + lam), lambda r, gain=1: gain > 1e-6)
        m = m + np.array([tree(x) for x in X])
    model = trees.fit_boosted(df, ["a", "b", "c"], n_estimators=4, max_depth=3, learning_rate=eta, reg_lambda=lam, reg_alpha=alpha,
                              min_child_weight=least)
    got = {r["row_key"]: r["proba"] for r in trees.predict(model, df).collect()}
    assert np.abs(np.array([got[i] for i in range(len(y))]) - 1 / (1 + np.exp(-m))).max() < 1e-9


@pytest.mark.parametrize("split,leaf,depth", [(2, 1, None), (40, 1, None), (2, 15, None), (10, 5, 3)])
def test_one_tree_of_a_forest_equals_brute_force(spark, split, leaf, depth):
    df, X, y = _data(spark, seed=2)
    w = np.where(y == 1, 2.0, 0.5)
    df = df.withColumn("w", F.when(F.col("churn") == 1, 2.0).otherwise(0.5))

    def score(r):
        pos, all_ = (w[r] * y[r]).sum(), w[r].sum()
        return (pos ** 2 + (all_ - pos) ** 2) / all_

    def splits(r, gain=0.0):
        return len(set(y[r])) == 2 and len(r) >= split and gain >= 0
    tree = _grow(X, np.arange(len(y)), depth or 99, _cuts(X), score, lambda r: len(r) >= leaf, lambda r: (w[r] * y[r]).sum() / w[r].sum(), splits)
    model = trees.fit_forest(df, ["a", "b", "c"], n_estimators=1, max_depth=depth, min_samples_split=split, min_samples_leaf=leaf,
                             max_features=None, bootstrap=False, weight="w")
    got = {r["row_key"]: r["proba"] for r in trees.predict(model, df).collect()}
    assert np.abs(np.array([got[i] for i in range(len(y))]) - np.array([tree(x) for x in X])).max() < 1e-9


def test_absorbed_margins_change_nothing(spark, monkeypatch):
    df, X, y = _data(spark, n=120)
    one = trees.fit_boosted(df, ["a", "b", "c"], n_estimators=5, max_depth=2, subsample=0.7, colsample_bytree=0.7)
    monkeypatch.setattr(trees, "ABSORB", 2)
    two = trees.fit_boosted(df.repartition(3), ["a", "b", "c"], n_estimators=5, max_depth=2, subsample=0.7, colsample_bytree=0.7)
    assert [t.feature for t in one.trees] == [t.feature for t in two.trees]
    assert np.allclose(one.margin(one.bins(list(X.T))), two.margin(two.bins(list(X.T))))
    used = [{f for f in t.feature if f >= 0} for t in one.trees]
    assert all(len(u) <= 2 for u in used) and len(set().union(*used)) == 3      # two of three columns a tree


def test_forest_draws_rows_and_columns(spark):
    df, X, y = _data(spark)
    model = trees.fit_forest(df, ["a", "b", "c"], n_estimators=25, max_depth=4)
    assert len({t.feature[0] for t in model.trees}) > 1        # the root's one column differs
    p = model.probability(model.bins(list(X.T)))
    order = np.argsort(p)
    assert y[order[-100:]].mean() > y[order[:100]].mean() + 0.3 and 0 <= p.min() and p.max() <= 1


def test_many_values_missing_values_and_empty_tables(spark):
    rng = np.random.default_rng(3)
    rows = [(i, float(v) if i % 9 else None, float("nan") if i % 7 == 0 else float(i % 3), int(v > 0.2) if i % 50 else None) for i, v in enumerate(rng.normal(size=3000))]
    df = spark.createDataFrame(rows, "row_key long, `x.1` double, x double, churn int")
    cuts = trees.cut_points(df, ["x.1", "x"])
    assert len(cuts[0]) <= 255 and list(cuts[1]) == [0.5, 1.5]
    model = trees.fit_boosted(df, ["x.1", "x"], n_estimators=3, max_depth=2)
    scored = trees.predict(model, df.withColumn("proba", F.lit("clash"))).where("`x.1` is not null and churn is not null")
    assert scored.where((F.col("proba") >= 0.5) != (F.col("churn") == 1)).count() < 30
    none = trees.fit_boosted(df.limit(0), ["x"], n_estimators=2)
    assert {r["proba"] for r in trees.predict(none, df).collect()} == {0.5}
    assert trees.predict(model, df.limit(0)).count() == 0


def _same(a, b):
    return all(getattr(a, c) == getattr(b, c) for c in ("feature", "cut", "left", "right")) and np.allclose(a.value, b.value, rtol=0, atol=1e-12)


@pytest.mark.parametrize("leaf,split,features", [(1, 2, "sqrt"), (2, 10, 2), (3, 5, None)])
def test_unlimited_forests_are_stored_and_equal_those_of_the_driver(spark, monkeypatch, leaf, split, features):
    """Trees of any depth do not reach the driver; they and their scores are those of the
    level-wise growth, in which the driver holds every node."""
    df, X, _ = _data(spark, n=500, seed=4)
    df = df.withColumn("w", F.when(F.col("churn") == 1, 1.7).otherwise(0.6)).repartition(3)
    args = {"n_estimators": 6, "min_samples_leaf": leaf, "min_samples_split": split, "max_features": features, "weight": "w"}
    deep = trees.fit_forest(df, ["a", "b", "c"], max_depth=18, **args)
    assert deep.table is None
    with monkeypatch.context() as m:
        m.setattr(trees, "_grow", None)
        m.setattr(trees, "checked_collect", None)
        model = trees.fit_forest(df, ["a", "b", "c"], **args)
        scored = {r["row_key"]: r["proba"] for r in trees.predict(model, df).collect()}
    assert model.table is not None and not model.grown
    assert len(scored) == 500 and max(abs(scored[i] - q) for i, q in enumerate(deep.probability(deep.bins(list(X.T))))) < 1e-12
    assert all(_same(a, b) for a, b in zip(deep.trees, model.trees, strict=True))


def test_unlimited_forests_without_rows(spark):
    df, _, _ = _data(spark, n=30)
    model = trees.fit_forest(df.limit(0), ["a", "b"], n_estimators=3)
    assert {r["proba"] for r in trees.predict(model, df).collect()} == {0.0}
    assert trees.predict(trees.fit_forest(df, ["a"], n_estimators=2), df.limit(0)).count() == 0
