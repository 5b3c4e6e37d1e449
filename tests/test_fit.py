"""Fitted models: the logistic-regression objective mapping and a sanity bar."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.operators import evaluate, fit, score
from tidemark.plans import flows


def _newton(X, y, w, C, iters=50):
    """Minimise C * sum(w_i * logloss_i) + |beta|^2 / 2 (intercept not penalised)."""
    n, p = X.shape
    Xa = np.hstack([X, np.ones((n, 1))])
    b = np.zeros(p + 1)
    reg = np.eye(p + 1)
    reg[-1, -1] = 0.0
    for _ in range(iters):
        z = Xa @ b
        pr = 1 / (1 + np.exp(-z))
        g = C * Xa.T @ (w * (pr - y)) + reg @ b
        H = C * (Xa * (w * pr * (1 - pr))[:, None]).T @ Xa + reg
        b -= np.linalg.solve(H, g)
    return b


def test_logreg_matches_direct_solve(spark, small_dir):
    st = flows.standardized_split(spark, small_dir)
    feats = flows.NUMERIC
    d = st.select("row_key", F.col("churn").cast("double").alias("churn"), *feats).where("true")
    C = 0.5
    model, _ = fit.fit_logreg(d, feats, C=C, scale=False, weighted=True)
    lr = model.stages[-1]
    got = np.append(np.array(lr.coefficients.toArray()), lr.intercept)
    pdf = d.toPandas()
    y = pdf["churn"].to_numpy()
    wmap = fit.fit_class_weights(d)
    w = np.array([wmap[v] for v in y])
    want = _newton(pdf[feats].to_numpy(), y, w, C)
    assert np.max(np.abs(got - want)) < 1e-4


def test_logreg_beats_base_rate(spark, small_dir):
    st = flows.standardized_split(spark, small_dir)
    feats = flows.NUMERIC
    d = st.select("row_key", "split", F.col("churn").cast("double").alias("churn"), *feats)
    model, _ = fit.fit_logreg(d.where("split = 'train'"), feats)
    sc = score.score(model, d.where("split != 'train'")).withColumn("churn", F.col("churn").cast("int"))
    s = evaluate.curve_summary(evaluate.score_curve(sc)).collect()[0]
    base = sc.agg(F.avg("churn")).collect()[0][0]
    assert s.roc_auc > 0.6 and s.pr_ap > base


def _table(spark, n=400, p=4, seed=3):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, p)) * np.array([1, 50, 0.01, 3])[:p]
    y = (rng.random(n) < 1 / (1 + np.exp(-(X[:, 0] - X[:, 1] / 60 + 0.7)))).astype(float)
    names = [f"f.{i}" for i in range(p)]
    df = spark.createDataFrame([(*map(float, x), float(t)) for x, t in zip(X, y)], ", ".join(f"`{c}` double" for c in names) + ", churn double")
    return df, X, y, names


def _minimum(X, y, w, C, penalised):
    n, p = X.shape
    Xa = np.hstack([X, np.ones((n, 1))])
    reg = np.eye(p + 1)
    reg[-1, -1] = 1.0 if penalised else 0.0
    b = np.zeros(p + 1)
    for _ in range(60):
        pr = 1 / (1 + np.exp(-Xa @ b))
        b -= np.linalg.solve(C * (Xa * (w * pr * (1 - pr))[:, None]).T @ Xa + reg, C * Xa.T @ (w * (pr - y)) + reg @ b)
    return b


def test_newton_logreg_matches_direct_solve(spark):
    """The liblinear objective (penalised constant), and the one with a free intercept and
    weights, within 1e-6 on features of very different sizes."""
    df, X, y, names = _table(spark)
    for C in (0.01, 1.0, 30.0):
        coef, intercept = fit.newton_logreg(df, names, C=C)
        assert np.abs(np.array([*coef.values(), intercept]) - _minimum(X, y, np.ones(len(y)), C, True)).max() < 1e-6
        worst = fit.logreg_gradient(df, coef, intercept, C=C).agg(F.max(F.abs("gradient"))).first()[0]
        assert worst < 1e-6
    w = np.where(y == 1, 2.5, 0.5)
    weighted = df.withColumn("w", F.when(F.col("churn") == 1, 2.5).otherwise(0.5))
    coef, intercept = fit.newton_logreg(weighted, names, weight="w", penalize_intercept=False)
    assert np.abs(np.array([*coef.values(), intercept]) - _minimum(X, y, w, 1.0, False)).max() < 1e-6


def test_newton_logreg_edges(spark):
    df, X, y, names = _table(spark, n=60)
    holes = df.union(spark.createDataFrame([(None, 1.0, 1.0, 1.0, 1.0), (float("nan"), 1.0, 1.0, 1.0, 0.0)], df.schema))
    assert fit.newton_logreg(holes, names) == fit.newton_logreg(df, names) or np.allclose(
        list(fit.newton_logreg(holes, names)[0].values()), list(fit.newton_logreg(df, names)[0].values()), atol=1e-9)
    coef, intercept = fit.newton_logreg(df.limit(0), names)
    assert set(coef.values()) == {0.0} and intercept == 0.0
    one, b = fit.newton_logreg(df.withColumn("churn", F.lit(1.0)), names)      # one class: finite, as all is penalised
    assert b > 0 and all(np.isfinite(v) for v in one.values())


def test_cross_validation_fits_inside_the_fold(spark):
    """Fold scores equal fitting by hand with weights and scaling from the other folds."""
    df, X, y, names = _table(spark, n=240, p=3)
    df = df.toDF("a", "b", "c", "churn").withColumn("fold", (F.monotonically_increasing_id() % 3).cast("int"))
    df = spark.createDataFrame([tuple(r) for r in df.collect()], df.schema)
    feats = ["a", "b", "c"]
    _, scores = fit.grid_search_cv(df, feats, lambda C: fit.logreg(C, 100, 160, True), {"C": [0.001, 1.0]}, scale=True)
    got = {(r["candidate"], r["fold"]): r["f1"] for r in scores.collect()}
    assert len(got) == 6
    for i, C in enumerate([0.001, 1.0]):
        for f in range(3):
            train, test = df.where(F.col("fold") != f), df.where(F.col("fold") == f)
            stats = fit.fit_standardizer(train, feats)
            train = fit.prepare_weighted(fit.standardize(train, stats))
            model = fit.fit(fit.logreg(C, 100, 160, True), train, feats)
            want = fit.f1_evaluator().evaluate(model.transform(fit.standardize(test, stats)))
            assert abs(got[i, f] - want) < 1e-9
    means = {r["candidate"]: r["mean_f1"] for r in fit.fold_scores_mean(scores).collect()}
    assert abs(means[1] - sum(got[1, f] for f in range(3)) / 3) < 1e-12


def test_parameters_merge_and_grid():
    assert fit.merge_params({"a": 1, "b": 2}, {"b": None, "c": 3}, {"a": 0}) == {"a": 0, "b": 2, "c": 3}
    assert fit.merge_params({"a": 1}) == {"a": 1} and fit.merge_params({}, None, {"x": False}) == {"x": False}
    assert fit.param_grid({"a": [1, 2], "b": ["x", "y"]}) == [{"a": 1, "b": "x"}, {"a": 1, "b": "y"}, {"a": 2, "b": "x"}, {"a": 2, "b": "y"}]
    assert fit.param_grid({}) == [{}] and fit.param_grid({"a": []}) == []


def test_coefficient_table_scores_as_its_numbers(spark):
    df = spark.createDataFrame([(1.0, 2.0), (0.0, -3.0), (None, 1.0)], "a double, b double")
    table = spark.createDataFrame([("m", "a", 0.5), ("m", "b", -1.25), ("m", "__intercept__", 0.1), ("n", "a", 2.0)],
                                  "model_name string, feature string, weight double")
    own = score.linear_score(df, {"a": 0.5, "b": -1.25}, 0.1).collect()
    models = score.coefficients_from_table(table)
    assert models == {"m": (0.1, {"a": 0.5, "b": -1.25}), "n": (0.0, {"a": 2.0})}
    assert score.linear_score(df, models["m"][1], models["m"][0]).collect() == own
