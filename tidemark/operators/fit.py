"""Model fitting and tuning on ``pyspark.ml``.

Standardisation and class weights are one small aggregate each (numbers per column or
per class reach the driver) applied as projections.  Learners are the distributed
``pyspark.ml`` estimators, and Newton steps over one aggregate each for logistic
regression with a penalised intercept; tuning fits every candidate on every fold (the
stratified folds of ``split.stratified_folds``) or on the training split of a holdout.
"""

from __future__ import annotations

import itertools
import json
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exprs import quoted
from tidemark.session import checked_collect, checkpoint_dir, materialize

MAX_CLASSES = 1_000


# --- M1 -------------------------------------------------------------------------------
def fit_standardizer(df: DataFrame, cols: list[str]) -> dict:
    """Mean and population std per column; a zero (or undefined) std scales by 1."""
    row = df.agg(*[x for c in cols for x in (F.avg(quoted(c).cast("double")).alias(f"m_{c}"),
                                             F.stddev_pop(quoted(c).cast("double")).alias(f"s_{c}"))]).collect()[0]
    out = {}
    for c in cols:
        s = row[f"s_{c}"]
        out[c] = (row[f"m_{c}"] or 0.0, s if s else 1.0)
    return out


def standardize(df: DataFrame, stats: dict) -> DataFrame:
    return df.withColumns({c: (quoted(c).cast("double") - F.lit(m)) / F.lit(s) for c, (m, s) in stats.items()})


# --- M2 -------------------------------------------------------------------------------
def fit_class_weights(df: DataFrame, target: str = "churn") -> dict:
    """Balanced weights ``n / (k * n_c)``."""
    rows = checked_collect(df.groupBy(target).count(), MAX_CLASSES, "class counts")
    n, k = sum(r["count"] for r in rows), len(rows)
    return {r[target]: n / (k * r["count"]) for r in rows}


def with_class_weights(df: DataFrame, weights: dict, target: str = "churn", out: str = "weight") -> DataFrame:
    m = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))])
    return df.withColumn(out, F.element_at(m, F.col(target)))


# --- M7 / M8 --------------------------------------------------------------------------
def merge_params(defaults: dict, base: dict | None = None, best: dict | None = None) -> dict:
    """defaults <- base <- best (later wins; ``None`` values do not override)."""
    out = dict(defaults)
    for layer in (base or {}), (best or {}):
        out.update({k: v for k, v in layer.items() if v is not None})
    return out


def param_grid(grid: dict) -> list[dict]:
    """Cartesian product of value lists, in key order then value order."""
    keys = list(grid)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[grid[k] for k in keys])]


# --- M3 - M6 --------------------------------------------------------------------------
def assembler(features: list[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="keep")


def logreg(C: float = 1.0, max_iter: int = 100, n_weight: float | None = None, weighted: bool = True,
           label: str = "churn") -> LogisticRegression:
    """L2 logistic regression with the objective ``C * sum(w_i * loss_i) + |b|^2 / 2``:
    ``regParam = 1 / (C * sum(w))``.  Balanced weights give ``sum(w) = n``."""
    reg = 1.0 / (C * n_weight) if n_weight else 0.0
    lr = LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter, regParam=reg,
                            elasticNetParam=0.0, standardization=False, tol=1e-8)
    return lr.setWeightCol("weight") if weighted else lr


def random_forest(n_estimators: int = 100, max_depth: int | None = None, min_samples_leaf: int = 1,
                  seed: int = 42, weighted: bool = True, label: str = "churn") -> RandomForestClassifier:
    if max_depth is not None and max_depth > 30:
        raise ValueError("random_forest: depths above 30 are not supported by pyspark.ml")
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=n_estimators,
                                maxDepth=30 if max_depth is None else max_depth,
                                minInstancesPerNode=min_samples_leaf, seed=seed, checkpointInterval=10)
    return rf.setWeightCol("weight") if weighted else rf


UNSUPPORTED_BOOSTING = {"reg_lambda": 1.0, "reg_alpha": 0.0}


def boosted_trees(n_estimators: int = 100, max_depth: int = 6, learning_rate: float = 0.3,
                  subsample: float = 1.0, colsample_bytree: float = 1.0, seed: int = 42,
                  label: str = "churn", **unsupported) -> GBTClassifier:
    """Gradient-boosted trees.  L1/L2 leaf penalties have no Spark counterpart: a
    non-default value is an error rather than silently ignored."""
    for k, v in unsupported.items():
        if k not in UNSUPPORTED_BOOSTING or v != UNSUPPORTED_BOOSTING[k]:
            raise ValueError(f"boosted_trees: {k}={v} is not supported")
    strat = "all" if colsample_bytree >= 1.0 else str(colsample_bytree)
    return GBTClassifier(featuresCol="features", labelCol=label, maxIter=n_estimators, maxDepth=max_depth,
                         stepSize=learning_rate, subsamplingRate=subsample, featureSubsetStrategy=strat,
                         seed=seed, checkpointInterval=10)


# --- M4 -------------------------------------------------------------------------------
def _newton_sums(beta: np.ndarray):
    """Loss, gradient and Hessian of a batch's rows (features, constant, label, weight)."""
    def run(it):
        p = len(beta)
        total = np.zeros(1 + p + p * p)
        for batch in it:
            m = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            x, y, w = m[:, :p], m[:, p], m[:, p + 1]
            z = x @ beta
            pr = 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))
            total[0] += float((w * (np.logaddexp(0.0, z) - y * z)).sum())
            total[1:1 + p] += x.T @ (w * (pr - y))
            total[1 + p:] += ((x * (w * pr * (1 - pr))[:, None]).T @ x).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["sums"])
    return run


def newton_logreg(df: DataFrame, features: list[str], C: float = 1.0, label: str = "churn", weight: str | None = None,
                  penalize_intercept: bool = True, max_iter: int = 50, tol: float = 1e-12) -> tuple[dict, float]:
    """Logistic regression by Newton steps: coefficients per feature, and the intercept.

    The objective is ``C * sum(w_i * loss_i) + |b|^2 / 2``; with ``penalize_intercept`` the
    constant is one more penalised feature (the liblinear objective), else it is free.  It
    is strictly convex in all penalised parameters, so the minimum is unique.  A step needs
    one aggregate: each task adds its rows' loss, gradient and Hessian (p^2 numbers), and
    only their sum reaches the driver.  Steps are halved until the objective falls.  Rows
    with a null or NaN value in any used column are left out.  For up to a few hundred
    features; wider tables go to ``fit_logreg``."""
    cols = [quoted(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)]
    rows = df.select(*cols, F.lit(1.0).alias("one"), quoted(label).cast("double").alias("y"),
                     (quoted(weight).cast("double") if weight else F.lit(1.0)).alias("w")).dropna()
    rows = materialize(rows)
    p = len(features) + 1
    reg = np.ones(p)
    if not penalize_intercept:
        reg[-1] = 0.0

    def at(beta):
        each = rows.mapInArrow(_newton_sums(beta), "sums array<double>").select(F.posexplode("sums").alias("i", "v"))
        total = np.array([r[1] for r in sorted(each.groupBy("i").agg(F.sum("v")).collect())])
        if not len(total):
            total = np.zeros(1 + p + p * p)
        return (C * total[0] + (reg * beta * beta).sum() / 2, C * total[1:1 + p] + reg * beta,
                C * total[1 + p:].reshape(p, p) + np.diag(reg))

    beta = np.zeros(p)
    value, grad, hess = at(beta)
    for _ in range(max_iter):
        scale = 1.0 / np.sqrt(np.maximum(np.diag(hess), 1e-300))    # features of any size
        step = scale * np.linalg.lstsq(hess * np.outer(scale, scale), scale * grad, rcond=None)[0]
        gain = float(grad @ step)
        near = gain <= tol * max(1.0, abs(value))     # one more step squares the distance
        size = 1.0
        while size > 1e-8:
            new = at(beta - size * step)
            if near or new[0] <= value - 1e-4 * size * gain:
                break
            size /= 2
        beta = beta - size * step
        value, grad, hess = new
        if near:
            break
    return {c: float(b) for c, b in zip(features, beta)}, float(beta[-1])


def logreg_gradient(df: DataFrame, coef: dict, intercept: float, C: float = 1.0, label: str = "churn", weight: str | None = None,
                    penalize_intercept: bool = True) -> DataFrame:
    """``(feature, gradient, curvature)`` of the objective of ``newton_logreg`` at given
    parameters, by one plain aggregation: a check of a fit that shares no code with it.
    Gradient over curvature is how far one parameter alone is from its best value, whatever
    the size of its feature.  Where all parameters are penalised the distance to the minimum
    is also at most the gradient's length."""
    z = F.lit(float(intercept))
    for c, b in coef.items():
        z = z + F.lit(float(b)) * quoted(c).cast("double")
    w = quoted(weight).cast("double") if weight else F.lit(1.0)
    p = 1 / (1 + F.exp(-z))
    given = df.select((F.lit(float(C)) * w * (p - quoted(label).cast("double"))).alias("m"), (F.lit(float(C)) * w * p * (1 - p)).alias("h"),
                      *[quoted(c).cast("double").alias(f"x{i}") for i, c in enumerate(coef)], F.lit(1.0).alias(f"x{len(coef)}"))
    sums = given.agg(*[F.sum(F.col("m") * F.col(f"x{i}")).alias(f"g{i}") for i in range(len(coef) + 1)],
                     *[F.sum(F.col("h") * F.col(f"x{i}") * F.col(f"x{i}")).alias(f"h{i}") for i in range(len(coef) + 1)])
    parameters = [*((c, float(b), 1.0) for c, b in coef.items()), ("intercept", float(intercept) * penalize_intercept, float(penalize_intercept))]
    each = [F.struct(F.lit(c).alias("feature"), (F.col(f"g{i}") + F.lit(b)).alias("gradient"), (F.col(f"h{i}") + F.lit(r)).alias("curvature"))
            for i, (c, b, r) in enumerate(parameters)]
    return sums.select(F.explode(F.array(*each)).alias("x")).select("x.*")


def fit(estimator, df: DataFrame, features: list[str]) -> PipelineModel:
    """Assemble the features and fit; tree learners checkpoint into the shared folder."""
    checkpoint_dir(df.sparkSession)
    return Pipeline(stages=[assembler(features), estimator]).fit(df)


def fit_logreg(df: DataFrame, features: list[str], C: float = 1.0, max_iter: int = 100,
               target: str = "churn", scale: bool = True, weighted: bool = True):
    """M3 (scaled and weighted; the intercept is not penalised, see ``newton_logreg`` for the
    objective that does).  Returns the model and the fitted standardiser (apply it to
    scoring input first)."""
    stats = fit_standardizer(df, features) if scale else {}
    d = standardize(df, stats) if scale else df
    n_weight = None
    if weighted:
        w = fit_class_weights(d, target)
        d = with_class_weights(d, w, target)
        n_weight = d.agg(F.sum("weight")).collect()[0][0]
    else:
        n_weight = d.count()
    model = fit(logreg(C, max_iter, n_weight, weighted, target), d, features)
    return model, stats


def prepare_weighted(df: DataFrame, target: str = "churn") -> DataFrame:
    return with_class_weights(df, fit_class_weights(df, target), target)


# --- M9 / M11 / M12 -------------------------------------------------------------------
def f1_evaluator(label: str = "churn") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction",
                                             metricName="fMeasureByLabel", metricLabel=1.0)


def grid_search_cv(df: DataFrame, features: list[str], make_estimator, grid: dict, fold_col: str = "fold",
                   label: str = "churn", parallelism: int = 4, weighted: bool = True, scale: bool = False):
    """k-fold grid search on F1 of class 1 with given folds; refits the best on all rows.

    Everything that is fitted is fitted inside a fold: class weights and scaling come from
    the fold's training rows only.  Each (candidate, fold) is one job, ``parallelism`` at a
    time.  Returns ``(best_model, fold_scores)``; ``fold_scores`` is a small table
    ``candidate, params, fold, f1`` for ``fold_scores_mean`` and ``best_candidate``."""
    candidates = param_grid(grid)
    folds = sorted(r[0] for r in checked_collect(df.select(fold_col).distinct(), MAX_CLASSES, "folds"))
    checkpoint_dir(df.sparkSession)

    def prepared(rows, other):
        if scale:
            stats = fit_standardizer(rows, features)
            rows, other = standardize(rows, stats), standardize(other, stats)
        return (prepare_weighted(rows, label) if weighted else rows), other

    sides = {f: tuple(materialize(d) for d in prepared(df.where(F.col(fold_col) != f), df.where(F.col(fold_col) == f))) for f in folds}

    def one(job):
        (i, params), f = job
        train, test = sides[f]
        model = fit(make_estimator(**params), train, features)
        return i, json.dumps(params, sort_keys=True), f, float(f1_evaluator(label).evaluate(model.transform(test)))

    with ThreadPool(parallelism) as pool:
        rows = pool.map(one, list(itertools.product(enumerate(candidates), folds)), chunksize=1)
    scores = df.sparkSession.createDataFrame(rows, ["candidate", "params", "fold", "f1"]) \
        .withColumns({"candidate": F.col("candidate").cast("int"), "fold": F.col("fold").cast("int")})
    best = best_candidate(fold_scores_mean(scores)).first()["candidate"]
    everything, _ = prepared(df, df.limit(0))
    return fit(make_estimator(**candidates[best]), everything, features), scores


def fold_scores_mean(fold_scores: DataFrame, candidate: str = "candidate", score: str = "f1") -> DataFrame:
    """Mean score per candidate."""
    return fold_scores.groupBy(candidate).agg(F.avg(score).alias(f"mean_{score}"))


def best_candidate(results: DataFrame, score: str = "mean_f1", candidate: str = "candidate", by=None) -> DataFrame:
    """Highest score; the first candidate wins a tie (strict ``>`` in a loop)."""
    by = list(by or [])
    return (results.groupBy(*by).agg(F.min(F.struct((-F.col(score)).alias("ns"), F.col(candidate).alias("c"))).alias("b"))
            .select(*by, F.col("b.c").alias(candidate), (-F.col("b.ns")).alias(score)))


# --- M10 ------------------------------------------------------------------------------
def grid_search_holdout(train: DataFrame, valid: DataFrame, features: list[str], make_estimator, grid: dict,
                        label: str = "churn", threshold: float = 0.5):
    """Fit every candidate on ``train``; F1 of class 1 on ``valid`` at ``threshold``.

    The loop is over candidates (a parameter list), each a distributed fit."""
    from tidemark.operators.evaluate import classification_metrics
    from tidemark.operators.score import apply_threshold
    from tidemark.operators.score import score as score_model
    results, best = [], (-1.0, None, None)
    for i, params in enumerate(param_grid(grid)):
        model = fit(make_estimator(**params), train, features)
        scored = apply_threshold(score_model(model, valid), threshold)
        f1 = classification_metrics(scored, label, "pred").collect()[0]["f1"]
        results.append((i, json.dumps(params, sort_keys=True), float(f1)))
        if f1 > best[0]:
            best = (f1, i, model)
    res = train.sparkSession.createDataFrame(results, "candidate int, params string, f1 double")
    return best[2], res


# --- M13 ------------------------------------------------------------------------------
def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
