"""Curves, AUC, AP and thresholds against brute force."""

from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.operators import evaluate, score


def _scores(spark, pairs):
    return spark.createDataFrame(pairs, "churn int, proba double")


def brute(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y != 1]
    auc = None
    if pos and neg:
        auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    best, best_t, ap, prev_r = -1.0, None, 0.0, 0.0
    for t in sorted({s for _, s in pairs}):
        tp = sum(1 for y, s in pairs if s >= t and y == 1)
        fp = sum(1 for y, s in pairs if s >= t and y != 1)
        p = tp / (tp + fp)
        r = tp / len(pos) if pos else 0.0
        f1 = 2 * p * r / (p + r + 1e-12)
        if f1 > best:
            best, best_t = f1, t
    for t in sorted({s for _, s in pairs}, reverse=True):
        tp = sum(1 for y, s in pairs if s >= t and y == 1)
        fp = sum(1 for y, s in pairs if s >= t and y != 1)
        r = tp / len(pos) if pos else 0.0
        ap += (r - prev_r) * tp / (tp + fp)
        prev_r = r
    return auc, ap, best_t, best


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.sampled_from([0.1, 0.2, 0.35, 0.5, 0.51, 0.8, 0.9, 1.0])),
                min_size=2, max_size=40))
def test_summary_matches_brute_force(spark, pairs):
    df = _scores(spark, pairs)
    s = evaluate.curve_summary(evaluate.score_curve(df, rows_per_range=2)).collect()[0]
    auc, ap, t, f1 = brute(pairs)
    if auc is None:
        assert s.roc_auc is None
    else:
        assert abs(s.roc_auc - auc) < 1e-12
    if any(y == 1 for y, _ in pairs):
        assert abs(s.pr_ap - ap) < 1e-12
    assert s.best_threshold == t and abs(s.best_f1 - f1) < 1e-12
    assert 0.0 <= (s.roc_auc if s.roc_auc is not None else 0.5) <= 1.0


def test_all_scores_tied(spark):
    df = _scores(spark, [(1, 0.5), (0, 0.5), (1, 0.5)])
    s = evaluate.curve_summary(evaluate.score_curve(df)).collect()[0]
    assert s.roc_auc == 0.5 and s.best_threshold == 0.5


def test_metrics_zero_when_undefined(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "churn int, pred int")
    m = evaluate.classification_metrics(df).collect()[0]
    assert (m.precision, m.recall, m.f1) == (0.0, 0.0, 0.0)
    assert abs(m.accuracy - 2 / 3) < 1e-12


def test_grid_sweep_matches_direct_counts(spark):
    pairs = [(1, 0.21), (0, 0.2), (1, 0.7), (0, 0.79), (1, 0.8), (0, 0.05)]
    sw = {r.i: r for r in evaluate.threshold_sweep(_scores(spark, pairs)).collect()}
    grid = evaluate.threshold_grid()
    assert len(sw) == 31
    for i, g in enumerate(grid):
        assert sw[i].tp == sum(1 for y, s in pairs if y == 1 and s >= g)
        assert sw[i].fp == sum(1 for y, s in pairs if y == 0 and s >= g)


def test_minmax_all_equal(spark):
    df = spark.createDataFrame([(1, 3.0), (2, 3.0)], "k long, s double")
    assert [r.proba for r in score.minmax_score(df, "s").collect()] == [0.0, 0.0]


def test_curve_points_bounded(spark):
    df = spark.range(5000).selectExpr("cast(id % 2 as int) as churn", "rand(1) as proba")
    c = evaluate.score_curve(df, rows_per_range=300)
    assert evaluate.curve_points(c, max_points=25).count() <= 26


def test_weighted_curve_equals_row_curve(spark):
    """A curve over (group, score, label) counts with ``weight`` equals the curve over
    the rows themselves (ties, one-class groups, repeated rows)."""
    import random
    from tidemark.operators import evaluate as E
    rnd = random.Random(3)
    rows = [(g, round(rnd.random(), 2) if g != "c" else 0.5, rnd.randint(0, 1) if g != "b" else 1)
            for g in ("a", "b", "c") for _ in range(400)]
    df = spark.createDataFrame(rows, "g string, proba double, churn int")
    agg = df.groupBy("g", "proba", "churn").count().withColumnRenamed("count", "n")
    cols = ["g", "threshold", "pos", "neg", "tp", "fp", "n_pos", "n_neg", "precision", "recall", "f1"]
    a = sorted(tuple(r) for r in E.score_curve(df, by=["g"]).select(*cols).collect())
    b = sorted(tuple(r) for r in E.score_curve(agg, by=["g"], weight="n").select(*cols).collect())
    assert a == b
    sa = sorted(tuple(r) for r in E.curve_summary(E.score_curve(df, by=["g"]), ["g"]).collect())
    sb = sorted(tuple(r) for r in E.curve_summary(E.score_curve(agg, by=["g"], weight="n"), ["g"]).collect())
    assert sa == sb


def test_curves_use_raw_scores_and_keep_null_groups(spark):
    """Scores 1e-10 apart stay apart; the threshold returned is a score, and applying it
    gives the metrics reported at it; null and NaN scores count as never reached."""
    rows = [(g, y, s) for g in ("a", None) for y, s in [(0, 1e-10), (1, 2e-10), (0, 3e-10), (1, 4e-10), (1, None), (0, float("nan"))]]
    df = spark.createDataFrame(rows, "g string, churn int, proba double")
    got = evaluate.curve_summary(evaluate.score_curve(df, by=["g"]), ["g"]).collect()
    assert {r["g"] for r in got} == {"a", None}
    for r in got:
        assert (r["n_pos"], r["n_neg"], r["best_threshold"]) == (3, 3, 2e-10)
        # wins of a positive over a negative, ties half: (2 + 3) + (1 + 0.5 ...)
        order = {1: [2e-10, 4e-10, -1.0], 0: [1e-10, 3e-10, -1.0]}
        wins = sum((p > n) + (p == n) / 2 for p in order[1] for n in order[0])
        assert abs(r["roc_auc"] - wins / 9) < 1e-12
    at = {r["g"]: r for r in evaluate.metrics_at_best(df, by=["g"]).collect()}
    assert set(at) == {"a", None}
    for r in at.values():
        assert (r["tp"], r["fp"], r["fn"], r["tn"], r["n"]) == (2, 1, 1, 2, 6)


def test_null_and_nan_scores_are_handled_one_way(spark):
    """Every way to counts gives the same ones for null and NaN scores, null predictions
    and null labels."""
    from pyspark.sql import functions as F

    from tidemark.streaming import monitor
    rows = [(1, 0.9), (1, None), (1, float("nan")), (0, 0.9), (0, None), (0, float("nan")), (1, 0.2), (0, 0.1), (None, 0.9), (None, None)]
    df = _scores(spark, rows).withColumn("k", F.monotonically_increasing_id()).withColumn("event_time", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    want = (1, 1, 3, 3, 8)      # tp, fp, tn, fn, n at 0.5
    pred = score.apply_threshold(df, 0.5)
    assert {r["pred"] for r in pred.collect()} == {0, 1}
    cols = ["tp", "fp", "tn", "fn", "n"]
    assert tuple(evaluate.confusion(pred).select(*cols).first()) == want
    holes = pred.withColumn("pred", F.when(F.col("pred") == 1, 1))      # null instead of 0
    assert tuple(evaluate.confusion(holes).select(*cols).first()) == want
    assert tuple(monitor.windowed_counts(holes).select(*cols).first()) == want
    assert tuple(monitor.windowed_metrics(holes).select(*cols).first()) == want
    sweep = evaluate.threshold_sweep(df, grid=[0.5, 0.05, 0.95, 0.5]).orderBy("i").collect()
    assert [(r["tp"], r["fp"]) for r in sweep] == [(1, 1), (2, 2), (0, 0), (1, 1)]
    flags = {r["customer_id"]: r["flag_alto_riesgo"] for r in score.score_table(df, "k", 0.5, "2024-01-01").collect()}
    assert sum(flags.values()) == 3 and None not in flags.values()
    drift = monitor.prediction_drift(pred).collect()
    assert {round(r["high_risk_share"], 6) for r in drift} == {0.3} and sum(r["n"] for r in drift) == 10
    at = evaluate.metrics_at_best(df).first()
    assert at["tp"] + at["fp"] + at["tn"] + at["fn"] == at["n"] == 8


def test_groups_without_a_score_keep_their_row(spark):
    rows = [("a", 1, 0.9), ("a", 0, 0.1), ("b", 1, None), ("b", 0, float("nan")), (None, 1, None)]
    df = spark.createDataFrame(rows, "g string, churn int, proba double")
    got = {r["g"]: r for r in evaluate.metrics_at_best(df, by=["g"]).collect()}
    assert set(got) == {"a", "b", None}
    assert (got["a"]["tp"], got["a"]["best_threshold"]) == (1, 0.9)
    assert [got["b"][c] for c in ("tp", "fp", "tn", "fn", "n", "n_pos", "n_neg", "best_threshold", "roc_auc")] == [0, 0, 1, 1, 2, 1, 1, None, None]
    assert got[None]["fn"] == got[None]["n_pos"] == 1
    alone = evaluate.metrics_at_best(df.where("g = 'b'")).first()
    assert (alone["n"], alone["fn"], alone["best_threshold"]) == (2, 1, None)


def test_sketch_drift_within_its_bound(spark):
    """Merged window sketches against the exact gap on shifted, equal, discrete and hot
    columns; and the binned gap with very many categories against a plain count."""
    from pyspark.sql import functions as F

    from tidemark.streaming import monitor
    base = spark.range(20000).select(F.randn(1).alias("same"), F.randn(2).alias("moved"), (F.col("id") % 5).cast("double").alias("few"),
                                     F.when(F.col("id") % 3 > 0, 7.0).when(F.col("id") % 3 == 0, F.rand(3)).alias("hot"),
                                     F.lit("2024-01-01 00:00:00").cast("timestamp").alias("t"))
    recent = spark.range(12000).select(F.randn(4).alias("same"), (F.randn(5) + 0.4).alias("moved"), (F.col("id") % 4).cast("double").alias("few"),
                                       F.when(F.col("id") % 2 > 0, 7.0).when(F.col("id") % 5 > 0, F.rand(6)).otherwise(float("nan")).alias("hot"),
                                       F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 100).alias("t"))
    cols = ["same", "moved", "few", "hot"]
    windows = monitor.feature_sketches(recent, cols, "t")
    assert windows.select("window_start").distinct().count() >= 2
    near = {r["feature"]: r for r in monitor.sketch_drift(monitor.merge_sketches(monitor.feature_sketches(base, cols)), monitor.merge_sketches(windows)).collect()}
    exact = {r["feature"]: r["max_cdf_diff"] for r in monitor.exact_cdf_gap(base, recent, cols).collect()}
    assert set(near) == set(exact) == set(cols)
    for c in cols:
        assert abs(near[c]["max_cdf_diff"] - exact[c]) <= monitor.sketch_bound(), (c, near[c], exact[c])
    assert exact["moved"] > 0.1 and abs(exact["few"] - 0.2) < 1e-9
    a = spark.range(3000).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("k"))
    b = a.where("k >= 'c2'")
    got = monitor.feature_drift(a, b, [], ["k"]).first()["max_cdf_diff"]
    assert abs(got - a.where("k < 'c2'").count() / 3000) < 1e-9
