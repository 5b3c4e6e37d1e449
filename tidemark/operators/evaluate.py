"""Classification metrics, curves and decision thresholds.

Everything is grouped by optional ``by`` columns (split, model, window ...).

The curves are exact: one point per distinct raw score.  The plan is
``groupBy(by, score)`` with map-side partial aggregation - a score shared by a third
of all rows collapses to one partial row per task - followed by descending running
sums computed over contiguous score ranges (``ranking.running_totals``).  AUC and
average precision are sums over the curve rows, and the best threshold is a
``min(struct(-f1, score))`` aggregate, so no step needs a global window or a sort on
one task.

A row whose score is null or NaN reaches no threshold: it makes no point, but counts in the
class totals, so it is a missed positive or a rejected negative everywhere; so is a row
with a null prediction.  A row with a null label is in no count.  A null group is a group,
and a group without any score keeps its row.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import nan_to_null, safe_div
from tidemark.operators.ranges import ROWS_PER_RANGE
from tidemark.operators.ranking import join_groups, running_totals
from tidemark.session import materialize

# Fixed value: keeps F1 defined on the curve where precision and recall are both 0.
F1_EPS = 1e-12


def _g(by):
    return list(by or [])


# --- E1 -------------------------------------------------------------------------------
def confusion(df: DataFrame, label: str = "churn", pred: str = "pred", by=None) -> DataFrame:
    """Counts of labelled rows; tp + fp + tn + fn = n."""
    y, p = F.col(label), F.coalesce(F.col(pred).cast("int"), F.lit(0))
    return df.groupBy(*_g(by)).agg(
        F.count(F.when((y == 1) & (p == 1), 1)).alias("tp"),
        F.count(F.when((y != 1) & (p == 1), 1)).alias("fp"),
        F.count(F.when((y != 1) & (p != 1), 1)).alias("tn"),
        F.count(F.when((y == 1) & (p != 1), 1)).alias("fn"),
        F.count(y).alias("n"))


# --- E2 - E5 --------------------------------------------------------------------------
def accuracy_expr() -> Column:
    return safe_div(F.col("tp") + F.col("tn"), F.col("n"))


def precision_expr() -> Column:
    return safe_div(F.col("tp"), F.col("tp") + F.col("fp"))


def recall_expr() -> Column:
    return safe_div(F.col("tp"), F.col("tp") + F.col("fn"))


def f1_expr() -> Column:
    return safe_div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))


def classification_metrics(df: DataFrame, label: str = "churn", pred: str = "pred", by=None) -> DataFrame:
    """E1-E5 in one aggregation: confusion counts plus accuracy, precision, recall, F1
    (0 where undefined)."""
    return confusion(df, label, pred, by).select(
        "*", accuracy_expr().alias("accuracy"), precision_expr().alias("precision"),
        recall_expr().alias("recall"), f1_expr().alias("f1"))


# --- E6 / E7 --------------------------------------------------------------------------
def score_curve(df: DataFrame, label: str = "churn", score: str = "proba", by=None,
                rows_per_range: int = ROWS_PER_RANGE, weight: str | None = None) -> DataFrame:
    """One row per distinct raw score and group:

    ``threshold, pos, neg`` (rows at that score), ``tp, fp`` (rows scoring >= it),
    ``n_pos, n_neg`` (group totals), ``precision, recall, f1, tpr, fpr``.
    ``weight`` names a row-count column, for input that is already aggregated.  The
    points, far fewer than the rows, are written once and read by every later step.
    """
    by = _g(by)
    y = F.col(label)
    if weight:
        pos = F.coalesce(F.sum(F.when(y == 1, F.col(weight))), F.lit(0)).cast("long")
        neg = F.coalesce(F.sum(F.when(y != 1, F.col(weight))), F.lit(0)).cast("long")
    else:
        pos, neg = F.count(F.when(y == 1, 1)), F.count(F.when(y != 1, 1))
    pts = materialize(df.groupBy(*by, nan_to_null(F.col(score).cast("double")).alias("threshold"))
                      .agg(pos.alias("pos"), neg.alias("neg")))
    cum = running_totals(pts.where("threshold is not null"), by, "threshold", ["pos", "neg"], rows_per_range, stored=True)
    totals = pts.groupBy(*by).agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    cum = _attach_totals(cum, totals, by)
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    prec = tp / (tp + fp)
    rec = safe_div(tp, F.col("n_pos"))
    return cum.select(*by, "threshold", "pos", "neg", tp.alias("tp"), fp.alias("fp"), "n_pos", "n_neg",
                      prec.alias("precision"), rec.alias("recall"),
                      (2 * prec * rec / (prec + rec + F.lit(F1_EPS))).alias("f1"),
                      rec.alias("tpr"), safe_div(fp, F.col("n_neg")).alias("fpr"))


def _attach_totals(cum: DataFrame, totals: DataFrame, by: list) -> DataFrame:
    if by:
        return join_groups(cum, totals, by)   # one row per group; AQE broadcasts it when small
    row = totals.collect()[0]   # one row: the two class totals
    return cum.withColumn("n_pos", F.lit(row["n_pos"] or 0)).withColumn("n_neg", F.lit(row["n_neg"] or 0))


def pr_curve(df, label="churn", score="proba", by=None, **kw) -> DataFrame:
    c = score_curve(df, label, score, by, **kw)
    return c.select(*_g(by), "threshold", "precision", "recall", "f1", "tp", "fp")


def roc_curve(df, label="churn", score="proba", by=None, **kw) -> DataFrame:
    c = score_curve(df, label, score, by, **kw)
    return c.select(*_g(by), "threshold", "fpr", "tpr", "tp", "fp")


# --- E8 / E9 / E10 --------------------------------------------------------------------
def curve_summary(curve: DataFrame, by=None) -> DataFrame:
    """From a ``score_curve``: ROC AUC (trapezoids; null with one class), average
    precision (step sum), and the best-F1 threshold (lowest score wins a tie)."""
    by = _g(by)
    P, N = F.first("n_pos"), F.first("n_neg")
    unscored_pos, unscored_neg = P - F.sum("pos"), N - F.sum("neg")     # tied below every score
    auc_num = F.sum(F.col("neg") * (2 * F.col("tp") - F.col("pos"))) + unscored_neg * (2 * P - unscored_pos)
    return curve.groupBy(*by).agg(
        F.when((P > 0) & (N > 0), auc_num / (2.0 * P * N)).alias("roc_auc"),
        F.when(P > 0, F.sum(F.col("pos") * F.col("precision")) / P).otherwise(F.lit(0.0)).alias("pr_ap"),
        F.min(F.struct((-F.col("f1")).alias("nf1"), F.col("threshold").alias("t"))).alias("_best"),
        P.alias("n_pos"), N.alias("n_neg"),
    ).select(*by, "roc_auc", "pr_ap", F.col("_best.t").alias("best_threshold"),
             (-F.col("_best.nf1")).alias("best_f1"), "n_pos", "n_neg")


def roc_auc(df, label="churn", score="proba", by=None) -> DataFrame:
    return curve_summary(score_curve(df, label, score, by), by).select(*_g(by), "roc_auc")


def average_precision(df, label="churn", score="proba", by=None) -> DataFrame:
    return curve_summary(score_curve(df, label, score, by), by).select(*_g(by), "pr_ap")


def best_threshold(df, label="churn", score="proba", by=None) -> DataFrame:
    return curve_summary(score_curve(df, label, score, by), by).select(*_g(by), "best_threshold", "best_f1")


# --- E11 ------------------------------------------------------------------------------
def metrics_at_best(df: DataFrame, label: str = "churn", score: str = "proba", by=None) -> DataFrame:
    """Accuracy, precision, recall and F1 at the best-F1 threshold, with ROC AUC and
    average precision: the threshold-selection report.  A group without any score has a
    null threshold, AUC and precision, and predicts no row."""
    by = _g(by)
    summ = curve_summary(score_curve(df, label, score, by), by)
    s = nan_to_null(F.col(score).cast("double"))
    if by:
        d = join_groups(df, summ.select(*by, "best_threshold"), by, "left")   # one row per group
        t = F.col("best_threshold")
    else:
        row = summ.collect()[0]
        t = F.lit(row["best_threshold"]).cast("double")
        d = df
    m = classification_metrics(d.withColumn("_pred", F.coalesce(s >= t, F.lit(False)).cast("int")), label, "_pred", by)
    both = join_groups(m, summ, by, "left") if by else \
        m.select("*", *[F.lit(row[c]).cast(summ.schema[c].dataType).alias(c) for c in summ.columns])
    return both.withColumns({"n_pos": F.coalesce("n_pos", F.col("tp") + F.col("fn")),
                             "n_neg": F.coalesce("n_neg", F.col("fp") + F.col("tn"))})


# --- E12 ------------------------------------------------------------------------------
def threshold_grid(start: float = 0.2, stop: float = 0.8, step: float = 0.02) -> list:
    n = int(round((stop - start) / step)) + 1
    return [start + i * step for i in range(n)]


def threshold_sweep(df: DataFrame, label: str = "churn", score: str = "proba", by=None,
                    grid: list | None = None) -> DataFrame:
    """F1 at every grid threshold in one pass: each row finds its place in the grid once,
    one aggregation counts positives and negatives per place (at most grid + 1 rows a
    group), and the counts above each threshold are sums over those places."""
    by = _g(by)
    grid = grid or threshold_grid()
    points = sorted(set(grid))
    s = F.coalesce(nan_to_null(F.col(score).cast("double")), F.lit(float("-inf")))
    y = F.col(label)
    placed = Bucketizer(splits=[float("-inf"), *points, float("inf")], inputCol="_s", outputCol="_at").transform(
        df.select(*by, y.alias("_y"), s.alias("_s")))       # _at: how many points the score reaches
    counts = placed.groupBy(*by, F.col("_at").cast("int").alias("at")).agg(
        F.count(F.when(F.col("_y") == 1, 1)).alias("pos"), F.count(F.when(F.col("_y") != 1, 1)).alias("neg"))
    wide = counts.groupBy(*by).agg(F.collect_list(F.struct("at", "pos", "neg")).alias("c"), F.sum("pos").alias("n_pos"))
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(g)).alias("threshold"), F.lit(points.index(g) + 1).alias("need"))
                               for i, g in enumerate(grid)]))
    long = wide.select(*by, "n_pos", "c", each.alias("p")).select(*by, "n_pos", "c", "p.*")

    def above(name):
        return F.aggregate("c", F.lit(0).cast("long"), lambda t, x: t + F.when(x["at"] >= F.col("need"), x[name]).otherwise(0))
    long = long.withColumns({"tp": above("pos"), "fp": above("neg")})
    fn = F.col("n_pos") - F.col("tp")
    return long.select(*by, "i", "threshold", "tp", "fp",
                       safe_div(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                       safe_div(F.col("tp"), F.col("n_pos")).alias("recall"),
                       safe_div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + fn).alias("f1"))


def best_on_grid(sweep: DataFrame, by=None) -> DataFrame:
    by = _g(by)
    return (sweep.groupBy(*by).agg(F.min(F.struct((-F.col("f1")).alias("nf1"), F.col("threshold").alias("t"))).alias("b"))
            .select(*by, F.col("b.t").alias("threshold"), (-F.col("b.nf1")).alias("f1")))


# --- E13 ------------------------------------------------------------------------------
def curve_points(curve: DataFrame, by=None, max_points: int = 100) -> DataFrame:
    """Thin a curve to about ``max_points`` points per group for plotting: the curve
    is cut into equal slices of the cumulative row count and each slice keeps its
    lowest threshold (its last point)."""
    by = _g(by)
    seen = F.col("tp") + F.col("fp")
    total = F.col("n_pos") + F.col("n_neg")
    sl = F.floor((seen - 1) * F.lit(max_points) / total)
    return (curve.withColumn("_slice", sl).groupBy(*by, "_slice")
            .agg(F.min(F.struct("threshold", "fpr", "tpr", "precision", "recall")).alias("p"))
            .select(*by, "p.*"))
