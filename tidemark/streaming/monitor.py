"""Monitoring over scored events: windowed metrics, feature / class / prediction
drift, retraining reasons and run comparison.

Every function takes a DataFrame that may be static or streaming where that makes
sense (windowed counts); curve-based metrics (AUC, AP) are computed per closed window
on static data or inside ``foreachBatch``.  Event times must be ``timestamp`` (cast
``timestamp_ntz`` first; watermarks reject it) and the session zone is UTC.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import nan_to_null
from tidemark.operators import evaluate
from tidemark.operators.ranking import running_totals
from tidemark.operators.score import reaches
from tidemark.session import ensure_utc, materialize

PSI_EPS = 1e-6


def event_time(df: DataFrame, col: str = "ts", out: str = "event_time") -> DataFrame:
    """``timestamp_ntz`` -> ``timestamp`` (watermarks need the latter), read as UTC."""
    ensure_utc(df.sparkSession)
    return df.withColumn(out, F.col(col).cast("timestamp"))


def _window(width: str, slide: str | None, col: str = "event_time"):
    return F.window(col, width, slide) if slide else F.window(col, width)


# --- T4 -------------------------------------------------------------------------------
def windowed_counts(df: DataFrame, width: str = "7 days", slide: str | None = None, label: str = "churn",
                    pred: str = "pred", watermark: str | None = None) -> DataFrame:
    """Confusion counts and ratios per event-time window (streaming-safe: a plain
    aggregation; add ``watermark`` on a stream)."""
    d = df.withWatermark("event_time", watermark) if watermark else df
    y, p = F.col(label), F.coalesce(F.col(pred).cast("int"), F.lit(0))
    c = d.groupBy(_window(width, slide).alias("w")).agg(
        F.count(F.when((y == 1) & (p == 1), 1)).alias("tp"), F.count(F.when((y != 1) & (p == 1), 1)).alias("fp"),
        F.count(F.when((y != 1) & (p != 1), 1)).alias("tn"), F.count(F.when((y == 1) & (p != 1), 1)).alias("fn"),
        F.count(y).alias("n"))
    return c.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "tp", "fp", "tn", "fn", "n")


def with_ratios(c: DataFrame) -> DataFrame:
    return c.select("*", evaluate.accuracy_expr().alias("accuracy"), evaluate.precision_expr().alias("precision"),
                    evaluate.recall_expr().alias("recall"), evaluate.f1_expr().alias("f1"))


def window_score_counts(df: DataFrame, width: str = "7 days", slide: str | None = None, label: str = "churn",
                        pred: str = "pred", score: str = "proba") -> DataFrame:
    """Rows per (window, score, label, prediction): all that the metrics of a window need.
    Works on static and on streaming input (``event_time``)."""
    c = df.groupBy(_window(width, slide).alias("w"), F.col(score).cast("double").alias(score), label, pred).agg(F.count(F.lit(1)).alias("_n"))
    return c.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), score, label, pred, "_n")


def metrics_of_counts(agg: DataFrame, label: str = "churn", pred: str = "pred", score: str = "proba") -> DataFrame:
    """Accuracy, precision, recall, F1, ROC AUC and average precision per window from
    stored ``window_score_counts``; a window without any score has null AUC and precision."""
    y, p, n = F.col(label), F.coalesce(F.col(pred).cast("int"), F.lit(0)), F.col("_n")

    def total(cond):
        return F.coalesce(F.sum(F.when(cond, n)), F.lit(0)).cast("long")
    counts = with_ratios(agg.groupBy("window_start", "window_end").agg(
        total((y == 1) & (p == 1)).alias("tp"), total((y != 1) & (p == 1)).alias("fp"),
        total((y != 1) & (p != 1)).alias("tn"), total((y == 1) & (p != 1)).alias("fn"),
        total(y.isNotNull()).alias("n")))
    summ = evaluate.curve_summary(evaluate.score_curve(agg, label, score, ["window_start"], weight="_n"),
                                  ["window_start"])
    return counts.join(summ.select("window_start", "roc_auc", "pr_ap"), "window_start", "left")


def windowed_metrics(df: DataFrame, width: str = "7 days", slide: str | None = None, label: str = "churn",
                     pred: str = "pred", score: str = "proba") -> DataFrame:
    """Accuracy, precision, recall, F1, ROC AUC and average precision per window
    (static input: the curves are grouped by window start).

    The events are read once: they are aggregated (map-side first) to counts per
    (window, score, label, prediction), and that table, far smaller than the
    events, is materialised; the confusion counts and the curves both read it."""
    return metrics_of_counts(materialize(window_score_counts(df, width, slide, label, pred, score)), label, pred, score)


# --- T5 -------------------------------------------------------------------------------
def _stack(df: DataFrame, cols: list[str], as_string: bool = False) -> DataFrame:
    items = [F.struct(F.lit(c).alias("feature"),
                      (F.col(c).cast("string") if as_string else F.col(c).cast("double")).alias("x")) for c in cols]
    return df.select(F.explode(F.array(*items)).alias("s")).select("s.feature", "s.x")


def _psi_from_counts(counts: DataFrame) -> DataFrame:
    """``feature, bin, n_base, n_recent`` -> PSI and the largest CDF gap per feature.

    The cumulative counts run over ranges of (feature, bin), so a feature with very many
    bins (a wide category) is spread over many tasks."""
    counts = materialize(counts)
    both = ["n_base", "n_recent"]
    totals = counts.groupBy("feature").agg(*[F.sum(c).alias(f"all_{c}") for c in both])
    p = running_totals(counts, ["feature"], "bin", both, stored=True).join(totals, "feature")
    share = {c: F.coalesce(F.try_divide(F.col(c), F.col(f"all_{c}")), F.lit(0.0)) for c in both}
    above = {c: F.coalesce(F.try_divide(F.col(f"cum_{c}"), F.col(f"all_{c}")), F.lit(0.0)) for c in both}
    pb, pr = (F.greatest(share[c], F.lit(PSI_EPS)) for c in both)
    # shares from each bin upwards differ by as much as shares up to each bin do
    return p.groupBy("feature").agg(F.sum((pr - pb) * F.log(pr / pb)).alias("psi"),
                                    F.max(F.abs(above["n_recent"] - above["n_base"])).alias("max_cdf_diff"))


def feature_drift(base: DataFrame, recent: DataFrame, numeric: list[str], categorical: list[str],
                  n_bins: int = 10) -> DataFrame:
    """Population stability index and the largest CDF difference per feature.

    Numeric features use ``n_bins`` equal-width bins over the baseline range (values
    outside go to the end bins); categorical features use their values.  Counts per
    (feature, bin) are one aggregation per side; only the two range ends per numeric
    feature reach the driver."""
    parts = []
    if numeric:
        rng = base.agg(*[x for c in numeric for x in (F.min(F.col(c).cast("double")).alias(f"lo_{c}"),
                                                      F.max(F.col(c).cast("double")).alias(f"hi_{c}"))]).collect()[0]
        lo = F.create_map(*[x for c in numeric for x in (F.lit(c), F.lit(rng[f"lo_{c}"]))])
        hi = F.create_map(*[x for c in numeric for x in (F.lit(c), F.lit(rng[f"hi_{c}"]))])

        def binned(df):
            s = _stack(df, numeric)
            l, h = F.element_at(lo, F.col("feature")), F.element_at(hi, F.col("feature"))
            width = F.when(h > l, h - l).otherwise(F.lit(1.0))
            b = F.least(F.greatest(F.floor((F.col("x") - l) / width * n_bins), F.lit(0)), F.lit(n_bins - 1))
            return s.where(F.col("x").isNotNull()).select("feature", F.lpad(b.cast("string"), 6, "0").alias("bin"))     # sort as numbers
        parts.append((binned(base), binned(recent)))
    if categorical:
        def cats(df):
            return _stack(df, categorical, as_string=True).select("feature", F.coalesce("x", F.lit("<null>")).alias("bin"))
        parts.append((cats(base), cats(recent)))
    out = None
    for b, r in parts:
        cb = b.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n_base"))
        cr = r.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n_recent"))
        j = cb.join(cr, ["feature", "bin"], "full").na.fill(0, ["n_base", "n_recent"])
        res = _psi_from_counts(j)
        out = res if out is None else out.unionByName(res)
    return out


def exact_cdf_gap(base: DataFrame, recent: DataFrame, numeric: list[str]) -> DataFrame:
    """``(feature, max_cdf_diff)``: the largest difference of the two distribution functions
    over all values (no bins).  Null and NaN take no part."""
    def values(df, name):
        s = _stack(df, numeric).select("feature", nan_to_null(F.col("x")).alias("bin")).where("bin is not null")
        return s.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias(name))
    j = values(base, "n_base").join(values(recent, "n_recent"), ["feature", "bin"], "full").na.fill(0, ["n_base", "n_recent"])
    return _psi_from_counts(j).select("feature", "max_cdf_diff")


#: Size of a quantile sketch; ranks read from it are off by at most ``SKETCH_ERROR`` of the
#: rows (two-sided, 99 % of the time), whatever the number of rows.
SKETCH_K, SKETCH_ERROR = 1600, 0.004
SKETCH_POINTS = 1000


def feature_sketches(df: DataFrame, numeric: list[str], time_col: str | None = None, width: str = "7 days") -> DataFrame:
    """``(feature[, window_start], n, sketch)``: a mergeable quantile sketch (KLL) of every
    numeric feature, per time window if given.  Kept as a table, it stands for the rows in
    all later comparisons, which merge sketches instead of scanning again."""
    when = [] if time_col is None else [F.window(time_col, width)["start"].alias("window_start")]
    items = [F.struct(F.lit(c).alias("feature"), nan_to_null(F.col(c).cast("double")).alias("x")) for c in numeric]
    d = df.select(*when, F.explode(F.array(*items)).alias("s")).select(*["window_start"] * bool(when), "s.*").where("x is not null")
    return d.groupBy("feature", *["window_start"] * bool(when)).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("x", F.lit(SKETCH_K)).alias("sketch"))


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """One sketch per feature from those of its windows."""
    return sketches.groupBy("feature").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(SKETCH_K)).alias("sketch"))


def sketch_drift(base: DataFrame, recent: DataFrame) -> DataFrame:
    """``(feature, n_base, n_recent, max_cdf_diff)`` from one sketch per feature and side.

    Each side's distribution function is read off ``SKETCH_POINTS`` quantiles, at the
    quantiles of both sides, so the gap is within ``sketch_bound()`` of the exact one."""
    probs = F.array(*[F.lit(i / SKETCH_POINTS) for i in range(SKETCH_POINTS + 1)])
    j = base.select("feature", F.col("n").alias("n_base"), F.col("sketch").alias("b")).join(
        recent.select("feature", F.col("n").alias("n_recent"), F.col("sketch").alias("r")), "feature")
    j = j.select("feature", "n_base", "n_recent", *[F.kll_sketch_get_quantile_double(s, probs).alias(s) for s in "br"])
    at = j.select("feature", "n_base", "n_recent", "b", "r", F.explode(F.array_distinct(F.concat("b", "r"))).alias("v"))
    upto = lambda s: F.size(F.filter(s, lambda q: q <= F.col("v"))) / F.lit(float(SKETCH_POINTS + 1))
    return at.groupBy("feature", "n_base", "n_recent").agg(F.max(F.abs(upto("b") - upto("r"))).alias("max_cdf_diff"))


def sketch_bound() -> float:
    """Largest difference between ``sketch_drift`` and ``exact_cdf_gap``."""
    return 2 * SKETCH_ERROR + 2 / SKETCH_POINTS


# --- T6 / T7 --------------------------------------------------------------------------
def class_drift(df: DataFrame, baseline_rate: float, width: str = "7 days", slide: str | None = None,
                label: str = "churn") -> DataFrame:
    w = df.groupBy(_window(width, slide).alias("w")).agg(F.avg(F.col(label).cast("double")).alias("label_rate"),
                                                         F.count(F.lit(1)).alias("n"))
    return w.select(F.col("w.start").alias("window_start"), "n", "label_rate",
                    F.lit(float(baseline_rate)).alias("baseline_rate"),
                    (F.col("label_rate") - F.lit(float(baseline_rate))).alias("diff"))


def prediction_drift(df: DataFrame, width: str = "7 days", slide: str | None = None, score: str = "proba",
                     pred: str = "pred", n_bins: int = 10) -> DataFrame:
    """Per window: the histogram of scores (``n_bins`` bins on [0, 1]), each bin's share,
    the mean prediction and the share flagged high risk.  Null and NaN scores share a null
    bin and are not high risk."""
    from pyspark.sql import Window
    b = F.least(F.floor(nan_to_null(F.col(score).cast("double")) * n_bins), F.lit(n_bins - 1)).cast("int")
    d = df.withColumn("w", _window(width, slide)).withColumn("bin", b)
    p, high = F.col(pred).cast("double"), reaches(F.col(score), F.lit(0.5)).cast("double")
    # one pass over the events: per (window, bin) the count and the sums behind the means;
    # the window totals are a window over that small table (at most n_bins rows each)
    hist = d.groupBy(F.col("w.start").alias("window_start"), "bin").agg(
        F.count(F.lit(1)).alias("n"), F.sum(p).alias("_sp"), F.count(p).alias("_np"),
        F.sum(high).alias("_sh"), F.count(high).alias("_nh"))
    per = Window.partitionBy("window_start")
    out = hist.select("window_start", "bin", "n", F.sum("n").over(per).alias("n_window"),
                      F.try_divide(F.sum("_sp").over(per), F.sum("_np").over(per)).alias("avg_pred"),
                      F.try_divide(F.sum("_sh").over(per), F.sum("_nh").over(per)).alias("high_risk_share"))
    return out.withColumn("share", F.col("n") / F.col("n_window"))


# --- T8 -------------------------------------------------------------------------------
def retrain_reasons(window_metrics: DataFrame, drift: DataFrame, trained_at: str, min_f1: float = 0.55,
                    max_psi: float = 0.2, max_days: int = 180) -> DataFrame:
    """Per window, the reasons to retrain: F1 below ``min_f1``; any feature PSI above
    ``max_psi``; more than ``max_days`` between training and the window end."""
    worst = drift.agg(F.max("psi").alias("max_psi")).collect()[0]["max_psi"] or 0.0   # one number
    days = F.datediff(F.col("window_end").cast("date"), F.lit(trained_at).cast("date"))
    reasons = F.filter(F.array(F.when(F.col("f1") < min_f1, F.lit("low_f1")),
                               F.when(F.lit(worst) > max_psi, F.lit("feature_drift")),
                               F.when(days > max_days, F.lit("stale_model"))), lambda x: x.isNotNull())
    return window_metrics.select("window_start", "f1", F.lit(worst).alias("max_psi"),
                                 days.alias("days_since_training"),
                                 reasons.alias("reasons"), (F.size(reasons) > 0).alias("retrain"))


# --- T9 -------------------------------------------------------------------------------
def compare_runs(metrics_long: DataFrame, role_col: str = "role") -> DataFrame:
    """``role, metric, value`` rows (champion / challenger) side by side with the difference."""
    p = metrics_long.groupBy("metric").pivot(role_col, ["champion", "challenger"]).agg(F.first("value"))
    return p.withColumn("diff", F.col("champion") - F.col("challenger"))
