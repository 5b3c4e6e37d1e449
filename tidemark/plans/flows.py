"""Composed plans over the driver tables, shared by the registered queries, the
benchmark and the tests.  Each builder returns a lazy DataFrame; the fitting steps run
small aggregation jobs and keep only bounded results (numbers, category lists)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import clean, fit, score, split
from tidemark.session import materialize, stage
from tidemark.sources.tables import raw_customers

SEED = 42
TEST_SIZE = 0.2
VAL_SIZE = 0.1

NUMERIC = ["tenure_months", "monthly_charges", "total_charges", "order_count", "account_balance"]

# Fixed parameters: four linear scorers on standardised features.  They stand in for
# fitted model families so that metrics, thresholds and the run log are computed
# from real scores (fitted pyspark.ml models are exercised separately).
SCORERS = {
    "logreg": (-1.4, {"order_count": -1.1, "tenure_months": -0.4, "monthly_charges": 0.3, "account_balance": -0.1}),
    "logreg_fe": (-1.5, {"order_count": -1.3, "total_charges": 0.2, "tenure_months": -0.2,
                         "contract_type_2-HIGH": 0.1}),
    "xgb": (-1.2, {"order_count": -0.9, "monthly_charges": 0.5, "account_balance": 0.05}),
    "rf": (-1.3, {"order_count": -1.0, "tenure_months": -0.6}),
}


def clean_table(spark: SparkSession, sf_dir: str, strict_compat: bool = False) -> DataFrame:
    """Canonical names, label, key, trimmed text, numeric text coerced."""
    d, t = clean.standardize_raw(raw_customers(spark, sf_dir), "churn", strict_compat)
    return clean.coerce_numeric(d, exclude=(t, "row_key"), known=NUMERIC)


def encoding_spec(spark: SparkSession, sf_dir: str) -> clean.EncodingSpec:
    d, t = clean.standardize_raw(raw_customers(spark, sf_dir))
    return clean.fit_encoding(materialize(d), t, known=NUMERIC)   # fitted on all rows, as the original order of steps does


def prepared_table(spark: SparkSession, sf_dir: str, spec: clean.EncodingSpec | None = None) -> DataFrame:
    """``row_key``, numeric features (imputed), boolean dummies, ``churn``."""
    d = materialize(clean.standardize_raw(raw_customers(spark, sf_dir))[0])     # read by fitting and by the result
    return clean.apply_encoding(d, spec or clean.fit_encoding(d, "churn", known=NUMERIC))


#: Tables that the churn data come from.
INPUTS = ("customer", "nation", "region", "orders")


def _inputs(sf_dir: str) -> list[str]:
    return [os.path.join(sf_dir, f"{t}.parquet") for t in INPUTS]


def new_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prepared table with its ``split`` column, from the raw tables.  The standardised
    raw table is written once for the fitting passes and the final projection."""
    raw, t = clean.standardize_raw(raw_customers(spark, sf_dir))
    raw = materialize(raw)
    prepared = clean.apply_encoding(raw, clean.fit_encoding(raw, t, known=NUMERIC))
    return split.stratified_split(prepared, "churn", TEST_SIZE, VAL_SIZE, SEED)


def split_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``new_split`` as a stage output (the processed-data files of the original): fitting,
    scoring and evaluation read it, and it is made again when a raw table changes."""
    return stage(spark, "split", _inputs(sf_dir), lambda: new_split(spark, sf_dir))


def standardized_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 then M1 fitted on the train rows only."""
    sp = split_table(spark, sf_dir)
    stats = fit.fit_standardizer(sp.where(F.col("split") == "train"), NUMERIC)
    return fit.standardize(sp, stats)


def scored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer scored by every fixed scorer: ``row_key, churn, split, model_name, proba``;
    a stage output like the split."""
    def build():
        return score.linear_score_many(standardized_split(spark, sf_dir), SCORERS).select("row_key", "churn", "split", "model_name", "proba")
    return stage(spark, "scores", _inputs(sf_dir), build)


def tied(scores: DataFrame) -> DataFrame:
    """Scores rounded to 9 places, so that two engines agree on which ones tie on a curve;
    the operators themselves compare and return scores as they are."""
    return scores.withColumn("proba", F.round("proba", 9))


# Model key of each scorer (the keys the run log and registry use).
MODEL_KEYS = {"logreg": "LogReg", "rf": "RF", "xgb": "XGB", "logreg_fe": "FE"}
SPLIT_INDEX = {"train": 0, "valid": 1, "test": 2}
METRIC_NAMES = ["accuracy", "precision", "recall", "f1", "roc_auc", "pr_ap"]


def run_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per (scorer, split): ids, names, experiment, model key and registered
    name, start time and six metrics computed from the scores."""
    from tidemark.operators import evaluate, runs
    sc = score.apply_threshold(scored_table(spark, sf_dir), 0.5)
    by = ["model_name", "split"]
    m = evaluate.classification_metrics(sc, "churn", "pred", by)
    cs = evaluate.curve_summary(evaluate.score_curve(tied(sc), "churn", "proba", by), by)
    w = m.join(cs.select(*by, "roc_auc", "pr_ap"), by)   # one row per (scorer, split) on each side
    key = runs.lookup(MODEL_KEYS, F.col("model_name"))
    pos = F.array_position(F.array(*[F.lit(k) for k in runs.METRIC_FILES]), key).cast("int") - 1
    suffix = F.regexp_extract(runs.lookup(runs.METRIC_FILES, key), r"^metrics_test(.*)\.json$", 1)
    hours = pos * 3 + runs.lookup(SPLIT_INDEX, F.col("split"))
    return materialize(w.select(
        F.md5(F.concat_ws("|", "model_name", "split")).alias("run_id"),
        F.concat(F.lit("metrics_"), F.col("split"), suffix).alias("run_name"),
        F.lit("telco_churn").alias("experiment_name"),
        key.alias("model_key"),
        runs.registered_name(key).alias("registered_model"),
        "split", pos.alias("position"),
        (F.lit("2024-02-01 00:00:00").cast("timestamp_ntz") + F.make_interval(hours=hours)).alias("start_time"),
        *METRIC_NAMES))


def metric_documents(runs_df: DataFrame) -> DataFrame:
    """One nested JSON metrics document per model key, built from the run log:
    metrics by split, parameters, a boolean flag, a list and a text field."""
    metric_struct = F.struct(*[F.col(m) for m in METRIC_NAMES])
    per = runs_df.groupBy("model_key", "position").agg(
        *[F.max(F.when(F.col("split") == s, metric_struct)).alias(s) for s in ("train", "valid", "test")])
    doc = F.to_json(F.struct("train", "valid", "test",
                             F.struct(F.lit(0.5).alias("threshold"), F.col("model_key").alias("model")).alias("params"),
                             F.lit(True).alias("calibrated"),
                             F.array(F.lit("train"), F.lit("valid"), F.lit("test")).alias("splits"),
                             F.lit("scored at 0.5").alias("note")))
    return per.select("model_key", "position", doc.alias("doc"))
