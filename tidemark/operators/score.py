"""Scoring: probabilities from fitted models or from a coefficient table, score
fallbacks, thresholds (explicit, from documents, per model family), prediction-shape
normalisation, response flattening, score tables and an audit log.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import checked_collect

DEFAULT_THRESHOLD = 0.5
# Threshold keys in the order they are looked up in a threshold document.
THRESHOLD_KEYS = ("best_threshold", "threshold", "best", "value")


# --- P1 -------------------------------------------------------------------------------
def score(model, df: DataFrame, out: str = "proba") -> DataFrame:
    """Positive-class probability of a fitted ``pyspark.ml`` model (features already
    assembled into the model's input column)."""
    res = model.transform(df)
    prob_col = "probability"
    return res.withColumn(out, vector_to_array(F.col(prob_col)).getItem(1)).drop("rawPrediction", prob_col, "prediction")


# --- P2 -------------------------------------------------------------------------------
def minmax_score(df: DataFrame, col: str, out: str = "proba", by: list[str] | None = None) -> DataFrame:
    """Decision scores squashed to [0, 1] by the batch min and max (+1e-12).

    A global aggregate (two numbers reach the driver), or per group an equi-join on the
    group keys (AQE broadcasts the per-group table from its exact runtime size); never
    an unpartitioned window.
    """
    if by:
        mm = df.groupBy(*by).agg(F.min(col).alias("_mn"), F.max(col).alias("_mx"))
        mm = mm.withColumnsRenamed({c: f"_by_{c}" for c in by})      # null groups are groups
        same = [df[c].eqNullSafe(mm[f"_by_{c}"]) for c in by]
        d = df.join(mm, same).drop(*[f"_by_{c}" for c in by])
        return d.withColumn(out, (F.col(col) - F.col("_mn")) / (F.col("_mx") - F.col("_mn") + F.lit(1e-12))).drop("_mn", "_mx")
    row = df.agg(F.min(col).alias("mn"), F.max(col).alias("mx")).collect()[0]
    if row["mn"] is None:
        return df.withColumn(out, F.lit(None).cast("double"))
    return df.withColumn(out, (F.col(col) - F.lit(row["mn"])) / F.lit(row["mx"] - row["mn"] + 1e-12))


def log_odds(proba: Column) -> Column:
    """The decision behind a probability.  One that has been rounded to 0 or 1 has an
    infinite decision (a plain division by ``1 - proba`` is an error there)."""
    return (F.when(proba == 1, F.lit(float("inf"))).when(proba == 0, F.lit(float("-inf")))
            .otherwise(F.log(proba / (1 - proba))))


# --- P3 -------------------------------------------------------------------------------
def hard_to_float(df: DataFrame, col: str, out: str = "proba") -> DataFrame:
    return df.withColumn(out, F.col(col).cast("double"))


# --- P4 -------------------------------------------------------------------------------
def apply_threshold(df: DataFrame, t=DEFAULT_THRESHOLD, col: str = "proba", out: str = "pred") -> DataFrame:
    """``pred = int(proba >= t)``; ``t`` is a number or a Column (per-row thresholds).
    A null or NaN score reaches no threshold (Spark alone would order NaN above all
    numbers), and no score reaches a null threshold."""
    return df.withColumn(out, reaches(F.col(col), t if isinstance(t, Column) else F.lit(float(t))).cast("int"))


def reaches(score: Column, t) -> Column:
    """Whether a score reaches a threshold: never null, false for a null or NaN score."""
    return F.coalesce((score >= t) & ~F.isnan(score.cast("double")), F.lit(False))


# --- P5 -------------------------------------------------------------------------------
def threshold_from_doc(doc: Column, explicit: float | None = None) -> Column:
    """Explicit value, else the first present key of a JSON threshold document, else 0.5.
    Malformed documents fall through to the default."""
    if explicit is not None:
        return F.lit(float(explicit))
    v = F.try_parse_json(doc)
    return F.coalesce(*[F.try_variant_get(v, f"$.{k}", "double") for k in THRESHOLD_KEYS],
                      F.lit(DEFAULT_THRESHOLD))


def resolve_threshold(df: DataFrame, doc_col: str = "doc", explicit: float | None = None,
                      out: str = "threshold") -> DataFrame:
    return df.withColumn(out, threshold_from_doc(F.col(doc_col), explicit))


# --- P6 -------------------------------------------------------------------------------
def model_family(name: Column) -> Column:
    """``xgb``, ``rf`` (also "randomforest") or ``general`` from a model name."""
    low = F.lower(name)
    return (F.when(low.contains("xgb"), F.lit("xgb"))
            .when(low.contains("randomforest") | low.contains("rf"), F.lit("rf"))
            .otherwise(F.lit("general")))


def threshold_for_model(models: DataFrame, thresholds: DataFrame, name_col: str = "model_name",
                        out: str = "threshold") -> DataFrame:
    """Threshold per model: its family's threshold if present, else the general one,
    else 0.5.  ``thresholds`` (``family, threshold``) is a parameter table of a few rows:
    it is collected after a size check and applied as a literal map (no join)."""
    rows = checked_collect(thresholds.select("family", "threshold").where(F.col("threshold").isNotNull()),
                           1_000, "threshold table")
    table = {}
    for r in rows:
        table.setdefault(r["family"], float(r["threshold"]))
    fam = model_family(F.col(name_col))
    lookup = F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.lit(v))]) if table else None
    got = F.element_at(lookup, fam) if lookup is not None else F.lit(None).cast("double")
    general = F.lit(table.get("general", DEFAULT_THRESHOLD))
    return models.withColumn(out, F.coalesce(got, general).cast("double"))


# --- P7 -------------------------------------------------------------------------------
def normalize_array_predictions(df: DataFrame, col: str, out_proba: str = "proba", out_class: str = "pred_class") -> DataFrame:
    """Per-row prediction arrays: length 2 -> second entry is the probability; length k > 2
    -> class = argmax (first maximum); length 1 -> the single value."""
    arr = F.col(col).cast("array<double>")
    n = F.size(arr)
    argmax = (F.array_position(arr, F.array_max(arr)) - 1).cast("int")
    return (df.withColumn(out_proba, F.when(n == 2, F.element_at(arr, 2)).when(n == 1, F.element_at(arr, 1)))
              .withColumn(out_class, F.when(n > 2, argmax).when(n == 2, (F.element_at(arr, 2) >= 0.5).cast("int"))
                          .when(n == 1, F.element_at(arr, 1).cast("int"))))


def normalize_scalar_predictions(df: DataFrame, col: str, by: list[str] | None = None,
                                 out_proba: str = "proba", out_kind: str = "kind") -> DataFrame:
    """1-D predictions: the batch (or group) is probabilities when every value is in
    [0, 1] and the distinct values are not exactly {0, 1}; otherwise classes.  One
    aggregate per batch decides."""
    v = F.col(col).cast("double")
    stats = (df.groupBy(*(by or [])).agg(
        F.min(v).alias("_mn"), F.max(v).alias("_mx"),
        F.max(F.when((v != 0) & (v != 1), 1).otherwise(0)).alias("_other"),
        F.count_distinct(F.when((v == 0) | (v == 1), v)).alias("_n01")))
    kind = F.when((F.col("_mn") >= 0) & (F.col("_mx") <= 1) & ~((F.col("_other") == 0) & (F.col("_n01") == 2)),
                  F.lit("proba")).otherwise(F.lit("class"))
    stats = stats.select(*(by or []), kind.alias(out_kind))
    if by:
        d = df.join(stats, by)
    else:
        k = stats.collect()[0][out_kind]
        d = df.withColumn(out_kind, F.lit(k))
    return d.withColumn(out_proba, F.when(F.col(out_kind) == "proba", v))


# --- P8 -------------------------------------------------------------------------------
def explode_predictions(df: DataFrame, json_col: str, out: str = "prediction", pos: str = "pos") -> DataFrame:
    """Rows from ``{"predictions": [...]}`` or a bare JSON array; bad documents give no rows."""
    v = F.try_parse_json(F.col(json_col))
    inner = F.coalesce(F.try_variant_get(v, "$.predictions", "array<double>"),
                       F.try_variant_get(v, "$", "array<double>"))
    return df.select("*", F.posexplode(inner).alias(pos, out)).drop(json_col)


# --- P9 -------------------------------------------------------------------------------
# The column names of the score table.
def score_table(df: DataFrame, key: str, t: float, scoring_date: str, proba: str = "proba") -> DataFrame:
    """``customer_id, score_churn, flag_alto_riesgo, fecha_scoring``; append with
    ``partitionBy("fecha_scoring")`` for one partition per date.  A null or NaN score is
    not flagged."""
    return df.select(F.col(key).alias("customer_id"), F.col(proba).alias("score_churn"),
                     reaches(F.col(proba), F.lit(float(t))).cast("int").alias("flag_alto_riesgo"),
                     F.lit(scoring_date).cast("date").alias("fecha_scoring"))


# --- P10 ------------------------------------------------------------------------------
def linear_score(df: DataFrame, coef: dict, intercept: float = 0.0, out: str = "proba") -> DataFrame:
    """``1 / (1 + exp(-(b + w.x)))`` as one column expression (stays in codegen)."""
    z = F.lit(float(intercept))
    for c, w in coef.items():
        z = z + F.lit(float(w)) * F.col(c).cast("double")
    return df.withColumn(out, F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))


def linear_score_many(df: DataFrame, models: dict, model_col: str = "model_name", out: str = "proba") -> DataFrame:
    """Score every row under several coefficient sets in one pass: one struct per model,
    exploded (rows x models output, no join).  ``models``: name -> (intercept, {feature: weight})."""
    items = []
    for name, (b, coef) in models.items():
        z = F.lit(float(b))
        for c, w in coef.items():
            z = z + F.lit(float(w)) * F.col(c).cast("double")
        items.append(F.struct(F.lit(name).alias(model_col), (F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).alias(out)))
    return df.withColumn("_m", F.explode(F.array(*items))).select("*", f"_m.{model_col}", f"_m.{out}").drop("_m")


def coefficients_from_table(coef_table: DataFrame, model_col: str = "model_name") -> dict:
    """``model_name, feature, weight`` rows (feature ``__intercept__`` is the bias) to the
    dict form; the table is a parameter and is size-checked before collection."""
    out: dict = {}
    for r in checked_collect(coef_table, 100_000, "coefficient table"):
        b, coef = out.setdefault(r[model_col], [0.0, {}])
        if r["feature"] == "__intercept__":
            out[r[model_col]][0] = float(r["weight"])
        else:
            coef[r["feature"]] = float(r["weight"])
    return {k: (v[0], v[1]) for k, v in out.items()}


# --- P11 ------------------------------------------------------------------------------
def audit_log(df: DataFrame, key: str, inputs: list[str], requested_by: str, scored_at: str,
              proba: str = "proba") -> DataFrame:
    """Who asked, a summary of the inputs (count of present inputs, their sum), the
    score and the time; append-only."""
    present = sum((F.col(c).isNotNull().cast("int") for c in inputs), F.lit(0))
    total = sum((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in inputs), F.lit(0.0))
    return df.select(F.lit(requested_by).alias("requested_by"), F.col(key).alias("row_key"),
                     present.alias("n_inputs"), total.alias("input_sum"), F.col(proba).alias("score"),
                     F.lit(scored_at).cast("timestamp").alias("scored_at"))
