"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) ->
DataFrame`` over the driver tables, and the DuckDB SQL twin where one exists.

Reported floats are rounded once, to 6 places, in both engines; scores are rounded to 9
places before grouping into curve points.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exprs import r6
from tidemark.operators import clean, evaluate, fit, score, split, trees
from tidemark.plans import flows
from tidemark.plans import sql as S
from tidemark.session import materialize, shared_path
from tidemark.sources import files, tables

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def _r6_all(df: DataFrame) -> DataFrame:
    """Round every double column to 6 places (for comparison across engines)."""
    return df.select(*[r6(f.name).alias(f.name) if f.dataType.typeName() in ("double", "float") else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def _r6_sql(cols: list[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


# ------------------------------------------------------------------ sources / cleaning
@register("churn_features", S.with_(S.CHURN, body="SELECT * REPLACE (round(monthly_charges, 6) AS monthly_charges) FROM churn_t"))
def q_churn_features(spark, sf):
    return _r6_all(tables.churn_customers(spark, sf))


_CANON = ('"customerID" AS customerid, "Tenure Months" AS tenure_months, round("Monthly Charges", 6) AS monthly_charges, '
          '"Total Charges" AS total_charges, "Order Count" AS order_count, "Account Balance" AS account_balance, '
          '"Contract Type" AS contract_type, "Region" AS region, "Payment-Method" AS payment_method, "Churn" AS churn')


@register("canonicalize_columns", S.with_(S.CHURN, S.RAW, body=f"SELECT {_CANON} FROM raw_t"))
def q_canonicalize(spark, sf):
    return _r6_all(clean.canonicalize(tables.raw_customers(spark, sf)))


@register("encode_label", S.with_(S.CHURN, S.RAW, body="""
SELECT "customerID" AS row_key,
       CAST(CASE WHEN lower(trim("Churn")) = 'yes' THEN 1 WHEN lower(trim("Churn")) = 'no' THEN 0
            ELSE coalesce(TRY_CAST(TRY_CAST(trim("Churn") AS DOUBLE) AS INTEGER), 0) END AS INTEGER) AS churn,
       CAST(CASE WHEN lower(trim("Churn")) = 'yes' THEN 1 ELSE 0 END AS INTEGER) AS churn_strict
FROM raw_t"""))
def q_encode_label(spark, sf):
    d = clean.canonicalize(tables.raw_customers(spark, sf))
    t = clean.find_target(d, "Churn")
    d = clean.encode_label(d, t, strict_compat=True, out="churn_strict")
    d = clean.encode_label(d, t)
    return d.select(F.col("customerid").alias("row_key"), "churn", "churn_strict")


@register("drop_id_like", S.with_(S.CHURN, S.RAW, body=f"SELECT * EXCLUDE (customerid), customerid AS row_key FROM (SELECT {_CANON} FROM raw_t)"))
def q_drop_id_like(spark, sf):
    return _r6_all(clean.drop_id_like(clean.canonicalize(tables.raw_customers(spark, sf))))


@register("trim_strings", S.with_(S.CHURN, S.RAW, body="""
SELECT "customerID" AS row_key, "Tenure Months" AS tenure_months, round("Monthly Charges", 6) AS monthly_charges,
       trim("Total Charges") AS total_charges, "Order Count" AS order_count, "Account Balance" AS account_balance,
       trim("Contract Type") AS contract_type, trim("Region") AS region, trim("Payment-Method") AS payment_method,
       trim("Churn") AS churn
FROM raw_t"""))
def q_trim(spark, sf):
    return _r6_all(clean.trim_strings(clean.drop_id_like(clean.canonicalize(tables.raw_customers(spark, sf)))))


@register("coerce_numeric", S.with_(S.CHURN, S.RAW, S.CLEAN, body="SELECT * REPLACE (round(monthly_charges, 6) AS monthly_charges) FROM clean_t"))
def q_coerce(spark, sf):
    return _r6_all(flows.clean_table(spark, sf))


@register("impute_median", S.with_(S.CHURN, S.RAW, S.CLEAN, S.IMPUTED,
                                   body=f"SELECT * REPLACE ({_r6_sql(S.NUMERIC)}) FROM imp_t"))
def q_impute(spark, sf):
    d = flows.clean_table(spark, sf)
    kinds = clean.column_kinds(d, exclude=("churn", "row_key"))
    return _r6_all(clean.impute_median(d, kinds["numeric"]))


@register("one_hot_encode", S.with_(S.CHURN, S.RAW, S.CLEAN, body=f"""
SELECT row_key, tenure_months, round(monthly_charges, 6) AS monthly_charges, total_charges, order_count, account_balance,
       churn, {S._dummies()} FROM clean_t"""))
def q_one_hot(spark, sf):
    d = flows.clean_table(spark, sf)
    kinds = clean.column_kinds(d, exclude=("churn", "row_key"))
    return _r6_all(clean.one_hot(d, clean.fit_categories(d, kinds["categorical"])))


@register("wide_one_hot", """
WITH v AS (SELECT ref, row_number() OVER (ORDER BY ref) - 1 AS rank, count(*) OVER () AS n
           FROM (SELECT DISTINCT 'ORD-' || CAST(l_orderkey AS VARCHAR) AS ref FROM lineitem WHERE l_orderkey % 97 <> 0))
SELECT l.l_orderkey, l.l_linenumber, l.l_returnflag = 'N' AS l_returnflag_N, l.l_returnflag = 'R' AS l_returnflag_R,
       CASE WHEN v.rank >= 1 THEN '(' || (SELECT max(n) - 1 FROM v) || ',[' || (v.rank - 1) || '],[1.0])'
            ELSE '(' || (SELECT max(n) - 1 FROM v) || ',[],[])' END AS order_ref
FROM lineitem l LEFT JOIN v ON l.l_orderkey % 97 <> 0 AND v.ref = 'ORD-' || CAST(l.l_orderkey AS VARCHAR)""")
def q_wide_one_hot(spark, sf):
    """C10 on lineitem: a text column with a value per order (far more than dummies can
    hold, some null) as a sparse vector, beside the dummies of a narrow column."""
    ref = F.when(F.col("l_orderkey") % 97 != 0, F.concat(F.lit("ORD-"), F.col("l_orderkey").cast("string")))
    d = tables.load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", ref.alias("order_ref"))
    spec = clean.fit_encoding(d, "l_linenumber", "l_orderkey")
    e = clean.one_hot_sparse(clean.one_hot(d, spec.categories), spark.read.parquet(spec.dictionary))
    return e.select("l_orderkey", "l_linenumber", "l_returnflag_N", "l_returnflag_R",
                    F.col(clean.vector_name("order_ref")).cast("string").alias("order_ref"))


@register("prepared_features", S.chain(upto="prep", body=f"SELECT * REPLACE ({_r6_sql(S.NUMERIC)}) FROM prep_t"))
def q_prepared(spark, sf):
    return _r6_all(flows.prepared_table(spark, sf))


@register("derived_features", S.chain(upto="prep", body=f"""
SELECT * REPLACE ({_r6_sql(S.NUMERIC)}), round(tenure_months * monthly_charges, 6) AS tenure_x_monthly FROM prep_t"""))
def q_derived(spark, sf):
    d = clean.add_features(flows.prepared_table(spark, sf), {"tenure_x_monthly": "tenure_months * monthly_charges"})
    return _r6_all(d)


def _feature_list_sql() -> str:
    feats = S.NUMERIC + [f"{c}_{v}" for c, vs in S.CATEGORIES.items() for v in vs[1:]]
    return ",".join(feats)


@register("dataset_manifest", S.chain(upto="split", body=f"""
SELECT CAST(count(*) AS BIGINT) AS n_rows_raw, 10 AS n_cols_raw, {len(S.NUMERIC) + 12} AS n_features,
       '{_feature_list_sql()}' AS features,
       CAST(count(*) FILTER (WHERE split = 'train') AS BIGINT) AS train,
       CAST(count(*) FILTER (WHERE split = 'valid') AS BIGINT) AS valid,
       CAST(count(*) FILTER (WHERE split = 'test') AS BIGINT) AS test,
       'churn' AS target, 42 AS seed, CAST(0.2 AS DOUBLE) AS test_size, CAST(0.1 AS DOUBLE) AS val_size
FROM split_t"""))
def q_manifest(spark, sf):
    raw = tables.raw_customers(spark, sf)
    d, t = clean.standardize_raw(raw)
    d = materialize(d)
    spec = clean.fit_encoding(d, t)
    sp = split.stratified_split(clean.apply_encoding(d, spec), "churn", flows.TEST_SIZE, flows.VAL_SIZE, flows.SEED)
    m = clean.manifest(raw, spec, sp, flows.SEED, flows.TEST_SIZE, flows.VAL_SIZE)
    return m.select("n_rows_raw", "n_cols_raw", "n_features", F.array_join("features", ",").alias("features"),
                    "splits.train", "splits.valid", "splits.test", "target", "seed", "test_size", "val_size")


@register("drop_label_columns", S.chain(upto="prep", body=f"SELECT * EXCLUDE (churn) REPLACE ({_r6_sql(S.NUMERIC)}) FROM prep_t"))
def q_drop_labels(spark, sf):
    return _r6_all(clean.drop_labels(flows.prepared_table(spark, sf), ["Churn"]))


VALID_REGIONS = S.CATEGORIES["region"]


def _rules():
    return {
        "total_charges_numeric": clean.numeric_text_rule("total_charges"),
        "tenure_present": F.col("tenure_months").isNotNull() & (F.col("tenure_months") >= 0),
        "region_known": F.col("region").isin(VALID_REGIONS),
        "label_yes_no": F.lower(F.col("churn")).isin("yes", "no"),
    }


@register("validate_rows", S.with_(S.CHURN, S.RAW, r"""
t AS (SELECT "customerID" AS row_key, "Tenure Months" AS tenure_months, trim("Total Charges") AS total_charges,
             trim("Region") AS region, trim("Churn") AS churn FROM raw_t),
v AS (SELECT row_key, list_filter([
        CASE WHEN NOT coalesce(regexp_matches(trim(total_charges), '^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$'), false) THEN 'total_charges_numeric' END,
        CASE WHEN NOT coalesce(tenure_months IS NOT NULL AND tenure_months >= 0, false) THEN 'tenure_present' END,
        CASE WHEN NOT coalesce(region IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'), false) THEN 'region_known' END,
        CASE WHEN NOT coalesce(lower(churn) IN ('yes', 'no'), false) THEN 'label_yes_no' END], lambda x: x IS NOT NULL) AS vs FROM t)
""", body="SELECT row_key, CAST(len(vs) AS INTEGER) AS n_violations, array_to_string(vs, ',') AS violations FROM v"))
def q_validate(spark, sf):
    d = clean.trim_strings(clean.drop_id_like(clean.canonicalize(tables.raw_customers(spark, sf))))
    v = clean.validate(d, _rules())
    return v.select("row_key", F.size("violations").alias("n_violations"),
                    F.array_join("violations", ",").alias("violations"))


@register("csv_roundtrip", S.with_(S.CHURN, S.RAW, S.CLEAN, body=f"""
SELECT row_key, CAST(tenure_months AS DOUBLE) AS tenure_months, round(monthly_charges, 6) AS monthly_charges,
       total_charges, CAST(order_count AS DOUBLE) AS order_count, account_balance, contract_type, region,
       payment_method, churn FROM clean_t"""))
def q_csv_roundtrip(spark, sf):
    path = shared_path(spark, "csv_roundtrip", uuid.uuid4().hex)
    files.write_table(tables.raw_customers(spark, sf), path, fmt="csv")
    d, t = clean.standardize_raw(files.read_table(spark, path))
    d = clean.coerce_numeric(d, exclude=(t, "row_key"))
    return _r6_all(d.withColumn("row_key", F.col("row_key").cast("long")))


@register("processed_csv_roundtrip", S.chain(upto="prep", body=f"SELECT * REPLACE ({_r6_sql(S.NUMERIC)}) FROM prep_t"))
def q_processed_csv_roundtrip(spark, sf):
    """The prepared table as the original keeps it: CSV, read back with its booleans."""
    path = shared_path(spark, "processed_csv", uuid.uuid4().hex)
    files.write_table(flows.prepared_table(spark, sf), path, fmt="csv")
    d = clean.restore_booleans(files.read_table(spark, path))
    d = clean.coerce_numeric(d, exclude=("churn", "row_key"))
    return _r6_all(d.withColumns({"row_key": F.col("row_key").cast("long"), "churn": F.col("churn").cast("int")}))


@register("csv_quoted_breaks", """
SELECT doc_id, CASE WHEN text IN ('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', '<NA>', 'N/A', 'NA',
                                  'NULL', 'NaN', 'None', 'n/a', 'nan', 'null') THEN NULL ELSE text END AS text,
       lang, CAST(length(text) AS BIGINT) AS n FROM documents""")
def q_csv_quoted_breaks(spark, sf):
    """Documents - line breaks, quotes and commas inside cells - written as CSV and read
    back by several tasks a file."""
    path = shared_path(spark, "csv_breaks", uuid.uuid4().hex)
    d = tables.load(spark, sf, "documents").select("doc_id", "text", "lang", F.length("text").cast("long").alias("n"))
    files.write_table(d, path, fmt="csv")
    back = files.read_table(spark, path)
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", F.col("n").cast("long").alias("n"))


# ------------------------------------------------------------------ splits / sampling
@register("stratified_split", S.chain(upto="split", body="SELECT row_key, churn, split FROM split_t"))
def q_split(spark, sf):
    return flows.new_split(spark, sf).select("row_key", "churn", "split")


@register("shuffle_positions", S.chain(upto="prep", body="""
SELECT row_key, row_number() OVER (ORDER BY md5(CAST(row_key AS VARCHAR) || '|42'), row_key) - 1 AS position FROM prep_t"""))
def q_shuffle_positions(spark, sf):
    """The seeded order over the union of the three splits."""
    d = flows.split_table(spark, sf).select("row_key", "split")
    parts = [d.where(F.col("split") == s).select("row_key") for s in ("train", "valid", "test")]
    return split.shuffle_position(split.union_parts(*parts), flows.SEED).select("row_key", "position")


@register("split_counts", S.chain(upto="split", body="SELECT split, churn, CAST(count(*) AS BIGINT) AS n FROM split_t GROUP BY ALL"))
def q_split_counts(spark, sf):
    return flows.split_table(spark, sf).groupBy("split", "churn").agg(F.count(F.lit(1)).alias("n"))


@register("stratified_folds", S.chain(upto="prep", body="""
SELECT row_key, churn,
       CAST((row_number() OVER (PARTITION BY churn ORDER BY md5(CAST(row_key AS VARCHAR) || '|42'), row_key) - 1) % 3 AS INTEGER) AS fold
FROM prep_t"""))
def q_folds(spark, sf):
    return split.stratified_folds(flows.prepared_table(spark, sf), "churn", 3, flows.SEED).select("row_key", "churn", "fold")


@register("ordered_folds", S.chain(upto="prep", body="""
SELECT row_key, churn, CAST((row_number() OVER (PARTITION BY churn ORDER BY row_key) - 1) % 3 AS INTEGER) AS fold
FROM prep_t"""))
def q_ordered_folds(spark, sf):
    return split.stratified_folds(flows.prepared_table(spark, sf), "churn", 3, shuffle=False).select("row_key", "churn", "fold")


@register("head_sample", S.chain(upto="prep", body=f"SELECT * REPLACE ({_r6_sql(S.NUMERIC)}) FROM prep_t ORDER BY row_key LIMIT 5"))
def q_head(spark, sf):
    return _r6_all(split.head_sample(flows.prepared_table(spark, sf), 5))


ARMS = {"control": 0.5, "treatment": 0.3, "holdout": 0.2}


@register("traffic_arms", S.chain(upto="prep", body="""
SELECT row_key,
       CASE WHEN u < CAST(0.5 AS DOUBLE) THEN 'control' WHEN u < CAST(0.8 AS DOUBLE) THEN 'treatment' ELSE 'holdout' END AS arm
FROM (SELECT row_key, CAST(('0x' || substr(md5(CAST(row_key AS VARCHAR) || '|7'), 1, 8)) AS BIGINT) / 4294967296.0 AS u FROM prep_t)"""))
def q_arms(spark, sf):
    return split.assign_arm(flows.prepared_table(spark, sf), ARMS, seed=7).select("row_key", "arm")


# ------------------------------------------------------------------ fitting helpers (M1, M2)
@register("standardized_features", S.chain(upto="std", body=f"SELECT row_key, split, {_r6_sql(S.NUMERIC)} FROM std_t"))
def q_standardized(spark, sf):
    return _r6_all(flows.standardized_split(spark, sf).select("row_key", "split", *flows.NUMERIC))


@register("class_weights", S.chain(upto="split", body="""
SELECT churn, CAST(count(*) AS BIGINT) AS n,
       round(sum(count(*)) OVER () / (2.0 * count(*)), 6) AS weight
FROM split_t WHERE split = 'train' GROUP BY churn"""))
def q_class_weights(spark, sf):
    tr = flows.split_table(spark, sf).where(F.col("split") == "train")
    w = fit.fit_class_weights(tr)
    return _r6_all(fit.with_class_weights(tr, w).groupBy("churn").agg(F.count(F.lit(1)).alias("n"), F.first("weight").alias("weight")))


# ------------------------------------------------------------------ scoring
def _valid_scores(spark, sf):
    return flows.tied(flows.scored_table(spark, sf).where(F.col("split") == "valid"))


@register("split_metrics", S.chain(body=f"""
SELECT model_name, split, tp, fp, tn, fn, n, {S.RATIOS} FROM (
  SELECT model_name, split, {S.metrics_cols("CAST(proba >= 0.5 AS INTEGER)")} FROM scored_t GROUP BY model_name, split)"""))
def q_split_metrics(spark, sf):
    """Flagship: churn table -> exact split -> linear score -> metrics per model and split."""
    sc = score.apply_threshold(flows.scored_table(spark, sf), 0.5)
    return _r6_all(evaluate.classification_metrics(sc, "churn", "pred", ["model_name", "split"]))


@register("linear_scores", S.chain(body="SELECT row_key, model_name, split, round(proba, 6) AS proba FROM scored_t"))
def q_linear_scores(spark, sf):
    rows = [(m, f, float(w)) for m, (b, coef) in flows.SCORERS.items() for f, w in [("__intercept__", b), *coef.items()]]
    table = spark.createDataFrame(rows, "model_name string, feature string, weight double")
    sc = score.linear_score_many(flows.standardized_split(spark, sf), score.coefficients_from_table(table))
    return _r6_all(sc.select("row_key", "model_name", "split", "proba"))


@register("minmax_scores", S.chain("""
dec_t AS (SELECT row_key, model_name, ln(proba / (1 - proba)) AS decision FROM scored_t),
mm_t AS (SELECT model_name, min(decision) AS mn, max(decision) AS mx FROM dec_t GROUP BY model_name)""",
    body="SELECT d.row_key, d.model_name, round((d.decision - m.mn) / (m.mx - m.mn + 1e-12), 6) AS proba "
         "FROM dec_t d JOIN mm_t m USING (model_name)"))
def q_minmax(spark, sf):
    d = flows.scored_table(spark, sf).select("row_key", "model_name", score.log_odds(F.col("proba")).alias("decision"))
    return _r6_all(score.minmax_score(d, "decision", "proba", by=["model_name"]).select("row_key", "model_name", "proba"))


@register("threshold_predictions", S.chain(body="""
SELECT row_key, model_name, CAST(proba >= 0.5 AS INTEGER) AS pred, CAST(CAST(proba >= 0.5 AS INTEGER) AS DOUBLE) AS pred_score
FROM scored_t"""))
def q_predictions(spark, sf):
    d = score.apply_threshold(flows.scored_table(spark, sf), 0.5)
    return score.hard_to_float(d, "pred", "pred_score").select("row_key", "model_name", "pred", "pred_score")


# ------------------------------------------------------------------ evaluation
_BY = ["model_name"]


@register("pr_curve", S.chain(S.CURVE, body="""
SELECT model_name, round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp FROM curve_t"""))
def q_pr_curve(spark, sf):
    return _r6_all(evaluate.pr_curve(_valid_scores(spark, sf), by=_BY))


@register("roc_curve", S.chain(S.CURVE, body="""
SELECT model_name, round(threshold, 6) AS threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr,
       CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp FROM curve_t"""))
def q_roc_curve(spark, sf):
    return _r6_all(evaluate.roc_curve(_valid_scores(spark, sf), by=_BY))


@register("curve_summary", S.chain(S.CURVE, body="""
SELECT model_name, round(roc_auc, 6) AS roc_auc, round(pr_ap, 6) AS pr_ap, round(best_threshold, 6) AS best_threshold,
       round(best_f1, 6) AS best_f1, n_pos, n_neg FROM summary_t"""))
def q_curve_summary(spark, sf):
    c = evaluate.score_curve(_valid_scores(spark, sf), by=_BY)
    return _r6_all(evaluate.curve_summary(c, _BY))


@register("metrics_at_best", S.chain(S.CURVE, body=f"""
SELECT model_name, tp, fp, tn, fn, n, {S.RATIOS}, round(roc_auc, 6) AS roc_auc, round(pr_ap, 6) AS pr_ap,
       round(best_threshold, 6) AS best_threshold, round(best_f1, 6) AS best_f1, n_pos, n_neg
FROM (SELECT s.model_name, {S.metrics_cols("CAST(round(s.proba, 9) >= m.best_threshold AS INTEGER)", "s.churn")}
      FROM scored_t s JOIN summary_t m USING (model_name) WHERE s.split = 'valid' GROUP BY s.model_name)
JOIN summary_t USING (model_name)"""))
def q_metrics_at_best(spark, sf):
    return _r6_all(evaluate.metrics_at_best(_valid_scores(spark, sf), by=_BY))


def _grid_values_sql() -> str:
    vals = ", ".join(f"({i}, CAST('{g!r}' AS DOUBLE))" for i, g in enumerate(evaluate.threshold_grid()))
    return f"grid_t(i, g) AS (VALUES {vals})"


SWEEP_SQL = S.CURVE + ",\n" + _grid_values_sql() + """,
sweep_t AS (
  SELECT s.model_name, CAST(grid_t.i AS INTEGER) AS i, grid_t.g AS threshold,
         CAST(count(*) FILTER (WHERE s.churn = 1 AND round(s.proba, 9) >= grid_t.g) AS BIGINT) AS tp,
         CAST(count(*) FILTER (WHERE s.churn <> 1 AND round(s.proba, 9) >= grid_t.g) AS BIGINT) AS fp,
         CAST(count(*) FILTER (WHERE s.churn = 1) AS BIGINT) AS n_pos
  FROM scored_t s, grid_t WHERE s.split = 'valid' GROUP BY s.model_name, grid_t.i, grid_t.g),
sweep_m AS (
  SELECT model_name, i, threshold, tp, fp,
         CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
         CASE WHEN n_pos = 0 THEN 0.0 ELSE tp / n_pos END AS recall,
         CASE WHEN 2 * tp + fp + (n_pos - tp) = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + (n_pos - tp)) END AS f1
  FROM sweep_t)"""


@register("threshold_sweep", S.chain(SWEEP_SQL, body="""
SELECT model_name, i, round(threshold, 6) AS threshold, tp, fp, round(precision, 6) AS precision,
       round(recall, 6) AS recall, round(f1, 6) AS f1 FROM sweep_m"""))
def q_sweep(spark, sf):
    return _r6_all(evaluate.threshold_sweep(_valid_scores(spark, sf), by=_BY))


@register("grid_best_threshold", S.chain(SWEEP_SQL, body="""
SELECT model_name, round(arg_min(threshold, (-f1, threshold)), 6) AS threshold, round(max(f1), 6) AS f1
FROM sweep_m GROUP BY model_name"""))
def q_grid_best(spark, sf):
    return _r6_all(evaluate.best_on_grid(evaluate.threshold_sweep(_valid_scores(spark, sf), by=_BY), _BY))


@register("curve_points", S.chain(S.CURVE, body="""
SELECT model_name, round(threshold, 6) AS threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr,
       round(precision, 6) AS precision, round(recall, 6) AS recall
FROM (SELECT *, row_number() OVER (PARTITION BY model_name, floor((tp + fp - 1) * 20 / (n_pos + n_neg))
                                   ORDER BY threshold) AS rn FROM curve_t) WHERE rn = 1"""))
def q_curve_points(spark, sf):
    c = evaluate.score_curve(_valid_scores(spark, sf), by=_BY)
    return _r6_all(evaluate.curve_points(c, _BY, max_points=20))


# ------------------------------------------------------------------ thresholds and shapes
# Which key each model's threshold document uses (all four lookup keys occur).
DOC_KEYS = {"logreg": "best_threshold", "xgb": "threshold", "rf": "best", "logreg_fe": "value"}

_DOCS_SQL = S.CURVE + """,
docs_t AS (
  SELECT model_name, 'full' AS doc_kind,
         printf('{"%s": %s}', CASE model_name WHEN 'logreg' THEN 'best_threshold' WHEN 'xgb' THEN 'threshold'
                               WHEN 'rf' THEN 'best' ELSE 'value' END, CAST(best_threshold AS VARCHAR)) AS doc
  FROM summary_t),
all_docs AS (SELECT * FROM docs_t UNION ALL SELECT model_name, 'truncated', substr(doc, 1, length(doc) - 1) FROM docs_t)"""


def _threshold_docs(spark, sf):
    summ = evaluate.curve_summary(evaluate.score_curve(_valid_scores(spark, sf), by=_BY), _BY)
    key = F.create_map(*[x for k, v in DOC_KEYS.items() for x in (F.lit(k), F.lit(v))])
    docs = summ.select("model_name", F.lit("full").alias("doc_kind"),
                       F.format_string('{"%s": %s}', F.element_at(key, F.col("model_name")), F.col("best_threshold").cast("string")).alias("doc"))
    trunc = docs.select("model_name", F.lit("truncated").alias("doc_kind"),
                        F.expr("substring(doc, 1, length(doc) - 1)").alias("doc"))
    return docs.unionByName(trunc)


@register("resolve_threshold", S.chain(_DOCS_SQL, body="""
SELECT model_name, doc_kind, round(coalesce(
  CASE WHEN json_valid(doc) THEN TRY_CAST(json_extract_string(doc, '$.best_threshold') AS DOUBLE) END,
  CASE WHEN json_valid(doc) THEN TRY_CAST(json_extract_string(doc, '$.threshold') AS DOUBLE) END,
  CASE WHEN json_valid(doc) THEN TRY_CAST(json_extract_string(doc, '$.best') AS DOUBLE) END,
  CASE WHEN json_valid(doc) THEN TRY_CAST(json_extract_string(doc, '$.value') AS DOUBLE) END, 0.5), 6) AS threshold
FROM all_docs"""))
def q_resolve_threshold(spark, sf):
    return _r6_all(score.resolve_threshold(_threshold_docs(spark, sf)).select("model_name", "doc_kind", "threshold"))


@register("threshold_by_family", S.chain(S.CURVE, body="""
SELECT m.model_name, round(coalesce(
   CASE WHEN lower(m.model_name) LIKE '%xgb%' THEN (SELECT best_threshold FROM summary_t WHERE model_name = 'xgb')
        WHEN lower(m.model_name) LIKE '%rf%' THEN (SELECT best_threshold FROM summary_t WHERE model_name = 'rf') END,
   (SELECT best_threshold FROM summary_t WHERE model_name = 'logreg'), 0.5), 6) AS threshold
FROM (SELECT DISTINCT model_name FROM scored_t) m"""))
def q_threshold_by_family(spark, sf):
    summ = evaluate.curve_summary(evaluate.score_curve(_valid_scores(spark, sf), by=_BY), _BY)
    th = (summ.where(F.col("model_name").isin("xgb", "rf", "logreg"))
          .select(F.when(F.col("model_name") == "logreg", "general").otherwise(F.col("model_name")).alias("family"),
                  F.col("best_threshold").alias("threshold")))
    models = flows.scored_table(spark, sf).select("model_name").distinct()
    return _r6_all(score.threshold_for_model(models, th))


@register("array_predictions", """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS pred_class,
       round(CAST(embedding[2] AS DOUBLE), 6) AS proba
FROM embeddings""")
def q_array_predictions(spark, sf):
    e = tables.load(spark, sf, "embeddings")
    wide = score.normalize_array_predictions(e, "embedding", out_proba="_p64", out_class="pred_class")
    two = score.normalize_array_predictions(wide.withColumn("_two", F.slice("embedding", 1, 2)), "_two",
                                            out_proba="proba", out_class="_c2")
    return _r6_all(two.select("vec_id", "pred_class", "proba"))


@register("scalar_predictions", S.chain("""
mixed_t AS (SELECT model_name, CASE WHEN model_name IN ('rf', 'logreg_fe') THEN CAST(proba >= 0.5 AS INTEGER) ELSE proba END AS v
            FROM scored_t),
kind_t AS (SELECT model_name, CASE WHEN min(v) >= 0 AND max(v) <= 1
                                   AND NOT (max(CASE WHEN v <> 0 AND v <> 1 THEN 1 ELSE 0 END) = 0
                                            AND count(DISTINCT CASE WHEN v = 0 OR v = 1 THEN v END) = 2)
                                   THEN 'proba' ELSE 'class' END AS kind, CAST(count(*) AS BIGINT) AS n
           FROM mixed_t GROUP BY model_name)""", body="SELECT * FROM kind_t"))
def q_scalar_predictions(spark, sf):
    sc = flows.scored_table(spark, sf)
    mixed = sc.select("model_name", F.when(F.col("model_name").isin("rf", "logreg_fe"),
                                           (F.col("proba") >= 0.5).cast("int").cast("double")).otherwise(F.col("proba")).alias("v"))
    k = score.normalize_scalar_predictions(mixed, "v", by=["model_name"])
    return k.groupBy("model_name", "kind").agg(F.count(F.lit(1)).alias("n"))


@register("prediction_responses", S.chain(body="""
SELECT model_name, row_key // 100 AS batch,
       CAST(row_number() OVER (PARTITION BY model_name, row_key // 100 ORDER BY row_key) - 1 AS INTEGER) AS pos,
       CAST(CAST(proba >= 0.5 AS INTEGER) AS DOUBLE) AS prediction
FROM scored_t WHERE split = 'valid'"""))
def q_prediction_responses(spark, sf):
    d = score.apply_threshold(_valid_scores(spark, sf), 0.5).withColumn("batch", F.floor(F.col("row_key") / 100))
    # API-style responses: one JSON document per batch of at most 100 keys
    docs = (d.groupBy("model_name", "batch")
            .agg(F.array_sort(F.collect_list(F.struct("row_key", "pred"))).alias("rows"))
            .select("model_name", "batch",
                    F.to_json(F.struct(F.transform("rows", lambda r: r["pred"]).alias("predictions"))).alias("doc")))
    return score.explode_predictions(docs, "doc")


@register("score_table", S.chain(body="""
SELECT row_key AS customer_id, round(proba, 6) AS score_churn, CAST(proba >= 0.5 AS INTEGER) AS flag_alto_riesgo,
       DATE '2024-01-31' AS fecha_scoring FROM scored_t WHERE model_name = 'logreg'"""))
def q_score_table(spark, sf):
    sc = flows.scored_table(spark, sf).where(F.col("model_name") == "logreg")
    return _r6_all(score.score_table(sc, "row_key", 0.5, "2024-01-31"))


_AUDIT_INPUTS = list(flows.SCORERS["logreg"][1])


@register("audit_log", S.chain("""
ls_t AS (SELECT s.row_key, s.proba, """ + ", ".join(f"t.{c}" for c in _AUDIT_INPUTS) + """
         FROM scored_t s JOIN std_t t USING (row_key) WHERE s.model_name = 'logreg')""", body="""
SELECT 'batch-scorer' AS requested_by, row_key, """ + " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in _AUDIT_INPUTS) + """ AS n_inputs,
       round(""" + " + ".join(f"coalesce({c}, 0.0)" for c in _AUDIT_INPUTS) + """, 6) AS input_sum,
       round(proba, 6) AS score, TIMESTAMP '2024-01-31 06:00:00' AS scored_at FROM ls_t"""))
def q_audit_log(spark, sf):
    st = flows.standardized_split(spark, sf)
    b, coef = flows.SCORERS["logreg"]
    sc = score.linear_score(st, coef, b)
    log = score.audit_log(sc, "row_key", _AUDIT_INPUTS, "batch-scorer", "2024-01-31 06:00:00")
    return _r6_all(log.withColumn("scored_at", F.col("scored_at").cast("timestamp_ntz")))


# ------------------------------------------------------------------ run log, leaderboard, champion
from tidemark.operators import runs as R  # noqa: E402

_METRICS6 = flows.METRIC_NAMES


def _runs_sql(*extra, body):
    return S.chain(S.RUNS, *extra, body=body)


_RUN_COLS = "run_id, run_name, experiment_name, model_key, registered_model, split, position, start_time, " + \
            ", ".join(f"round({m}, 6) AS {m}" for m in _METRICS6)


@register("run_log", _runs_sql(body=f"SELECT {_RUN_COLS} FROM runs_t"))
def q_run_log(spark, sf):
    path = shared_path(spark, "run_log", uuid.uuid4().hex)
    rt = flows.run_table(spark, sf)
    return _r6_all(R.log_runs(rt, path).select(*rt.columns))


def _flat_expected_sql(name_expr: str) -> str:
    parts = [f"SELECT {name_expr}, split || '_{m}' AS key, round({m}, 6) AS value FROM runs_t" for m in _METRICS6]
    parts.append(f"SELECT DISTINCT {name_expr}, 'params_threshold' AS key, 0.5 AS value FROM runs_t")
    parts.append(f"SELECT DISTINCT {name_expr}, 'calibrated' AS key, 1.0 AS value FROM runs_t")
    return "\nUNION ALL ".join(parts)


@register("flatten_metrics", _runs_sql(body=_flat_expected_sql("model_key")))
def q_flatten(spark, sf):
    docs = flows.metric_documents(flows.run_table(spark, sf))
    return _r6_all(R.flatten_metrics(docs, "doc", keep=["model_key"]))


@register("import_metric_files", _runs_sql(body=_flat_expected_sql(
    "'metrics_test' || CASE model_key WHEN 'LogReg' THEN '' WHEN 'RF' THEN '_rf' WHEN 'XGB' THEN '_xgb' ELSE '_fe' END AS run_name")))
def q_import_files(spark, sf):
    docs = flows.metric_documents(flows.run_table(spark, sf))
    files_df = docs.select(R.lookup(R.METRIC_FILES, F.col("model_key")).alias("file"), "doc")
    broken = docs.where(F.col("model_key") == "LogReg").select(
        F.lit("metrics_broken.json").alias("file"), F.expr("substring(doc, 1, length(doc) - 2)").alias("doc"))
    empty = docs.where(F.col("model_key") == "LogReg").select(F.lit("metrics_empty.json").alias("file"), F.lit("").alias("doc"))
    path = shared_path(spark, "metric_files", uuid.uuid4().hex)
    files.write_json_documents(files_df.unionByName(broken).unionByName(empty), path)
    read = files.read_json_documents(spark, path, "metrics_*.json")
    return _r6_all(R.import_metric_documents(read, "file_name"))


def _doc_variants(spark, sf):
    """Per model key, the test metrics as documents in several layouts."""
    rt = flows.run_table(spark, sf)
    docs = flows.metric_documents(rt)
    test = rt.where(F.col("split") == "test")
    flat = F.to_json(F.struct(*[F.col(m) for m in ("accuracy", "precision", "recall")],
                              F.when(F.col("model_key") != "FE", F.col("f1")).alias("f1")))
    nested = F.to_json(F.struct(F.struct(*[F.col(m) for m in ("accuracy", "precision", "recall", "f1")]).alias("test")))
    aliased = F.to_json(F.struct(F.col("accuracy").alias("acc"), F.col("precision").alias("prec"),
                                 F.col("recall").alias("rec"), F.col("f1").alias("f1_score")))
    plain = F.to_json(F.struct(*[F.col(m) for m in ("accuracy", "precision", "recall", "f1")]))
    t = test.select("model_key", "position",
                    F.when(F.col("model_key").isin("LogReg", "XGB"), nested).otherwise(flat).alias("doc_mixed"),
                    F.when(F.col("model_key") == "RF", aliased).otherwise(plain).alias("doc_alias"))
    no_test = docs.select("model_key", F.when(F.col("model_key") == "RF",
                                              F.to_json(F.struct(F.expr("from_json(doc, 'valid struct<f1:double>').valid").alias("valid"))))
                          .otherwise(F.col("doc")).alias("doc_primary"))
    return t.join(no_test, "model_key")


@register("primary_f1", _runs_sql(body="""
SELECT model_key, round(f1, 6) AS f1 FROM runs_t WHERE (model_key = 'RF' AND split = 'valid') OR (model_key <> 'RF' AND split = 'test')"""))
def q_primary_f1(spark, sf):
    return _r6_all(R.primary_f1(_doc_variants(spark, sf), "doc_primary").select("model_key", "f1"))


@register("metrics_or_flat", _runs_sql(body="""
SELECT model_key, round(CASE WHEN model_key = 'FE' THEN 0.0 ELSE f1 END, 6) AS f1, round(accuracy, 6) AS accuracy,
       round(precision, 6) AS precision, round(recall, 6) AS recall FROM runs_t WHERE split = 'test'"""))
def q_metrics_or_flat(spark, sf):
    return _r6_all(R.metrics_or_flat(_doc_variants(spark, sf), "doc_mixed").select("model_key", "f1", "accuracy", "precision", "recall"))


@register("metric_alias", _runs_sql(body="""
SELECT model_key, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1 FROM runs_t WHERE split = 'test'"""))
def q_metric_alias(spark, sf):
    return _r6_all(R.metric_alias(_doc_variants(spark, sf), "doc_alias").select("model_key", "accuracy", "precision", "recall", "f1"))


_FILE_SQL = "CASE model_key WHEN 'LogReg' THEN 'metrics_test.json' WHEN 'RF' THEN 'metrics_test_rf.json' WHEN 'XGB' THEN 'metrics_test_xgb.json' ELSE 'metrics_test_fe.json' END"
_LABEL_SQL = "CASE model_key WHEN 'LogReg' THEN 'LogReg baseline' WHEN 'RF' THEN 'RandomForest' WHEN 'XGB' THEN 'XGBoost' ELSE 'LogReg FE' END"


@register("benchmark_leaderboard", _runs_sql(body=f"""
SELECT {_FILE_SQL} AS file, {_LABEL_SQL} AS label, round(f1, 6) AS f1,
       CAST(row_number() OVER (ORDER BY f1 DESC, position) AS INTEGER) AS rank,
       row_number() OVER (ORDER BY f1 DESC, position) = 1 AS is_winner
FROM runs_t WHERE split = 'test'"""))
def q_leaderboard(spark, sf):
    t = flows.run_table(spark, sf).where(F.col("split") == "test")
    t = R.label_for(t.withColumn("file", R.lookup(R.METRIC_FILES, F.col("model_key"))))
    return _r6_all(R.leaderboard(t, "f1", "position").select("file", "label", "f1", "rank", "is_winner"))


@register("metric_table", S.chain(S.RUNS, S.CURVE, body="""
SELECT r.model_key, r.split, CASE r.split WHEN 'test' THEN 0 WHEN 'valid' THEN 1 ELSE 2 END AS split_order,
       printf('%.4f', r.accuracy) AS accuracy, printf('%.4f', r.precision) AS precision,
       printf('%.4f', r.recall) AS recall, printf('%.4f', r.f1) AS f1,
       coalesce(printf('%.4f', s.best_threshold), '-') AS threshold,
       CAST(row_number() OVER (ORDER BY CASE r.split WHEN 'test' THEN 0 WHEN 'valid' THEN 1 ELSE 2 END, r.model_key) AS INTEGER) AS "row"
FROM runs_t r LEFT JOIN summary_t s ON s.model_name = CASE r.model_key WHEN 'LogReg' THEN 'logreg' WHEN 'RF' THEN 'rf'
                                                     WHEN 'XGB' THEN 'xgb' ELSE 'logreg_fe' END
WHERE r.split IN ('test', 'valid')"""))
def q_metric_table(spark, sf):
    rt = flows.run_table(spark, sf).where(F.col("split").isin("test", "valid"))
    summ = evaluate.curve_summary(evaluate.score_curve(_valid_scores(spark, sf), by=_BY), _BY)
    # the threshold found on the valid rows stands beside both splits of its model
    th = summ.select(R.lookup(flows.MODEL_KEYS, F.col("model_name")).alias("model_key"),
                     F.col("best_threshold").alias("thr"))
    j = rt.join(th, "model_key", "left")   # a handful of rows per side
    t = R.metric_table(j)
    return t.join(j.select("model_key", "split", R.fmt4(F.col("thr")).alias("threshold")),
                  ["model_key", "split"])


@register("champion_challenger", _runs_sql(body="""
SELECT model_key, registered_model, round(f1, 6) AS f1,
       CASE WHEN rn = 1 THEN 'champion' ELSE 'challenger' END AS role,
       (SELECT string_agg(model_key, ',' ORDER BY position) FROM runs_t WHERE split = 'test') AS considered
FROM (SELECT *, row_number() OVER (ORDER BY f1 DESC, position) AS rn FROM runs_t WHERE split = 'test') WHERE rn <= 2"""))
def q_champion_challenger(spark, sf):
    t = flows.run_table(spark, sf).where(F.col("split") == "test")
    return _r6_all(R.top_two(t).select("model_key", "registered_model", "f1", "role", "considered"))


SELECTED_AT = 1_706_745_600      # epoch seconds


@register("selection_record", _runs_sql("""
ver_t AS (SELECT registered_model, count(*) AS latest FROM runs_t GROUP BY registered_model),
sel_t AS (SELECT r.*, row_number() OVER (ORDER BY f1 DESC, position) AS rn FROM runs_t r WHERE split = 'test')""", body=f"""
SELECT CAST({SELECTED_AT} AS BIGINT) AS ts, CASE WHEN rn = 1 THEN 'champion' ELSE 'challenger' END AS role, model_key AS key,
       registered_model AS model_name, CAST(latest AS INTEGER) AS version, round(f1, 6) AS f1, unnest(['accuracy', 'precision', 'recall', 'f1', 'roc_auc', 'pr_ap']) AS metric,
       unnest([round(accuracy, 6), round(precision, 6), round(recall, 6), round(f1, 6), round(roc_auc, 6), round(pr_ap, 6)]) AS value
FROM sel_t JOIN ver_t USING (registered_model) WHERE rn <= 2"""))
def q_selection_record(spark, sf):
    """R10 + C14: the selection record written as a JSON document and read back."""
    rt = flows.run_table(spark, sf)
    roles = R.selection_roles(R.candidates(rt.where(F.col("split") == "test"), _METRICS6), _versions(rt))
    path = shared_path(spark, "selection", uuid.uuid4().hex)
    files.write_json_documents(R.selection_document(roles, SELECTED_AT, "registry").withColumn("file", F.lit("selection.json")), path)
    rows = R.read_selection(files.read_json_documents(spark, path, "selection.json"))
    return _r6_all(rows.select("ts", "role", "key", "model_name", "version", "f1", F.explode("metrics").alias("metric", "value")))


@register("registered_names", _runs_sql(body="SELECT run_id, model_key, registered_model FROM runs_t"))
def q_registered_names(spark, sf):
    rt = flows.run_table(spark, sf)
    return rt.select("run_id", "model_key", R.registered_name(F.col("model_key")).alias("registered_model"))


_BEST_SQL = """
best_t AS (SELECT experiment_name, arg_min(run_id, (-f1, run_id)) AS run_id, max(f1) AS f1
           FROM runs_t WHERE f1 > 0 GROUP BY experiment_name)"""


@register("best_run", _runs_sql(_BEST_SQL, body="SELECT experiment_name, run_id, round(f1, 6) AS f1 FROM best_t"))
def q_best_run(spark, sf):
    return _r6_all(R.best_run(flows.run_table(spark, sf), "f1"))


@register("best_test_run", _runs_sql(body="""
SELECT arg_min(run_id, (f1 IS NULL, -f1, run_id)) AS run_id, round(max(f1), 6) AS f1 FROM runs_t WHERE run_name LIKE 'metrics_test%'"""))
def q_best_test_run(spark, sf):
    return _r6_all(R.best_named_run(flows.run_table(spark, sf), "metrics_test", "f1"))


_PREV_SQL = """
prev_t AS (SELECT experiment_name, arg_min(run_id, (-accuracy, run_id)) AS run_id, arg_min(f1, (-accuracy, run_id)) AS f1
           FROM runs_t WHERE split = 'valid' GROUP BY experiment_name)"""


def _prev_champion(rt):
    """The stored champion: the best validation run by accuracy (derived from the log)."""
    return R.best_run(rt.where(F.col("split") == "valid"), "accuracy").join(rt.select("run_id", "f1"), "run_id")


@register("retag_champion", _runs_sql(_BEST_SQL, _PREV_SQL, body="""
SELECT r.run_id, r.run_id = b.run_id AS is_champion
FROM runs_t r, best_t b WHERE r.run_id = b.run_id OR r.run_id = (SELECT run_id FROM prev_t)"""))
def q_retag(spark, sf):
    rt = flows.run_table(spark, sf)
    prev = _prev_champion(rt).select("run_id", F.lit(True).alias("is_champion"))
    # the new champion of each experiment, joined on the experiment (one row per experiment)
    best = R.best_run(rt, "f1").select("experiment_name", F.col("run_id").alias("best_run_id"))
    tagged = rt.join(prev, "run_id", "left").join(best, "experiment_name", "left")
    return R.retag(tagged, "best_run_id")


_VERSIONS_SQL = """
ver_t AS (SELECT registered_model, run_id, start_time,
                 CAST(row_number() OVER (PARTITION BY registered_model ORDER BY start_time, run_id) AS VARCHAR) AS version
          FROM runs_t)"""


def _versions(rt):
    """Model versions: every run registers the next version of its registered model,
    numbered by the distributed rank in (start time, run id) order per model."""
    from tidemark.operators.ranking import stratified_rank
    r = stratified_rank(rt.select("registered_model", "run_id", "start_time"), ["registered_model"],
                        ["start_time", "run_id"], order="key", stored=True)
    return r.select("registered_model", "run_id", "start_time", (F.col("_rank") + 1).cast("string").alias("version"))


@register("latest_versions", _runs_sql(_VERSIONS_SQL, body="""
SELECT registered_model, max(CAST(version AS INTEGER)) AS latest_version FROM ver_t GROUP BY registered_model"""))
def q_latest_versions(spark, sf):
    return R.latest_version(_versions(flows.run_table(spark, sf)))


@register("assign_alias", _runs_sql(_VERSIONS_SQL, """
lat_t AS (SELECT registered_model, max(CAST(version AS INTEGER)) AS v FROM ver_t GROUP BY registered_model),
champ_t AS (SELECT registered_model FROM (SELECT *, row_number() OVER (ORDER BY f1 DESC, position) AS rn
            FROM runs_t WHERE split = 'test') WHERE rn = 1)""", body="""
SELECT 'challenger' AS alias, 'TelcoChurn_XGB' AS registered_model, CAST((SELECT v FROM lat_t WHERE registered_model = 'TelcoChurn_XGB') AS VARCHAR) AS version
UNION ALL
SELECT 'champion', c.registered_model, CAST(l.v AS VARCHAR) FROM champ_t c JOIN lat_t l USING (registered_model)"""))
def q_assign_alias(spark, sf):
    rt = flows.run_table(spark, sf)
    lat = R.latest_version(_versions(rt))
    old = lat.where(F.col("registered_model").isin("TelcoChurn_RF", "TelcoChurn_XGB")).select(
        F.when(F.col("registered_model") == "TelcoChurn_RF", "champion").otherwise("challenger").alias("alias"),
        "registered_model", F.col("latest_version").cast("string").alias("version"))
    champ = R.top_two(rt.where(F.col("split") == "test")).where(F.col("role") == "champion").select("registered_model")
    return R.assign_alias(old, "champion", F.col("registered_model"), F.col("latest_version"),
                          holder=champ.join(lat, "registered_model"))


@register("champion_version", _runs_sql(_BEST_SQL, _VERSIONS_SQL, body="""
SELECT b.run_id, r.registered_model, CAST(v.version AS INTEGER) AS version
FROM best_t b JOIN runs_t r USING (run_id) LEFT JOIN ver_t v ON v.registered_model = r.registered_model AND v.run_id = b.run_id"""))
def q_champion_version(spark, sf):
    rt = flows.run_table(spark, sf)
    best = R.best_run(rt, "f1").join(rt.select("run_id", "registered_model"), "run_id")
    return R.version_of_run(best, _versions(rt)).select("run_id", "registered_model", "version")


@register("champion_changed", _runs_sql(_BEST_SQL, _PREV_SQL, body="""
SELECT b.experiment_name, b.run_id, round(b.f1, 6) AS f1, p.run_id AS prev_run_id, round(p.f1, 6) AS prev_f1,
       p.run_id IS NULL OR b.run_id IS DISTINCT FROM p.run_id AS changed,
       p.run_id IS NULL OR (b.run_id IS DISTINCT FROM p.run_id AND b.f1 > p.f1) AS improved,
       CASE WHEN p.run_id IS NULL THEN 'no previous champion' WHEN b.run_id = p.run_id THEN 'same run'
            WHEN b.f1 > p.f1 THEN 'better metric' ELSE 'different run, metric not better' END AS reason
FROM best_t b LEFT JOIN prev_t p USING (experiment_name)"""))
def q_champion_changed(spark, sf):
    rt = flows.run_table(spark, sf)
    return _r6_all(R.champion_changed(R.best_run(rt, "f1"), _prev_champion(rt)))


# references, selections and free text derived from the version table
_REFS_SQL = """
refs_t AS (
  SELECT registered_model AS n, version AS v, 1 AS form, 'models:/' || registered_model || '@champion' AS ref FROM ver_t
  UNION ALL SELECT registered_model, version, 2, 'models:/' || registered_model || '/' || version FROM ver_t
  UNION ALL SELECT registered_model, version, 3, registered_model || '@challenger' FROM ver_t
  UNION ALL SELECT registered_model, version, 4, registered_model || ' v' || version FROM ver_t
  UNION ALL SELECT registered_model, version, 5, ' ' || registered_model || ' ' FROM ver_t)"""


def _refs(rt):
    v = _versions(rt)
    n, ver = F.col("registered_model"), F.col("version")
    forms = [F.concat(F.lit("models:/"), n, F.lit("@champion")), F.concat(F.lit("models:/"), n, F.lit("/"), ver),
             F.concat(n, F.lit("@challenger")), F.concat(n, F.lit(" v"), ver), F.concat(F.lit(" "), n, F.lit(" "))]
    arr = F.array(*[F.struct(F.lit(i + 1).alias("form"), f.alias("ref")) for i, f in enumerate(forms)])
    return v.select(n.alias("n"), ver.alias("v"), F.explode(arr).alias("x")).select("n", "v", "x.form", "x.ref")


@register("parse_model_refs", _runs_sql(_VERSIONS_SQL, _REFS_SQL, body="""
SELECT ref, CAST(form AS INTEGER) AS form, n AS name,
       CASE WHEN form IN (2, 4) THEN CAST(v AS INTEGER) END AS version,
       CASE form WHEN 1 THEN 'champion' WHEN 3 THEN 'challenger' END AS alias
FROM refs_t"""))
def q_parse_refs(spark, sf):
    r = _refs(flows.run_table(spark, sf)).withColumn("p", R.parse_model_ref(F.col("ref")))
    return r.select("ref", F.col("form").cast("int").alias("form"), "p.name", "p.version", "p.alias")


_SEL_SQL = """
sel_t AS (
  SELECT registered_model AS n, CAST(version AS INTEGER) AS v, run_id,
         CAST(version AS INTEGER) % 4 AS form,
         CASE CAST(version AS INTEGER) % 4
           WHEN 0 THEN '{"name":"' || registered_model || '","version":"' || version || '"}'
           WHEN 1 THEN '{"Model":"' || registered_model || '","model_version":' || version || '}'
           WHEN 2 THEN '{"registered_model":"' || registered_model || '","alias":"champion"}'
           ELSE '{"uri":"models:/' || registered_model || '/' || version || '"}' END AS doc
  FROM ver_t)"""


def _selections(rt):
    v = _versions(rt)
    n, ver = F.col("registered_model"), F.col("version")
    form = ver.cast("int") % 4
    doc = (F.when(form == 0, F.concat(F.lit('{"name":"'), n, F.lit('","version":"'), ver, F.lit('"}')))
           .when(form == 1, F.concat(F.lit('{"Model":"'), n, F.lit('","model_version":'), ver, F.lit('}')))
           .when(form == 2, F.concat(F.lit('{"registered_model":"'), n, F.lit('","alias":"champion"}')))
           .otherwise(F.concat(F.lit('{"uri":"models:/'), n, F.lit('/'), ver, F.lit('"}'))))
    return v.select(n.alias("n"), ver.cast("int").alias("v"), "run_id", form.alias("form"), doc.alias("doc"))


@register("parse_selection", _runs_sql(_VERSIONS_SQL, _SEL_SQL, body="""
SELECT run_id, doc, n AS name, CASE WHEN form = 2 THEN NULL ELSE v END AS version,
       CASE WHEN form = 2 THEN 'champion' END AS alias,
       CASE WHEN form = 2 THEN 'models:/' || n || '@champion' ELSE 'models:/' || n || '/' || CAST(v AS VARCHAR) END AS model_uri
FROM sel_t"""))
def q_parse_selection(spark, sf):
    s = _selections(flows.run_table(spark, sf)).withColumn("p", R.parse_selection(F.col("doc")))
    return s.select("run_id", "doc", "p.name", "p.version", "p.alias",
                    R.resolve_model_uri(F.col("p.name"), F.col("p.version"), F.col("p.alias")).alias("model_uri"))


_TEXT_SQL = """
text_t AS (
  SELECT run_id || '-a' AS text_id, 'promoted ' || registered_model || ' as version ' || version || ' today' AS text,
         registered_model AS n, CAST(version AS INTEGER) AS v FROM ver_t
  UNION ALL
  SELECT run_id || '-b', 'compare TelcoChurn_RF and ' || registered_model || ' build 20240201 step ' || version,
         CASE WHEN registered_model = 'TelcoChurn_RF' THEN 'TelcoChurn_RF' ELSE registered_model END,
         CAST(version AS INTEGER) FROM ver_t
  UNION ALL
  SELECT run_id || '-c', 'no model named here ' || version, NULL, NULL FROM ver_t)"""


def _texts(rt):
    v = _versions(rt)
    n, ver = F.col("registered_model"), F.col("version")
    a = v.select(F.concat("run_id", F.lit("-a")).alias("text_id"),
                 F.concat(F.lit("promoted "), n, F.lit(" as version "), ver, F.lit(" today")).alias("text"))
    b = v.select(F.concat("run_id", F.lit("-b")).alias("text_id"),
                 F.concat(F.lit("compare TelcoChurn_RF and "), n, F.lit(" build 20240201 step "), ver).alias("text"))
    c = v.select(F.concat("run_id", F.lit("-c")).alias("text_id"), F.concat(F.lit("no model named here "), ver).alias("text"))
    return a.unionByName(b).unionByName(c), v.select("registered_model").distinct()


@register("extract_model_ref", _runs_sql(_VERSIONS_SQL, _TEXT_SQL, body="""
SELECT text_id, text, n AS name, CASE WHEN n IS NULL THEN NULL ELSE v END AS version FROM text_t"""))
def q_extract_ref(spark, sf):
    texts, known = _texts(flows.run_table(spark, sf))
    return R.extract_model_ref(texts, "text", "text_id", known)


_MENTION_SQL = r"""
name_t AS (SELECT registered_model AS n, row_number() OVER (ORDER BY registered_model) - 1 AS i, count(*) OVER () AS k,
                  (SELECT max(CAST(version AS INTEGER)) FROM ver_t v WHERE v.registered_model = m.registered_model) AS latest
           FROM (SELECT DISTINCT registered_model FROM ver_t) m),
say_t AS (SELECT conv_id, turn, role, CASE conv_id % 4
            WHEN 0 THEN coalesce(text, '') || ' please promote ' || n || ' as version ' || CAST(turn + 1 AS VARCHAR)
            WHEN 1 THEN n || ' and TelcoChurn_RF differ: ' || coalesce(text, '')
            ELSE text END AS text
          FROM conversations JOIN name_t ON conv_id % k = i),
hit_t AS (SELECT *, list_filter(['TelcoChurn_LogReg', 'TelcoChurn_XGB', 'TelcoChurn_RF'], lambda x: contains(coalesce(text, ''), x)) AS hits,
                 regexp_extract(coalesce(text, ''), '(?i)(?:\bv|@|version[^0-9]{0,10})(\d{1,5})', 1) AS said,
                 list_filter(list_transform(regexp_extract_all(coalesce(text, ''), '(\d{1,5})', 1), lambda x: CAST(x AS INTEGER)),
                             lambda x: x > 0 AND x <= 10000) AS nums FROM say_t),
ref_t AS (SELECT *, hits[1] AS nm, CASE WHEN said <> '' THEN CAST(said AS INTEGER) ELSE nums[len(nums)] END AS ver FROM hit_t)"""


@register("mentioned_models", _runs_sql(_VERSIONS_SQL, _MENTION_SQL, body="""
SELECT conv_id, turn, role, CASE WHEN nm IS NOT NULL AND ver > 0 THEN nm ELSE 'TelcoChurn_LogReg' END AS name,
       CAST(CASE WHEN nm IS NOT NULL AND ver > 0 THEN ver ELSE (SELECT latest FROM name_t WHERE n = 'TelcoChurn_LogReg') END AS INTEGER) AS version
FROM ref_t"""))
def q_mentioned_models(spark, sf):
    """R22 over all conversations, a quarter naming one model and a quarter two; the rest
    take the fallback."""
    versions = materialize(_versions(flows.run_table(spark, sf)))
    names = sorted(r[0] for r in versions.select("registered_model").distinct().limit(1_000).collect())     # the registry's few names
    n = F.get(F.array(*[F.lit(x) for x in names]), (F.col("conv_id") % len(names)).cast("int"))
    text, form = F.coalesce("text", F.lit("")), F.col("conv_id") % 4
    said = F.when(form == 0, F.concat(text, F.lit(" please promote "), n, F.lit(" as version "), (F.col("turn") + 1).cast("string"))) \
        .when(form == 1, F.concat(n, F.lit(" and TelcoChurn_RF differ: "), text)).otherwise(F.col("text"))
    talk = tables.load(spark, sf, "conversations").select("conv_id", "turn", "role", said.alias("text"))
    return R.extract_model_ref(talk, "text", "conv_id", versions.select("registered_model"), versions=versions).drop("text")


# ------------------------------------------------------------------ streaming and monitoring
from tidemark.streaming import monitor as T  # noqa: E402
from tidemark.streaming import watch as W  # noqa: E402


def _scored_events(spark, sf):
    """Events joined to the logreg scores of their user (user_id = customer key)."""
    sc = score.apply_threshold(flows.scored_table(spark, sf).where(F.col("model_name") == "logreg"), 0.5)
    ev = tables.load(spark, sf, "events").select("event_id", "user_id", "ts")
    j = ev.join(sc.select("row_key", "churn", "proba", "pred"), ev.user_id == sc.row_key)
    return T.event_time(j)


def _ntz(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


@register("windowed_metrics", S.chain(
    S.SCORED_EVENTS, S.WINDOW_COUNTS, S.curve_ctes(["window_start"], "TRUE", "w", "sev_t"), body=f"""
SELECT c.window_start, c.window_end, c.tp, c.fp, c.tn, c.fn, c.n, {S.RATIOS.replace('tp', 'c.tp').replace('fp', 'c.fp').replace('tn', 'c.tn').replace('fn', 'c.fn').replace(' n ', ' c.n ').replace('/ n', '/ c.n')},
       round(s.roc_auc, 6) AS roc_auc, round(s.pr_ap, 6) AS pr_ap
FROM wc_t c LEFT JOIN summaryw_t s USING (window_start)"""))
def q_windowed_metrics(spark, sf):
    return _r6_all(_ntz(T.windowed_metrics(flows.tied(_scored_events(spark, sf))), "window_start", "window_end"))


@register("windowed_counts_stream", S.chain(S.SCORED_EVENTS, S.WINDOW_COUNTS,
                                            body="SELECT window_start, window_end, tp, fp, tn, fn, n FROM wc_t"))
def q_windowed_counts_stream(spark, sf):
    sc = score.apply_threshold(flows.scored_table(spark, sf).where(F.col("model_name") == "logreg"), 0.5) \
        .select("row_key", "churn", "proba", "pred")

    def enrich(stream):   # stream-static join on the customer key
        return stream.join(sc, stream.user_id == sc.row_key)
    out = shared_path(spark, "windowed_counts", uuid.uuid4().hex)
    res = W.windowed_counts_stream(spark, sf, "events.parquet", enrich, out)
    return _ntz(res, "window_start", "window_end")


#: The stream's watermark: windows that end at most this long before the last event stay open.
STREAM_DELAY_DAYS = 1


@register("windowed_metrics_stream", S.chain(
    S.SCORED_EVENTS, S.WINDOW_COUNTS, S.curve_ctes(["window_start"], "TRUE", "w", "sev_t"), body=f"""
SELECT c.window_start, c.window_end, c.tp, c.fp, c.tn, c.fn, c.n, {S.RATIOS.replace('tp', 'c.tp').replace('fp', 'c.fp').replace('tn', 'c.tn').replace('fn', 'c.fn').replace(' n ', ' c.n ').replace('/ n', '/ c.n')},
       round(s.roc_auc, 6) AS roc_auc, round(s.pr_ap, 6) AS pr_ap
FROM wc_t c LEFT JOIN summaryw_t s USING (window_start)
WHERE c.window_end <= (SELECT max(ts) FROM sev_t) - INTERVAL '{STREAM_DELAY_DAYS} days'"""))
def q_windowed_metrics_stream(spark, sf):
    """T4 on a stream: the windows closed by the watermark, AUC and AP included."""
    sc = materialize(flows.tied(score.apply_threshold(flows.scored_table(spark, sf).where(F.col("model_name") == "logreg"), 0.5))
                     .select("row_key", "churn", "proba", "pred"))

    def enrich(stream):   # stream-static join on the customer key
        return stream.join(sc, stream.user_id == sc.row_key)
    out = shared_path(spark, "windowed_metrics", uuid.uuid4().hex)
    res = W.windowed_metrics_stream(spark, sf, "events.parquet", enrich, out, watermark=f"{STREAM_DELAY_DAYS} days")
    return _r6_all(_ntz(res, "window_start", "window_end"))


def _drift_ctes(split_name: str = "split_t") -> str:
    """PSI / CDF-gap CTEs over a split table of the imputed (not encoded) columns."""
    num = S.NUMERIC
    cats = list(S.CATEGORIES)
    rng = "rng_t AS (SELECT " + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in num) + \
          f" FROM {split_name} WHERE split = 'train')"

    def stacked(which):
        parts = []
        for c in num:
            b = (f"lpad(CAST(least(greatest(floor((s.{c} - r.lo_{c}) / CASE WHEN r.hi_{c} > r.lo_{c} "
                 f"THEN r.hi_{c} - r.lo_{c} ELSE 1.0 END * 10), 0), 9) AS BIGINT)::VARCHAR, 6, '0')")
            parts.append(f"SELECT '{c}' AS feature, {b} AS bin FROM {split_name} s, rng_t r "
                         f"WHERE s.split {which} AND s.{c} IS NOT NULL")
        for c in cats:
            parts.append(f"SELECT '{c}' AS feature, coalesce({c}, '<null>') AS bin FROM {split_name} WHERE split {which}")
        return "\n UNION ALL ".join(parts)
    return f"""
{rng},
base_t AS ({stacked("= 'train'")}),
rec_t AS ({stacked("<> 'train'")}),
cnt_t AS (
  SELECT feature, bin, coalesce(b.n, 0) AS n_base, coalesce(r.n, 0) AS n_recent
  FROM (SELECT feature, bin, count(*) AS n FROM base_t GROUP BY ALL) b
  FULL JOIN (SELECT feature, bin, count(*) AS n FROM rec_t GROUP BY ALL) r USING (feature, bin)),
sh_t AS (
  SELECT feature, bin, n_base / sum(n_base) OVER (PARTITION BY feature) AS pb, n_recent / sum(n_recent) OVER (PARTITION BY feature) AS pr
  FROM cnt_t),
cdf_t AS (
  SELECT *, sum(pb) OVER w AS cb, sum(pr) OVER w AS cr FROM sh_t
  WINDOW w AS (PARTITION BY feature ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
drift_t AS (
  SELECT feature, sum((greatest(pr, 1e-6) - greatest(pb, 1e-6)) * ln(greatest(pr, 1e-6) / greatest(pb, 1e-6))) AS psi,
         max(abs(cr - cb)) AS max_cdf_diff
  FROM cdf_t GROUP BY feature)"""


def _drift_sql() -> str:
    split_on_imp = S.SPLIT.replace("FROM prep_t", "FROM imp_t")
    return S.with_(S.CHURN, S.RAW, S.CLEAN, S.IMPUTED, split_on_imp, _drift_ctes(),
                   body="SELECT feature, round(psi, 6) AS psi, round(max_cdf_diff, 6) AS max_cdf_diff FROM drift_t")


def _drift(spark, sf):
    sp, kinds = _drift_sides(spark, sf)
    return T.feature_drift(sp.where(F.col("split") == "train"), sp.where(F.col("split") != "train"),
                           kinds["numeric"], kinds["categorical"])


@register("sketch_drift", "SELECT unnest([" + ", ".join(f"'{c}'" for c in S.NUMERIC) + "]) AS feature, true AS within")
def q_sketch_drift(spark, sf):
    """T5 from stored sketches: per feature, whether the gap read from merged sketches (one
    per label and side, kept as a table) is within the stated bound of the exact one."""
    sp, kinds = _drift_sides(spark, sf)
    sides = {"train": sp.where(F.col("split") == "train"), "rest": sp.where(F.col("split") != "train")}
    kept = {s: materialize(T.feature_sketches(d.where("churn = 0"), kinds["numeric"]).unionByName(
        T.feature_sketches(d.where("churn = 1"), kinds["numeric"]))) for s, d in sides.items()}
    near = T.sketch_drift(T.merge_sketches(kept["train"]), T.merge_sketches(kept["rest"]))
    exact = T.exact_cdf_gap(sides["train"], sides["rest"], kinds["numeric"]).withColumnRenamed("max_cdf_diff", "exact")
    return near.join(exact, "feature").select("feature", (F.abs(F.col("max_cdf_diff") - F.col("exact")) <= T.sketch_bound()).alias("within"))


def _drift_sides(spark, sf):
    """The imputed (not encoded) table: train rows are the baseline, all others recent."""
    d = materialize(flows.clean_table(spark, sf))
    kinds = clean.column_kinds(d, exclude=("churn", "row_key"))
    imp = clean.impute_median(d, kinds["numeric"])
    return materialize(split.stratified_split(imp, "churn", flows.TEST_SIZE, flows.VAL_SIZE, flows.SEED)), kinds


@register("feature_drift", _drift_sql())
def q_feature_drift(spark, sf):
    return _r6_all(_drift(spark, sf))


@register("class_drift", S.chain(S.SCORED_EVENTS, """
base_rate_t AS (SELECT avg(churn) AS r FROM split_t WHERE split = 'train')""", body="""
SELECT window_start, CAST(count(*) AS BIGINT) AS n, round(avg(churn), 6) AS label_rate,
       round(any_value(b.r), 6) AS baseline_rate, round(avg(churn) - any_value(b.r), 6) AS diff
FROM sev_t, base_rate_t b GROUP BY window_start"""))
def q_class_drift(spark, sf):
    rate = flows.split_table(spark, sf).where(F.col("split") == "train").agg(F.avg("churn")).collect()[0][0]
    return _r6_all(_ntz(T.class_drift(_scored_events(spark, sf), rate), "window_start"))


@register("prediction_drift", S.chain(S.SCORED_EVENTS, body="""
SELECT h.window_start, h.bin, h.n, t.n_window, round(t.avg_pred, 6) AS avg_pred, round(t.high_risk_share, 6) AS high_risk_share,
       round(h.n / t.n_window, 6) AS share
FROM (SELECT window_start, CAST(least(floor(proba * 10), 9) AS INTEGER) AS bin, CAST(count(*) AS BIGINT) AS n FROM sev_t GROUP BY ALL) h
JOIN (SELECT window_start, CAST(count(*) AS BIGINT) AS n_window, avg(pred) AS avg_pred, avg(CAST(proba >= 0.5 AS DOUBLE)) AS high_risk_share
      FROM sev_t GROUP BY window_start) t USING (window_start)"""))
def q_prediction_drift(spark, sf):
    return _r6_all(_ntz(T.prediction_drift(_scored_events(spark, sf)), "window_start"))


TRAINED_AT = "2023-10-01"


def _retrain_sql() -> str:
    dsplit = S.SPLIT.replace("FROM prep_t", "FROM imp_t").replace("rank_t", "drank_t").replace("split_t", "dsplit_t")
    wf = """
wf_t AS (
  SELECT window_start, window_end,
         CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1,
         (SELECT max(psi) FROM drift_t) AS max_psi,
         CAST(date_diff('day', DATE '""" + TRAINED_AT + """', CAST(window_end AS DATE)) AS INTEGER) AS days
  FROM wc_t),
rs_t AS (
  SELECT *, list_filter([CASE WHEN f1 < 0.55 THEN 'low_f1' END, CASE WHEN max_psi > 0.2 THEN 'feature_drift' END,
                         CASE WHEN days > 90 THEN 'stale_model' END], lambda x: x IS NOT NULL) AS rs
  FROM wf_t)"""
    return S.chain(S.SCORED_EVENTS, S.WINDOW_COUNTS, dsplit, _drift_ctes("dsplit_t"), wf, body="""
SELECT window_start, round(f1, 6) AS f1, round(max_psi, 6) AS max_psi, days AS days_since_training,
       array_to_string(rs, ',') AS reasons, len(rs) > 0 AS retrain FROM rs_t""")


@register("retrain_reasons", _retrain_sql())
def q_retrain(spark, sf):
    wm = T.windowed_metrics(flows.tied(_scored_events(spark, sf)))
    r = T.retrain_reasons(wm, _drift(spark, sf), TRAINED_AT, max_days=90)
    return _r6_all(_ntz(r.withColumn("reasons", F.array_join("reasons", ",")), "window_start"))


@register("compare_runs", _runs_sql("""
role_t AS (SELECT *, CASE WHEN rn = 1 THEN 'champion' ELSE 'challenger' END AS role
           FROM (SELECT *, row_number() OVER (ORDER BY f1 DESC, position) AS rn FROM runs_t WHERE split = 'test') WHERE rn <= 2),
long_t AS (""" + "\n UNION ALL ".join(f"SELECT role, '{m}' AS metric, {m} AS value FROM role_t" for m in flows.METRIC_NAMES) + ")",
    body="""
SELECT metric, round(max(value) FILTER (WHERE role = 'champion'), 6) AS champion,
       round(max(value) FILTER (WHERE role = 'challenger'), 6) AS challenger,
       round(max(value) FILTER (WHERE role = 'champion') - max(value) FILTER (WHERE role = 'challenger'), 6) AS diff
FROM long_t GROUP BY metric"""))
def q_compare_runs(spark, sf):
    top = R.top_two(flows.run_table(spark, sf).where(F.col("split") == "test"))
    long = top.select("role", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"))
                                                   for m in flows.METRIC_NAMES])).alias("x")).select("role", "x.*")
    return _r6_all(T.compare_runs(long))


def _write_run_files(spark, rt, folder, keys=tuple(R.METRIC_FILES)):
    """The run log as a file stream: one file per model key, by default in start-time order."""
    for k in keys:
        rt.where(F.col("model_key") == k).coalesce(1).write.mode("append").parquet(folder)


@register("champion_watch", _runs_sql(_BEST_SQL, body="SELECT experiment_name, run_id, round(f1, 6) AS f1 FROM best_t"))
def q_champion_watch(spark, sf):
    base = shared_path(spark, "champion_watch", uuid.uuid4().hex)
    _write_run_files(spark, flows.run_table(spark, sf), os.path.join(base, "runs"))
    champ, _ = W.watch_champion(spark, os.path.join(base, "runs"), os.path.join(base, "state"))
    return _r6_all(champ)


@register("champion_events", _runs_sql("""
pref_t AS (
  SELECT p.position AS batch_id, arg_min(r.run_id, (-r.f1, r.run_id)) AS run_id
  FROM (SELECT DISTINCT position FROM runs_t) p JOIN runs_t r ON r.position <= p.position AND r.f1 > 0
  GROUP BY p.position),
ev_t AS (SELECT batch_id, lag(run_id) OVER (ORDER BY batch_id) AS old_run_id, run_id AS new_run_id FROM pref_t)""", body="""
SELECT CAST(batch_id AS INTEGER) AS batch_id, 'telco_churn' AS experiment_name, old_run_id, new_run_id
FROM ev_t WHERE old_run_id IS NULL OR old_run_id <> new_run_id"""))
def q_champion_events(spark, sf):
    base = shared_path(spark, "champion_events", uuid.uuid4().hex)
    _write_run_files(spark, flows.run_table(spark, sf), os.path.join(base, "runs"))
    _, events = W.watch_champion(spark, os.path.join(base, "runs"), os.path.join(base, "state"))
    return events


_HIST_SQL = _runs_sql(body="""
SELECT experiment_name, run_id, run_name, start_time, round(f1, 6) AS f1, round(prev_best, 6) AS prev_best
FROM (SELECT *, max(f1) OVER (PARTITION BY experiment_name ORDER BY start_time, run_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_best FROM runs_t)
WHERE f1 > coalesce(prev_best, -1.0)""")


@register("champion_history", _HIST_SQL)
def q_champion_history(spark, sf):
    h = W.champion_history(flows.run_table(spark, sf))
    return _r6_all(h.select("experiment_name", "run_id", "run_name", "start_time", "f1", "prev_best"))


@register("champion_history_stream", _HIST_SQL)
def q_champion_history_stream(spark, sf):
    """T2 on a stream whose files arrive out of order (each model's three runs take three
    hours; the second model's file comes first, the last one's before the third's)."""
    base = shared_path(spark, "champion_history", uuid.uuid4().hex)
    _write_run_files(spark, flows.run_table(spark, sf), os.path.join(base, "runs"), ("RF", "LogReg", "FE", "XGB"))
    return _r6_all(W.champion_history_stream(spark, os.path.join(base, "runs"), os.path.join(base, "out"), delay="6 hours"))


@register("score_stream", S.chain(body="SELECT row_key, round(proba, 6) AS proba FROM scored_t WHERE model_name = 'logreg'"))
def q_score_stream(spark, sf):
    st = flows.standardized_split(spark, sf).withColumn(
        "arrived_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_interval(secs=F.col("row_key")))
    base = shared_path(spark, "score_stream", uuid.uuid4().hex)
    src = os.path.join(base, "in")
    for s in ("train", "valid", "test", "valid"):   # the validation rows arrive twice
        st.where(F.col("split") == s).write.mode("append").parquet(src)
    b, coef = flows.SCORERS["logreg"]
    out = W.score_stream(spark, src, os.path.join(base, "out"), lambda d: score.linear_score(d, coef, b).select("row_key", "proba"))
    return _r6_all(out)


# ------------------------------------------------------------------ fitted models (rows-only checks)
def _train_valid(spark, sf):
    st = flows.standardized_split(spark, sf)
    feats = [c for c in st.columns if c not in ("row_key", "churn", "split")]
    cast = st.select("row_key", "split", F.col("churn").cast("double").alias("churn"),
                     *[F.col(f"`{c}`").cast("double").alias(c) for c in feats])
    return cast, feats


def _fitted_scores(spark, sf, estimator_fn, weighted=True):
    d, feats = _train_valid(spark, sf)
    train = d.where(F.col("split") == "train")
    if weighted:
        train = fit.prepare_weighted(train)
    model = fit.fit(estimator_fn(train), train, feats)
    sc = score.score(model, d.where(F.col("split") == "valid"))
    return _r6_all(sc.select("row_key", F.col("churn").cast("int").alias("churn"), "proba"))


@register("logreg_fit_scores")
def q_logreg_fit(spark, sf):
    """M3 + P1: balanced-weight L2 logistic regression on standardised features."""
    d, feats = _train_valid(spark, sf)
    train = d.where(F.col("split") == "train")
    model, _ = fit.fit_logreg(train, feats, C=1.0, scale=False, weighted=True)   # already standardised
    sc = score.score(model, d.where(F.col("split") == "valid"))
    return _r6_all(sc.select("row_key", F.col("churn").cast("int").alias("churn"), "proba"))


@register("logreg_unscaled_scores")
def q_logreg_unscaled(spark, sf):
    """M4: unweighted logistic regression with a penalised constant on the unscaled
    prepared features, scored through its coefficients."""
    d, coef, intercept = _liblinear(spark, sf)
    sc = score.linear_score(d.where(F.col("split") == "valid"), coef, intercept)
    return _r6_all(sc.select("row_key", "churn", "proba"))


def _liblinear(spark, sf):
    d = flows.split_table(spark, sf)
    feats = [c for c in d.columns if c not in ("row_key", "churn", "split")]
    coef, intercept = fit.newton_logreg(d.where(F.col("split") == "train"), feats)
    return d, coef, intercept


_FEATURE_NAMES = S.NUMERIC + [f"{c}_{v}" for c, vs in S.CATEGORIES.items() for v in vs[1:]]


@register("liblinear_optimum", "SELECT unnest([" + ", ".join(f"'{c}'" for c in [*_FEATURE_NAMES, "intercept"]) + "]) AS feature, true AS optimal")
def q_liblinear_optimum(spark, sf):
    """M4: at the fitted parameters no parameter could move by 1e-6 towards its best value,
    by a gradient and curvature computed apart from the fit."""
    d, coef, intercept = _liblinear(spark, sf)
    g = fit.logreg_gradient(d.where(F.col("split") == "train"), coef, intercept)
    return g.select("feature", (F.abs("gradient") < 1e-6 * F.col("curvature")).alias("optimal"))


@register("logreg_fit_optimum", "SELECT unnest([" + ", ".join(f"'{c}'" for c in [*_FEATURE_NAMES, "intercept"]) + "]) AS feature, true AS agrees")
def q_logreg_fit_optimum(spark, sf):
    """M3: the library's fit agrees with Newton steps on the same weighted objective."""
    d, feats = _train_valid(spark, sf)
    train = fit.prepare_weighted(d.where(F.col("split") == "train"))
    model = fit.fit(fit.logreg(1.0, 100, train.agg(F.sum("weight")).first()[0]), train, feats).stages[-1]
    coef, intercept = fit.newton_logreg(train, feats, weight="weight", penalize_intercept=False)
    got = [*model.coefficients.toArray(), model.intercept]
    return spark.createDataFrame([(c, bool(abs(a - b) < 1e-3 * max(1.0, abs(b)))) for c, a, b in
                                  zip([*feats, "intercept"], got, [*coef.values(), intercept])], "feature string, agrees boolean")


@register("forest_scores")
def q_forest(spark, sf):
    """M5: weighted random forest."""
    return _fitted_scores(spark, sf, lambda t: fit.random_forest(n_estimators=30, max_depth=6, seed=42))


@register("boosted_scores")
def q_boosted(spark, sf):
    """M6: gradient-boosted trees."""
    return _fitted_scores(spark, sf, lambda t: fit.boosted_trees(n_estimators=20, max_depth=3, learning_rate=0.1),
                          weighted=False)


_STUMP_FEATURES = ["order_count"] + [f"{c}_{v}" for c, vs in S.CATEGORIES.items() for v in vs[1:]]


@register("boosted_stump", S.chain("""
feat_t AS (""" + "\n UNION ALL ".join(f"SELECT {i} AS f, '{c}' AS feature, CAST(\"{c}\" AS DOUBLE) AS v, churn FROM split_t WHERE split = 'train'"
                                       for i, c in enumerate(_STUMP_FEATURES)) + """),
cell_t AS (SELECT f, feature, v, sum(0.5 - churn) AS g, count(*) * 0.25 AS h FROM feat_t GROUP BY f, feature, v),
run_t AS (SELECT f, feature, v, lead(v) OVER w AS nv, sum(g) OVER w AS gl, sum(h) OVER w AS hl,
                 sum(g) OVER (PARTITION BY f) AS g, sum(h) OVER (PARTITION BY f) AS h
          FROM cell_t WINDOW w AS (PARTITION BY f ORDER BY v)),
cut_t AS (SELECT *, (v + nv) / 2 AS cut, gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1) AS gain
          FROM run_t WHERE nv IS NOT NULL AND hl >= 1 AND h - hl >= 1)""", upto="split", body="""
SELECT feature, round(cut, 6) AS cut, round(-0.3 * gl / (hl + 1), 6) AS left_value, round(-0.3 * (g - gl) / (h - hl + 1), 6) AS right_value
FROM cut_t ORDER BY round(gain, 9) DESC, f, v LIMIT 1"""))
def q_boosted_stump(spark, sf):
    """M6: the first cut of boosted trees over all train rows, and its leaf values."""
    train = flows.split_table(spark, sf).where(F.col("split") == "train")
    model = trees.fit_boosted(train, _STUMP_FEATURES, n_estimators=1, max_depth=1)
    t = model.trees[0]
    f = t.feature[0]
    return _r6_all(spark.createDataFrame([(model.features[f], float(model.cuts[f][t.cut[0]]), t.value[t.left[0]], t.value[t.right[0]])],
                                         "feature string, cut double, left_value double, right_value double"))


def _tree_features(d):
    return [c for c in d.columns if c not in ("row_key", "churn", "split")]


@register("boosted_penalty_scores")
def q_boosted_penalty(spark, sf):
    """M6: boosted trees at each L2 penalty of the original's grid, scored on valid."""
    d = flows.split_table(spark, sf)
    train, valid = d.where(F.col("split") == "train"), d.where(F.col("split") == "valid")
    defaults = {"n_estimators": 10, "max_depth": 3, "learning_rate": 0.1, "reg_lambda": 1.0}
    parts = []
    for best in fit.param_grid({"reg_lambda": [0.0, 1.0, 2.0]}):
        params = fit.merge_params(defaults, {"subsample": 0.8, "colsample_bytree": 0.8}, best)
        model = trees.fit_boosted(train, _tree_features(d), **params)
        parts.append(trees.predict(model, valid).select("row_key", "churn", F.lit(params["reg_lambda"]).alias("reg_lambda"), "proba"))
    return _r6_all(split.union_parts(*parts))


@register("forest_rules_scores")
def q_forest_rules(spark, sf):
    """M5: a weighted forest of unlimited depth with ``min_samples_split`` and ``min_samples_leaf``."""
    d = flows.split_table(spark, sf)
    train = fit.prepare_weighted(d.where(F.col("split") == "train"))
    model = trees.fit_forest(train, _tree_features(d), n_estimators=50, min_samples_split=10, min_samples_leaf=2, weight="weight")
    return _r6_all(trees.predict(model, d.where(F.col("split") == "valid")).select("row_key", "churn", "proba"))


@register("cv_grid_results")
def q_cv_grid(spark, sf):
    """M8 + M9 + M12: 3-fold stratified CV over a small forest grid, mean F1 per candidate."""
    d, feats = _train_valid(spark, sf)
    train = materialize(split.stratified_folds(d.where(F.col("split") == "train"), "churn", 3, flows.SEED))
    _, scores = fit.grid_search_cv(train, feats, lambda **p: fit.random_forest(n_estimators=10, seed=42, **p),
                                   {"max_depth": [3, 5], "min_samples_leaf": [1, 5]}, fold_col="fold", parallelism=4)
    return _r6_all(scores.select("candidate", "params").distinct().join(fit.fold_scores_mean(scores), "candidate"))


_GRID = {"model": list(flows.SCORERS), "threshold": [0.2, 0.25, 0.3, 0.35, 0.4, 0.5]}
_GRID_SQL = "grid_t(candidate, model_name, threshold) AS (VALUES " + ", ".join(
    f"({i}, '{p['model']}', CAST({p['threshold']} AS DOUBLE))" for i, p in enumerate(fit.param_grid(_GRID))) + ")"


@register("grid_folds_scorers", S.chain(_GRID_SQL, """
fold_t AS (SELECT row_key, CAST((row_number() OVER (PARTITION BY churn ORDER BY md5(CAST(row_key AS VARCHAR) || '|42'), row_key) - 1) % 3 AS INTEGER) AS fold
           FROM split_t),
conf_t AS (SELECT g.candidate, f.fold, count(*) FILTER (WHERE s.churn = 1 AND s.proba >= g.threshold) AS tp,
                  count(*) FILTER (WHERE s.churn <> 1 AND s.proba >= g.threshold) AS fp,
                  count(*) FILTER (WHERE s.churn = 1 AND NOT s.proba >= g.threshold) AS fn
           FROM scored_t s JOIN fold_t f USING (row_key) JOIN grid_t g USING (model_name) GROUP BY g.candidate, f.fold),
mean_t AS (SELECT candidate, avg(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END) AS mean_f1
           FROM conf_t GROUP BY candidate)""", body="""
SELECT CAST(g.candidate AS INTEGER) AS candidate, g.model_name AS model, g.threshold, round(m.mean_f1, 6) AS mean_f1,
       g.candidate = (SELECT arg_min(candidate, (-round(mean_f1, 9), candidate)) FROM mean_t) AS is_best
FROM grid_t g JOIN mean_t m USING (candidate)"""))
def q_grid_folds(spark, sf):
    """M8 + M11 + M12 on the fixed scorers: the grid of scorer and threshold, F1 of every
    candidate on every stratified fold, mean per candidate, and the best one."""
    sc = flows.scored_table(spark, sf)
    keys = materialize(flows.split_table(spark, sf).select("row_key", "churn"))
    folds = split.stratified_folds(keys, "churn", 3, flows.SEED).select("row_key", "fold")
    grid = [(i, p["model"], p["threshold"]) for i, p in enumerate(fit.param_grid(_GRID))]
    table = spark.createDataFrame(grid, "candidate int, model string, threshold double")     # a parameter list
    rows = sc.join(folds, "row_key").join(F.broadcast(table), F.col("model_name") == F.col("model"))
    scores = evaluate.classification_metrics(score.apply_threshold(rows, F.col("threshold")), "churn", "pred", ["candidate", "fold"])
    means = materialize(fit.fold_scores_mean(scores))
    best = fit.best_candidate(means.withColumn("mean_f1", F.round("mean_f1", 9)))
    out = table.join(means, "candidate").join(best.select(F.col("candidate").alias("best")), F.col("candidate") == F.col("best"), "left")
    return _r6_all(out.select("candidate", "model", "threshold", "mean_f1", F.col("best").isNotNull().alias("is_best")))


@register("holdout_grid_best")
def q_holdout_grid(spark, sf):
    """M10 + M11: logistic regression candidates fitted on train, F1 on valid, best kept."""
    d, feats = _train_valid(spark, sf)
    train = fit.prepare_weighted(d.where(F.col("split") == "train"))
    n = train.count()
    _, res = fit.grid_search_holdout(train, d.where(F.col("split") == "valid"), feats,
                                     lambda C: fit.logreg(C, 100, n, True), {"C": [0.01, 0.1, 1.0, 10.0]})
    return _r6_all(fit.best_candidate(res, "f1"))


@register("model_roundtrip")
def q_model_roundtrip(spark, sf):
    """Save a fitted model to the shared folder, load it, score with the copy."""
    d, feats = _train_valid(spark, sf)
    train = d.where(F.col("split") == "train")
    model, _ = fit.fit_logreg(train, feats, scale=False, weighted=True)
    path = shared_path(spark, "models", uuid.uuid4().hex)
    fit.save_model(model, path)
    sc = score.score(fit.load_model(path), d.where(F.col("split") == "valid"))
    return _r6_all(sc.select("row_key", "proba"))


@register("model_roundtrip_equal", S.chain(upto="split", body="SELECT row_key, true AS same FROM split_t WHERE split = 'valid'"))
def q_model_roundtrip_equal(spark, sf):
    """M13 + P1: the loaded copy scores every row exactly as the original does."""
    d, feats = _train_valid(spark, sf)
    train, valid = d.where(F.col("split") == "train"), d.where(F.col("split") == "valid")
    model, _ = fit.fit_logreg(train, feats, scale=False, weighted=True)
    path = shared_path(spark, "models", uuid.uuid4().hex)
    fit.save_model(model, path)
    own = score.score(model, valid).select("row_key", "proba")
    copy = score.score(fit.load_model(path), valid).select("row_key", F.col("proba").alias("again"))
    return own.join(copy, "row_key").select("row_key", F.col("proba").eqNullSafe(F.col("again")).alias("same"))


# ------------------------------------------------------------------ sinks with partitions
@register("split_sink_valid", S.chain(upto="split", body=f"SELECT * EXCLUDE (split) REPLACE ({_r6_sql(S.NUMERIC)}) FROM split_t WHERE split = 'valid'"))
def q_split_sink(spark, sf):
    """The split table written with one folder per split; reading one split back prunes
    the other folders (PartitionFilters on the scan)."""
    path = shared_path(spark, "splits", uuid.uuid4().hex)
    files.write_partitions(flows.split_table(spark, sf), path, "split")
    return _r6_all(spark.read.parquet(path).where(F.col("split") == "valid").drop("split"))


@register("score_table_sink", S.chain(body="""
SELECT row_key AS customer_id, round(proba, 6) AS score_churn, CAST(proba >= 0.5 AS INTEGER) AS flag_alto_riesgo,
       CASE model_name WHEN 'logreg' THEN DATE '2024-01-31' ELSE DATE '2024-02-29' END AS fecha_scoring
FROM scored_t WHERE model_name IN ('logreg', 'xgb')"""))
def q_score_sink(spark, sf):
    """Daily score table, one partition per date.  The first date is scored twice (a
    re-run); dynamic partition overwrite keeps one copy."""
    sc = flows.scored_table(spark, sf)
    path = shared_path(spark, "scores", uuid.uuid4().hex)
    day1 = score.score_table(sc.where(F.col("model_name") == "logreg"), "row_key", 0.5, "2024-01-31")
    day2 = score.score_table(sc.where(F.col("model_name") == "xgb"), "row_key", 0.5, "2024-02-29")
    for part in (day1, day2, day1):
        files.write_partitions(part, path, "fecha_scoring")
    return _r6_all(spark.read.parquet(path))
