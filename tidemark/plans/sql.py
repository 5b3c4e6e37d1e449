"""SQL twins of the Spark plans, for DuckDB over the same Parquet tables.

Shared common-table-expressions are composed into one statement per query.  Floats that
are reported are rounded to 6 places; scores are rounded to 9 places before grouping.
"""

from __future__ import annotations

# churn table: same definition as tidemark.sources.tables.churn_customers
CHURN = """
hist AS (
  SELECT o_custkey,
         min(CASE WHEN o_orderdate < TIMESTAMP '2000-08-01' THEN o_orderdate END) AS first_order,
         sum(CASE WHEN o_orderdate < TIMESTAMP '2000-08-01' THEN o_totalprice END) AS total_raw,
         count(CASE WHEN o_orderdate < TIMESTAMP '2000-08-01' THEN 1 END) AS n_orders,
         max(CASE WHEN o_orderdate >= TIMESTAMP '2000-08-01' THEN 1 END) AS active_after
  FROM orders WHERE o_orderdate < TIMESTAMP '2001-08-01' GROUP BY o_custkey),
prio AS (
  SELECT o_custkey, o_orderpriority AS contract_type,
         row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) AS rn
  FROM orders WHERE o_orderdate < TIMESTAMP '2000-08-01' GROUP BY o_custkey, o_orderpriority),
churn_t AS (
  SELECT c.c_custkey AS customer_id,
         CAST(date_diff('day', CAST(h.first_order AS DATE), DATE '2000-08-01') AS INTEGER) AS tenure_days,
         CAST(coalesce(h.n_orders, 0) AS BIGINT) AS n_orders,
         round(h.total_raw, 2) AS total_charges,
         round(h.total_raw, 2) / (date_diff('day', CAST(h.first_order AS DATE), DATE '2000-08-01') / 30.0) AS monthly_charges,
         c.c_acctbal AS acctbal,
         p.contract_type,
         r.r_name AS region,
         c.c_mktsegment AS payment_method,
         CASE WHEN h.active_after IS NULL THEN 1 ELSE 0 END AS churn
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN hist h ON c.c_custkey = h.o_custkey
  LEFT JOIN prio p ON c.c_custkey = p.o_custkey AND p.rn = 1)
"""


def with_(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body

RAW = """
raw_t AS (
  SELECT customer_id AS "customerID",
         CAST(floor(tenure_days / 30) AS INTEGER) AS "Tenure Months",
         monthly_charges AS "Monthly Charges",
         CASE WHEN total_charges IS NULL THEN ' ' ELSE printf('%.2f', total_charges) END AS "Total Charges",
         n_orders AS "Order Count",
         acctbal AS "Account Balance",
         contract_type AS "Contract Type",
         CASE WHEN customer_id % 5 = 0 THEN '  ' || region || ' ' ELSE region END AS "Region",
         payment_method AS "Payment-Method",
         CASE WHEN churn = 1 THEN CASE customer_id % 3 WHEN 0 THEN ' Yes ' WHEN 1 THEN 'yes' ELSE 'YES' END
              ELSE CASE WHEN customer_id % 2 = 0 THEN 'No' ELSE ' no' END END AS "Churn"
  FROM churn_t)
"""

# C2 - C7 on raw_t
CLEAN = r"""
clean_t AS (
  SELECT "customerID" AS row_key,
         "Tenure Months" AS tenure_months,
         "Monthly Charges" AS monthly_charges,
         CASE WHEN regexp_matches(trim("Total Charges"), '^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$')
              THEN CAST(trim("Total Charges") AS DOUBLE) END AS total_charges,
         "Order Count" AS order_count,
         "Account Balance" AS account_balance,
         trim("Contract Type") AS contract_type,
         trim("Region") AS region,
         trim("Payment-Method") AS payment_method,
         CAST(CASE WHEN lower(trim("Churn")) = 'yes' THEN 1 WHEN lower(trim("Churn")) = 'no' THEN 0
              ELSE coalesce(TRY_CAST(TRY_CAST(trim("Churn") AS DOUBLE) AS INTEGER), 0) END AS INTEGER) AS churn
  FROM raw_t)
"""

# The categories present in the driver tables (sorted; the first is the base).
CATEGORIES = {
    "contract_type": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "region": ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"],
    "payment_method": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
}
NUMERIC = ["tenure_months", "monthly_charges", "total_charges", "order_count", "account_balance"]


def _dummies() -> str:
    out = []
    for c, vs in CATEGORIES.items():
        for v in vs[1:]:
            out.append(f"coalesce({c} = '{v}', false) AS \"{c}_{v}\"")
    return ",\n         ".join(out)


IMPUTED = """
med_t AS (SELECT """ + ", ".join(f"median({c}) AS {c}" for c in NUMERIC) + """ FROM clean_t),
imp_t AS (
  SELECT c.row_key, """ + ", ".join(f"coalesce(CAST(c.{c} AS DOUBLE), m.{c}) AS {c}" for c in NUMERIC) + """,
         c.contract_type, c.region, c.payment_method, c.churn
  FROM clean_t c, med_t m)
"""

PREP = """
prep_t AS (
  SELECT row_key, """ + ", ".join(NUMERIC) + """,
         """ + _dummies() + """,
         churn
  FROM imp_t)
"""

SPLIT = """
rank_t AS (
  SELECT *, row_number() OVER (PARTITION BY churn ORDER BY md5(CAST(row_key AS VARCHAR) || '|42'), row_key) - 1 AS rk,
         count(*) OVER (PARTITION BY churn) AS cn
  FROM prep_t),
split_t AS (
  SELECT * EXCLUDE (rk, cn),
         CASE WHEN rk < round_even(CAST(cn AS DOUBLE) * CAST(0.2 AS DOUBLE), 0) THEN 'test'
              WHEN rk < round_even(CAST(cn AS DOUBLE) * CAST(0.2 AS DOUBLE), 0)
                        + round_even(CAST(cn AS DOUBLE) * CAST(0.1 AS DOUBLE), 0) THEN 'valid'
              ELSE 'train' END AS split
  FROM rank_t)
"""

STD = """
stat_t AS (SELECT """ + ", ".join(f"avg({c}) AS m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) AS s_{c}" for c in NUMERIC) + """
           FROM split_t WHERE split = 'train'),
std_t AS (
  SELECT s.* REPLACE (""" + ", ".join(f"(s.{c} - t.m_{c}) / t.s_{c} AS {c}" for c in NUMERIC) + """)
  FROM split_t s, stat_t t)
"""


def _scorer_sql(scorers: dict) -> str:
    parts = []
    for name, (b, coef) in scorers.items():
        z = " + ".join([f"CAST({float(b)!r} AS DOUBLE)"] +
                       [f"CAST({float(w)!r} AS DOUBLE) * CAST(\"{c}\" AS DOUBLE)" for c, w in coef.items()])
        parts.append(f"SELECT row_key, churn, split, '{name}' AS model_name, 1.0 / (1.0 + exp(-({z}))) AS proba FROM std_t")
    return "scored_t AS (\n  " + "\n  UNION ALL ".join(parts) + ")"


def scored_cte() -> str:
    from tidemark.plans.flows import SCORERS
    return _scorer_sql(SCORERS)


def chain(*extra: str, upto: str = "scored", body: str) -> str:
    order = ["churn", "raw", "clean", "imputed", "prep", "split", "std", "scored"]
    pieces = {"churn": CHURN, "raw": RAW, "clean": CLEAN, "imputed": IMPUTED, "prep": PREP,
              "split": SPLIT, "std": STD}
    ctes = []
    for k in order[: order.index(upto) + 1]:
        ctes.append(scored_cte() if k == "scored" else pieces[k])
    return with_(*ctes, *extra, body=body)

def curve_ctes(by: list[str], where: str, sfx: str = "", src: str = "scored_t") -> str:
    """Curve points per group (scores rounded to 9 places) and the per-group summary."""
    g = ", ".join(by)
    return f"""
pts{sfx}_t AS (
  SELECT {g}, round(proba, 9) AS threshold,
         count(*) FILTER (WHERE churn = 1) AS pos, count(*) FILTER (WHERE churn <> 1) AS neg
  FROM {src} WHERE {where} GROUP BY {g}, round(proba, 9)),
cum{sfx}_t AS (
  SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
         sum(pos) OVER (PARTITION BY {g}) AS n_pos, sum(neg) OVER (PARTITION BY {g}) AS n_neg
  FROM pts{sfx}_t WINDOW w AS (PARTITION BY {g} ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
pr{sfx}_t AS (
  SELECT *, tp / (tp + fp) AS precision,
         CASE WHEN n_pos = 0 THEN 0.0 ELSE tp / n_pos END AS recall,
         CASE WHEN n_neg = 0 THEN 0.0 ELSE fp / n_neg END AS fpr
  FROM cum{sfx}_t),
curve{sfx}_t AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-12) AS f1, recall AS tpr FROM pr{sfx}_t),
summary{sfx}_t AS (
  SELECT {g},
         CASE WHEN any_value(n_pos) > 0 AND any_value(n_neg) > 0
              THEN sum(neg * (2 * tp - pos)) / (2.0 * any_value(n_pos) * any_value(n_neg)) END AS roc_auc,
         CASE WHEN any_value(n_pos) > 0 THEN sum(pos * precision) / any_value(n_pos) ELSE 0.0 END AS pr_ap,
         arg_min(threshold, (-f1, threshold)) AS best_threshold,
         max(f1) AS best_f1,
         CAST(any_value(n_pos) AS BIGINT) AS n_pos, CAST(any_value(n_neg) AS BIGINT) AS n_neg
  FROM curve{sfx}_t GROUP BY {g})
"""


# curve points per model on the validation split
CURVE = curve_ctes(["model_name"], "split = 'valid'")


def metrics_cols(pred: str, label: str = "churn") -> str:
    """Confusion counts and the four ratios over rows with a 0/1 ``pred`` expression."""
    return f"""
  CAST(count(*) FILTER (WHERE {label} = 1 AND {pred} = 1) AS BIGINT) AS tp,
  CAST(count(*) FILTER (WHERE {label} <> 1 AND {pred} = 1) AS BIGINT) AS fp,
  CAST(count(*) FILTER (WHERE {label} <> 1 AND {pred} <> 1) AS BIGINT) AS tn,
  CAST(count(*) FILTER (WHERE {label} = 1 AND {pred} <> 1) AS BIGINT) AS fn,
  CAST(count(*) AS BIGINT) AS n"""


RATIOS = """
  round(CASE WHEN n = 0 THEN 0.0 ELSE (tp + tn) / n END, 6) AS accuracy,
  round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END, 6) AS precision,
  round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1"""


# run log: one run per (scorer, split), metrics at threshold 0.5 plus curve summaries
RUNS = curve_ctes(["model_name", "split"], "TRUE", "2") + """,
runm_t AS (SELECT model_name, split, """ + metrics_cols("CAST(proba >= 0.5 AS INTEGER)") + """
           FROM scored_t GROUP BY model_name, split),
runs_t AS (
  SELECT md5(m.model_name || '|' || m.split) AS run_id,
         'metrics_' || m.split || CASE m.model_name WHEN 'logreg' THEN '' WHEN 'rf' THEN '_rf' WHEN 'xgb' THEN '_xgb' ELSE '_fe' END AS run_name,
         'telco_churn' AS experiment_name,
         CASE m.model_name WHEN 'logreg' THEN 'LogReg' WHEN 'rf' THEN 'RF' WHEN 'xgb' THEN 'XGB' ELSE 'FE' END AS model_key,
         CASE m.model_name WHEN 'rf' THEN 'TelcoChurn_RF' WHEN 'xgb' THEN 'TelcoChurn_XGB' ELSE 'TelcoChurn_LogReg' END AS registered_model,
         m.split,
         CAST(CASE m.model_name WHEN 'logreg' THEN 0 WHEN 'rf' THEN 1 WHEN 'xgb' THEN 2 ELSE 3 END AS INTEGER) AS position,
         TIMESTAMP '2024-02-01 00:00:00' + to_hours(CAST(CASE m.model_name WHEN 'logreg' THEN 0 WHEN 'rf' THEN 1 WHEN 'xgb' THEN 2 ELSE 3 END * 3
                                                + CASE m.split WHEN 'train' THEN 0 WHEN 'valid' THEN 1 ELSE 2 END AS INTEGER)) AS start_time,
         CASE WHEN m.n = 0 THEN 0.0 ELSE (m.tp + m.tn) / m.n END AS accuracy,
         CASE WHEN m.tp + m.fp = 0 THEN 0.0 ELSE m.tp / (m.tp + m.fp) END AS precision,
         CASE WHEN m.tp + m.fn = 0 THEN 0.0 ELSE m.tp / (m.tp + m.fn) END AS recall,
         CASE WHEN 2 * m.tp + m.fp + m.fn = 0 THEN 0.0 ELSE 2 * m.tp / (2 * m.tp + m.fp + m.fn) END AS f1,
         c.roc_auc, c.pr_ap
  FROM runm_t m JOIN summary2_t c USING (model_name, split))"""

SCORED_EVENTS = """
sev_t AS (
  SELECT e.event_id, e.ts, s.row_key, s.churn, s.proba, CAST(s.proba >= 0.5 AS INTEGER) AS pred,
         time_bucket(INTERVAL '7 days', e.ts, TIMESTAMP '1970-01-01') AS window_start
  FROM events e JOIN scored_t s ON e.user_id = s.row_key WHERE s.model_name = 'logreg')"""

WINDOW_COUNTS = """
wc_t AS (
  SELECT window_start, window_start + INTERVAL '7 days' AS window_end,""" + metrics_cols("pred") + """
  FROM sev_t GROUP BY window_start)"""
