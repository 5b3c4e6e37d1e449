"""Loading the driver tables and deriving the customer churn table from them.

The test tables carry no churn column, so one is defined from order history (a fixed
cut-off date; features only from orders before it; churn = no order in the year after).
Everything here is one lazy plan: a single aggregation of ``orders`` keyed by customer,
joined to ``customer`` and the two fixed-size dimension tables.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed parameters of the churn definition.
CUTOFF = "2000-08-01"
HORIZON_END = "2001-08-01"   # cut-off plus one year



def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table. Column pruning and filters reach the Parquet scan."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _ts(value: str):
    return F.lit(value).cast("timestamp_ntz")


def order_history(spark: SparkSession, sf_dir: str, cutoff: str = CUTOFF,
                  horizon_end: str = HORIZON_END) -> DataFrame:
    """One row per customer with an order before ``horizon_end``.

    A single ``groupBy(o_custkey)``: partial aggregation runs map-side, so a customer that
    owns a third of all orders still leaves each map task as one partial row.
    """
    o = (load(spark, sf_dir, "orders")
         .select("o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
         .where(F.col("o_orderdate") < _ts(horizon_end)))
    before = F.col("o_orderdate") < _ts(cutoff)
    return o.groupBy("o_custkey").agg(
        F.min(F.when(before, F.col("o_orderdate"))).alias("first_order"),
        F.sum(F.when(before, F.col("o_totalprice"))).alias("total_raw"),
        F.count(F.when(before, F.lit(1))).alias("n_orders"),
        # most frequent priority; ties go to the smallest name
        F.mode(F.when(before, F.col("o_orderpriority")), deterministic=True).alias("contract_type"),
        F.max(F.when(~before, F.lit(1))).alias("active_after"),
    )


def churn_customers(spark: SparkSession, sf_dir: str, cutoff: str = CUTOFF,
                    horizon_end: str = HORIZON_END) -> DataFrame:
    """Typed churn table: one row per customer.

    Columns: ``customer_id, tenure_days, n_orders, total_charges, monthly_charges,
    acctbal, contract_type, region, payment_method, churn``.  Customers without orders
    before the cut-off have null tenure and charges (they exercise imputation).
    """
    cust = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    # nation and region are fixed-size dimension tables; no hint: the planner
    # broadcasts them after checking their file-size statistics against
    # spark.sql.autoBroadcastJoinThreshold, and keeps a shuffle join otherwise.
    nation = load(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = load(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")
    hist = order_history(spark, sf_dir, cutoff, horizon_end)
    tenure = F.datediff(_ts(cutoff).cast("date"), F.col("first_order").cast("date"))
    total = F.round(F.col("total_raw"), 2)
    return (cust
            .join(geo, cust.c_nationkey == geo.n_nationkey, "left")
            .join(hist, cust.c_custkey == hist.o_custkey, "left")
            .select(
                F.col("c_custkey").alias("customer_id"),
                tenure.alias("tenure_days"),
                F.coalesce(F.col("n_orders"), F.lit(0)).cast("long").alias("n_orders"),
                total.alias("total_charges"),
                (total / (tenure / F.lit(30.0))).alias("monthly_charges"),
                F.col("c_acctbal").alias("acctbal"),
                F.col("contract_type"),
                F.col("r_name").alias("region"),
                F.col("c_mktsegment").alias("payment_method"),
                F.when(F.col("active_after").isNull(), 1).otherwise(0).alias("churn"),
            ))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The churn table dressed as a raw export: display names, text numbers, blanks,
    padded categories and Yes/No labels in several spellings.

    It is what the cleaning operators (canonical names, label encoding, trimming, numeric
    coercion) are meant to undo.
    """
    c = churn_customers(spark, sf_dir)
    k = F.col("customer_id")
    label = (F.when(F.col("churn") == 1,
                    F.when(k % 3 == 0, F.lit(" Yes ")).when(k % 3 == 1, F.lit("yes")).otherwise(F.lit("YES")))
             .otherwise(F.when(k % 2 == 0, F.lit("No")).otherwise(F.lit(" no"))))
    return c.select(
        k.alias("customerID"),
        F.floor(F.col("tenure_days") / 30).cast("int").alias("Tenure Months"),
        F.col("monthly_charges").alias("Monthly Charges"),
        F.when(F.col("total_charges").isNull(), F.lit(" "))
         .otherwise(F.format_string("%.2f", F.col("total_charges"))).alias("Total Charges"),
        F.col("n_orders").alias("Order Count"),
        F.col("acctbal").alias("Account Balance"),
        F.col("contract_type").alias("Contract Type"),
        F.when(k % 5 == 0, F.concat(F.lit("  "), F.col("region"), F.lit(" "))).otherwise(F.col("region")).alias("Region"),
        F.col("payment_method").alias("Payment-Method"),
        label.alias("Churn"),
    )
