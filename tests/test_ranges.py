"""Composite-key ranges under skew, and the operators cut by them, against plain windows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import evaluate, ranges, ranking, runs, split


def _check(d, cols, most):
    """Ranges are contiguous in the key order; more than ten of them, none too large."""
    per = d.groupBy("_rng").agg(F.count("*").alias("n"), F.min(F.struct(*cols)).alias("lo"), F.max(F.struct(*cols)).alias("hi"))
    rows = sorted((r["_rng"], r["n"], r["lo"], r["hi"]) for r in per.collect())
    assert len(rows) > 10 and max(r[1] for r in rows) <= most
    both = per.alias("a").join(per.alias("b"), F.col("a._rng") + 1 == F.col("b._rng"))
    assert both.where(~(F.col("a.hi") < F.col("b.lo"))).count() == 0


def test_text_ids_with_one_prefix(spark):
    df = spark.range(4000).select(F.concat(F.lit("CUST-"), F.lpad(F.col("id").cast("string"), 8, "0")).alias("k"))
    _check(ranges.with_ranges(df, ["k"], 100), ["k"], 300)


def test_equal_scores_are_split_by_the_tie_breaker(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 10 < 9, 0.5).otherwise(F.col("id") / 4000).alias("f1"), F.col("id").alias("position"))
    _check(ranges.with_ranges(df, ["f1", "position"], 100), ["f1", "position"], 300)


def test_one_group_in_a_narrow_band(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 20 == 0, "wide").otherwise("band").alias("g"),
                                  F.when(F.col("id") % 20 == 0, F.col("id") * 1.0).otherwise(7 + F.col("id") * 1e-9).alias("x"))
    d = ranges.with_ranges(df, ["g", "x"], 100)
    _check(d, ["g", "x"], 300)
    assert d.where("g = 'band'").select("_rng").distinct().count() > 10


def test_repeated_keys_nulls_and_small_tables(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.lit(5)).otherwise(F.when(F.col("id") % 7 > 0, F.col("id"))).alias("k"))
    d = ranges.with_ranges(df, ["k"], 50)
    assert d.where("k = 5").select("_rng").distinct().count() == 1
    assert d.where("k is null").agg(F.max("_rng")).first()[0] <= d.where("k is not null").agg(F.min("_rng")).first()[0]
    assert {r["_rng"] for r in ranges.with_ranges(df.limit(10), ["k"], 50).collect()} == {0}
    assert ranges.with_ranges(df.limit(0), ["k"], 50).count() == 0


def test_leaderboard_with_equal_scores(spark):
    rows = [(i, 0.7 if i % 10 else (None if i % 3 else i / 1e4)) for i in range(2000)]
    df = spark.createDataFrame(rows, "position int, f1 double")
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    got = sorted((r["rank"], r["position"]) for r in runs.leaderboard(df, rows_per_range=60).collect())
    assert got == [(i + 1, r[0]) for i, r in enumerate(want)]


def test_metric_table_rows_of_one_model(spark):
    rnd = random.Random(2)
    rows = [("LogReg", rnd.choice(["test", "valid"]), *[rnd.random() for _ in range(4)]) for _ in range(500)]
    df = spark.createDataFrame(rows, "model_key string, split string, accuracy double, precision double, recall double, f1 double")
    got = runs.metric_table(df, rows_per_range=20).orderBy("row").collect()
    assert [r["row"] for r in got] == list(range(1, 501))
    cells = [(r["split_order"], r["model_key"], r["accuracy"], r["precision"], r["recall"], r["f1"]) for r in got]
    assert cells == sorted(cells)


def test_ordered_folds_of_long_text_keys(spark):
    df = spark.range(2500).select(F.concat(F.lit("customer-number-"), F.col("id").cast("string")).alias("row_key"), (F.col("id") % 4 == 0).cast("int").alias("churn"))
    w = Window.partitionBy("churn").orderBy("row_key")
    want = df.withColumn("f", (F.row_number().over(w) - 1) % 3)
    got = split.stratified_folds(df, k=3, shuffle=False, rows_per_range=70)
    assert got.join(want, ["row_key", "churn"]).where("fold <> f").count() == 0 and got.count() == 2500


@pytest.mark.parametrize("rows_per_range", [37, 100_000])
def test_curve_in_a_narrow_band(spark, rows_per_range):
    rnd = random.Random(4)
    rows = [("band" if i % 9 else "rest", 0.5 + rnd.randint(0, 400) * 1e-12 if i % 9 else rnd.random(), int(rnd.random() < 0.4)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, proba double, churn int")
    got = {(r["g"], r["threshold"]): (r["tp"], r["fp"]) for r in evaluate.score_curve(df, by=["g"], rows_per_range=rows_per_range).collect()}
    for g in ("band", "rest"):
        own = sorted(((p, y) for h, p, y in rows if h == g), reverse=True)
        tp = fp = 0
        for i, (p, y) in enumerate(own):
            tp, fp = tp + y, fp + 1 - y
            if i + 1 == len(own) or own[i + 1][0] != p:
                assert got[g, p] == (tp, fp)


def test_running_max_of_a_hot_group(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 5 > 0, "hot").otherwise("cold").alias("g"), (F.col("id") / 100).cast("int").alias("t"),
                                  F.col("id").alias("u"), F.rand(3).alias("v"))
    df = spark.createDataFrame([tuple(r) for r in df.collect()], df.schema)
    w = Window.partitionBy("g").orderBy("t", "u").rowsBetween(Window.unboundedPreceding, -1)
    got = ranking.running_max_before(df, ["g"], ["t", "u"], "v", rows_per_range=80)
    assert got.join(df.withColumn("m", F.max("v").over(w)), ["g", "t", "u"]).where(~F.col("prev_best").eqNullSafe(F.col("m"))).count() == 0
