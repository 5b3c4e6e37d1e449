"""Exact splits and folds, against plain-window twins and hand counts."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import ranking, split


def _table(spark, n_pos, n_neg):
    rows = [(i, 1) for i in range(n_pos)] + [(n_pos + i, 0) for i in range(n_neg)]
    return spark.createDataFrame(rows, "row_key long, churn int")


def test_split_sizes_round_half_even(spark):
    # 5 at 0.1 -> 0 (0.5 rounds to even); 15 at 0.1 -> 2 (1.5000000000000002 in floats)
    df = _table(spark, 5, 15)
    counts = {(r.churn, r.split): r["count"] for r in split.stratified_split(df, test_size=0.2, val_size=0.1)
              .groupBy("churn", "split").count().collect()}
    assert counts.get((1, "valid"), 0) == 0 and counts[(1, "test")] == 1
    assert counts[(0, "valid")] == 2 and counts[(0, "test")] == 3


def test_one_row_class(spark):
    out = split.stratified_split(_table(spark, 1, 9)).where("churn = 1").collect()
    assert [r.split for r in out] == ["train"]


def test_rank_matches_window_twin(spark):
    df = spark.range(3000).select(F.col("id").alias("row_key"), (F.col("id") % 7 == 0).cast("int").alias("churn"))
    got = ranking.stratified_rank(df, ["churn"], ["row_key"], 42, n_buckets=64)
    twin = df.withColumn("_h", ranking.seeded_hash(["row_key"], 42)).withColumn(
        "r", F.row_number().over(Window.partitionBy("churn").orderBy("_h", "row_key")) - 1)
    bad = got.join(twin, ["row_key", "churn"]).where(F.col("_rank") != F.col("r")).count()
    assert bad == 0


def test_key_order_rank(spark):
    df = spark.range(500).select((F.col("id") * 3).alias("row_key"), (F.col("id") % 2).cast("int").alias("churn"))
    got = ranking.stratified_rank(df, ["churn"], ["row_key"], order="key", rows_per_range=40)
    twin = df.withColumn("r", F.row_number().over(Window.partitionBy("churn").orderBy("row_key")) - 1)
    assert got.join(twin, ["row_key", "churn"]).where(F.col("_rank") != F.col("r")).count() == 0



def test_key_order_rank_keeps_null_keys(spark):
    """Rows whose first key is null are ranked first (ascending, nulls first), not lost."""
    df = spark.range(300).select(F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id") % 50).alias("k"),
                                 F.col("id").alias("row_key"), (F.col("id") % 2).cast("int").alias("churn"))
    got = ranking.stratified_rank(df, ["churn"], ["k", "row_key"], order="key", rows_per_range=40)
    assert got.count() == 300
    twin = df.withColumn("r", F.row_number().over(Window.partitionBy("churn").orderBy("k", "row_key")) - 1)
    assert got.join(twin, ["row_key", "churn"]).where(F.col("_rank") != F.col("r")).count() == 0

@settings(max_examples=8, deadline=None)
@given(n_pos=st.integers(0, 40), n_neg=st.integers(1, 60), test=st.sampled_from([0.1, 0.2, 0.25]),
       val=st.sampled_from([0.0, 0.1, 0.15]))
def test_split_exact_and_disjoint(spark, n_pos, n_neg, test, val):
    df = _table(spark, n_pos, n_neg)
    out = split.stratified_split(df, test_size=test, val_size=val, seed=7).collect()
    assert len(out) == n_pos + n_neg and len({r.row_key for r in out}) == len(out)
    for cls, n in ((1, n_pos), (0, n_neg)):
        got = [r.split for r in out if r.churn == cls]
        assert got.count("test") == round(n * test)
        assert got.count("valid") == round(n * val)


def test_folds_balanced(spark):
    df = _table(spark, 10, 23)
    for shuffle in (True, False):
        f = split.stratified_folds(df, k=3, shuffle=shuffle).groupBy("churn", "fold").count().collect()
        for cls in (0, 1):
            sizes = [r["count"] for r in f if r.churn == cls]
            assert max(sizes) - min(sizes) <= 1


def test_arms_stable_and_proportional(spark):
    df = spark.range(20000).withColumnRenamed("id", "row_key")
    a = split.assign_arm(df, {"a": 0.5, "b": 0.5}, seed=1)
    share = a.where("arm = 'a'").count() / 20000
    assert 0.47 < share < 0.53
    assert a.exceptAll(split.assign_arm(df, {"a": 0.5, "b": 0.5}, seed=1)).count() == 0


def test_exact_quantile_descent(spark):
    import numpy as np
    vals = [float(x) for x in np.random.default_rng(3).normal(size=2001)] + [5.0] * 700
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = ranking.exact_quantile(df, "x", 0.5, n_buckets=8, small=50)   # forces several rounds
    assert got == float(np.median(vals))
    got2 = ranking.exact_quantile(df.where("x < 4"), "x", 0.5, n_buckets=8, small=50)
    assert got2 == float(np.median([v for v in vals if v < 4]))


def test_running_max_before_matches_window(spark):
    df = spark.range(2000).select((F.col("id") % 3).alias("g"), F.col("id").alias("t"),
                                  (F.rand(5) * 100).alias("v"))
    got = ranking.running_max_before(df, ["g"], ["t"], "v", rows_per_range=100)
    w = Window.partitionBy("g").orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    twin = df.withColumn("m", F.max("v").over(w))
    j = got.join(twin, ["g", "t"])
    assert j.where(~F.col("prev_best").eqNullSafe(F.col("m"))).count() == 0


def test_exact_quantiles_many_columns(spark):
    import numpy as np
    rng = np.random.default_rng(11)
    a = rng.normal(size=3001)
    b = np.concatenate([np.full(1500, 2.0), rng.uniform(size=1000)])       # a hot value
    c = rng.integers(0, 5, size=3001).astype(float)                         # heavy ties
    rows = [(float(a[i]), float(b[i]) if i < len(b) else None, float(c[i])) for i in range(3001)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = ranking.exact_quantiles(df, ["a", "b", "c"], 0.5, n_buckets=8, small=40)
    assert got["a"] == float(np.median(a))
    assert got["b"] == float(np.median(b))
    assert got["c"] == float(np.median(c))
    assert ranking.exact_medians(df, ["a", "b"], small=40, n_buckets=8) == {"a": float(np.median(a)), "b": float(np.median(b))}


def test_ordered_folds_on_text_keys(spark):
    keys = [f"customer-{i:03d}" for i in range(40)] + ["é", "", None]
    df = spark.createDataFrame([(k, i % 2) for i, k in enumerate(keys)], "row_key string, churn int")
    got = {(r.row_key, r.churn): r.fold for r in split.stratified_folds(df, k=3, shuffle=False).collect()}
    w = Window.partitionBy("churn").orderBy(F.col("row_key").asc_nulls_first())
    want = {(r.row_key, r.churn): r.f for r in df.withColumn("f", (F.row_number().over(w) - 1) % 3).collect()}
    assert got == want


def test_shuffle_order_and_positions(spark):
    df = spark.range(700).select(F.col("id").alias("row_key"), F.lit("x").alias("x"))
    order = [r.row_key for r in split.shuffle_order(df, seed=9).collect()]
    assert sorted(order) == list(range(700)) and order != sorted(order)
    assert order != [r.row_key for r in split.shuffle_order(df, seed=10).collect()]
    placed = {r.position: r.row_key for r in split.shuffle_position(df.repartition(5), seed=9, n_buckets=16).collect()}
    assert [placed[i] for i in range(700)] == order
    assert split.shuffle_position(df.limit(0)).count() == 0


def test_union_parts_by_name(spark):
    a = spark.createDataFrame([(1, "a")], "k int, v string")
    b = spark.createDataFrame([("b", 2, 0.5)], "v string, k int, extra double")
    rows = sorted((r.k, r.v, r.extra) for r in split.union_parts(a, b, a).collect())
    assert rows == [(1, "a", None), (1, "a", None), (2, "b", 0.5)]
    assert split.union_parts(a).collect() == a.collect()
