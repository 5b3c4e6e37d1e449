"""Splits and sampling: exact stratified train/valid/test, stratified k-fold, head
samples and hash-based traffic arms.

All of them are a column added to one DataFrame (no physical split into three jobs):
``split`` or ``fold``.  Writing with ``partitionBy("split")`` gives partition pruning
for readers of one split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranges import ROWS_PER_RANGE
from tidemark.operators.ranking import HASH_BUCKETS, seeded_hash, stratified_rank


def _count_for(size_col: str, frac: float):
    # Python's round() on the float product: half to even
    return F.bround(F.col(size_col).cast("double") * F.lit(float(frac)), 0)


def stratified_split(df: DataFrame, target: str = "churn", test_size: float = 0.2, val_size: float = 0.1,
                     seed: int = 42, key: str = "row_key", split_col: str = "split",
                     n_buckets: int = HASH_BUCKETS) -> DataFrame:
    """Per class, rows in seeded hash order; the first ``round(n*test)`` are test,
    the next ``round(n*val)`` valid, the rest train (half-to-even rounding).

    Exact sizes per class, disjoint, deterministic under recomputation.
    """
    r = stratified_rank(df, [target], [key], seed, n_buckets=n_buckets)
    n_test = _count_for("_class_n", test_size)
    n_val = _count_for("_class_n", val_size)
    split = (F.when(F.col("_rank") < n_test, "test")
             .when(F.col("_rank") < n_test + n_val, "valid")
             .otherwise("train"))
    return r.withColumn(split_col, split).drop("_rank", "_class_n")


def shuffle_order(df: DataFrame, seed: int = 42, key: str = "row_key") -> DataFrame:
    """The seeded order of rows, for sinks that need one (a global sort)."""
    return df.orderBy(seeded_hash([key], seed), F.col(key))


def shuffle_position(df: DataFrame, seed: int = 42, key: str = "row_key", out: str = "position",
                     n_buckets: int = HASH_BUCKETS) -> DataFrame:
    """S2 as a column: each row's 0-based place in the seeded order, by the distributed rank
    (no global sort); rows can be stored in any order and still be read as shuffled."""
    return stratified_rank(df, [], [key], seed, n_buckets=n_buckets, rank_col=out, size_col="_all").drop("_all")


def union_parts(*parts: DataFrame) -> DataFrame:
    """S3: concatenation by column name."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def stratified_folds(df: DataFrame, target: str = "churn", k: int = 3, seed: int = 42, key: str = "row_key",
                     shuffle: bool = True, fold_col: str = "fold", n_buckets: int = HASH_BUCKETS,
                     rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``fold = rank within class % k``.

    ``shuffle=True`` ranks in seeded hash order; ``shuffle=False`` ranks by the key, so
    folds interleave in key order.  Fold sizes per class differ by at most one.
    """
    if shuffle:
        r = stratified_rank(df, [target], [key], seed, order="hash", n_buckets=n_buckets)
    else:
        r = stratified_rank(df, [target], [key], order="key", rows_per_range=rows_per_range)
    return r.withColumn(fold_col, (F.col("_rank") % k).cast("int")).drop("_rank", "_class_n")


def head_sample(df: DataFrame, n: int = 5, key: str = "row_key") -> DataFrame:
    """The first ``n`` rows in key order (a top-k, planned as TakeOrderedAndProject)."""
    return df.orderBy(F.col(key)).limit(n)


def assign_arm(df: DataFrame, fractions: dict, key: str = "row_key", seed: int = 0, arm_col: str = "arm") -> DataFrame:
    """Hash bucket of ``md5(key|seed)`` mapped to arms by cumulative fraction.

    Stable per key, no shuffle, no state.
    """
    total = float(sum(fractions.values()))
    u = F.conv(F.substring(seeded_hash([key], seed), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    expr, acc = None, 0.0
    items = list(fractions.items())
    for i, (arm, frac) in enumerate(items):
        acc += frac / total
        cond = u < F.lit(acc) if i < len(items) - 1 else F.lit(True)
        expr = F.when(cond, F.lit(arm)) if expr is None else expr.when(cond, F.lit(arm))
    return df.withColumn(arm_col, expr)
