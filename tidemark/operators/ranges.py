"""Contiguous ranges of a composite sort key.

Ranks, running sums and running maxima over whole tables need the rows cut into ranges of
their order.  Here a range is cut on the full key - group, sort columns and tie-breakers -
so a hot group, a band of nearly equal scores, equal scores or texts that share a prefix
are spread as evenly as distinct keys allow.  The number of ranges follows the number of
rows; the splitters come from one weighted sample and are found by binary search in a
column expression, so rows never leave the JVM.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.exprs import quoted
from tidemark.session import checked_collect, materialize

#: Rows that one range should hold, and most ranges of a table (splitters reach the driver).
ROWS_PER_RANGE, MAX_RANGES = 250_000, 16_384
#: Sampled keys per range.
SAMPLE_PER_RANGE = 32
_HASH_SPACE = 1 << 40


def splitters(df: DataFrame, cols: list[str], n_rows: int, rows_per_range: int = ROWS_PER_RANGE) -> list:
    """Upper ends of all ranges but the last, ascending: rows with fields ``k0, k1, ...``.

    The sample keeps the keys whose hash falls below a share, so it is the same at every
    evaluation.  A key that many rows repeat weighs as many sampled rows as it stands for,
    and can end a range of its own; its rows stay together, as no further column tells them
    apart."""
    n = min(MAX_RANGES, -(-n_rows // max(1, rows_per_range)))
    if n < 2:
        return []
    keys = [f"k{i}" for i in range(len(cols))]
    share = min(1.0, SAMPLE_PER_RANGE * n / n_rows)
    rows = df.select(*[quoted(c).alias(k) for c, k in zip(cols, keys)])
    if share < 1.0:
        rows = rows.where(F.pmod(F.xxhash64(*keys), F.lit(_HASH_SPACE)) < F.lit(int(share * _HASH_SPACE)))
    sample = rows.groupBy(*keys).agg(F.greatest(F.lit(1.0), F.round(F.count(F.lit(1)) * share)).alias("w"))
    # about SAMPLE_PER_RANGE * MAX_RANGES keys at most, whatever the table: one task orders them
    order = Window.orderBy(*keys)
    upto = F.sum("w").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    total = F.sum("w").over(Window.partitionBy())
    cut = sample.select(*keys, "w", upto.alias("upto"), total.alias("total"))
    ends = cut.where((F.floor(F.col("upto") * n / F.col("total")) > F.floor((F.col("upto") - F.col("w")) * n / F.col("total")))
                     & (F.col("upto") < F.col("total")))
    return checked_collect(ends.select(*keys).orderBy(*keys), MAX_RANGES, "range splitters")


def add_ranges(df: DataFrame, cols: list[str], ends: list, out: str = "_rng") -> DataFrame:
    """Add ``out``: the number of splitters below the row's key (nulls sort first, as in an
    ascending sort)."""
    if not ends:
        return df.withColumn(out, F.lit(0))
    key_type = T.StructType([T.StructField(f"k{i}", df.schema[c].dataType) for i, c in enumerate(cols)])
    table = df.sparkSession.createDataFrame([(ends,)], T.StructType([T.StructField("ends", T.ArrayType(key_type))]))
    key = F.struct(*[quoted(c).alias(f"k{i}") for i, c in enumerate(cols)])
    d = df.withColumn("_ends", table.scalar()).withColumn("_key", key)
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(len(ends).bit_length()))])
    at = F.aggregate(steps, F.lit(0), lambda low, step: F.when(F.get("_ends", low + step - 1) < F.col("_key"), low + step).otherwise(low))
    return d.withColumn(out, at).drop("_ends", "_key")


def with_ranges(df: DataFrame, cols: list[str], rows_per_range: int = ROWS_PER_RANGE, out: str = "_rng",
                stored: bool = False) -> DataFrame:
    """``df`` with the range of its composite key ``cols``, ascending.

    The table is written once (unless the caller ``stored`` it): counting, sampling and the
    caller's passes read that copy, and its row count costs no scan."""
    d = df if stored else materialize(df)
    return add_ranges(d, cols, splitters(d, cols, d.count(), rows_per_range), out)
