"""Distributed exact ranks, running sums and order statistics.

Three operators the rest of the library builds on.  Each avoids the two plans that do
not scale: a window partitioned by a low-cardinality key (one task per class) and an
unpartitioned window (one task for everything).

* ``stratified_rank``  - exact 0-based rank of every row inside its class, in a seeded
  hash order (or key order).  Rows are cut into contiguous ranges of the sort key (for
  key order ``ranges.with_ranges``: of class, key and tie-breakers together); the
  per-(class, range) counts form a small table whose running offsets are joined back,
  and each range is ranked locally by its own window partition.
* ``running_totals``   - descending cumulative sums over a sorted column, same offset trick.
* ``exact_quantiles``  - exact interpolated quantiles (pandas / Spark ``median``) of
  many columns at once by repeated bucket counting; never holds more than ``small``
  values in one task.
* ``running_max_before`` - prefix maxima in time order, same range/offset trick.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ranges import ROWS_PER_RANGE, with_ranges
from tidemark.session import checked_collect

HASH_BUCKETS = 4096          # contiguous ranges of the md5 order per class


def seeded_hash(key_cols: list[str], seed) -> Column:
    """md5 hex of ``key|...|seed``: the seeded shuffle order used by splits and folds."""
    parts = [F.col(c).cast("string") for c in key_cols] + [F.lit(str(seed))]
    return F.md5(F.concat_ws("|", *parts))


def _hash_range(h: Column, n_buckets: int) -> Column:
    # monotone in h: the first 8 hex digits scaled to [0, n_buckets)
    prefix = F.conv(F.substring(h, 1, 8), 16, 10).cast("long")
    return F.floor(prefix * F.lit(n_buckets) / F.lit(4294967296)).cast("int")


def join_groups(left: DataFrame, right: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on the group columns in which null is a value like any other.

    The key is a struct of the columns: structs with equal null fields are equal, and the
    join still shuffles and sorts on that one key."""
    key = F.struct(*by)
    r = right.withColumn("_g", key).drop(*by)
    return left.withColumn("_g", key).join(r, "_g", how).drop("_g")


def stratified_rank(df: DataFrame, by: list[str], key: list[str], seed=None,
                    order: str = "hash", n_buckets: int = HASH_BUCKETS, rows_per_range: int = ROWS_PER_RANGE,
                    rank_col: str = "_rank", size_col: str = "_class_n", stored: bool = False) -> DataFrame:
    """Add the exact 0-based rank of each row within its ``by`` group, and the group size.

    ``order="hash"``: rows are ordered by ``md5(key|seed)`` then key (a seeded shuffle).
    ``order="key"``:  rows are ordered by the key columns themselves, of any type, nulls
    first.

    Plan: ``range`` is a monotone function of the sort order, so (by, range) counts give
    every range its starting offset.  The final window is partitioned by (by, range): a
    hot class is spread over ``n_buckets`` hash ranges, or in key order over ranges of
    about ``rows_per_range`` rows, instead of one task.  The input is shuffled once, on
    (by, range); the counts table (a row per range, and one more per group that shares a
    range) is the only other shuffle.  ``stored`` says that key order may read ``df``
    several times; otherwise it is written once.
    """
    if order == "hash":
        d = df.withColumn("_h", seeded_hash(key, seed)).withColumn("_rng", _hash_range(F.col("_h"), n_buckets))
        within = [F.col("_h")] + [F.col(c) for c in key]
    elif order == "key":
        d = with_ranges(df, [*by, *key], rows_per_range, stored=stored)
        within = [F.col(c) for c in key]
    else:
        raise ValueError(f"unknown order {order!r}")
    d = d.withColumn("_g", F.struct(*by, "_rng"))      # null groups join as a value
    counts = d.groupBy("_g").agg(F.count(F.lit(1)).alias("_cnt")).select("_g", "_g.*", "_cnt")
    w_before = Window.partitionBy(*by).orderBy("_rng").rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*by)
    offsets = counts.select("_g",
                            F.coalesce(F.sum("_cnt").over(w_before), F.lit(0)).alias("_off"),
                            F.sum("_cnt").over(w_all).alias(size_col))
    # No broadcast: the join and the local window both cluster on (by, range), so one
    # shuffle of the input serves both; AQE may still turn the join into a broadcast
    # from the exact runtime size of the offsets stage.
    local = Window.partitionBy("_g").orderBy(*within)
    out = (d.join(offsets, "_g")
           .withColumn(rank_col, (F.col("_off") + F.row_number().over(local) - 1).cast("long"))
           .drop("_off", "_rng", "_g"))
    return out.drop("_h") if order == "hash" else out


def running_totals(df: DataFrame, by: list[str], order_col: str, sums: list[str],
                   rows_per_range: int = ROWS_PER_RANGE, prefix: str = "cum_", stored: bool = False) -> DataFrame:
    """For each row, the sums of ``sums`` over all rows of its group with
    ``order_col >= `` its own value (descending cumulative sums, ties excluded: the
    input should already hold one row per distinct ``order_col`` in each group).

    Rows are cut into ranges of (group, ``order_col``); totals per (group, range) become
    offsets joined back on (group, range), the same clustering the local running window
    needs.  ``stored``: ``df`` may be read several times.
    """
    d = with_ranges(df, [*by, order_col], rows_per_range, stored=stored)
    d = d.withColumn("_g", F.struct(*by, "_rng"))
    tot = d.groupBy("_g").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums]).select("_g", "_g.*", *[f"_t_{s}" for s in sums])
    w_before = Window.partitionBy(*by).orderBy(F.col("_rng").desc()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = tot.select("_g", *[F.coalesce(F.sum(f"_t_{s}").over(w_before), F.lit(0)).alias(f"_off_{s}")
                                         for s in sums])
    local = (Window.partitionBy("_g").orderBy(F.col(order_col).desc())
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = d.join(offsets, "_g")
    for s in sums:
        out = out.withColumn(f"{prefix}{s}", F.col(f"_off_{s}") + F.sum(s).over(local))
    return out.drop("_rng", "_g", *[f"_off_{s}" for s in sums])


def exact_medians(df: DataFrame, cols: list[str], small: int = 1_000_000, n_buckets: int = 256,
                  counts: dict | None = None) -> dict:
    """Exact interpolated medians of several columns (NaN counts as missing).

    One job counts the values of every column (skipped when the caller passes
    ``counts`` from an earlier pass).  Columns with at most ``small`` values
    share one ``median`` aggregate (exact, holding at most ``small`` values per task);
    larger ones go through ``exact_quantiles``, whose memory is bounded whatever the
    column size.
    """
    if not cols:
        return {}
    if counts is None or any(c not in counts for c in cols):
        row = df.agg(*[F.count(_clean_value(c)).alias(f"n{i}") for i, c in enumerate(cols)]).collect()[0]
        n = {c: row[f"n{i}"] for i, c in enumerate(cols)}
    else:
        n = {c: counts[c] for c in cols}
    out = {c: None for c in cols if n[c] == 0}
    small_cols = [c for c in cols if 0 < n[c] <= small]
    if small_cols:
        row = df.agg(*[F.median(_clean_value(c)).alias(f"m{i}") for i, c in enumerate(small_cols)]).collect()[0]
        out.update({c: float(row[f"m{i}"]) for i, c in enumerate(small_cols)})
    big = [c for c in cols if n[c] > small]
    if big:
        out.update(exact_quantiles(df, big, 0.5, n_buckets=n_buckets, small=small, counts=n))
    return out


def _clean_value(c: str) -> Column:
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def exact_quantiles(df: DataFrame, cols: list[str], q: float = 0.5, n_buckets: int = 256,
                    small: int = 1_000_000, counts: dict | None = None) -> dict:
    """Exact interpolated quantile of several columns at once, with bounded memory.

    All columns descend together.  Each round is two jobs over the table: approximate
    quantile bounds inside every column's current value range, then per (column,
    range bucket) the count, minimum and maximum (at most ``n_buckets`` rows per column
    reach the driver).  A target rank that is the first or last of its bucket, or in a
    bucket holding a single value, is read from those statistics; otherwise the search
    continues inside that bucket.  Once a range holds at most ``small`` values, a window
    ranked per column (partitioned by column) picks the target rows.
    """
    if counts is None:
        row = df.agg(*[F.count(_clean_value(c)).alias(f"n{i}") for i, c in enumerate(cols)]).collect()[0]
        counts = {c: row[f"n{i}"] for i, c in enumerate(cols)}
    state, result = {}, {}
    for c in cols:
        n = counts[c]
        if n == 0:
            result[c] = None
            continue
        pos = (n - 1) * q
        k0, k1 = math.floor(pos), math.ceil(pos)
        state[c] = {"lo": -math.inf, "hi": math.inf, "off": 0, "m": n, "pos": pos,
                    "need": sorted({k0, k1}), "found": {}}

    def in_range(c, st):
        v = _clean_value(c)
        cond = v.isNotNull()
        if st["lo"] != -math.inf:
            cond = cond & (v >= F.lit(st["lo"]))
        if st["hi"] != math.inf:
            cond = cond & (v < F.lit(st["hi"]))
        return cond

    def stacked(names):
        items = [F.struct(F.lit(c).alias("feature"), F.when(in_range(c, state[c]), _clean_value(c)).alias("v"))
                 for c in names]
        return df.select(F.explode(F.array(*items)).alias("s")).select("s.feature", "s.v").where(F.col("v").isNotNull())

    while True:
        active = [c for c, st in state.items() if len(st["found"]) < len(st["need"])]
        if not active:
            break
        small_cols = [c for c in active if state[c]["m"] <= small]
        if small_cols:
            off = F.create_map(*[x for c in small_cols for x in (F.lit(c), F.lit(state[c]["off"]))])
            w = Window.partitionBy("feature").orderBy("v")
            ranked = stacked(small_cols).withColumn("r", F.row_number().over(w) - 1 + F.element_at(off, F.col("feature")))
            wanted = F.create_map(*[x for c in small_cols
                                    for x in (F.lit(c), F.array(*[F.lit(k) for k in state[c]["need"]]))])
            hits = ranked.where(F.array_contains(F.element_at(wanted, F.col("feature")), F.col("r")))
            for r in checked_collect(hits, 2 * len(small_cols), "rank picks"):
                state[r["feature"]]["found"][r["r"]] = float(r["v"])
            continue
        # one job: range bounds (and the range's min and max) for every active column
        probs = [i / n_buckets for i in range(n_buckets + 1)]
        qrow = df.agg(*[F.percentile_approx(F.when(in_range(c, state[c]), _clean_value(c)), probs, 10_000).alias(f"q{i}")
                        for i, c in enumerate(active)]).collect()[0]
        splits = {}
        for i, c in enumerate(active):
            st, qs = state[c], [float(x) for x in qrow[f"q{i}"]]
            mn, mx = qs[0], qs[-1]
            if mn == mx:   # the whole range is one value
                for k in st["need"]:
                    st["found"].setdefault(k, mn)
                continue
            inner = sorted({x for x in qs[1:-1] if st["lo"] < x < st["hi"]}) or [(mn + mx) / 2]
            splits[c] = [st["lo"]] + inner + [st["hi"]]
        if not splits:
            continue
        names = list(splits)
        tmp = {c: f"_x{i}" for i, c in enumerate(names)}
        wide = df.select(*[F.coalesce(F.when(in_range(c, state[c]), _clean_value(c)), F.lit(float("nan"))).alias(tmp[c])
                           for c in names])
        bucketed = Bucketizer(splitsArray=[splits[c] for c in names], inputCols=[tmp[c] for c in names],
                              outputCols=[f"{tmp[c]}_b" for c in names], handleInvalid="keep").transform(wide)
        items = [F.struct(F.lit(c).alias("feature"), F.col(f"{tmp[c]}_b").alias("b"), F.col(tmp[c]).alias("v"))
                 for c in names]
        last = F.create_map(*[x for c in names for x in (F.lit(c), F.lit(float(len(splits[c]) - 1)))])
        stats = (bucketed.select(F.explode(F.array(*items)).alias("s")).select("s.*")
                 .where(F.col("b") < F.element_at(last, F.col("feature")))      # drop out-of-range (NaN) rows
                 .groupBy("feature", "b").agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("mn"), F.max("v").alias("mx")))
        rows = checked_collect(stats, sum(len(splits[c]) for c in names), "bucket statistics")
        by_col: dict = {}
        for r in rows:
            by_col.setdefault(r["feature"], []).append(r)
        for c in names:
            st = state[c]
            start = st["off"]
            descend = None
            for r in sorted(by_col.get(c, []), key=lambda x: x["b"]):
                first, last_rank = start, start + r["c"] - 1
                for k in st["need"]:
                    if k in st["found"] or not first <= k <= last_rank:
                        continue
                    if r["mn"] == r["mx"] or k == first:
                        st["found"][k] = float(r["mn"])
                    elif k == last_rank:
                        st["found"][k] = float(r["mx"])
                    else:
                        j = int(r["b"])
                        descend = (splits[c][j], splits[c][j + 1], first, r["c"])
                start = last_rank + 1
            if descend:
                st["lo"], st["hi"], st["off"], st["m"] = descend
    for c, st in state.items():
        k0, k1 = math.floor(st["pos"]), math.ceil(st["pos"])
        a, b = st["found"][k0], st["found"][k1]
        result[c] = a if k0 == k1 else (k1 - st["pos"]) * a + (st["pos"] - k0) * b
    return result


def exact_quantile(df: DataFrame, col: str, q: float = 0.5, n_buckets: int = 256,
                   small: int = 50_000) -> float | None:
    """Exact interpolated quantile of one column (pandas ``quantile``, Spark
    ``percentile``); ``None`` for an all-null column."""
    return exact_quantiles(df, [col], q, n_buckets=n_buckets, small=small)[col]


def running_max_before(df: DataFrame, by: list[str], order: list[str], value: str,
                       rows_per_range: int = ROWS_PER_RANGE, out: str = "prev_best", stored: bool = False) -> DataFrame:
    """For each row, the maximum of ``value`` over the rows of its group that come
    strictly before it in ``order`` (null for the first row).

    Rows are cut into ranges of (group, order columns); the maximum of every earlier range
    of the group is an offset computed on the small (group, range) table, and only the rest
    is a window - partitioned by (group, range), so a group holding a third of all rows
    still spreads over many tasks.  ``stored``: ``df`` may be read several times."""
    d = with_ranges(df, [*by, *order], rows_per_range, stored=stored)
    d = d.withColumn("_g", F.struct(*by, "_rng"))
    tot = d.groupBy("_g").agg(F.max(value).alias("_m")).select("_g", "_g.*", "_m")
    w_before = Window.partitionBy(*by).orderBy("_rng").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tot.select("_g", F.max("_m").over(w_before).alias("_off"))
    local = Window.partitionBy("_g").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (d.join(offsets, "_g")
            .withColumn(out, F.greatest(F.col("_off"), F.max(value).over(local)))
            .drop("_rng", "_off", "_g"))
