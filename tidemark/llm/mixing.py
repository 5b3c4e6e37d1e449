"""Mixing sources to target weights by temperature, in DataFrame operations only.

Source shares ``p`` become weights ``p^a / sum p^a``.  The exponent is found by bisection;
one aggregate over the source table serves four halvings at once: the largest exponent in
[0, 1] at which the entropy reaches a target, or the smallest at which no source repeats
more often than a limit.  The weights are realised as a stream of blocks of equal token
budget: a source's documents run in permutations (one per pass over the source, ordered by
a hash), their running token sum says which block a document falls in, and a block holds
each source's share of the budget.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.storage import stored

#: A step judges the ends of 16 equal parts, all that four halvings can reach; 40 halvings.
GRID, STEPS = 16, 10
#: A source is cut into 2^bits hash ranges for its running token sums: enough that the
#: tokens of the corpus give each about this many, within these bits.
RANGE_TOKENS, RANGE_BITS = 4_000_000, (10, 24)
BLOCK_TOKENS = 1_000_000
TARGET_ENTROPY = 0.97      # of the highest possible, ln(number of sources)
MAX_REPEATS = 4.0


def _search(shares: DataFrame, fits, low_fits: bool) -> float:
    """Bisect the exponent in [0, 1]; ``fits(row, i)`` judges exponent i of a step.

    ``low_fits``: small exponents fit and the largest fitting is wanted; otherwise large
    ones fit and the smallest is wanted.
    """
    lo, hi = 0.0, 1.0
    for _ in range(STEPS):
        grid = [lo + (hi - lo) * i / GRID for i in range(GRID + 1)]
        cols = []
        for i, a in enumerate(grid):
            t = F.exp(F.lit(a) * F.col("lp"))
            cols += [F.sum(t).alias(f"z{i}"), F.sum(t * F.col("lp") * a).alias(f"e{i}"), F.max(t / F.col("p")).alias(f"r{i}")]
        row = shares.agg(*cols).first()
        good = [fits(row, i) for i in range(GRID + 1)]
        if low_fits:
            if good[-1]:
                return grid[-1]
            k = max((i for i in range(GRID + 1) if good[i]), default=0)
            lo, hi = grid[k], grid[min(k + 1, GRID)]
        else:
            if good[0]:
                return grid[0]
            k = min((i for i in range(GRID + 1) if good[i]), default=GRID)
            lo, hi = grid[max(k - 1, 0)], grid[k]
        if hi - lo < 1e-12:
            break
    return round(lo if low_fits else hi, 9)


def source_weights(tokens: DataFrame, budget: float, target_entropy: float | None = TARGET_ENTROPY,
                   max_repeats: float | None = MAX_REPEATS) -> DataFrame:
    """``tokens(source, n)`` -> ``(source, n, weight, exponent)`` for sources with tokens.

    The exponent is the largest whose entropy is at least ``target_entropy`` times the
    highest possible, raised, where a source would repeat more than ``max_repeats`` times
    within ``budget`` tokens, to the smallest at which none does (1 if none does at any).
    """
    full = tokens.where("n > 0")
    total, count = full.agg(F.sum("n"), F.count("*")).first()
    if not count:
        return full.select("source", "n", F.lit(0.0).alias("weight"), F.lit(1.0).alias("exponent"))
    shares = full.withColumn("p", F.col("n") / F.lit(float(total))).withColumn("lp", F.ln("p"))
    exponent = 1.0
    if target_entropy is not None:
        need = target_entropy * math.log(count)
        exponent = _search(shares, lambda r, i: math.log(r[f"z{i}"]) - r[f"e{i}"] / r[f"z{i}"] >= need - 1e-12, True)
    if max_repeats is not None:
        limit = max_repeats * total / budget     # weight * budget <= repeats * p * total
        exponent = max(exponent, _search(shares, lambda r, i: r[f"r{i}"] / r[f"z{i}"] <= limit + 1e-12, False))
    raised = shares.withColumn("w", F.exp(F.lit(exponent) * F.col("lp")))
    scale = raised.agg(F.sum("w")).first()[0]
    return raised.select("source", "n", F.round(F.col("w") / F.lit(scale), 12).alias("weight"), F.lit(exponent).alias("exponent"))


def _key(*cols):
    """Position of a row in a pass: a 60-bit hash, the same in any SQL engine with md5."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
            budget: float | None = None, block_tokens: int = BLOCK_TOKENS, target_entropy: float | None = TARGET_ENTROPY,
            max_repeats: float | None = MAX_REPEATS, row_col: str | None = None) -> DataFrame:
    """``(doc_id, source, n_tokens, pass, block, position, weight, repeats)``: a row per
    emission of a document in the mixed stream.  ``row_col`` names a column (unique per
    row) that is carried along and decides last between rows equal in all else.

    Tokens are runs of bytes other than ASCII white space.  ``budget`` defaults to the
    tokens of the corpus.  A source emits whole passes and then the part of one more whose
    running tokens start below its budget.  Rows without tokens (null or blank texts) are
    emitted once, in the pass they belong to, if its budget reaches them.  A null source is
    a source of its own.  Ties of the hash go to the smaller id; rows equal in id, source
    and tokens are emitted once each.  Blocks are numbered from 0; ``position`` counts from
    1 within a block.  An empty table gives no rows.
    """
    extra = [] if row_col is None else [row_col]
    words = F.regexp_count(F.col(text_col).cast("string"), F.lit(r"[^\x20\x09-\x0D]+"))
    rows = stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                              F.coalesce(words, F.lit(0)).cast("long").alias("n_tokens"), *extra), "sources")
    per_source = stored(rows.groupBy("source").agg(F.sum("n_tokens").alias("n")), "per-source")     # read by every step of the search
    total = per_source.agg(F.sum("n")).first()[0] or 0
    budget = float(total if budget is None else budget)
    bits = min(RANGE_BITS[1], max(RANGE_BITS[0], math.ceil(math.log2(max(1, total) / RANGE_TOKENS))))
    weights = stored(source_weights(per_source, budget or 1.0, target_entropy, max_repeats), "weights").withColumnRenamed("source", "s")

    target = F.col("weight") * F.lit(budget)
    due = rows.join(weights, rows.source.eqNullSafe(weights.s)).drop("s")
    due = due.withColumn("target", target).withColumn("passes", F.ceil(F.round(F.col("target") / F.col("n"), 9)).cast("int"))
    emitted = (due.where("passes > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)))
               .withColumn("key", _key("source", "doc_id", "pass")).withColumn("cut", F.shiftright("key", 60 - bits).cast("int")))
    part = ["source", "pass", "cut"]
    sums = emitted.groupBy(*part).agg(F.sum("n_tokens").alias("part_tokens"))
    sums = sums.withColumn("before", F.coalesce(F.sum("part_tokens").over(
        Window.partitionBy("source", "pass").orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    sums = sums.select(F.col("source").alias("s"), F.col("pass").alias("e"), F.col("cut").alias("c"), "before")
    placed = emitted.join(sums, emitted.source.eqNullSafe(sums.s) & (F.col("pass") == F.col("e")) & (F.col("cut") == F.col("c")))
    w = Window.partitionBy("source", "pass", "cut").orderBy("key", "doc_id", "n_tokens", *extra)
    own = F.sum("n_tokens").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n_tokens")
    placed = placed.withColumn("offset", F.col("pass") * F.col("n") + F.col("before") + own).where("offset < target")
    share = F.col("weight") * F.lit(float(block_tokens))
    placed = placed.withColumn("block", F.floor(F.col("offset") / share).cast("long"))
    placed = placed.withColumn("shuffle", _key("block", "key"))
    order = Window.partitionBy("block").orderBy("shuffle", "doc_id", "source", "pass", "n_tokens", *extra)
    return placed.select("doc_id", "source", "n_tokens", "pass", "block", F.row_number().over(order).cast("long").alias("position"),
                         "weight", F.round(F.col("target") / F.col("n"), 9).alias("repeats"), *extra)
