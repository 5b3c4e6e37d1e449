"""Near-duplicate lines by an exact set-similarity join, in DataFrame operations only.

A line is its set of distinct words (lower-cased), as 58-bit hashes under a rarity level, rare
words first.  Its keys are runs of neighbouring words (grams) of two to four words: the rarer
the first word, the shorter, so that few lines share one by chance however many there are.

Say two sets share the words ``S``, one has ``a`` words more and the other ``b``, and a gram of
``l`` words weighs ``1 / l``.  A gram of ``S`` is one of both sets unless another word falls
between its words.  In a set's own list of grams (their lengths grow along it) its ``a`` words
take away a weight of at most ``a`` and the ``b`` words at most ``b * (1 - 1 / l)``, with ``l`` the
longest.  At a Jaccard similarity of ``t`` that is ``(1 - t) * n`` at most in all, as long as
``1 - 1 / l <= t``.  So each set needs only its first grams, up to a weight above ``(1 - t) * n``:
the first gram that is left belongs to both.  Only those are shuffled.  A set whose grams do not
weigh enough has all of them and, to meet its like, all pairs of neighbours up to that weight;
if these do not either, also the words of its prefix.  What one set alone has is dropped at once.

Every set carries a 64-bit parity sketch, whose distance never exceeds the symmetric difference.
Sets meet on a gram only when length and sketch allow a match, so what they share by chance
makes few rows.  Those that meet are compared by a 128-bit sketch and then in full.
A line that matches an earlier one, in the order of (doc_id, line number), goes.

Lines meet in three rounds.  In the first, a set meets only the earliest set of each of its
grams, in the pass that orders the sets of a gram; what that settles needs no other match.  In
the second, the sets still open meet one in ``PART`` of the earlier ones, which settles nearly
all of a group whose members match each other but not the first.  In the third, those still
open meet every other earlier set.

Rarity is the log2 of a word's count over hash buckets; every bucket's count covers all
lines.  It fixes one order for all, and lengths of grams by their first words, which is all
that exactness needs.
"""

from __future__ import annotations

import math
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.storage import stored
from tidemark.session import bounded_broadcast

THRESHOLD = 80             # percent
#: Least and most log2 of the rarity buckets, about so many words each; bytes of a word.
RARITY_BITS, BUCKET_WORDS, WORD_BYTES = (16, 20), 400, 7
HASH_BITS = 58
#: Bits of a gram's key; sets that meet by a chance of keys are told apart like others.
KEY_BITS = 40
#: Words of the longest gram, and the bits by which a gram's words are to be rarer than one in all lines.
LONGEST, SPARE_BITS = 4, 2
#: Documents broadcast (an id and line numbers each) to pick the texts to verify; beyond, a shuffle join does.
BROADCAST_IDS = 1_000_000
#: The second round meets one in so many earlier sets, the third the rest.
PART = 16
ODD_SPACE = "\t\r\x0b\x0c"
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_dropped(spark: SparkSession):
    """Shuffle files of a table that is being stored go once it is stored."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def _plain(text):
    """Lower-cased text whose words are parted by spaces and line feeds only."""
    return F.lower(F.when(text.rlike(r"[\t\r\x0B\f]"), F.translate(text, ODD_SPACE, "    ")).otherwise(text))


def rarity_levels(docs: DataFrame):
    """Array column: per hash bucket the log2 of its words' count in all lines; and the log2
    of the number of lines.  The buckets are a power of two of them, by the bytes of text."""
    words = (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / WORD_BYTES
    buckets = 1 << max(RARITY_BITS[0], min(RARITY_BITS[1], round(math.log2(1 + words / BUCKET_WORDS))))
    # a feed after each text, too: as many feeds as lines
    text = F.replace(_plain(F.concat(F.col("text"), F.lit("\n"))), F.lit("\n"), F.lit(" \n "))
    bucket = F.when(F.col("w") == "\n", -1).otherwise(F.pmod(F.xxhash64("w"), F.lit(buckets)).cast("int"))
    counts = docs.select(F.explode(F.split(text, " ")).alias("w")).where("w <> ''").groupBy(bucket.alias("b")).agg(F.count("*").alias("n"))
    row = counts.agg(F.collect_list(F.when(F.col("b") >= 0, F.col("b") * 32 + F.least(F.lit(31), F.floor(F.log2("n"))).cast("int"))).alias("m"),
                     F.max(F.when(F.col("b") < 0, F.col("n"))).alias("lines")).first()     # bounded by the buckets
    levels = ["0"] * buckets
    for x in row["m"]:
        levels[x >> 5] = str(x & 31)
    return F.split(F.lit(",".join(levels)), ",").cast("array<bigint>"), buckets, math.log2(max(2, row["lines"] or 0))


def _tokens(line, rarity):
    """Sorted distinct tokens of a plain line: rarity level above a word hash."""
    levels, buckets = rarity[:2]

    def token(h):
        level = F.coalesce(F.get(levels, h.bitwiseAND(F.lit(buckets - 1)).cast("int")), F.lit(0).cast("long"))
        return F.shiftleft(level, HASH_BITS).bitwiseOR(h.bitwiseAND(F.lit((1 << HASH_BITS) - 1)))
    hashes = F.transform(F.split(line, " "), lambda w: F.xxhash64(w))
    words = F.array_remove(F.array_distinct(hashes), F.xxhash64(F.lit("")))
    return F.array_distinct(F.sort_array(F.transform(words, token)))


def _sketch(tokens, half: int | None = None):
    """64 parity bits of the tokens, or of those whose bit 6 is ``half``."""
    def step(acc, t):
        bit = acc.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), t.bitwiseAND(F.lit(63)).cast("int")))
        return bit if half is None else F.when(F.shiftright(t, 6).bitwiseAND(F.lit(1)) == half, bit).otherwise(acc)
    return F.aggregate(tokens, F.lit(0).cast("long"), step)


def _need(n, threshold: int):
    return F.ceil(n * threshold / 100.0)


def _gram_levels(bits: float, threshold: int) -> list[int]:
    """Per length from 2 on, but for the longest, the rarity levels below which a gram has it."""
    longest = max(2, min(LONGEST, 100 // (100 - threshold) if threshold < 100 else LONGEST))
    return [min(31, max(0, math.floor(bits - (bits + SPARE_BITS) / k - (k - 1) / 2) + 1)) for k in range(2, longest)]


def _grams(lines: DataFrame, bits: float, threshold: int) -> DataFrame:
    """``(key, value, more, sketch)`` of ``(doc_id, line_no, tokens)``: per line its set id, the
    document, the line number above the size, and the sketch; and each of its grams, its set id, minus its place, and 0."""
    levels, n = _gram_levels(bits, threshold), F.col("n")
    weights = [12 // k for k in range(2, len(levels) + 3)]              # in twelfths
    zero, whole = F.lit(0).cast("int"), F.floor(n * 12 * (100 - threshold) / 100.0).cast("int") + 1
    # place from which on grams have the next length; the last length goes to the end
    marks = [F.lit(at << HASH_BITS).cast("long") for at in levels]
    ends = [(F.array_position("marked", m) - 1 - levels.index(at)).cast("int") for m, at in zip(marks, levels)]
    sized = (lines.select("*", F.xxhash64("tokens").alias("set_id"), F.size("tokens").alias("n"), F.sort_array(F.concat("tokens", F.array(*marks))).alias("marked"))
             .select("*", *[e.alias(f"end{i}") for i, e in enumerate(ends)]).drop("marked")
             .select("*", _sketch(F.col("tokens")).alias("sketch"), whole.alias("left"), zero.alias("grams")))
    begin = zero
    for i, w in enumerate(weights):
        end = F.col(f"end{i}") if i < len(levels) else n
        there = F.greatest(zero, F.least(end, n - i - 1) - begin)
        taken = F.least(there, F.greatest(zero, F.ceil(F.col("left") / w).cast("int")))
        sized = sized.withColumn("taken", taken).withColumn("grams", F.col("grams") + F.col("taken")).withColumn("left", F.col("left") - F.col("taken") * w)
        begin = end
    weak = F.col("left") > 0
    twos, wanted = F.least(n - 1, F.floor(n * 2 * (100 - threshold) / 100.0).cast("int") + 1), F.floor(n * 2 * (100 - threshold) / 100.0) + 1
    short = F.col("end0") if levels else n
    sized = (sized.withColumn("skip", F.least(short, F.greatest(zero, n - 1)))
             .withColumn("pairs", F.when(weak, F.greatest(zero, twos - F.col("skip"))).otherwise(zero))
             .withColumn("singles", F.when(weak & (twos < wanted), n - _need(n, threshold).cast("int") + 1).otherwise(zero))
             .select("doc_id", "tokens", "set_id", "sketch", *[f"end{i}" for i in range(len(levels))], "grams", "skip", "pairs", "singles",
                     F.shiftleft(F.col("line_no").cast("long"), 32).bitwiseOR(n.cast("long")).alias("more"), "n"))
    # no column of its own: a filter on it would be pushed below the tokens and take them twice
    places = F.when(n > 0, F.sequence(zero, F.col("grams") + F.col("pairs") + F.col("singles")))
    rows = sized.select("*", F.explode(places).alias("i")).drop("n")
    line, at = F.col("i") == 0, F.col("i") - 1
    pair_at, single_at = at - F.col("grams") + F.col("skip"), at - F.col("grams") - F.col("pairs")

    def gram(place, length: int):
        return F.xxhash64(*[F.get("tokens", place + k) for k in range(length)]).bitwiseAND(F.lit((1 << KEY_BITS) - 1))
    key = F.when(line, F.col("set_id"))
    for k in range(len(levels)):
        key = key.when((at < F.col("grams")) & (at < F.col(f"end{k}")), gram(at, k + 2))
    key = (key.when(at < F.col("grams"), gram(at, len(levels) + 2)).when(at < F.col("grams") + F.col("pairs"), gram(pair_at, 2))
           .otherwise(gram(single_at, 1)))
    return rows.select(key.alias("key"), F.when(line, F.col("doc_id")).otherwise(F.col("set_id")).alias("value"), F.when(line, F.col("more")).otherwise(-F.col("i")).alias("more"),
                       F.when(line, F.col("sketch")).otherwise(0).alias("sketch"))


def _lines(docs: DataFrame, *more) -> DataFrame:
    return docs.select("doc_id", *more, F.posexplode(F.split(_plain(F.col("text")), "\n", -1)).alias("line_no", "line"))


def _may_match(a: str, b: str, threshold: int):
    """Whether the lengths and the sketches of two sets allow a match."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    apart = F.bit_count(F.col(f"{a}.sketch").bitwiseXOR(F.col(f"{b}.sketch")))
    return (F.least(n, m) * 100 >= F.greatest(n, m) * threshold) & (apart * (100 + threshold) <= (n + m) * (100 - threshold))


def _met():
    """Columns of a pair of sets, ``x`` before ``y``, of rows ``a`` and ``b``."""
    return [F.col(f"{side}.{c}").alias(name) for c, more in (("set_id", ""), ("first", "_first")) for side, name in (("a", "x" + more), ("b", "y" + more))]


def _pairs(a: DataFrame, b: DataFrame, threshold: int) -> DataFrame:
    """Pairs of a set of ``a`` and a later one of ``b`` that share a gram and may match.  Where they
    share the gram before it, too, they meet there."""
    return (a.alias("a").join(b.alias("b"), (F.col("a.gram") == F.col("b.gram")) & (F.col("a.first") < F.col("b.first"))
                              & F.coalesce(F.col("a.before") != F.col("b.before"), F.lit(True))
                              & _may_match("a", "b", threshold)).select(*_met()).distinct())


def _verified(pairs: DataFrame, given: DataFrame, rarity, threshold: int) -> DataFrame:
    """``(set_id, near)``: every set that is similar to an earlier one of its pairs, and the
    earliest such line."""
    need = stored(pairs.select(F.col("x").alias("set_id"), F.col("x_first").alias("at"))
                  .union(pairs.select("y", "y_first")).distinct(), "need")
    places = need.groupBy("at.doc_id").agg(F.collect_set("at.line_no").alias("wanted"))
    lines = _lines(given.join(bounded_broadcast(places, BROADCAST_IDS), "doc_id"), "wanted").where("array_contains(wanted, line_no)")
    again = lines.select("doc_id", "line_no", _tokens(F.col("line"), rarity).alias("tokens")).withColumn("set_id", F.xxhash64("tokens"))
    wanted = need.select("set_id", "at.doc_id", "at.line_no")
    sets = stored(again.join(wanted, ["set_id", "doc_id", "line_no"], "left_semi").dropDuplicates(["set_id"])
                  .select("set_id", F.size("tokens").alias("n"), _sketch(F.col("tokens"), 0).alias("s0"),
                          _sketch(F.col("tokens"), 1).alias("s1"), "tokens"), "sets")

    def side(name, *cols):
        return sets.select(F.col("set_id").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in cols])
    total = F.col("x_n") + F.col("y_n")
    apart = F.bit_count(F.col("x_s0").bitwiseXOR(F.col("y_s0"))) + F.bit_count(F.col("x_s1").bitwiseXOR(F.col("y_s1")))
    alike = stored(pairs.join(side("x", "n", "s0", "s1"), "x").join(side("y", "n", "s0", "s1"), "y")
                   .where(apart * (100 + threshold) <= total * (100 - threshold)).select("x", "y", "x_first"), "alike")
    both = F.size(F.array_intersect("x_tokens", "y_tokens"))
    near = (alike.join(side("x", "tokens"), "x").join(side("y", "tokens"), "y")
            .where(both * 100 >= threshold * (F.size("x_tokens") + F.size("y_tokens") - both))
            .groupBy(F.col("y").alias("set_id")).agg(F.min("x_first").alias("near")))
    return stored(near, "near")


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """``(doc_id, line_no, match_id, match_line)`` of every line to remove, with an earlier
    line it matches.  Lines without words match nothing; null texts have no lines.
    Matches are judged on the input, not on what is left."""
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    given = given.where("doc_id is not null and text is not null")
    rarity = rarity_levels(given)
    with _shuffles_dropped(docs.sparkSession):
        lines = _lines(given).select("doc_id", "line_no", _tokens(F.col("line"), rarity).alias("tokens"))
        keys, same = _grams(lines, rarity[2], threshold), Window.partitionBy("key")
        table = stored(keys.select("*", F.min("value").over(same).alias("low"), F.max("value").over(same).alias("high"))
                       .where("more >= 0 or low < high").drop("low", "high"), "grams")
        at = F.struct("doc_id", "line_no")
        rows = table.where("more >= 0").select(F.col("key").alias("set_id"), F.col("value").alias("doc_id"), F.shiftright("more", 32).cast("int").alias("line_no"),
                                               F.col("more").bitwiseAND(F.lit((1 << 31) - 1)).cast("int").alias("n"), "sketch")
        first = stored(rows.groupBy("set_id").agg(F.min(at).alias("first"), F.max("n").alias("n"), F.max("sketch").alias("sketch")), "first")
        members = (table.where("more < 0").select(F.col("key").alias("gram"), F.col("value").alias("set_id"), F.col("more").alias("at")).distinct().join(first, "set_id")
                   .select("*", F.lag("gram").over(Window.partitionBy("set_id").orderBy(F.desc("at"))).alias("before")))
        order = Window.partitionBy("gram").orderBy("b.first")
        whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        places = (members.select("gram", F.struct("set_id", "first", "n", "sketch", "before").alias("b"))
                  .select("*", F.row_number().over(order).alias("place"), F.first("b").over(whole).alias("a"), F.count("*").over(whole).alias("many")))
        met = (F.col("a.set_id") != F.col("b.set_id")) & _may_match("a", "b", threshold)
        table = stored(places.select("gram", F.when(met, F.col("a")).alias("a"), "b", "place", "many").where("a is not null or many > 2"), "members")
        near = _verified(stored(table.where("a is not null").select(*_met()).distinct(), "pairs"), given, rarity, threshold)
        # a gram's first set has met all others, its second one has met the first
        later = table.where("many > 2 and place > 1").select("gram", "place", "b.*")
        some = F.pmod("set_id", F.lit(PART)) == 0
        for earlier in (later.where(some), later.where(~some)):
            open_sets = later.where("place > 2").join(near.select("set_id"), "set_id", "left_anti")
            near = near.union(_verified(stored(_pairs(earlier, open_sets, threshold), "pairs"), given, rarity, threshold))
    best = first.join(near, "set_id", "left").select("set_id", F.least("first", "near").alias("match"))
    return (rows.select("set_id", "doc_id", "line_no").join(best, "set_id").where(F.col("match") < at)
            .select("doc_id", "line_no", F.col("match.doc_id").alias("match_id"), F.col("match.line_no").alias("match_line")))


def remove_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """``(doc_id, n_lines, n_removed, kept_text, kept_sha256)``, one row per input row.

    Lines end at line feeds; a line goes when it is, or nearly is, an earlier one.  Lines
    without words stay.  Null texts have no lines and an empty kept text.  Rows that repeat
    an id are cut at the same places; rows with a null id stay whole.  Other columns are
    ignored; an empty table gives no rows.
    """
    lost = (duplicate_lines(docs, id_col, text_col, threshold).groupBy("doc_id")
            .agg(F.collect_set("line_no").alias("lost")))
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    lines = F.coalesce(F.split("text", "\n", -1), F.array())
    gone = F.coalesce("lost", F.array().cast("array<int>"))
    kept = F.filter("lines", lambda l, i: ~F.array_contains(F.col("gone"), i))
    return (given.join(lost, "doc_id", "left").select("doc_id", lines.alias("lines"), gone.alias("gone"))
            .select("doc_id", F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_removed"),
                    F.array_join(kept, "\n").alias("kept_text"))
            .withColumn("kept_sha256", F.sha2(F.col("kept_text").cast("binary"), 256)))
