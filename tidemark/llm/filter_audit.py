"""Filter interaction audit: what every order of five quality filters would remove.

Failure conditions of a document (words: maximal runs of bytes other than space and
``\\t\\n\\v\\f\\r``, case-sensitive; null text is empty):

* ``A``: fewer than 100 words; ``B``: 100 * distinct words < 80 * words;
* ``C``: 100 * ``[A-Z]`` characters > 10 * code points; ``D``: holds any of ``#$%&*|``;
* ``E``: identical to the text of a row with a smaller id.

``E`` is an existential self-join: a left-semi join on hash, exact text and smaller id,
whose right side holds the smallest id of each text, so copies meet one row and not each
other.  Only texts whose hash has several ids travel to it.  The ids it marks are united
with the other failures, and one aggregate counts each combination of failure bits per
part.  Every order, step and Shapley sum then follows from at most 32 counts a part.
"""

from __future__ import annotations

import itertools
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import stored

LETTERS = "ABCDE"
BIT = {letter: 1 << i for i, letter in enumerate(LETTERS)}
MIN_WORDS, MIN_DISTINCT, MAX_UPPER = 100, 80, 10
#: Bytes of a text whose words are split at once; longer ones go piece by piece.
PIECE = 4_000_000

WHITE = re.compile(rb"[ \t-\r]")
UPPER = bytes(range(65, 91))
SYMBOLS = b"#$%&*|"
CONTINUATION = bytes(range(0x80, 0xC0))     # UTF-8 bytes that start no code point


def _pieces(raw: bytes):
    """``raw`` in pieces that cut no word."""
    lo = 0
    while len(raw) - lo > PIECE:
        cut = WHITE.search(raw, lo + PIECE)
        if cut is None:
            break
        yield raw[lo:cut.start()]
        lo = cut.start()
    yield raw[lo:] if lo else raw


def failure_bits(raw: bytes) -> int:
    """Bits of the conditions A to D that one text (UTF-8) meets."""
    count, seen = 0, set()
    for piece in _pieces(raw):
        words = piece.split()
        count += len(words)
        seen.update(words)
    upper = len(raw) - len(raw.translate(None, UPPER))
    points = len(raw.translate(None, CONTINUATION))
    return (BIT["A"] * (count < MIN_WORDS) | BIT["B"] * (100 * len(seen) < MIN_DISTINCT * count)
            | BIT["C"] * (100 * upper > MAX_UPPER * points) | BIT["D"] * (len(raw.translate(None, SYMBOLS)) < len(raw)))


def _judge(it):
    """The text (last column) of every row replaced by its failure bits."""
    for batch in it:
        texts = batch.columns[-1].cast(pa.large_binary())
        bits = [failure_bits(x.as_py()) for x in texts]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(bits, pa.int32())],
                                         names=[*batch.schema.names[:-1], "bits"])


def _given(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.md5(text.cast("binary"))).alias("hash"), text.alias("text"))


def earlier_copies(given: DataFrame, narrow: DataFrame) -> DataFrame:
    """``(doc_id, part, hash)`` of the rows whose whole text a smaller id has too.

    ``narrow`` holds the ids and hashes without texts: it tells which hashes have several
    ids, and only their texts are moved.  A hash shared by a third of all rows is split by
    the adaptive skew join, as the other side has one row of it.
    """
    ids = narrow.where("doc_id is not null").groupBy("hash").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    shared = ids.where("high > low").select("hash", "low")
    same_hash = stored(given.where("doc_id is not null").join(shared, "hash"), "same-hash")
    later = same_hash.where("doc_id > low").select("doc_id", "part", "hash", "text")
    first = same_hash.groupBy("hash", "text").agg(F.min("doc_id").alias("first_id"))
    first = first.withColumnsRenamed({"hash": "h", "text": "x"})
    same = (later["hash"] == first.h) & (later["text"] == first.x) & (first.first_id < later["doc_id"])
    return later.join(first, same, "left_semi").select("doc_id", "part", "hash")


def failure_combinations(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         part_col: str = "lang") -> DataFrame:
    """``(part, bits, n, good, toxic)``: documents per combination of failure bits, and how
    many of them ``labels`` marks with quality = 1 and toxic = 1.

    A null part is the empty string.  A null id has no smaller id and is no smaller id, and
    carries no label.  Rows that repeat an id count each; with the same text, neither is a
    copy of the other.  Of several labels of an id any one that is 1 counts.
    """
    given = _given(docs, id_col, text_col, part_col)
    narrow = stored(given.mapInArrow(_judge, "doc_id long, part string, hash binary, bits int"), "failures")
    others = narrow.select("doc_id", "part", "hash", "bits", F.lit(1).cast("long").alias("n"))
    copies = earlier_copies(given, narrow).select("doc_id", "part", "hash", F.lit(BIT["E"]).alias("bits"),
                                                  F.lit(0).cast("long").alias("n"))
    # rows of one id, part and text have equal bits, so they may share a row here
    rows = others.union(copies).groupBy("doc_id", "part", "hash").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("is_good"), F.max((F.col("toxic") == 1).cast("int")).alias("is_toxic"))
    one = lambda c: F.sum(F.when(F.col(c) == 1, F.col("n")).otherwise(0)).alias(c[3:])
    return rows.join(marks, "doc_id", "left").groupBy("part", "bits").agg(F.sum("n").alias("n"), one("is_good"), one("is_toxic"))


def _steps():
    """What each combination of failures means to each step of each order: 19,200 rows."""
    for order in itertools.permutations(LETTERS):
        earlier = 0
        for step, letter in enumerate(order, 1):
            own = BIT[letter]
            for bits in range(1 << len(LETTERS)):
                fails, gone = bool(bits & own), bool(bits & earlier)
                yield (bits, "".join(order), step, int(not (fails or gone)), int(fails and not gone), int(fails and gone),
                       int(bits == own), 120 // bits.bit_count() if fails else 0)
            earlier |= own


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "lang") -> DataFrame:
    """One row per part, order of the five filters and step: ``part, filter_order, step``
    and the document counts ``kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley``.

    ``kept`` pass this step and all before; ``removed`` go here; ``redundant`` fail this
    filter but went before; ``unique_fails`` fail this filter only; ``good_lost`` and
    ``toxic_lost`` are the labelled among the removed; ``shapley`` adds the filter's
    removals over all orders (each document that fails m filters gives 120 / m to each).
    Steps with zero counts are rows too; an empty table gives none.
    """
    combos = failure_combinations(docs, labels, id_col, text_col, part_col)
    spec = docs.sparkSession.createDataFrame(
        list(_steps()), "bits int, filter_order string, step int, keeps long, removes long, repeats long, only long, share long")
    each = combos.join(F.broadcast(spec), "bits")       # a fixed table of 19,200 rows
    total = lambda *c: F.sum(F.expr(" * ".join(c)))     # noqa: E731
    return each.groupBy("part", "filter_order", "step").agg(
        total("n", "keeps").alias("kept"), total("n", "removes").alias("removed"), total("n", "repeats").alias("redundant"),
        total("n", "only").alias("unique_fails"), total("good", "removes").alias("good_lost"),
        total("toxic", "removes").alias("toxic_lost"), total("n", "share").alias("shapley"))


#: The same audit in DuckDB SQL; a document's failures are a string of letters.
SQL = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS x FROM documents),
w AS (SELECT doc_id, part, x, list_filter(regexp_split_to_array(x, '[ \t\n\v\f\r]+'), lambda s: s <> '') AS ws,
             min(doc_id) OVER (PARTITION BY x) AS first_id FROM t),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             CASE WHEN len(ws) < 100 THEN 'A' ELSE '' END
             || CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' ELSE '' END
             || CASE WHEN 100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 10 * length(x) THEN 'C' ELSE '' END
             || CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 'D' ELSE '' END
             || CASE WHEN first_id < doc_id THEN 'E' ELSE '' END AS fails
      FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
v AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS s),
o AS (SELECT a.s || b.s || c.s || d.s || e.s AS filter_order FROM v a, v b, v c, v d, v e
      WHERE len(list_distinct([a.s, b.s, c.s, d.s, e.s])) = 5),
p AS (SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS earlier
      FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
j AS (SELECT part, filter_order, step, n, good, toxic, fails, own, contains(fails, own) AS hit,
             length(translate(fails, earlier, '')) < length(fails) AS gone FROM c, p)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
  CAST(sum(CASE WHEN NOT hit AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS kept,
  CAST(sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed,
  CAST(sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant,
  CAST(sum(CASE WHEN fails = own THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
  CAST(sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END) AS BIGINT) AS good_lost,
  CAST(sum(CASE WHEN hit AND NOT gone THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost,
  CAST(sum(CASE WHEN hit THEN n * (120 // length(fails)) ELSE 0 END) AS BIGINT) AS shapley
FROM j GROUP BY part, filter_order, step
"""
