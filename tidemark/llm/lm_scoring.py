"""Language-model scoring by prediction by partial matching (PPM) over bytes.

The pretrained model is a trie of byte contexts, up to ``ORDER`` bytes, with the counts of
all training texts.  A byte is coded in the longest context the trie holds; where it is
unseen there, an escape (method C: distinct symbols over total plus distinct) leads to the
next shorter context, in which the symbols already refused are excluded.  Whatever follows
a context also follows its suffixes, so the symbols to exclude are exactly those of the
next longer node; what they hold of the shorter node's total is one number per node, and a
whole block of positions is coded with array operations.

The trie is never held in one place.  Contexts that share their two nearest bytes share
all longer nodes, so the distinct (context, byte) keys of the corpus are coded in groups of
those two bytes; the nodes above (at most 256 * 256 entries) go to every group.  A text's
score is the sum of its keys' codes.  Keys that make up at least ``1 / HOT_KEYS`` of the
training bytes (so at most ``HOT_KEYS`` keys) are broadcast with their codes; occurrences of
all others meet theirs in a join on the key.  No entry is ever forgotten.

Beside it stands the unigram word score of the contract.  Words that make up at least
``1 / HOT_SHARE`` of the training tokens (so at most ``HOT_SHARE`` words) are broadcast;
occurrences of all others meet their counts in the same join.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tokens as tk
from tidemark.llm.storage import stored

ORDER = 4
#: At most so many keys and words are broadcast (16 bytes each); all others are joined.
HOT_KEYS = 3_000_000
HOT_SHARE = 50_000
GROUP_BITS = 24            # a key's lower bytes: two context bytes above them name its group
END = 255                  # never a byte of UTF-8: ends a text
BLOCK = 3_000_000


def _keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per coded byte: nearest context byte first, ``ORDER`` of them, then the byte.

    Every text is followed by END and preceded by zero bytes.  Returns keys and each
    text's first position.
    """
    n = len(offsets) - 1
    pad = ORDER
    size = np.diff(offsets) + 1
    at = np.cumsum(size + pad) - size          # first coded byte in the padded buffer
    buf = np.zeros(int((size + pad).sum()), np.uint8)
    buf[tk.ranges(at, size - 1)] = tk.LOWER[data]
    buf[at + size - 1] = END
    pos = tk.ranges(at, size)
    key = np.zeros(len(pos), tk.U64)
    for back in range(1, ORDER + 1):
        key = (key << tk.U64(8)) | buf[pos - back]
    return (key << tk.U64(8)) | buf[pos], np.r_[0, np.cumsum(size)][:n + 1]


def _blocks(it):
    for batch in it:
        data, offsets = tk.text_buffer(batch.column(0))
        for lo, hi in tk.row_blocks(offsets, BLOCK):
            yield batch.slice(lo, hi - lo), data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]


def _word_keys(data, offsets):
    low = tk.LOWER[data]
    starts, ends, first = tk.words(low, offsets)
    return tk.word_hashes(low, starts, ends), first


def _gather(it):
    """Training counts of a block: (0, word hash, n) and (1, context and byte, n).  Texts
    held out give their contexts with n = 0, so that every key gets a code."""
    for batch in it:
        held = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        for learns, part in ((1, batch.filter(pa.array(~held))), (0, batch.filter(pa.array(held)))):
            for _, data, offsets in _blocks([part]):
                kinds = [(1, _keys(data, offsets)[0])]
                if learns:
                    kinds.append((0, _word_keys(data, offsets)[0]))
                for kind, keys in kinds:
                    k, n = np.unique(keys, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(k), kind, np.int8)), pa.array(tk.to_long(k)), pa.array(n * learns)],
                        names=["kind", "key", "n"])


class Trie:
    """Arrays per order: sorted contexts with totals, and sorted (context, byte) counts.

    ``low``: keys and counts that orders 0 and 1 are built from, where ``keys`` are only one
    group of the corpus's."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, low: tuple[np.ndarray, np.ndarray] | None = None):
        whole = keys, counts
        self.entry, self.count, self.context, self.total, self.kinds, self.held = {}, {}, {}, {}, {}, {}
        for o in range(ORDER + 1):
            keys, counts = low if low is not None and o < 2 else whole
            drop = tk.U64(8 * (ORDER - o))
            symbol = keys & tk.U64(255)
            short = (((keys >> tk.U64(8)) >> drop) << tk.U64(8)) | symbol
            e, back = np.unique(short, return_inverse=True)
            c = np.bincount(back, weights=counts, minlength=len(e)).astype(np.int64)
            self.entry[o], self.count[o] = e, c
            ctx, first = np.unique(e >> tk.U64(8), return_index=True)
            self.context[o] = ctx
            edge = np.r_[first, len(e)]
            self.total[o] = np.add.reduceat(c, first) if len(e) else c
            self.kinds[o] = np.diff(edge)
        for o in range(1, ORDER + 1):      # what a node's symbols hold in its suffix node
            e = self.entry[o]
            suffix = ((e >> tk.U64(16)) << tk.U64(8)) | (e & tk.U64(255))
            c = self.count[o - 1][np.searchsorted(self.entry[o - 1], suffix)] if len(e) else np.zeros(0, np.int64)
            first = np.searchsorted(e >> tk.U64(8), self.context[o])
            self.held[o] = np.add.reduceat(c, first) if len(e) else c

    @staticmethod
    def _find(have, keys):
        if not len(have):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        pos = np.minimum(np.searchsorted(have, keys), len(have) - 1)
        return pos, have[pos] == keys

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of each (context, byte) key; keys sorted for cheap lookups."""
        out = np.zeros(len(keys))
        open_ = np.ones(len(keys), bool)
        out_kinds, out_held = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)   # excluded here
        symbol = keys & tk.U64(255)
        for o in range(ORDER, -1, -1):
            row = np.flatnonzero(open_)
            if not len(row):
                break
            ctx = (keys[row] >> tk.U64(8)) >> tk.U64(8 * (ORDER - o))
            pos, there = self._find(self.context[o], ctx)
            row, ctx, pos = row[there], ctx[there], pos[there]
            total = self.total[o][pos] - out_held[row]
            kinds = self.kinds[o][pos] - out_kinds[row]
            at, seen = self._find(self.entry[o], (ctx << tk.U64(8)) | symbol[row])
            rest = (total + kinds).astype(float)
            hit = row[seen]
            out[hit] += np.log10(self.count[o][at[seen]] / rest[seen])
            open_[hit] = False
            miss = ~seen & (kinds > 0)      # nothing left to refuse: the escape is certain
            out[row[miss]] += np.log10(kinds[miss] / rest[miss])
            out_kinds[row[~seen]] = self.kinds[o][pos[~seen]]
            if o:
                out_held[row[~seen]] = self.held[o][pos[~seen]]
        out[open_] -= np.log10(np.maximum(256 - out_kinds[open_], 1))
        return out


def _code(low):
    """Codes of one group's keys, those with n = 0 included."""
    def run(table: pa.Table) -> pa.Table:
        keys = tk.from_long(table.column("key").to_numpy())
        n = table.column("n").to_numpy()
        trie = Trie(keys[n > 0], n[n > 0], low.value)
        return pa.table({"key": table.column("key"), "n": table.column("n"), "code": trie.log10(keys)})
    return run


def key_codes(keys: DataFrame) -> DataFrame:
    """``keys(key, n)``, one row per key -> ``(key, n, code)`` with the log10 probability of
    the key's byte after its context.  A group holds at most 256 ** 3 keys."""
    short = F.shiftleft(F.shiftright("key", 32), 32).bitwiseOR(F.col("key").bitwiseAND(F.lit(255)))
    low = keys.where("n > 0").groupBy(short.alias("key")).agg(F.sum("n").alias("n")).toArrow()   # at most 65,536 rows
    shared = keys.sparkSession.sparkContext.broadcast((tk.from_long(low.column("key").to_numpy()), low.column("n").to_numpy()))
    return (keys.withColumn("suffix", F.shiftright("key", GROUP_BITS)).groupBy("suffix")
            .applyInArrow(_code(shared), "key long, n long, code double"))


def _lookup(have: np.ndarray, values: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Value of each key (0 where absent) and whether it is there; ``have`` is sorted."""
    if not len(have):
        return np.zeros(len(keys)), np.zeros(len(keys), bool)
    pos = np.minimum(np.searchsorted(have, keys), len(have) - 1)
    there = have[pos] == keys
    return np.where(there, values[pos], 0.0), there


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    run = np.r_[0.0, np.cumsum(values)]
    return np.diff(run[first])


SCORED = ("kind byte, row_id long, key long, times long, doc_id long, held_out boolean, n_tokens long, n_known long, "
          "base double, score double")


def _occurrences(kind: int, row: np.ndarray, owner: np.ndarray, keys: np.ndarray, names: list[str]) -> pa.RecordBatch:
    """One row per document and distinct key, with the number of its occurrences."""
    order = np.lexsort((keys, owner))
    k, o = keys[order], owner[order]
    head = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (o[1:] != o[:-1])]) if len(k) else np.zeros(0, np.int64)
    m = len(head)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(m, kind, np.int8)), pa.array(row[o[head]]), pa.array(tk.to_long(k[head])),
         pa.array(np.diff(np.r_[head, len(k)])), pa.nulls(m, pa.int64()), pa.nulls(m, pa.bool_()), *[pa.nulls(m, pa.int64())] * 2,
         *[pa.nulls(m, pa.float64())] * 2], names=names)


def _score(shared):
    """Document rows (kind 2), and a row per distinct word (0) or key (1) of a document that
    is not broadcast."""
    names = [c.split()[0] for c in SCORED.split(", ")]

    def run(it):
        hot_key, hot_code, hot, hot_log, base, ends = shared.value
        for rows, data, offsets in _blocks(it):
            word, first = _word_keys(data, offsets)
            part, known = _lookup(hot, hot_log, word)
            n = rows.num_rows
            row = rows.column(1).to_numpy(zero_copy_only=False)
            spread = tk.to_long(tk.mix(row.astype(np.uint64)))      # deals document rows evenly
            keys, at = _keys(data, offsets)
            order = np.argsort(keys)
            k = keys[order]
            head = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
            times = np.diff(np.r_[head, len(k)])
            code, coded = _lookup(hot_key, hot_code, k[head])
            each = np.empty(len(k))
            each[order] = np.repeat(code, times)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, 2, np.int8)), pa.array(row), pa.array(spread), pa.array(np.zeros(n, np.int64)),
                 rows.column(2), rows.column(3), pa.array((np.diff(first) + 1).astype(np.int64)),
                 pa.array(np.diff(np.r_[0, np.cumsum(known)][first]) + (ends > 0)),
                 pa.array(_sums(part, first) + base), pa.array(_sums(each, at))], names=names)
            yield _occurrences(0, row, np.repeat(np.arange(n), np.diff(first))[~known], word[~known], names)
            rare = order[np.repeat(~coded, times)]
            yield _occurrences(1, row, np.searchsorted(at, rare, side="right") - 1, keys[rare], names)
    return run


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 1, F.lit(False))


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per row.

    Learns from the rows whose id's crc32 modulo 5 is not 1; a null id trains.  Null and
    empty texts have one token, the end.  Rows that repeat an id are scored on their own.
    Scores are log10 probabilities of the text with A-Z lower-cased and its end.  Without
    training rows all contexts are unseen: each byte counts 1 / 256, and base scores use
    N = 0 and V = 0.  Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    given = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.col(id_col).alias("doc_id"))
    given = given.withColumn("held_out", held_out())
    train = given.where("not held_out")
    counts = stored(given.select("text", "held_out").mapInArrow(_gather, "kind byte, key long, n long").groupBy("kind", "key")
                    .agg(F.sum("n").alias("n")), "counts")
    words = counts.where("kind = 0").select("key", "n")
    total = words.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    ends = train.count()
    big_n, vocab = (total["n"] or 0) + ends, total["v"] + (ends > 0)
    below = float(big_n + 0.5 * (vocab + 1))
    hot = words.where(F.col("n") * HOT_SHARE >= F.lit(big_n)).toArrow()      # at most HOT_SHARE rows
    key, n = tk.from_long(hot.column("key").to_numpy()), hot.column("n").to_numpy()
    order = np.argsort(key)
    codes = stored(key_codes(counts.where("kind = 1").select("key", "n")), "codes")
    coded = codes.agg(F.sum("n")).first()[0] or 0
    often = (F.col("n") > 0) & (F.col("n") * HOT_KEYS >= F.lit(coded))       # at most HOT_KEYS rows
    top = codes.where(often).select("key", "code").toArrow()
    top_key = tk.from_long(top.column("key").to_numpy())
    rank = np.argsort(top_key)
    shared = spark.sparkContext.broadcast(
        (top_key[rank], top.column("code").to_numpy()[rank], key[order], np.log10((n[order] + 0.5) / below),
         float(np.log10((ends + 0.5) / below)), ends))

    numbered = given.select("text", F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long"), "held_out")
    known_keys = (words.select(F.lit(0).cast("byte").alias("kind"), "key", "n", F.lit(0.0).alias("code"))
                  .union(codes.where(~often).select(F.lit(1).cast("byte"), "key", "n", "code")))
    rows = numbered.mapInArrow(_score(shared), SCORED).join(known_keys, ["kind", "key"], "left")
    word, context = F.col("kind") == 0, F.col("kind") == 1
    known = F.when(word, F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).otherwise(F.col("n_known"))
    base = F.when(word, F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + 0.5) / below)).otherwise(F.col("base"))
    score = F.when(context, F.col("times") * F.col("code")).otherwise(F.col("score"))
    return (rows.select("row_id", "doc_id", "held_out", "n_tokens", known.alias("n_known"), base.alias("base"), score.alias("score"))
            .groupBy("row_id").agg(F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"),
                                   F.max("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
                                   F.sum("base").alias("base_score"), F.sum("score").alias("score"))
            .select("doc_id", "held_out", "n_tokens", "n_known", F.lit(big_n).cast("long").alias("train_tokens"),
                    "base_score", "score"))
