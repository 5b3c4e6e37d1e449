"""Language identification, words first.

A word known from training scores by its log frequency per language.  An unseen word
backs off to its longest known character n-grams, five letters down to one; their mean
log frequency counts as one word.  A text sums over its words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import tokens as tk
from tidemark.session import checked_collect

LONGEST = 5
#: The model is fitted on at most about this many different texts per language, dealt by a hash.
TRAIN_DOCS = 3000
#: Evidence beyond this many words no longer sharpens the score.
SURE_WORDS = 30
MIN_SCORE = 0.5
UNKNOWN = "und"
ALPHA = 0.5

# words here are runs of letters: ASCII letters and everything beyond ASCII
BREAK = np.ones(256, dtype=bool)
BREAK[65:91] = BREAK[97:123] = False
BREAK[128:] = False


def _letter_words(data: np.ndarray, offsets: np.ndarray):
    """Lower-cased bytes with every non-letter blanked, and the words in them."""
    data = np.where(BREAK[data], 32, tk.LOWER[data]).astype(np.uint8)
    return data, *tk.words(data, offsets)


def _grams(words: list[str], n: int):
    """Hashes of all n-grams of ``^word$`` end to end, and the owner of each."""
    cps = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le"), np.uint32).astype(tk.U64)
    lens = np.array([len(w) + 2 for w in words], np.int64)
    count = np.maximum(lens - n + 1, 0)
    at = tk.ranges(np.cumsum(lens) - lens, count)
    return tk.window_hashes(tk.mix(cps), n)[at] if len(at) else np.zeros(0, tk.U64), np.repeat(np.arange(len(words)), count)


def _texts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    raw = data.tobytes()
    return [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts, ends)]


def _train(it):
    """Counts (kind, hash, language): kind 0 words, 1 to 5 n-grams."""
    for batch in it:
        langs = np.array(batch.column(1).to_pylist(), dtype=object)
        data, offsets = tk.text_buffer(batch.column(0))
        for lo, hi in tk.row_blocks(offsets):
            for lang in sorted(set(langs[lo:hi])):
                own = np.flatnonzero(langs[lo:hi] == lang) + lo
                part = data[tk.ranges(offsets[own], offsets[own + 1] - offsets[own])]
                part, starts, ends, _ = _letter_words(part, np.r_[0, np.cumsum(offsets[own + 1] - offsets[own])])
                if not len(starts):
                    continue
                key, index, count = np.unique(tk.word_hashes(part, starts, ends), return_index=True, return_counts=True)
                rows = [(0, key, count)]
                words = _texts(part, starts[index], ends[index])
                for n in range(1, LONGEST + 1):
                    gram, owner = _grams(words, n)
                    g, back = np.unique(gram, return_inverse=True)
                    rows.append((n, g, np.bincount(back, weights=count[owner], minlength=len(g)).astype(np.int64)))
                for kind, k, c in rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(k), kind, np.int32)), pa.array(tk.to_long(k)),
                         pa.array([lang] * len(k), pa.string()), pa.array(c)], names=["kind", "key", "lang", "n"])


class Model:
    """Per kind: sorted keys and the log frequency of each in every language."""

    def __init__(self, langs: list[str], tables: dict[int, tuple[np.ndarray, np.ndarray]]):
        self.langs, self.tables = langs, tables

    def look(self, kind: int, keys: np.ndarray):
        have, logs = self.tables[kind]
        if not len(have):
            return np.zeros(len(keys), bool), np.zeros((len(keys), len(self.langs)), np.float32)
        pos = np.minimum(np.searchsorted(have, keys), len(have) - 1)
        return have[pos] == keys, logs[pos]

    def word_scores(self, keys: np.ndarray, spell) -> np.ndarray:
        """Log frequency of distinct words; ``spell(rows)`` gives the letters of unseen ones."""
        known, score = self.look(0, keys)
        score = np.where(known[:, None], score, 0).astype(np.float64)
        open_ = np.flatnonzero(~known)
        words = spell(open_) if len(open_) else []
        for n in range(LONGEST, 0, -1):
            if not len(open_):
                break
            gram, owner = _grams(words, n)
            hit, logs = self.look(n, gram)
            found = np.bincount(owner[hit], minlength=len(words))
            for i in range(len(self.langs)):
                total = np.bincount(owner[hit], weights=logs[hit, i], minlength=len(words))
                score[open_, i] = np.where(found > 0, total / np.maximum(found, 1), score[open_, i])
            left = np.flatnonzero(found == 0)
            open_, words = open_[left], [words[i] for i in left]
        return score


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", train_docs: int = TRAIN_DOCS) -> Model:
    """Fit on the different texts of each language in ``docs``: all of them up to
    ``train_docs``, else a hash-dealt share of about as many.  Copies count once.  Words and
    n-grams found once in the whole sample are not kept.  Rows with a null text or language
    are left out; no rows give a model without languages."""
    given = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    given = given.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    different = given.select("lang", F.xxhash64("text").alias("hash")).distinct()
    counts = {r["lang"]: r["count"] for r in checked_collect(different.groupBy("lang").count(), 10_000, "languages")}
    langs = sorted(counts)
    if not langs:
        return Model([], {})
    share = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, train_docs / counts[lang]))])
    some = given.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000).distinct()
    rows = (some.mapInArrow(tk.tidy(_train), "kind int, key long, lang string, n long").groupBy("kind", "key", "lang")
            .agg(F.sum("n").alias("n")))
    rows = rows.join(rows.groupBy("kind", "key").agg(F.sum("n").alias("all")).where("all > 1"), ["kind", "key"]).toArrow()
    kind, key = rows.column("kind").to_numpy(), tk.from_long(rows.column("key").to_numpy())
    lang, n = np.searchsorted(np.array(langs), np.array(rows.column("lang").to_pylist(), dtype=str)), rows.column("n").to_numpy()
    tables = {}
    for k in range(LONGEST + 1):
        own = kind == k
        keys, back = np.unique(key[own], return_inverse=True)
        table = np.zeros((len(keys), len(langs)))
        np.add.at(table, (back, lang[own]), n[own])
        total = table.sum(0) + ALPHA * (len(keys) + 1)
        tables[k] = keys, np.log((table + ALPHA) / total).astype(np.float32)
    return Model(langs, tables)


def _predict(shared):
    def run(it):
        model = shared.value
        for batch in it:
            data, offsets = tk.text_buffer(batch.column(0))
            for lo, hi in tk.row_blocks(offsets):
                own = batch.slice(lo, hi - lo)
                lang, score = block(model, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                yield pa.RecordBatch.from_arrays([*own.columns[1:], pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                                 names=[*own.schema.names[1:], "lang_pred", "score"])

    def block(model, data, offsets):
        n = len(offsets) - 1
        lang, score = [UNKNOWN] * n, np.zeros(n)
        part, starts, ends, first = _letter_words(data, offsets)
        count = np.diff(first)
        if not model.langs or not len(starts):
            return lang, score
        ascii_ = np.r_[0, np.cumsum(~BREAK[data] & (data < 128))][offsets]
        keys, index, back = np.unique(tk.word_hashes(part, starts, ends), return_index=True, return_inverse=True)
        words = model.word_scores(keys, lambda rows: _texts(part, starts[index[rows]], ends[index[rows]]))
        run = np.zeros((len(starts) + 1, len(model.langs)))
        np.cumsum(words[back], axis=0, out=run[1:])
        mean = (run[first[1:]] - run[first[:-1]]) / np.maximum(count, 1)[:, None]
        sure = np.exp((mean - mean.max(1, keepdims=True)) * np.minimum(count, SURE_WORDS)[:, None])
        sure /= sure.sum(1, keepdims=True)
        best = sure.argmax(1)
        raw = data.tobytes()
        for i in range(n):
            letter = ascii_[i + 1] > ascii_[i]
            if not letter and count[i]:
                letter = any(c.isalpha() for c in raw[offsets[i]:offsets[i + 1]].decode("utf-8", "replace"))
            if letter:
                lang[i], score[i] = model.langs[best[i]], sure[i, best[i]]
        return lang, score
    return run


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1).

    Only the text decides.  Null texts and texts without a letter are ``und`` with score 0,
    and so is every text when nothing was learned; ties go to the first language in
    alphabetical order.  Existing columns of these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rest = docs.drop("lang_pred", "score")
    given = rest.select(F.col(f"`{text_col}`").cast("string").alias("_input_text"), *[F.col(f"`{c}`") for c in rest.columns])
    schema = T.StructType([*rest.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return given.mapInArrow(tk.tidy(_predict(shared)), schema)


def held_out(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Adds ``held_out``: crc32 of the id's text modulo 4 is 2 (a null id is not)."""
    return docs.withColumn("held_out", F.coalesce(
        F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False)))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every row, learning from the rows that
    are not held out."""
    given = held_out(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                                 F.col(lang_col).cast("string").alias("lang")))
    model = fit(given.where("not held_out"))
    return predict(given.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score")
