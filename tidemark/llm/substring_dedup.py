"""Removal of repeated 13-word windows by super-k-mer partitioning.

A window is ``K`` consecutive words.  Its minimiser is the run of ``M`` words in it with
the smallest hash; consecutive windows with one minimiser are a super-k-mer, and travel as
one packed string to the minimiser's bucket, where sorting brings equal windows together.

* A minimiser that many different windows share (template text) is no bucket: where the
  counts of a first pass say so, its windows travel singly, dealt by their full hash.
  Equal windows have one minimiser, so they still meet.
* Windows that a smaller document of the same block holds are settled in place, so a
  passage that a third of the documents share reaches its bucket once per block.
* Super-k-mers of one block and bucket are one compressed row.
* Sorting uses 64-bit window hashes; every window found twice is compared word by word.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tokens as tk
from tidemark.llm.storage import stored

K = 13
M = 2
#: Text bytes per bucket; packed super-k-mers are about three times their text.
BUCKET_BYTES = 5_000_000
#: Minimisers are counted by hash in this many cells a bucket (``MAX_CELLS`` at most); the
#: windows of a cell above ``HOT_BYTES`` of packed super-k-mers, and ``HOT_MEAN`` times the
#: mean cell, are dealt singly.
CELLS, MAX_CELLS = 64, 1 << 22
HOT_BYTES, HOT_MEAN = 5_000_000, 4
#: Packed super-k-mers over their text, as ``BUCKET_BYTES`` counts it.
PACKED = 3
#: A bucket is sorted in this many parts, by the hash that deals it, one after the other.
PARTS = 4
#: Text bytes settled together in a task; twenty times this is the task's working memory.
BLOCK = 4_000_000


def _minimiser_runs(first: np.ndarray, word: np.ndarray, k: int, m: int):
    """Valid window starts and the minimiser (hash) of each.  Windows never cross texts."""
    n = len(word)
    lens = np.maximum(np.diff(first) - k + 1, 0)
    at = tk.ranges(first[:-1], lens)
    if not len(at):
        return at, np.zeros(0, tk.U64), np.zeros(0, np.int64)
    grams = tk.window_hashes(word, m)
    span = k - m + 1
    low = grams[:n - k + 1].copy()
    for j in range(1, span):
        np.minimum(low, grams[j:j + n - k + 1], out=low)
    owner = np.repeat(np.arange(len(first) - 1), lens)
    return at, low[at], owner


def _settle(key: np.ndarray, order_ids: np.ndarray, same) -> np.ndarray:
    """Per window: whether a window with the same words starts in a smaller document.

    ``key``: window hashes; ``order_ids``: document ids; ``same(i, j)``: whether windows i
    and j (arrays) have the same words.
    """
    order = np.lexsort((order_ids, key))
    k, d = key[order], order_ids[order]
    head = np.r_[True, k[1:] != k[:-1]]
    lead = np.maximum.accumulate(np.where(head, np.arange(len(k)), 0))
    later = d > d[lead]
    out = np.zeros(len(key), dtype=bool)
    x, y = order[later], order[lead[later]]
    if len(x):
        ok = same(x, y)
        out[x[ok]] = True
        for i in x[~ok]:     # a 64-bit collision: compare with every window of that hash
            rest = order[(k == key[i]) & (d < order_ids[i])]
            out[i] = bool(same(np.full(len(rest), i), rest).any())
    return out


def _same_words(data: bytes, starts, ends, at, k: int):
    def same(x, y):
        px, py = at[x], at[y]
        size = ends[px + k - 1] - starts[px]
        ok = size == ends[py + k - 1] - starts[py]
        # with equal length the bytes decide; separators differ only where words do
        for i in np.flatnonzero(ok):
            a, b = px[i], py[i]
            ok[i] = data[starts[a]:starts[a] + size[i]] == data[starts[b]:starts[b] + size[i]]
        for i in np.flatnonzero(~ok):
            a, b = px[i], py[i]
            ok[i] = data[starts[a]:ends[a + k - 1]].split() == data[starts[b]:ends[b + k - 1]].split()
        return ok
    return same


def _spans(doc: np.ndarray, pos: np.ndarray, k: int):
    """Runs of consecutive flagged windows -> (document, first word, end word)."""
    if not len(doc):
        return doc, pos, pos
    cut = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1] + 1)])
    last = np.r_[cut[1:], len(doc)] - 1
    return doc[cut], pos[cut], pos[last] + k


def _cuts(owner: np.ndarray, at: np.ndarray, low: np.ndarray, single: np.ndarray | None = None) -> np.ndarray:
    """Where super-k-mers start; windows flagged ``single`` are one each."""
    cut = np.r_[True, (owner[1:] != owner[:-1]) | (at[1:] != at[:-1] + 1) | (low[1:] != low[:-1])]
    return np.flatnonzero(cut if single is None else cut | single)


def _weigh(k: int, m: int, cells: int):
    """Rows (cell, packed, singly): bytes of a cell's windows as super-k-mers and one by one;
    windows that a block repeats count once."""
    def run(it):
        packed, singly = np.zeros(cells, np.int64), np.zeros(cells, np.int64)
        for batch in it:
            data, offsets = tk.text_buffer(batch.column(1))
            for lo, hi in tk.row_blocks(offsets, BLOCK):
                starts, ends, first = tk.words(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                word = tk.word_hashes(data[offsets[lo]:offsets[hi]], starts, ends)
                at, low, owner = _minimiser_runs(first, word, k, m)
                if not len(at):
                    continue
                own = np.sort(np.unique(tk.window_hashes(word, k)[at], return_index=True)[1])
                at, low, owner = at[own], low[own], owner[own]
                cell = (tk.mix(low) % tk.U64(cells)).astype(np.int64)
                np.add.at(singly, cell, ends[at + k - 1] - starts[at])
                cut = _cuts(owner, at, low)
                count = np.diff(np.r_[cut, len(at)])
                np.add.at(packed, cell[cut], ends[at[cut] + count + k - 2] - starts[at[cut]])
        used = np.flatnonzero(packed)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(packed[used]), pa.array(singly[used])],
                                         names=["cell", "packed", "singly"])
    return run


def _pack(k: int, m: int, buckets: int, cells: int, shared):
    """Rows (bucket, payload), and spans settled here, which pass through any bucket."""
    def run(it):
        pack, hot = zstandard.ZstdCompressor(level=6), np.zeros(cells, dtype=bool)
        hot[shared.value] = True
        for batch in it:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = tk.text_buffer(batch.column(1))
            for lo, hi in tk.row_blocks(offsets, BLOCK):
                yield from block(pack, hot, ids[lo:hi], data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])

    def block(pack, hot, ids, data, offsets):
        starts, ends, first = tk.words(data, offsets)
        word = tk.word_hashes(data, starts, ends)
        at, low, owner = _minimiser_runs(first, word, k, m)
        if not len(at):
            return
        raw = data.tobytes()
        key = tk.window_hashes(word, k)[at]
        doc, pos = ids[owner], at - first[owner]
        settled = _settle(key, doc, _same_words(raw, starts, ends, at, k))
        s_doc, s_from, s_to = _spans(doc[settled], pos[settled], k)
        names = ["bucket", "doc_id", "from_word", "to_word", "payload"]
        if len(s_doc):
            yield pa.RecordBatch.from_arrays(
                [pa.array((s_doc % buckets).astype(np.int32)), pa.array(s_doc), pa.array(s_from), pa.array(s_to),
                 pa.nulls(len(s_doc), pa.binary())], names=names)
        at, low, owner, doc, pos, key = (v[~settled] for v in (at, low, owner, doc, pos, key))
        if not len(at):
            return
        single = hot[(tk.mix(low) % tk.U64(cells)).astype(np.int64)]
        cut = _cuts(owner, at, low, single | np.r_[False, single[:-1]])
        count = np.diff(np.r_[cut, len(at)])
        a, b = starts[at[cut]], ends[at[cut] + count - 1 + k - 1]
        deal = tk.mix(np.where(single[cut], key[cut], low[cut]))
        bucket, part = (deal % tk.U64(buckets)).astype(np.int32), (deal >> tk.U64(40)) % tk.U64(PARTS)
        order = np.argsort(bucket, kind="stable")
        edge = np.r_[np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0]), len(order)]
        flat, out = np.frombuffer(raw, np.uint8), []
        for x, y in zip(edge[:-1], edge[1:]):
            own = order[x:y]
            head = np.stack([doc[cut[own]], pos[cut[own]], b[own] - a[own], part[own].astype(np.int64)], 1).astype(np.int64)
            text = flat[tk.ranges(a[own], b[own] - a[own])]
            out.append(pack.compress(np.int64(len(own)).tobytes() + head.T.copy().tobytes() + text.tobytes()))
        n = len(out)
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket[order[edge[:-1]]]), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
             pa.array(out, pa.binary())], names=names)
    return run


def _count(k: int):
    """Sorted by bucket: every bucket's windows are sorted and settled across blocks."""
    def solve(payloads):
        unpack = zstandard.ZstdDecompressor()
        heads, texts = [], []
        for p in payloads:
            raw = unpack.decompress(p)
            n = int(np.frombuffer(raw, np.int64, 1)[0])
            heads.append(np.frombuffer(raw, np.int64, 4 * n, 8).reshape(4, n))
            texts.append(np.frombuffer(raw, np.uint8, offset=8 + 32 * n))
        head, data = np.concatenate(heads, axis=1), np.concatenate(texts)
        del heads, texts
        at = np.cumsum(head[2]) - head[2]
        for part in range(PARTS):
            own = np.flatnonzero(head[3] == part)
            if len(own):
                yield one(*head[:3, own], data[tk.ranges(at[own], head[2, own])])

    def one(doc, pos, size, data):
        offsets = np.r_[0, np.cumsum(size)]
        starts, ends, first = tk.words(data, offsets)
        lens = np.diff(first) - k + 1
        at = tk.ranges(first[:-1], lens)
        owner = np.repeat(np.arange(len(doc)), lens)
        key = tk.window_hashes(tk.word_hashes(data, starts, ends), k)[at]
        d = doc[owner]
        flag = _settle(key, d, _same_words(data.tobytes(), starts, ends, at, k))
        return _spans(d[flag], (pos[owner] + at - first[owner])[flag], k)

    def run(it):
        now, held = None, []
        for batch in it:
            settled = batch.filter(pc.is_valid(batch.column("doc_id")))
            if settled.num_rows:
                yield settled.select(["doc_id", "from_word", "to_word"])
            open_ = batch.filter(pc.is_null(batch.column("doc_id")))
            for b, p in zip(open_.column("bucket").to_pylist(), open_.column("payload")):
                if b != now:
                    if len(held) > 1:
                        yield from spans(held)
                    now, held = b, []
                held.append(p.as_buffer().to_pybytes())
        if len(held) > 1:
            yield from spans(held)

    def spans(held):
        for found in solve(held):
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x).astype(np.int64)) for x in found],
                                             names=["doc_id", "from_word", "to_word"])
    return run


def _squeeze(it):
    """Texts go to their spans compressed."""
    pack = zstandard.ZstdCompressor(level=3)
    for batch in it:
        texts = batch.column(1).cast(pa.binary())
        packed = [pack.compress(t.as_buffer()) if t.is_valid and len(t.as_buffer()) else None for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["doc_id", "packed"])


def _remove(it):
    unpack = zstandard.ZstdDecompressor()
    for batch in it:
        ids, texts, spans = batch.column(0), batch.column(1), batch.column(2).to_pylist()
        total, lost, sha, kept_text = [], [], [], []
        for text, own in zip(texts.to_pylist(), spans):
            w = unpack.decompress(text).split() if text else []
            total.append(len(w))
            if own:
                gone = np.zeros(len(w), dtype=bool)
                for s in own:
                    gone[s["from_word"]:s["to_word"]] = True
                w = [x for x, g in zip(w, gone) if not g]
            lost.append(total[-1] - len(w))
            kept_text.append(b" ".join(w))
            sha.append(hashlib.sha256(kept_text[-1]).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(total, pa.int64()), pa.array(lost, pa.int64()), pa.array(sha),
             pa.array(kept_text, pa.binary()).cast(pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, m: int = M) -> DataFrame:
    """``(doc_id, from_word, to_word)``: word ranges covered by windows whose words also
    start in a document with a smaller id.  Ranges of one document may overlap."""
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    given = given.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    size = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, math.ceil(size / BUCKET_BYTES))
    cells = min(CELLS * buckets, MAX_CELLS)
    counts = stored(given.mapInArrow(_weigh(k, m, cells), "cell int, packed long, singly long").groupBy("cell")
                    .agg(F.sum("packed").alias("packed"), F.sum("singly").alias("singly")), "cells")
    total = counts.agg(F.sum("packed")).first()[0] or 0
    many = counts.where(F.col("packed") > max(HOT_BYTES, HOT_MEAN * total / cells)).toArrow()
    more = sum(many.column("singly").to_pylist()) - sum(many.column("packed").to_pylist())
    buckets = max(buckets, math.ceil((total + more) / (PACKED * BUCKET_BYTES)))
    hot = docs.sparkSession.sparkContext.broadcast(many.column("cell").to_numpy())
    rows = given.mapInArrow(_pack(k, m, buckets, cells, hot), "bucket int, doc_id long, from_word long, to_word long, payload binary")
    return (rows.repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(_count(k), "doc_id long, from_word long, to_word long"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, m: int = M) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, kept_text)``, one row per input row.

    A word goes when a window of ``k`` words that covers it also starts in a document with
    a smaller id; windows are judged on the input.  Null texts have no words.  Rows that
    repeat an id are one document to the comparison and are cut at the same places.  Rows
    with a null id are kept whole and compared with nothing.  Other columns are ignored;
    an empty table gives no rows.
    """
    spans = repeated_spans(docs, id_col, text_col, k, m)
    own = spans.groupBy("doc_id").agg(F.collect_set(F.struct("from_word", "to_word")).alias("spans"))
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    packed = given.mapInArrow(_squeeze, "doc_id long, packed binary")
    return packed.join(own, "doc_id", "left").select("doc_id", "packed", "spans").mapInArrow(
        _remove, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
