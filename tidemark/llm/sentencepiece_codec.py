"""SentencePiece encoding and decoding with a batched numpy Viterbi.

A text is cut into units no piece can span (before each run of spaces, around characters
that no longer piece holds); each distinct unit of a block is encoded once.  Units of
equal length advance together: every substring up to the longest piece is hashed and
probes the sorted piece keys, and at each end position the best predecessor is stored as a
backpointer.

The transition score depends on the model.  A unigram model adds piece scores.  A BPE
model has no such sum: there a piece may follow another exactly if merging their joined
text gives those two pieces back.  Merges on one side of a boundary never depend on what
lies beyond the neighbouring piece, so the path on which every pair passes exists once and
is the model's own encoding; ids equal those of the public library.
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import tokens as tk

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text, and ids, that are worked on at once.
BLOCK, BLOCK_IDS = 1_000_000, 400_000
#: Units of a worker whose ids are remembered for later blocks, and most ids of one.
KNOWN_UNITS, KNOWN_IDS = 300_000, 32
META = "▁"                     # fixed value: the model's visible space
#: Slots of the direct-mapped table of checked pairs, per Python worker.
PAIR_SLOTS = 1 << 20
#: Longer units, and lengths with fewer units than this, advance one unit at a time.
WIDE, FEW = 48, 12
_KNOWN: dict[str, "Codec"] = {}


def load_pieces(path: str = MODEL_PATH) -> dict:
    """The model's pieces, scores and special ids (driver side; some 0.5 MB)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    proto = sp.serialized_model_proto()
    return {"pieces": [sp.id_to_piece(i) for i in range(n)], "scores": [sp.get_score(i) for i in range(n)],
            "plain": [not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) for i in range(n)],
            "byte": [i for i in range(n) if sp.is_byte(i)], "unk": sp.unk_id(), "key": hashlib.sha256(proto).hexdigest(),
            "bpe": sp.encode("") == [] and _is_bpe(sp)}


def _is_bpe(sp) -> bool:
    """BPE scores are the negated merge ranks, hence whole numbers; log probabilities are not."""
    scores = [sp.get_score(i) for i in range(sp.get_piece_size())]
    return all(float(s).is_integer() for s in scores)


class Codec:
    """Encoder and decoder tables of one model; lives in a Python worker."""

    def __init__(self, model: dict):
        self.bpe, self.unk = model["bpe"], model["unk"]
        self.pieces, self.scores = model["pieces"], np.array(model["scores"])
        ids = [i for i, ok in enumerate(model["plain"]) if ok]
        self.id_of = {self.pieces[i]: i for i in ids}
        self.longest = max(len(self.pieces[i]) for i in ids)
        cps = np.frombuffer("".join(self.pieces[i] for i in ids).encode("utf-32-le"), np.uint32).astype(tk.U64)
        lens = np.array([len(self.pieces[i]) for i in ids])
        keys = self._hash(cps, np.cumsum(lens) - lens, np.cumsum(lens))
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], np.array(ids, np.int64)[order]
        self.key_len = lens[order]
        self.single = {c for i in ids if len(self.pieces[i]) > 1 for c in self.pieces[i]}
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in model["byte"]}
        raw = [self.pieces[i].replace(META, " ").encode() if ok else b"" for i, ok in enumerate(model["plain"])]
        raw[self.unk] = " ⁇ ".encode()
        for b, i in self.bytes.items():
            raw[i] = bytes([b])
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_len = np.array([len(x) for x in raw])
        self.raw_at = np.cumsum(self.raw_len) - self.raw_len
        self.forget()
        self.pair: dict[int, bool] = {}
        self.slot_key = np.full(PAIR_SLOTS, -1, np.int64)
        self.slot_ok = np.zeros(PAIR_SLOTS, bool)
        self.whole = None
        if self.bpe:     # pieces that merging never builds cannot be on a path
            self.whole = np.zeros(len(self.pieces), bool)
            for i in ids:
                self.whole[i] = self.merge(self.pieces[i]) == [i]

    def forget(self):
        """No unit of earlier blocks is known."""
        self.known = np.zeros(0, tk.U64)                                    # sorted hashes
        self.known_at = self.known_count = self.known_ids = np.zeros(0, np.int64)

    def remember(self, keys: np.ndarray, flat: np.ndarray, at: np.ndarray, count: np.ndarray):
        """Keep the ids of new units; when there are too many, only the last block's."""
        short = np.flatnonzero(count <= KNOWN_IDS)
        if len(self.known) + len(short) > KNOWN_UNITS:
            self.forget()
            short = short[:KNOWN_UNITS]
        keys, own = keys[short], flat[tk.ranges(at[short], count[short])]
        count = count[short]
        at = np.cumsum(count) - count + len(self.known_ids)
        order = np.argsort(np.r_[self.known, keys], kind="stable")
        self.known = np.r_[self.known, keys][order]
        self.known_at, self.known_count = np.r_[self.known_at, at][order], np.r_[self.known_count, count][order]
        self.known_ids = np.r_[self.known_ids, own]

    @staticmethod
    def _hash(cps: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        up, down = tk._table(tk._WORD_BASE, len(cps) + 1)
        run = np.zeros(len(cps) + 1, tk.U64)
        np.cumsum((cps + tk.U64(1)) * up[:len(cps)], out=run[1:])
        return tk.mix((run[ends] - run[starts]) * down[starts] + (ends - starts).astype(tk.U64))

    # symbols outside the vocabulary are single characters, numbered after the pieces
    def symbol(self, char: str) -> int:
        known = self.id_of.get(char)
        return len(self.pieces) + ord(char) if known is None else known

    def text_of(self, symbol: int) -> str:
        return self.pieces[symbol] if symbol < len(self.pieces) else chr(symbol - len(self.pieces))

    def merge(self, text: str) -> list[int]:
        """Byte-pair merges of a short text: best score first, leftmost among equals."""
        part, nxt, prev = list(text), list(range(1, len(text) + 1)), list(range(-1, len(text) - 1))
        heap: list = []

        def offer(i):
            j = nxt[i] if i >= 0 else len(part)
            if i >= 0 and j < len(part):
                k = self.id_of.get(part[i] + part[j])
                if k is not None:
                    heapq.heappush(heap, (-self.scores[k], i, part[i], part[j]))

        for i in range(len(part) - 1):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = nxt[i] if part[i] == a else len(part)
            if j >= len(part) or part[j] != b or part[i] is None:
                continue
            part[i], part[j] = a + b, None
            nxt[i] = nxt[j]
            if nxt[i] < len(part):
                prev[nxt[i]] = i
            offer(prev[i])
            offer(i)
        return [self.symbol(p) for p in part if p is not None]

    def _follows(self, key: int) -> bool:
        ok = self.pair.get(key)
        if ok is None:
            a, b = key >> 21, key & ((1 << 21) - 1)
            ok = self.pair[key] = self.merge(self.text_of(a) + self.text_of(b)) == [a, b]
        return ok

    def follows(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Per pair of symbols: whether b may follow a."""
        key = (a << 21) | b
        slot = (tk.mix(key.view(tk.U64)) & tk.U64(PAIR_SLOTS - 1)).astype(np.int64)
        ok = self.slot_ok[slot]
        miss = np.flatnonzero(self.slot_key[slot] != key)
        if len(miss):
            new, back = np.unique(key[miss], return_inverse=True)
            good = np.fromiter((self._follows(int(k)) for k in new), bool, len(new))
            ok[miss] = good[back]
            self.slot_key[slot[miss]], self.slot_ok[slot[miss]] = key[miss], good[back]
            if len(self.pair) > 4 * PAIR_SLOTS:
                self.pair.clear()
        return ok

    def candidates(self, cps: np.ndarray) -> np.ndarray:
        """(units, end position, piece length) -> symbol, or -1."""
        n, size = cps.shape
        wide = min(self.longest, size)
        up, down = tk._table(tk._WORD_BASE, size + 1)
        run = np.zeros((n, size + 1), tk.U64)
        np.cumsum((cps.astype(tk.U64) + tk.U64(1)) * up[:size], axis=1, out=run[:, 1:])
        out = np.full((n, size + 1, wide + 1), -1, np.int32)
        for length in range(1, wide + 1):
            h = tk.mix((run[:, length:] - run[:, :size - length + 1]) * down[:size - length + 1] + tk.U64(length))
            pos = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            hit = (self.keys[pos] == h) & (self.key_len[pos] == length)
            if self.whole is not None:
                hit &= self.whole[self.key_ids[pos]]
            if length == 1:
                out[:, 1:, 1] = np.where(hit, self.key_ids[pos], len(self.pieces) + cps)
            else:
                out[:, length:, length] = np.where(hit, self.key_ids[pos], -1)
        return out

    def _score(self, symbol):
        if self.bpe:
            return np.zeros(np.shape(symbol))
        low = self.scores.min() - 10.0
        return np.where(symbol < len(self.pieces), self.scores[np.minimum(symbol, len(self.pieces) - 1)], low)

    def viterbi(self, cps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of equally long units: (flat symbols, count per unit)."""
        n, size = cps.shape
        cand = self.candidates(cps)
        wide = cand.shape[2] - 1
        last = np.full((n, size + 1), -1, np.int64)
        back = np.zeros((n, size + 1), np.int64)
        best = np.full((n, size + 1), -np.inf)
        best[:, 0] = 0
        for j in range(1, size + 1):
            for length in range(1, min(j, wide) + 1):
                c = cand[:, j, length].astype(np.int64)
                row = np.flatnonzero((c >= 0) & (best[:, j - length] > -np.inf))
                if not len(row):
                    continue
                c = c[row]
                if self.bpe and j > length:
                    ok = self.follows(last[row, j - length], c)
                    row, c = row[ok], c[ok]
                value = best[row, j - length] + self._score(c)
                better = value > best[row, j]
                row, c = row[better], c[better]
                best[row, j], last[row, j], back[row, j] = value[better], c, length
        return self._trace(last, back)

    @staticmethod
    def _trace(last, back):
        n, size = last.shape[0], last.shape[1] - 1
        at, rows, steps = np.full(n, size), np.arange(n), []
        while len(rows):
            steps.append((rows, last[rows, at[rows]]))
            at[rows] -= back[rows, at[rows]]
            rows = rows[at[rows] > 0]
        count = np.bincount(np.concatenate([r for r, _ in steps]), minlength=n) if steps else np.zeros(n, np.int64)
        end = np.cumsum(count)
        flat = np.empty(int(end[-1]) if n else 0, np.int64)
        for k, (r, s) in enumerate(steps):
            flat[end[r] - 1 - k] = s
        return flat, count

    def viterbi_one(self, cps: np.ndarray) -> np.ndarray:
        """The same recurrence for a single unit, in steps of bounded memory."""
        size, step = len(cps), 4096
        last, back, best = [-1] * (size + 1), [0] * (size + 1), [float("-inf")] * (size + 1)
        best[0] = 0.0
        for lo in range(0, size, step):
            a = max(0, lo - self.longest)
            hi = min(size, lo + step)
            block = self.candidates(cps[a:hi][None])[0]
            score = self._score(block)
            for j in range(lo + 1, hi + 1):
                own, s = block[j - a].tolist(), score[j - a]
                for length in range(1, min(j, len(own) - 1) + 1):
                    c = own[length]
                    if c < 0 or best[j - length] == float("-inf"):
                        continue
                    if self.bpe and j > length and not self._follows((last[j - length] << 21) | c):
                        continue
                    value = best[j - length] + float(s[length])
                    if value > best[j]:
                        best[j], last[j], back[j] = value, c, length
        out, j = [], size
        while j > 0:
            out.append(last[j])
            j -= back[j]
        return np.array(out[::-1], np.int64)

    def units(self, cps: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of units given end to end: (flat ids, count per unit)."""
        at = np.cumsum(lens) - lens
        flats, owners = [], []
        for size in np.unique(lens):
            rows = np.flatnonzero(lens == size)
            if size > WIDE or len(rows) < FEW:
                for r in rows:
                    got = self.viterbi_one(cps[at[r]:at[r] + size])
                    flats.append(got)
                    owners.append(np.full(len(got), r))
                continue
            step = max(FEW, 1_000_000 // int(size * min(size, self.longest)))
            for lo in range(0, len(rows), step):
                own = rows[lo:lo + step]
                flat, count = self.viterbi(cps[at[own][:, None] + np.arange(size)])
                flats.append(flat)
                owners.append(np.repeat(own, count))
        if not flats:
            return np.zeros(0, np.int64), np.zeros(len(lens), np.int64)
        flat, owner = np.concatenate(flats), np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        flat, owner = flat[order], owner[order]
        alien = np.flatnonzero(flat >= len(self.pieces))
        if len(alien):
            if self.bytes:          # byte fallback: one id per UTF-8 byte
                spell = {s: [self.bytes[b] for b in chr(s - len(self.pieces)).encode()] for s in np.unique(flat[alien]).tolist()}
                times = np.ones(len(flat), np.int64)
                times[alien] = [len(spell[s]) for s in flat[alien].tolist()]
                put = np.cumsum(times) - times
                wide = np.repeat(flat, times)
                for i in alien.tolist():
                    wide[put[i]:put[i] + times[i]] = spell[int(flat[i])]
                flat, owner = wide, np.repeat(owner, times)
            else:
                flat[alien] = self.unk
        return flat, np.bincount(owner, minlength=len(lens))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of UTF-8 texts end to end, and their offsets."""
        meta = META.encode()
        if meta in data.tobytes():
            texts = [data[a:b].tobytes().replace(meta, b" ") for a, b in zip(offsets[:-1], offsets[1:])]
            data = np.frombuffer(b"".join(texts), np.uint8)
            offsets = np.r_[0, np.cumsum([len(t) for t in texts])]
        full = np.flatnonzero(np.diff(offsets) > 0)
        data = np.insert(data, offsets[full], 32)          # the dummy space before each text
        offsets = offsets + np.searchsorted(full, np.arange(len(offsets)))
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        space, cut = data == 32, np.zeros(256, bool)
        cut[[b for b in (9, 10, 13) if chr(b) not in self.single]] = True
        alone = cut[data]
        start = space.copy()
        start[1:] &= ~space[:-1]
        start |= alone
        start[1:] |= alone[:-1]
        start[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(start)
        ends = np.r_[starts[1:], len(data)]
        first = np.searchsorted(starts, offsets)
        keys, index, back = np.unique(tk.word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, keys)
        met = np.zeros(len(keys), bool)
        if len(self.known):
            met = self.known[np.minimum(place, len(self.known) - 1)] == keys
        new = np.flatnonzero(~met)
        put, count = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        put[met], count[met] = self.known_at[place[met]], self.known_count[place[met]]
        pool = self.known_ids
        if len(new):
            flat, own = self._units_of(data, starts[index[new]], ends[index[new]])
            at = np.cumsum(own) - own
            put[new], count[new] = at + len(pool), own
            pool = np.r_[pool, flat]
            self.remember(keys[new], flat, at, own)
        ids = pool[tk.ranges(put[back], count[back])]
        return ids, np.r_[0, np.cumsum(count[back])][first]

    def _units_of(self, data: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of the units at the given byte ranges: (flat ids, count per unit)."""
        part = data[tk.ranges(a, b - a)]
        cps = np.frombuffer(part.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        cps[cps == 32] = ord(META)
        byte_at = np.cumsum(b - a) - (b - a)
        lens = np.add.reduceat(((part & 0xC0) != 0x80).astype(np.int64), byte_at)
        return self.units(cps, lens)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of id sequences end to end, and their offsets."""
        ids = np.where((ids >= 0) & (ids < len(self.pieces)), ids, self.unk)
        lens = self.raw_len[ids]
        at = np.r_[0, np.cumsum(lens)][offsets]
        data = self.raw[tk.ranges(self.raw_at[ids], lens)]
        lead = at[:-1][(np.diff(at) > 0)]
        lead = lead[data[lead] == 32] if len(data) else lead
        return np.delete(data, lead), at - np.searchsorted(lead, at)


def codec(model: dict) -> Codec:
    if model["key"] not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[model["key"]] = Codec(model)
    return _KNOWN[model["key"]]


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    raw = data.tobytes()
    return pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])], pa.string())


def _encode(model):
    def run(it):
        tool = codec(model.value)
        for batch in it:
            data, offsets = tk.text_buffer(batch.column(0))
            for lo, hi in tk.row_blocks(offsets, BLOCK):
                ids, at = tool.encode(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                own = batch.slice(lo, hi - lo)
                pieces = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*own.columns[1:], pieces], names=[*own.schema.names[1:], "piece_ids"])
    return run


def _decode(model):
    def run(it):
        tool = codec(model.value)
        for batch in it:
            lists = batch.column(0)
            if lists.null_count:
                lists = lists.fill_null([])
            at = np.frombuffer(lists.offsets.buffers()[1], np.int32)[lists.offset:lists.offset + len(lists) + 1].astype(np.int64)
            ids = lists.values.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)[at[0]:at[-1]] if len(at) else np.zeros(0, np.int64)
            at = at - at[0]
            for lo, hi in tk.row_blocks(at, BLOCK_IDS):
                data, off = tool.decode(ids[at[lo]:at[hi]], at[lo:hi + 1] - at[lo])
                own = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*own.columns[1:], _strings(data, off)], names=[*own.schema.names[1:], "decoded"])
    return run


def _round_trip(model):
    """Ids of every text, and what they decode to, in one pass over small blocks."""
    def run(it):
        tool = codec(model.value)
        for batch in it:
            data, offsets = tk.text_buffer(batch.column(1))
            for lo, hi in tk.row_blocks(offsets, BLOCK):
                own, at = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
                ids, id_at = tool.encode(own, at)
                back, back_at = tool.decode(ids, id_at)
                decoded = [back[a:b].tobytes().decode("utf-8", "replace").encode() for a, b in zip(back_at[:-1], back_at[1:])]
                same = [d == own[a:b].tobytes() for d, a, b in zip(decoded, at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(id_at.astype(np.int32)), pa.array(ids.astype(np.int32))),
                     pa.array(np.diff(id_at).astype(np.int64)), pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string()),
                     pa.array(same, pa.bool_())],
                    names=["doc_id", "piece_ids", "n_pieces", "decoded_sha256", "round_trip"])
    return run


def encode(docs: DataFrame, text_col: str = "text", model_path: str = MODEL_PATH) -> DataFrame:
    """``docs`` with the column ``piece_ids array<int>``.

    Null and empty texts have no pieces.  Characters outside the vocabulary fall back to
    byte pieces, or to the unknown id where the model has none.  Existing columns stay; one
    named ``piece_ids`` is replaced.  An empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(load_pieces(model_path))
    rest = docs.drop("piece_ids")
    given = rest.select(F.col(f"`{text_col}`").cast("string").alias("_input_text"), *[F.col(f"`{c}`") for c in rest.columns])
    schema = T.StructType([*rest.schema.fields, T.StructField("piece_ids", T.ArrayType(T.IntegerType()))])
    return given.mapInArrow(tk.tidy(_encode(model)), schema)


def decode(rows: DataFrame, ids_col: str = "piece_ids", model_path: str = MODEL_PATH) -> DataFrame:
    """``rows`` with the column ``decoded`` (string).

    The inverse of ``encode`` for every text without the model's visible space U+2581,
    which decodes as a space.  Ids outside the model count as unknown; byte pieces that
    form no UTF-8 become U+FFFD.  Null lists decode to the empty text.  An existing column
    ``decoded`` is replaced.
    """
    model = rows.sparkSession.sparkContext.broadcast(load_pieces(model_path))
    rest = rows.drop("decoded")
    given = rest.select(F.col(f"`{ids_col}`").cast("array<int>").alias("_input_ids"), *[F.col(f"`{c}`") for c in rest.columns])
    schema = T.StructType([*rest.schema.fields, T.StructField("decoded", T.StringType())])
    return given.mapInArrow(tk.tidy(_decode(model)), schema)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str = MODEL_PATH) -> DataFrame:
    """``(doc_id, piece_ids, n_pieces, decoded_sha256, round_trip)`` of every row."""
    model = docs.sparkSession.sparkContext.broadcast(load_pieces(model_path))
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(tk.tidy(_round_trip(model)), "doc_id long, piece_ids array<int>, n_pieces long, decoded_sha256 string, round_trip boolean")
