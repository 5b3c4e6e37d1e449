"""N-gram Jaccard join through a token-group matrix.

Every text becomes the set of its distinct word 5-grams (64-bit hashes).  Two texts link
when ``100 * |A & B| >= threshold * |A | B|``; the result is each text's component.

1. Texts with equal sets form one class; a class is treated once.
2. The matrix has a row per (token, class) for the tokens that matter: under one global
   order, rare tokens first, sets that link share a token among their first
   ``n - ceil(t * n) + 1``.  Tokens seen by one class only leave at once.
3. Similar classes are partitioned into groups: below a few tokens of its own each class
   proposes the partner that most others qualify with, proposals are verified, components
   are groups.
4. The rows stay one per (token, class), now with the class's group; no union per group is
   built.  Classes of *different* groups that share a token are compared one by one, so
   a token of n classes costs up to n * n comparisons.  The overlap of a pair is bounded by
   size and by a 512-bit parity sketch (the Hamming distance of two sketches never
   exceeds the sets' symmetric difference).  A pair is named only by a token that can be
   its first shared one: what follows it must suffice for a link, and neither of the two
   tokens before it may be shared.  What is named must qualify by a sketch of two bits per
   element, is then opened and verified against the exact sets.

No step drops a pair that could link: order and grouping decide the cost, not the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import tokens as tk
from tidemark.llm.components import connected_components
from tidemark.llm.storage import stored
from tidemark.session import bounded_broadcast

SHINGLE = 5
THRESHOLD = 80           # percent
#: Entries of the table of frequent tokens that orders the others before them.  It only
#: steers the order; whatever it holds, no link is lost.
FREQUENT_ENTRIES = 1 << 18
SKETCH_BITS = 512
#: Ids broadcast (8 bytes each) to pick the texts to verify; beyond, a shuffle join does.
BROADCAST_IDS = 1_000_000
#: Rows of one token handled together; a longer list is cut into pairs of such chunks.
CHUNK = 1024
#: Lists up to this length are compared many at a time.
SHORT = 24
#: Tokens of a class below which it proposes a partner, those with the smallest hash (so
#: similar classes take the same ones).  Groups only save work; all tokens open pairs.
HUB_TOKENS = 6
#: Columns of the tokens just before a row's token in its prefix, of those in other sets too.
BEFORE = ("before1", "before2")

CLASS_SCHEMA = "doc_id long, n_shingles long, sig long, sketch binary, fine binary"


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, end to end, and their offsets.

    A text of fewer than ``k`` words has its whole word sequence as one shingle; a text
    without words has the empty set.
    """
    data = tk.LOWER[data]
    starts, ends, first = tk.words(data, offsets)
    word = tk.word_hashes(data, starts, ends)
    grams = tk.window_hashes(word, k)
    out, sizes = [], np.zeros(len(offsets), np.int64)
    for i in range(len(offsets) - 1):
        lo, hi = first[i], first[i + 1]
        if hi - lo >= k:
            s = np.unique(grams[lo:hi - k + 1])
        elif hi > lo:
            s = np.array([tk.sequence_hash(word[lo:hi])], dtype=tk.U64)
        else:
            continue
        out.append(s)
        sizes[i + 1] = len(s)
    return np.concatenate(out) if out else np.zeros(0, tk.U64), np.cumsum(sizes)


def set_signatures(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """64-bit hash of each set; the empty set has 0."""
    run = np.zeros(len(values) + 1, dtype=tk.U64)
    np.cumsum(tk.mix(values ^ tk.U64(0xA5A5A5A5A5A5A5A5)), out=run[1:])
    sizes = np.diff(offsets).astype(tk.U64)
    sig = tk.mix((run[offsets[1:]] - run[offsets[:-1]]) + sizes)
    sig[sizes == 0] = 0
    return sig


def parity_sketches(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``SKETCH_BITS`` parity bits of each set, as rows of uint64."""
    n = len(offsets) - 1
    out = np.zeros((n, SKETCH_BITS // 64), dtype=tk.U64)
    for lo in range(0, n, 512):
        hi = min(n, lo + 512)
        part = values[offsets[lo]:offsets[hi]]
        row = np.repeat(np.arange(hi - lo), np.diff(offsets[lo:hi + 1]))
        cell = row * SKETCH_BITS + (part & tk.U64(SKETCH_BITS - 1)).astype(np.int64)
        odd = (np.bincount(cell, minlength=(hi - lo) * SKETCH_BITS) & 1).astype(np.uint8)
        out[lo:hi] = np.packbits(odd.reshape(hi - lo, SKETCH_BITS), axis=1).view(tk.U64)
    return out


def fine_sketch(values: np.ndarray) -> bytes:
    """Parity bits of a set, about two per element (a power of two of them), which bound
    the symmetric difference of large sets closely."""
    bits = max(SKETCH_BITS, 1 << int(2 * len(values) - 1).bit_length())
    odd = np.bincount((values & tk.U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _fold(x: np.ndarray, words: int) -> np.ndarray:
    """A wide sketch as a narrower one: bit positions are equal modulo the width."""
    return np.bitwise_xor.reduce(x.reshape(-1, words), axis=0) if len(x) > words else x


def _batches(it: Iterator[pa.RecordBatch], k: int):
    for batch in it:
        heads = batch.drop_columns([batch.schema.names[1]]).columns
        data, offsets = tk.text_buffer(batch.column(1))
        for lo, hi in tk.row_blocks(offsets):
            values, at = shingle_sets(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], k)
            yield [c.slice(lo, hi - lo) for c in heads], values, at


def _profile(k: int, extra: tuple[str, ...] = ()):
    """One row per text; ``extra`` names columns that pass through."""
    def run(it):
        for heads, values, at in _batches(it, k):
            sig = set_signatures(values, at)
            sketch = parity_sketches(values, at)
            yield pa.RecordBatch.from_arrays(
                [heads[0], pa.array(np.diff(at)), pa.array(tk.to_long(sig)),
                 pa.array([r.tobytes() for r in sketch], pa.binary()),
                 pa.array([fine_sketch(values[lo:hi]) if hi > lo else b"" for lo, hi in zip(at[:-1], at[1:])], pa.binary()),
                 *heads[1:]],
                names=["doc_id", "n_shingles", "sig", "sketch", "fine", *extra])
    return run


def _repeats(k: int):
    def run(it):
        for _, values, at in _batches(it, k):
            keep = np.unique(set_signatures(values, at), return_index=True)[1]
            lens = np.diff(at)[keep]
            part = np.sort(values[tk.ranges(at[keep], lens)])
            if not len(part):
                continue
            head = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            count = np.diff(np.r_[head, len(part)])
            many = count > 1
            yield pa.RecordBatch.from_arrays([pa.array(tk.to_long(part[head[many]])), pa.array(count[many])],
                                             names=["token", "n"])
    return run


def frequent_tokens(docs: DataFrame, k: int, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted tokens, log2 of their counts): the most frequent levels that fit ``entries``."""
    spark = docs.sparkSession
    counts = (docs.mapInArrow(tk.tidy(_repeats(k)), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
              .where("n >= 4").select("token", F.floor(F.log2("n")).cast("int").alias("level")))
    counts = stored(counts, "frequent")
    total, cut = 0, 64
    for level, n in counts.groupBy("level").count().orderBy(F.desc("level")).collect():   # at most 64 rows
        if total + n > entries:
            break
        total, cut = total + n, level
    rows = counts.where(F.col("level") >= cut).toArrow()
    token = tk.from_long(rows.column("token").to_numpy())
    order = np.argsort(token)
    return token[order], rows.column("level").to_numpy()[order].astype(np.int8)


def prefix_length(n, threshold: int):
    return n + (-threshold * n) // 100 + 1      # n - ceil(t * n) + 1


def _prefixes(k: int, threshold: int, frequent):
    def run(it):
        known, level_of = frequent.value
        for _, values, at in _batches(it, k):
            sig, first = np.unique(set_signatures(values, at), return_index=True)
            level = np.zeros(len(values), np.int8)
            if len(known):
                pos = np.minimum(np.searchsorted(known, values), len(known) - 1)
                hit = known[pos] == values
                level[hit] = level_of[pos[hit]]
            tokens, owners, places = [], [], []
            for s, i in zip(sig, first):
                lo, hi = at[i], at[i + 1]
                if hi == lo:
                    continue
                p = prefix_length(hi - lo, threshold)
                own = values[lo:hi]
                if level[lo:hi].any():
                    own = own[np.argsort(level[lo:hi], kind="stable")]
                tokens.append(own[:p])
                owners.append(np.full(min(p, hi - lo), s, tk.U64))
                places.append(np.arange(min(p, hi - lo), dtype=np.int32))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tk.to_long(np.concatenate(tokens))), pa.array(tk.to_long(np.concatenate(owners))),
                     pa.array(np.concatenate(places))],
                    names=["token", "sig", "pos"])
    return run


def _hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int32)


def _qualify(n1, n2, distance, threshold: int):
    """Whether sets of these sizes and this sketch distance can link: the size bound, and
    symmetric difference <= (n1 + n2) * (100 - t) / (100 + t)."""
    return ((np.minimum(n1, n2) * 100 >= np.maximum(n1, n2) * threshold)
            & (distance * (100 + threshold) <= (n1 + n2) * (100 - threshold)))


def _first_shared(part: dict, a: np.ndarray, b: np.ndarray, threshold: int) -> np.ndarray:
    """Whether the list's token can be the first one that these linking rows share: their
    sets from it on can hold the overlap, and no token just before it is in both.  True
    for the token that is the first, so each link is named at least once."""
    n1, n2 = part["n"][a], part["n"][b]
    can = np.minimum(n1 - part["pos"][a], n2 - part["pos"][b]) * (100 + threshold) >= (n1 + n2) * threshold
    for x in BEFORE:
        for y in BEFORE:
            can &= (part[x][a] != part[y][b]) | (part[x][a] == 0)      # 0: none
    return can


def _list_pairs(part: dict, threshold: int, hubs: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of one (token, chunk pair) list.  With ``hubs`` each row keeps only the
    qualifying partner that most rows qualify with."""
    n, group, side, rep = part["n"], part["grp"], part["side"], part["rep"]
    left = np.flatnonzero(side != 2)          # 0: a chunk with itself, 1 against 2
    right = np.flatnonzero(side != 1)
    step = max(1, 60_000 // max(1, len(right)))

    def blocks():
        for lo in range(0, len(left), step):
            l = left[lo:lo + step]
            ok = _qualify(n[l][:, None], n[right][None], _hamming(part["sketch"][l][:, None], part["sketch"][right][None]),
                          threshold) & (group[l][:, None] != group[right][None])
            yield l, ok

    if not hubs:
        for l, ok in blocks():
            i, j = np.nonzero(ok)
            a, b = l[i], right[j]
            keep = (side[a] == 1) | (rep[a] < rep[b])
            a, b = a[keep], b[keep]
            keep = _first_shared(part, a, b, threshold)
            yield a[keep], b[keep]
        return
    degree = np.zeros(len(n), np.int64)
    for l, ok in blocks():
        degree[l] += ok.sum(1)
        np.add.at(degree, right[ok.any(0)], ok.sum(0)[ok.any(0)])
    for l, ok in blocks():
        score = np.where(ok, degree[right][None] + 1, 0)
        best = score.argmax(1)
        got = score[np.arange(len(l)), best] > 0
        yield l[got], right[best[got]]
        if side[l[0]] == 1:                    # the other chunk's rows choose as well
            score = np.where(ok, degree[l][:, None] + 1, 0)
            best = score.argmax(0)
            got = score[best, np.arange(len(right))] > 0
            yield l[best[got]], right[got]


def _short_pairs(part: dict, first: np.ndarray, size: int, threshold: int, hubs: bool):
    """As ``_list_pairs``, for all uncut lists of one small length at once."""
    step = max(1, 200_000 // (size * size))
    for lo in range(0, len(first), step):
        at = first[lo:lo + step][:, None] + np.arange(size)
        n, g, s = part["n"][at], part["grp"][at], part["sketch"][at]
        ok = _qualify(n[:, :, None], n[:, None], _hamming(s[:, :, None], s[:, None]), threshold)
        ok &= g[:, :, None] != g[:, None]
        if hubs:
            score = np.where(ok, ok.sum(2)[:, None] + 1, 0)
            best = score.argmax(2)
            i, j = np.nonzero(np.take_along_axis(score, best[:, :, None], 2)[:, :, 0])
            yield at[i, j], at[i, best[i, j]]
        else:
            i, j, k = np.nonzero(ok & np.triu(np.ones((size, size), bool), 1))
            a, b = at[i, j], at[i, k]
            keep = _first_shared(part, a, b, threshold)
            yield a[keep], b[keep]


def _candidates(threshold: int, hubs: bool):
    """Streams rows sorted by (token, cell); a list is complete once the next one begins."""
    names = ["token", "cell", "side", "rep", "n", "grp", "pos", *BEFORE]

    def table(batch):
        out = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
        flat = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), dtype=tk.U64)
        return out | {"sketch": flat.reshape(-1, SKETCH_BITS // 64)}

    def emit(part):
        key = np.flatnonzero(np.r_[True, (part["token"][1:] != part["token"][:-1]) | (part["cell"][1:] != part["cell"][:-1]), True])
        seen = []

        def add(rep, a, b):
            seen.append(np.stack([np.minimum(rep[a], rep[b]), np.maximum(rep[a], rep[b])], 1))

        first, size = key[:-1], np.diff(key)
        whole = part["side"][first] == 0
        for length in range(2, SHORT + 1):
            some = first[(size == length) & whole]
            if len(some):
                for a, b in _short_pairs(part, some, length, threshold, hubs):
                    add(part["rep"], a, b)
        for lo, hi in zip(key[:-1][(size > SHORT) | ~whole], key[1:][(size > SHORT) | ~whole]):
            own = {c: v[lo:hi] for c, v in part.items()}
            for a, b in _list_pairs(own, threshold, hubs):
                add(own["rep"], a, b)
        if seen:
            pairs = np.unique(np.concatenate(seen), axis=0)
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])

    def run(it):
        rest = None
        for batch in it:
            if not batch.num_rows:
                continue
            part = table(batch)
            if rest is not None:
                part = {c: np.concatenate([rest[c], part[c]]) for c in part}
            last = np.flatnonzero((part["token"] != part["token"][-1]) | (part["cell"] != part["cell"][-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield from emit({c: v[:cut] for c, v in part.items()})
            rest = {c: v[cut:] for c, v in part.items()}
        if rest is not None:
            yield from emit(rest)
    return run


def _chunked(lists: DataFrame) -> DataFrame:
    """Cut long lists: with m chunks a row goes to the m cells (own chunk, any chunk)."""
    w = Window.partitionBy("token")
    cut = lists.withColumn("m", F.ceil(F.count("*").over(w) / CHUNK).cast("int"))
    cut = cut.withColumn("c", F.pmod(F.xxhash64("rep"), F.col("m")).cast("int"))
    cut = cut.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    lo, hi = F.least("c", "o"), F.greatest("c", "o")
    return cut.select("token", (lo * F.col("m") + hi).alias("cell"),
                      F.when(F.col("c") == F.col("o"), 0).when(F.col("c") < F.col("o"), 1).otherwise(2).alias("side"),
                      "rep", "n", "grp", "pos", *BEFORE, "sketch")


def _pairs(lists: DataFrame, groups: DataFrame | None, threshold: int, hubs: bool) -> DataFrame:
    """Candidate pairs of classes in different groups."""
    if groups is None:
        own = lists.withColumn("grp", F.col("rep"))
    else:
        own = (lists.join(groups, lists.rep == groups.node, "left")
               .withColumn("grp", F.coalesce("component", "rep")).drop("node", "component"))
        many = own.groupBy("token").agg(F.min("grp").alias("g0"), F.max("grp").alias("g1")).where("g0 <> g1")
        own = own.join(many.select("token"), "token", "left_semi")
    return (_chunked(own).repartition("token", "cell").sortWithinPartitions("token", "cell")
            .mapInArrow(tk.tidy(_candidates(threshold, hubs)), "a long, b long").distinct())


def _closer(threshold: int):
    def run(it):
        for batch in it:
            n1, n2 = batch.column("n1").to_numpy(), batch.column("n2").to_numpy()
            distance = np.zeros(batch.num_rows, np.int64)
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"))):
                x, y = (np.frombuffer(v.as_buffer(), dtype=tk.U64) for v in (x, y))
                words = min(len(x), len(y))
                distance[i] = np.bitwise_count(_fold(x, words) ^ _fold(y, words)).sum()
            keep = _qualify(n1, n2, distance, threshold)
            yield batch.select(["a", "b"]).filter(pa.array(keep))
    return run


def _closer_pairs(pairs: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """The pairs that still qualify by their fine sketches."""
    fine = classes.select("sig", "n", "fine")
    joined = (pairs.join(fine.select(F.col("sig").alias("a"), F.col("n").alias("n1"), F.col("fine").alias("x")), "a")
              .join(fine.select(F.col("sig").alias("b"), F.col("n").alias("n2"), F.col("fine").alias("y")), "b")
              .select("a", "b", "n1", "n2", "x", "y"))
    return stored(joined.mapInArrow(tk.tidy(_closer(threshold)), "a long, b long"), "pairs")


def _sets(k: int):
    def run(it):
        for _, values, at in _batches(it, k):
            raw = values.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(tk.to_long(set_signatures(values, at))),
                 pa.array([raw[8 * lo:8 * hi] for lo, hi in zip(at[:-1], at[1:])], pa.binary())], names=["sig", "tokens"])
    return run


def _verify(threshold: int):
    def run(it):
        for batch in it:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"))):
                x, y = (np.frombuffer(v.as_buffer(), dtype=tk.U64) for v in (x, y))
                both = np.sort(np.concatenate([x, y]))
                same = int((both[1:] == both[:-1]).sum())
                if 100 * same >= threshold * (len(both) - same):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))
    return run


def _verified(pairs: DataFrame, classes: DataFrame, known: DataFrame, k: int, threshold: int) -> DataFrame:
    """The pairs whose exact sets link; only the sets of these pairs are built again."""
    need = pairs.select(F.col("a").alias("sig")).union(pairs.select("b")).distinct()
    first = stored(classes.join(need, "sig", "left_semi").select(F.col("first_id").alias("doc_id")).distinct(), "need")
    sets = stored(known.join(bounded_broadcast(first, BROADCAST_IDS), "doc_id", "left_semi")
                  .mapInArrow(tk.tidy(_sets(k)), "sig long, tokens binary").dropDuplicates(["sig"]), "sets")
    joined = (pairs.join(sets.select(F.col("sig").alias("a"), F.col("tokens").alias("x")), "a")
              .join(sets.select(F.col("sig").alias("b"), F.col("tokens").alias("y")), "b").select("a", "b", "x", "y"))
    return joined.mapInArrow(tk.tidy(_verify(threshold)), "a long, b long")


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
                     threshold: int = THRESHOLD, row_col: str | None = None) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row, and ``row_col`` (a long) where
    one is named.

    Null and blank texts have an empty set and link with nothing.  Rows with equal sets
    share a class.  Repeated ids are rows of their own.  A row with a null id is kept, but
    links nothing: its component is that of an equal text, else null.  Other columns are
    ignored.  An empty table gives no rows.  ``threshold`` is in percent, 1 to 100.
    """
    spark = docs.sparkSession
    extra = () if row_col is None else (row_col,)
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *extra)
    known = given.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    profile = stored(given.mapInArrow(tk.tidy(_profile(k, extra)), CLASS_SCHEMA + "".join(f", `{c}` long" for c in extra)), "profile")
    classes = stored(profile.where("n_shingles > 0 and doc_id is not null").groupBy("sig")
                     .agg(F.min("doc_id").alias("first_id"), F.min("n_shingles").alias("n"),
                          F.min("sketch").alias("sketch"), F.min("fine").alias("fine")), "classes")

    frequent = spark.sparkContext.broadcast(frequent_tokens(known, k, FREQUENT_ENTRIES))
    rows = known.mapInArrow(tk.tidy(_prefixes(k, threshold, frequent)), "token long, sig long, pos int")
    w = Window.partitionBy("token")
    shared = (rows.withColumn("s0", F.min("sig").over(w)).withColumn("s1", F.max("sig").over(w))
              .where("s0 <> s1").select("token", "sig", "pos").distinct())
    own = Window.partitionBy("sig").orderBy(F.xxhash64("token"), "token")       # at most a prefix
    shared = shared.withColumn("hub", F.row_number().over(own) <= HUB_TOKENS)
    order = Window.partitionBy("sig").orderBy("pos")
    shared = shared.withColumns({c: F.lag("token", i, 0).over(order) for i, c in enumerate(BEFORE, 1)})
    both = stored(shared.join(classes, "sig").select("token", F.col("sig").alias("rep"), "n", "pos", *BEFORE, "sketch", "hub"), "lists")
    lists = both.drop("hub")

    proposed = _closer_pairs(_pairs(both.where("hub").drop("hub"), None, threshold, True), classes, threshold)
    groups = stored(connected_components(_verified(proposed, classes, known, k, threshold)), "groups")
    opened = _closer_pairs(_pairs(lists, groups, threshold, False), classes, threshold)
    second = _verified(opened, classes, known, k, threshold)
    final = connected_components(groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
                                 .where("a <> b").union(second))
    label = classes.join(final, classes.sig == final.node, "left").select(
        "sig", "first_id", F.coalesce("component", "sig").alias("component"))
    smallest = label.groupBy("component").agg(F.min("first_id").alias("component_id"))
    label = label.join(smallest, "component").select("sig", "component_id")
    return (profile.select("doc_id", "n_shingles", "sig", *extra).join(label, "sig", "left")
            .select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id"))
                    .otherwise(F.col("component_id")).alias("component_id"), *extra))
