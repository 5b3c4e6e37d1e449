"""Exact top-k inner products by multi-resolution segment statistics.

A vector is cut into segments; a segment's mean and deviation bound what it adds to an
inner product: ``sum q*v <= L * (mean_q * mean_v + dev_q * dev_v)`` (the distance form is
``L * ((mean_q - mean_v)^2 + (dev_q - dev_v)^2) <= |q - v|^2``).  Summed over segments
this is an inner product of short statistics vectors.  Blocks of queries meet blocks of
rows; resolutions go coarse to fine, each on the pairs the last one left, against the k-th
best score known so far; survivors are scored exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.storage import stored

K = 20
QUERY_EVERY = 20
SCALE = 64
#: Numbers of segments, coarse to fine.
LEVELS = (1, 4, 16)
#: Rows of a packed block; a task holds one query block and a few row blocks.
QUERY_ROWS, DATA_ROWS, DATA_BLOCKS = 1024, 4096, 4
EXACT = 2.0 ** 52


def quantised(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(vec_id, v array<long>, dim)``: floor(64 * x).  Rows with a null id, a null or
    empty vector, or a null or non-finite component take no part, nor do components whose
    product leaves the range of a long."""
    vec = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 2.0 ** 40))
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("v")).where("vec_id is not null and size(v) > 0").where(good)
    return rows.select("vec_id", F.transform("v", lambda x: F.floor(x * SCALE).cast("long")).alias("v"), F.size("v").alias("dim"))


def _pack(size: int):
    """Rows of one dimension and side as packed blocks."""
    def run(it):
        held: dict = {}
        for batch in it:
            ids, dims = batch.column("vec_id").to_numpy(), batch.column("dim").to_numpy()
            flat = batch.column("v").flatten().to_numpy()
            at = np.r_[0, np.cumsum(dims)]
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                m = flat[at[rows][:, None] + np.arange(dim)]
                old = held.get(int(dim))
                ids_, m = (ids[rows], m) if old is None else (np.r_[old[0], ids[rows]], np.r_[old[1], m])
                while len(ids_) >= size:
                    yield one(int(dim), ids_[:size], m[:size])
                    ids_, m = ids_[size:], m[size:]
                held[int(dim)] = ids_, m
        for dim, (ids, m) in held.items():
            if len(ids):
                yield one(dim, ids, m)

    def one(dim, ids, m):
        return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
                                           pa.array([m.astype(np.int64).tobytes()], pa.binary())], names=["dim", "ids", "m"])
    return run


def _stats(m: np.ndarray, parts: int) -> np.ndarray:
    """Statistics whose inner product bounds the vectors' from above."""
    out = []
    for seg in np.array_split(m, min(parts, m.shape[1]), axis=1):
        size = np.sqrt(seg.shape[1])
        out += [seg.mean(1) * size, seg.std(1) * size]
    return np.stack(out, 1)


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products, by floating point where that is exact."""
    if float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1] < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def search_block(q_ids, q, d_ids, d, k: int, floor: np.ndarray):
    """The rows of one data block that can be among the k best: (query row, data row, score).

    ``floor``: a score per query that k rows are known to reach; raised in place.
    """
    if len(d_ids) >= k + 1:     # some k rows (not the query itself) give a first floor
        first = np.where(q_ids[:, None] == d_ids[None, :k + 1], np.iinfo(np.int64).min, _dot(q, d[:k + 1]))
        np.maximum(floor, np.sort(first, axis=1)[:, 1], out=floor)
    alive = q_ids[:, None] != d_ids[None]
    big = max(1.0, float(np.abs(q).max(initial=0)) * float(np.abs(d).max(initial=0)) * q.shape[1])
    slack = 1e-9 * big + 0.5
    for parts in LEVELS:
        if not alive.any():
            break
        rows, cols = np.flatnonzero(alive.any(1)), np.flatnonzero(alive.any(0))
        bound = _stats(q[rows].astype(float), parts) @ _stats(d[cols].astype(float), parts).T
        alive[np.ix_(rows, cols)] &= bound + slack >= floor[rows][:, None]
    rows, cols = np.flatnonzero(alive.any(1)), np.flatnonzero(alive.any(0))
    if not len(rows):
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.int64)
    score = _dot(q[rows], d[cols])
    ok = alive[np.ix_(rows, cols)]
    if len(cols) >= k:
        low = np.iinfo(np.int64).min
        kth = np.partition(np.where(ok, score, low), len(cols) - k, axis=1)[:, len(cols) - k]
        floor[rows] = np.maximum(floor[rows], kth)
    i, j = np.nonzero(ok & (score >= floor[rows][:, None]))
    return rows[i], cols[j], score[i, j]


def _search(k: int):
    def run(key, table):
        side = table.column("side").to_pylist()
        ids = [np.frombuffer(x.as_py(), np.int64) for x in table.column("ids")]
        dim = table.column("dim")[0].as_py()
        ms = [np.frombuffer(x.as_py(), np.int64).reshape(-1, dim) for x in table.column("m")]
        queries = [i for i, s in enumerate(side) if s == 0]
        if not queries or len(side) == 1:
            return empty.slice(0)
        q_ids, q = ids[queries[0]], ms[queries[0]]
        floor = np.full(len(q_ids), np.iinfo(np.int64).min)
        found = []
        for i, s in enumerate(side):
            if s == 1:
                r, c, score = search_block(q_ids, q, ids[i], ms[i], k, floor)
                found.append((r, ids[i][c], score))
        r, v, score = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((v, -score, r))
        r, v, score = r[order], v[order], score[order]
        at = np.flatnonzero(np.r_[True, r[1:] != r[:-1]]) if len(r) else np.zeros(0, int)
        rank = np.arange(len(r)) - np.repeat(at, np.diff(np.r_[at, len(r)]))
        keep = rank < k
        return pa.table({"query_id": pa.array(q_ids[r[keep]]), "vec_id": pa.array(v[keep]), "score": pa.array(score[keep])})
    empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
    return run


def _blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Packed blocks, each with a number of its own."""
    packed = rows.mapInArrow(_pack(size), "dim int, ids binary, m binary")
    return stored(packed.withColumn("block", F.monotonically_increasing_id()), name)


def _numbers(blocks: DataFrame, together: int, name: str) -> DataFrame:
    """``(dim, block, name)``: blocks counted from 0 within a dimension, ``together`` to a
    number.  Two numbers a block are ordered in one task, never its ids or vectors."""
    order = Window.partitionBy("dim").orderBy("block")
    place = F.floor((F.row_number().over(order) - 1) / together).cast("int")
    return stored(blocks.select("dim", "block").withColumn(name, place), name)


def top_k(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, every: int = QUERY_EVERY) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k highest inner products of every row whose
    id is divisible by ``every`` with all rows of another id; ties to the smaller id.

    Only vectors of the query's own dimension are candidates.  Rows that repeat an id are
    candidates of their own, and one of them is the query; a query is never its own id's
    candidate.
    Fewer than k candidates give all; an empty table gives no rows.
    """
    rows = quantised(table, id_col, vec_col)
    data = _blocks(rows, DATA_ROWS, "blocks")
    queries = _blocks(rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"]), QUERY_ROWS, "queries")
    at_q, at_d = _numbers(queries, 1, "qb"), _numbers(data, DATA_BLOCKS, "db")
    q, d = queries.join(at_q, ["dim", "block"]), data.join(at_d, ["dim", "block"])
    sizes = (at_q.groupBy("dim").agg(F.max("qb").alias("nq"))
             .join(at_d.groupBy("dim").agg(F.max("db").alias("nd")), "dim"))
    cells_q = q.join(sizes, "dim").select("dim", "qb", F.explode(F.sequence(F.lit(0), "nd")).alias("db"), F.lit(0).alias("side"), "ids", "m")
    cells_d = d.join(sizes, "dim").select("dim", F.explode(F.sequence(F.lit(0), "nq")).alias("qb"), "db", F.lit(1).alias("side"), "ids", "m")
    found = cells_q.unionByName(cells_d).groupBy("dim", "qb", "db").applyInArrow(
        _search(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
