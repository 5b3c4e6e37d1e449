"""Exact integer k-means by dimension-sharded Lloyd rounds.

Vectors are cut into blocks of rows and shards of columns.  In a round a task on a column
block computes the exact partial squared distances to its slice of every centroid;
``reduceByKey`` adds the blocks of one row group, whose argmin is the assignment.  The
assignments return to the column blocks (which stay where they are: both sides share one
partitioning), each shard sums its own columns per cluster and updates its own slice.
Only slices (k * dimension numbers) reach the driver, to be shipped with the next round.

The blocks are a Parquet table in the shared folder and a cache above it; a lost executor
costs the recomputation of its blocks.  All arithmetic is on integers: 64-bit where the
largest component and the number of vectors prove that no sum overflows, else unbounded.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.storage import stored

DIM, K, ROUNDS, SEED, SCALE = 64, 8, 10, 3, 1024
#: Column shards, and rows of a block.
SHARDS, BLOCK_ROWS = 4, 1024
#: Bytes of blocks in one partition, at most, about.
PART_BYTES = 64_000_000
#: Differences of components below this square and add up within 64 bits (dimension <= 64).
SMALL = 2.0 ** 27

OUTPUT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def quantised(table: DataFrame, id_col: str, vec_col: str, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """``(vec_id, v array<double>)``: floor(scale * x) of the vectors with exactly ``dim``
    components, none null or non-finite.  ``scale`` is a power of two and 2^53 and more are
    integers already, so the doubles are exact."""
    vec = F.transform(F.col(vec_col), lambda x: x.cast("double") * F.lit(float(scale)))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("v")).where(F.size("v") == dim).where(good)
    whole = F.transform("v", lambda x: F.when(F.abs(x) < 2.0 ** 53, F.floor(x).cast("double")).otherwise(x))
    return rows.select("vec_id", whole.alias("v"))


def first_centroids(vectors: DataFrame, k: int = K, seed: int = SEED) -> list[list[int]]:
    """The ``k`` vectors with the smallest sha256 of ``<seed>:<vec_id>``, in that order;
    rows that repeat an id follow each other by their components."""
    sha = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.where("vec_id is not null").withColumn("sha", sha).orderBy("sha", "v").limit(k).collect()
    return [[int(x) for x in r["v"]] for r in rows]


def _cuts(dim: int, shards: int) -> list[tuple[int, int]]:
    """Column ranges of the shards."""
    ends = [dim * i // shards for i in range(shards + 1)]
    return list(zip(ends[:-1], ends[1:]))


def _blocks(dim: int, shards: int):
    """Rows of a task as blocks of ``BLOCK_ROWS`` rows by one shard's columns."""
    def run(it):
        task, seq = TaskContext.get().partitionId(), 0
        for batch in it:
            ids = batch.column("vec_id").to_pylist()
            flat = batch.column("v").flatten().to_numpy().reshape(len(ids), dim)
            for lo in range(0, len(ids), BLOCK_ROWS):
                own, part = ids[lo:lo + BLOCK_ROWS], flat[lo:lo + BLOCK_ROWS]
                most = float(np.abs(part).max())
                rows = [(task, seq, s, len(own), own if s == 0 else None, most, np.ascontiguousarray(part[:, a:b]).tobytes())
                        for s, (a, b) in enumerate(_cuts(dim, shards))]
                cols = list(zip(*rows))
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.float64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                                 names=["task", "seq", "shard", "n", "ids", "most", "data"])
                seq += 1
    return run


def _matrix(data: bytes, n: int, exact: bool) -> np.ndarray:
    m = np.frombuffer(data, np.float64).reshape(n, -1)
    if not exact:
        return m.astype(np.int64)
    return np.array([[int(x) for x in row] for row in m], dtype=object).reshape(m.shape)


def _slice(centroids, cut, exact: bool) -> np.ndarray:
    return np.array([c[cut[0]:cut[1]] for c in centroids], dtype=object if exact else np.int64)


def partial_distances(m: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances over one shard's columns: a row of ``m`` to each row of ``c``."""
    out = np.empty((len(m), len(c)), dtype=m.dtype)
    for i, own in enumerate(c):
        diff = m - own
        out[:, i] = (diff * diff).sum(axis=1)
    return out


def slice_sums(m: np.ndarray, assign: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Members and component sums of each cluster."""
    sums = np.zeros((k, m.shape[1]), dtype=m.dtype)
    np.add.at(sums, assign, m)
    return np.bincount(assign, minlength=k), sums


def updated(old: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> list[list[int]]:
    """Floor of sum / count; an empty cluster keeps its slice."""
    return [[int(s) // int(n) for s in row] if n else [int(x) for x in was] for was, n, row in zip(old, counts, sums)]


class Lloyd:
    """Column blocks of a stored table, and the rounds over them."""

    def __init__(self, blocks: DataFrame, dim: int, shards: int, parts: int, exact: bool):
        self.cuts, self.parts, self.exact = _cuts(dim, shards), parts, exact
        rows = blocks.select("task", "seq", "shard", "n", "ids", "data").rdd
        keyed = rows.map(lambda r: ((r[0], r[1], r[2]), (r[3], r[4], bytes(r[5]))))
        self.blocks = keyed.partitionBy(parts).persist(StorageLevel.MEMORY_AND_DISK)

    def distances(self, centroids):
        """``((task, seq), (ids, distances))``: the shards' partial distances, added."""
        cuts, exact = self.cuts, self.exact

        def partial(item):
            (task, seq, shard), (n, ids, data) = item
            return (task, seq), (ids, partial_distances(_matrix(data, n, exact), _slice(centroids, cuts[shard], exact)))

        return self.blocks.map(partial).reduceByKey(lambda a, b: (a[0] or b[0], a[1] + b[1]), self.parts)

    def round(self, centroids):
        """The centroids after one assignment and update."""
        cuts, exact, k = self.cuts, self.exact, len(centroids)
        assigned = self.distances(centroids).mapValues(lambda x: x[1].argmin(axis=1).astype(np.int32))
        sent = assigned.flatMap(lambda x: [((*x[0], s), x[1]) for s in range(len(cuts))])

        def sums(it):
            held: dict = {}
            for (_, _, shard), ((n, _, data), assign) in it:
                counts, total = slice_sums(_matrix(data, n, exact), assign, k)
                if shard in held:
                    counts, total = held[shard][0] + counts, held[shard][1] + total
                held[shard] = counts, total
            return iter(held.items())

        joined = self.blocks.join(sent.partitionBy(self.parts), self.parts)
        per_shard = joined.mapPartitions(sums).reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1]), len(cuts))
        slices = dict(per_shard.map(lambda x: (x[0], updated(_slice(centroids, cuts[x[0]], exact), *x[1]))).collect())
        return [[v for s in range(len(cuts)) for v in slices[s][i]] for i in range(k)]


def _final(item):
    """Ids, clusters, distances and inertia per cluster of one row group."""
    ids, dist = item[1]
    cluster = dist.argmin(axis=1)
    best = dist[np.arange(len(dist)), cluster]
    sums = [sum(int(x) for x in best[cluster == c]) for c in range(dist.shape[1])]
    fits = [int(x) if x < 2 ** 63 else None for x in best]
    return ids, [int(c) for c in cluster], fits, [str(s) for s in sums]


def lloyd(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dim: int = DIM, k: int = K, rounds: int = ROUNDS,
          seed: int = SEED, scale: int = SCALE, shards: int = SHARDS) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of every
    vector of exactly ``dim`` components, none null or non-finite; others take no part.

    Components become floor(scale * x).  Centroids start as the ``k`` vectors with the
    smallest sha256 of ``<seed>:<vec_id>`` (fewer vectors, fewer centroids; a null id is
    never one).  Each round assigns every vector to the nearest centroid (ties: smaller
    number) and replaces each non-empty one by the floor of its vectors' mean; then vectors
    are assigned once more.  Rows that repeat an id or a vector count each.  A distance or
    inertia beyond a long is null, though it is compared exactly.  Without a vector there
    are no rows; if all ids are null there is no centroid, and the other columns are null.
    """
    spark = table.sparkSession
    shards = min(shards, dim)
    vectors = quantised(table, id_col, vec_col, dim, scale)
    start = first_centroids(vectors, k, seed)
    if not start:
        empty = vectors.select("vec_id")
        for name, kind in (f.split() for f in OUTPUT.split(", ")[1:]):
            empty = empty.withColumn(name, F.lit(None).cast(kind))
        return empty
    blocks = stored(vectors.mapInArrow(_blocks(dim, shards), "task long, seq long, shard int, n long, ids array<long>, "
                                                             "most double, data binary"), "blocks")
    most, count = blocks.where("shard = 0").agg(F.max("most"), F.sum("n")).first()
    exact = dim > 64 or most >= SMALL or most * count >= 2.0 ** 62
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count * dim * 8 // PART_BYTES))
    job = Lloyd(blocks, dim, shards, parts, exact)
    centroids = start
    for _ in range(rounds):
        centroids = job.round(centroids)
    rows = stored(spark.createDataFrame(job.distances(centroids).map(_final),
                                        "ids array<long>, cluster array<int>, distance array<long>, sums array<string>"), "assigned")
    job.blocks.unpersist()
    return _report(spark, rows, centroids)


def _report(spark: SparkSession, rows: DataFrame, centroids) -> DataFrame:
    each = rows.select(F.posexplode("sums").alias("cluster", "s"))
    inertia = {r[0]: r[1] for r in each.groupBy("cluster").agg(F.sum(F.col("s").try_cast("decimal(38,0)"))).collect()}
    long = lambda x: int(x) if x is not None and x < 2 ** 63 else None
    total = None if None in inertia.values() else sum(inertia.values())
    about = [(c, long(inertia.get(c)), long(total), hashlib.sha256(",".join(map(str, own)).encode()).hexdigest())
             for c, own in enumerate(centroids)]
    table = spark.createDataFrame(about, "c int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = rows.select(F.explode(F.arrays_zip("ids", "cluster", "distance")).alias("x"))
    out = out.select(F.col("x.ids").alias("vec_id"), F.col("x.cluster").alias("cluster"), F.col("x.distance").alias("distance"))
    return out.join(F.broadcast(table), F.col("cluster") == F.col("c")).drop("c")     # one row per centroid


def _sql(dim: int = DIM, k: int = K, rounds: int = ROUNDS, seed: int = SEED, scale: int = SCALE) -> str:
    """The rounds written out in DuckDB SQL."""
    parts = [f"""e AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, sha256('{seed}:' || vec_id) AS sha,
    list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             f"""c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha, v) - 1 AS INTEGER) AS cluster, v AS c
  FROM (SELECT sha, v FROM e ORDER BY sha, v LIMIT {k}))"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT rid, any_value(vec_id) AS vec_id, any_value(v) AS v, min({{'d': CAST(list_sum(
    list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT), 'c': cluster}}) AS m FROM e, c{i} GROUP BY rid)""")
        if i < rounds:
            parts.append(f"""u{i} AS (SELECT m.c AS cluster, i, sum(v[i]) AS s, count(*) AS n FROM a{i}, range(1, {dim + 1}) r(i) GROUP BY m.c, i),
c{i + 1} AS MATERIALIZED (SELECT c{i}.cluster, coalesce(w.c, c{i}.c) AS c FROM c{i} LEFT JOIN (
  SELECT cluster, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM u{i} GROUP BY cluster) w USING (cluster))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, m.c AS cluster, m.d AS distance, CAST(sum(m.d) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(m.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON m.c = cluster"""


SQL = _sql()
