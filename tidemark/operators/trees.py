"""Random forests and gradient-boosted trees with the usual single-node rules, grown level
by level.

``pyspark.ml`` lacks some of those rules: L1 and L2 penalties and least hessian of boosted
leaves, columns drawn per tree, least rows to split a node, unlimited depth.  Here the
features are binned once and stored; each level of a tree - of all trees of a forest
together - is one aggregation of (node, feature, bin) statistics, a running sum over the
bins of a node's feature, and the best cut per node.  Only those cuts reach the driver.
Forests whose depth does not bound their nodes are grown a tree a task, by the same rules,
from the rows each tree draws; their nodes are stored and never reach the driver.
Features with at most ``BINS`` different values lose nothing by binning.
"""

from __future__ import annotations

import dataclasses
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.exprs import quoted
from tidemark.session import checked_collect, materialize

BINS = 256
BLOCK_ROWS = 65_536
#: Boosting rounds after which the stored margins take in the trees so far.
ABSORB = 20
#: Nodes grown at once, and those of a model that is kept on the driver.
MAX_NODES = 2_000_000
#: Gains nearer than this count as equal; the first feature, then the first cut wins.
GAIN_PLACES = 9


class Tree:
    """A binary tree over bins: ``bin <= cut`` goes left; ``feature`` is -1 in a leaf."""

    def __init__(self):
        self.feature, self.cut, self.left, self.right, self.value = [-1], [0], [0], [0], [0.0]

    def split(self, node: int, feature: int, cut: int) -> tuple[int, int]:
        left = len(self.feature)
        self.feature[node], self.cut[node], self.left[node], self.right[node] = feature, cut, left, left + 1
        for _ in range(2):
            for column, x in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.right, 0), (self.value, 0.0)):
                column.append(x)
        return left, left + 1

    def arrays(self) -> tuple[np.ndarray, ...]:
        return np.array(self.feature, np.int32), np.array(self.cut, np.int32), np.array(self.left, np.int32), np.array(self.right, np.int32)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The node every row of bins ends in."""
        return _leaves(self.arrays(), x)


def _leaves(tree: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
    feature, cut, left, right = tree
    node = np.zeros(len(x), np.int64)
    rows = np.arange(len(x))
    while len(rows):
        rows = rows[feature[node[rows]] >= 0]
        at = node[rows]
        down = x[rows, feature[at]] <= cut[at]
        node[rows] = np.where(down, left[at], right[at])
    return node


@dataclasses.dataclass
class Model:
    """Trees with the cut points of every feature; ``kind`` is ``boosted`` or ``forest``."""

    kind: str
    features: list[str]
    cuts: list[np.ndarray]
    grown: list[Tree] = dataclasses.field(default_factory=list)
    #: The stored trees of a forest that the driver does not hold (``TREES``).
    table: DataFrame | None = None

    @property
    def trees(self) -> list[Tree]:
        """The trees; those of a stored forest are brought here only when asked for."""
        if self.table is not None and not self.grown:
            self.grown = [_tree(r) for r in sorted(self.table.collect(), key=lambda r: r["tree"])]
        return self.grown

    @trees.setter
    def trees(self, trees: list[Tree]) -> None:
        self.grown = trees

    def bins(self, columns: list[np.ndarray]) -> np.ndarray:
        """Bin of every value: the number of cut points below it; a missing one is in the first."""
        return np.column_stack([np.where(np.isnan(v), 0, np.searchsorted(c, v, side="left")).astype(np.uint8)
                                for c, v in zip(self.cuts, columns)])

    def margin(self, x: np.ndarray, start: int = 0) -> np.ndarray:
        out = np.zeros(len(x))
        for tree in self.trees[start:]:
            out += np.array(tree.value)[tree.leaves(x)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = self.margin(x)
        return 1 / (1 + np.exp(-np.clip(total, -700, 700))) if self.kind == "boosted" else total / max(1, len(self.trees))


# ---- binning --------------------------------------------------------------------------
def cut_points(df: DataFrame, features: list[str], bins: int = BINS) -> list[np.ndarray]:
    """Midpoints between the different values of each feature, or between ``bins`` quantiles
    of one with more values.  Infinite values belong to the first and the last bin."""
    value = lambda c: quoted(c).cast("double")
    ok = lambda c: F.when(~F.isnan(value(c)) & (F.abs(value(c)) < float("inf")), value(c))
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), ok(c).alias("v")) for i, c in enumerate(features)])).alias("p"))
    pairs = pairs.select("p.*").where("v is not null").distinct()
    bound = bins * len(features)
    rows = pairs.limit(bound + 1).collect()
    points: list = [[] for _ in features]
    for r in rows if len(rows) <= bound else []:
        points[r["i"]].append(r["v"])
    many = [i for i, p in enumerate(points) if len(p) > bins or len(rows) > bound]
    if many:
        probs = [k / (bins - 1) for k in range(bins)]
        row = df.agg(*[F.percentile_approx(ok(features[i]), probs, 100_000).alias(f"q{i}") for i in many]).first()
        for i in many:
            points[i] = sorted(set(row[f"q{i}"] or []))
    out = []
    for p in points:
        p = np.array(sorted(p))
        out.append((p[:-1] + p[1:]) / 2)
    return out


BLOCKS = "n long, x binary, y binary, w binary, id binary, m binary"


def _blocks(model: Model):
    def run(it):
        p = len(model.features)
        for batch in it:
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(lo, BLOCK_ROWS)
                cols = [c.to_numpy(zero_copy_only=False).astype(float) for c in part.columns[:p + 2]]
                ids = part.columns[p + 2].to_numpy(zero_copy_only=False).astype(np.int64)
                yield _block(model.bins(cols[:p]), cols[p], cols[p + 1], ids, np.zeros(part.num_rows))
    return run


def _block(x, y, w, ids, m):
    cols = [len(y), x.tobytes(), y.tobytes(), w.tobytes(), ids.tobytes(), m.tobytes()]
    kinds = [pa.int64(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cols, kinds)], names=["n", "x", "y", "w", "id", "m"])


def _read(batch, p: int):
    """The stored blocks of a batch as arrays."""
    for i in range(batch.num_rows):
        raw = {c: batch.column(c)[i].as_py() for c in ("x", "y", "w", "id", "m")}
        yield (np.frombuffer(raw["x"], np.uint8).reshape(-1, p), np.frombuffer(raw["y"]), np.frombuffer(raw["w"]),
               np.frombuffer(raw["id"], np.int64), np.frombuffer(raw["m"]))


def binned(df: DataFrame, model: Model, label: str, weight: str | None, key: str) -> DataFrame:
    """The stored blocks of a table: bins, label, weight, key hash, margin.  Rows with a
    null label take no part."""
    cols = [quoted(c).cast("double").alias(f"x{i}") for i, c in enumerate(model.features)]
    rows = df.where(quoted(label).isNotNull()).select(
        *cols, quoted(label).cast("double").alias("y"), (quoted(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
        F.xxhash64(quoted(key)).alias("id"))
    return materialize(rows.mapInArrow(_blocks(model), BLOCKS))


def _uniform(ids: np.ndarray, *salt: int) -> np.ndarray:
    """A number in [0, 1) per row and salt, the same wherever it is computed."""
    x = ids.view(np.uint64).copy()
    for s in salt:
        x ^= np.uint64((s * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(float) / 2.0 ** 53


# ---- one level ------------------------------------------------------------------------
@dataclasses.dataclass
class Rules:
    seed: int = 42
    max_depth: int | None = 6
    # boosting
    learning_rate: float = 0.3
    reg_lambda: float = 1.0
    reg_alpha: float = 0.0
    min_child_weight: float = 1.0
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    # forest
    bootstrap: bool = True
    max_features: str | int | None = "sqrt"
    min_samples_split: int = 2
    min_samples_leaf: int = 1

    def columns(self, kind: str, p: int, tree: int, node: int) -> np.ndarray:
        """Features that a node may be cut by: drawn per tree in boosting, per node in a forest."""
        if kind == "boosted":
            k = max(1, int(self.colsample_bytree * p))
            draw = (self.seed, tree)
        else:
            k = p if self.max_features is None else max(1, int(math.sqrt(p))) if self.max_features == "sqrt" else int(self.max_features)
            draw = (self.seed, tree, node)
        return np.arange(p) if k >= p else np.sort(np.random.default_rng(draw).permutation(p)[:k])


def _statistics(model: Model, growing: dict[int, Tree], open_nodes: dict[int, list[int]], rules: Rules, absorbed: int):
    """``(tree, node, feature, bin, a, b, n)`` of a batch for the open nodes.  Boosting: a, b
    are gradient and hessian; forest: positive and whole weight.  n counts rows."""
    p = len(model.features)
    # once a level and not once a block: the trees as arrays, the open nodes, their features
    shape = {t: tree.arrays() for t, tree in growing.items()}
    nodes = {t: np.array(open_nodes[t], np.int64) for t in growing}
    may = {}
    for t in growing:
        may[t] = np.zeros((len(nodes[t]), p), bool)
        for i, node in enumerate(open_nodes[t]):
            may[t][i, rules.columns(model.kind, p, t, node)] = True

    def run(it):
        for batch in it:
            for x, y, w, ids, m in _read(batch, p):
                if model.kind == "boosted":
                    prob = 1 / (1 + np.exp(-np.clip(m + model.margin(x, absorbed), -700, 700)))
                for t, tree in shape.items():
                    if model.kind == "boosted":
                        a, b = w * (prob - y), w * prob * (1 - prob)
                        take = _uniform(ids, rules.seed, t) < rules.subsample
                    else:
                        times = _poisson(_uniform(ids, rules.seed, t)) if rules.bootstrap else np.ones(len(y))
                        a, b, take = w * y * times, w * times, times > 0
                    place = np.full(len(tree[0]), -1)
                    place[nodes[t]] = np.arange(len(nodes[t]))
                    at = place[_leaves(tree, x)]
                    rows = np.flatnonzero(take & (at >= 0))
                    if not len(rows):
                        continue
                    allowed = may[t]
                    for f in range(p):
                        own = rows[allowed[at[rows], f]]
                        if len(own):
                            code, back = np.unique(at[own] * BINS + x[own, f], return_inverse=True)
                            size = len(code)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(size, t, np.int32)), pa.array(nodes[t].astype(np.int32)[code // BINS]),
                                 pa.array(np.full(size, f, np.int32)), pa.array((code % BINS).astype(np.int32)),
                                 pa.array(np.bincount(back, a[own], size)), pa.array(np.bincount(back, b[own], size)),
                                 pa.array(np.bincount(back, minlength=size).astype(np.int64))],
                                names=["tree", "node", "feature", "bin", "a", "b", "n"])
    return run


def _poisson(u: np.ndarray) -> np.ndarray:
    """How often a row is drawn: Poisson with mean 1 at quantile ``u``."""
    ends = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
    return np.searchsorted(ends, u, side="right").astype(float)


def best_cuts(stats: DataFrame, kind: str, rules: Rules) -> DataFrame:
    """``(tree, node, gain, feature, bin, a, b, n, la, lb, ln)``: each node's best cut with its
    totals and its left part; the gain is null where no cut is allowed."""
    sums = stats.groupBy("tree", "node", "feature", "bin").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("n").alias("n"))
    own = Window.partitionBy("tree", "node", "feature")
    upto = own.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = sums.select("tree", "node", "feature", "bin", *[F.sum(c).over(upto).alias(f"l{c}") for c in "abn"],
                    *[F.sum(c).over(own).alias(c) for c in "abn"])
    ra, rb, rn = (F.col(c) - F.col(f"l{c}") for c in "abn")

    if kind == "boosted":
        def value(g, h):
            pulled = F.greatest(F.abs(g) - rules.reg_alpha, F.lit(0.0))
            return F.coalesce(F.try_divide(pulled * pulled, h + rules.reg_lambda), F.lit(0.0))
        ok = (rn > 0) & (F.col("lb") >= rules.min_child_weight) & (rb >= rules.min_child_weight)
    else:
        def value(pos, all_):
            return F.coalesce(F.try_divide(pos * pos + (all_ - pos) * (all_ - pos), all_), F.lit(0.0))
        ok = (F.col("ln") >= rules.min_samples_leaf) & (rn >= rules.min_samples_leaf) & (rn > 0)
    gain = F.round(value(F.col("la"), F.col("lb")) + value(ra, rb) - value(F.col("a"), F.col("b")), GAIN_PLACES)
    ranked = F.struct(F.when(ok, gain).alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("c"), "a", "b", "n", "la", "lb", "ln")
    best = d.groupBy("tree", "node").agg(F.max(ranked).alias("x"))
    return best.select("tree", "node", "x.gain", (-F.col("x.f")).alias("feature"), (-F.col("x.c")).alias("bin"), "x.a", "x.b", "x.n", "x.la", "x.lb", "x.ln")


def _grow(blocks: DataFrame, model: Model, first: int, count: int, rules: Rules, absorbed: int) -> list[Tree]:
    """Grow ``count`` trees numbered from ``first`` together, one aggregation a level."""
    growing = {first + i: Tree() for i in range(count)}
    open_nodes = {t: [0] for t in growing}
    depth = 0
    while open_nodes:
        active = {t: growing[t] for t in open_nodes}
        stats = blocks.mapInArrow(_statistics(model, active, open_nodes, rules, absorbed),
                                  "tree int, node int, feature int, bin int, a double, b double, n long")
        following: dict[int, list[int]] = {}
        rows = checked_collect(best_cuts(stats, model.kind, rules), MAX_NODES, "tree nodes")
        for r in sorted(rows, key=lambda r: (r["tree"], r["node"])):
            tree = growing[r["tree"]]
            tree.value[r["node"]] = _leaf(model.kind, r["a"], r["b"], rules)
            if rules.max_depth is not None and depth >= rules.max_depth or not _splits(model.kind, r, rules):
                continue
            left, right = tree.split(r["node"], r["feature"], r["bin"])
            tree.value[left] = _leaf(model.kind, r["la"], r["lb"], rules)
            tree.value[right] = _leaf(model.kind, r["a"] - r["la"], r["b"] - r["lb"], rules)
            following.setdefault(r["tree"], []).extend([left, right])
        depth += 1
        open_nodes = following if rules.max_depth is None or depth < rules.max_depth else {}
    return list(growing.values())


# ---- a tree a task --------------------------------------------------------------------
DRAWN = "tree int, x binary, y binary, w binary, times binary"
TREES = "tree int, feature binary, cut binary, child binary, value binary"
TREE_TYPES = (("feature", np.int32), ("cut", np.int32), ("child", np.int32), ("value", np.float64))


def _tree(r) -> Tree:
    tree = Tree()
    feature, cut, child, value = (np.frombuffer(r[c], kind) for c, kind in TREE_TYPES)
    tree.feature, tree.cut, tree.left = feature.tolist(), cut.tolist(), child.tolist()
    tree.right, tree.value = np.where(child > 0, child + 1, 0).tolist(), value.tolist()
    return tree


def _batch(names: list[str], columns: list[list], first=pa.int32()) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, first if i == 0 else pa.binary()) for i, c in enumerate(columns)], names=names)


def _draws(p: int, count: int, rules: Rules):
    """What each tree draws of a batch of blocks."""
    def run(it):
        for batch in it:
            for x, y, w, ids, _ in _read(batch, p):
                for t in range(count):
                    times = _poisson(_uniform(ids, rules.seed, t)) if rules.bootstrap else np.ones(len(y))
                    own = times > 0
                    yield _batch(["tree", "x", "y", "w", "times"], [[t], *[[v.tobytes()] for v in (x[own], y[own], w[own], times[own].astype(np.uint8))]])
    return run


def _gains(a, b, n, rules: Rules):
    """``(place, gain)`` of the best cut of each row of running sums over bins; ``n`` does not
    grow where a row has no bin.  The gain is -inf where no cut is allowed."""
    def value(pos, all_):
        return np.divide(pos * pos + (all_ - pos) * (all_ - pos), all_, out=np.zeros_like(all_), where=all_ != 0)
    wa, wb, wn = a[:, -1:], b[:, -1:], n[:, -1:]
    least = max(1, rules.min_samples_leaf)
    ok = (n >= rules.min_samples_leaf) & (wn - n >= least)
    gain = np.where(ok, np.round(value(a, b) + value(wa - a, wb - b) - value(wa, wb), GAIN_PLACES), -np.inf)
    place = gain.argmax(axis=1)
    return place, gain[np.arange(len(gain)), place]


def _best_of_feature(node, bins, a, b, rules: Rules):
    """``(node, gain, bin)`` of the best cut of each node by one feature."""
    code, back = np.unique(node.astype(np.int64) * BINS + bins, return_inverse=True)
    sums = [np.bincount(back, v, len(code)) for v in (a, b)] + [np.bincount(back, minlength=len(code))]
    of = code // BINS
    start = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    many = np.diff(np.r_[start, len(code)])
    gains, cuts = np.full(len(start), -np.inf), np.zeros(len(start), np.int32)
    width = 2                                                    # nodes with about as many bins at once; one bin has no cut
    while width // 2 < many.max():
        some = np.flatnonzero((many > width // 2) & (many <= width))
        for part in np.array_split(some, max(1, len(some) * width // 2_000_000)) if len(some) else []:
            at, there = start[part][:, None] + np.arange(width), np.arange(width) < many[part][:, None]
            at = np.where(there, at, 0)
            place, gains[part] = _gains(*[np.cumsum(np.where(there, v[at], 0), axis=1) for v in sums], rules)
            cuts[part] = code[start[part] + place] % BINS
        width *= 2
    return of[start], gains, cuts


def _grow_alone(x, a, b, t: int, rules: Rules) -> list[np.ndarray]:
    """The columns of ``TREES`` of one tree, level by level, from the rows it draws."""
    p = x.shape[1]
    levels, size, depth = [], 1, 0
    node, open_nodes = np.zeros(len(a), np.int64), np.zeros(1, np.int64)
    while len(open_nodes):
        m = len(open_nodes)
        wa, wb, n = np.bincount(node, a, m), np.bincount(node, b, m), np.bincount(node, minlength=m)
        value = np.divide(wa, wb, out=np.zeros(m), where=wb > 0)
        feature, cut, child, gain = np.full(m, -1, np.int32), np.zeros(m, np.int32), np.zeros(m, np.int32), np.full(m, -np.inf)
        may = np.zeros((m, p), bool)
        if rules.max_depth is None or depth < rules.max_depth:
            for i in np.flatnonzero((np.minimum(wa, wb - wa) > 1e-9) & (n >= rules.min_samples_split)):
                may[i, rules.columns("forest", p, t, int(open_nodes[i]))] = True
        for f in range(p):
            own = np.flatnonzero(may[node, f])
            if len(own):
                at, g, c = _best_of_feature(node[own], x[own, f], a[own], b[own], rules)
                better = g > gain[at]
                at = at[better]
                feature[at], cut[at], gain[at] = f, c[better], g[better]
        split = gain >= 0
        feature[~split], cut[~split] = -1, 0
        left = 2 * (np.cumsum(split) - 1)
        child[split] = size + left[split]
        levels.append((feature, cut, child, value))
        keep = np.flatnonzero(split[node])
        at = node[keep]
        node = left[at] + (x[keep, feature[at]] > cut[at])
        x, a, b = x[keep], a[keep], b[keep]
        open_nodes = np.arange(size, size + 2 * int(split.sum()))
        size, depth = size + len(open_nodes), depth + 1
    return [np.concatenate(c).astype(kind) for c, (_, kind) in zip(zip(*levels), TREE_TYPES)]


def _grow_apart(p: int, rules: Rules):
    """The trees of a partition of ``DRAWN``, sorted by tree; one is held at a time."""
    names = ["tree", *[c for c, _ in TREE_TYPES]]

    def grown(t, parts):
        x, y, w, times = (np.concatenate(c) for c in zip(*parts))
        parts.clear()
        b = w * times
        return _batch(names, [[t], *[[c.tobytes()] for c in _grow_alone(x, b * y, b, t, rules)]])

    def run(it):
        last, parts = None, []
        for batch in it:
            for i in range(batch.num_rows):
                t, x, y, w, times = (batch.column(c)[i].as_py() for c in ("tree", "x", "y", "w", "times"))
                if t != last and parts:
                    yield grown(last, parts)
                last = t
                parts.append((np.frombuffer(x, np.uint8).reshape(-1, p), np.frombuffer(y), np.frombuffer(w), np.frombuffer(times, np.uint8)))
        if parts:
            yield grown(last, parts)
    return run


def _forest_apart(blocks: DataFrame, model: Model, count: int, rules: Rules) -> DataFrame:
    drawn = blocks.mapInArrow(_draws(len(model.features), count, rules), DRAWN)
    table = materialize(drawn.repartition(count, "tree").sortWithinPartitions("tree").mapInArrow(_grow_apart(len(model.features), rules), TREES))
    # without rows there are no draws: leaves that say 0, as of a tree without splits
    blank = [bytearray(np.zeros(1, k) if c != "feature" else np.full(1, -1, k)) for c, k in TREE_TYPES]
    missing = sorted(set(range(count)) - {r["tree"] for r in table.select("tree").collect()})
    return table.union(blocks.sparkSession.createDataFrame([(t, *blank) for t in missing], TREES)) if missing else table


def _predict_apart(model: Model, given: DataFrame, names: list[str], out: str) -> DataFrame:
    """``predict`` for stored trees: every block of rows meets every tree in the tree's task,
    and the tree's values are summed by block in the order of the trees."""
    p, cuts = len(model.features), Model(model.kind, model.features, model.cuts)
    count = model.table.count()
    rows = materialize(given.withColumn("_row", F.monotonically_increasing_id()))

    def blocks(it):
        for batch in it:
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(lo, BLOCK_ROWS)
                ids = part.column("_row").to_numpy(zero_copy_only=False).astype(np.int64)
                x = cuts.bins([c.to_numpy(zero_copy_only=False).astype(float) for c in part.columns[1:]])
                yield _batch(["block", "x", "ids"], [[int(ids[0])], [x.tobytes()], [ids.tobytes()]], pa.int64())

    def scores(it):
        tree = value = None
        for batch in it:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if r["block"] is None:
                    feature, cut, child, value = (np.frombuffer(r[c], kind) for c, kind in TREE_TYPES)
                    tree = feature, cut, child, child + 1
                else:
                    got = value[_leaves(tree, np.frombuffer(r["x"], np.uint8).reshape(-1, p))]
                    yield pa.RecordBatch.from_arrays([pa.array([r["block"]], pa.int64()), pa.array([r["tree"]], pa.int32()), pa.array([got.tobytes()], pa.binary())],
                                                     names=["block", "tree", "v"])

    def sums(it):
        block, total, ids = None, None, None

        def done():
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total / max(1, count))], names=["_row", "_score"])
        for batch in it:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i].as_py() for c in ("block", "tree", "v")}
                if r["tree"] < 0:                                # the block's row ids come first
                    if block is not None:
                        yield done()
                    block, ids = r["block"], np.frombuffer(r["v"], np.int64)
                    total = np.zeros(len(ids))
                else:
                    total += np.frombuffer(r["v"])
        if block is not None:
            yield done()

    table = materialize(rows.select("_row", *[f"_x{i}" for i in range(p)]).mapInArrow(blocks, "block long, x binary, ids binary"))
    null = F.lit(None)
    each = table.select(F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("tree"), "block", "x", *[null.cast("binary").alias(c) for c, _ in TREE_TYPES])
    trees = model.table.select("tree", null.cast("long").alias("block"), null.cast("binary").alias("x"), *[c for c, _ in TREE_TYPES])
    met = trees.union(each).repartition(count, "tree").sortWithinPartitions("tree", F.asc_nulls_first("block"))
    parts = met.mapInArrow(scores, "block long, tree int, v binary").union(table.select("block", F.lit(-1).alias("tree"), F.col("ids").alias("v")))
    total = parts.repartition("block").sortWithinPartitions("block", "tree").mapInArrow(sums, "_row long, _score double")
    return rows.join(total, "_row").select(*[f"_c{i}" for i in range(len(names))], "_score").toDF(*names, out)


def _splits(kind: str, r, rules: Rules) -> bool:
    if r["gain"] is None:
        return False
    if kind == "boosted":
        return r["gain"] > 1e-6
    impure = min(r["a"], r["b"] - r["a"]) > 1e-9
    return impure and r["n"] >= rules.min_samples_split and r["gain"] >= 0


def _leaf(kind: str, a: float, b: float, rules: Rules) -> float:
    if kind == "forest":
        return a / b if b > 0 else 0.0
    pulled = math.copysign(max(abs(a) - rules.reg_alpha, 0.0), a)
    return -rules.learning_rate * pulled / (b + rules.reg_lambda) if b + rules.reg_lambda > 0 else 0.0


# ---- learners -------------------------------------------------------------------------
def fit_boosted(df: DataFrame, features: list[str], label: str = "churn", key: str = "row_key", n_estimators: int = 100,
                max_depth: int = 6, learning_rate: float = 0.3, subsample: float = 1.0, colsample_bytree: float = 1.0,
                reg_lambda: float = 1.0, reg_alpha: float = 0.0, min_child_weight: float = 1.0, seed: int = 42,
                weight: str | None = None) -> Model:
    """M6: gradient-boosted trees on the logistic loss, leaf penalties included.

    ``key`` decides which rows a tree draws with ``subsample`` below 1.  Missing values go
    with the smallest.  No rows give trees that score one half."""
    rules = Rules(seed, max_depth, learning_rate, reg_lambda, reg_alpha, min_child_weight, subsample, colsample_bytree)
    model = Model("boosted", list(features), cut_points(df, features))
    blocks, absorbed = binned(df, model, label, weight, key), 0
    for i in range(n_estimators):
        model.trees += _grow(blocks, model, i, 1, rules, absorbed)
        if len(model.trees) - absorbed >= ABSORB and i + 1 < n_estimators:
            blocks, absorbed = materialize(blocks.mapInArrow(_absorb(model, absorbed), BLOCKS)), len(model.trees)
    return model


def _absorb(model: Model, absorbed: int):
    def run(it):
        for batch in it:
            for x, y, w, ids, m in _read(batch, len(model.features)):
                yield _block(x, y, w, ids, m + model.margin(x, absorbed))
    return run


def fit_forest(df: DataFrame, features: list[str], label: str = "churn", key: str = "row_key", n_estimators: int = 100,
               max_depth: int | None = None, min_samples_split: int = 2, min_samples_leaf: int = 1,
               max_features: str | int | None = "sqrt", bootstrap: bool = True, seed: int = 42, weight: str | None = None) -> Model:
    """M5: a random forest by Gini impurity, all trees grown together.

    A row is drawn for a tree as often as a Poisson number from its ``key`` says; a node is
    cut while it is impure, has ``min_samples_split`` drawn rows and a cut that leaves
    ``min_samples_leaf`` on either side, to any depth unless ``max_depth`` is given.  Where
    the depth does not bound the nodes, a task holds the rows a tree draws (a byte a feature
    and some 80 more each) and the trees are stored."""
    rules = Rules(seed, max_depth, bootstrap=bootstrap, max_features=max_features, min_samples_split=min_samples_split,
                  min_samples_leaf=min_samples_leaf)
    model = Model("forest", list(features), cut_points(df, features))
    blocks = binned(df, model, label, weight, key)
    if max_depth is None or n_estimators << min(max_depth, 40) > MAX_NODES:
        model.table = _forest_apart(blocks, model, n_estimators, rules)
    else:
        model.trees = _grow(blocks, model, 0, n_estimators, rules, 0)
    return model


def predict(model: Model, df: DataFrame, out: str = "proba") -> DataFrame:
    """``df`` with the probability of class 1 in ``out``."""
    rest = df.drop(out)
    # plain names inside: columns may be called anything
    given = rest.select(*[quoted(c).cast("double").alias(f"_x{i}") for i, c in enumerate(model.features)],
                        *[quoted(c).alias(f"_c{i}") for i, c in enumerate(rest.columns)])
    if model.table is not None:
        return _predict_apart(model, given, rest.columns, out)
    shared = df.sparkSession.sparkContext.broadcast(model)      # the model, whatever the rows

    def run(it):
        m = shared.value
        p = len(m.features)
        for batch in it:
            cols = [c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns[:p]]
            score = m.probability(m.bins(cols)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[p:], pa.array(score)], names=[*batch.schema.names[p:], "_score"])

    kept = [T.StructField(f"_c{i}", f.dataType) for i, f in enumerate(rest.schema.fields)]
    return given.mapInArrow(run, T.StructType([*kept, T.StructField("_score", T.DoubleType())])).toDF(*rest.columns, out)
