"""Random forests whose trees are each grown whole by one task.

MLlib grows all trees of a forest level by level: at each level every partition
makes and sends sums for all open nodes, and the driver holds each node as an
object. Where a worker can hold the binned features of all rows, one byte a
value, a task needs only those and a seed. The trees follow MLlib's rules: 32
bins by its thresholds (found over all rows instead of 10,000), Poisson bags,
Gini, new features drawn at each node, no split without gain, sibling leaves of
one prediction merged. The draws themselves are others.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Workers get this module's functions by value, wherever the package lies.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 32
#: Sums hold the rows' weights below this and the weights of the class's rows above: exact up to 2 ** 26 rows.
CLASS = float(2**26)
#: In place of a leaf's feature.
LEAF = 65535
#: Trees of a task; open nodes whose sums are made together.
TREES_A_TASK, NODES = 4, 4096


def thresholds(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """At most 31 cuts between ascending values: all midpoints, or those nearest to equal shares of the rows."""
    if len(values) <= BINS:
        cuts = (values[:-1] + values[1:]) / 2
    else:
        upto = np.cumsum(counts)
        between, stride = (upto[:-1] + upto[1:]) / 2, upto[-1] / BINS
        found, k, target = [], 0, stride
        while (k := max(k, int(np.searchsorted(between, target, "right")))) < len(between):
            found.append((values[k] + values[k + 1]) / 2)
            k, target = k + 1, target + stride
        cuts = np.array(found)
    return cuts[~np.isnan(cuts)]


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Cuts below each value, by row; a NaN is above all."""
    out = np.empty(x.shape, np.uint8)
    for k, c in enumerate(cuts):
        out[:, k] = np.searchsorted(c, np.ascontiguousarray(x[:, k]), "left")
    return out


def _splits(flat, at, node, sums, pos, tot, width, tries, rng):
    """The best split of each open node: its cost (infinite if there is none), feature and bin, and the left child's sums."""
    k = len(pos)
    each = np.arange(k)
    drawn = np.argpartition(rng.random((k, width), dtype=np.float32), tries - 1, axis=1)[:, :tries] if tries < width else np.broadcast_to(np.arange(width), (k, width))
    best, left_pos, left_tot = np.full(k, np.inf), np.zeros(k), np.zeros(k)
    feature, cut = np.zeros(k, np.int64), np.zeros(k, np.int64)
    base = node * BINS
    for s in range(tries):
        f = drawn[:, s]
        h = np.bincount(base + flat.take(at + f.take(node)), weights=sums, minlength=k * BINS).reshape(k, BINS)
        upto = np.cumsum(h, axis=1)[:, :-1]
        lp = np.floor(upto / CLASS)
        lt = upto - lp * CLASS
        rp, rt = pos[:, None] - lp, tot[:, None] - lt
        with np.errstate(divide="ignore", invalid="ignore"):
            cost = lp * (lt - lp) / lt + rp * (rt - rp) / rt
        cost[(lt <= 0) | (rt <= 0)] = np.inf
        j = cost.argmin(axis=1)
        better = cost[each, j] < best
        best = np.where(better, cost[each, j], best)
        feature, cut = np.where(better, f, feature), np.where(better, j, cut)
        left_pos, left_tot = np.where(better, lp[each, j], left_pos), np.where(better, lt[each, j], left_tot)
    return best, feature, cut, left_pos, left_tot


def grow(bins: np.ndarray, mine: np.ndarray, weights: np.ndarray, tries: int, depth: int, rng: np.random.Generator):
    """A tree as (features, arguments, other leaves' probabilities), and its importances.

    Nodes are listed level by level: a split's argument is the last bin of its
    left child, a leaf's is its probability if that is 0 or 1, otherwise 2.
    """
    width = bins.shape[1]
    flat = bins.reshape(-1)
    rows = np.flatnonzero(weights)
    sums = weights[rows] * np.where(mine[rows], CLASS + 1, 1.0)
    at, node = rows * width, np.zeros(len(rows), np.int64)
    pos = np.array([float(weights[mine].sum())])
    tot = np.array([float(weights.sum())])
    levels = []
    for level in range(depth + 1):
        feature, cut, worth = np.full(len(pos), LEAF, np.int64), np.zeros(len(pos), np.int64), np.zeros(len(pos))
        levels.append((feature, cut, worth, pos, tot))
        opened = np.flatnonzero((pos > 0) & (pos < tot))
        if level == depth or not len(opened):
            break
        op, ot = pos[opened], tot[opened]
        found = []
        for a in range(0, len(opened), NODES):
            b = min(a + NODES, len(opened))
            here = (node >= a) & (node < b) if len(opened) > NODES else slice(None)
            found.append(_splits(flat, at[here], node[here] - a, sums[here], op[a:b], ot[a:b], width, tries, rng))
        best, f, c, lp, lt = (np.concatenate(x) for x in zip(*found))
        before = op * (ot - op) / ot
        ok = best < before * (1 - 1e-12)
        split = opened[ok]
        feature[split], cut[split], worth[split] = f[ok], c[ok], 2 * (before - best)[ok]
        pos = np.stack([lp, op - lp], 1)[ok].ravel()
        tot = np.stack([lt, ot - lt], 1)[ok].ravel()
        # Rows go on to the children that stay open.
        stays = (pos > 0) & (pos < tot)
        number = np.append(np.where(stays, np.cumsum(stays) - 1, -1), -1)
        first = np.where(ok, 2 * np.cumsum(ok) - 2, len(pos))
        child = first.take(node) + (ok.take(node) & (flat.take(at + f.take(node)) > c.take(node)))
        node = number.take(child)
        keep = node >= 0
        node, at, sums = node[keep], at[keep], sums[keep]
    for (feature, *_), (below, _, _, pos, tot) in zip(levels[-2::-1], levels[:0:-1]):  # from the leaves up
        split = np.flatnonzero(feature != LEAF)
        leaf, guess = (below == LEAF).reshape(-1, 2), (2 * pos > tot).reshape(-1, 2)
        feature[split[leaf.all(axis=1) & (guess[:, 0] == guess[:, 1])]] = LEAF
    importance = np.zeros(width)
    parts, kept = [], np.ones(1, bool)
    for feature, cut, worth, pos, tot in levels:
        f, c, p = feature[kept], cut[kept], (pos / np.maximum(tot, 1))[kept]
        inner = f != LEAF
        importance += np.bincount(f[inner], weights=worth[kept][inner], minlength=width)
        parts.append((f, np.where(inner, c, np.where(p == 0, 0, np.where(p == 1, 1, 2))), p[~inner & (p > 0) & (p < 1)]))
        split = np.flatnonzero(worth > 0)  # as grown
        kept = np.repeat(kept[split] & (feature[split] != LEAF), 2)
    f, arg, other = (np.concatenate(x) for x in zip(*parts))
    return f.astype(np.uint16), arg.astype(np.uint8), other, importance / (importance.sum() or 1.0)


def vote(tree: tuple, bins: np.ndarray, into: np.ndarray) -> None:
    """Adds each row's leaf probability."""
    feature, arg, other = tree
    inner = feature != LEAF
    child = 2 * np.cumsum(inner) - 1
    value = arg.astype(float)
    value[~inner & (arg == 2)] = other
    n, width = bins.shape
    flat, row, node = bins.reshape(-1), np.arange(n), np.zeros(n, np.int64)
    at = row * width
    while len(row):
        f = feature.take(node)
        done = f == LEAF
        if done.any():
            into[row[done]] += value.take(node[done])
            row, node, at, f = row[~done], node[~done], at[~done], f[~done]
        node = child.take(node) + (flat.take(at + f) > arg.take(node))


def draws(width: int) -> int:
    """Features tried at a node, as MLlib's ``sqrt``."""
    return ceil(sqrt(width))


def generator(seed: int, value, tree: int) -> np.random.Generator:
    return np.random.default_rng([seed & 0xFFFFFFFF, zlib.crc32(repr(value).encode()), tree])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an array column; NaN for null."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(-1, width)


@dataclass
class Forest:
    """A class's forest: the driver holds three bytes a node, and eight for a leaf of both kinds."""

    features: list[str]
    cuts: list[np.ndarray]
    trees: list[tuple]


@dataclass
class Table:
    """Binned rows that all workers hold, in an order that goes by their content."""

    features: list[str]
    cuts: list[np.ndarray]
    values: list
    shared: object  # broadcast of bins, class codes and folds
    spark: object

    def close(self) -> None:
        self.shared.destroy()

    def run(self, tasks: list, work, schema: str) -> list:
        """``work(bins, codes, folds, task)`` for each task, in their order; its result is a tuple by the schema."""
        shared = self.shared
        types = [pa.binary() if t.endswith("binary") else pa.list_(pa.float64()) for t in schema.split(", ")]

        def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in batch.column(0).to_pylist():
                    out = work(*shared.value, tasks[k])
                    yield pa.RecordBatch.from_arrays([pa.array([k]), *[pa.array([v], t) for v, t in zip(out, types)]], names=["task", *[c.split()[0] for c in schema.split(", ")]])

        n = len(tasks)
        return [r[1:] for r in sorted(self.spark.range(0, n, 1, n).mapInArrow(worker, f"task long, {schema}").collect(), key=lambda r: r[0])]  # a row per task

    def forests(self, wanted: dict, trees: int, depth: int, bag: float, seed: int, nodes: bool) -> dict:
        """Importances of a forest for each class of ``wanted`` on its features, by name, and the Forest if ``nodes``."""
        names = {v: [self.features.index(f) for f in fs] for v, fs in wanted.items()}
        tasks = [(v, self.values.index(v), cols, a, min(a + TREES_A_TASK, trees)) for v, cols in names.items() for a in range(0, trees, TREES_A_TASK)]

        def work(bins, codes, folds, task):
            value, code, cols, first, last = task
            some = bins if cols == list(range(bins.shape[1])) else np.ascontiguousarray(bins[:, cols])
            mine, grown, importance = codes == code, [], np.zeros(len(cols))
            for t in range(first, last):
                rng = generator(seed, value, t)
                *tree, gains = grow(some, mine, rng.poisson(bag, len(some)), draws(len(cols)), depth, rng)
                importance += gains
                grown.append(tree)
            if not nodes:
                grown = []
            sizes = np.array([[len(f), len(other)] for f, _, other in grown], np.int64)
            return importance.tolist(), sizes.tobytes(), *[b"".join(t[k].tobytes() for t in grown) for k in range(3)]

        found: dict = {v: (np.zeros(len(cols)), []) for v, cols in names.items()}
        for (v, *_), (importance, sizes, feature, arg, other) in zip(tasks, self.run(tasks, work, "importance array<double>, sizes binary, feature binary, arg binary, other binary")):
            found[v][0][:] += importance
            ends = np.cumsum(np.frombuffer(sizes, np.int64).reshape(-1, 2), axis=0)[:-1]
            if sizes:
                by_node, by_leaf = ends[:, 0], ends[:, 1]
                found[v][1].extend(zip(np.split(np.frombuffer(feature, np.uint16), by_node), np.split(np.frombuffer(arg, np.uint8), by_node), np.split(np.frombuffer(other, float), by_leaf)))
        out = {}
        for v, (importance, grown) in found.items():
            importance /= importance.sum() or 1.0
            forest = Forest(list(wanted[v]), [self.cuts[k] for k in names[v]], grown) if nodes else None
            out[v] = (dict(zip(wanted[v], importance.tolist())), forest)
        return out

    def out_of_bag(self, value, trees: int, depth: int, seed: int, folds: int, out: int) -> float:
        """Share of rows that the sub-forests without their fold get wrong."""
        code = self.values.index(value) if value in self.values else -2

        def work(bins, codes, fold, b):
            held = np.isin(fold, [(b + k) % folds for k in range(out)])
            mine, rest, votes = codes == code, np.ascontiguousarray(bins[held]), np.zeros(held.sum())
            for t in range(trees):
                rng = generator(seed + b, value, t)
                *tree, _ = grow(bins, mine, np.where(held, 0, rng.poisson(1.0, len(bins))), draws(bins.shape[1]), depth, rng)
                vote(tree, rest, votes)
            return ((votes / trees).tobytes(),)

        bins, codes, fold = self.shared.value
        p = np.zeros(len(bins))
        for b, (votes,) in enumerate(self.run(list(range(folds)), work, "votes binary")):
            p[np.isin(fold, [(b + k) % folds for k in range(out)])] += np.frombuffer(votes, float)
        return float(np.mean((p / out >= 0.5) != (codes == code)))


def table(points: DataFrame, label: str, values: list, features: list[str], fold=None) -> Table:
    """Reads the points twice: for the thresholds, and for the bins, which the driver passes on."""
    width = len(features)
    x = F.array(*[F.col(f).cast("double") for f in features]).alias("x")

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            m = _matrix(batch.column(0), width)
            if np.isnan(m).any():
                raise ValueError("features of a training point are null or NaN")
            found = [np.unique(m[:, k], return_counts=True) for k in range(width)]
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([v.tobytes() for v, _ in found]), pa.array([n.tobytes() for _, n in found])], names=["feature", "at", "n"])

    def merged(group: pa.Table) -> pa.Table:
        at, n = (np.frombuffer(b"".join(group.column(c).to_pylist()), t) for c, t in (("at", float), ("n", np.int64)))
        values, where = np.unique(at, return_inverse=True)
        return pa.table({"feature": group.column("feature")[:1], "cuts": pa.array([thresholds(values, np.bincount(where, weights=n)).tolist()], pa.list_(pa.float64()))})

    by_feature = points.select(x).mapInArrow(distinct, "feature int, at binary, n binary").groupBy("feature").applyInArrow(merged, "feature int, cuts array<double>")
    found = {r["feature"]: np.array(r["cuts"], float) for r in by_feature.collect()}  # a row per feature
    cuts = [found[k] for k in range(width)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            if batch.column(1).null_count:
                raise ValueError("labels of training points are null")
            parts = [binned(_matrix(batch.column(0), width), cuts), batch.column(1).to_numpy().astype(np.int32), batch.column(2).to_numpy().astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], names=["bins", "code", "fold"])

    code = F.when(F.col(label).isNotNull(), F.coalesce(*[F.when(F.col(label) == v, F.lit(k)) for k, v in enumerate(values)], F.lit(-1))).alias("code")
    blocks = points.select(x, code, (F.lit(0) if fold is None else fold).alias("fold")).mapInArrow(rows, "bins binary, code binary, fold binary").collect()  # a byte a value
    bins, codes, folds = (np.frombuffer(b"".join(r[k] for r in blocks), t) for k, t in enumerate((np.uint8, np.int32, np.uint8)))
    bins = bins.reshape(-1, width)
    key = np.concatenate([bins, codes.astype(">i4").view(np.uint8).reshape(-1, 4), folds[:, None], np.ones((len(bins), 1), np.uint8)], axis=1)
    order = np.argsort(key.view(f"S{key.shape[1]}").ravel(), kind="stable")
    shared = points.sparkSession.sparkContext.broadcast((bins[order], codes[order], folds[order]))
    return Table(list(features), cuts, list(values), shared, points.sparkSession)


def probabilities(df: DataFrame, forests: dict[str, Forest]) -> DataFrame:
    """A column of probabilities for each forest, by name; a null feature is above all thresholds, as MLlib's NaN."""
    features = list(dict.fromkeys(f for forest in forests.values() for f in forest.features))
    shared = df.sparkSession.sparkContext.broadcast([([features.index(f) for f in forest.features], forest.cuts, forest.trees) for forest in forests.values()])

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            x, out = _matrix(batch, len(features)), np.zeros((len(batch), len(shared.value)))
            for k, (cols, cuts, trees) in enumerate(shared.value):
                votes, bins = np.zeros(len(batch)), binned(x[:, cols], cuts)
                for tree in trees:
                    vote(tree, bins, votes)
                out[:, k] = votes / len(trees)
            yield pa.ListArray.from_arrays(np.arange(0, out.size + 1, out.shape[1], dtype=np.int32), out.ravel())

    scores = F.arrow_udf(score, "array<double>")(F.array(*[F.col(f).cast("double") for f in features]))
    return df.withColumn("__scores", scores).select(*df.columns, *[F.col("__scores")[k].alias(name) for k, name in enumerate(forests)])
