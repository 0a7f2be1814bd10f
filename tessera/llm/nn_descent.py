"""Embedding near-duplicates by NN-descent.

Equal vectors of a label are one node from the start. The neighbour graph
starts from random-projection trees (leaves of about ``LEAF`` nodes, as many
trees as pairs at the threshold need to meet with high probability) and is
refined by joining neighbours of neighbours, forward and backward, until a
round finds hardly any new edge over the threshold. A node whose whole list
lies over the threshold is saturated: its list is enlarged to all of its
component, in tiles of at most ``TILE`` by ``TILE`` vectors. Those tiles also
recompute every edge in double precision, so no pair below the threshold
stays. An audit holds about ``AUDIT`` nodes of each label against all vectors
of their label by brute force. The search goes on with new trees while the mean
recall of any label's audited nodes that have links is under ``RECALL``; a
label that stays under it, or has fewer than ``JUDGES`` such nodes to judge by,
is compared whole, all vectors with all, in tiles of ``WHOLE`` by ``WHOLE``.

Every list in the search is bounded, and longer groups are worked off in
chunks of ``CHUNK`` vectors, so a crowded leaf or a popular neighbour fills no
task. Chunks are dealt anew in each round, by hash, so a run can be repeated;
pairs that never share one are what the audit finds labels by.

Nodes are numbers of their own, and ids come in only at the end, so rows that
share an id are vectors of their own, whatever they hold.

Defined results: a null label, a null or zero vector, or one with null or
non-finite components links with nothing and is its own component; vectors of
different lengths never link; repeated rows are vectors of their own, linked
with each other; a row with a null id links like any other, but a null id
names a component only if there is no other id in it; ids and labels may have
any type that can be compared.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import components
from .scratch import Scratch, named, ship

THRESHOLD = 0.93
LIST, LEAF, CHUNK, TILE = 8, 48, 96, 256
MOST_ROUNDS, MOST_SEARCHES = 4, 4
RECALL, AUDIT, JUDGES = 0.98, 256, 32
WHOLE = 1024


def trees_needed(depth: int, threshold: float, miss: float = 0.02) -> int:
    """Trees in which a pair at the threshold shares no leaf with probability ``miss`` at most."""
    same = (1 - math.acos(threshold) / math.pi) ** depth
    return max(2, math.ceil(math.log(miss) / math.log1p(-min(same, 1 - 1e-9))))


def _planes(dim: int, tree: int, depth: int) -> np.ndarray:
    return np.random.default_rng([dim, tree]).normal(size=(depth, dim)).astype(np.float32)


def _matrix(column, dtype) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype) for x in column.to_pylist()]


def _groups(batches, width: int):
    """Rows with equal first column, at most ``width`` at a time; batches are sorted by it."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if rows and (row[0] != key or len(rows) >= width):
                yield rows
                rows = []
            key = row[0]
            rows.append(row)
    if rows:
        yield rows


def _emit(out):
    u, v, s = zip(*out)
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float32())], names=["u", "v", "s"])


def _nearest(ids: list, x: np.ndarray, lists: int) -> list:
    """(u, v, similarity) of each row's best few among the others."""
    s = x @ x.T
    np.fill_diagonal(s, -2)
    k = min(lists, len(ids) - 1)
    best = np.argpartition(-s, k - 1, axis=1)[:, :k] if k else np.zeros((len(ids), 0), np.int64)
    return [(ids[i], ids[j], float(s[i, j])) for i in range(len(ids)) for j in best[i] if ids[i] != ids[j]]


def _local_join(rows: DataFrame, lists: int, turn: int) -> DataFrame:
    """(group, id, x): near pairs within each group; ``turn`` deals crowded groups into other chunks."""

    def run(batches):
        out = []
        for group in _groups(batches, CHUNK):
            known = {g[1]: g[2] for g in group}
            if len(known) > 1:
                out += _nearest(list(known), np.stack([np.frombuffer(v, np.float32) for v in known.values()]), lists)
            if len(out) > 50_000:
                yield _emit(out)
                out = []
        if out:
            yield _emit(out)

    placed = rows.repartition("group").sortWithinPartitions("group", F.xxhash64("id", F.lit(turn)))
    return placed.select("group", "id", "x").mapInArrow(run, "u long, v long, s float")


def _best(edges: DataFrame, lists: int) -> DataFrame:
    """Each node's list: its nearest few."""
    edges = edges.groupBy("u", "v").agg(F.max("s").alias("s"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("s"), "v"))
    return edges.withColumn("rank", rank).filter(F.col("rank") <= lists).drop("rank")


def _trees(nodes: DataFrame, first: int, count: int, lists: int, scratch: Scratch) -> DataFrame:
    """Near pairs within the leaves of ``count`` random-projection trees."""

    def codes(batches):
        for batch in batches:
            x = _matrix(batch.column(4), np.float32)
            rows = []
            for k, (i, label, dim, depth) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4)))):
                for t in range(first, first + count):
                    bits = _planes_of(dim, t)[:depth] @ x[k] > 0
                    rows.append((t, label, dim, int.from_bytes(np.packbits(bits).tobytes(), "big") << 6 | depth, i, k))
            if rows:
                t, label, dim, code, i, k = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(t, pa.int32()), pa.array(label, batch.schema.field(1).type), pa.array(dim, pa.int32()), pa.array(code, pa.int64()), batch.column(0).take(pa.array(k)), batch.column(4).take(pa.array(k))], names=["tree", "label", "dim", "code", "id", "x"])

    cache: dict = {}

    def _planes_of(dim, tree):
        if (dim, tree) not in cache:
            cache[dim, tree] = _planes(dim, tree, 48)
        return cache[dim, tree]

    label = nodes.schema["label"].dataType.simpleString()
    placed = nodes.select("id", "label", "dim", "depth", "x").mapInArrow(codes, f"tree int, label {label}, dim int, code long, id long, x binary")
    leaf = ["tree", "label", "dim", "code"]
    placed = scratch.put(placed, f"leaves-{first}")
    sizes = scratch.put(placed.groupBy(leaf).agg(F.count(F.lit(1)).alias("n")), f"leaf-sizes-{first}")
    share = F.pmod(F.xxhash64("id", "tree"), F.ceil(F.col("n") / CHUNK).cast("long"))
    grouped = placed.join(sizes, leaf).select(F.struct(*leaf, share.alias("share")).alias("group"), "id", "x")
    return _local_join(grouped, lists, first)


def _rows_of_tiles(found: DataFrame, nodes: DataFrame, threshold: float, scratch: Scratch, step: int | str, width: int = TILE) -> DataFrame:
    """(id, links, root): by tile, the weight of each node's links, and its component's least node there."""
    size = scratch.put(found.groupBy("component").agg(F.count(F.lit(1)).alias("n")), f"component-sizes-{step}")
    part = F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / width).cast("long"))
    placed = found.join(size, "component").select("component", F.col("node").alias("id"), part.alias("part"))
    parts = placed.select("component", "part").distinct()
    pairs = parts.join(parts.withColumnRenamed("part", "part2"), "component").filter("part <= part2")
    tile = F.struct("component", "part", "part2").alias("tile")
    one = placed.join(pairs, ["component", "part"]).select(tile, F.when(F.col("part") == F.col("part2"), -1).otherwise(0).alias("side"), "id")
    two = placed.withColumnRenamed("part", "part2").join(pairs.filter("part < part2"), ["component", "part2"]).select(tile, F.lit(1).alias("side"), "id")
    rows = one.union(two).join(nodes.select("id", "n_copies", "vector"), "id")

    def product(group):
        left = [g for g in group if g[1] <= 0]
        right = [g for g in group if g[1] != 0]
        a, b = (np.stack([np.frombuffer(g[4], np.float64) for g in side]) if side else np.zeros((0, 1)) for side in (left, right))
        if not left or not right:
            return []
        hit = a @ b.T >= threshold
        if group[0][1] == -1:
            np.fill_diagonal(hit, False)
            hit |= hit.T
        weight = lambda side: np.array([g[3] for g in side], np.int64)
        links = {}
        for g, n in zip(left, hit @ weight(right)):
            links[g[2]] = links.get(g[2], 0) + int(n)
        if group[0][1] != -1:
            for g, n in zip(right, hit.T @ weight(left)):
                links[g[2]] = links.get(g[2], 0) + int(n)
        root = {i: i for i in links}

        def top(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for i, j in zip(*np.nonzero(hit)):
            p, q = top(left[i][2]), top(right[j][2])
            if p != q:
                root[max(p, q)] = min(p, q)
        return [(i, n, top(i)) for i, n in links.items() if n]

    def run(batches):
        group, out = [], []
        names = ["id", "links", "root"]

        def emit(out):
            i, n, r = zip(*out)
            return pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(n, pa.int64()), pa.array(r, pa.int64())], names=names)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if group and row[0] != group[0][0]:
                    out += product(group)
                    group = []
                group.append(row)
            if out:
                yield emit(out)
                out = []
        if group and (out := product(group)):
            yield emit(out)

    placed = rows.select("tile", "side", "id", "n_copies", "vector").repartition("tile").sortWithinPartitions("tile", "side")
    return placed.mapInArrow(run, "id long, links long, root long")


def _true_links(nodes: DataFrame, threshold: float) -> DataFrame:
    """(id, n): the weight of all links of each audited node, against every vector of its label."""
    parts = F.ceil(F.col("n") / WHOLE).cast("long")
    audited = nodes.filter(F.pmod(F.xxhash64("id", F.lit("audit")), F.ceil(F.col("n") / AUDIT).cast("long")) == 0)
    asked = audited.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).withColumn("side", F.lit(0))
    every = nodes.withColumn("part", F.pmod(F.xxhash64("id"), parts)).withColumn("side", F.lit(1))
    columns = [F.struct("label", "dim", "part").alias("group"), "side", "id", "n_copies", "vector"]
    rows = asked.select(*columns).union(every.select(*columns)).repartition("group").sortWithinPartitions("group", "side")

    def product(group):
        left, right = [g for g in group if g[1] == 0], [g for g in group if g[1] == 1]
        if not left or not right:
            return []
        a, b = (np.stack([np.frombuffer(g[4], np.float64) for g in side]) for side in (left, right))
        hit = a @ b.T >= threshold
        place = {g[2]: k for k, g in enumerate(right)}
        for k, g in enumerate(left):
            if g[2] in place:
                hit[k, place[g[2]]] = False
        return [(g[2], int(n)) for g, n in zip(left, hit @ np.array([g[3] for g in right], np.int64))]

    def run(batches):
        group, out = [], []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if group and row[0] != group[0][0]:
                    out += product(group)
                    group = []
                group.append(row)
        if group:
            out += product(group)
        if out:
            i, n = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(n, pa.int64())], names=["id", "n"])

    return rows.mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_links, component_id, kept, audit_recall): a row per vector."""
    spark = vectors.sparkSession
    ship(spark)
    scratch = Scratch(spark, "nn-descent")
    source = vectors.select(named(vectors, id_col).alias("id"), named(vectors, label_col).alias("label"), named(vectors, vector_col).alias("v"))
    number = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    good = source.filter(F.col("label").isNotNull() & F.col("v").isNotNull()).filter(number & F.exists("v", lambda c: c != 0))
    # ``id`` is a node's number from here on; the table is written, so it stays.
    classes = good.groupBy("label", "v").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n_copies"))
    classes = scratch.put(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    per_label = scratch.put(classes.groupBy("label", F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")), "labels")
    deep = F.least(F.lit(40), F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / LEAF)))).cast("int").alias("depth")
    depths = per_label.select("label", "dim", "n", deep)

    label = classes.schema["label"].dataType.simpleString()

    def unit(batches):
        for batch in batches:
            out, out32 = [], []
            for v in batch.column(2).to_pylist():
                v = np.array(v, np.float64)
                v = v / np.abs(v).max()
                v = v / np.sqrt(v @ v)
                out.append(v.tobytes())
                out32.append(v.astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), batch.column(4), pa.array(out, pa.binary()), pa.array(out32, pa.binary())], names=["id", "label", "n_copies", "dim", "vector", "x"])

    units = classes.select("id", "label", "v", "n_copies", F.size("v").alias("dim")).mapInArrow(unit, f"id long, label {label}, n_copies long, dim int, vector binary, x binary")
    nodes = scratch.put(units.join(depths, ["label", "dim"]), "nodes")
    depth = nodes.agg(F.coalesce(F.max("depth"), F.lit(0))).first()[0]
    trees = trees_needed(depth, threshold)
    near = F.col("s") >= threshold - 1e-4  # in single precision; the tiles decide in double

    true = _true_links(nodes, threshold).filter("n > 0").withColumnRenamed("n", "true_links")
    judges = scratch.put(true.join(nodes.select("id", "label", "dim"), "id"), "judges")
    sizes = scratch.put(nodes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least")).filter("n > 1"), "label-sizes")

    edges, step, used = None, 0, 0
    for _ in range(MOST_SEARCHES):
        found = _trees(nodes, used, trees, LIST, scratch)
        used += trees
        edges = scratch.put(_best(found if edges is None else edges.union(found), LIST), f"edges-{step}")
        scratch.drop(f"leaves-{used - trees}", f"leaf-sizes-{used - trees}")
        count = edges.filter(near).count()
        for _ in range(MOST_ROUNDS):
            both = edges.select(F.col("u").alias("group"), F.col("v").alias("id")).union(edges.select(F.col("v").alias("group"), F.col("u").alias("id")))
            itself = nodes.select(F.col("id").alias("group"), "id")
            joined = both.union(itself).distinct().join(nodes.select("id", "x"), "id")
            step += 1
            edges = scratch.put(_best(edges.union(_local_join(joined, LIST, step)), LIST), f"edges-{step}")
            scratch.drop(f"edges-{step - 1}")
            scratch.settle()
            now = edges.filter(near).count()
            grown, count = now - count, now
            if now and grown <= 0.002 * now:
                break
        links = edges.filter(near).select(F.col("u").alias("a"), F.col("v").alias("b"))
        clusters = scratch.put(components(links, scratch, f"c{step}"), f"clusters-{step}")
        tiles = scratch.put(_rows_of_tiles(clusters, nodes, threshold, scratch, step), f"tiles-{step}")
        seen = tiles.groupBy("id").agg(F.sum("links").alias("links"))
        recalls = judges.join(seen, "id", "left").withColumn("recall", F.coalesce("links", F.lit(0)) / F.col("true_links"))
        marks = recalls.groupBy("label", "dim").agg(F.avg("recall").alias("recall"), F.count(F.lit(1)).alias("judges"))
        marks = scratch.put(sizes.join(marks, ["label", "dim"], "left"), f"marks-{step}")
        if marks.filter((F.col("judges") >= JUDGES) & (F.col("recall") < RECALL)).isEmpty():
            break
    weak = F.coalesce("judges", F.lit(0)) < JUDGES
    weak = scratch.put(marks.filter(weak | (F.col("recall") < RECALL)).select("label", "dim", "least"), "weak")
    if not weak.isEmpty():
        labels = nodes.select("id", "label", "dim")
        whole = labels.join(weak, ["label", "dim"]).select(F.col("id").alias("node"), F.col("least").alias("component"))
        exact = _rows_of_tiles(whole, nodes, threshold, scratch, "whole", WHOLE)
        others = tiles.join(labels.join(weak, ["label", "dim"], "left_anti").select("id"), "id", "left_semi")
        tiles = scratch.put(others.select("id", "links", "root").union(exact), "tiles-whole")
    # Over audited nodes that have links; those of labels compared whole count as found.
    recall = recalls.join(weak.select("label", "dim", F.lit(1.0).alias("exact")), ["label", "dim"], "left").agg(F.avg(F.coalesce("exact", "recall"))).first()[0]
    recall = 1.0 if recall is None else recall
    final = components(tiles.select(F.col("id").alias("a"), F.col("root").alias("b")), scratch, "final")
    weights = tiles.groupBy("id").agg(F.sum("links").alias("links"))
    # Ids come back: a component is named by the least id of its vectors.
    linked = classes.join(weights, "id", "left").join(final.withColumnRenamed("node", "id"), "id", "left")
    linked = linked.select("label", "v", "first", (F.coalesce("links", F.lit(0)) + F.col("n_copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component"))
    linked = scratch.put(linked, "linked")
    names = scratch.put(linked.groupBy("component").agg(F.min("first").alias("name")), "names")
    linked = scratch.put(linked.join(names, "component").select("label", "v", "n_links", "name", F.lit(True).alias("compared")), "named")
    rows = source.join(linked, ["label", "v"], "left")
    component = F.when(F.col("compared"), F.col("name")).otherwise(F.col("id"))
    result = rows.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"), F.lit(float(recall)).alias("audit_recall"))
    result = scratch.put(result, "result")
    scratch.keep("result")
    return result
