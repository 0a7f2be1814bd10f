"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence.

Rows are documents, columns are word n-grams. Two documents of sizes a <= b
link when their sets have Jaccard similarity of at least ``NUM / DEN``; then
a >= b * NUM / DEN, and their rows differ in at most
``(a + b) * (DEN - NUM) / (DEN + NUM)`` columns. These size-derived bounds
decide which parts of the product are computed at all:

1. Sizes fall into bands, and a band's columns (hash ranges) into more blocks
   than a linked pair of that band can differ in, so a linked pair agrees on
   at least one whole column block. Rows that agree on no block of a common
   band are discarded with no product. The most frequent columns (common
   lines and passages) stay out of the blocks, so that they make nobody a
   candidate: rows still differ in no more of the other columns than before.
2. Equal rows are one class from the start. Within the rows that agree on a
   block, each is multiplied with the least one (a star, not all pairs); the
   overlaps are accumulated over column blocks, and a pair is dropped as soon
   as what is left cannot reach its bound; before any product, if the counts
   of both rows' columns in 256 ranges are too far apart for it.
3. Links join classes into components. Where rows that agree on a block are
   still in different components, the products between those components are
   computed too, as tiles of at most ``TILE`` by ``TILE`` rows. So every link
   between different texts is either computed or lies inside a component that
   other links already made.

Agreement on an empty block says nothing. A row that has too few blocks with
columns for the guarantee of step 1, for want of infrequent columns, adds a
second set of blocks over all of its columns, and if need be its empty ones;
a pair of such rows meets there, any other pair meets in the first set.

Everything runs on classes of rows with equal sets, told apart by 128 bits of
hash; ids come in only at the end, so rows that share an id and differ in text
are rows of their own.

Defined results: null, empty or blank text has an empty set, links with
nothing and has its own id as component; a row links by its text alone,
whatever its id, so one id may stand in several components; rows with a null
id link like any other, but a null id names a component only if there is no
other id in it; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vocab
from .graph import components
from .scratch import Scratch, named, ship
from .shingles import WordHashes, mix, shingle_set, word_hashes

SHINGLE = 3
NUM, DEN = 90, 100
TILE = 128
#: Columns multiplied at a time.
COLUMNS = 4096
#: Columns in at least so many rows are frequent; at most so many of them, the most frequent, are set apart (a bound
#: on what is sent to every task; which columns these are never changes the result).
FREQUENT, MOST_FREQUENT = 50, 200_000
#: Frequent columns are counted in stretches of so many entries, from so many occurrences in a stretch.
STRETCH, LEAST_LOCAL = 4_000_000, 4

_memo = WordHashes()
_SPIN = np.uint64(0xD6E8FEB86659FD93)


class Bands:
    """Size bands, and the column blocks of each."""

    def __init__(self, num: int, den: int, ratio: float = 1.5):
        self.num, self.den = num, den
        self.edges = [1]
        while self.edges[-1] < 1 << 40:
            self.edges.append(max(self.edges[-1] + 1, int(self.edges[-1] * ratio)))
        self.least = [-(-e * num // den) for e in self.edges]  # the least partner of a band's smallest member
        self.cuts: dict[tuple[int, int], np.ndarray] = {}

    def differ(self, band: int) -> int:
        """The most columns in which a linked pair differs whose larger row is in the band."""
        return 2 * (self.edges[band + 1] - 1) * (self.den - self.num) // (self.den + self.num)

    def of(self, n: int) -> list[int]:
        """Bands in which a row of n columns can meet a partner."""
        own = int(np.searchsorted(self.edges, n, side="right")) - 1
        out, band = [], own
        while self.least[band] <= n:
            if self.differ(band):
                out.append(band)
            band += 1
        return out

    def blocks(self, band: int, spare: int) -> tuple[int, np.ndarray]:
        """(number of blocks, their inner boundaries among the hashes); one in ``spare`` may be empty."""
        k = self.differ(band)
        m = k + 2 + k // spare
        if (band, spare) not in self.cuts:
            self.cuts[band, spare] = np.array([(i << 64) // m for i in range(1, m)], np.uint64)
        return m, self.cuts[band, spare]

    def signatures(self, row: np.ndarray, frequent: np.ndarray | None = None) -> np.ndarray:
        """Values of the column blocks of a sorted row in each of its bands."""
        n = len(row)
        if not n:
            return np.zeros(0, np.int64)
        rare = row
        if frequent is not None and len(frequent):
            at = np.minimum(np.searchsorted(frequent, row), len(frequent) - 1)
            rare = row[frequent[at] != row]
        out = []
        for band in self.of(n):
            least = self.differ(band)  # more filled blocks than this are a guarantee
            value, full = self._values(rare, band, 0)
            out.append(value[full])
            if int(full.sum()) <= least:
                value, full = self._values(row, band, 1)
                out.append(value[full] if int(full.sum()) > least else value)
        return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)

    def _values(self, row: np.ndarray, band: int, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """(value, whether it has columns) of each block of the band."""
        m, cuts = self.blocks(band, 16 if kind else 4)
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(row), dtype=np.uint64)])
            at = np.concatenate([[0], np.searchsorted(row, cuts), [len(row)]])
            name = np.uint64((2 * band + kind) << 40) + np.arange(m, dtype=np.uint64)
            return mix((sums[at[1:]] - sums[at[:-1]]) ^ mix(name)), at[1:] > at[:-1]


def frequent_columns(docs: DataFrame, text_col: str, shingle: int) -> np.ndarray:
    """Sorted hashes of the most frequent columns, from counts over all rows."""

    def run(batches):
        def counted(rows):
            every = np.sort(np.concatenate(rows))
            first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
            n = np.diff(np.append(first, len(every)))
            keep = n >= LEAST_LOCAL
            return pa.RecordBatch.from_arrays([pa.array(every[first[keep]].view(np.int64)), pa.array(n[keep].astype(np.int64))], names=["column", "n"])

        vocab.only("ngram_join", _memo.clear)
        rows, held = [], 0
        for batch in batches:
            texts = batch.column(0).cast(pa.large_binary())
            for k in range(batch.num_rows):
                row = shingle_set(word_hashes(texts[k].as_py() or b"", _memo), shingle)
                rows.append(row)
                held += len(row)
                if held >= STRETCH:
                    yield counted(rows)
                    rows, held = [], 0
        if held:
            yield counted(rows)

    counts = docs.select(named(docs, text_col)).mapInArrow(run, "column long, n long").groupBy("column").agg(F.sum("n").alias("n"))
    best = counts.filter(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "column").limit(MOST_FREQUENT).select("column").collect()
    return np.sort(np.array([r[0] for r in best], np.int64).view(np.uint64))


def set_key(row: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    if not len(row):
        return 0, 0
    with np.errstate(over="ignore"):
        return int(np.sum(mix(row)).view(np.int64)), int(np.sum(mix(row * _SPIN)).view(np.int64))


def rows_of(docs: DataFrame, id_col: str, text_col: str, shingle: int, num: int, den: int, frequent: np.ndarray) -> DataFrame:
    """(id, text_key, n, k1, k2, sketch, blocks): size, set hash, sketch and block values of every row."""
    text = named(docs, text_col)
    source = docs.select(named(docs, id_col).alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(frequent)  # at most MOST_FREQUENT numbers

    def run(batches):
        vocab.only("ngram_join", _memo.clear)
        bands = Bands(num, den)
        for batch in batches:
            n, keys, sketches, blocks = [], [], [], []
            texts = batch.column(2).cast(pa.large_binary())
            for k in range(batch.num_rows):
                row = shingle_set(word_hashes(texts[k].as_py() or b"", _memo), shingle)
                n.append(len(row))
                keys.append(set_key(row))
                sketches.append(sketch(row))
                blocks.append(bands.signatures(row, sent.value))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array([x[0] for x in keys], pa.int64()), pa.array([x[1] for x in keys], pa.int64()), pa.array(sketches, pa.binary()), pa.array(blocks, pa.list_(pa.int64()))], names=["id", "text_key", "n", "k1", "k2", "sketch", "blocks"])

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, text_key long, n long, k1 long, k2 long, sketch binary, blocks array<long>")


def sketch(row: np.ndarray) -> bytes:
    """The row's size, and how many of its columns fall into each of 256 ranges (255 at most)."""
    return np.int64(len(row)).tobytes() + np.minimum(np.bincount((row >> np.uint64(56)).astype(np.int64), minlength=256), 255).astype(np.uint8).tobytes()


def may_link(left: list[bytes], right: list[bytes], num: int, den: int) -> np.ndarray:
    """Boolean matrix of pairs that their sketches allow to link.

    Rows that differ in d columns have sketches that differ by d at most in
    all, and linked rows differ in (a + b) * (den - num) / (den + num) at most.
    """
    a, b = (np.array([int.from_bytes(x[:8], "little") for x in side], np.int64) for side in (left, right))
    p, q = (np.stack([np.frombuffer(x, np.uint8, 256, 8) for x in side]).astype(np.int16) for side in (left, right))
    total = a[:, None] + b[None, :]
    far = np.stack([np.abs(row[None, :] - q).sum(1) for row in p]) if len(p) else np.zeros((0, len(q)), np.int64)
    return (far * (den + num) <= total * (den - num)) & (np.minimum(a[:, None], b[None, :]) * den >= np.maximum(a[:, None], b[None, :]) * num)


def sets_of(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame, shingle: int) -> DataFrame:
    """(node, row): the sorted hashes of the wanted classes (node, first, k1, k2), read from the rows with their first ids."""
    ids = wanted.select("first").distinct()
    source = docs.select(named(docs, id_col).alias("id"), named(docs, text_col).alias("text"))
    source = source.join(ids, F.col("id").eqNullSafe(F.col("first")), "left_semi").select("text")

    def run(batches):
        vocab.only("ngram_join", _memo.clear)
        for batch in batches:
            texts = batch.column(0).cast(pa.large_binary())
            rows = [shingle_set(word_hashes(texts[k].as_py() or b"", _memo), shingle) for k in range(batch.num_rows)]
            keys = [set_key(row) for row in rows]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in keys], pa.int64()), pa.array([x[1] for x in keys], pa.int64()), pa.array([r.tobytes() for r in rows], pa.binary())], names=["k1", "k2", "row"])

    return source.mapInArrow(run, "k1 long, k2 long, row binary").join(wanted.select("node", "k1", "k2"), ["k1", "k2"]).select("node", "row").dropDuplicates(["node"])


def overlaps(left: list[np.ndarray], right: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """Boolean matrix of linked pairs, from overlap counts accumulated over column blocks."""
    a, b = np.array([len(x) for x in left], np.int64), np.array([len(x) for x in right], np.int64)
    total = a[:, None] + b[None, :]
    need = -(-total * num // (num + den))  # the least overlap of a linked pair
    alive = np.minimum(a[:, None], b[None, :]) >= need
    count = np.zeros(total.shape, np.int64)
    if not alive.any():
        return alive
    every = np.concatenate([*left, *right])
    names, column = np.unique(every, return_inverse=True)
    ends = np.cumsum(np.concatenate([a, b]))
    row = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    on_left = np.zeros(len(names), bool)
    on_left[column[row < len(a)]] = True
    on_right = np.zeros(len(names), bool)
    on_right[column[row >= len(a)]] = True
    both = on_left & on_right
    place = np.cumsum(both) - 1
    keep = both[column]
    row, column = row[keep], place[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = int(both.sum())
    left_over = np.bincount(row, minlength=len(ends))  # of each row's columns, what is yet to come
    for first in range(0, width, COLUMNS):
        i, j = np.searchsorted(column, [first, first + COLUMNS])
        dense = np.zeros((len(ends), min(COLUMNS, width - first)), np.float32)
        dense[row[i:j], column[i:j] - first] = 1
        count += np.rint(dense[: len(a)] @ dense[len(a) :].T).astype(np.int64)
        left_over = left_over - np.bincount(row[i:j], minlength=len(ends))
        alive &= count + np.minimum(left_over[: len(a), None], left_over[None, len(a) :]) >= need
        if not alive.any():
            break
    return alive & (count >= need)


def _tiles(rows: DataFrame, num: int, den: int, sketches: bool = False) -> DataFrame:
    """(tile, side, node, comp, row), one tile's rows together -> linked (a, b) across sides, or with sketches for rows those that may link.

    A null comp, or different comps, may link; equal ones already are. Side -1
    stands on both sides.
    """

    def run(batches):
        def linked(members):
            left = [m for m in members if m[0] <= 0]
            right = [m for m in members if m[0] != 0]
            if not left or not right:
                return []
            hits = (may_link if sketches else overlaps)([m[3] for m in left], [m[3] for m in right], num, den)
            return [(left[i][1], right[j][1]) for i, j in zip(*np.nonzero(hits)) if left[i][1] != right[j][1] and (left[i][2] is None or left[i][2] != right[j][2])]

        tile, members = None, []
        for batch in batches:
            out = []
            for t, side, i, comp, row in zip(*(batch.column(c).to_pylist() for c in range(5))):
                if t != tile and members:
                    out += linked(members)
                    members = []
                tile = t
                members.append((side, i, comp, row if sketches else np.frombuffer(row, np.uint64)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], names=["a", "b"])
        if members and (out := linked(members)):
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], names=["a", "b"])

    placed = rows.repartition("tile").sortWithinPartitions("tile", "side")
    return placed.select("tile", "side", "node", "comp", "row").mapInArrow(run, "a long, b long")


def _groups(docs: DataFrame, id_col: str, text_col: str, shingle: int, num: int, den: int, scratch: Scratch) -> DataFrame:
    """(id, text_key, n, group, name): each row with its component (NULL for an empty set) and the least id there."""
    spark = docs.sparkSession
    ship(spark)
    frequent = frequent_columns(docs, text_col, shingle)
    table = scratch.put(rows_of(docs, id_col, text_col, shingle, num, den, frequent), "rows")
    some = table.filter("n > 0")
    # The nodes of all that follow. The table is written, so a node's number stays.
    classes = some.groupBy("k1", "k2").agg(F.min("id").alias("first"), F.min("n").alias("n")).withColumn("node", F.monotonically_increasing_id())
    classes = scratch.put(classes, "classes")

    # Blocks in which different rows agree. Fixed-width minima only, so the count is a hash aggregate of small
    # rows, and equal rows alone never pass. Each group's figures are a table of its own before they are joined
    # back: then Spark can split the rows of a hot block or centre over tasks.
    spread = some.select("k1", F.explode("blocks").alias("block"))
    met = spread.groupBy("block").agg(F.min("k1").alias("lo"), F.max("k1").alias("hi")).filter("lo < hi").select("block")
    met = scratch.put(met, "met")
    scratch.settle()
    agreed = scratch.put(spread.join(met, "block").select("block", "k1").distinct(), "agreed")
    members = scratch.put(agreed.join(classes.select("k1", "node"), "k1").select("block", "node"), "members")
    del spread, met
    scratch.drop("met", "agreed")
    scratch.settle()
    centres = scratch.put(members.groupBy("block").agg(F.min("node").alias("centre")), "centres")
    groups = scratch.put(members.join(centres, "block").select("block", "node", "centre"), "groups")
    stars = scratch.put(groups.filter("node <> centre").select("node", "centre").distinct(), "pairs")
    stars = stars.join(classes.select("node", "n"), "node").join(classes.select(F.col("node").alias("centre"), F.col("n").alias("centre_n")), "centre")
    fits = F.least("n", "centre_n") * den >= F.greatest("n", "centre_n") * num
    stars = scratch.put(stars.filter(fits).select("node", "centre"), "stars")
    meeting = members.select("node").distinct().join(classes.select("node", "k1", "k2"), "node")
    sketched = scratch.put(table.select("k1", "k2", "sketch").dropDuplicates(["k1", "k2"]).join(meeting, ["k1", "k2"]).select("node", "sketch"), "sketches")
    scratch.drop("members", "centres", "pairs")

    def allowed(batches):
        for batch in batches:
            one, two = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            yield batch.select([0, 1]).filter(pa.array([bool(may_link([x], [y], num, den)[0, 0]) for x, y in zip(one, two)], pa.bool_()))

    both = stars.join(sketched, "node").join(sketched.select(F.col("node").alias("centre"), F.col("sketch").alias("centre_sketch")), "centre")
    hopeful = scratch.put(both.select("node", "centre", "sketch", "centre_sketch").mapInArrow(allowed, "node long, centre long"), "hopeful")
    scratch.drop("stars")
    scratch.settle()

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        """The linked pairs among (node, centre), by products of each centre with its others, at most TILE at a time."""
        nodes = pairs.select("node").union(pairs.select(F.col("centre").alias("node"))).distinct()
        wanted = scratch.put(classes.join(nodes, "node", "left_semi").select("node", "first", "k1", "k2"), f"wanted-{name}")
        sets = scratch.put(sets_of(docs, id_col, text_col, wanted, shingle), f"sets-{name}")
        sizes = scratch.put(pairs.groupBy("centre").agg(F.count(F.lit(1)).alias("size")), f"sizes-{name}")
        scratch.settle()
        salt = F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / TILE).cast("long"))
        sized = pairs.join(sizes, "centre").select("centre", "node", F.struct("centre", salt.alias("salt")).alias("tile"))
        others = sized.join(sets, "node").select("tile", F.lit(1).alias("side"), "node", F.lit(None).cast("long").alias("comp"), "row")
        heads = sized.select("tile", F.col("centre").alias("node")).distinct().join(sets, "node").select("tile", F.lit(0).alias("side"), "node", F.lit(None).cast("long").alias("comp"), "row")
        out = scratch.put(_tiles(others.unionByName(heads), num, den), f"links-{name}")
        scratch.drop(f"wanted-{name}", f"sets-{name}", f"sizes-{name}")
        scratch.settle()
        return out

    links = verified(hopeful, "stars")
    found = scratch.put(components(links, scratch, "found"), "found")

    # Rows that agree on a block and are in different components still.
    marked = groups.join(found, "node", "left").select("block", "node", "centre", F.coalesce("component", "node").alias("comp"))
    marked = scratch.put(marked, "marked")
    split = scratch.put(marked.groupBy("block").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("n")).filter("lo < hi").select("block", "n"), "split")
    open_rows = scratch.put(marked.join(split, "block"), "open")
    scratch.drop("groups", "found", "marked")
    # Small groups: each distinct list of members is one tile, however many blocks it agrees on.
    lists = open_rows.filter(F.col("n") <= TILE).groupBy("block").agg(F.sort_array(F.collect_set(F.struct("node", "comp"))).alias("members"))
    lists = lists.select("members").distinct().select(F.struct(F.xxhash64("members").alias("cluster"), F.lit(0).cast("long").alias("part"), F.lit(0).cast("long").alias("part2")).alias("tile"), F.explode("members").alias("m"))
    small = lists.select("tile", F.lit(-1).alias("side"), "m.node", "m.comp")
    # Large ones: each row stands in one part, beside rows with the same least centre; a part is of one component or
    # of several that are small there. Parts that meet in some block are tiles, but for those of one component.
    large = scratch.put(open_rows.filter(F.col("n") > TILE).select("block", "node", "centre", "comp"), "large")
    homes = scratch.put(large.groupBy("node", "comp").agg(F.min("centre").alias("home")), "homes")
    sizes = homes.groupBy("home", "comp").agg(F.count(F.lit(1)).alias("n")).withColumn("whole", F.when(F.col("n") >= TILE, F.col("comp")))
    sizes = scratch.put(sizes, "home-sizes")
    loose = scratch.put(sizes.filter("whole is null").groupBy("home").agg(F.sum("n").alias("loose")), "home-loose")
    parts = F.ceil(F.when(F.col("whole").isNotNull(), F.col("n")).otherwise(F.col("loose")) / TILE).cast("long")
    share = F.pmod(F.xxhash64("node"), parts)
    placed = homes.join(sizes.join(loose, "home", "left"), ["home", "comp"])
    placed = scratch.put(placed.select("node", "comp", "whole", F.xxhash64("home", "whole", share).alias("part")), "placed")
    blocks = large.select("block", "node").join(placed.select("node", "whole", "part"), "node").select("block", "whole", "part").distinct()
    blocks = scratch.put(blocks, "blocks")
    # Blocks with the same parts ask the same; one of them stays.
    same = blocks.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("one"), F.sum(F.xxhash64("part").cast("decimal(38,0)")).alias("two"))
    asking = scratch.put(same.groupBy("n", "one", "two").agg(F.min("block").alias("block")).select("block"), "asking")
    blocks = scratch.put(blocks.join(asking, "block"), "asked")
    other = blocks.select("block", F.col("whole").alias("whole2"), F.col("part").alias("part2"))
    pairs = blocks.join(other, "block").filter("part <= part2 and (whole is null or whole2 is null or whole <> whole2)")
    tile = F.struct(F.lit(0).cast("long").alias("cluster"), "part", "part2").alias("tile")
    pairs = scratch.put(pairs.select("part", "part2").distinct(), "tiles")
    one = placed.join(pairs, "part").select(tile, F.when(F.col("part") == F.col("part2"), -1).otherwise(0).alias("side"), "node", "comp")
    two = placed.withColumnRenamed("part", "part2").join(pairs.filter("part < part2"), "part2").select(tile, F.lit(1).alias("side"), "node", "comp")
    tiled = small.unionByName(one).unionByName(two).join(sketched, "node").select("tile", "side", "node", "comp", F.col("sketch").alias("row"))
    hopeful = scratch.put(_tiles(tiled, num, den, sketches=True).select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("centre")).distinct(), "more")
    scratch.drop("split", "open", "large", "homes", "home-sizes", "home-loose", "placed", "blocks", "asking", "asked", "tiles", "sketches")
    more = verified(hopeful, "more")
    final = scratch.put(components(links.union(more), scratch, "final"), "components")
    scratch.drop("hopeful", "more", "links-stars", "links-more")

    # Ids come back: a component is named by the least id of its classes.
    grouped = scratch.put(classes.join(final, "node", "left").select("k1", "k2", "first", F.coalesce("component", "node").alias("group")), "grouped")
    names = scratch.put(grouped.groupBy("group").agg(F.min("first").alias("name")), "names")
    grouped = scratch.put(grouped.join(names, "group").select("k1", "k2", "group", "name"), "named")
    result = table.select("id", "text_key", "n", "k1", "k2").join(grouped, ["k1", "k2"], "left")
    empty = F.col("n") == 0
    result = result.select("id", "text_key", "n", F.when(~empty, F.col("group")).alias("group"), F.when(empty, F.col("id")).otherwise(F.coalesce("name", "id")).alias("name"))
    result = scratch.put(result, "result")
    scratch.keep("result")
    return result


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """(id, n_shingles, component_id): every row with its component under similarity >= num / den."""
    found = _groups(docs, id_col, text_col, shingle, num, den, Scratch(docs.sparkSession, "ngram-join"))
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("name").alias("component_id"))


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """One row of each component, with all its columns; rows with an empty set all stay.

    The row has the component's least id (a null one only if there is no
    other), and of several texts under that id the one with the least hash; of
    rows that agree in id and text, any one.
    """
    scratch = Scratch(docs.sparkSession, "representatives")
    found = _groups(docs, id_col, text_col, shingle, num, den, scratch).filter("group is not null")
    own = F.struct(F.col("id").isNull().alias("none"), "id", "text_key")
    first = scratch.put(found.groupBy("group").agg(F.min(own).alias("stays")), "stays")
    gone = found.join(first, "group").filter(~own.eqNullSafe(F.col("stays"))).select(F.col("id").alias("gone_id"), F.col("text_key").alias("gone_key")).distinct()
    gone = scratch.put(gone, "gone")
    again = scratch.put(found.groupBy("id", "text_key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("id").alias("gone_id"), F.col("text_key").alias("gone_key")), "again")
    rows = docs.select(F.struct(*[named(docs, c) for c in docs.columns]).alias("row"), named(docs, id_col).alias("id"), F.xxhash64(named(docs, text_col)).alias("text_key"))
    is_it = F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("text_key") == F.col("gone_key"))
    # What goes grows with the input, so the plan is the one for large inputs at every size.
    kept = rows.join(gone.hint("merge"), is_it, "left_anti")
    if not again.isEmpty():
        kept = kept.join(again, is_it, "left_anti").union(kept.join(again, is_it, "left_semi").groupBy("id", "text_key").agg(F.first("row").alias("row")).select("row", "id", "text_key"))
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])
