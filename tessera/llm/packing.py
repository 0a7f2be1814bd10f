"""Sequence packing by non-negative least squares over a length histogram.

Every document is cut at multiples of the window; the last piece, of whatever
length, falls into one of ``WINDOW / GRID`` length bins (rounded up, so a
planned sequence always fits). All combinations of up to ``DEPTH`` bins that
fill the window exactly are the columns of a least-squares problem; its
non-negative solution against the histogram says how often to repeat each.
Counts are rounded down, so no combination asks for pieces that aren't there,
and the residual histogram is packed greedily: longest bin first, filled with
the longest bins that still fit, repeated as often as the counts allow.

The plan has a bounded size (bins, not documents). Pieces find their place by
arithmetic: a piece's number within its bin gives the combination, the repeat
and the slot. Numbers come from counts per input partition and bin, summed up
over partitions, so no bin is ever sorted or gathered in one task, and a bin
with a third of all pieces is dealt out like any other.
"""

from __future__ import annotations

import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import vocab
from .scratch import Scratch, ship

WINDOW = 4096
GRID = 16
DEPTH = 3
END_ID = 2

_memos: dict[str, vocab.ChunkMemo] = {}


def combinations(bins: int, depth: int) -> list[tuple[int, ...]]:
    """Non-increasing bin tuples of at most ``depth`` parts that sum to ``bins``."""
    out: list[tuple[int, ...]] = []

    def extend(head: tuple[int, ...], left: int) -> None:
        if left == 0:
            out.append(head)
        elif len(head) == depth - 1:
            if not head or left <= head[-1]:
                out.append((*head, left))
        elif len(head) < depth:
            for b in range(min(left, head[-1] if head else left), 0, -1):
                extend((*head, b), left - b)

    extend((), bins)
    return out


def nnls(a: np.ndarray, b: np.ndarray, rounds: int | None = None, tol: float = 1e-7, block: int = 16) -> np.ndarray:
    """min ||a x - b|| with x >= 0: the active-set method of Lawson and Hanson.

    Up to ``block`` columns enter at once, the best of each; passive systems
    are solved by normal equations (their size is at most the rows of ``a``).
    """
    m, n = a.shape
    x = np.zeros(n)
    passive = np.zeros(0, np.int64)
    scale = max(1e-300, float((a.T @ b).max(initial=0.0)))
    error = np.inf
    for _ in range(rounds or 2 * m):
        gradient = a.T @ (b - a[:, passive] @ x[passive])
        gradient[passive] = -np.inf
        if error <= float(np.sum((b - a[:, passive] @ x[passive]) ** 2)) * (1 + 1e-12):
            block = 1  # no progress with many at once
        error = float(np.sum((b - a[:, passive] @ x[passive]) ** 2))
        best = np.argsort(-gradient)[: max(1, min(block, m - len(passive)))]
        best = best[gradient[best] > tol * scale]
        if not len(best):
            break
        passive = np.append(passive, best)
        while len(passive):
            p = a[:, passive]
            gram = p.T @ p
            gram[np.diag_indices_from(gram)] += 1e-10
            z = np.linalg.solve(gram, p.T @ b)
            low = z <= 0
            if not low.any():
                x[passive] = z
                break
            step = np.min(x[passive][low] / np.maximum(x[passive][low] - z[low], 1e-300))
            x[passive] += step * (z - x[passive])
            gone = low & (x[passive] <= 1e-13)
            if not gone.any():
                gone = np.arange(len(z)) == np.argmin(z)
            x[passive[gone]] = 0
            passive = passive[~gone]
    return x


def plan(histogram: np.ndarray, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """[(bins of a sequence, repeats)] that places every piece of the histogram (index: bin; 0 is unused)."""
    bins = len(histogram) - 1
    left = histogram.astype(np.int64).copy()
    total = left.sum()
    out: list[tuple[tuple[int, ...], int]] = []
    if total:
        shapes = [c for c in combinations(bins, depth) if all(left[list(c)] > 0)]
        if shapes:
            a = np.zeros((bins, len(shapes)))
            for j, c in enumerate(shapes):
                for b in c:
                    a[b - 1, j] += 1
            # Short pieces fit anywhere, so missing them costs little.
            weight = np.where(np.arange(1, bins + 1) <= max(1, bins // 32), 0.1, 1.0)
            x = nnls(a * weight[:, None], left[1:] / total * weight)
            for j in np.argsort(-x, kind="stable"):
                need = np.bincount(shapes[j], minlength=bins + 1)
                k = min(int(x[j] * total + 1e-6), int((left[need > 0] // need[need > 0]).min()))
                if k > 0:
                    left -= k * need
                    out.append((shapes[j], k))
    while left.any():
        shape, room, b = [], bins, bins
        used = np.zeros(bins + 1, np.int64)
        while room:
            b = min(b, room)
            while b and left[b] - used[b] <= 0:
                b -= 1
            if not b:
                break
            take = min(room // b, int(left[b] - used[b]))
            # A bin that is plentiful repeats within the sequence; a scarce one is taken once.
            shape += [b] * take
            used[b] += take
            room -= b * take
        k = int((left[used > 0] // used[used > 0]).min())
        left -= k * used
        out.append((tuple(shape), k))
    return out


def _forget() -> None:
    _memos.clear()
    vocab.unload()


def pieces(docs: DataFrame, id_col: str, text_col: str, path: str, window: int, grid: int) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, bin, part, number): window-sized pieces and the rest of each document."""
    source = docs.select(id_col, text_col)
    kind = source.schema[id_col].dataType.simpleString()

    def run(batches):
        from pyspark import TaskContext

        vocab.only("packing", _forget)
        if path not in _memos:
            ids = vocab.library_encoder(path)
            _memos[path] = vocab.ChunkMemo(vocab.load(path), lambda p: array("I", [p] if isinstance(p, int) else ids(p)).tobytes(), b"".join)
        get, part = _memos[path].__getitem__, TaskContext.get().partitionId()
        end, width, seen = np.array([END_ID], "<u4").tobytes(), 4 * window, np.zeros(window // grid + 1, np.int64)
        for batch in batches:
            row, start, length, crc, total, bins, number = [], [], [], [], [], [], []
            texts = batch.column(1).cast(pa.large_binary())
            for k in range(batch.num_rows):
                data = b"".join([x for words in vocab.pieces_of(texts[k].as_py() or b"") for x in map(get, words)]) + end
                n = len(data) // 4
                for at in range(0, len(data), width):
                    size = min(width, len(data) - at) // 4
                    b = -(-size // grid)
                    row.append(k)
                    start.append(at // 4)
                    length.append(size)
                    crc.append(zlib.crc32(data[at : at + width]))
                    total.append(n)
                    bins.append(b)
                    number.append(seen[b])
                    seen[b] += 1
            columns = [batch.column(0).take(pa.array(row, pa.int64()))] + [pa.array(x, pa.int64()) for x in (start, length, crc, total, bins, [part] * len(row), number)]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "start", "length", "ids_crc32", "doc_tokens", "bin", "part", "number"])

    return source.mapInArrow(run, f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, bin long, part long, number long")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, window: int = WINDOW, grid: int = GRID, depth: int = DEPTH) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset): every token of every document in one place.

    A null or empty text is one piece with the end token alone; repeated rows
    are packed as often as they occur; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    ship(spark)
    path = path or vocab.vocabulary_path()
    scratch = Scratch(spark, "packing")
    table = scratch.put(pieces(docs, id_col, text_col, path, window, grid), "pieces")
    per_part = table.groupBy("part", "bin").agg(F.count(F.lit(1)).alias("n"))
    histogram = np.zeros(window // grid + 1, np.int64)
    for b, n in per_part.groupBy("bin").agg(F.sum("n")).collect():  # at most window / grid rows
        histogram[b] = n
    shapes = plan(histogram, depth)

    # For each bin: where each combination's slots begin, how many it has a sequence, and its first sequence.
    slots: dict[int, list[tuple[int, int, int]]] = {}
    placed, sequences = np.zeros(len(histogram), np.int64), 0
    for shape, repeats in shapes:
        for b, times in zip(*np.unique(shape, return_counts=True)):
            slots.setdefault(int(b), []).append((int(placed[b]), int(times), sequences))
            placed[b] += times * repeats
        sequences += repeats
    lookup = {b: tuple(np.array(x, np.int64) for x in zip(*v)) for b, v in slots.items()}

    before = F.sum("n").over(Window.partitionBy("bin").orderBy("part")) - F.col("n")
    numbered = table.join(per_part.select("part", "bin", before.alias("before")), ["part", "bin"])
    numbered = numbered.select(id_col, "start", "length", "ids_crc32", "doc_tokens", "bin", "part", "number", (F.col("before") + F.col("number")).alias("rank"))
    kind = docs.schema[id_col].dataType.simpleString()

    def place(batches):
        for batch in batches:
            bins, rank = batch.column(5).to_numpy(), batch.column(8).to_numpy()
            sequence = np.zeros(len(bins), np.int64)
            for b in np.unique(bins):
                at = np.flatnonzero(bins == b)
                first, times, base = lookup[int(b)]
                s = np.searchsorted(first, rank[at], side="right") - 1
                sequence[at] = base[s] + (rank[at] - first[s]) // times[s]
            yield pa.RecordBatch.from_arrays([*batch.columns[:8], pa.array(sequence)], names=[*batch.schema.names[:8], "sequence_id"])

    placed_rows = numbered.mapInArrow(place, f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, bin long, part long, number long, sequence_id long")
    order = Window.partitionBy("sequence_id").orderBy("bin", "part", "number")
    offset = (F.sum("length").over(order) - F.col("length")).alias("offset")
    return placed_rows.select(id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", offset)
