"""Work on tiles of a grid: each tile sees its cells and a margin of its neighbours', in one exchange.

A tile's rows come as columns to a function over arrays; many small tiles (of
sparse scenes, say) are worked on together. Cells are integers (x, y), sparse
or dense; nothing is laid out as a full array, so memory follows the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells of a tile's side, a multiple of all coarser grids; rows worked on together, tiles permitting.
TILE, ROWS = 1000, 200_000


class Group:
    """Rows of some tiles: ``g`` numbers the tiles, x and y count from the tile's corner."""

    def __init__(self, table: pa.Table, g: np.ndarray, x: np.ndarray, y: np.ndarray):
        self.table, self.g, self.x, self.y = table, g, x, y

    def column(self, name: str) -> np.ndarray:
        """As doubles, NaN for NULL."""
        return self.table[name].cast(pa.float64()).to_numpy(zero_copy_only=False)


class Plane:
    """Positions (g, x, y) as sortable numbers, with so much room around each tile that neighbours never wrap."""

    def __init__(self, x: np.ndarray, y: np.ndarray, room: int):
        self.x0, self.y0 = int(x.min(initial=0)) - room - 1, int(y.min(initial=0)) - room - 1
        self.width = int(x.max(initial=0)) - self.x0 + room + 2
        self.height = int(y.max(initial=0)) - self.y0 + room + 2

    def at(self, g: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return (g * self.height + (y - self.y0)) * self.width + (x - self.x0)

    def within(self, cells: np.ndarray, marks: np.ndarray, radius: int) -> np.ndarray:
        """Whether a mark (sorted) lies within a circle around each cell: one search for each row of the circle."""
        found = np.zeros(len(cells), bool)
        if not len(marks):
            return found
        for dy in range(-radius, radius + 1):
            half = int(np.sqrt(radius * radius - dy * dy))
            first = cells + (dy * self.width - half)
            k = np.minimum(np.searchsorted(marks, first), len(marks) - 1)
            found |= (marks[k] >= first) & (marks[k] <= first + 2 * half)
        return found


def member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Whether each value is among some sorted ones."""
    if not len(of):
        return np.zeros(len(values), bool)
    k = np.minimum(np.searchsorted(of, values), len(of) - 1)
    return of[k] == values


def by_tile(
    cells: DataFrame,
    margin: int,
    work: Callable[[Group], list[pa.Array]],
    adds: str,
    keys: tuple[str, ...] = (),
    far: int = 0,
    far_rows: Column | None = None,
    light: tuple[str, ...] | None = None,
) -> DataFrame:
    """The cells with the columns ``adds`` (a schema) that ``work`` gives for each row.

    A tile also gets the rows up to ``margin`` cells around it, and, up to
    ``far`` cells, those that ``far_rows`` holds for. Rows outside their tile
    bring the ``light`` columns only, and don't come out.
    """
    reach = max(margin, far)
    tiles = lambda c: F.explode(F.sequence(F.floor((F.col(c) - reach) / TILE).cast("long"), F.floor((F.col(c) + reach) / TILE).cast("long")))
    spread = cells.withColumn("__tx", tiles("x")).withColumn("__ty", tiles("y"))
    inside = lambda c, t, m: (F.col(c) >= F.col(t) * TILE - m) & (F.col(c) < (F.col(t) + 1) * TILE + m)
    own = inside("x", "__tx", 0) & inside("y", "__ty", 0)
    if far > margin:
        spread = spread.filter((inside("x", "__tx", margin) & inside("y", "__ty", margin)) | F.coalesce(far_rows, F.lit(False)))
    if light is not None:
        heavy = [c for c in cells.columns if c not in {*keys, "x", "y", *light}]
        spread = spread.withColumns({c: F.when(own, F.col(c)) for c in heavy})
    names, group = cells.columns, [*keys, "__tx", "__ty"]
    added = [f.split()[0] for f in adds.split(", ")]

    def result(table: pa.Table, g: np.ndarray) -> Iterator[pa.RecordBatch]:
        tx, ty = (table[c].to_numpy() for c in ("__tx", "__ty"))
        x, y = table["x"].to_numpy() - tx * TILE, table["y"].to_numpy() - ty * TILE
        new = work(Group(table, g, x, y))
        mine = pa.array((x >= 0) & (x < TILE) & (y >= 0) & (y < TILE))
        out = pa.Table.from_arrays([*[table[c] for c in names], *new], names=[*names, *added]).filter(mine)
        yield from out.to_batches()

    def run(batches):
        held: list[pa.RecordBatch] = []

        def groups(table: pa.Table) -> np.ndarray:
            new = np.zeros(table.num_rows, bool)
            for c in group:
                code = table[c].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
                new[1:] |= code[1:] != code[:-1]
            return np.cumsum(new).astype(np.int64)

        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < ROWS:
                continue
            table = pa.Table.from_batches(held)
            g = groups(table)
            cut = int(np.searchsorted(g, g[-1]))  # the last tile may go on
            if cut:
                yield from result(table.slice(0, cut), g[:cut])
            held, size = table.slice(cut).to_batches(), table.num_rows - cut
        if size:
            table = pa.Table.from_batches(held)
            yield from result(table, groups(table))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cells.schema.fields)
    placed = spread.repartition(*group).sortWithinPartitions(*group)
    return placed.select(*names, "__tx", "__ty").mapInArrow(run, f"{schema}, {adds}")
