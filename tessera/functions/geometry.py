"""Planar geometry on rings, arrays of (x, y) structs whose last point need not repeat the first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ring(points: list[tuple[float, float]]) -> Column:
    """A literal ring."""
    return F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in points])


def rectangle(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    point = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1))


def area(ring: Column) -> Column:
    """The ring's area (shoelace formula)."""
    turned = F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, 1, 1))
    cross = F.zip_with(ring, turned, lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda s, v: s + v)) / 2


def contains(ring: Column, x: Column, y: Column) -> Column:
    """Whether the point lies inside, by counting crossings of a ray; left and lower edges belong to the ring."""
    turned = F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, 1, 1))

    def crosses(a: Column, b: Column) -> Column:
        at = a["x"] + F.try_divide((y - a["y"]) * (b["x"] - a["x"]), b["y"] - a["y"])
        return ((a["y"] <= y) != (b["y"] <= y)) & (x >= at)

    hits = F.aggregate(F.zip_with(ring, turned, lambda a, b: F.when(crosses(a, b), 1).otherwise(0)), F.lit(0), lambda s, v: s + v)
    return hits % 2 == 1


def bounds(ring: Column) -> dict[str, Column]:
    """The ring's box as x0, y0, x1 and y1."""
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return {"x0": F.array_min(xs), "y0": F.array_min(ys), "x1": F.array_max(xs), "y1": F.array_max(ys)}


def buffered(box: dict[str, Column], distance: float) -> dict[str, Column]:
    """A box grown (or, for a negative distance, shrunk) on all sides."""
    return {"x0": box["x0"] - distance, "y0": box["y0"] - distance, "x1": box["x1"] + distance, "y1": box["y1"] + distance}


def distance_to_ring(ring: Column, x: Column, y: Column) -> Column:
    """Distance from a point to the nearest edge."""
    turned = F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, 1, 1))

    def to_edge(a: Column, b: Column) -> Column:
        dx, dy = b["x"] - a["x"], b["y"] - a["y"]
        t = F.coalesce(F.try_divide((x - a["x"]) * dx + (y - a["y"]) * dy, dx * dx + dy * dy), F.lit(0.0))
        t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
        return F.hypot(x - a["x"] - t * dx, y - a["y"] - t * dy)

    return F.array_min(F.zip_with(ring, turned, to_edge))


def within(ring: Column, x: Column, y: Column, distance: float) -> Column:
    """Inside the ring grown by a distance; a negative one asks to be that far inside the edge."""
    inside, gap = contains(ring, x, y), distance_to_ring(ring, x, y)
    return inside | (gap <= distance) if distance >= 0 else inside & (gap >= -distance)


def extent(df: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """One row: the box around all points."""
    return df.agg(F.min(x).alias("x0"), F.min(y).alias("y0"), F.max(x).alias("x1"), F.max(y).alias("y1"))


def points_in_rings(points: DataFrame, rings: DataFrame, cell: int, x: str = "x", y: str = "y", ring_col: str = "geom") -> DataFrame:
    """points joined with the rings that hold them.

    Rings are laid out on cells of a coarse grid and joined on the cell, so
    neither side is compared with all of the other.
    """
    box = bounds(F.col(ring_col))
    cells = lambda lo, hi: F.sequence(F.floor(lo / cell).cast("long"), F.floor(hi / cell).cast("long"))
    spread = rings.withColumn("__cx", F.explode(cells(box["x0"], box["x1"]))).withColumn("__cy", F.explode(cells(box["y0"], box["y1"])))
    placed = points.withColumns({"__cx": F.floor(F.col(x) / cell).cast("long"), "__cy": F.floor(F.col(y) / cell).cast("long")})
    joined = placed.join(spread, ["__cx", "__cy"])
    return joined.filter(contains(F.col(ring_col), F.col(x).cast("double"), F.col(y).cast("double"))).drop("__cx", "__cy")
