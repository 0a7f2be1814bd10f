"""Neighbourhood operators on grids of integer cells (x, y).

Wide ones work on tiles with a margin (``tiles``): one exchange, and little
more than a row for each cell in it, whatever the radius. The small ones (the
four neighbours, the three by three square) scatter: each cell sends its value
to the cells whose neighbourhoods hold it, and a combinable aggregate meets
them there, so neighbours within an input partition meet before the exchange.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tiles import Group, Plane, by_tile


#: Steps this close to the middle between two cells go to the nearer to the start, whatever the last bit of a cosine.
EDGE = 1e-9


def circle(radius: int) -> list[tuple[int, int]]:
    return [(dx, dy) for dx in range(-radius, radius + 1) for dy in range(-radius, radius + 1) if dx * dx + dy * dy <= radius * radius]


def square(size: int) -> list[tuple[int, int]]:
    """Offsets of a size by size kernel of ones."""
    half = size // 2
    return [(dx, dy) for dx in range(-half, half + 1) for dy in range(-half, half + 1)]


def scatter(cells: DataFrame, offsets: list[tuple[int, int]], keys: tuple[str, ...] = ()) -> DataFrame:
    """Every row once for each offset, moved there; the offsets are a short literal."""
    steps = F.array(*[F.struct(F.lit(dx).cast("long").alias("dx"), F.lit(dy).cast("long").alias("dy")) for dx, dy in offsets])
    others = [c for c in cells.columns if c not in ("x", "y")]
    moved = cells.withColumn("__o", F.explode(steps))
    return moved.select((F.col("x") + F.col("__o.dx")).alias("x"), (F.col("y") + F.col("__o.dy")).alias("y"), *others)


def focal_min(cells: DataFrame, band: str, radius: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, x, y, band): the least value within a circle; cells outside the grid and NULLs don't count."""

    def work(rows: Group) -> list[pa.Array]:
        plane, v = Plane(rows.x, rows.y, radius), rows.column("__v")
        at = plane.at(rows.g, rows.x, rows.y)
        order = np.lexsort((v, at))  # of rows on one cell the least comes first
        marks, least, best = at[order], v[order], np.full(len(v), np.nan)
        for dx, dy in circle(radius):
            there = at + (dy * plane.width + dx)
            k = np.minimum(np.searchsorted(marks, there), len(marks) - 1)
            best = np.fmin(best, np.where(marks[k] == there, least[k], np.nan))
        return [pa.array(best, pa.float64(), mask=np.isnan(best))]

    out = by_tile(cells.select(*keys, "x", "y", F.col(band).cast("double").alias("__v")), radius, work, "__out double", keys)
    return out.select(*keys, "x", "y", F.col("__out").cast(cells.schema[band].dataType).alias(band))


def focal_max(cells: DataFrame, band: str, radius: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, x, y, band): the greatest value of a 0/1 band within a circle; of the margin only ones are sent."""

    def work(rows: Group) -> list[pa.Array]:
        plane = Plane(rows.x, rows.y, radius)
        at = plane.at(rows.g, rows.x, rows.y)
        marks = np.unique(at[rows.table["__one"].to_numpy(zero_copy_only=False)])
        return [pa.array(plane.within(at, marks, radius).astype(np.int32))]

    one = F.coalesce(F.col(band) == 1, F.lit(False))
    out = by_tile(cells.select(*keys, "x", "y", one.alias("__one")), 0, work, "__out int", keys, radius, F.col("__one"))
    return out.select(*keys, "x", "y", F.col("__out").alias(band))


def project(cells: DataFrame, flag: str, azimuth: float | Column, steps: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """Cells that lie up to some steps from a flagged cell along a direction, in degrees counter-clockwise from x."""
    on = [*keys, "x", "y"]
    angle = F.radians(F.lit(azimuth) if isinstance(azimuth, (int, float)) else azimuth)
    cast = cells.filter(F.col(flag)).withColumn("__k", F.explode(F.sequence(F.lit(1), F.lit(steps))))
    step = lambda v: (F.signum(v) * F.floor(F.abs(v) + (0.5 - EDGE))).cast("long")
    x = (F.col("x") + step(F.col("__k") * F.cos(angle))).alias("x")
    y = (F.col("y") + step(F.col("__k") * F.sin(angle))).alias("y")
    return cast.select(*keys, x, y).distinct().join(cells.select(*on), on, "left_semi")


def neighbourhood(cells: DataFrame, band: str, size: int = 3, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, x, y, mean, variance) over a square kernel."""
    on = [*keys, "x", "y"]
    spread = scatter(cells.select(*on, band), square(size)).groupBy(*on).agg(F.avg(band).alias("mean"), F.var_pop(band).alias("variance"))
    return spread.join(cells.select(*on), on, "left_semi")


def coarsen(cells: DataFrame, factor: int, aggregates: list[Column], keys: tuple[str, ...] = ()) -> DataFrame:
    """The grid in steps of ``factor`` cells."""
    big = lambda c: F.floor(F.col(c) / factor).cast("long").alias(c)
    return cells.select(*[big(c) if c in ("x", "y") else c for c in cells.columns]).groupBy(*keys, "x", "y").agg(*aggregates)


def terrain(cells: DataFrame, elevation: str = "elevation", scale: float = 1.0, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, x, y, elevation, slope, aspect) in degrees, from the four neighbours; NULL at the edges.

    Aspect is the downhill direction clockwise from north (y grows to the north); NULL on flat ground.
    """
    on = [*keys, "x", "y"]
    sides = {"__w": (1, 0), "__e": (-1, 0), "__s": (0, 1), "__n": (0, -1)}
    steps = F.array(*[F.struct(F.lit(dx).cast("long").alias("dx"), F.lit(dy).cast("long").alias("dy"), F.lit(k).alias("side")) for k, (dx, dy) in sides.items()])
    sent = cells.select(*on, F.col(elevation).alias("__v"), F.explode(F.concat(steps, F.array(F.struct(F.lit(0).cast("long").alias("dx"), F.lit(0).cast("long").alias("dy"), F.lit("__c").alias("side"))))).alias("__o"))
    sent = sent.select(*keys, (F.col("x") + F.col("__o.dx")).alias("x"), (F.col("y") + F.col("__o.dy")).alias("y"), F.col("__o.side").alias("side"), "__v")
    pick = lambda k: F.max(F.when(F.col("side") == k, F.col("__v"))).alias(k)
    met = sent.groupBy(*on).agg(*[pick(k) for k in [*sides, "__c"]], F.max(F.when(F.col("side") == "__c", 1)).alias("__is")).filter("__is = 1")
    gx, gy = (F.col("__e") - F.col("__w")) / (2 * scale), (F.col("__n") - F.col("__s")) / (2 * scale)
    flat = (gx == 0) & (gy == 0)
    aspect = F.when(~flat, F.pmod(F.degrees(F.atan2(-gx, -gy)) + 360, F.lit(360.0)))
    return met.select(*on, F.col("__c").alias(elevation), F.degrees(F.atan(F.hypot(gx, gy))).alias("slope"), aspect.alias("aspect"))


def eastness_northness() -> dict[str, Column]:
    rad = F.radians(F.col("aspect"))
    return {"eastness": F.sin(rad), "northness": F.cos(rad)}


def topography(cells: DataFrame, elevation: str = "elevation", scale: float = 1.0, keys: tuple[str, ...] = ()) -> DataFrame:
    return terrain(cells, elevation, scale, keys).withColumns(eastness_northness())


def shadow_azimuth(solar: Column) -> Column:
    return F.lit(90.0) - solar
