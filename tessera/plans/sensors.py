"""Stacks of the other sensors: radar means over two weeks, and monthly basemaps of a year."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import points_in_rings, within
from ..functions.indices import planet_indices
from ..operators.joins import static_layers
from ..operators.radar import dual_polarised, polarisation_ratio, speckle_filter, terrain_correction, two_week_mean
from ..operators.temporal import advance, calendar_years, from_ymd
from .composite import select_bands

MONTHS = list(range(1, 13))


def radar_composite(obs: DataFrame, scenes: DataFrame, elevation: DataFrame, start: date, footprints: DataFrame | None = None, erode: float = 0.0) -> DataFrame:
    """(x, y, VH, VV): natural backscatter of the two weeks from ``start``, flattened, filtered, averaged, times 10,000.

    ``obs`` is (scene, x, y, VV, VH, angle) in dB and degrees, ``scenes``
    (scene, ts, polarisations, mode). With footprints (scene, geom) only cells
    at least ``erode`` inside their scene's outline count.
    """
    begin = from_ymd(start.year, start.month, start.day)
    chosen = scenes.filter(dual_polarised(F.col("polarisations"), F.col("mode")) & (F.col("ts") >= begin) & (F.col("ts") < advance(begin, 2)))
    cells = obs.join(chosen.select("scene"), "scene").join(elevation.select("x", "y", "elevation"), ["x", "y"])
    keys = ("scene",)
    flat = terrain_correction(cells, keys)
    filtered = None
    for band in ("VV", "VH"):
        one = speckle_filter(flat, band, keys=keys).drop("branch")
        filtered = one if filtered is None else filtered.join(one, ["scene", "x", "y"])
    out = polarisation_ratio(filtered)
    if footprints is not None:
        rings = footprints.select(F.col("scene").alias("__of"), "geom")
        out = points_in_rings(out, rings, 64).filter(F.col("scene") == F.col("__of"))
        out = out.filter(within(F.col("geom"), F.col("x").cast("double"), F.col("y").cast("double"), -erode)).drop("geom", "__of")
    return two_week_mean(out, ["x", "y"], ["VH", "VV"])


def basemap_stack(images: DataFrame, year: int, topography: DataFrame | None = None, bands: dict[str, str] | None = None) -> DataFrame:
    """One row per cell: R, G, N, NDVI, NDWI and SAVI of each month of a year, and the terrain.

    ``images`` is (ts, x, y and the bands, under the names that ``bands`` maps to R, G and N).
    """
    bands = bands or {b: b for b in ("R", "G", "N")}
    monthly = select_bands(images.filter(calendar_years(F.col("ts"), year, year)), ["ts", "x", "y"], bands)
    monthly = monthly.groupBy("x", "y", F.month("ts").alias("month")).agg(*[F.avg(b).alias(b) for b in ("R", "G", "N")])
    monthly = monthly.withColumns(planet_indices())
    names = ["R", "G", "N", *planet_indices()]
    wide = monthly.groupBy("x", "y").pivot("month", MONTHS).agg(*[F.first(b).alias(b) for b in names])
    return wide if topography is None else static_layers(wide, topography, ["x", "y"], [c for c in topography.columns if c not in ("x", "y")], fill=None)
