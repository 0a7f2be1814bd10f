"""Cloud and shadow masks of optical scenes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import BANDS, CompositeConfig
from .stencil import EDGE
from .tiles import TILE, Group, Plane, by_tile, member

WATER_CLASS = 6


def is_cloud(probability: Column, threshold: float) -> Column:
    return probability > threshold


def is_dark(nir: Column, scene_class: Column, threshold: float) -> Column:
    """Dark in near infrared, and not water."""
    return (nir < threshold) & (scene_class != WATER_CLASS)


def _margins(config: CompositeConfig) -> tuple[int, int]:
    """How far a cell's mask depends on other cells, and on clouds."""
    if TILE % config.shadow_grid or TILE % config.mask_grid:
        raise ValueError(f"the grids must divide a tile's side, {TILE}")
    near = (config.erode + config.dilate + 1) * config.mask_grid
    return near, near + (config.shadow_steps + 1) * config.shadow_grid


def margin(config: CompositeConfig) -> int:
    """How far around an area observations and clouds matter to the masks inside it."""
    return _margins(config)[1]


def _steps(v: np.ndarray) -> np.ndarray:
    return (np.sign(v) * np.floor(np.abs(v) + (0.5 - EDGE))).astype(np.int64)


def _mask(rows: Group, casting: np.ndarray, cell: np.ndarray, cloud: np.ndarray, dark: np.ndarray, azimuth: np.ndarray, config: CompositeConfig) -> tuple[np.ndarray, np.ndarray]:
    """(shadow, cloud mask) of the rows that are cells; ``casting`` rows are clouds that cast shadows."""
    s, m = config.shadow_grid, config.mask_grid
    # Shadows: on the coarse grid, up to some steps away from the sun.
    gx, gy = rows.x // s, rows.y // s
    plane = Plane(gx, gy, config.shadow_steps)
    at = plane.at(rows.g, gx, gy)
    _, k = np.unique(at[casting], return_index=True)
    k = np.flatnonzero(casting)[k]
    angle = np.deg2rad(azimuth[k])
    step = np.arange(1, config.shadow_steps + 1)[:, None]
    cast = plane.at(rows.g[k], gx[k] + _steps(step * np.cos(angle)), gy[k] + _steps(step * np.sin(angle)))
    shadow = cell & dark & member(at, np.unique(cast))
    # The mask: on its own grid, small patches eroded away and the rest dilated.
    gx, gy = rows.x // m, rows.y // m
    plane = Plane(gx, gy, max(config.erode, config.dilate))
    places, of = np.unique(plane.at(rows.g, gx, gy)[cell], return_inverse=True)
    marked = np.bincount(of, weights=(cloud | shadow)[cell], minlength=len(places)) > 0
    eroded = marked & ~plane.within(places, places[~marked], config.erode)
    mask = np.zeros(len(cell), bool)
    mask[cell] = plane.within(places, places[eroded], config.dilate)[of]
    return shadow, mask


def cloud_shadow_mask(cells: DataFrame, config: CompositeConfig | None = None, azimuth: float | Column = 90.0, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, x, y, clouds, shadows, cloudmask) of cells with ``probability``, ``nir`` and ``scl``.

    Shadows are dark cells in the clouds' projection away from the sun, which
    goes over a grid of ``shadow_grid`` cells. On a grid of ``mask_grid`` cells
    small patches are eroded away and the rest is dilated. One exchange.
    """
    config = config or CompositeConfig()
    near, far = _margins(config)
    azimuth = F.lit(float(azimuth)) if isinstance(azimuth, (int, float)) else azimuth
    cloud = F.coalesce(is_cloud(F.col("probability"), config.cloud_probability), F.lit(False))
    dark = F.coalesce(is_dark(F.col("nir"), F.col("scl"), config.dark_nir), F.lit(False))

    def work(rows: Group) -> list[pa.Array]:
        cloud, dark = (rows.column(c) > 0 for c in ("__cloud", "__dark"))
        shadow, mask = _mask(rows, cloud, np.ones(len(cloud), bool), cloud, dark, rows.column("__azimuth"), config)
        return [pa.array(v.astype(np.int32)) for v in (cloud, shadow, mask)]

    light = cells.select(*keys, "x", "y", cloud.cast("int").alias("__cloud"), dark.cast("int").alias("__dark"), azimuth.cast("double").alias("__azimuth"))
    out = by_tile(light, near, work, "clouds int, shadows int, cloudmask int", keys, far, F.col("__cloud") == 1)
    return out.select(*keys, "x", "y", "clouds", "shadows", "cloudmask")


def mask_scenes(obs: DataFrame, probabilities: DataFrame, config: CompositeConfig, bands: tuple[str, ...] = BANDS) -> DataFrame:
    """Observations (scene, x, y, ``azimuth``, bands, ...) with the bands NULL under the scene's cloud and shadow mask.

    ``probabilities`` is (scene, x, y, probability), a cloud image's pixels; of
    several on one cell the greatest counts. A cell without one is masked.
    Both meet by scene and tile in one exchange.
    """
    near, far = _margins(config)
    image = probabilities.select("scene", "x", "y", F.col("probability").cast("double").alias("__p"))
    dark = F.coalesce(is_dark(F.col("nir"), F.col("scl"), config.dark_nir), F.lit(False)).cast("int")
    sun = F.col("azimuth").cast("double")
    rows = obs.withColumns({"__dark": dark, "__azimuth": F.lit(90.0) - sun}).unionByName(image, allowMissingColumns=True)

    def work(group: Group) -> list[pa.Array]:
        p, seen = group.column("__p"), np.asarray(group.table["__dark"].is_valid())
        plane = Plane(group.x, group.y, 0)
        at = plane.at(group.g, group.x, group.y)
        order = np.lexsort((-p, at))  # pixels before observations, the greatest first; NaN comes last
        first = order[np.flatnonzero(np.diff(at[order], prepend=-1))]
        best = p[first][np.searchsorted(at[first], at)]
        cloud = best > config.cloud_probability
        # The sun stands where it stands for the whole scene; pixels of the cloud image don't bring it.
        azimuth = group.column("__azimuth")
        of_group = np.full(int(group.g.max(initial=-1)) + 1, np.nan)
        of_group[group.g[seen]] = azimuth[seen]
        cell = seen & ~np.isnan(best)
        casting = ~seen & (p > config.cloud_probability) & ~np.isnan(of_group)[group.g]
        _, mask = _mask(group, casting, cell, cloud, (group.column("__dark") > 0), of_group[group.g], config)
        return [pa.array(cell & ~mask)]

    far_rows = F.col("__p") > config.cloud_probability
    out = by_tile(rows, near, work, "__clear boolean", ("scene",), far, far_rows, light=("__p", "__dark", "__azimuth"))
    out = out.filter(F.col("__dark").isNotNull())
    return out.withColumns({b: F.when(F.col("__clear"), F.col(b)) for b in bands}).drop("__p", "__dark", "__azimuth", "__clear")
