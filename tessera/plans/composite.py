"""The annual composite, from scenes to a feature stack."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import BANDS, TOPOGRAPHY, WATER, CompositeConfig
from ..functions.geometry import extent
from ..functions.indices import add_indices, add_tasselled_cap
from ..operators.clouds import mask_scenes
from ..operators.joins import static_layers
from ..operators.temporal import between_dates, composite

#: Sensor bands and their names here.
SENSOR_BANDS = {"B2": "blue", "B3": "green", "B4": "red", "B8": "nir", "B11": "swir1", "B12": "swir2"}


def select_bands(df: DataFrame, keys: list[str], bands: dict[str, str] | None = None) -> DataFrame:
    return df.select(*keys, *[F.col(a).alias(b) for a, b in (bands or SENSOR_BANDS).items()])


def scenes_of_year(scenes: DataFrame, first: int, last: int, config: CompositeConfig, ts: str = "ts") -> DataFrame:
    """Scenes from the first of January to before the last of December, with few enough clouds."""
    return scenes.filter(between_dates(F.col(ts), f"{first}-01-01", f"{last}-12-31")).filter(F.col("cloudy_pct") <= config.cloudy_percentage)


def masked_observations(obs: DataFrame, scenes: DataFrame, clouds: DataFrame, config: CompositeConfig) -> DataFrame:
    """Observations of the scenes, without values under each scene's cloud and shadow mask.

    ``clouds`` holds the pixels of cloud images (scene, cloud_id, x, y,
    probability); a scene takes its first image, one without any goes.
    """
    images = clouds.join(scenes.select("scene"), "scene", "left_semi")
    images = images.withColumn("__first", F.min("cloud_id").over(Window.partitionBy("scene"))).filter(F.col("cloud_id") == F.col("__first"))
    paired = scenes.join(images.select("scene").distinct(), "scene", "left_semi").select("scene", "azimuth")
    return mask_scenes(obs.join(paired, "scene"), images, config).drop("azimuth")


def near_polygons(df: DataFrame, polygons: DataFrame, margin: int, ring_col: str = "geom") -> DataFrame:
    """Rows whose cells lie in the box around all polygons, grown by a margin: bare comparisons, so they reach the scan."""
    corners = polygons.select(F.explode(ring_col).alias("p")).select("p.x", "p.y")
    x0, y0, x1, y1 = extent(corners).first()  # one row
    if x0 is None:
        return df.limit(0)
    return df.filter(F.col("x").between(math.floor(x0) - margin, math.ceil(x1) + margin) & F.col("y").between(math.floor(y0) - margin, math.ceil(y1) + margin))


def feature_stack(obs: DataFrame, keys: list[str], config: CompositeConfig | None = None, topography: DataFrame | None = None, water: DataFrame | None = None, footprint: DataFrame | None = None) -> DataFrame:
    """One row per pixel with ``config.feature_names()``.

    With a footprint (keys of pixels to keep) only its pixels are computed,
    and the filled static layers stay inside it; without, every pixel is.
    """
    config = config or CompositeConfig()
    names = config.feature_names()
    if footprint is not None:
        obs = obs.join(footprint.select(*keys).distinct(), keys, "left_semi")
    obs = add_indices(obs, config.indices)
    if config.add_tasselled_cap:
        obs = add_tasselled_cap(obs)
    stack = composite(obs, keys, config.bands(), config.percentiles, config.harmonics if config.add_harmonics else None, approximate=config.approximate_percentiles)
    if config.add_water:
        stack = static_layers(stack, water, keys, list(WATER))
    if config.add_topography:
        stack = static_layers(stack, topography, keys, list(TOPOGRAPHY))
    missing = [n for n in names if n not in stack.columns]
    if missing:
        raise ValueError(f"features missing from the stack: {missing}")
    return stack.select(*keys, *names)


def landsat_covariates(image: DataFrame, keys: list[str], water: DataFrame | None = None, topography: DataFrame | None = None) -> DataFrame:
    """Low, median and high reflectance composites with all indices and tasselled caps, under p20_, no and p80_ prefixes."""
    from ..functions.indices import INDICES, scale_reflectance, with_prefix

    bands = [p + b for p in ("p20_", "", "p80_") for b in BANDS]
    scaled = scale_reflectance(image, bands, "thermal" if "thermal" in image.columns else None)
    out = None
    for prefix in ("p20", "", "p80"):
        part = scaled.select(*keys, *[F.col(f"{prefix}_{b}" if prefix else b).alias(b) for b in BANDS])
        part = add_indices(add_tasselled_cap(part), list(INDICES))
        if water is not None:
            part = static_layers(part, water, keys, list(WATER))
        if topography is not None:
            part = static_layers(part, topography, keys, list(TOPOGRAPHY))
        part = with_prefix(part, prefix, tuple(keys)) if prefix else part
        out = part if out is None else out.join(part, keys)
    return out
