"""Radar backscatter: speckle filter, terrain flattening, polarisation ratio."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.indices import to_db, to_natural
from ..functions.masks import update_mask
from .stencil import neighbourhood, terrain

ENL = 7
KERNEL = 3


def dual_polarised(polarisations: Column, mode: Column) -> Column:
    """Interferometric wide swath scenes with both VV and VH."""
    return F.array_contains(polarisations, "VH") & F.array_contains(polarisations, "VV") & (mode == "IW")


def speckle_filter(cells: DataFrame, band: str, enl: float = ENL, size: int = KERNEL, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, x, y, band, branch) in dB.

    The coefficient of variation in the kernel decides: pure speckle becomes
    the mean, weak texture the maximum a posteriori value, strong texture stays.
    """
    on = [*keys, "x", "y"]
    natural = cells.select(*on, F.col(band).alias("__db"), to_natural(F.col(band)).alias("__n"))
    stats = neighbourhood(natural, "__n", size, keys)
    joined = natural.join(stats, on)
    cu, mean, n = 1 / math.sqrt(enl), F.col("mean"), F.col("__n")
    cmax = math.sqrt(2.0) * cu
    ci = F.try_divide(F.sqrt("variance"), mean)
    alpha = F.try_divide(F.lit(1.0 + cu * cu), ci * ci - cu * cu)
    b = alpha - (enl + 1.0)
    root = F.sqrt(mean * mean * b * b + alpha * mean * n * (4.0 * enl))
    textured = F.try_divide(b * mean + root, alpha * 2.0)
    value = F.when(ci <= cu, to_db(mean)).when(ci < cmax, to_db(textured)).otherwise(update_mask(F.col("__db"), ci >= cmax))
    branch = F.when(ci <= cu, "mean").when(ci < cmax, "textured").when(ci >= cmax, "raw")
    there = F.col("__n").isNotNull()  # a masked cell stays masked, whatever is around it
    return joined.select(*on, F.when(there, value).alias(band), F.when(there, branch).alias("branch"))


def polarisation_ratio(df: DataFrame) -> DataFrame:
    """VV and VH in natural units, and VH / VV."""
    vv, vh = to_natural(F.col("VV")), to_natural(F.col("VH"))
    return df.withColumns({"VV": vv, "VH": vh, "ratio": F.try_divide(vh, vv)})


def terrain_correction(cells: DataFrame, keys: tuple[str, ...] = (), scale: float = 1.0, polarisations: tuple[str, ...] = ("VV", "VH")) -> DataFrame:
    """(keys, x, y, polarisations, layover, shadow) of cells with ``elevation`` and the incidence ``angle``.

    Radiometric slope correction by the volumetric model. The look direction
    is the mean aspect of the incidence angle over the whole scene.
    """
    on = [*keys, "x", "y"]
    ground = terrain(cells, "elevation", scale, keys).select(*on, "slope", F.col("aspect").alias("phi_s"))
    looking = terrain(cells, "angle", scale, keys)
    mean = looking.groupBy(*keys).agg(F.avg("aspect").alias("phi_i")) if keys else looking.agg(F.avg("aspect").alias("phi_i"))
    joined = cells.join(ground, on)
    joined = joined.join(mean, list(keys)) if keys else joined.crossJoin(F.broadcast(mean))  # without keys, the one row of one scene
    phi_r, alpha_s, theta = F.radians(F.col("phi_i") - F.col("phi_s")), F.radians("slope"), F.radians("angle")
    alpha_r = F.atan(F.tan(alpha_s) * F.cos(phi_r))
    alpha_az = F.atan(F.tan(alpha_s) * F.sin(phi_r))
    incidence = F.acos(F.cos(alpha_az) * F.cos(theta - alpha_r))
    upright = math.pi / 2
    model = F.abs(F.try_divide(F.tan(F.lit(upright) - theta + alpha_r), F.tan(F.lit(upright) - theta)))
    out = {p: to_db(F.try_divide(F.try_divide(to_natural(F.col(p)), F.cos(theta)), model)).alias(p) for p in polarisations}
    layover, shadow = F.degrees(alpha_r) < F.col("angle"), F.degrees(incidence) < 85
    return joined.select(*on, *out.values(), layover.cast("int").alias("layover"), shadow.cast("int").alias("shadow"))


def two_week_mean(obs: DataFrame, keys: list[str], bands: list[str], factor: int = 10_000) -> DataFrame:
    """Means by pixel, times a factor, cut to whole numbers (after rounding to thousandths, which sums in any order agree on)."""
    return obs.groupBy(*keys).agg(*[F.round(F.avg(b) * factor, 3).cast("long").alias(b) for b in bands])
