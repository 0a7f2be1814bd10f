"""Spectral indices as column expressions over blue, green, red, nir, swir1 and swir2.

Divisions by zero and masked inputs give NULL. A normalised difference of a
negative input is masked, too.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import BANDS, TASSELLED

#: Pairs of the normalised differences ``ND_<a>_<b>``.
ND_PAIRS = (
    ("blue", "green"), ("blue", "red"), ("blue", "nir"), ("blue", "swir1"), ("blue", "swir2"),
    ("green", "red"), ("green", "nir"), ("green", "swir1"), ("green", "swir2"),
    ("red", "swir1"), ("red", "swir2"),
    ("nir", "red"), ("nir", "swir1"), ("nir", "swir2"),
    ("swir1", "swir2"),
)

# The tasselled-cap coefficients, a row per component and a column per band.
TASSELLED_CAP = (
    (0.3037, 0.2793, 0.4743, 0.5585, 0.5082, 0.1863),
    (-0.2848, -0.2435, -0.5436, 0.7243, 0.0840, -0.1800),
    (0.1509, 0.1973, 0.3279, 0.3406, -0.7112, -0.4572),
    (-0.8242, 0.0849, 0.4392, -0.0580, 0.2012, -0.2768),
    (-0.3280, 0.0549, 0.1075, 0.1855, -0.4357, 0.8085),
    (0.1084, -0.9022, 0.4120, 0.0573, -0.0251, 0.0238),
)


def div(a: Column, b: Column) -> Column:
    """a / b, NULL where b is 0."""
    return F.try_divide(a, b)


def nd(a: Column, b: Column) -> Column:
    """(a - b) / (a + b), NULL where either is negative or both are 0."""
    return F.when((a >= 0) & (b >= 0), div(a - b, a + b))


def evi(nir: Column, red: Column, blue: Column) -> Column:
    return F.lit(2.5) * div(nir - red, nir + 6 * red - 7.5 * blue + 1)


def savi(nir: Column, red: Column, soil: float = 0.5) -> Column:
    return div((nir - red) * (1 + soil), nir + red + soil)


def ibi(green: Column, red: Column, nir: Column, swir1: Column) -> Column:
    built = div(2 * swir1, swir1 + nir)
    other = div(nir, nir + red) + div(green, green + swir1)
    return nd(built, other)


def _c(name: str) -> Column:
    return F.col(name)


INDICES: dict[str, Callable[[], Column]] = {
    **{f"ND_{a}_{b}": (lambda a=a, b=b: nd(_c(a), _c(b))) for a, b in ND_PAIRS},
    "R_swir1_nir": lambda: div(_c("swir1"), _c("nir")),
    "R_red_swir1": lambda: div(_c("red"), _c("swir1")),
    "EVI": lambda: evi(_c("nir"), _c("red"), _c("blue")),
    "SAVI": lambda: savi(_c("nir"), _c("red")),
    "IBI": lambda: ibi(_c("green"), _c("red"), _c("nir"), _c("swir1")),
}


def add_indices(df: DataFrame, names: list[str] | tuple[str, ...]) -> DataFrame:
    """The rows with the named indices; unknown names fail before anything runs."""
    unknown = [n for n in names if n not in INDICES]
    if unknown:
        raise ValueError(f"unknown indices: {unknown}")
    return df.withColumns({n: INDICES[n]() for n in names})


def tasselled_cap(bands: tuple[str, ...] = BANDS) -> dict[str, Column]:
    """brightness, greenness, wetness and three more components: a matrix product, written out."""
    out = {}
    for name, row in zip(TASSELLED, TASSELLED_CAP):
        total = F.lit(row[0]) * _c(bands[0])
        for k, b in zip(row[1:], bands[1:]):
            total = total + F.lit(k) * _c(b)
        out[name] = total
    return out


def angle(x: Column, y: Column) -> Column:
    """The angle of the vector (x, y), in radians."""
    return F.atan2(y, x)


def tasselled_angles() -> dict[str, Column]:
    """Angles (in units of pi) and lengths of the brightness, greenness and wetness pairs."""
    pairs = {"BG": ("brightness", "greenness"), "GW": ("greenness", "wetness"), "BW": ("brightness", "wetness")}
    out = {f"tcAngle{k}": angle(_c(a), _c(b)) / math.pi for k, (a, b) in pairs.items()}
    return out | {f"tcDist{k}": F.hypot(_c(a), _c(b)) for k, (a, b) in pairs.items()}


def add_tasselled_cap(df: DataFrame) -> DataFrame:
    return df.withColumns(tasselled_cap()).withColumns(tasselled_angles())


def scale_reflectance(df: DataFrame, bands: list[str], thermal: str | None = None) -> DataFrame:
    """Reflectance bands times 0.0001, a thermal band over 10."""
    scaled = {b: F.col(b) * 0.0001 for b in bands}
    if thermal:
        scaled[thermal] = F.col(thermal) / 10
    return df.withColumns(scaled)


def with_prefix(df: DataFrame, prefix: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Every band but the keys renamed to ``<prefix>_<band>``."""
    return df.select([F.col(c) if c in keys else F.col(c).alias(f"{prefix}_{c}") for c in df.columns])


def select_like(df: DataFrame, pattern: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """The keys and the bands whose whole name matches a regular expression."""
    import re

    return df.select([c for c in df.columns if c in keys or re.fullmatch(pattern, c)])


def add_bands(df: DataFrame, bands: dict[str, Column]) -> DataFrame:
    """New bands; a name that is there already is an error, not a silent suffix."""
    taken = set(df.columns) & set(bands)
    if taken:
        raise ValueError(f"bands exist already: {sorted(taken)}")
    return df.withColumns(bands)


def new_names(wanted: list[str], present: list[str]) -> list[str]:
    """Wanted names that aren't present yet, in order."""
    return [n for n in wanted if n not in present]


def hsv_to_rgb(h: Column, s: Column, v: Column) -> dict[str, Column]:
    """Red, green and blue of hue, saturation and value in [0, 1]."""
    sector = F.floor(h * 6)
    f = h * 6 - sector
    p, q, t = v * (1 - s), v * (1 - f * s), v * (1 - (1 - f) * s)
    order = sector % 6
    pick = lambda *c: F.when(order == 0, c[0]).when(order == 1, c[1]).when(order == 2, c[2]).when(order == 3, c[3]).when(order == 4, c[4]).otherwise(c[5])
    return {"r": pick(v, q, p, p, t, v), "g": pick(t, v, v, q, p, p), "b": pick(p, p, t, v, v, q)}


def unit_scale(c: Column, low: float, high: float) -> Column:
    return (c - low) / (high - low)


def to_natural(db: Column) -> Column:
    return F.pow(F.lit(10.0), db / 10.0)


def to_db(natural: Column) -> Column:
    return F.when(natural > 0, F.log10(natural) * 10.0)


def planet_indices() -> dict[str, Column]:
    """NDVI, NDWI and SAVI of the bands R, G and N."""
    return {"NDVI": nd(_c("N"), _c("R")), "NDWI": nd(_c("G"), _c("N")), "SAVI": savi(_c("N"), _c("R"))}
