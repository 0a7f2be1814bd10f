"""Time filters, percentile composites and harmonic trends.

A composite is one aggregation by pixel: percentiles and the regression's
moments share a single exchange of the observations.
"""

from __future__ import annotations

import math
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import HarmonicRange

YEAR_DAYS = 365.25


def between_dates(ts: Column, start: date | datetime | str, end: date | datetime | str) -> Column:
    """start <= ts < end; bare comparisons, so they reach the scan."""
    return (ts >= F.lit(str(start)).cast("timestamp_ntz")) & (ts < F.lit(str(end)).cast("timestamp_ntz"))


def day_of_year(ts: Column, start: int, end: int, inclusive_end: bool = False) -> Column:
    """start <= day < end, or <= end when inclusive."""
    day = F.dayofyear(ts)
    return (day >= start) & ((day <= end) if inclusive_end else (day < end))


def calendar_years(ts: Column, first: int, last: int) -> Column:
    """Whole years, both included, as a range of instants."""
    return between_dates(ts, f"{first}-01-01", f"{last + 1}-01-01")


def from_ymd(year: int, month: int, day: int) -> Column:
    return F.make_timestamp_ntz(F.lit(year), F.lit(month), F.lit(day), F.lit(0), F.lit(0), F.lit(0))


def advance(ts: Column, weeks: int) -> Column:
    """The instant some weeks later."""
    return ts + F.expr(f"INTERVAL '{7 * weeks}' DAY")


def fractional_years(ts: Column) -> Column:
    """Years of 365.25 days since 1970-01-01."""
    seconds = F.unix_micros(ts.cast("timestamp")) / 1e6
    return seconds / 86400.0 / YEAR_DAYS


def harmonic_terms(t: Column) -> dict[str, Column]:
    """constant, t, and the yearly cosine and sine."""
    angle = t * (2 * math.pi)
    return {"constant": F.lit(1), "t": t, "cos": F.cos(angle), "sin": F.sin(angle)}


def percentiles(bands: list[str], at: tuple[int, ...], approximate: bool = False) -> list[Column]:
    """An array of percentiles for each band; exact with linear interpolation, or approximate for wide pixels."""
    shares = [p / 100 for p in at]
    if approximate:
        return [F.percentile_approx(b, shares, 10_000).alias(f"__p_{b}") for b in bands]
    return [F.percentile(F.col(b), F.array(*[F.lit(s) for s in shares])).alias(f"__p_{b}") for b in bands]


def percentile_columns(bands: list[str], at: tuple[int, ...]) -> list[Column]:
    return [F.col(f"__p_{b}")[k].alias(f"{b}_p{p}") for b in bands for k, p in enumerate(at)]


_TERMS = ("t", "c", "s")
#: Years are counted from here in the sums, which keeps them exact enough; it changes no coefficient but the constant.
_MIDDLE = 30.0


def trend_terms(obs: DataFrame, harmonics: dict[str, HarmonicRange | None], ts: str) -> DataFrame:
    """The observations with t, cos and sin once, and their masked values for each fitted band."""
    terms = harmonic_terms(fractional_years(F.col(ts)))
    out = obs.withColumns({"__t": terms["t"] - _MIDDLE, "__c": terms["cos"], "__s": terms["sin"]})
    masked = {}
    for band, days in harmonics.items():
        use = F.col(band).isNotNull()
        if days is not None:
            use = use & day_of_year(F.col(ts), days.start, days.end, days.inclusive_end)
        masked |= {f"__{a}_{band}": F.when(use, F.col(f"__{a}")) for a in _TERMS}
        masked[f"__y_{band}"] = F.when(use, F.col(band).cast("double"))
    return out.withColumns(masked)


def trend_sums(band: str) -> list[Column]:
    """Sums and sums of products for a least-squares fit of band on t, cos and sin: plain, combinable sums."""
    x = {a: F.col(f"__{a}_{band}") for a in (*_TERMS, "y")}
    out = [F.count(x["y"]).alias(f"__n_{band}")] + [F.sum(x[a]).alias(f"__sum_{a}_{band}") for a in x]
    pairs = [(a, b) for i, a in enumerate(_TERMS) for b in (*_TERMS[i:], "y")]
    return out + [F.sum(x[a] * x[b]).alias(f"__sum_{a}{b}_{band}") for a, b in pairs]


def trend_coefficients(band: str) -> dict[str, Column]:
    """Coefficients of t, cos and sin by Cramer's rule; NULL where the fit is not determined."""
    n = F.col(f"__n_{band}")

    def m(ab: str) -> Column:  # the covariance
        one = lambda a: F.col(f"__sum_{a}_{band}")
        return F.try_divide(F.col(f"__sum_{ab}_{band}") - F.try_divide(one(ab[0]) * one(ab[1]), n), n)

    tt, tc, ts, cc, cs, ss = (m(k) for k in ("tt", "tc", "ts", "cc", "cs", "ss"))
    ty, cy, sy = (m(k) for k in ("ty", "cy", "sy"))

    def det(a, b, c, d, e, f, g, h, i):
        return a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)

    whole = det(tt, tc, ts, tc, cc, cs, ts, cs, ss)
    good = F.when((n >= 4) & (F.abs(whole) > 1e-12), whole)
    return {
        "t": F.try_divide(det(ty, tc, ts, cy, cc, cs, sy, cs, ss), good),
        "cos": F.try_divide(det(tt, ty, ts, tc, cy, cs, ts, sy, ss), good),
        "sin": F.try_divide(det(tt, tc, ty, tc, cc, cy, ts, cs, sy), good),
    }


def phase_amplitude(band: str) -> list[Column]:
    """The fitted wave's phase, the angle of (cos, sin), and its amplitude."""
    k = trend_coefficients(band)
    return [F.atan2(k["sin"], k["cos"]).alias(f"{band}_phase"), F.hypot(k["cos"], k["sin"]).alias(f"{band}_amplitude")]


def composite(obs: DataFrame, keys: list[str], bands: list[str], at: tuple[int, ...], harmonics: dict[str, HarmonicRange] | None = None, ts: str = "ts", approximate: bool = False) -> DataFrame:
    """One row per pixel: percentiles of every band, phase and amplitude of some."""
    harmonics = harmonics or {}
    aggregates = percentiles(bands, at, approximate) if at else []
    if harmonics:
        obs = trend_terms(obs, harmonics, ts)
    for band in harmonics:
        aggregates += trend_sums(band)
    out = percentile_columns(bands, at) if at else []
    for band in harmonics:
        out += phase_amplitude(band)
    return obs.groupBy(*keys).agg(*aggregates).select(*keys, *out)


def mean_composite(obs: DataFrame, keys: list[str], bands: list[str]) -> DataFrame:
    return obs.groupBy(*keys).agg(*[F.avg(b).alias(b) for b in bands])


def harmonic_rgb(df: DataFrame, phase: str, amplitude: str) -> DataFrame:
    """Phase as hue, 2.5 times the amplitude as saturation, full value."""
    from ..functions.indices import hsv_to_rgb, unit_scale

    return df.withColumns(hsv_to_rgb(unit_scale(F.col(phase), -math.pi, math.pi), F.col(amplitude) * 2.5, F.lit(1.0)))
