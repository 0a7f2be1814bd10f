"""Settings of a composite: bands, indices, percentiles, harmonics and static layers."""

from __future__ import annotations

from dataclasses import dataclass, field

# Names of bands and layers, the legend, and the settings' defaults.
BANDS = ("blue", "green", "red", "nir", "swir1", "swir2")
TOPOGRAPHY = ("elevation", "slope", "aspect", "eastness", "northness")
WATER = ("occurrence", "change_abs", "change_norm", "seasonality", "transition", "max_extent")
TASSELLED = ("brightness", "greenness", "wetness", "fourth", "fifth", "sixth")
TASSELLED_ANGLES = ("tcAngleBG", "tcAngleGW", "tcAngleBW", "tcDistBG", "tcDistGW", "tcDistBW")

#: Class codes and names of the land-cover legend.
LEGEND = {1: "Bare", 2: "Built", 3: "Crop", 4: "Forest", 5: "Grass", 6: "Shrub", 7: "Water", 8: "Wetland"}


@dataclass(frozen=True)
class HarmonicRange:
    """Days of the year that a harmonic fit uses: ``start <= day < end``, or ``<= end`` when inclusive."""

    start: int = 1
    end: int = 365
    inclusive_end: bool = False


@dataclass(frozen=True)
class CompositeConfig:
    indices: tuple[str, ...] = ("EVI", "SAVI", "IBI")
    percentiles: tuple[int, ...] = (10, 25, 50, 75, 90)
    harmonics: dict[str, HarmonicRange] = field(default_factory=lambda: {"nir": HarmonicRange(), "swir1": HarmonicRange()})
    add_harmonics: bool = True
    add_tasselled_cap: bool = False
    add_water: bool = False
    add_topography: bool = True
    cloudy_percentage: float = 70
    cloud_probability: float = 40
    dark_nir: float = 0.15 * 10_000
    shadow_steps: int = 20
    #: Sides, in cells, of the grids on which shadows are projected and masks eroded and dilated.
    shadow_grid: int = 10
    mask_grid: int = 2
    erode: int = 2
    dilate: int = 10
    approximate_percentiles: bool = False

    def bands(self) -> list[str]:
        extra = [*TASSELLED, *TASSELLED_ANGLES] if self.add_tasselled_cap else []
        return [*BANDS, *self.indices, *extra]

    def feature_names(self) -> list[str]:
        """The stack's columns, in order; known before anything runs."""
        names = [f"{b}_p{p}" for b in self.bands() for p in self.percentiles]
        if self.add_harmonics:
            unknown = set(self.harmonics) - set(self.bands())
            if unknown:
                raise ValueError(f"harmonics of unknown bands: {sorted(unknown)}")
            names += [f"{b}_{part}" for b in self.harmonics for part in ("phase", "amplitude")]
        if self.add_water:
            names += WATER
        if self.add_topography:
            names += TOPOGRAPHY
        return names
