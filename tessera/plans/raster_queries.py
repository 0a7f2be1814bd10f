"""Queries over observations and grids, with their DuckDB oracles."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BANDS, CompositeConfig, HarmonicRange
from ..functions import indices as ix
from ..functions import masks
from ..operators import clouds, joins, radar, stencil, temporal
from . import views
from .composite import feature_stack, masked_observations, scenes_of_year

KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None, *names: str):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = views.with_views(sql, *names) if names else sql
        return f

    return keep


def r(c: Column | str, digits: int = 6) -> Column:
    """Rounded half up in double arithmetic, the same in any engine."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c * F.lit(10.0**digits) + F.lit(0.5)) / F.lit(10.0**digits)


def rounded(df: DataFrame, bands: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({b: r(b, digits) for b in bands})


def sr(expr: str, name: str, digits: int = 6) -> str:
    return f"(floor(CAST({expr} AS DOUBLE) * {10.0**digits:.1f}::DOUBLE + 0.5::DOUBLE) / {10.0**digits:.1f}::DOUBLE) AS {name}"


def sdiv(a: str, b: str) -> str:
    return f"(({a}) / nullif({b}, 0))"


def snd(a: str, b: str) -> str:
    return f"(CASE WHEN ({a}) >= 0 AND ({b}) >= 0 THEN (({a}) - ({b})) / nullif(({a}) + ({b}), 0) END)"


S_EVI = "(2.5 * ((nir - red) / nullif(nir + 6 * red - 7.5 * blue + 1, 0)))"
S_SAVI = "((nir - red) * 1.5 / nullif(nir + red + 0.5, 0))"
S_IBI = snd(sdiv("2 * swir1", "swir1 + nir"), f"{sdiv('nir', 'nir + red')} + {sdiv('green', 'green + swir1')}")
S_KEYS = ", ".join(KEYS)

# Indices.

_ND = [f"ND_{a}_{b}" for a, b in ix.ND_PAIRS]


@query("idx_normdiff_all", f"SELECT {S_KEYS}, {', '.join(sr(snd(a, b), f'ND_{a}_{b}') for a, b in ix.ND_PAIRS)} FROM obs", "obs")
def idx_normdiff_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ix.add_indices(views.obs(spark, sf_dir), _ND), _ND).select(*KEYS, *_ND)


@query("idx_ratio_evi_savi_ibi", f"SELECT {S_KEYS}, {sr(sdiv('swir1', 'nir'), 'R_swir1_nir')}, {sr(sdiv('red', 'swir1'), 'R_red_swir1')}, {sr(S_EVI, 'EVI')}, {sr(S_SAVI, 'SAVI')}, {sr(S_IBI, 'IBI')} FROM obs", "obs")
def idx_ratio_evi_savi_ibi(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["R_swir1_nir", "R_red_swir1", "EVI", "SAVI", "IBI"]
    return rounded(ix.add_indices(views.obs(spark, sf_dir), names), names).select(*KEYS, *names)


_S_TC = {name: " + ".join(f"({k}) * {b}" for k, b in zip(row, BANDS)) for name, row in zip(ix.TASSELLED, ix.TASSELLED_CAP)}
_S_TC_CTE = ", tc AS (SELECT " + S_KEYS + ", " + ", ".join(f"{e} AS {n}" for n, e in _S_TC.items()) + " FROM obs) "


@query("idx_tasselcap", _S_TC_CTE + f"SELECT {S_KEYS}, {', '.join(sr(n, n, 9) for n in ix.TASSELLED)} FROM tc", "obs")
def idx_tasselcap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(views.obs(spark, sf_dir).withColumns(ix.tasselled_cap()), list(ix.TASSELLED), 9).select(*KEYS, *ix.TASSELLED)


_PAIRS = {"BG": ("brightness", "greenness"), "GW": ("greenness", "wetness"), "BW": ("brightness", "wetness")}


@query("idx_tc_angles", _S_TC_CTE + f"SELECT {S_KEYS}, " + ", ".join([sr(f"atan2({b}, {a}) / pi()", f"tcAngle{k}") for k, (a, b) in _PAIRS.items()] + [sr(f"sqrt({a} * {a} + {b} * {b})", f"tcDist{k}", 3) for k, (a, b) in _PAIRS.items()]) + " FROM tc", "obs")
def idx_tc_angles(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = ix.add_tasselled_cap(views.obs(spark, sf_dir))
    angles, far = [f"tcAngle{k}" for k in _PAIRS], [f"tcDist{k}" for k in _PAIRS]
    return rounded(rounded(df, angles), far, 3).select(*KEYS, *angles, *far)


@query(
    "planet_indices_pivot",
    f", m AS (SELECT px, month(ts) AS m, avg(red) AS R, avg(green) AS G, avg(nir) AS N FROM obs WHERE ts >= TIMESTAMP '1997-01-01' AND ts < TIMESTAMP '1998-01-01' GROUP BY 1, 2), i AS (SELECT px, m, {snd('N', 'R')} AS ndvi, {snd('G', 'N')} AS ndwi, (N - R) * 1.5 / nullif(N + R + 0.5, 0) AS savi FROM m) SELECT px, "
    + ", ".join(sr(f"max(CASE WHEN m = {m} THEN {b} END)", f"m{m}_{b}") for m in range(1, 13) for b in ("ndvi", "ndwi", "savi"))
    + " FROM i GROUP BY px",
    "obs",
)
def planet_indices_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = views.obs(spark, sf_dir).filter(temporal.calendar_years(F.col("ts"), 1997, 1997))
    df = df.groupBy("px", F.month("ts").alias("m")).agg(F.avg("red").alias("R"), F.avg("green").alias("G"), F.avg("nir").alias("N"))
    i = ix.planet_indices()
    df = df.select("px", "m", i["NDVI"].alias("ndvi"), i["NDWI"].alias("ndwi"), i["SAVI"].alias("savi"))
    wide = df.groupBy("px").pivot("m", list(range(1, 13))).agg(*[F.first(b).alias(b) for b in ("ndvi", "ndwi", "savi")])
    return wide.select("px", *[r(f"{m}_{b}").alias(f"m{m}_{b}") for m in range(1, 13) for b in ("ndvi", "ndwi", "savi")])


@query("scale_rename", f"SELECT {S_KEYS}, " + ", ".join(sr(f"{b} * 0.0001", f"p20_{b}", 9) for b in BANDS) + ", " + sr("swir2 / 10", "p20_thermal", 9) + " FROM obs", "obs")
def scale_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = ix.add_bands(views.obs(spark, sf_dir).select(*KEYS, *BANDS), {"thermal": F.col("swir2")})
    df = ix.with_prefix(ix.scale_reflectance(df, list(BANDS), "thermal"), "p20", tuple(KEYS))
    return rounded(ix.select_like(df, "p20_.*", tuple(KEYS)), [f"p20_{b}" for b in (*BANDS, "thermal")], 9)


# Filters.


@query("filter_date_halfopen", f"SELECT {S_KEYS}, {sr('nir', 'nir')} FROM obs WHERE ts >= TIMESTAMP '1996-01-01' AND ts < TIMESTAMP '1996-12-31'", "obs")
def filter_date_halfopen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(views.obs(spark, sf_dir).filter(temporal.between_dates(F.col("ts"), "1996-01-01", "1996-12-31")), ["nir"]).select(*KEYS, "nir")


@query("filter_doy", f"SELECT {S_KEYS}, CAST(dayofyear(ts) AS INTEGER) AS doy FROM obs WHERE dayofyear(ts) >= 60 AND dayofyear(ts) < 152", "obs")
def filter_doy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.obs(spark, sf_dir).filter(temporal.day_of_year(F.col("ts"), 60, 152)).select(*KEYS, F.dayofyear("ts").alias("doy"))


@query("filter_year", "SELECT scene, ts FROM scenes WHERE year(ts) BETWEEN 1996 AND 1997", "scenes")
def filter_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.scenes(spark, sf_dir).filter(temporal.calendar_years(F.col("ts"), 1996, 1997)).select("scene", "ts")


@query("filter_scenes", "SELECT scene, CAST(cloudy_pct AS BIGINT) AS cloudy_pct FROM scenes WHERE ts >= TIMESTAMP '1996-01-01' AND ts < TIMESTAMP '1998-12-31' AND cloudy_pct <= 70", "scenes")
def filter_scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenes_of_year(views.scenes(spark, sf_dir), 1996, 1998, CompositeConfig()).select("scene", "cloudy_pct")


@query("filter_list_contains", "SELECT l_orderkey, CAST(len(list_distinct(list(l_returnflag))) AS INTEGER) AS n_flags FROM lineitem GROUP BY l_orderkey HAVING list_contains(list(l_returnflag), 'A') AND list_contains(list(l_returnflag), 'R') AND min(l_linestatus) = 'F'")
def filter_list_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = views.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("flags"), F.min("l_linestatus").alias("mode"))
    df = df.filter(F.array_contains("flags", "A") & F.array_contains("flags", "R") & (F.col("mode") == "F"))
    return df.select("l_orderkey", F.size("flags").alias("n_flags"))


@query("date_advance", "SELECT scene, ts + INTERVAL 14 DAY AS later, CAST(round((epoch_us(ts) / 1000000.0) / 86400.0 / 365.25, 8) AS DOUBLE) AS t FROM scenes WHERE ts >= TIMESTAMP '1997-01-11' AND ts < TIMESTAMP '1997-01-11' + INTERVAL 14 DAY", "scenes")
def date_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = temporal.advance(temporal.from_ymd(1997, 1, 4), 1)
    df = views.scenes(spark, sf_dir).filter((F.col("ts") >= start) & (F.col("ts") < temporal.advance(start, 2)))
    return df.select("scene", temporal.advance(F.col("ts"), 2).alias("later"), F.round(temporal.fractional_years(F.col("ts")), 8).alias("t"))


# Masks.


@query("mask_algebra", f"SELECT {S_KEYS}, {sr('CASE WHEN nir > 1000 THEN red END', 'updated')}, {sr('nullif(green, 0)', 'self_masked')}, CAST(CASE WHEN nullif(green, 0) IS NULL THEN 0 ELSE 1 END AS INTEGER) AS valid, {sr('coalesce(nullif(blue, 0), 0)', 'unmasked')} FROM obs", "obs")
def mask_algebra(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = views.obs(spark, sf_dir).withColumns({"updated": masks.update_mask(F.col("red"), F.col("nir") > 1000), "self_masked": masks.self_mask(F.col("green")), "unmasked": masks.self_mask(F.col("blue"))})
    df = masks.unmask(df.withColumn("valid", masks.valid(F.col("self_masked"))), ["unmasked"])
    return rounded(df, ["updated", "self_masked", "unmasked"]).select(*KEYS, "updated", "self_masked", "valid", "unmasked")


@query("drop_masked", f"SELECT {S_KEYS}, {sr('nullif(green, 0)', 'green')} FROM obs WHERE green <> 0 AND blue <> 0", "obs")
def drop_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = views.obs(spark, sf_dir).withColumns({"green": masks.self_mask(F.col("green")), "blue": masks.self_mask(F.col("blue"))})
    return rounded(masks.drop_masked(df, ["green", "blue"]), ["green"]).select(*KEYS, "green")


# Joins.


@query("join_save_first", "SELECT s.scene, c.cloud_id, c.probability FROM scenes s JOIN (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY probability, cloud_id) AS k FROM clouds) c ON c.scene = s.scene AND c.k = 1 WHERE s.cloudy_pct <= 70", "scenes", "clouds")
def join_save_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    primary = views.scenes(spark, sf_dir).filter(F.col("cloudy_pct") <= 70)
    return joins.save_first(primary, views.clouds(spark, sf_dir), "scene", ["probability", "cloud_id"]).select("scene", "cloud_id", "probability")


@query("static_join_unmask", f", s AS (SELECT px, {sr('avg(nir)', 'nir')} FROM obs GROUP BY px) SELECT s.px, s.nir, coalesce(round(g.elevation, 6), 0.0) AS elevation, coalesce(nullif(g.probability, 50.0), 0.0) AS occurrence FROM s LEFT JOIN grid g ON g.cell = s.px", "obs", "grid")
def static_join_unmask(spark: SparkSession, sf_dir: str) -> DataFrame:
    stack = rounded(temporal.mean_composite(views.obs(spark, sf_dir), ["px"], ["nir"]), ["nir"])
    layers = views.grid(spark, sf_dir).select(F.col("cell").alias("px"), F.round("elevation", 6).alias("elevation"), F.nullif(F.col("probability"), F.lit(50.0)).alias("occurrence"))
    return joins.static_layers(stack, layers, ["px"], ["elevation", "occurrence"])


@query("distance_pairs", "SELECT a.cell AS id, b.cell AS other, CAST(round(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), 6) AS DOUBLE) AS distance FROM grid a JOIN grid b ON a.cell <> b.cell AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 2.25", "grid")
def distance_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(joins.near_pairs(views.grid(spark, sf_dir), 1.5, "cell"), ["distance"])


# Composites and harmonics.

_S_OBS = f", i AS (SELECT *, {S_EVI} AS EVI, {S_SAVI} AS SAVI, {S_IBI} AS IBI FROM obs)"


def _s_percentiles(bands: list[str], at=(10, 25, 50, 75, 90)) -> str:
    return ", ".join(sr(f"quantile_cont({b}, {p / 100})", f"{b}_p{p}") for b in bands for p in at)


@query("composite_percentiles", _S_OBS + f" SELECT px, {_s_percentiles(['EVI', 'SAVI', 'IBI'])} FROM i GROUP BY px", "obs")
def composite_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["EVI", "SAVI", "IBI"]
    df = ix.add_indices(views.obs(spark, sf_dir), names)
    out = temporal.composite(df, ["px"], names, (10, 25, 50, 75, 90))
    return rounded(out, [c for c in out.columns if c != "px"])


def _s_terms(source: str, where: str, keys: str = "px") -> str:
    t = "(epoch_us(ts) / 1000000.0) / 86400.0 / 365.25"
    return f"SELECT {keys}, nir, swir1, {t} AS t, cos(2 * pi() * ({t})) AS c, sin(2 * pi() * ({t})) AS s FROM {source} WHERE {where}"


def _s_fit(band: str, source: str, keys: str = "px") -> str:
    cov = ", ".join(f"covar_pop({a}, {b}) AS {a}{b}" for a, b in (("t", "t"), ("t", "c"), ("t", "s"), ("c", "c"), ("c", "s"), ("s", "s")))
    y = ", ".join(f"covar_pop({a}, {band}) AS {a}y" for a in "tcs")
    det = lambda a, b, c, d, e, f, g, h, i: f"({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"
    whole = det("tt", "tc", "ts", "tc", "cc", "cs", "ts", "cs", "ss")
    bc = det("tt", "ty", "ts", "tc", "cy", "cs", "ts", "sy", "ss")
    bs = det("tt", "tc", "ty", "tc", "cc", "cy", "ts", "cs", "sy")
    good = f"(CASE WHEN n >= 4 AND abs({whole}) > 1e-12 THEN {whole} END)"
    return f"SELECT {keys}, {bc} / {good} AS bc, {bs} / {good} AS bs FROM (SELECT {keys}, count({band}) AS n, {cov}, {y} FROM {source} WHERE {band} IS NOT NULL GROUP BY {keys})"


_S_HARMONIC = f", tt AS ({_s_terms('obs', 'dayofyear(ts) >= 1 AND dayofyear(ts) < 365')}), fn AS ({_s_fit('nir', 'tt')}), fs AS ({_s_fit('swir1', 'tt')})"


@query("harmonic_phase_amp", _S_HARMONIC + f" SELECT fn.px, {sr('atan2(fn.bs, fn.bc)', 'nir_phase', 5)}, {sr('sqrt(fn.bc * fn.bc + fn.bs * fn.bs)', 'nir_amplitude', 5)}, {sr('atan2(fs.bs, fs.bc)', 'swir1_phase', 5)}, {sr('sqrt(fs.bc * fs.bc + fs.bs * fs.bs)', 'swir1_amplitude', 5)} FROM fn JOIN fs USING (px)", "obs")
def harmonic_phase_amp(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = temporal.composite(views.obs(spark, sf_dir), ["px"], [], (), {"nir": HarmonicRange(), "swir1": HarmonicRange()})
    return rounded(out, [c for c in out.columns if c != "px"], 5)


def _s_hsv(h: str, s: str) -> dict[str, str]:
    f = f"({h} * 6 - floor({h} * 6))"
    p, q, t = f"(1.0 - {s})", f"(1.0 - {f} * {s})", f"(1.0 - (1.0 - {f}) * {s})"
    pick = lambda *c: "CASE CAST(floor(" + h + " * 6) AS INTEGER) % 6 " + " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(c)) + " END"
    return {"r": pick("1.0", q, p, p, t, "1.0"), "g": pick(t, "1.0", "1.0", q, p, p), "b": pick(p, p, t, "1.0", "1.0", q)}


@query("harmonic_rgb", _S_HARMONIC + ", hs AS (SELECT px, (atan2(bs, bc) + pi()) / (2 * pi()) AS h, sqrt(bc * bc + bs * bs) / 10000 * 2.5 AS s FROM fn) SELECT px, " + ", ".join(sr(e, n, 5) for n, e in _s_hsv("h", "s").items()) + " FROM hs", "obs")
def harmonic_rgb(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = temporal.composite(views.obs(spark, sf_dir), ["px"], [], (), {"nir": HarmonicRange()})
    out = temporal.harmonic_rgb(out.withColumn("nir_amplitude", F.col("nir_amplitude") / 10000), "nir_phase", "nir_amplitude")
    return rounded(out.select("px", "r", "g", "b"), ["r", "g", "b"], 5)


# Terrain, stencils, clouds.

_S_SIDES = ", ter AS (SELECT g.x, g.y, g.elevation, (e.elevation - w.elevation) / 2 AS gx, (n.elevation - s.elevation) / 2 AS gy FROM grid g LEFT JOIN grid e ON e.x = g.x + 1 AND e.y = g.y LEFT JOIN grid w ON w.x = g.x - 1 AND w.y = g.y LEFT JOIN grid n ON n.x = g.x AND n.y = g.y + 1 LEFT JOIN grid s ON s.x = g.x AND s.y = g.y - 1), topo AS (SELECT x, y, elevation, degrees(atan(sqrt(gx * gx + gy * gy))) AS slope, CASE WHEN gx <> 0 OR gy <> 0 THEN (degrees(atan2(-gx, -gy)) + 360) % 360 END AS aspect FROM ter)"


@query("terrain_slope_aspect", _S_SIDES + f" SELECT x, y, {sr('elevation', 'elevation')}, {sr('slope', 'slope')}, {sr('aspect', 'aspect')}, {sr('sin(radians(aspect))', 'eastness')}, {sr('cos(radians(aspect))', 'northness')} FROM topo", "grid")
def terrain_slope_aspect(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stencil.topography(views.grid(spark, sf_dir))
    return rounded(out, ["elevation", "slope", "aspect", "eastness", "northness"])


_S_C2 = "(SELECT a.dx, b.dy FROM (SELECT unnest(range(-2, 3)) AS dx) a, (SELECT unnest(range(-2, 3)) AS dy) b WHERE a.dx * a.dx + b.dy * b.dy <= 4)"
_S_C10 = "(SELECT a.dx, b.dy FROM (SELECT unnest(range(-10, 11)) AS dx) a, (SELECT unnest(range(-10, 11)) AS dy) b WHERE a.dx * a.dx + b.dy * b.dy <= 100)"


@query("focal_min", f"SELECT g.x, g.y, min(h.probability) AS probability FROM grid g CROSS JOIN {_S_C2} o JOIN grid h ON h.x = g.x + o.dx AND h.y = g.y + o.dy GROUP BY 1, 2", "grid")
def focal_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stencil.focal_min(views.grid(spark, sf_dir), "probability", 2)


@query("focal_max", f"SELECT g.x, g.y, CAST(max(CASE WHEN h.probability > 96 THEN 1 ELSE 0 END) AS INTEGER) AS cloud FROM grid g CROSS JOIN {_S_C10} o JOIN grid h ON h.x = g.x + o.dx AND h.y = g.y + o.dy GROUP BY 1, 2", "grid")
def focal_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stencil.focal_max(views.grid(spark, sf_dir).withColumn("cloud", (F.col("probability") > 96).cast("int")), "cloud", 10)


@query("reproject_coarse", f"SELECT CAST(x // 5 AS BIGINT) AS x, CAST(y // 5 AS BIGINT) AS y, {sr('max(elevation)', 'elevation')}, max(probability) AS probability FROM grid GROUP BY 1, 2", "grid")
def reproject_coarse(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = views.grid(spark, sf_dir).select("x", "y", "elevation", "probability")
    return rounded(stencil.coarsen(df, 5, [F.max("elevation").alias("elevation"), F.max("probability").alias("probability")]), ["elevation"])


def _s_steps(v: str) -> str:
    return f"CAST(sign({v}) * floor(abs({v}) + 0.499999999) AS BIGINT)"


def _s_cast(name: str, grid: int, steps: int, clouds: str, keys: str = "", azimuth: str = "30") -> str:
    """Cells of a coarse grid that lie up to some steps from a cloud, away from the sun."""
    x, y = (f"{c} // {grid} + {_s_steps(f'k * {f}(radians({azimuth}))')} AS {c}" for c, f in (("x", "cos"), ("y", "sin")))
    return f"{name} AS (SELECT DISTINCT {keys}{x}, {y} FROM {clouds}, (SELECT unnest(range(1, {steps + 1})) AS k))"


def _s_disc(radius: int) -> str:
    return f"(SELECT a.dx, b.dy FROM (SELECT unnest(range(-{radius}, {radius + 1})) AS dx) a, (SELECT unnest(range(-{radius}, {radius + 1})) AS dy) b WHERE a.dx * a.dx + b.dy * b.dy <= {radius * radius})"


def _s_dilated(config: CompositeConfig, marked: str, keys: tuple[str, ...] = ()) -> str:
    """Erosion and dilation of marks ``m`` on the mask's grid: ``dil`` has its cells (u, v) that end up set."""
    k, on = "".join(f"{c}, " for c in keys), "".join(f"z.{c} = e.{c} AND " for c in keys)
    g = config.mask_grid
    return (
        f"mid AS (SELECT {k}x // {g} AS u, y // {g} AS v, bool_or(m) AS m FROM {marked} GROUP BY ALL), "
        f"bad AS (SELECT DISTINCT {''.join(f'z.{c}, ' for c in keys)}z.u + o.dx AS u, z.v + o.dy AS v FROM mid z, {_s_disc(config.erode)} o WHERE NOT z.m), "
        f"ero AS (SELECT e.* FROM mid e LEFT JOIN bad z ON {on}z.u = e.u AND z.v = e.v WHERE e.m AND z.u IS NULL), "
        f"dil AS (SELECT DISTINCT {''.join(f'e.{c}, ' for c in keys)}e.u + o.dx AS u, e.v + o.dy AS v FROM ero e, {_s_disc(config.dilate)} o)"
    )


@query("shadow_project", ", " + _s_cast("kast", 1, 20, "(SELECT * FROM grid WHERE probability > 90)") + " SELECT x, y FROM kast WHERE EXISTS (SELECT 1 FROM grid g WHERE g.x = kast.x AND g.y = kast.y)", "grid")
def shadow_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = views.grid(spark, sf_dir).withColumn("cloud", F.col("probability") > 90)
    return stencil.project(df, "cloud", stencil.shadow_azimuth(F.lit(60.0)), 20)


_MASK = CompositeConfig(cloud_probability=98, shadow_grid=4)


@query(
    "cloud_mask",
    ", "
    + _s_cast("kast", _MASK.shadow_grid, _MASK.shadow_steps, f"(SELECT * FROM grid WHERE probability > {_MASK.cloud_probability})")
    + f", m AS (SELECT g.x, g.y, CAST(g.probability > {_MASK.cloud_probability} AS INTEGER) AS clouds, CAST(k.x IS NOT NULL AND g.nir < 1500 AND g.scl <> 6 AS INTEGER) AS shadows, clouds + shadows > 0 AS m FROM grid g LEFT JOIN kast k ON k.x = g.x // {_MASK.shadow_grid} AND k.y = g.y // {_MASK.shadow_grid}), "
    + _s_dilated(_MASK, "m")
    + f" SELECT m.x, m.y, m.clouds, m.shadows, CAST(d.u IS NOT NULL AS INTEGER) AS cloudmask FROM m LEFT JOIN dil d ON d.u = m.x // {_MASK.mask_grid} AND d.v = m.y // {_MASK.mask_grid}",
    "grid",
)
def cloud_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clouds.cloud_shadow_mask(views.grid(spark, sf_dir), _MASK, stencil.shadow_azimuth(F.lit(60.0)))


_FULL = CompositeConfig()
_S_MASKED = (
    ", img AS (SELECT * FROM (SELECT *, min(cloud_id) OVER (PARTITION BY scene) AS f FROM cloudpix) WHERE cloud_id = f)"
    + f", sel AS (SELECT s.* FROM scenes s WHERE s.cloudy_pct <= {_FULL.cloudy_percentage} AND s.ts >= TIMESTAMP '1996-01-01' AND s.ts < TIMESTAMP '1999-12-31' AND s.scene IN (SELECT scene FROM img))"
    + ", pix AS (SELECT scene, x, y, max(probability) AS p FROM img GROUP BY ALL), ob AS (SELECT o.*, s.azimuth, pix.p FROM obs o JOIN sel s ON s.scene = o.scene LEFT JOIN pix ON pix.scene = o.scene AND pix.x = o.x AND pix.y = o.y), "
    + _s_cast("kast", _FULL.shadow_grid, _FULL.shadow_steps, f"(SELECT i.*, s.azimuth FROM img i JOIN sel s USING (scene) WHERE i.probability > {_FULL.cloud_probability})", "scene, ", "90 - azimuth")
    + f", mk AS (SELECT o.scene, o.x, o.y, o.p > {_FULL.cloud_probability} OR (o.nir < {_FULL.dark_nir} AND o.scl <> 6 AND k.x IS NOT NULL) AS m FROM ob o LEFT JOIN kast k ON k.scene = o.scene AND k.x = o.x // {_FULL.shadow_grid} AND k.y = o.y // {_FULL.shadow_grid} WHERE o.p IS NOT NULL), "
    + _s_dilated(_FULL, "mk", ("scene",))
    + f", clear AS (SELECT o.px, o.ts, {', '.join(f'CASE WHEN o.p IS NOT NULL AND d.u IS NULL THEN o.{b} END AS {b}' for b in BANDS)} FROM ob o LEFT JOIN dil d ON d.scene = o.scene AND d.u = o.x // {_FULL.mask_grid} AND d.v = o.y // {_FULL.mask_grid})"
)
_S_FULL = (
    _S_MASKED
    + f", i AS (SELECT *, {S_EVI} AS EVI, {S_SAVI} AS SAVI, {S_IBI} AS IBI FROM clear), p AS (SELECT px, {', '.join(f'quantile_cont({b}, {q / 100}) AS {b}_p{q}' for b in (*BANDS, 'EVI', 'SAVI', 'IBI') for q in (10, 25, 50, 75, 90))} FROM i GROUP BY px)"
    + f", tt AS ({_s_terms('clear', 'dayofyear(ts) >= 1 AND dayofyear(ts) < 365')}), fn AS ({_s_fit('nir', 'tt')}), fs AS ({_s_fit('swir1', 'tt')})"
    + _S_SIDES.replace(", ter AS", ", ter AS", 1)
)
_FULL_NAMES = _FULL.feature_names()


def _digits(name: str) -> int:
    return 4 if name.endswith(("_phase", "_amplitude")) else 7


def _s_full_select() -> str:
    out = ["p.px"]
    for n in _FULL_NAMES:
        if n in ("elevation", "slope", "aspect"):
            e = f"t.{n}"
        elif n in ("eastness", "northness"):
            e = f"{'sin' if n == 'eastness' else 'cos'}(radians(t.aspect))"
        elif n.endswith("_phase"):
            e = f"atan2(f{n[0]}.bs, f{n[0]}.bc)"
        elif n.endswith("_amplitude"):
            e = f"sqrt(f{n[0]}.bc * f{n[0]}.bc + f{n[0]}.bs * f{n[0]}.bs)"
        else:
            e = f"p.{n}"
        out.append(sr(f"coalesce({e}, 0)", n, _digits(n)))
    return ", ".join(out)


@query("composite_full", _S_FULL + f" SELECT {_s_full_select()} FROM p LEFT JOIN fn ON fn.px = p.px LEFT JOIN fs ON fs.px = p.px LEFT JOIN topo t ON t.x + 50 * t.y = p.px", "obs", "scenes", "cloudpix", "grid")
def composite_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = scenes_of_year(views.scenes(spark, sf_dir), 1996, 1999, _FULL)
    obs = masked_observations(views.obs(spark, sf_dir), chosen, views.cloud_pixels(spark, sf_dir), _FULL)
    stack = feature_stack(obs, ["x", "y"], _FULL, stencil.topography(views.grid(spark, sf_dir)))
    return stack.select((F.col("x") + 50 * F.col("y")).alias("px"), *[r(n, _digits(n)).alias(n) for n in _FULL.feature_names()])


# Radar.


@query("s1_db_natural_ratio", f"SELECT x, y, {sr('pow(10.0, VV / 10.0)', 'VV')}, {sr('pow(10.0, VH / 10.0)', 'VH')}, {sr('pow(10.0, VH / 10.0) / pow(10.0, VV / 10.0)', 'ratio')}, {sr('10 * log10(pow(10.0, VV / 10.0))', 'back')} FROM grid", "grid")
def s1_db_natural_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = radar.polarisation_ratio(views.grid(spark, sf_dir)).withColumn("back", ix.to_db(F.col("VV")))
    return rounded(df.select("x", "y", "VV", "VH", "ratio", "back"), ["VV", "VH", "ratio", "back"])


_CU = 1 / math.sqrt(7)
_S_C3 = "(SELECT a.dx, b.dy FROM (SELECT unnest(range(-1, 2)) AS dx) a, (SELECT unnest(range(-1, 2)) AS dy) b)"


@query(
    "s1_speckle",
    f", n AS (SELECT x, y, VV, pow(10.0, VV / 10.0) AS v FROM grid), st AS (SELECT n.x, n.y, any_value(n.VV) AS VV, any_value(n.v) AS v, avg(h.v) AS m, var_pop(h.v) AS q FROM n CROSS JOIN {_S_C3} o JOIN n h ON h.x = n.x + o.dx AND h.y = n.y + o.dy GROUP BY 1, 2), c AS (SELECT *, sqrt(q) / nullif(m, 0) AS ci FROM st), a AS (SELECT *, {1.0 + _CU * _CU} / nullif(ci * ci - {_CU * _CU}, 0) AS alpha FROM c), b AS (SELECT *, alpha - 8.0 AS b FROM a), f AS (SELECT *, (b * m + sqrt(CASE WHEN ci > {_CU} AND ci < {math.sqrt(2.0) * _CU} THEN m * m * b * b + alpha * m * v * 28.0 END)) / nullif(alpha * 2.0, 0) AS f FROM b) SELECT x, y, {sr(f'CASE WHEN ci <= {_CU} THEN 10 * log10(m) WHEN ci < {math.sqrt(2.0) * _CU} THEN 10 * log10(f) ELSE VV END', 'VV')}, CASE WHEN ci <= {_CU} THEN 'mean' WHEN ci < {math.sqrt(2.0) * _CU} THEN 'textured' ELSE 'raw' END AS branch FROM f",
    "grid",
)
def s1_speckle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(radar.speckle_filter(views.grid(spark, sf_dir), "VV"), ["VV"])


@query(
    "s1_terrain",
    _S_SIDES
    + ", la AS (SELECT g.x, g.y, (e.angle - w.angle) / 2 AS gx, (n.angle - s.angle) / 2 AS gy FROM grid g JOIN grid e ON e.x = g.x + 1 AND e.y = g.y JOIN grid w ON w.x = g.x - 1 AND w.y = g.y JOIN grid n ON n.x = g.x AND n.y = g.y + 1 JOIN grid s ON s.x = g.x AND s.y = g.y - 1), ph AS (SELECT avg(CASE WHEN gx <> 0 OR gy <> 0 THEN (degrees(atan2(-gx, -gy)) + 360) % 360 END) AS phi_i FROM la), j AS (SELECT g.x, g.y, g.VV, g.VH, g.angle, radians(g.angle) AS th, radians(t.slope) AS al, radians(ph.phi_i - t.aspect) AS pr FROM grid g JOIN topo t ON t.x = g.x AND t.y = g.y CROSS JOIN ph), k AS (SELECT *, atan(tan(al) * cos(pr)) AS ar, atan(tan(al) * sin(pr)) AS az FROM j), v AS (SELECT *, abs(tan(pi() / 2 - th + ar) / nullif(tan(pi() / 2 - th), 0)) AS vm, acos(cos(az) * cos(th - ar)) AS lia FROM k) SELECT x, y, "
    + ", ".join(sr(f"CASE WHEN vm > 0 THEN 10 * log10(pow(10.0, {p} / 10.0) / cos(th) / vm) END", p, 5) for p in ("VV", "VH"))
    + ", CAST(degrees(ar) < angle AS INTEGER) AS layover, CAST(degrees(lia) < 85 AS INTEGER) AS shadow FROM v WHERE vm > 0",
    "grid",
)
def s1_terrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(radar.terrain_correction(views.grid(spark, sf_dir)).filter("VV is not null"), ["VV", "VH"], 5)


@query("s1_two_week_mean", "SELECT px, CAST(trunc(round(avg(nir) * 10000, 3)) AS BIGINT) AS nir FROM obs WHERE ts >= TIMESTAMP '1997-01-11' AND ts < TIMESTAMP '1997-01-25' GROUP BY px", "obs")
def s1_two_week_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = temporal.advance(temporal.from_ymd(1997, 1, 4), 1)
    df = views.obs(spark, sf_dir).filter((F.col("ts") >= start) & (F.col("ts") < temporal.advance(start, 2)))
    return radar.two_week_mean(df, ["px"], ["nir"])
