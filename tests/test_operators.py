import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.config import CompositeConfig, HarmonicRange
from tessera.functions import geometry, hashing, indices, masks
from tessera.operators import accuracy, classify, joins, radar, sampling, stencil, temporal
from tessera.plans.composite import feature_stack


def one(df):
    return df.first().asDict()


def test_feature_names():
    names = CompositeConfig().feature_names()
    assert len(names) == 54 and len(set(names)) == 54
    with pytest.raises(ValueError):
        CompositeConfig(harmonics={"nope": HarmonicRange()}).feature_names()


def test_indices_edges(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 0.0, 0.0, 0.0), (1.0, -2.0, 3.0, 4.0, 5.0, 6.0), (None, 1.0, 1.0, 1.0, 1.0, 1.0)], "blue double, green double, red double, nir double, swir1 double, swir2 double")
    rows = indices.add_indices(df, list(indices.INDICES)).collect()
    assert rows[0]["ND_blue_green"] is None and rows[0]["R_swir1_nir"] is None and rows[0]["IBI"] is None
    assert rows[1]["ND_blue_green"] is None and rows[1]["ND_nir_red"] == pytest.approx(1 / 7)
    assert rows[2]["EVI"] is None and rows[2]["ND_swir1_swir2"] == 0
    with pytest.raises(ValueError):
        indices.add_indices(df, ["NDXX"])
    with pytest.raises(ValueError):
        indices.add_bands(df, {"red": F.lit(1)})
    tc = one(indices.add_tasselled_cap(df.filter("green = -2")))
    x = np.array([1.0, -2, 3, 4, 5, 6])
    assert tc["wetness"] == pytest.approx(np.array(indices.TASSELLED_CAP[2]) @ x)
    assert tc["tcAngleBG"] == pytest.approx(math.atan2(tc["greenness"], tc["brightness"]) / math.pi)
    assert indices.new_names(["a", "b"], ["b"]) == ["a"]


def test_masks(spark):
    df = spark.createDataFrame([(0.0, True), (2.0, False), (3.0, None)], "v double, m boolean")
    out = [tuple(r) for r in df.select(masks.update_mask(F.col("v"), F.col("m")), masks.self_mask(F.col("v")), masks.valid(masks.self_mask(F.col("v")))).collect()]
    assert out == [(0.0, None, 0), (None, 2.0, 1), (None, 3.0, 1)]


def test_planted_harmonic(spark):
    rng, rows = np.random.default_rng(0), []
    for px, (c, s) in enumerate([(3.0, 4.0), (-1.0, 0.5)]):
        for d in rng.choice(2000, 60, replace=False):
            t = d / 365.25 + 25
            rows.append((px, int(d), float(7 + 0.3 * t + c * math.cos(2 * math.pi * t) + s * math.sin(2 * math.pi * t))))
    rows += [(9, 10, 1.0), (9, 20, 2.0), (9, 30, 4.0)]
    df = spark.createDataFrame(rows, "px int, d int, nir double").withColumn("ts", F.expr("cast(timestamp_seconds((d / 365.25 + 25) * 365.25 * 86400) AS timestamp_ntz)"))
    out = {r["px"]: r for r in temporal.composite(df, ["px"], [], (), {"nir": HarmonicRange(1, 367)}).collect()}
    assert out[0]["nir_phase"] == pytest.approx(math.atan2(4, 3), abs=1e-4) and out[0]["nir_amplitude"] == pytest.approx(5, abs=1e-3)
    assert out[1]["nir_amplitude"] == pytest.approx(math.hypot(1, 0.5), abs=1e-3)
    assert out[9]["nir_phase"] is None


def test_half_open_dates(spark):
    df = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ '2020-12-30'), (TIMESTAMP_NTZ '2020-12-31'), (TIMESTAMP_NTZ '2020-02-29') t(ts)")
    assert df.filter(temporal.between_dates(F.col("ts"), "2020-01-01", "2020-12-31")).count() == 2
    assert df.filter(temporal.day_of_year(F.col("ts"), 1, 366)).count() == 2
    assert df.filter(temporal.day_of_year(F.col("ts"), 1, 366, True)).count() == 3
    assert df.filter(temporal.calendar_years(F.col("ts"), 2020, 2020)).count() == 3


def grid(spark, n, f, schema="v double"):
    return spark.createDataFrame([(x, y, f(x, y)) for x in range(n) for y in range(n)], f"x long, y long, {schema}")


def test_impulse(spark):
    cells = grid(spark, 21, lambda x, y: int((x, y) == (10, 10)), "v int")
    big = stencil.focal_max(cells, "v", 3).filter("v = 1")
    assert {(r.x - 10, r.y - 10) for r in big.collect()} == set(stencil.circle(3))
    assert stencil.focal_min(cells, "v", 2).filter("v = 1").count() == 0
    cast = stencil.project(cells.withColumn("c", F.col("v") == 1), "c", 0.0, 20)
    assert {(r.x, r.y) for r in cast.collect()} == {(x, 10) for x in range(11, 21)}
    assert len(stencil.circle(10)) == 317


def test_plane(spark):
    out = stencil.topography(grid(spark, 5, lambda x, y: float(2 * x), "elevation double"))
    inner = out.filter("x = 2 and y = 2").first()
    assert inner["slope"] == pytest.approx(math.degrees(math.atan(2))) and inner["aspect"] == pytest.approx(270)
    assert out.filter("x = 0 and y = 2").first()["slope"] is None


def test_speckle_branches(spark):
    rng = random.Random(3)
    flat = radar.speckle_filter(grid(spark, 5, lambda x, y: -5.0, "VV double"), "VV")
    assert {r["branch"] for r in flat.collect()} == {"mean"} and flat.filter("abs(VV + 5) > 1e-9").count() == 0
    noisy = radar.speckle_filter(grid(spark, 9, lambda x, y: rng.choice([-20.0, -6.0, 0.0, 9.0]), "VV double"), "VV")
    kinds = {r["branch"] for r in noisy.collect()}
    assert "raw" in kinds and noisy.filter("VV is null").count() == 0


def test_thinning_equals_scan(spark):
    rng = random.Random(5)
    pts = [(i, rng.uniform(0, 60), rng.uniform(0, 60)) for i in range(150)]
    kept = []
    for i, x, y in pts:
        if all(math.hypot(x - a, y - b) > 6 for _, a, b in kept):
            kept.append((i, x, y))
    df = spark.createDataFrame(pts, "id long, x double, y double")
    assert sorted(r.id for r in sampling.distance_filter(df, 6.0).collect()) == [k[0] for k in kept]
    pairs = {(r.id, r.other) for r in joins.near_pairs(df, 6.0).collect()}
    assert pairs == {(a[0], b[0]) for a in pts for b in pts if a[0] != b[0] and math.hypot(a[1] - b[1], a[2] - b[2]) <= 6}


def test_thinning_within_classes(spark):
    """Classes over the same square don't thin each other."""
    square = geometry.ring([(0, 0), (10, 0), (10, 10), (0, 10)])
    polys = spark.range(2).select(F.col("id").alias("fid"), (F.col("id") + 1).cast("int").alias("class"), square.alias("geom"))
    got = sampling.sample_points(polys, "class", {1: 30, 2: 30}, distance=3.0).collect()
    for c in (1, 2):
        mine = [(r.px, r.py) for r in got if r["class"] == c]
        assert len(mine) >= 5 and all(math.hypot(a - x, b - y) > 3 for k, (a, b) in enumerate(mine) for x, y in mine[:k])


def test_points_are_uniform(spark):
    """Over polygons of very unequal size and shape, every part of the area gets its share (chi-square)."""
    shapes = [[(0, 0), (30, 0), (30, 30), (0, 30)], [(100, 0), (101, 0), (101, 1), (100, 1)], [(200, 0), (240, 0), (200, 40)], [(300, 0), (306, 0), (306, 2), (302, 2), (302, 6), (300, 6)]]
    polys = None
    for k, s in enumerate(shapes):
        one = spark.range(1).select(F.lit(k).alias("fid"), F.lit(5).alias("class"), geometry.ring(s).alias("geom"))
        polys = one if polys is None else polys.union(one)
    n = 4000
    got = sampling.random_points(polys, {5: n}, class_col="class")
    assert got.count() == n
    areas = np.array([900, 1, 800, 20.0])
    hits = np.zeros(4)
    for r in got.groupBy("fid").count().collect():
        hits[r.fid] = r["count"]
    want = areas / areas.sum() * n
    assert ((hits - want) ** 2 / want).sum() < 16.3  # three degrees of freedom, one in a thousand
    quarters = got.filter("fid = 0").groupBy((F.col("px") > 15).alias("a"), (F.col("py") > 15).alias("b")).count().collect()
    mean = hits[0] / 4
    assert sum((q["count"] - mean) ** 2 / mean for q in quarters) < 16.3
    assert sampling.random_points(polys, 50).count() == 50 and sampling.random_points(polys.limit(0), 50).count() == 0


def brute_mask(cells, config, azimuth):
    """cells: (x, y) -> (cloud, dark); the mask by its definition."""
    step = lambda v: int(math.copysign(math.floor(abs(v) + 0.5 - stencil.EDGE), v))
    s, m = config.shadow_grid, config.mask_grid
    cast = {(x // s + step(k * math.cos(math.radians(azimuth))), y // s + step(k * math.sin(math.radians(azimuth)))) for (x, y), c in cells.items() if c[0] for k in range(1, config.shadow_steps + 1)}
    hit = {p: c[0] or (c[1] and (p[0] // s, p[1] // s) in cast) for p, c in cells.items()}
    mid = {}
    for (x, y), h in hit.items():
        mid[x // m, y // m] = mid.get((x // m, y // m), False) or h
    eroded = {p for p in mid if all(mid.get((p[0] + a, p[1] + b), True) for a, b in stencil.circle(config.erode))}
    grown = {(x + a, y + b) for x, y in eroded for a, b in stencil.circle(config.dilate)}
    return {p: (p[0] // m, p[1] // m) in grown for p in cells}


def test_cloud_masks_by_definition(spark, monkeypatch):
    """Sparse cells, several scenes, small tiles: masks go over tile borders."""
    from tessera.config import BANDS
    from tessera.operators import clouds, tiles

    monkeypatch.setattr(tiles, "TILE", 40)
    monkeypatch.setattr(clouds, "TILE", 40)
    monkeypatch.setattr(tiles, "ROWS", 500)
    config = CompositeConfig(shadow_grid=4, shadow_steps=6, dilate=4, erode=1)
    rng = random.Random(4)
    scenes, rows = {}, []
    for scene, azimuth in ((1, 0.0), (2, 30.0), (3, 200.0)):
        cells = {}
        for _ in range(3):
            cx, cy = rng.randrange(110), rng.randrange(90)
            cells |= {(x, y): (True, False) for x in range(cx, cx + 9) for y in range(cy, cy + 9)}
        for x in range(0, 120):
            for y in range(-20, 100):
                if rng.random() < 0.7:
                    cells[x, y] = (cells.get((x, y), (False, False))[0], rng.random() < 0.4)
        scenes[scene] = azimuth, cells
        rows += [(scene, x, y, 99.0 if c else 3.0, 1000.0 if d else 3000.0, 4, 90.0 - azimuth) for (x, y), (c, d) in cells.items()]
    df = spark.createDataFrame(rows, "scene long, x long, y long, probability double, nir double, scl int, azimuth double").repartition(5)
    got = {(r.scene, r.x, r.y): r for r in clouds.cloud_shadow_mask(df, config, F.lit(90.0) - F.col("azimuth"), ("scene",)).collect()}
    want = {(s, *p): v for s, (azimuth, cells) in scenes.items() for p, v in brute_mask(cells, config, azimuth).items()}
    assert {k: r.cloudmask == 1 for k, r in got.items()} == want and 0.05 < np.mean(list(want.values())) < 0.95
    obs = df.withColumns({b: F.lit(1.0) for b in BANDS if b != "nir"}).drop("probability")
    masked = clouds.mask_scenes(obs, df.select("scene", "x", "y", "probability"), config)
    assert {(r.scene, r.x, r.y): r.blue is None for r in masked.collect()} == want
    # Without a probability a cell is masked, and repeated observations share a cell's mask.
    twice = clouds.mask_scenes(obs.union(obs), df.filter("x < 60").select("scene", "x", "y", "probability"), config)
    assert twice.count() == 2 * len(want) and twice.filter("x >= 60 and blue is not null").count() == 0


def test_wide_stencils_cross_tiles(spark, monkeypatch):
    from tessera.operators import tiles

    monkeypatch.setattr(tiles, "TILE", 10)
    rng = random.Random(6)
    values = {(x, y): rng.randrange(50) for x in range(-12, 25) for y in range(30) if rng.random() < 0.8}
    df = spark.createDataFrame([(x, y, v, int(v > 46)) for (x, y), v in values.items()], "x long, y long, v int, one int")
    low = {(r.x, r.y): r.v for r in stencil.focal_min(df, "v", 3).collect()}
    assert low == {(x, y): min(values[x + a, y + b] for a, b in stencil.circle(3) if (x + a, y + b) in values) for x, y in values}
    big = {(r.x, r.y): r.one for r in stencil.focal_max(df, "one", 5).collect()}
    assert big == {(x, y): int(any(values.get((x + a, y + b), 0) > 46 for a, b in stencil.circle(5))) for x, y in values}
    plan = stencil.focal_max(df, "one", 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_polygons(spark):
    ell = [(0, 0), (6, 0), (6, 2), (2, 2), (2, 6), (0, 6)]
    polys = spark.range(1).select(F.lit(1).alias("fid"), F.lit(3).alias("class"), geometry.ring(ell).alias("geom"))
    cells = grid(spark, 9, lambda x, y: 0.0)
    inside = geometry.points_in_rings(cells, polys, 4)
    assert inside.count() == 6 * 2 + 2 * 4
    assert polys.select(geometry.area(F.col("geom"))).first()[0] == 20
    painted = sampling.paint(cells, polys.withColumn("class", F.lit(0)), "class")
    assert painted.filter("class is not null").count() == 0


def test_sampling_rules(spark):
    with pytest.raises(ValueError):
        sampling.resolve_points([1], None)
    with pytest.raises(ValueError):
        sampling.allocation(spark, [1, 2], [1])
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("class"))
    a = sampling.stratified_sample(df.repartition(7), "class", ["id"], 20)
    b = sampling.stratified_sample(df.coalesce(1), "class", ["id"], 20)
    assert sorted(r.id for r in a.collect()) == sorted(r.id for r in b.collect()) and a.count() == 60
    train, test = sampling.split_train_test(df, ["id"])
    assert train.count() + test.count() == 1000 and 740 < train.count() < 860
    assert 1 <= hashing.reshuffled_seed() < 1_000_000


def test_argmax_and_top(spark):
    df = spark.createDataFrame([(1, 0.5, 0.5, 0.1), (2, 0.1, None, 0.2)], "id int, a double, b double, c double")
    got = [r.LANDCOVER for r in classify.most_probable(df, {4: "a", 7: "b", 12: "c"}).orderBy("id").collect()]
    assert got == [4, None]
    values = {f"f{i}": float(i // 2) for i in range(50)}
    table = spark.createDataFrame(list(values.items()), "feature string, importance double")
    assert sorted(r.feature for r in classify.top_features(table, "feature", "importance", 19).collect()) == sorted(classify.top_names(values, 19))
    assert len(classify.top_names(values, 19)) == 20 and len(classify.top_names({"a": 1.0}, 20)) == 1


def test_accuracy_by_hand(spark):
    rows = [(1, 1)] * 6 + [(1, 2)] * 2 + [(2, 2)] * 3 + [(2, 3)] + [(3, 3)] * 4 + [(3, 1)] * 4
    df = spark.createDataFrame(rows, "t int, p int")
    got = {r["class"]: r for r in accuracy.by_class(df, "t", "p").collect()}
    assert (got[1]["tp"], got[1]["fn"], got[1]["fp"], got[1]["tn"]) == (6, 2, 4, 8)
    assert got[1]["omission"] == pytest.approx(0.25) and got[1]["commission"] == pytest.approx(0.4) and got[1]["user_acc"] == 60
    old = {r["class"]: r for r in accuracy.by_class(df, "t", "p", legacy=True).collect()}
    assert old[1]["commission"] == pytest.approx(0.5)
    assert one(accuracy.overall(df, "t", "p"))["accuracy"] == pytest.approx(0.65)
    m = {r.true: tuple(r)[1:] for r in accuracy.confusion_matrix(df, "t", "p", [1, 2, 3, 4]).collect()}
    assert m == {1: (6, 2, 0, 0), 2: (0, 3, 1, 0), 3: (4, 0, 4, 0), 4: (0, 0, 0, 0)}


def test_fits_have_few_partitions(spark, monkeypatch):
    """Each partition makes sums for every open node of all trees, so a fit of few rows gets one; rows keep their nodes."""
    rows = spark.range(1000).selectExpr("id", "id % 3 as LANDCOVER", "double(id % 7) as a").repartition(8).persist()
    assert classify.together(rows).rdd.getNumPartitions() == 1
    monkeypatch.setattr(classify, "ROWS", 400)
    assert classify.together(rows).rdd.getNumPartitions() == 3
    assert classify.together(rows.limit(0)).count() == 0
    rows.unpersist()
    assert classify.forest().getCacheNodeIds()
    seen, fit = [], classify.RandomForestClassifier.fit
    monkeypatch.setattr(classify, "ROWS", 5000)
    monkeypatch.setattr(classify.RandomForestClassifier, "fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or fit(self, df))
    classify.train_primitives(rows, "LANDCOVER", ["a"], [1], trees=2, depth=2)
    assert seen == [1, 1]
    classify.out_of_bag(rows, "LANDCOVER", 1, ["a"], ["id"], trees=10, depth=2)
    assert seen == [1] * 12


def test_forest(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(120, 4))
    rows = [(i, 1 + int(v[0] > 0) + int(v[1] > 1), *map(float, v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, LANDCOVER int, a double, b double, c double, d double")
    fits = classify.train_primitives(df, "LANDCOVER", ["a", "b", "c", "d"], trees=4, depth=5)
    assert [f.value for f in fits] == [1, 2, 3] and sum(fits[0].importance_all.values()) == pytest.approx(1)
    p = classify.probabilities(df, fits)
    assert p.filter("Class1 < 0 or Class1 > 1").count() == 0
    best = classify.most_probable(p, {f.value: f"Class{f.value}" for f in fits}, "guess")
    assert best.filter("guess = LANDCOVER").count() > 100
    assert 0 <= classify.out_of_bag(df, "LANDCOVER", 1, ["a", "b"], ["id"], trees=10, depth=4) <= 0.2


def test_footprint_stack(spark):
    rng = random.Random(2)
    rows = [(x, 0, f"2020-{1 + k % 12:02d}-{1 + k % 28:02d}", *[rng.uniform(1, 4000) for _ in range(6)]) for x in range(4) for k in range(30)]
    obs = spark.createDataFrame(rows, "x long, y long, d string, blue double, green double, red double, nir double, swir1 double, swir2 double").withColumn("ts", F.col("d").cast("timestamp_ntz"))
    topo = stencil.topography(grid(spark, 4, lambda x, y: float(x + y), "elevation double"))
    stack = feature_stack(obs, ["x", "y"], None, topo, footprint=spark.createDataFrame([(1, 0), (2, 0)], "x long, y long"))
    assert stack.count() == 2 and stack.columns[2:] == CompositeConfig().feature_names()
    assert stack.filter("blue_p10 > blue_p50 or blue_p50 > blue_p90").count() == 0
    plain = feature_stack(obs, ["x", "y"], CompositeConfig(add_harmonics=False, add_topography=False, add_tasselled_cap=True))
    assert plain.count() == 4 and "tcDistBG_p90" in plain.columns
