import random

import pytest
from pyspark.sql import functions as F

from tessera import cli
from tessera.config import LEGEND
from tessera.functions.geometry import rectangle
from tessera.operators import accuracy, stencil
from tessera.plans.composite import landsat_covariates
from tessera.sources import io


def test_all_stages(spark, tmp_path):
    rng = random.Random(1)
    p = lambda n: str(tmp_path / n)
    obs = [(s, f"2020-{1 + s:02d}-05", x, y, *[(500 + 300 * (x // 4) + rng.uniform(0, 60)) * k for k in (1, 1.2, 1.5, 3, 2, 1.8)]) for s in range(8) for x in range(12) for y in range(6)]
    names = "blue double, green double, red double, nir double, swir1 double, swir2 double"
    df = spark.createDataFrame(obs, f"scene int, d string, x long, y long, {names}").withColumn("ts", F.col("d").cast("timestamp_ntz")).drop("d")
    df = df.withColumn("scl", F.lit(4))
    io.write_collection(df.withColumns({"year": F.year("ts"), "tile": F.lit("a")}), p("obs"))
    df.select("scene", "ts").distinct().withColumns({"cloudy_pct": F.col("scene") * 5, "azimuth": F.lit(30.0)}).write.parquet(p("scenes"))
    # Scene 3 lies under a cloud; scene 7 has no cloud image.
    df.filter("scene <> 7").select("scene", F.col("scene").alias("cloud_id"), "x", "y", F.when(F.col("scene") == 3, 90.0).otherwise(10.0).alias("probability")).write.parquet(p("clouds"))
    stencil.topography(spark.createDataFrame([(x, y, float(x * y)) for x in range(12) for y in range(6)], "x long, y long, elevation double")).write.parquet(p("topo"))
    polys = spark.createDataFrame([(k, k + 1, 4.0 * k, 0.0, 4.0 * k + 4, 6.0) for k in range(3)], "fid long, LANDCOVER int, x0 double, y0 double, x1 double, y1 double")
    polys.withColumn("geom", rectangle(*[F.col(c) for c in ("x0", "y0", "x1", "y1")])).select("fid", "LANDCOVER", "geom").write.parquet(p("polys"))

    base = ["composite", "--observations", p("obs"), "--scenes", p("scenes"), "--clouds", p("clouds"), "--topography", p("topo"), "--year", "2020"]
    assert cli.main([*base, "--output", p("dry"), "--dry-run"], spark) == 0 and not io.exists(spark, p("dry"))
    cli.main([*base, "--output", p("stack")], spark)
    cli.main([*base, "--output", p("inside"), "--polygons", p("polys")], spark)
    assert spark.read.parquet(p("stack")).count() == 72 == spark.read.parquet(p("inside")).count()
    with pytest.raises(FileExistsError):
        cli.main([*base, "--output", p("stack")], spark)
    with pytest.raises(FileNotFoundError):
        cli.main(["assemble", "--primitives", p("nowhere"), "--output", p("x")], spark)

    cli.main(["train-test", "--polygons", p("polys"), "--stack", p("stack"), "--output", p("pts"), "--scale", "1", "--class-values", "1 2 3", "--class-points", "20,20,20"], spark)
    train, test = spark.read.parquet(p("pts_train")), spark.read.parquet(p("pts_test"))
    assert train.count() + test.count() == 60 and train.join(test, "id").count() == 0
    with pytest.raises(ValueError):
        cli.main(["train-test", "--polygons", p("polys"), "--stack", p("stack"), "--output", p("q"), "--class-values", "1 2", "--class-points", "5"], spark)

    # A small stack keeps the forests quick.
    spark.read.parquet(p("stack")).select("x", "y", "nir_p50", "red_p50").write.parquet(p("small"))
    cli.main(["primitives", "--stack", p("small"), "--training", p("pts_train"), "--metrics", p("metrics"), "--output", p("prims"), "--trees", "10", "--depth", "4"], spark)
    cli.main(["assemble", "--primitives", p("prims"), "--output", p("map")], spark)
    image = spark.read.parquet(p("map"))
    assert image.filter(F.col("LANDCOVER") == F.floor(F.col("x") / 4) + 1).count() >= 68
    assert (tmp_path / "metrics" / "varImportanceClass1.csv").exists() and (tmp_path / "metrics" / "oobErrorClass2.txt").exists() and (tmp_path / "metrics" / "oobErrorAllClass2.txt").exists()

    cli.main(["sample", "--input", p("map"), "--n-points", "5", "--output", p("ceo")], spark)
    assert spark.read.parquet(p("ceo")).count() == 15
    assert spark.read.option("header", True).csv(p("ceo_csv")).columns == ["LON", "LAT", "PLOTID", "SAMPLEID", "LANDCOVER"]
    assert io.write_table(image, p("ceo")) is False

    rows = image.withColumn("label", (F.floor(F.col("x") / 4) + 1).cast("int"))
    io.write_report(p("report"), accuracy.by_class(rows, "label", "LANDCOVER"), accuracy.confusion_matrix(rows, "label", "LANDCOVER", list(LEGEND)), accuracy.overall(rows, "label", "LANDCOVER"))
    assert "Accuracy:" in (tmp_path / "report" / "overallAccuracy.txt").read_text()


def test_collections(spark, tmp_path):
    df = spark.createDataFrame([(2019, "a", 1.0), (2020, "a", 2.0), (2020, "b", 3.0)], "year int, tile string, v double")
    io.write_collection(df, str(tmp_path / "c"))
    got = io.read_collection(spark, str(tmp_path / "c"), (2020, 2020), ["a"])
    assert [r.v for r in got.collect()] == [2.0]
    assert "PartitionFilters: [" in got._jdf.queryExecution().executedPlan().toString()
    io.make_folder(spark, str(tmp_path / "new"))
    assert io.exists(spark, str(tmp_path / "new"))


def test_composite_prunes(spark, tmp_path):
    """Year, tile and area reach the scan of the observations."""
    from tessera.config import CompositeConfig
    from tessera.plans.composite import masked_observations, near_polygons

    df = spark.createDataFrame([(y, t, 1, x, 0, *[1.0] * 6, 4) for y in (2019, 2020) for t in "ab" for x in (5, 9000)], "year int, tile string, scene long, x long, y long, blue double, green double, red double, nir double, swir1 double, swir2 double, scl int")
    io.write_collection(df, str(tmp_path / "c"))
    polys = spark.range(1).select(rectangle(F.lit(0.0), F.lit(0.0), F.lit(9.0), F.lit(9.0)).alias("geom"))
    obs = near_polygons(io.read_collection(spark, str(tmp_path / "c"), (2020, 2020), ["a"]), polys, 300)
    scenes = spark.createDataFrame([(1, 30.0)], "scene long, azimuth double")
    clouds = obs.select("scene", F.lit(0).alias("cloud_id"), "x", "y", F.lit(5.0).alias("probability"))
    out = masked_observations(obs, scenes, clouds, CompositeConfig())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "LessThanOrEqual(x,309)" in plan
    assert [(r.x, r.blue) for r in out.collect()] == [(5, 1.0)]


def test_radar_and_basemap(spark, tmp_path):
    p = lambda n: str(tmp_path / n)
    rows = [(s, x, y, -8.0, -14.0, 35.0) for s in (1, 2, 3) for x in range(5) for y in range(5)]
    spark.createDataFrame(rows, "scene int, x long, y long, VV double, VH double, angle double").withColumn("angle", F.col("angle") + F.col("x") / 10).write.parquet(p("radar"))
    scenes = [(1, "2021-01-05", ["VV", "VH"], "IW"), (2, "2021-01-06", ["VV"], "IW"), (3, "2021-03-01", ["VV", "VH"], "IW")]
    spark.createDataFrame(scenes, "scene int, d string, polarisations array<string>, mode string").withColumn("ts", F.col("d").cast("timestamp_ntz")).write.parquet(p("scenes"))
    spark.createDataFrame([(x, y, float(y)) for x in range(5) for y in range(5)], "x long, y long, elevation double").write.parquet(p("ground"))
    cli.main(["radar", "--observations", p("radar"), "--scenes", p("scenes"), "--elevation", p("ground"), "--start", "2021-01-04", "--output", p("s1")], spark)
    got = {(r.x, r.y): r for r in spark.read.parquet(p("s1")).collect() if r.VV is not None}
    assert len(got) == 9 and all(0 < r.VH < r.VV < 10_000 for r in got.values())  # the edges have no slope
    plain = got[2, 2]
    assert plain.VV / plain.VH == pytest.approx(10 ** 0.6, rel=0.01)  # 6 dB apart, whatever the flattening

    images = [(f"2021-{m:02d}-01", 0, 0, 100.0 * m, 50.0, 300.0) for m in range(1, 13)] + [("2020-05-01", 0, 0, 1.0, 1.0, 1.0)]
    spark.createDataFrame(images, "d string, x long, y long, R double, G double, N double").withColumn("ts", F.col("d").cast("timestamp_ntz")).write.parquet(p("planet"))
    cli.main(["basemap", "--images", p("planet"), "--year", "2021", "--topography", p("ground"), "--output", p("base")], spark)
    row = spark.read.parquet(p("base")).filter("x = 0 and y = 0").first()
    assert len(row) == 2 + 12 * 6 + 1 and row["3_NDVI"] == 0 and row["1_NDVI"] == pytest.approx(0.5) and row["elevation"] == 0


def test_landsat(spark):
    bands = [f"{p}{b}" for p in ("p20_", "", "p80_") for b in ("blue", "green", "red", "nir", "swir1", "swir2")]
    df = spark.createDataFrame([(1, 2, *[float(100 + 7 * i) for i in range(18)], 2900.0)], "x long, y long, " + ", ".join(f"{b} double" for b in [*bands, "thermal"]))
    out = landsat_covariates(df, ["x", "y"])
    assert len(out.columns) == 2 + 3 * (6 + 12 + 20) and out.first()["p20_blue"] == pytest.approx(0.01)
