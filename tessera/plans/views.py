"""Test tables seen as rasters: observations, scenes, grids, polygons and labels.

Each view is given twice, as a DataFrame and as the DuckDB SQL of a CTE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import rectangle

SQL = {
    "obs": "SELECT l_orderkey AS scene, l_suppkey AS px, l_suppkey % 50 AS x, l_suppkey // 50 AS y, CAST(2 * l_linenumber AS INTEGER) AS scl, l_shipdate AS ts, 10000 * l_tax AS blue, 10000 * l_discount AS green, 40 * l_quantity AS red, l_extendedprice / 20 AS nir, l_extendedprice / l_quantity AS swir1, CAST(20 * ((l_suppkey % 50) + l_linenumber) AS DOUBLE) AS swir2, l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem",
    "scenes": "SELECT o_orderkey AS scene, o_orderdate AS ts, o_orderkey % 100 AS cloudy_pct, (o_custkey * 7) % 360 AS azimuth FROM orders",
    "clouds": "SELECT o_orderkey AS scene, o_custkey AS cloud_id, CAST((o_custkey * 13) % 100 AS DOUBLE) AS probability FROM orders",
    "cloudpix": "SELECT l_orderkey AS scene, CAST(l_linenumber % 2 AS BIGINT) AS cloud_id, l_suppkey % 50 AS x, l_suppkey // 50 AS y, CAST((l_partkey * 13) % 100 AS DOUBLE) AS probability FROM lineitem",
    "grid": "SELECT p_partkey % 50 AS x, p_partkey // 50 AS y, p_partkey AS cell, p_retailprice AS elevation, CAST(2 * p_size AS DOUBLE) AS probability, CAST(60 * p_size AS DOUBLE) AS nir, CAST(p_size % 12 AS INTEGER) AS scl, -5 - CAST(p_size AS DOUBLE) / 5 AS VV, -12 - CAST(p_size % 17 AS DOUBLE) / 3 AS VH, 30 + CAST((p_partkey % 50) AS DOUBLE) / 10 + CAST((p_partkey // 50) % 7 AS DOUBLE) / 20 AS angle FROM part",
    "polys": "SELECT CAST(n_nationkey AS BIGINT) AS fid, CAST(n_regionkey AS INTEGER) AS class, CAST((n_nationkey * 7) % 40 AS DOUBLE) AS x0, CAST((n_nationkey * 3) % 35 AS DOUBLE) AS y0, CAST((n_nationkey * 7) % 40 + 4 + n_regionkey AS DOUBLE) AS x1, CAST((n_nationkey * 3) % 35 + 3 + n_nationkey % 4 AS DOUBLE) AS y1 FROM nation",
    "labelled": "SELECT l_orderkey AS id, CAST(l_quantity AS INTEGER) % 8 + 1 AS label, CASE WHEN l_partkey % 5 = 0 THEN l_suppkey % 8 + 1 ELSE CAST(l_quantity AS INTEGER) % 8 + 1 END AS pred FROM lineitem",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return table(spark, sf_dir, "lineitem").select(
        c("l_orderkey").alias("scene"),
        c("l_suppkey").alias("px"),
        (c("l_suppkey") % 50).alias("x"),
        F.floor(c("l_suppkey") / 50).cast("long").alias("y"),
        (2 * c("l_linenumber")).cast("int").alias("scl"),
        c("l_shipdate").alias("ts"),
        (10000 * c("l_tax")).alias("blue"),
        (10000 * c("l_discount")).alias("green"),
        (40 * c("l_quantity")).alias("red"),
        (c("l_extendedprice") / 20).alias("nir"),
        (c("l_extendedprice") / c("l_quantity")).alias("swir1"),
        (20 * ((c("l_suppkey") % 50) + c("l_linenumber"))).cast("double").alias("swir2"),
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
    )


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return table(spark, sf_dir, "orders").select(c("o_orderkey").alias("scene"), c("o_orderdate").alias("ts"), (c("o_orderkey") % 100).alias("cloudy_pct"), ((c("o_custkey") * 7) % 360).alias("azimuth"))


def clouds(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return table(spark, sf_dir, "orders").select(c("o_orderkey").alias("scene"), c("o_custkey").alias("cloud_id"), ((c("o_custkey") * 13) % 100).cast("double").alias("probability"))


def cloud_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    image = (c("l_linenumber") % 2).cast("long").alias("cloud_id")
    x, y = (c("l_suppkey") % 50).alias("x"), F.floor(c("l_suppkey") / 50).cast("long").alias("y")
    return table(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("scene"), image, x, y, ((c("l_partkey") * 13) % 100).cast("double").alias("probability"))


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, size = F.col, F.col("p_size")
    row = F.floor(c("p_partkey") / 50).cast("long")
    return table(spark, sf_dir, "part").select(
        (c("p_partkey") % 50).alias("x"),
        row.alias("y"),
        c("p_partkey").alias("cell"),
        c("p_retailprice").alias("elevation"),
        (2 * size).cast("double").alias("probability"),
        (60 * size).cast("double").alias("nir"),
        (size % 12).cast("int").alias("scl"),
        (-5 - size.cast("double") / 5).alias("VV"),
        (-12 - (size % 17).cast("double") / 3).alias("VH"),
        (30 + (c("p_partkey") % 50).cast("double") / 10 + (row % 7).cast("double") / 20).alias("angle"),
    )


def polys(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = F.col("n_nationkey"), F.col("n_regionkey")
    x0, y0 = ((n * 7) % 40).cast("double"), ((n * 3) % 35).cast("double")
    df = table(spark, sf_dir, "nation").select(n.cast("long").alias("fid"), r.cast("int").alias("class"), x0.alias("x0"), y0.alias("y0"), (x0 + 4 + r).alias("x1"), (y0 + 3 + n % 4).alias("y1"))
    return df.withColumn("geom", rectangle(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.col("l_quantity").cast("int") % 8 + 1
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), own.cast("int").alias("label"), F.when(F.col("l_partkey") % 5 == 0, F.col("l_suppkey") % 8 + 1).otherwise(own).cast("int").alias("pred"))


def labels_px(spark: SparkSession, sf_dir: str, width: int = 64) -> DataFrame:
    """(id, LANDCOVER 1 to 10, f0 ...): a wide feature table."""
    df = table(spark, sf_dir, "embeddings")
    return df.select(F.col("vec_id").alias("id"), (F.col("label") + 1).alias("LANDCOVER"), *[F.col("embedding")[k].cast("double").alias(f"f{k}") for k in range(width)])


def with_views(sql: str, *names: str) -> str:
    """A query with the named views as leading CTEs."""
    head = ", ".join(f"{n} AS ({SQL[n]})" for n in names)
    return f"WITH RECURSIVE {head}{sql}" if sql.lstrip().startswith(",") else f"WITH {head} {sql}"
