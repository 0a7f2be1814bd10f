"""Joins of scenes, pixels, points and class tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def save_first(primary: DataFrame, secondary: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Each primary row with the first secondary row of its key; primary rows without one go."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    first = secondary.withColumn("__rank", rank).filter(F.col("__rank") == 1).drop("__rank")
    return primary.join(first, key)


def near_pairs(points: DataFrame, distance: float, id_col: str = "id", x: str = "x", y: str = "y", class_col: str | None = None) -> DataFrame:
    """(id, other, distance) for all ordered pairs of different points (of one class, if one is named) within a distance.

    Points are dealt to square cells of the distance's size; each looks into
    its own and the eight cells around it, so no point meets all others.
    """
    cell = lambda c: F.floor(F.col(c) / distance).cast("long")
    own = F.col(class_col) if class_col else F.lit(0)
    placed = points.select(own.alias("class"), F.col(id_col).alias("id"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), cell(x).alias("cx"), cell(y).alias("cy"))
    around = F.array(*[F.struct(F.lit(i).cast("long").alias("i"), F.lit(j).cast("long").alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    seeking = placed.withColumn("o", F.explode(around)).select("class", F.col("id").alias("other"), F.col("x").alias("ox"), F.col("y").alias("oy"), (F.col("cx") + F.col("o.i")).alias("cx"), (F.col("cy") + F.col("o.j")).alias("cy"))
    far = F.hypot(F.col("x") - F.col("ox"), F.col("y") - F.col("oy"))
    # Both sides grow with the input: neither is ever broadcast, however small its file looks.
    return placed.join(seeking.hint("merge"), ["class", "cx", "cy"]).filter((F.col("id") != F.col("other")) & (far <= distance)).select("id", "other", far.alias("distance"))


def sample_regions(points: DataFrame, raster: DataFrame, scale: float, bands: list[str], x: str = "px", y: str = "py") -> DataFrame:
    """Points with the bands of the raster cell that holds them; points on masked cells go."""
    cell = lambda c: F.floor(F.col(c) / scale).cast("long")
    placed = points.withColumns({"__x": cell(x), "__y": cell(y)})
    cells = raster.select(F.col("x").cast("long").alias("__x"), F.col("y").cast("long").alias("__y"), *bands)
    return placed.join(cells, ["__x", "__y"]).drop("__x", "__y").dropna(subset=bands)


def static_layers(stack: DataFrame, layers: DataFrame, keys: list[str], bands: list[str], fill: float | None = 0, fill_static_only: bool = False) -> DataFrame:
    """The stack with static bands; missing values of all bands (or of the static ones) are filled."""
    joined = stack.join(layers.select(*keys, *bands), keys, "left")
    if fill is None:
        return joined
    return joined.fillna(fill, subset=bands if fill_static_only else [c for c in joined.columns if c not in keys])


def class_names(df: DataFrame, legend: dict[int, str], code: str, name: str) -> DataFrame:
    """The class name of a code; a map literal, so there is no join at all."""
    table = F.create_map(*[F.lit(v) for k in legend.items() for v in k])
    return df.withColumn(name, F.try_element_at(table, F.col(code).cast("int")))
