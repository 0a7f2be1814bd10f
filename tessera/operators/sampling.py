"""Stratified sampling, random points, spatial thinning and the train/test split.

Random numbers are hashes of seed and id, so a sample is the same for any
partitioning and after any retry.
"""

from __future__ import annotations

import math
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.geometry import area, bounds, contains
from ..functions.hashing import DEFAULT_SEED, uniform
from .joins import near_pairs, sample_regions

TRAIN_SHARE = 0.8
OVERSAMPLE = 2


def allocation(spark: SparkSession, class_values: list[int], class_points: list[int]) -> DataFrame:
    """(class, n): a row per class; lists of different lengths are an error."""
    if len(class_values) != len(class_points):
        raise ValueError(f"class_values and class_points differ in length: {class_values} {class_points}")
    return spark.createDataFrame(list(zip(class_values, class_points)), "class int, n int")


def resolve_points(class_values: list[int] | None, class_points: list[int] | None, n_points: int | None = None) -> int | None:
    """The number for every class, or None where lists give it; one list without the other is an error."""
    if (class_values is None) != (class_points is None):
        raise ValueError("give both class_values and class_points, or neither")
    if class_values is not None:
        if len(class_values) != len(class_points):
            raise ValueError(f"class_values and class_points differ in length: {class_values} {class_points}")
        return None
    return 100 if n_points is None else n_points


def random_column(df: DataFrame, id_cols: list[str], seed: int = DEFAULT_SEED, name: str = "random") -> DataFrame:
    return df.withColumn(name, uniform(seed, *[F.col(c) for c in id_cols]))


def limit_per_class(df: DataFrame, class_col: str, n: int | Column, order: list[str]) -> DataFrame:
    """The first n rows of each class; Spark cuts each partition to n before the exchange."""
    rank = F.row_number().over(Window.partitionBy(class_col).orderBy(*order))
    return df.withColumn("__rank", rank).filter(F.col("__rank") <= n).drop("__rank")


def stratified_sample(df: DataFrame, class_col: str, id_cols: list[str], n_points: int | None = None, class_values: list[int] | None = None, class_points: list[int] | None = None, seed: int = DEFAULT_SEED, drop_nulls: bool = True, bands: list[str] | None = None) -> DataFrame:
    """Exactly n rows of each class (or all it has), by the order of a random column."""
    n = resolve_points(class_values, class_points, n_points)
    rows = df.dropna(subset=[class_col, *(bands or [])]) if drop_nulls else df
    rows = random_column(rows, id_cols, seed)
    if n is not None:
        return limit_per_class(rows, class_col, n, ["random", *id_cols])
    wanted = allocation(df.sparkSession, class_values, class_points)
    wanted = wanted.select(F.col("class").alias("__class"), F.col("n").alias("__n"))
    rows = rows.join(F.broadcast(wanted), F.col(class_col) == F.col("__class")).drop("__class")  # a row per class
    return limit_per_class(rows.filter(F.col("__n") > 0), class_col, F.col("__n"), ["random", *id_cols]).drop("__n")


def attempts(n: float, share: float) -> int:
    """How many draws make ``n`` hits, each with probability ``share``, all but certain (eight deviations)."""
    need = n / share
    return math.ceil(need + 8 * math.sqrt(need * (1 - share) / share + 1)) if share < 1 else math.ceil(n)


def random_points(polygons: DataFrame, n: int | dict[int, int], seed: int = DEFAULT_SEED, class_col: str | None = None, id_col: str = "fid", ring_col: str = "geom") -> DataFrame:
    """n points, uniform over the area of all polygons, or of each class's: (polygon columns, k, px, py).

    A draw picks a polygon by the area of its box and a place in that box; it
    counts if it lies inside. Draws are numbered, and the first n that count
    are taken, so every point of the area is as likely as any other, whatever
    the polygons' sizes and shapes. ``n`` is one number or one for each class.
    """
    spark = polygons.sparkSession
    own = F.col(class_col) if class_col else F.lit(0)
    wanted = None if isinstance(n, int) else F.create_map(*[F.lit(v) for k in n.items() for v in k])
    n_of = F.lit(n) if wanted is None else F.try_element_at(wanted, own.cast("int"))
    box = bounds(F.col(ring_col))
    boxes = polygons.withColumns({"__class": own, "__n": n_of, "__size": (box["x1"] - box["x0"]) * (box["y1"] - box["y0"]), "__area": area(F.col(ring_col))}).filter("__n > 0 and __area > 0")
    totals = boxes.groupBy("__class").agg(F.max("__n").alias("n"), F.sum("__size").alias("size"), F.sum("__area").alias("area")).collect()  # a row for each class
    if not totals:
        return polygons.limit(0).select("*", F.lit(0).alias("k"), F.lit(0.0).alias("px"), F.lit(0.0).alias("py"))
    kind = boxes.schema["__class"].dataType.simpleString()
    draws = spark.createDataFrame([(t[0], attempts(t["n"], min(1.0, t["area"] / t["size"])), float(t["size"])) for t in totals], f"__class {kind}, m int, total double")
    draws = draws.select("__class", F.explode(F.sequence(F.lit(1), "m")).alias("k"), "total")
    parts = [F.col("__class")] if class_col else []
    at = lambda salt: uniform(seed, *parts, F.col("k"), salt=salt)
    draws = draws.select("__class", "k", (at("p") * F.col("total")).alias("__at"))
    # Boxes of a class lie one after the other on a line, and a draw falls on one of them.
    before = F.sum("__size").over(Window.partitionBy("__class").orderBy(id_col)) - F.col("__size")
    held = boxes.select("__class", before.alias("__at"), F.struct(*polygons.columns, "__n").alias("__poly"))
    line = draws.unionByName(held, allowMissingColumns=True)
    along = Window.partitionBy("__class").orderBy(F.col("__at"), F.col("k").isNotNull(), "k").rowsBetween(Window.unboundedPreceding, 0)
    line = line.withColumn("__poly", F.last("__poly", ignorenulls=True).over(along)).filter("k is not null").select("__class", "k", "__poly.*")
    place = lambda lo, hi, salt: lo + at(salt) * (hi - lo)
    points = line.withColumns({"px": place(box["x0"], box["x1"], "x"), "py": place(box["y0"], box["y1"], "y")})
    points = points.filter(contains(F.col(ring_col), F.col("px"), F.col("py")))
    rank = F.row_number().over(Window.partitionBy("__class").orderBy("k"))
    return points.withColumn("__rank", rank).filter(F.col("__rank") <= F.col("__n")).select(*polygons.columns, "k", "px", "py")


def distance_filter(points: DataFrame, distance: float, id_col: str = "id", x: str = "x", y: str = "y", checkpoint: str | None = None, class_col: str | None = None) -> DataFrame:
    """Greedy thinning in id order: a point goes if a kept point of smaller id (and the same class, if one is named) lies within the distance.

    Rounds decide points all of whose smaller neighbours are decided, until
    none is open; this equals the one-by-one scan. Each round is a table in
    the shared folder, so lineage stays short and a lost executor costs one
    round at most.
    """
    spark = points.sparkSession
    base = checkpoint or spark.conf.get("spark.checkpoint.dir", None) or _local_dir(spark)
    folder = f"{base}/thin-{uuid.uuid4().hex}"

    def put(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    edges = put(near_pairs(points, distance, id_col, x, y, class_col).filter("other < id").select("id", "other"), "edges")
    status = put(edges.select("id").union(edges.select(F.col("other").alias("id"))).distinct().withColumn("kept", F.lit(None).cast("boolean")), "status-0")
    step = 0
    while status.filter("kept is null").limit(1).count():
        known = status.select(F.col("id").alias("other"), F.col("kept").alias("other_kept"))
        seen = edges.join(known, "other").groupBy("id").agg(F.max("other_kept").alias("blocked"), F.sum(F.col("other_kept").isNull().cast("int")).alias("open"))
        decided = F.when(F.col("kept").isNotNull(), F.col("kept")).when(F.col("blocked"), F.lit(False)).when(F.coalesce("open", F.lit(0)) == 0, F.lit(True))
        step += 1
        status = put(status.join(seen, "id", "left").select("id", decided.alias("kept")), f"status-{step}")
    gone = status.filter("not kept").select(F.col("id").alias("__gone"))
    return points.join(gone, F.col(id_col) == F.col("__gone"), "left_anti")


def _local_dir(spark: SparkSession) -> str:
    """Only where no shared folder is set and the master is this machine alone, as in tests."""
    import tempfile

    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir is unset: it must name a folder that driver and executors share")
    return "file://" + tempfile.mkdtemp(prefix="tessera-")


def _class_points(polygons: DataFrame, class_col: str, n_points: dict[int, int], seed: int, id_col: str, ring_col: str) -> DataFrame:
    """Twice the wanted points over each class's area, with an id."""
    many = {k: OVERSAMPLE * n for k, n in n_points.items()}
    points = random_points(polygons, many, seed, class_col, id_col, ring_col)
    return points.withColumn("id", F.concat_ws("_", F.col(class_col).cast("string"), F.lpad(F.col("k").cast("string"), 9, "0")))


def _first_of_class(points: DataFrame, class_col: str, n_points: dict[int, int], seed: int) -> DataFrame:
    wanted = F.create_map(*[F.lit(v) for k in n_points.items() for v in k])
    return limit_per_class(random_column(points, ["id"], seed), class_col, F.try_element_at(wanted, F.col(class_col).cast("int")), ["random", "id"]).drop("k")


def sample_points(polygons: DataFrame, class_col: str, n_points: dict[int, int], seed: int = DEFAULT_SEED, distance: float | None = None, id_col: str = "fid", ring_col: str = "geom") -> DataFrame:
    """Random points over each class's area, thinned by distance within the class, shuffled, cut to n for each class."""
    points = _class_points(polygons, class_col, n_points, seed, id_col, ring_col)
    if distance:
        points = distance_filter(points, distance, "id", "px", "py", class_col=class_col)
    return _first_of_class(points, class_col, n_points, seed)


def sample_with_extraction(polygons: DataFrame, raster: DataFrame, class_col: str, n_points: dict[int, int], scale: float, bands: list[str], seed: int = DEFAULT_SEED, id_col: str = "fid", ring_col: str = "geom") -> DataFrame:
    """Random points over each class's area with the raster's bands; points on masked cells go before the cut to n."""
    points = _class_points(polygons, class_col, n_points, seed, id_col, ring_col)
    return _first_of_class(sample_regions(points, raster, scale, bands), class_col, n_points, seed).drop(ring_col)


def split_train_test(df: DataFrame, id_cols: list[str], seed: int = DEFAULT_SEED, share: float = TRAIN_SHARE) -> tuple[DataFrame, DataFrame]:
    """Disjoint, and together all rows."""
    marked = random_column(df, id_cols, seed)
    train = F.coalesce(F.col("random") < share, F.lit(False))
    return marked.filter(train), marked.filter(~train)


def proportional_allocation(polygons: DataFrame, class_col: str, multiplier: int) -> DataFrame:
    """(class, n): a multiple of each class's number of polygons."""
    return polygons.groupBy(class_col).agg((F.count(F.lit(1)) * multiplier).alias("n"))


def plot_ids(points: DataFrame, id_col: str, lon: str, lat: str, prefix: str | None = None) -> DataFrame:
    """LON, LAT, PLOTID and SAMPLEID columns for a photo-interpretation tool."""
    name = F.col(id_col).cast("string")
    if prefix:
        name = F.concat_ws("_", F.lit(prefix), name)
    return points.withColumns({"LON": F.col(lon), "LAT": F.col(lat), "PLOTID": name, "SAMPLEID": name})


def paint(cells: DataFrame, polygons: DataFrame, value: str, cell: int = 16, id_col: str = "fid") -> DataFrame:
    """(x, y, value): the value of the polygon over each cell, the last by id where several lie; 0 becomes NULL."""
    from ..functions.geometry import points_in_rings

    over = points_in_rings(cells.select("x", "y"), polygons, cell).groupBy("x", "y").agg(F.max_by(value, id_col).alias(value))
    painted = cells.select("x", "y").join(over, ["x", "y"], "left").withColumn(value, F.nullif(F.coalesce(value, F.lit(0)), F.lit(0)))
    return painted


def merge_sets(*sets: DataFrame) -> DataFrame:
    """Training sets together, as bags; missing columns are NULL."""
    out = sets[0]
    for other in sets[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out
