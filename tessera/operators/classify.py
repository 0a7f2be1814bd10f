"""One-vs-rest random forests, their diagnostics, and the map of the most probable class."""

from __future__ import annotations

import contextlib
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.hashing import uniform
from . import forests

# The forests' settings.
TREES, BAG, SEED, DEPTH, TOP = 100, 0.7, 51515, 30, 20
#: Fits at a time; the driver holds the trees of each.
AT_ONCE = 6
#: Rows that make a partition of a fit worth while.
ROWS = 50_000
#: Above so many rows times trees, up to so many bytes of bins, a task grows whole trees (``forests``); MLlib fits less and more.
LITTLE, WHOLE = 10_000, 32_000_000
#: Folds of the out-of-bag error, and those that each sub-forest leaves out.
FOLDS, OUT = 10, 3


def one_vs_rest(points: DataFrame, label: str, value: int, name: str = "PRIM") -> DataFrame:
    """1 for the class, 0 for all others."""
    return points.withColumn(name, (F.col(label) == value).cast("double"))


def labels_of(points: DataFrame, label: str) -> list[int]:
    """The distinct class codes, sorted; as many as there are classes."""
    return [r[0] for r in points.select(label).distinct().orderBy(label).collect()]


def forest(trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> RandomForestClassifier:
    """The settings of a fit. Rows keep the node they are at, or each level would send all trees and walk them from the root."""
    return RandomForestClassifier(featuresCol="features", labelCol="PRIM", numTrees=trees, minInstancesPerNode=1, subsamplingRate=BAG, seed=seed, maxDepth=depth, featureSubsetStrategy="sqrt", probabilityCol="__probability", rawPredictionCol="__raw", predictionCol="__prediction", cacheNodeIds=True)


def importances(model: RandomForestClassificationModel, features: list[str]) -> dict[str, float]:
    values = model.featureImportances.toArray()
    return {f: float(v) for f, v in zip(features, values)}


def top_features(df: DataFrame, feature: str, importance: str, n: int = TOP) -> DataFrame:
    """The n most important features, with all that tie with the last."""
    rank = F.rank().over(Window.orderBy(F.desc(importance)))  # a row per feature
    return df.withColumn("__rank", rank).filter(F.col("__rank") <= n).drop("__rank")


def top_names(values: dict[str, float], n: int = TOP) -> list[str]:
    cut = sorted(values.values(), reverse=True)[: n][-1] if values else 0.0
    return [f for f, v in values.items() if v >= cut]


@dataclass
class Primitive:
    """A class's two fits: on all features, and on the most important ones."""

    value: int
    model: RandomForestClassificationModel | forests.Forest
    features: list[str]
    importance_all: dict[str, float]
    importance_top: dict[str, float]


def at_once(work, items: list, most: int = AT_ONCE) -> list:
    """``work`` of each item, some at a time, so that many small jobs share the cluster."""
    with ThreadPool(most) as pool:
        return pool.map(inheritable_thread_target(SparkSession.active())(work), items)


def together(rows: DataFrame) -> DataFrame:
    """Persisted rows in no more partitions than they need.

    A partition makes, sorts and sends sums for every open node of every tree,
    so its cost goes by the trees' size; fits that run side by side use the
    cores.
    """
    return rows.coalesce(-(-rows.count() // ROWS) or 1)


def train_primitive(points: DataFrame, label: str, value: int, features: list[str], trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> Primitive:
    rows = one_vs_rest(points, label, value)
    fit = lambda names: forest(trees, depth, seed).fit(VectorAssembler(inputCols=names, outputCol="features").transform(rows))
    every = importances(fit(features), features)
    chosen = top_names(every)
    model = fit(chosen)
    return Primitive(value, model, chosen, every, importances(model, chosen))


def train_primitives(points: DataFrame, label: str, features: list[str], values: list[int] | None = None, **options) -> list[Primitive]:
    """A primitive for each class; the driver loops over classes, never over rows."""
    points = points.select(label, *features).persist()
    try:
        if whole(points, features, options.get("trees", TREES)):
            return grow_primitives(points, label, features, list(values or labels_of(points, label)), **options)
        rows = together(points)
        return at_once(lambda v: train_primitive(rows, label, v, features, **options), list(values or labels_of(points, label)))
    finally:
        points.unpersist()


def whole(points: DataFrame, features: list[str], trees: int) -> bool:
    """Whether tasks grow whole trees: there is work for them, and a worker can hold the rows' bins."""
    n = points.count()
    return n * trees > LITTLE and n * len(features) <= WHOLE


def grow_primitives(points: DataFrame, label: str, features: list[str], values: list[int], trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> list[Primitive]:
    """The trees of all classes side by side: on all features, then on each class's best."""
    table = forests.table(points, label, values, features)
    try:
        every = table.forests({v: features for v in values}, trees, depth, BAG, seed, nodes=False)
        best = table.forests({v: top_names(every[v][0]) for v in values}, trees, depth, BAG, seed, nodes=True)
        return [Primitive(v, best[v][1], best[v][1].features, every[v][0], best[v][0]) for v in values]
    finally:
        table.close()


def probabilities(df: DataFrame, primitives: list[Primitive]) -> DataFrame:
    """A column ``Class<k>`` of probabilities for each primitive, added in one pass over the rows."""
    if primitives and all(isinstance(p.model, forests.Forest) for p in primitives):
        return forests.probabilities(df, {f"Class{p.value}": p.model for p in primitives})
    for p in primitives:
        scored = VectorAssembler(inputCols=p.features, outputCol="features", handleInvalid="keep").transform(df)
        scored = p.model.transform(scored)
        df = scored.withColumn(f"Class{p.value}", F.element_at(vector_to_array("__probability"), 2)).select(*df.columns, f"Class{p.value}")
    return df


def fold(id_cols: list[str], seed: int = SEED, folds: int = FOLDS) -> Column:
    return F.floor(uniform(seed, *[F.col(c) for c in id_cols]) * folds).cast("int")


#: Tables of ``prepared`` by the points' identity and what else they depend on.
_PREPARED: dict = {}


@contextlib.contextmanager
def prepared(points: DataFrame, label: str, values: list[int], features: list[str], id_cols: list[str], trees: int = TREES, seed: int = SEED, folds: int = FOLDS):
    """Inside, out-of-bag errors of these points share one table of bins; None where MLlib fits them."""
    rows = points.select(label, *features, *id_cols).persist()
    key = (id(points), label, *features, *id_cols, seed, folds)
    table = None
    try:
        if whole(rows, features, trees):
            table = _PREPARED[key] = forests.table(rows, label, values, features, fold(id_cols, seed, folds))
        rows.unpersist()
        yield table
    finally:
        rows.unpersist()
        if table is not None:
            del _PREPARED[key]
            table.close()


def out_of_bag(points: DataFrame, label: str, value: int, features: list[str], id_cols: list[str], trees: int = TREES, depth: int = DEPTH, seed: int = SEED, folds: int = FOLDS, out: int = OUT) -> float:
    """Share of rows that forests which never saw them get wrong.

    Ten sub-forests, each without three of ten hash folds, so every row is
    out of bag in exactly three of them and each trains on about 70 %.
    """
    table = _PREPARED.get((id(points), label, *features, *id_cols, seed, folds))
    if table is not None and value in table.values:
        return table.out_of_bag(value, max(1, trees // folds), depth, seed, folds, out)
    with prepared(points, label, [value], features, id_cols, trees, seed, folds) as table:
        if table is not None:
            return table.out_of_bag(value, max(1, trees // folds), depth, seed, folds, out)
    rows = one_vs_rest(points, label, value).withColumn("__fold", fold(id_cols, seed, folds))
    rows = VectorAssembler(inputCols=features, outputCol="features").transform(rows).select("features", "PRIM", "__fold", *id_cols).persist()
    try:
        few = together(rows)

        def part(b: int) -> DataFrame:
            held = F.col("__fold").isin([(b + k) % folds for k in range(out)])
            model = forest(max(1, trees // folds), depth, seed + b).setSubsamplingRate(1.0).fit(few.filter(~held))
            return model.transform(few.filter(held)).select(*id_cols, "PRIM", F.element_at(vector_to_array("__probability"), 2).alias("p"))

        parts = at_once(part, list(range(folds)), AT_ONCE if few.rdd.getNumPartitions() == 1 else 3)  # ten at once filled a heap of 750 MB at 102,564 rows
        every = parts[0]
        for p in parts[1:]:
            every = every.union(p)
        voted = every.groupBy(*id_cols).agg(F.max("PRIM").alias("y"), F.avg("p").alias("p"))
        return float(voted.agg(F.avg(((F.col("p") >= 0.5).cast("double") != F.col("y")).cast("double"))).first()[0])
    finally:
        rows.unpersist()


def most_probable(df: DataFrame, columns: dict[int, str], name: str = "LANDCOVER") -> DataFrame:
    """The class code with the greatest probability, the first one at ties; NULL where any is masked."""
    codes = F.array(*[F.lit(c) for c in columns])
    values = F.array(*[F.col(c) for c in columns.values()])
    whole = F.forall(values, lambda v: v.isNotNull())
    return df.withColumn(name, F.when(whole, F.element_at(codes, F.array_position(values, F.array_max(values)).cast("int"))))


def to_bands(images: DataFrame, keys: list[str], index: str, values: list, band: str) -> DataFrame:
    """A column for each image: a pivot with known values, so one aggregation."""
    return images.groupBy(*keys).pivot(index, values).agg(F.first(band, ignorenulls=True))
