"""Queries over samples, classifiers, accuracy and areas, with their DuckDB oracles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry
from ..functions.hashing import DEFAULT_SEED, uniform_sql
from ..operators import accuracy, classify, joins, sampling, temporal
from . import views
from .raster_queries import r, rounded, sr

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None, *names: str):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = views.with_views(sql, *names) if names else sql
        return f

    return keep


_U = uniform_sql(DEFAULT_SEED, "o_orderkey")


@query("random_column", f"SELECT o_orderkey, {_U} AS random FROM orders")
def random_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.random_column(views.table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])


@query("split_train_test", f"SELECT o_orderkey, CASE WHEN {_U} < 0.8 THEN 'train' ELSE 'test' END AS part FROM orders")
def split_train_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = sampling.split_train_test(views.table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test"))).select("o_orderkey", "part")


@query("strat_sample_exact_n", f"SELECT o_orderkey, o_orderpriority, random FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY random, o_orderkey) AS k FROM (SELECT o_orderkey, o_orderpriority, {_U} AS random FROM orders)) WHERE k <= 100")
def strat_sample_exact_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return sampling.stratified_sample(df, "o_orderpriority", ["o_orderkey"], n_points=100)


_POINTS = {1: 40, 2: 25, 3: 60, 4: 10}


@query("strat_sample_allocation", f", w AS (SELECT * FROM (VALUES {', '.join(f'({k}, {n})' for k, n in _POINTS.items())}) v(class, n)), q AS (SELECT c_custkey, CAST(c_nationkey % 5 AS INTEGER) AS class, {uniform_sql(DEFAULT_SEED, 'c_custkey')} AS random FROM customer) SELECT c_custkey, class, random FROM (SELECT q.*, w.n, row_number() OVER (PARTITION BY q.class ORDER BY random, c_custkey) AS k FROM q JOIN w USING (class)) WHERE k <= n", "polys")
def strat_sample_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = views.table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_nationkey") % 5).cast("int").alias("class"))
    return sampling.stratified_sample(df, "class", ["c_custkey"], class_values=list(_POINTS), class_points=list(_POINTS.values()))


def _s_points(n: dict[int, int], seed: int = DEFAULT_SEED) -> str:
    """CTEs up to ``pts``: n points over each class's rectangles. All of a rectangle is its box, so every draw counts."""
    u = {salt: uniform_sql(seed, "class", "k", salt=salt) for salt in "pxy"}
    rows = ", ".join(f"({c}, {m})" for c, m in n.items())
    return (
        f", w AS (SELECT * FROM (VALUES {rows}) v(class, n)), b AS (SELECT p.*, (x1 - x0) * (y1 - y0) AS size, sum((x1 - x0) * (y1 - y0)) OVER (PARTITION BY class ORDER BY fid) AS upto FROM polys p),"
        f" d AS (SELECT class, n, CAST(unnest(range(1, n + 1)) AS INTEGER) AS k FROM w), t AS (SELECT class, sum(size) AS total FROM b GROUP BY class),"
        f" a AS (SELECT d.*, {u['p']} * t.total AS at FROM d JOIN t USING (class)),"
        f" pts AS (SELECT a.class, a.n, a.k, b.fid, x0 + {u['x'].replace('class', 'a.class').replace('CAST(k', 'CAST(a.k')} * (x1 - x0) AS px, y0 + {u['y'].replace('class', 'a.class').replace('CAST(k', 'CAST(a.k')} * (y1 - y0) AS py FROM a JOIN b ON a.class = b.class AND a.at >= b.upto - b.size AND a.at < b.upto)"
    )


_FEW = {k: 60 for k in range(5)}
_S_FEW = _s_points(_FEW)


@query("random_points_in_polygon", _S_FEW + f" SELECT class, fid, k, {sr('px', 'px', 9)}, {sr('py', 'py', 9)} FROM pts", "polys")
def random_points_in_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sampling.random_points(views.polys(spark, sf_dir), _FEW, class_col="class")
    return rounded(out, ["px", "py"], 9).select("class", "fid", "k", "px", "py")


@query("sample_regions", _S_FEW + f" SELECT s.class, s.k, g.cell, {sr('g.elevation', 'elevation')}, g.probability FROM pts s JOIN grid g ON g.x = floor(s.px) AND g.y = floor(s.py) WHERE g.probability <> 50", "polys", "grid")
def sample_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = sampling.random_points(views.polys(spark, sf_dir), _FEW, class_col="class").select("class", "k", "px", "py")
    raster = views.grid(spark, sf_dir).withColumn("probability", F.nullif(F.col("probability"), F.lit(50.0)))
    out = joins.sample_regions(points, raster, 1.0, ["cell", "elevation", "probability"])
    return rounded(out, ["elevation"]).select("class", "k", "cell", "elevation", "probability")


_ID = "(CAST(class AS VARCHAR) || '_' || lpad(CAST(k AS VARCHAR), 9, '0'))"
_S_TWICE = _s_points({k: sampling.OVERSAMPLE * n for k, n in _POINTS.items()})
_S_CUT = f", ran AS (SELECT *, {uniform_sql(DEFAULT_SEED, 'id')} AS random FROM ext), cut AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY random, id) AS r FROM ran)"


@query("strat_sample_extraction", _S_TWICE + f", ext AS (SELECT {_ID} AS id, pts.class, pts.n, g.cell, g.elevation FROM pts JOIN grid g ON g.x = floor(px) AND g.y = floor(py))" + _S_CUT + f" SELECT id, class, cell, {sr('elevation', 'elevation')}, random FROM cut WHERE r <= n // {sampling.OVERSAMPLE}", "polys", "grid")
def strat_sample_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sampling.sample_with_extraction(views.polys(spark, sf_dir), views.grid(spark, sf_dir), "class", _POINTS, 1.0, ["cell", "elevation"])
    return rounded(out, ["elevation"]).select("id", "class", "cell", "elevation", "random")


def _s_thinned(distance: float, source: str = "pts") -> str:
    """CTEs up to ``thin``: the points one by one in the order of their ids, each kept if no kept one of its class is near."""
    return (
        f", num AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY k) AS i FROM {source}),"
        " step AS (SELECT class, CAST(0 AS BIGINT) AS i, CAST([] AS STRUCT(k INTEGER, x DOUBLE, y DOUBLE)[]) AS kept FROM (SELECT DISTINCT class FROM num)"
        f" UNION ALL SELECT s.class, n.i, CASE WHEN len(list_filter(s.kept, lambda q: sqrt((q.x - n.px) * (q.x - n.px) + (q.y - n.py) * (q.y - n.py)) <= {distance})) = 0 THEN list_append(s.kept, {{'k': n.k, 'x': n.px, 'y': n.py}}) ELSE s.kept END FROM step s JOIN num n ON n.class = s.class AND n.i = s.i + 1),"
        " done AS (SELECT class, unnest(max_by(kept, i)).k AS k FROM step GROUP BY class), thin AS (SELECT num.* FROM num JOIN done USING (class, k))"
    )


@query("distance_filter", _S_FEW + _s_thinned(0.8) + f" SELECT class * 1000 + k AS id, {sr('px', 'px', 9)}, {sr('py', 'py', 9)} FROM thin", "polys")
def distance_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = sampling.random_points(views.polys(spark, sf_dir), _FEW, class_col="class").select("class", (F.col("class") * 1000 + F.col("k")).alias("id"), "px", "py")
    return rounded(sampling.distance_filter(points, 0.8, "id", "px", "py", class_col="class"), ["px", "py"], 9).drop("class")


@query("strat_sample_thinned", _S_TWICE + _s_thinned(0.5) + f", ext AS (SELECT {_ID} AS id, class, n, px, py FROM thin)" + _S_CUT + f" SELECT id, class, {sr('px', 'px', 9)}, {sr('py', 'py', 9)}, random FROM cut WHERE r <= n // {sampling.OVERSAMPLE}", "polys")
def strat_sample_thinned(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sampling.sample_points(views.polys(spark, sf_dir), "class", _POINTS, distance=0.5)
    return out.select("id", "class", r("px", 9).alias("px"), r("py", 9).alias("py"), "random")


@query("ceo_export_view", f"SELECT {sr('x * 10.0', 'LON')}, {sr('y * 10.0', 'LAT')}, 'aoi_' || CAST(cell AS VARCHAR) AS PLOTID, 'aoi_' || CAST(cell AS VARCHAR) AS SAMPLEID, scl FROM grid", "grid")
def ceo_export_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = views.grid(spark, sf_dir).withColumns({"lon": F.col("x") * 10.0, "lat": F.col("y") * 10.0})
    return rounded(sampling.plot_ids(df, "cell", "lon", "lat", "aoi"), ["LON", "LAT"]).select("LON", "LAT", "PLOTID", "SAMPLEID", "scl")


@query("paint_selfmask", "SELECT g.x, g.y, CAST(nullif(coalesce(p.class, 0), 0) AS DOUBLE) AS class FROM grid g LEFT JOIN (SELECT g.x, g.y, max_by(p.class, p.fid) AS class FROM grid g JOIN polys p ON g.x >= p.x0 AND g.x < p.x1 AND g.y >= p.y0 AND g.y < p.y1 GROUP BY 1, 2) p USING (x, y)", "grid", "polys")
def paint_selfmask(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sampling.paint(views.grid(spark, sf_dir), views.polys(spark, sf_dir), "class")
    return out.select("x", "y", F.col("class").cast("double").alias("class"))


@query("clip_to_polygons", "SELECT DISTINCT g.cell FROM grid g JOIN polys p ON g.x >= p.x0 AND g.x < p.x1 AND g.y >= p.y0 AND g.y < p.y1", "grid", "polys")
def clip_to_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometry.points_in_rings(views.grid(spark, sf_dir).select("cell", "x", "y"), views.polys(spark, sf_dir).select("geom"), 16).select("cell").distinct()


@query("bounds_buffer", f"SELECT {sr('min(x0) - 5', 'x0')}, {sr('min(y0) - 5', 'y0')}, {sr('max(x1) + 5', 'x1')}, {sr('max(y1) + 5', 'y1')} FROM polys", "polys")
def bounds_buffer(spark: SparkSession, sf_dir: str) -> DataFrame:
    corners = views.polys(spark, sf_dir).select(F.explode("geom").alias("p")).select("p.x", "p.y")
    box = geometry.extent(corners)
    return box.select(*[r(c).alias(k) for k, c in geometry.buffered({k: F.col(k) for k in box.columns}, 5).items()])


@query("erode_geometry", "SELECT g.cell, p.fid FROM grid g JOIN polys p ON g.x >= p.x0 + 1 AND g.x <= p.x1 - 1 AND g.y >= p.y0 + 1 AND g.y <= p.y1 - 1", "grid", "polys")
def erode_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    inside = geometry.points_in_rings(views.grid(spark, sf_dir).select("cell", "x", "y"), views.polys(spark, sf_dir).select("fid", "geom"), 16)
    return inside.filter(geometry.within(F.col("geom"), F.col("x").cast("double"), F.col("y").cast("double"), -1.0)).select("cell", "fid")


@query("class_histogram", "SELECT label, count(*) AS n FROM labelled GROUP BY label", "labelled")
def class_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accuracy.histogram(views.labelled(spark, sf_dir), "label")


@query("prop_allocation", "SELECT class, CAST(count(*) * 10 AS BIGINT) AS n FROM polys GROUP BY class", "polys")
def prop_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.proportional_allocation(views.polys(spark, sf_dir), "class", 10)


_S_AREA = ", a AS (SELECT class, sum((x1 - x0) * (y1 - y0)) AS area FROM polys GROUP BY class), s AS (SELECT class, area, area / sum(area) OVER () AS share FROM a)"


@query("area_by_class", _S_AREA + f" SELECT class, {sr('area', 'area')}, {sr('share', 'share')} FROM s", "polys")
def area_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = views.polys(spark, sf_dir).withColumn("size", geometry.area(F.col("geom")))
    return rounded(accuracy.area_by_class(df, "class", "size"), ["area", "share"]).select("class", "area", "share")


@query("majority_flag", _S_AREA + " SELECT class, share >= avg(share) OVER () AS majority FROM s", "polys")
def majority_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = views.polys(spark, sf_dir).withColumn("size", geometry.area(F.col("geom")))
    return accuracy.area_by_class(df, "class", "size").select("class", "majority")


@query("share_summary", _S_AREA + f" SELECT {sr('avg(share)', 'mean_share')}, {sr('median(share)', 'median_share')} FROM s", "polys")
def share_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = views.polys(spark, sf_dir).withColumn("size", geometry.area(F.col("geom")))
    return rounded(accuracy.share_summary(accuracy.area_by_class(df, "class", "size")), ["mean_share", "median_share"])


@query("merge_training", "SELECT o_orderkey, o_orderstatus, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders UNION ALL SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def merge_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = views.table(spark, sf_dir, "orders")
    one = orders.select("o_orderkey", "o_orderstatus")
    two = orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return sampling.merge_sets(one, two)


@query("one_vs_rest", "SELECT vec_id AS id, CAST(label + 1 AS INTEGER) AS LANDCOVER, CAST(label + 1 = 3 AS DOUBLE) AS PRIM FROM embeddings")
def one_vs_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.one_vs_rest(views.labels_px(spark, sf_dir, 1), "LANDCOVER", 3).select("id", "LANDCOVER", "PRIM")


@query("topk_ties", "SELECT p_partkey, CAST(p_size AS DOUBLE) AS importance FROM (SELECT *, rank() OVER (ORDER BY p_size DESC) AS k FROM part) WHERE k <= 20")
def topk_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = views.table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("double").alias("importance"))
    return classify.top_features(df, "p_partkey", "importance")


@query("argmax_landcover", "SELECT vec_id AS id, CAST(list_position(embedding[1:8], list_max(embedding[1:8])) AS INTEGER) AS LANDCOVER FROM embeddings")
def argmax_landcover(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = views.labels_px(spark, sf_dir, 8)
    return classify.most_probable(df.drop("LANDCOVER"), {k + 1: f"f{k}" for k in range(8)}).select("id", "LANDCOVER")


@query("bands_pivot", f"SELECT px, {', '.join(sr(f'max(CASE WHEN y = {y} THEN v END)', f'y{y}') for y in range(1995, 2002))} FROM (SELECT px, year(ts) AS y, avg(nir) AS v FROM obs GROUP BY 1, 2) GROUP BY px", "obs")
def bands_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    yearly = temporal.mean_composite(views.obs(spark, sf_dir).withColumn("y", F.year("ts")), ["px", "y"], ["nir"])
    wide = classify.to_bands(yearly, ["px"], "y", list(range(1995, 2002)), "nir")
    return wide.select("px", *[r(str(y)).alias(f"y{y}") for y in range(1995, 2002)])


@query("confusion_matrix", f"SELECT label AS true, {', '.join(f'CAST(count(*) FILTER (WHERE pred = {k}) AS BIGINT) AS pred_{k}' for k in range(1, 9))} FROM labelled GROUP BY label", "labelled")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accuracy.confusion_matrix(views.labelled(spark, sf_dir), "label", "pred", list(range(1, 9)))


@query("confusion_normalized", f"SELECT label AS true, {', '.join(sr(f'count(*) FILTER (WHERE pred = {k}) / count(*)', f'pred_{k}') for k in range(1, 9))} FROM labelled GROUP BY label", "labelled")
def confusion_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = accuracy.confusion_matrix(views.labelled(spark, sf_dir), "label", "pred", list(range(1, 9)), normalised=True)
    return rounded(out, [f"pred_{k}" for k in range(1, 9)])


_S_CLASSES = ", c AS (SELECT k AS class, count(*) FILTER (WHERE label = k AND pred = k) AS tp, count(*) FILTER (WHERE label = k AND pred <> k) AS fn, count(*) FILTER (WHERE label <> k AND pred = k) AS fp, count(*) FILTER (WHERE label <> k AND pred <> k) AS tn FROM labelled, unnest(range(1, 9)) u(k) GROUP BY k)"


@query("accuracy_by_class", _S_CLASSES + f" SELECT CAST(class AS INTEGER) AS class, tp, fn, fp, tn, {sr('fn / (fn + tp)', 'omission')}, {sr('fp / (fp + tp)', 'commission')}, {sr('100 - fn / (fn + tp) * 100', 'producer_acc', 2)}, {sr('100 - fp / (fp + tp) * 100', 'user_acc', 2)} FROM c", "labelled")
def accuracy_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(accuracy.by_class(views.labelled(spark, sf_dir), "label", "pred"), ["omission", "commission"])


@query("accuracy_by_class_legacy", _S_CLASSES + f" SELECT CAST(class AS INTEGER) AS class, {sr('fn / (fn + tp)', 'omission')}, {sr('fp / (fn + tp)', 'commission')} FROM c", "labelled")
def accuracy_by_class_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = accuracy.by_class(views.labelled(spark, sf_dir), "label", "pred", legacy=True)
    return rounded(out, ["omission", "commission"]).select("class", "omission", "commission")


@query("accuracy_overall", _S_CLASSES + f", m AS (SELECT tp, tp + fn AS n, tp / (tp + fp) AS p, tp / (tp + fn) AS r FROM c) SELECT {sr('sum(tp) / sum(n)', 'accuracy', 3)}, {sr('sum(p * n) / sum(n)', 'precision', 3)}, {sr('sum(r * n) / sum(n)', 'recall', 3)}, {sr('sum(2 * p * r / (p + r) * n) / sum(n)', 'f1', 3)} FROM m", "labelled")
def accuracy_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accuracy.overall(views.labelled(spark, sf_dir), "label", "pred")


@query("class_names", "SELECT id, label, CASE label WHEN 1 THEN 'Bare' WHEN 2 THEN 'Built' WHEN 3 THEN 'Crop' WHEN 4 THEN 'Forest' WHEN 5 THEN 'Grass' WHEN 6 THEN 'Shrub' WHEN 7 THEN 'Water' WHEN 8 THEN 'Wetland' END AS name FROM labelled", "labelled")
def class_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..config import LEGEND

    return joins.class_names(views.labelled(spark, sf_dir), LEGEND, "label", "name").select("id", "label", "name")


@query(
    "area_estimate_ci",
    f", mapped AS (SELECT pred, count(*) * 100.0 AS area FROM labelled GROUP BY pred), s AS (SELECT label, pred, count(*) AS n FROM labelled GROUP BY 1, 2), j AS (SELECT s.label, s.n, sum(s.n) OVER (PARTITION BY s.pred) AS ni, m.area / (SELECT sum(area) FROM mapped) AS w FROM s JOIN mapped m ON m.pred = s.pred) SELECT label AS class, {sr('sum(w * n / ni) * (SELECT sum(area) FROM mapped)', 'area', 4)}, {sr('1.96 * sqrt(sum(w * w * (n / ni) * (1 - n / ni) / nullif(ni - 1, 0))) * (SELECT sum(area) FROM mapped)', 'half_width', 4)} FROM j GROUP BY label",
    "labelled",
)
def area_estimate_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = views.labelled(spark, sf_dir)
    mapped = every.groupBy(F.col("pred").alias("class")).agg((F.count(F.lit(1)) * 100.0).alias("area"))
    return rounded(accuracy.area_estimates(every, "label", "pred", mapped), ["area", "half_width"], 4)


# Random forests of the library's defaults, for all classes and features; no SQL gives their figures.
_FEATURES = [f"f{k}" for k in range(64)]


@query("rf_primitives", None)
def rf_primitives(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = views.labels_px(spark, sf_dir, len(_FEATURES))
    fits = classify.train_primitives(points, "LANDCOVER", _FEATURES)
    scored = classify.probabilities(points, fits)
    names = {p.value: f"Class{p.value}" for p in fits}
    return classify.most_probable(scored.select("id", *names.values()), names)


@query("rf_importance_top20", None)
def rf_importance_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = views.labels_px(spark, sf_dir, len(_FEATURES))
    tops = []
    for fit in classify.train_primitives(points, "LANDCOVER", _FEATURES):
        table = spark.createDataFrame(list(fit.importance_all.items()), "feature string, importance double")
        tops.append(classify.top_features(table, "feature", "importance").withColumn("class", F.lit(fit.value).cast("int")))
    return reduce(DataFrame.union, tops)


@query("rf_oob", None)
def rf_oob(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = views.labels_px(spark, sf_dir, len(_FEATURES))
    values = classify.labels_of(points, "LANDCOVER")
    with classify.prepared(points, "LANDCOVER", values, _FEATURES, ["id"]) as table:
        error = lambda v: (v, classify.out_of_bag(points, "LANDCOVER", v, _FEATURES, ["id"]))
        errors = classify.at_once(error, values, 1 if table is None else len(values))
    return spark.createDataFrame(errors, "class int, oob_error double")
