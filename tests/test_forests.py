"""Forests whose trees are grown whole by tasks, held against MLlib and against their definitions."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tessera.operators import classify, forests

NAMES = ["a", "b", "c", "d", "e"]


def data(n=1500, seed=3):
    """Rows of five features, one of few values and one with a heavy value, and three noisy classes."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 5))
    x[:, 2] = rng.integers(0, 6, n)
    x[rng.random(n) < 0.3, 3] = 0.0
    y = 1 + (x[:, 0] + 0.3 * rng.normal(size=n) > 0.2) + ((x[:, 1] > 0.5) & (x[:, 2] > 2))
    return x, y.astype(int)


@pytest.fixture(scope="module")
def points(spark):
    x, y = data()
    rows = [(i, int(v), *map(float, r)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, LANDCOVER int, a double, b double, c double, d double, e double")


def mllib(points, value, **settings):
    rows = VectorAssembler(inputCols=NAMES, outputCol="features").transform(classify.one_vs_rest(points, "LANDCOVER", value))
    model = RandomForestClassifier(featuresCol="features", labelCol="PRIM", minInstancesPerNode=1, **settings).fit(rows.coalesce(1))
    scored = model.transform(rows).select("id", vector_to_array("probability")[1].alias("p"))
    return model, np.array([r.p for r in scored.orderBy("id").collect()])


def cuts_one_by_one(values, counts):
    """MLlib's rule: a cut before the value that takes the running count farther from the next equal share."""
    if len(values) <= forests.BINS:
        return (values[:-1] + values[1:]) / 2
    out, now, target = [], counts[0], counts.sum() / forests.BINS
    for k in range(1, len(values)):
        before, now = now, now + counts[k]
        if abs(before - target) < abs(now - target):
            out.append((values[k - 1] + values[k]) / 2)
            target += counts.sum() / forests.BINS
    return np.array(out)


def test_thresholds():
    rng = np.random.default_rng(1)
    for values in (np.arange(32.0), np.arange(33.0), np.array([5.0]), np.sort(rng.normal(size=4000))):
        for counts in (np.ones(len(values), int), rng.integers(1, 50, len(values)), np.where(np.arange(len(values)) == len(values) // 2, 3000, 1)):
            got = forests.thresholds(values, counts)
            assert len(got) < forests.BINS and np.allclose(got, cuts_one_by_one(values, counts))
    assert forests.binned(np.array([[0.5], [0.6], [np.nan], [-9.0]]), [np.array([0.5, 0.7])]).ravel().tolist() == [0, 1, 2, 0]


@pytest.mark.parametrize("depth", [1, 3, 5])
def test_tree_equals_mllib(points, depth, monkeypatch):
    """Without bags and draws of features a tree is MLlib's: thresholds, nodes, merged leaves, probabilities, importances."""
    x, y = data()
    bins = forests.binned(x, [forests.thresholds(*np.unique(x[:, k], return_counts=True)) for k in range(5)])
    for value in (1, 2, 3):
        model, want = mllib(points, value, numTrees=1, maxDepth=depth, featureSubsetStrategy="all", bootstrap=False, subsamplingRate=1.0)
        *tree, gains = forests.grow(bins, y == value, np.ones(len(y), int), 5, depth, np.random.default_rng(0))
        got = np.zeros(len(y))
        forests.vote(tree, bins, got)
        assert len(tree[0]) == model.totalNumNodes and (tree[0] == forests.LEAF).sum() == (len(tree[0]) + 1) // 2
        assert np.allclose(got, want) and np.allclose(gains, model.featureImportances.toArray())
        monkeypatch.setattr(forests, "NODES", 2)  # the open nodes in parts
        *parts, _ = forests.grow(bins, y == value, np.ones(len(y), int), 5, depth, np.random.default_rng(0))
        assert all((a == b).all() for a, b in zip(tree, parts))
        monkeypatch.undo()


def test_grown_whole():
    """Every row in a leaf of its own label where depth and features allow it; nothing to split is a single leaf."""
    x, y = data()
    bins = forests.binned(x, [forests.thresholds(*np.unique(x[:, k], return_counts=True)) for k in range(5)])
    _, one = np.unique(bins, axis=0, return_index=True)
    *tree, _ = forests.grow(bins[one], y[one] == 2, np.ones(len(one), int), 2, 60, np.random.default_rng(5))
    got = np.zeros(len(one))
    forests.vote(tree, bins[one], got)
    assert ((got >= 0.5) == (y[one] == 2)).mean() > 0.99
    for mine, weights, p in ((y == 9, np.ones(len(y), int), 0.0), (y > 0, np.ones(len(y), int), 1.0), (y == 1, np.zeros(len(y), int), 0.0)):
        *tree, gains = forests.grow(bins, mine, weights, 2, 30, np.random.default_rng(5))
        got = np.zeros(len(y))
        forests.vote(tree, bins, got)
        assert len(tree[0]) == 1 and (got == p).all() and gains.sum() == 0


def test_no_fit_level_by_level(points, monkeypatch):
    """Above LITTLE work no forest is MLlib's: its time and driver grow with all nodes of all trees."""

    def never(self, df):
        raise AssertionError("fitted level by level")

    monkeypatch.setattr(classify.RandomForestClassifier, "fit", never)
    fits = classify.train_primitives(points, "LANDCOVER", NAMES, trees=10)
    assert [f.value for f in fits] == [1, 2, 3] and all(len(f.model.trees) == 10 and f.features == NAMES for f in fits)
    assert all(sum(f.importance_all.values()) == pytest.approx(1) == sum(f.importance_top.values()) for f in fits)
    with pytest.raises(Exception, match="null or NaN"):
        classify.train_primitives(points.withColumn("c", F.when(F.col("id") != 77, F.col("c"))), "LANDCOVER", NAMES, [1], trees=10)


def test_importances_near_mllib(points):
    """All features, bags and draws as in the queries: other draws, the same figures."""
    fits = classify.train_primitives(points, "LANDCOVER", NAMES, trees=300, depth=8)
    for fit in fits:
        model, _ = mllib(points, fit.value, numTrees=300, maxDepth=8, featureSubsetStrategy="sqrt", subsamplingRate=classify.BAG, seed=1)
        assert np.allclose(list(fit.importance_all.values()), model.featureImportances.toArray(), atol=0.06)  # about 0.012 each by chance
        nodes = sum(len(t[0]) for t in fit.model.trees)
        assert nodes == pytest.approx(model.totalNumNodes, rel=0.05)


def test_probabilities_of_whole_trees(spark, points):
    """Scores are the trees' votes, whatever the partitions; other columns stay; a null feature is scored; one Python pass."""
    x, y = data()
    one, two = (classify.train_primitives(df, "LANDCOVER", NAMES, trees=9) for df in (points, points.repartition(7, "a")))
    scored = classify.probabilities(points.withColumn("kept", F.lit("k")), one)
    assert scored.columns == [*points.columns, "kept", "Class1", "Class2", "Class3"]
    assert scored._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    rows, again = scored.orderBy("id").collect(), classify.probabilities(points.repartition(5), two).orderBy("id").collect()
    for fit, value in zip(one, (1, 2, 3)):
        votes = np.zeros(len(y))
        for tree in fit.model.trees:
            forests.vote(tree, forests.binned(x[:, [NAMES.index(f) for f in fit.features]], fit.model.cuts), votes)
        got = np.array([r[f"Class{value}"] for r in rows])
        assert np.array_equal(got, votes / 9) and np.array_equal(got, [r[f"Class{value}"] for r in again])
        assert ((got >= 0.5) == (y == value)).mean() > 0.95
    gaps = classify.probabilities(points.limit(20).withColumn("a", F.when(F.col("id") != 3, F.col("a"))), one)
    assert gaps.filter("Class1 between 0 and 1").count() == 20 and classify.probabilities(points.limit(0), one).count() == 0
    assert classify.most_probable(scored, {v: f"Class{v}" for v in (1, 2, 3)}, "guess").filter("guess = LANDCOVER").count() > 1400


def test_out_of_bag_by_definition(points, monkeypatch):
    """Each fold is voted on by three sub-forests that never saw it; no fit is MLlib's; classes share one table of bins."""
    x, y = data()

    def never(self, df):
        raise AssertionError("fitted level by level")

    monkeypatch.setattr(classify.RandomForestClassifier, "fit", never)
    made, table = [], forests.table
    monkeypatch.setattr(forests, "table", lambda *a: made.append(table(*a)) or made[-1])
    assert classify.whole(points.limit(400), NAMES, classify.TREES)  # the queries' smallest tables too
    with classify.prepared(points, "LANDCOVER", [1, 2, 3], NAMES, ["id"]):
        got = [classify.out_of_bag(points, "LANDCOVER", v, NAMES, ["id"], trees=30, depth=6) for v in (1, 2, 3)]
        bins, codes, folds = made[0].shared.value
    assert len(made) == 1 and not classify._PREPARED
    assert classify.out_of_bag(points.repartition(3), "LANDCOVER", 2, NAMES, ["id"], trees=30, depth=6) == got[1] and len(made) == 2
    want = {r.id: r.fold for r in points.select("id", classify.fold(["id"]).alias("fold")).collect()}
    assert sorted(folds) == sorted(want.values()) and np.bincount(folds).min() > 100
    p, n = np.zeros(len(bins)), np.zeros(len(bins))
    for b in range(10):
        held = np.isin(folds, [b, (b + 1) % 10, (b + 2) % 10])
        votes = np.zeros(held.sum())
        for t in range(3):
            bag = forests.generator(classify.SEED + b, 1, t)
            weights = bag.poisson(1.0, len(bins)) * ~held
            *tree, _ = forests.grow(bins, codes == 0, weights, 3, 6, bag)
            forests.vote(tree, bins[held], votes)
        p[held] += votes / 3
        n[held] += 1
    assert (n == 3).all() and got[0] == pytest.approx(((p / 3 >= 0.5) != (codes == 0)).mean())


def test_out_of_bag_near_mllib(points, monkeypatch):
    """The error of whole trees is the one of MLlib's fits."""
    got = classify.out_of_bag(points, "LANDCOVER", 2, NAMES, ["id"], depth=6)
    monkeypatch.setattr(classify, "LITTLE", 150_000)
    assert got == pytest.approx(classify.out_of_bag(points, "LANDCOVER", 2, NAMES, ["id"], depth=6), abs=0.02) and 0.05 < got < 0.3
