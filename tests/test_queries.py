"""Every query with an oracle gives the oracle's rows; the others give rows."""

import pytest

from tessera.plans import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_matches_oracle(name, spark, sf_dir, duck, same_rows):
    assert same_rows(registry.QUERIES[name](spark, sf_dir).toPandas(), duck.sql(registry.ORACLES[name]).df())


@pytest.mark.parametrize("name", ["distance_filter", "strat_sample_thinned"])
def test_gives_rows(name, spark, sf_dir):
    assert registry.QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_pushdown_and_pruning(spark, sf_dir):
    plan = registry.QUERIES["filter_date_halfopen"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "l_comment" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_composite_has_one_exchange(spark, sf_dir):
    plan = registry.QUERIES["composite_percentiles"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_near_points_are_never_broadcast(spark, sf_dir):
    """The points grow with the input, so the driver must not hold them, even where their file is small."""
    plan = registry.QUERIES["distance_pairs"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_forests_of_the_defaults(spark, sf_dir, monkeypatch):
    """The forest queries take the library's trees and depth, all features and all classes."""
    from tessera.operators import classify

    asked = []

    def primitives(points, label, features, values=None, **options):
        asked.append((label, len(features), options))
        return [classify.Primitive(v, None, features[:20], {f: float(k) for k, f in enumerate(features)}, {}) for v in values or classify.labels_of(points, label)]

    def error(points, label, value, features, id_cols, **options):
        asked.append((label, len(features), options))
        return 0.5

    monkeypatch.setattr(classify, "train_primitives", primitives)
    monkeypatch.setattr(classify, "out_of_bag", error)
    top = registry.QUERIES["rf_importance_top20"](spark, sf_dir).groupBy("class").count().collect()
    assert sorted((r["class"], r["count"]) for r in top) == [(v, 20) for v in range(1, 11)]
    assert [r["class"] for r in registry.QUERIES["rf_oob"](spark, sf_dir).orderBy("class").collect()] == list(range(1, 11))
    assert asked == [("LANDCOVER", 64, {})] * 11
    monkeypatch.setattr(classify, "probabilities", lambda points, fits: points.selectExpr("id", *[f"0.5 as Class{p.value}" for p in fits]))
    assert registry.QUERIES["rf_primitives"](spark, sf_dir).filter("LANDCOVER is null").count() == 0
    assert asked == [("LANDCOVER", 64, {})] * 12
