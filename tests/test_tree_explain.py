from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.operators import tree_explain as tx
from riskloom.operators.explain import contribution_summary
from riskloom.operators.training import assemble

FEATURES = [f"f{i}" for i in range(8)]


def expected_value(tree, row, known, node=0):
    f = tree.feature[node]
    if f < 0:
        return tree.value[node]
    low, high = tree.left[node], tree.right[node]
    if f in known:
        return expected_value(tree, row, known, low if row[f] <= tree.threshold[node] else high)
    return (tree.cover[low] * expected_value(tree, row, known, low) + tree.cover[high] * expected_value(tree, row, known, high)) / tree.cover[node]


def by_subsets(ensemble, row):
    n = len(ensemble.features)
    value = {s: sum(expected_value(t, row, s) for t in ensemble.trees) for k in range(n + 1) for s in map(frozenset, combinations(range(n), k))}
    out = np.zeros(n)
    for i in range(n):
        for s in value:
            if i not in s:
                out[i] += factorial(len(s)) * factorial(n - len(s) - 1) / factorial(n) * (value[s | {i}] - value[s])
    return out, value[frozenset()]


@pytest.fixture(scope="module")
def rows(spark):
    columns = [((F.xxhash64("id", F.lit(i)) % 1000) / (1.0 if i < 6 else 300)).alias(f) for i, f in enumerate(FEATURES)]
    df = spark.range(1500).select("id", *columns)
    signal = F.expr("f0 + 0.8 * f1 * sign(f2) + IF(f3 > 200 AND f4 < 0, 300, 0)")
    return df.withColumn("y", (signal > 100).cast("double")).cache()


@pytest.mark.parametrize("family, params", [
    (GBTClassifier, {"maxIter": 6, "maxDepth": 5, "seed": 1}), (RandomForestClassifier, {"numTrees": 5, "maxDepth": 6, "seed": 1}),
    (DecisionTreeClassifier, {"maxDepth": 7})])
def test_equals_sum_over_subsets(spark, rows, family, params):
    prepared = assemble(rows, FEATURES, "y")
    model = family(featuresCol="__features", labelCol="y", **params).fit(prepared)
    trees = tx.from_spark(model, FEATURES)
    data = rows.orderBy("id").limit(400).toPandas()
    x = data[FEATURES].to_numpy()
    p = vector_to_array("probability")[1]
    told = np.array([r[0] for r in model.transform(prepared).orderBy("id").limit(400).select(p).collect()])
    expected = np.log(told / (1 - told)) / 2 if family is GBTClassifier else told
    assert np.allclose(trees.margin(x), expected, atol=1e-10)
    parts = trees.contributions(x)
    assert np.allclose(parts.sum(axis=1) + trees.base, trees.margin(x), atol=1e-12)
    for i in range(0, 400, 40):
        plain, base = by_subsets(trees, x[i])
        assert np.allclose(parts[i], plain, atol=1e-12) and base == pytest.approx(trees.base)


def test_missing_values_and_blocks(monkeypatch):
    tree = tx.Tree([0, 1, -1, -1, 0, -1, -1], [0.0, 5.0, 0, 0, 2.0, 0, 0], [1, 2, -1, -1, 5, -1, -1], [4, 3, -1, -1, 6, -1, -1],
                   [0, 0, 1.0, 2.0, 0, 3.0, 4.0], [10, 4, 1, 3, 6, 2, 4])
    ensemble = tx.TreeEnsemble(["a", "b", "c"], [tree, tx.Tree([-1], [0], [-1], [-1], [0.5], [3])])
    x = np.array([[-1, 4, 0], [-1, np.nan, 0], [np.nan, 0, 1], [1, 0, 0], [-np.inf, np.inf, 0], [2, 5, 5]])
    assert ensemble.margin(x).tolist() == [1.5, 2.5, 4.5, 3.5, 2.5, 3.5]
    whole = ensemble.contributions(x)
    for row, parts in zip(x, whole):
        assert np.allclose(parts, by_subsets(ensemble, row)[0])
    assert not whole[:, 2].any()
    monkeypatch.setattr(tx, "BLOCK", 1)
    assert np.allclose(ensemble.contributions(x), whole)
    unseen = tx.TreeEnsemble(["a"], [tx.Tree([0, -1, -1], [0] * 3, [1, -1, -1], [2, -1, -1], [0, 1, 2], [0, 0, 0])])
    assert unseen.base == 1.5 and unseen.contributions(np.array([[0.0], [1.0]])).tolist() == [[-0.5], [0.5]]


def test_long_table_and_summary(spark, rows, monkeypatch):
    monkeypatch.setattr(tx, "LONG_ROWS", 40)
    model = GBTClassifier(featuresCol="__features", labelCol="y", maxIter=3, maxDepth=4, seed=1).fit(assemble(rows, FEATURES, "y"))
    trees = tx.from_spark(model, FEATURES)
    some = rows.where("id < 100").withColumn("f5", F.when(F.col("id") % 3 > 0, F.col("f5")))
    got = tx.tree_contributions(some, trees, "id")
    assert got.columns == ["id", "feature", "value", "contribution"] and got.count() == 800
    x = some.orderBy("id").toPandas()[FEATURES].to_numpy(dtype=float)
    wide = got.groupBy("id").pivot("feature", FEATURES).agg(F.first("contribution")).orderBy("id").toPandas()[FEATURES].to_numpy()
    assert np.allclose(wide, trees.contributions(x))
    assert got.where("feature = 'f5' AND value IS NULL").count() == 34
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    summary = contribution_summary(got).toPandas().set_index("feature")
    assert np.allclose(summary.loc[FEATURES, "mean_abs_shap"], np.abs(wide).mean(axis=0))
    assert got.where("id < 0").count() == 0 and tx.tree_contributions(some.where("id < 0"), trees, "id").count() == 0


def test_covers_are_counted(spark, rows):
    model = GBTClassifier(featuresCol="__features", labelCol="y", maxIter=2, maxDepth=3, seed=1).fit(assemble(rows, FEATURES, "y"))
    trees = tx.from_spark(model, FEATURES)
    counted = tx.with_covers(rows, trees)
    assert [t.cover for t in counted.trees] == [t.cover for t in trees.trees]
