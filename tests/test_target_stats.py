import hashlib
import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators.target_stats import fit_target_statistics
from riskloom.plans.training import raw_table_baseline

SCHEMA = "id long, y int, a string, b string, value long, code double"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2.0) for r in rows], SCHEMA).repartition(4)


def customers(n=600):
    r = random.Random(2)
    return [(i, int(r.random() < 0.3), "hot" if i % 3 else r.choice(("x", "y", None, "")), r.choice(("null", "v", None, f"rare{i}"))) for i in range(n)]


def plain(rows, column, prior=0.5, weight=1.0, seed=42):
    seen, out = {}, {}
    for row in sorted(rows, key=lambda r: (hashlib.md5(f"{seed}|{r[0]}".encode()).hexdigest(), r[0])):
        total, n = seen.get(row[column], (0, 0))
        out[row[0]] = (total + prior * weight) / (n + weight)
        seen[row[column]] = total + row[1], n + 1
    return out, {v: (t + prior * weight) / (n + weight) for v, (t, n) in seen.items()}


def test_equals_plain_version(spark):
    rows = customers()
    df = table(spark, rows)
    stats = fit_target_statistics(df, ["a", "b"], "y", "id", prior=0.3, weight=2.0)
    got = {r["id"]: r for r in stats.ordered(df).collect()}
    assert len(got) == len(rows) and got[5]["value"] == 1 and got[5]["code"] == 2.0
    (a, whole_a), (b, whole_b) = (plain(rows, k, 0.3, 2.0) for k in (2, 3))
    assert all(got[i]["a_CODE"] == pytest.approx(a[i]) and got[i]["b_CODE"] == pytest.approx(b[i]) for i in got)
    others = [(i + 10_000, None, v, w) for i, (v, w) in enumerate([("hot", "v"), (None, None), ("", "unseen"), ("null", "null")])]
    coded = {r["id"]: r for r in stats.apply(table(spark, others)).collect()}
    for i, _, v, w in others:
        assert coded[i]["a_CODE"] == pytest.approx(whole_a.get(v, 0.3)) and coded[i]["b_CODE"] == pytest.approx(whole_b.get(w, 0.3))


def test_no_row_sees_its_own_label(spark):
    rows = customers(200)
    flipped = [(i, 1 - y if i == 77 else y, a, b) for i, y, a, b in rows]
    one, two = ({r["id"]: (r["a_CODE"], r["b_CODE"]) for r in fit_target_statistics(df, ["a", "b"], "y", "id").ordered(df).collect()} for df in (table(spark, rows), table(spark, flipped)))
    assert one[77] == two[77] and one != two


def test_a_hot_category_is_split(spark):
    df = spark.range(40_000).select("id", (F.col("id") % 2).cast("int").alias("y"), F.lit("hot").alias("a"))
    stats = fit_target_statistics(df, ["a"], "y", "id")
    coded = stats.ordered(df)
    plan = coded._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("part" in line for line in windows)
    assert coded.where("a_CODE BETWEEN 0.4 AND 0.6").count() > 39_000
    assert stats.ordered(df.where("id < 0")).count() == 0
    with pytest.raises(ValueError):
        fit_target_statistics(df, ["a"], "y", "id", weight=0)


def test_baseline_does_not_learn_from_unique_categories(spark):
    """A category of its own for every row would give the label away, were it coded by the row itself."""
    df = spark.range(600).select("id", (F.xxhash64("id") % 2 == 0).cast("int").alias("y"), F.concat(F.lit("own"), "id").alias("a"), (F.xxhash64("id", F.lit(1)) % 100).alias("n"))
    found = raw_table_baseline(df, "id", "y", trees=3)
    assert 0.3 < found.metrics["roc_auc"] < 0.7
    assert found.scored.count() == 600 and found.metrics["categorical_feature_count"] == 1
    tested = raw_table_baseline(df, "id", "y", trees=2, test=df.drop("y").where("id < 9"))
    assert tested.scored.count() == 9
