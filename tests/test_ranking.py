"""Global ranks, running totals, quantiles and pruning against brute force."""

import hashlib

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from riskloom.operators import metrics, prune, quantiles, ranking


@pytest.fixture(scope="module")
def scored():
    rng = np.random.default_rng(0)
    n = 3001
    df = pd.DataFrame({"id": range(n), "y": (rng.random(n) < 0.2).astype(int), "p": np.round(rng.random(n), 2)})
    df.loc[rng.random(n) < 0.35, "p"] = 0.5  # one score holds over a third of the rows
    return df


def test_shuffled_rank_and_take(spark, scored):
    df = spark.createDataFrame(scored)
    want = scored.assign(d=[hashlib.md5(f"7|{i}".encode()).hexdigest() for i in scored.id]).sort_values(["y", "d"])
    want["rank"] = want.groupby("y").cumcount() + 1
    got = ranking.shuffled_rank(df, "y", "id", 7).toPandas().set_index("id").draw_rank
    assert (want.set_index("id")["rank"].sort_index() == got.sort_index()).all()
    taken = {r.id for r in ranking.take_per_class(df, "y", "id", {0: 700, 1: 33}, 7).collect()}
    assert taken == set(want[((want.y == 0) & (want["rank"] <= 700)) | ((want.y == 1) & (want["rank"] <= 33))].id)
    marked = ranking.take_per_class(df, "y", "id", {0: 700, 1: 33}, 7, inside="m").toPandas()
    assert len(marked) == len(scored) and set(marked[marked.m].id) == taken


@pytest.mark.parametrize("range_rows", [10, 10_000])
def test_running_totals_over_ranges(spark, scored, range_rows):
    counts = metrics.stored_counts(spark.createDataFrame(scored), "y", "p")
    got = ranking.running_totals(counts, "score", {"tp": "pos", "seen": "n"}, range_rows).toPandas().sort_values("score", ascending=False)
    assert (got.tp == got.pos.cumsum()).all() and (got.seen == got.n.cumsum()).all() and len(got) == scored.p.nunique()


def test_metrics_with_ties(spark, scored):
    df = spark.createDataFrame(scored)
    pos, neg = scored[scored.y == 1].p.values, scored[scored.y == 0].p.values
    auc = (pos[:, None] > neg[None]).mean() + 0.5 * (pos[:, None] == neg[None]).mean()
    row = metrics.ranking_metrics(df, "y", "p").first()
    assert row.roc_auc == pytest.approx(auc) and row.brier_score == pytest.approx(((scored.p - scored.y) ** 2).mean())
    order = scored.groupby("p").y.agg(["sum", "size"]).sort_index(ascending=False)
    tp, seen = order["sum"].cumsum(), order["size"].cumsum()
    assert row.average_precision == pytest.approx((order["sum"] / scored.y.sum() * tp / seen).sum())


def test_threshold_table_is_strict(spark, scored):
    table = metrics.threshold_table(spark.createDataFrame(scored), "y", "p").toPandas()
    assert len(table) == 99
    for _, t in table.iterrows():
        hit = scored.p > t.threshold
        tp = (hit & (scored.y == 1)).sum()
        assert t.precision == pytest.approx(tp / hit.sum() if hit.sum() else 0)
        assert t.recall == pytest.approx(tp / scored.y.sum())
        assert t.accuracy == pytest.approx((hit == (scored.y == 1)).mean())


@pytest.mark.parametrize("rows", [3001, 13, 7])
def test_lift_cuts_through_ties(spark, scored, rows):
    part = scored.head(rows)
    got = metrics.lift_table(spark.createDataFrame(part), "y", "p").orderBy("decile").toPandas()
    ordered = part.sort_values(["p", "y"], ascending=[False, True]).reset_index(drop=True)
    groups = [g for g in np.array_split(np.arange(rows), 10) if len(g)]
    assert got.row_count.tolist() == [len(g) for g in groups]
    assert got.default_count.tolist() == [int(ordered.y.iloc[g].sum()) for g in groups]
    assert np.allclose(got.min_score, [ordered.p.iloc[g].min() for g in groups])


def test_empty_scores_and_unknown_names(spark, scored):
    empty = spark.createDataFrame(scored.head(0), "id long, y long, p double")
    assert metrics.threshold_table(empty, "y", "p").where("precision = 0 AND accuracy = 0").count() == 99
    df = spark.createDataFrame(scored)
    with pytest.raises(ValueError):
        metrics.single_metric(df, "y", "p", "gini")
    with pytest.raises(ValueError):
        metrics.evaluation_report(df, "y", "p", "m", "training")
    with pytest.raises(ValueError):
        metrics.choose_threshold(metrics.threshold_table(df, "y", "p"), "out_of_fold", objective="recall")
    fixed = metrics.choose_threshold(metrics.threshold_table(df, "y", "p"), "out_of_fold", tuned=False, configured=0.4).first()
    assert fixed.threshold == 0.4 and fixed.score is None and fixed.source == "config_classification_threshold"


POINTS = [0, 0.01, 0.25, 0.5, 0.99, 1]


def test_quantiles_close_in_on_large_inputs(spark):
    rng = np.random.default_rng(3)
    v = rng.lognormal(0, 3, 12_000)
    v[:5000] = 1.5  # a heavy repeated value
    df = spark.createDataFrame(pd.DataFrame({"v": v, "w": rng.normal(size=12_000)}))
    for limit in (10**9, 100):
        got = quantiles.exact_quantiles(df, ["v", "w"], POINTS, direct_rows=limit)
        for c, values in (("v", v), ("w", df.toPandas().w)):
            assert np.allclose(got[c], np.quantile(values, POINTS), rtol=1e-12)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.integers(-3, 3).map(float), st.floats(-1e6, 1e6)), min_size=1, max_size=60))
def test_both_quantile_ways_agree(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    direct = quantiles.exact_quantiles(df, ["v"], [0.5, 0.9])["v"]
    narrowed = quantiles.exact_quantiles(df, ["v"], [0.5, 0.9], direct_rows=3)["v"]
    assert np.allclose(direct, narrowed) and np.allclose(direct, np.quantile(values, [0.5, 0.9]))


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert quantiles.exact_quantiles(df, ["a", "b"], [0.5]) == {"a": [None], "b": [1.0]}


def test_pruning_follows_column_order(spark):
    rng = np.random.default_rng(5)
    a, c = rng.normal(size=500), rng.normal(size=500)
    pdf = pd.DataFrame({"a": a, "b": 2 * a + 1, "c": c, "d": -a, "flat": 1.0, "rare": (np.arange(500) == 3) * 1.0})
    df = spark.createDataFrame(pdf)
    assert prune.correlated_columns(df, ["a", "b", "c", "d", "flat"], 0.99) == ["b", "d"]
    assert prune.correlated_columns(df, ["d", "c", "a"], 0.99) == ["a"]
    assert prune.near_constant_columns(df, list(pdf.columns), 0.995) == ["flat", "rare"]
    assert prune.near_constant_columns(df, list(pdf.columns), 0.5) == ["flat", "rare"]


def test_null_is_a_value_for_near_constant(spark):
    df = spark.createDataFrame([(None, "x")] * 299 + [(1.0, "y")], "a double, s string")
    assert prune.near_constant_columns(df, ["a", "s"], 0.995) == ["a", "s"]
    assert prune.near_constant_columns(df, ["a", "s"], 0.998) == []


def test_quantiles_ask_for_one_sketch_per_column(spark, monkeypatch):
    """Neighbouring ranks and the points of a column share their sketch; the numbers stay exact."""
    values = np.random.default_rng(8).normal(size=400)
    df = spark.createDataFrame([(float(v), float(v) * 2) for v in values], "v double, w double")
    asked, sketch = [], quantiles.F.percentile_approx
    monkeypatch.setattr(quantiles.F, "percentile_approx", lambda *a: asked.append(a) or sketch(*a))
    got = quantiles.exact_quantiles(df, ["v", "w"], [0.25, 0.5, 0.75], direct_rows=50)
    assert len(asked) == 2
    for c, factor in (("v", 1), ("w", 2)):
        assert np.allclose(got[c], factor * np.quantile(values, [0.25, 0.5, 0.75]), rtol=1e-12)


def test_values_are_tallied_at_edges_in_few_counts(spark):
    """Edges of several columns, equal and not a number among them: four counts for each pair, from a row per edge and gap."""
    nan, inf = float("nan"), float("inf")
    columns = [[1.0, 1.0, 2.0, 3.0, None, nan, nan, inf], [-inf, -0.0, 0.0, 0.5, 7.0, 7.0, 8.0, None]]
    edges = [[3.0, 1.0, nan, nan], [0.0, 7.0]]
    held = spark.createDataFrame(list(zip(*columns)), "h0 double, h1 double")
    place = lambda v: (1, 0.0) if v != v else (0, v)
    for tally, values, own in zip(quantiles._tallies(held, edges), columns, edges):
        at = sorted(place(v) for v in values if v is not None)
        for low in own:
            for high in own:
                a, b = place(low), place(high)
                if a <= b:
                    on_high = at.count(b) if b > a else 0
                    assert tally(low, high) == (sum(v < a for v in at), at.count(a), sum(a < v < b for v in at), on_high)
