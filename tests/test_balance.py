"""Neighbours and synthetic rows against brute force."""

import numpy as np
import pandas as pd
import pytest

from riskloom.operators import balance, neighbors


def brute(points, ids, q, k):
    away = np.sqrt(((points - points[list(ids).index(q)]) ** 2).sum(1))
    return [ids[i] for i in np.lexsort((ids, away)) if ids[i] != q][:k]


def test_neighbors_with_a_large_group_of_copies(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "BLOCK_ROWS", 60)  # several blocks per cell
    rng = np.random.default_rng(1)
    y = rng.normal(size=(400, 3))
    y[:150] = y[0]
    df = spark.createDataFrame(pd.DataFrame({"id": range(400), "v": list(y)}))
    got = neighbors.nearest(df, df, "id", "v", 4).toPandas()
    assert len(got) == 1600
    for q, g in got.groupby("query"):
        assert g.sort_values("rank").neighbor.tolist() == brute(y, np.arange(400), q, 4)


def test_neighbors_of_other_points(spark):
    rng = np.random.default_rng(2)
    y = rng.normal(size=(120, 8))
    df = spark.createDataFrame(pd.DataFrame({"id": range(120), "v": list(y)}))
    got = neighbors.nearest(df.where("id < 15"), df, "id", "v", 6).toPandas()
    for q, g in got.groupby("query"):
        assert g.sort_values("rank").neighbor.tolist() == brute(y, np.arange(120), q, 6)
        mine = np.sqrt(((y[g.neighbor] - y[q]) ** 2).sum(1))
        assert np.allclose(mine, g.distance)


@pytest.fixture(scope="module")
def classes(spark):
    rng = np.random.default_rng(3)
    y = np.array([1] * 20 + [0] * 130)
    return spark.createDataFrame(pd.DataFrame({"id": range(150), "y": y, "a": rng.normal(size=150) + y, "b": rng.normal(size=150) - y}))


def test_smote_rows_lie_between_two_rare_rows(spark, classes):
    out = balance.oversample(classes, "y", "id", ["a", "b"], "smote", seed=5)
    pdf = out.toPandas()
    assert pdf.groupby("y").size().to_dict() == {0: 130, 1: 130}
    again = balance.oversample(classes, "y", "id", ["a", "b"], "smote", seed=5).toPandas()
    key = ["id", "a", "b"]
    assert np.allclose(pdf.sort_values(key)[key], again.sort_values(key)[key])
    rare = classes.where("y = 1").toPandas().set_index("id")[["a", "b"]]
    made = pdf[pdf.is_synthetic]
    draws = made.groupby("id").size()
    assert draws.max() - draws.min() <= 1 and len(draws) == 20
    for _, m in made.iterrows():
        start = rare.loc[m.id].values
        near = [rare.loc[j].values for j in brute(rare.values, rare.index.values, m.id, 5)]
        step = np.array([m.a, m.b]) - start
        on = [abs(step[0] * (e - start)[1] - step[1] * (e - start)[0]) < 1e-9 and -1e-9 <= step @ (e - start) <= (e - start) @ (e - start) + 1e-9 for e in near]
        assert any(on)


def test_weights_and_undersampling(spark, classes):
    assert balance.class_weights({0: 130, 1: 20}) == {0: 1.0, 1: 6.5}
    assert balance.class_weights({0: 130, 1: 20}, "negative_over_positive")[1] == 6.5
    assert balance.class_weights({0: 130, 1: 20}, "fixed")[1] == 11.3
    assert {r["y"]: r["count"] for r in balance.undersample(classes, "y", "id", 1).groupBy("y").count().collect()} == {0: 20, 1: 20}
    with pytest.raises(ValueError):
        balance.class_weights({0: 1, 1: 1}, "cubic")
    with pytest.raises(ValueError):
        balance.resample(classes, "y", "id", ["a"], "magic")
    assert balance.resample(classes, "y", "id", ["a"], "class_weight") is classes


def test_heavy_draws_are_chunked(spark, classes):
    out = balance.oversample(classes.where("y = 0 OR id < 2"), "y", "id", ["a", "b"], "adasyn")
    assert out.where("is_synthetic").count() > 0


def test_nothing_to_start_from_is_an_error(spark):
    rows = lambda points: spark.createDataFrame([(i, y, float(a), 0.0) for i, (y, a) in enumerate(points)], "id long, y int, a double, b double")
    one = rows([(1, 0)] + [(0, i) for i in range(5)])
    with pytest.raises(ValueError, match="two rows"):
        balance.oversample(one, "y", "id", ["a", "b"], "smote")
    apart = rows([(1, i / 100) for i in range(12)] + [(0, 1000 + i) for i in range(30)])
    with pytest.raises(ValueError, match="border"):
        balance.oversample(apart, "y", "id", ["a", "b"], "borderline_smote", border_neighbors=5)
    with pytest.raises(ValueError, match="adasyn"):
        balance.oversample(apart, "y", "id", ["a", "b"], "adasyn")




def test_queries_do_not_grow_by_their_cells(spark, monkeypatch):
    """Without clusters all cells can hold a neighbour; a query must still be one row with a short list."""
    rng = np.random.default_rng(6)
    y = rng.normal(size=(1_500, 16))
    df = spark.createDataFrame(pd.DataFrame({"id": range(1_500), "v": list(y)}))
    tables, settle = {}, neighbors.settle
    monkeypatch.setattr(neighbors, "settle", lambda df, label: tables.setdefault(label, settle(df, label)))
    got = neighbors.nearest(df, df, "id", "v", 5, exact=True).toPandas()
    assert tables["candidates"].count() == 1_500
    for q, g in got[got["query"] % 50 == 0].groupby("query"):
        assert g.sort_values("rank").neighbor.tolist() == brute(y, np.arange(1_500), q, 5)


@pytest.mark.parametrize("kind", ["apart", "grid", "far"])
def test_closest_equals_brute_force(monkeypatch, kind):
    """The first points far off, many equal distances, and vectors far from the origin, in small steps."""
    monkeypatch.setattr(neighbors, "STEP", 3_000)
    rng = np.random.default_rng(7)
    y = {"apart": np.r_[rng.normal(size=(300, 4)) + 50, rng.normal(size=(300, 4))], "grid": rng.integers(0, 3, (600, 4)).astype(float), "far": 1e7 + rng.normal(size=(600, 4)) / 1e3}[kind]
    x = y[rng.permutation(600)[:90]]
    rows, at, away = neighbors._closest(x, y, 6)
    true = np.sqrt(((x[:, None] - y[None]) ** 2).sum(axis=2))
    order = np.argsort(true, axis=1, kind="stable")[:, :6]
    assert (rows == np.repeat(np.arange(90), 6)).all() and (at == order.ravel()).all()
    assert (away == np.take_along_axis(true, order, axis=1).ravel()).all()


def test_places_on_segments_are_worked_out_once(spark):
    """Rows on a way, off it and beyond its end; the place along a way must not be reckoned anew for every number of a vector."""
    from riskloom.catalog import modelling as mm

    rng = np.random.default_rng(9)
    at = rng.normal(size=(3, 64))
    rows = spark.createDataFrame([(i, at[i].tolist()) for i in range(3)], "vec_id long, embedding array<double>")
    near = spark.createDataFrame([(0, 1), (0, 2), (1, 0)], "query long, neighbor long")
    way = lambda a, b, u: at[a] + u * (at[b] - at[a])
    points = [(0, way(0, 1, 0.3)), (0, way(0, 2, 1.0)), (0, way(0, 1, 1.2)), (0, way(0, 1, 0.5) + 0.01), (1, way(1, 0, 0.0)), (1, way(1, 2, 0.5))]
    made = spark.createDataFrame([(i, True, *map(float, x)) for i, x in points], ["vec_id", "is_synthetic", *mm.FEATURES])
    found = mm._on_segments(made, rows, near)
    assert sorted(tuple(r) for r in found.collect()) == [(0, 4, 2), (1, 2, 1)]
    last = found._jdf.queryExecution().analyzed().aggregateExpressions().mkString()
    assert last.count("aggregate(") == 3
