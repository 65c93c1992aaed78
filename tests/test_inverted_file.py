import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import inverted_file as ivf
from riskloom.operators import neighbors


def frame(spark, values):
    return spark.createDataFrame(pd.DataFrame({"id": np.arange(len(values)), "v": list(values)})).repartition(4)


def true_neighbors(values, asked, k):
    out = set()
    for q in asked:
        away = ((values - values[q]) ** 2).sum(axis=1)
        away[q] = np.inf
        out |= {(int(q), int(i)) for i in np.argsort(away, kind="stable")[:k]}
    return out


def recall(spark, values, k=5):
    asked = np.arange(0, len(values), 20)
    df = frame(spark, values)
    rows = neighbors.nearest(df.where("id % 20 = 0"), df, "id", "v", k).collect()
    assert len(rows) == k * len(asked)
    for r in rows[:200]:
        assert r["distance"] == pytest.approx(np.linalg.norm(values[r["query"]] - values[r["neighbor"]]))
    return len({(r["query"], r["neighbor"]) for r in rows} & true_neighbors(values, asked, k)) / (k * len(asked))


def test_recall_of_vectors_without_clusters(spark):
    """Gaussian vectors in 64 dimensions, the hardest case: all distances are alike."""
    assert recall(spark, np.random.default_rng(3).normal(size=(6_000, 64))) >= 0.9


def test_clusters_need_few_cells(spark):
    rng = np.random.default_rng(4)
    values = (rng.normal(size=(50, 64)) * 3)[np.arange(6_000) % 50] + rng.normal(size=(6_000, 64))
    assert recall(spark, values) >= 0.9
    points = frame(spark, values).select(F.col("id").alias("vid"), F.col("v").alias("vec"))
    file = ivf.fit(points, 6_000)
    queries = points.where("vid % 20 = 0").withColumnRenamed("vid", "qid")
    true = spark.createDataFrame(sorted(true_neighbors(values, range(0, 6_000, 20), 5)), "qid long, vid long")
    probes = ivf.probes_for(file, queries, true, 0.95)
    assert file.share(values[::20], probes) < 0.1
    assert file.sizes.sum() == 6_000
    compared = ivf.candidates(file, queries, probes, 6).count()
    assert compared < 0.01 * 300 * 6_000


@pytest.mark.parametrize("seed", range(3))
def test_codes_lose_nothing_in_probed_cells(seed):
    rng = np.random.default_rng(seed)
    x, points = rng.normal(size=(40, 7)), rng.normal(size=(300, 7))
    x[:5] = points[:5]
    scale = np.abs(points).max(axis=1) / 127
    codes = np.rint(points / scale[:, None]) * scale[:, None]
    error = np.sqrt(((points - codes) ** 2).sum(axis=1))
    rows, at, low, high = ivf._bounds(x, codes, error, 6)
    kept = set(zip(rows.tolist(), at.tolist()))
    away = np.sqrt(((x[:, None] - points[None]) ** 2).sum(axis=2))
    for i in range(40):
        assert {(i, int(j)) for j in np.argsort(away[i])[:6]} <= kept
    assert (low <= away[rows, at]).all() and (away[rows, at] <= high).all()
    assert len(kept) < 40 * 20


def test_all_cells_give_the_exact_result(spark, monkeypatch):
    monkeypatch.setattr(ivf, "BLOCK_POINTS", 50)
    monkeypatch.setattr(ivf, "BLOCK_QUERIES", 7)
    monkeypatch.setattr(ivf, "GROUP_CELLS", 3)
    rng = np.random.default_rng(8)
    values = np.concatenate([rng.normal(size=(400, 5)), np.tile(rng.normal(size=(1, 5)), (300, 1))])
    df = frame(spark, values)
    monkeypatch.setattr(neighbors, "TARGET", 1.0)
    rows = lambda **o: {(r["query"], r["rank"], round(r["distance"], 9)) for r in neighbors.nearest(df, df, "id", "v", 4, **o).collect()}
    assert rows(few=10) == rows(exact=True)


def test_queries_that_find_too_little_are_answered_exactly(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(size=(300, 4)), [[100.0, 0, 0, 0], [-90.0, 5, 5, 5]]])
    df = frame(spark, values)
    got = neighbors.nearest(df.where("id >= 300"), df, "id", "v", 7, few=3).toPandas()
    assert len(got) == 14
    assert set(map(tuple, got[["query", "neighbor"]].to_numpy().tolist())) == true_neighbors(values, [300, 301], 7)
