import numpy as np
import pytest

from riskloom.operators import gram
from riskloom.operators.prune import correlated_columns, correlation_matrix


def wide(spark, rows, columns, seed=3):
    """Columns in groups of ten that share a signal, some with a large mean, the last one constant."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(rows, columns))
    x += 4 * np.repeat(rng.normal(size=(rows, -(-columns // 10))), 10, axis=1)[:, :columns]
    x[:, 1::7] += 1e7
    x[:, -1] = 0.1
    names = [f"c {i}" for i in range(columns)]
    df = spark.createDataFrame([(v.tolist(),) for v in x], "v array<double>").repartition(4)
    return df.selectExpr(*[f"v[{i}] AS `{n}`" for i, n in enumerate(names)]), names, x


@pytest.mark.parametrize("block, held", [(256, 64 << 20), (64, 200_000), (7, 1)])
def test_equals_the_whole_matrix(spark, block, held):
    df, names, _ = wide(spark, 300, 120)
    whole = correlation_matrix(df, names)
    got = {(r["first"], r["second"]): r["correlation"] for r in gram.strong_pairs(df, names, block=block, held=held).collect()}
    assert len(got) == 119 * 118 // 2
    for (a, b), value in got.items():
        i, j = names.index(a), names.index(b)
        assert i < j and value == pytest.approx(whole[i, j], abs=1e-6)


def test_four_hundred_columns_prune_as_before(spark):
    df, names, x = wide(spark, 200, 400)
    with np.errstate(invalid="ignore", divide="ignore"):
        strength = np.abs(np.corrcoef(x.T))
    before = [c for j, c in enumerate(names[:-1]) if j and (strength[:j, j] > 0.9).any()]
    assert before and correlated_columns(df, names, 0.9) == before


def test_bands_hold_what_is_allowed():
    tile = 256 * 256 * 8
    bands = gram._bands(20, tile, 64 << 20)
    assert [b[0] for b in bands[1:]] == [b[1] for b in bands[:-1]] and bands[0][0] == 0 and bands[-1][1] == 20
    assert all(sum(20 - i for i in range(a, b)) * tile <= 64 << 20 for a, b in bands)
    assert gram._bands(3, 10, 1) == [(0, 1), (1, 2), (2, 3)]


def test_nulls_constants_and_nothing(spark):
    df = spark.createDataFrame([(float(i), -2.0 * i, None if i == 3 else float(i), float("nan") if i == 4 else i * 1.0, 0.1, i) for i in range(50)],
                               "a double, b double, gap double, nan double, flat double, whole int")
    got = {(r["first"], r["second"]): round(r["correlation"], 9) for r in gram.strong_pairs(df, df.columns, 0.9).collect()}
    assert got == {("a", "b"): -1.0, ("a", "whole"): 1.0, ("b", "whole"): -1.0}
    assert correlated_columns(df, ["b", "a", "a"], 0.9) == ["a", "a"]
    assert gram.strong_pairs(df.limit(0), df.columns).collect() == []
    assert correlated_columns(df, ["a"], 0.9) == [] and correlated_columns(df, [], 0.9) == []
