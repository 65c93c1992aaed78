"""Alignment, scoring, attribution and the stream."""

import json
import math

import numpy as np
import pytest

from riskloom.operators import explain, scoring as sc, training as tr
from riskloom.sources import sinks
from riskloom.streaming.scoring import open_stream, score_stream, write_stream

WEIGHTS = sc.LinearWeights({"A": 1.0, "B": -2.0}, 0.5)


def p(a, b):
    return 1 / (1 + math.exp(-(0.5 + a - 2 * b)))


def test_align_fills_missing_and_ignores_extra(spark):
    df = spark.createDataFrame([(10, 1.5, 99, 0)], "SK_ID_CURR long, A double, EXTRA int, TARGET int")
    out, found = sc.align_features(df, ["A", "B"], allow_target=True)
    assert out.columns == ["SK_ID_CURR", "A", "B"] and out.first().B == 0
    assert found.missing == ["B"] and found.extra == ["EXTRA"]
    with pytest.raises(ValueError, match="TARGET"):
        sc.align_features(df, ["A"])
    with pytest.raises(ValueError, match="missing"):
        sc.align_features(df.drop("TARGET"), ["A", "B"], strategy="error")
    with pytest.raises(ValueError, match="strategy"):
        sc.align_features(df.drop("TARGET"), ["A"], strategy="guess")
    with pytest.raises(ValueError, match="more than"):
        sc.align_features(df.drop("TARGET"), [f"F{i}" for i in range(21)])


def test_align_cleans_names_and_makes_keys(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "`A (x)` double")
    out, _ = sc.align_features(df, ["A_x"])
    assert [r.A_x for r in out.collect()] == [1.0, 2.0] and len({r.SK_ID_CURR for r in out.collect()}) == 2


def test_signature(spark):
    df = spark.createDataFrame([(10, 1, "2")], "SK_ID_CURR long, A int, B string")
    out, seen = sc.align_to_signature(df, {"SK_ID_CURR": "long", "A": "double", "B": "double", "C": "double"})
    assert dict(out.dtypes) == {"SK_ID_CURR": "bigint", "A": "double", "B": "double", "C": "double"}
    assert seen.filled_missing_preview == ["C"] and out.first().C == 0
    with pytest.raises(ValueError, match="no known"):
        sc.align_to_signature(df, {"SK_ID_CURR": "long", "Z": "double"})
    with pytest.raises(ValueError, match="B"):
        sc.align_to_signature(spark.createDataFrame([(1, "x")], "A int, B string"), {"A": "double", "B": "double"})


def test_request_scoring(spark):
    rows = spark.createDataFrame([(1001, 1.0, 2.0), (1002, 2.0, 0.5)], "SK_ID_CURR long, A double, B double")
    signature = {"A": "double", "B": "double"}
    scored, _ = sc.score_request(rows, sc.Scorer(WEIGHTS), signature, "m", "champion", threshold=p(2.0, 0.5))
    got = {r.SK_ID_CURR: r for r in scored.collect()}
    assert got[1001].TARGET_PROBABILITY == pytest.approx(p(1, 2)) and got[1001].TARGET_PREDICTION == 0
    assert got[1002].model_alias == "champion" and got[1002].TARGET_PREDICTION == 1  # the cut itself counts as positive
    with pytest.raises(ValueError, match="more than 1"):
        sc.score_request(rows, sc.Scorer(WEIGHTS), signature, "m", "c", most_rows=1)
    with pytest.raises(ValueError, match="no rows"):
        sc.score_request(rows.limit(0), sc.Scorer(WEIGHTS), signature, "m", "c")
    from riskloom.sources.tables import rows_from_json

    keyed, _ = sc.score_request(rows_from_json(spark, '[{"A": 1.0}, {"A": 2.0}]'), sc.Scorer(WEIGHTS), signature, "m", "c")
    assert sorted(r.SK_ID_CURR for r in keyed.collect()) == [0, 1]


def test_threshold_sources(spark, tmp_path):
    path = sinks.write_table(spark.createDataFrame([(0.42,)], "threshold double"), str(tmp_path / "t"))
    assert sc.resolve_threshold(spark, 0.9, artifact=path) == 0.9
    assert sc.resolve_threshold(spark, source="config", configured=0.3) == 0.3
    assert sc.resolve_threshold(spark, artifact=path) == 0.42
    with pytest.raises(ValueError):
        sc.resolve_threshold(spark, source="oracle")
    with pytest.raises(FileNotFoundError):
        sc.resolve_threshold(spark, artifact=str(tmp_path / "none"))


def test_saved_scorer_gives_the_same_scores(spark, tmp_path):
    df = spark.createDataFrame([(i, float(i), float(i % 3)) for i in range(20)], "SK_ID_CURR long, A double, B double")
    prep = tr.fit_preprocessing(df.selectExpr("*", "0 AS TARGET"), ["A", "B"], tr.TrainingOptions(selection=None))
    scorer = sc.Scorer(WEIGHTS, prep)
    scorer.save(spark, str(tmp_path / "s"))
    a, b = scorer.predict(df), sc.Scorer.load(spark, str(tmp_path / "s")).predict(df)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert sc.score_batch(df, scorer, 0.5)[0].columns == ["SK_ID_CURR", "TARGET_PROBABILITY", "TARGET_PREDICTION"]


def test_stream_equals_batch(spark, tmp_path):
    rows = [{"SK_ID_CURR": i, "A": i / 7, "B": i / 11} for i in range(50)]
    (tmp_path / "in").mkdir()
    for n in range(2):
        (tmp_path / "in" / f"{n}.json").write_text("\n".join(json.dumps(r) for r in rows[n::2]))
    stream = open_stream(spark, str(tmp_path / "in"), "SK_ID_CURR long, A double, B double", files_per_batch=1)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    write_stream(score_stream(stream, sc.Scorer(WEIGHTS)), out, state).awaitTermination()
    first = {tuple(r) for r in spark.read.parquet(out).collect()}
    batch, _ = sc.score_batch(spark.createDataFrame(rows).select("SK_ID_CURR", "A", "B"), sc.Scorer(WEIGHTS))
    assert first == {tuple(r) for r in batch.collect()} and len(first) == 50
    # a restart from the same state reads only the new file
    (tmp_path / "in" / "2.json").write_text(json.dumps({"SK_ID_CURR": 99, "A": 1.0, "B": 1.0}))
    write_stream(score_stream(stream, sc.Scorer(WEIGHTS)), out, state).awaitTermination()
    assert spark.read.parquet(out).count() == 51
    with pytest.raises(ValueError, match="key"):
        score_stream(stream.drop("SK_ID_CURR"), sc.Scorer(WEIGHTS))


def test_contributions_add_up(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, 2))
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, A double, B double")
    parts = explain.linear_contributions(df, WEIGHTS, "id").toPandas()
    margin = 0.5 + x[:, 0] - 2 * x[:, 1]
    assert np.allclose(parts.groupby("id").contribution.sum().values, margin - margin.mean())
    summary = explain.contribution_summary(explain.linear_contributions(df, WEIGHTS, "id")).toPandas().set_index("feature")
    part = (x[:, 1] - x[:, 1].mean()) * -2
    assert summary.loc["B", "std_shap"] == pytest.approx(part.std()) and summary.loc["B", "mean_abs_shap"] == pytest.approx(np.abs(part).mean())
    assert sorted(summary["rank"]) == [1, 2]


def test_plot_scale(spark):
    df = spark.createDataFrame([(float(i), 3.0) for i in range(101)], "x double, flat double")
    got = explain.plot_scale(df, ["x", "flat"]).toPandas()
    assert np.allclose(got.x, np.clip((np.arange(101) - 1) / 98, 0, 1)) and (got.flat == 0).all()


def test_text_with_decimals_becomes_a_whole_number(spark):
    df = spark.createDataFrame([("1.5", "7", 2.9)], "a string, b string, c double")
    row = sc.align_to_signature(df, {"a": "long", "b": "long", "c": "long"}, "k")[0].first()
    assert (row.a, row.b, row.c) == (1, 7, 2)
    with pytest.raises(ValueError):
        sc.align_to_signature(spark.createDataFrame([("x",)], "a string"), {"a": "long"}, "k")


def test_a_whole_table_as_one_request(spark):
    rows = spark.range(500).selectExpr("id AS SK_ID_CURR", "0.1D AS A")
    signature = {"SK_ID_CURR": "long", "A": "double", "B": "double"}
    scored, _ = sc.score_request(rows, sc.Scorer(WEIGHTS), signature, "m", "c", most_rows=None)
    assert scored.count() == 500 and "SinglePartition" not in scored._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        sc.score_request(rows, sc.Scorer(WEIGHTS), signature, "m", "c")
