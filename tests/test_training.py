"""Splits, preprocessing, search and the training job on a small table."""

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import training as tr
from riskloom.plans import training as job

OPTIONS = tr.TrainingOptions(folds=3, selector_trees=2, max_features=2, trials=1, search_rate=0.6, parallel=3)
PARAMS = {"maxIter": 2, "maxDepth": 2}


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    n = 240
    y = (rng.random(n) < 0.3).astype(int)
    return spark.createDataFrame(pd.DataFrame({
        "SK_ID_CURR": range(n), "TARGET": y, "good": y + rng.normal(scale=0.7, size=n), "noise": rng.normal(size=n), "flat": 1.0,
    }))


FEATURES = ["good", "noise", "flat"]


def test_folds_are_disjoint_and_stratified(data):
    folds = tr.assign_folds(data, "TARGET", "SK_ID_CURR", 5, 1).toPandas()
    assert len(folds) == 240 and set(folds.fold) == set(range(5))
    per = folds.groupby(["TARGET", "fold"]).size().unstack()
    assert (per.max(axis=1) - per.min(axis=1) <= 1).all()
    again = tr.assign_folds(data.repartition(5), "TARGET", "SK_ID_CURR", 5, 1).toPandas()
    assert folds.set_index("SK_ID_CURR").fold.sort_index().equals(again.set_index("SK_ID_CURR").fold.sort_index())


def test_sample_sizes(data):
    counts = {r[0]: r[1] for r in data.groupBy("TARGET").count().collect()}
    got = {r[0]: r[1] for r in tr.stratified_sample(data, "TARGET", "SK_ID_CURR", rate=0.15).groupBy("TARGET").count().collect()}
    total = sum(counts.values())
    assert sum(got.values()) == int(np.ceil(0.15 * total)) and all(abs(got[c] - 0.15 * n) < 1 for c, n in counts.items())
    assert tr.stratified_sample(data, "TARGET", "SK_ID_CURR", rows=10_000) is data
    with pytest.raises(ValueError):
        tr.stratified_sample(data, "TARGET", "SK_ID_CURR", rows=0)


def test_preprocessing_round_trip_and_missing_columns(data):
    prep = tr.fit_preprocessing(data, FEATURES, OPTIONS)
    assert len(prep.selected) == 2 and "good" in prep.selected
    back = tr.Preprocessing.from_json(prep.to_json())
    assert back == prep and back.apply(data).columns == ["SK_ID_CURR", "TARGET", *prep.selected]
    with pytest.raises(ValueError, match="missing"):
        prep.apply(data.drop("good"))
    with pytest.raises(ValueError):
        tr.fit_preprocessing(data, FEATURES, tr.TrainingOptions(selection="lasso"))


def test_feature_pruning(spark):
    scores = spark.createDataFrame([("a", 3.0), ("b", 0.5), ("c", 2.0)], "feature string, importance double")
    kept = lambda *a, **b: [r["feature"] for r in tr.prune_features(*a, **b).orderBy("place").collect()]
    assert kept(scores, minimum=1.0) == ["a", "c"]
    assert kept(scores, keep_top_n=1, always_keep=["b", "x"]) == ["b", "a"]
    assert kept(scores, minimum=9) == [] and kept(scores, minimum=9, always_keep=["c"]) == ["c"]


def test_candidates_stay_in_range():
    space = {"i": {"type": "int", "low": 4, "high": 10}, "f": {"type": "float", "low": 0.01, "high": 0.1, "log": True}, "c": {"type": "categorical", "choices": ["x", "y"]}}
    found = tr.sample_candidates(space, 20, 7)
    assert found == tr.sample_candidates(space, 20, 7)
    assert all(4 <= c["i"] <= 10 and 0.01 <= c["f"] <= 0.1 and c["c"] in "xy" for c in found)
    with pytest.raises(ValueError):
        tr.sample_candidates({"z": {"type": "grid"}}, 1)


def test_job_with_all_phases(spark, data, tmp_path):
    test = data.drop("TARGET").limit(50)
    run = job.run_training(data, test, "gbt", PARAMS, {"maxDepth": {"type": "int", "low": 1, "high": 2}}, OPTIONS, folder=str(tmp_path / "run"))
    assert run.threshold["source"] == "oof_max_f1" and set(run.reports) == {"search_subsample_cv", "out_of_fold"}
    assert run.metadata["row_count"] == 240 and run.trials.count() == 1
    assert run.reports["out_of_fold"]["metrics"]["ranking"]["roc_auc"] > 0.7
    saved = spark.read.parquet(str(tmp_path / "run" / "submission"))
    assert saved.columns == ["SK_ID_CURR", "TARGET"] and saved.count() == 50
    assert spark.read.parquet(str(tmp_path / "run" / "reports" / "out_of_fold" / "threshold_table")).count() == 99
    facts = json.loads(spark.read.text(str(tmp_path / "run" / "run")).first()[0])
    assert facts["metadata"]["data_hash"] == run.metadata["data_hash"]
    job.check_reuse(facts["metadata"], run.metadata)
    with pytest.raises(ValueError, match="data_hash"):
        job.check_reuse({**run.metadata, "data_hash": "other"}, run.metadata)


@pytest.mark.parametrize("balance", ["smote", "random_undersample"])
def test_resampled_fits(data, balance):
    options = tr.TrainingOptions(folds=2, selection=None, balance=balance, parallel=2, holdout_fraction=None)
    scored = tr.out_of_fold(data, FEATURES[:2], "logistic", {"maxIter": 5}, options)
    assert scored.count() == 240 and scored.select("SK_ID_CURR").distinct().count() == 240


def test_unknown_names(data):
    with pytest.raises(ValueError):
        tr.fit_model("svm", {}, data, FEATURES, OPTIONS)
    with pytest.raises(ValueError, match="must not"):
        job.run_training(data, data, "logistic", {"maxIter": 1}, None, tr.TrainingOptions(selection=None), ("final_fit",))


def test_baseline_on_the_raw_table(spark, data):
    df = data.selectExpr("SK_ID_CURR", "TARGET", "CASE WHEN noise > 0 THEN good END AS good", "CASE WHEN noise > 1 THEN 'a' WHEN noise > 0 THEN 'b' END AS word")
    found = job.raw_table_baseline(df, "SK_ID_CURR", "TARGET", trees=2)
    assert found.metrics["train_rows"] + found.metrics["valid_rows"] == 240 and found.metrics["categorical_feature_count"] == 1
    assert found.scored.count() == 240 and found.report.count() == 5


def test_champion(spark):
    runs = spark.createDataFrame([("a", 0.9, 1), ("b", 0.8, 2), ("c", 0.5, 3), ("d", None, 4)], "run string, roc_auc double, finished_at int")
    assert tr.champion(runs, 0.79).first().run == "b"
    assert tr.champion(runs, 0.95).count() == 0
    assert {r.run: r.registry_status for r in tr.gate_status(runs, 0.79).collect()} == {
        "a": "registered", "b": "registered", "c": "skipped_metric_gate", "d": "skipped_missing_roc_auc",
    }


def test_sizes_add_up_exactly():
    assert tr.allocate({0: 1364, 1: 136}, 225) == {0: 205, 1: 20} and sum(tr.allocate({0: 1364, 1: 136}, 500).values()) == 500
    for counts in ({0: 7, 1: 3, 2: 5}, {0: 1, 1: 999}, {0: 10}):
        for total in range(sum(counts.values()) + 1):
            sizes = tr.allocate(counts, total)
            assert sum(sizes.values()) == total and all(0 <= sizes[c] <= n for c, n in counts.items())
            assert all(abs(sizes[c] - total * n / sum(counts.values())) < 1 for c, n in counts.items())


def test_search_needs_a_space(spark, data):
    with pytest.raises(ValueError, match="space"):
        job.run_training(data, None, "gbt", PARAMS, None, OPTIONS, phases=("search",))


@pytest.mark.parametrize("family, params", [("gbt", {"maxIter": 3, "maxDepth": 3}), ("logistic", {"maxIter": 20})])
def test_scorers_are_explained(data, family, params):
    features = [c for c in data.columns if c not in ("SK_ID_CURR", "TARGET")]
    options = tr.TrainingOptions(selection=None, scaler="standard")
    scorer, importance = job.final_fit(data, features, family, params, options)
    told, summary = job.explain_scorer(scorer, data, rows=None, importance=importance)
    assert told.count() == data.count() * len(features)
    assert {r["feature"] for r in summary.collect()} == set(features) and summary.where("native_importance IS NULL").count() == 0
    p = F.col("TARGET_PROBABILITY")
    margins = scorer.predict(data).select("SK_ID_CURR", (F.log(p / (1 - p)) / (2 if family == "gbt" else 1)).alias("margin"))
    gaps = told.groupBy("SK_ID_CURR").agg(F.sum("contribution").alias("s")).join(margins, "SK_ID_CURR").select((F.col("margin") - F.col("s")).alias("base"))
    assert gaps.agg(F.max("base") - F.min("base")).first()[0] < 1e-6
    some, _ = job.explain_scorer(scorer, data, rows=40)
    assert some.select("SK_ID_CURR").distinct().count() == 40


def test_gate_names_its_metric(spark):
    runs = spark.createDataFrame([(1, None), (2, 0.1), (3, 0.9)], "run int, f1 double")
    assert [r["registry_status"] for r in tr.gate_status(runs, 0.5, "f1").orderBy("run").collect()] == ["skipped_missing_f1", "skipped_metric_gate", "registered"]


def test_rows_of_one_row_group_are_spread(spark, folder, monkeypatch):
    """A file with a single row group must not leave the training rows in one task."""
    from pyspark.sql import functions as F

    from riskloom import session
    from riskloom.catalog import modelling

    monkeypatch.setattr(session, "TASK_ROWS", 20)
    held = [r["n"] for r in modelling.training_table(spark, folder).groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(held) == 150 and max(held) <= 30 and len(held) >= 5
    few = spark.range(20)
    assert session.spread(few) is few


def test_search_prepares_each_fold_once(data, monkeypatch):
    """Candidates differ in the model's parameters only; scaling, balance and the rows of a fit are those of the fold."""
    options = tr.TrainingOptions(folds=2, selection=None, trials=3, search_rate=0.6, parallel=2)
    fitted, prepare = [], tr.fit_preprocessing
    monkeypatch.setattr(tr, "fit_preprocessing", lambda *a, **k: fitted.append(1) or prepare(*a, **k))
    space = {"regParam": {"type": "float", "low": 0.0, "high": 0.5}}
    best, trials, scored = tr.search(data, FEATURES, "logistic", {"maxIter": 5}, space, options)
    assert len(fitted) == 2 and trials.count() == 3 and scored.count() == 144
    # the shared folds give what a candidate gets from folds of its own
    sample = tr.stratified_sample(data, "TARGET", "SK_ID_CURR", rate=0.6, seed=options.seed)
    alone = tr.out_of_fold(sample, FEATURES, "logistic", best, options, False)
    both = scored.join(alone.select("SK_ID_CURR", F.col("score").alias("own")), "SK_ID_CURR")
    assert both.count() == 144 and both.where(F.abs(F.col("score") - F.col("own")) > 1e-9).count() == 0


def test_selector_rows_are_written_before_the_fit(data, monkeypatch):
    """A boosted selector reads its rows several times; scaling must not run again for each."""
    labels, settle = [], tr.settle
    monkeypatch.setattr(tr, "settle", lambda df, label="table": labels.append(label) or settle(df, label))
    tr.fit_preprocessing(data, FEATURES, OPTIONS)
    assert labels == ["selector-rows"]
