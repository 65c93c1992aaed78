"""The training job: search, out-of-fold validation, final fit and submission."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.errors import AnalysisException
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import as_column, numeric_columns, string_columns
from riskloom.functions.names import tidy_columns
from riskloom.operators.balance import class_weights, weight_column
from riskloom.operators.explain import contribution_summary, linear_contributions
from riskloom.operators.metrics import classification_report, evaluation_report, ranking_metrics
from riskloom.operators.quality import fingerprint
from riskloom.operators.ranking import class_counts
from riskloom.operators.scoring import FittedModel, LinearWeights, Scorer
from riskloom.operators.target_stats import SUFFIX, fit_target_statistics
from riskloom.operators.training import (
    FAMILIES, HOLDOUT, TrainingOptions, WEIGHT, feature_importances, fit_model, fit_preprocessing, mark_holdout,
    out_of_fold, positive_probability, search, stratified_sample,
)
from riskloom.operators.tree_explain import from_spark, tree_contributions
from riskloom.session import settle, spread
from riskloom.sources.sinks import read_document, write_document, write_reports, write_submission


@dataclass(frozen=True)
class TrainingRun:
    metadata: dict
    params: dict
    threshold: dict | None = None
    reports: dict[str, dict] = field(default_factory=dict)
    scorer: Scorer | None = None
    importance: DataFrame | None = None
    submission: DataFrame | None = None
    trials: DataFrame | None = None


def settings_hash(**settings) -> str:
    """One hash of everything that was chosen for a run."""
    return hashlib.sha256(json.dumps(settings, sort_keys=True, default=str).encode()).hexdigest()


def run_metadata(df: DataFrame, features: Sequence[str], label: str, **settings) -> dict:
    """Rows, features, positives, an order-free fingerprint of the training data and a hash of the settings."""
    facts = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(as_column(label).cast("long")).alias("positives")).first()
    content = fingerprint(df).first().asDict()
    return {
        "row_count": facts["rows"], "feature_count": len(features), "positive_count": facts["positives"],
        "data_hash": "-".join(str(content[k]) for k in ("rows", "content_xor", "content_sum")),
        "config_hash": settings_hash(features=list(features), label=label, **settings),
    }


def check_reuse(existing: Mapping | None, current: Mapping, allow_stale: bool = False) -> None:
    """Refuses to mix results of other data or other settings into a run."""
    if existing and not allow_stale:
        other = sorted({k for k in ("config_hash", "data_hash")} & {k for k in {**existing, **current} if existing.get(k) != current.get(k)})
        if other:
            raise ValueError(f"the folder holds a run with another {' and another '.join(other)}; take a new folder or allow it")


def stored_metadata(spark, folder: str) -> dict | None:
    """Metadata of the run in a folder, None where there is none."""
    try:
        return read_document(spark, f"{folder}/run")["metadata"]
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def run_training(train: DataFrame, test: DataFrame | None, family: str = "gbt", params: Mapping | None = None,
                 space: Mapping | None = None, options: TrainingOptions = TrainingOptions(),
                 phases: Sequence[str] = ("search", "validate", "final_fit"), folder: str | None = None, allow_stale: bool = False) -> TrainingRun:
    """The configured phases in order; the threshold comes from the last phase that evaluates.

    A folder that holds a run of other data or settings is refused unless ``allow_stale``.
    """
    spark = train.sparkSession
    train = tidy_columns(train)
    features = [c for c in train.columns if c not in (options.key, options.label)]
    metadata = run_metadata(train, features, options.label, family=family, params=dict(params or {}), space=space, options=asdict(options), phases=list(phases))
    if folder:
        check_reuse(stored_metadata(spark, folder), metadata, allow_stale)
    chosen, threshold, reports, trials = dict(params or {}), None, {}, None
    if "search" in phases and not space:
        raise ValueError("the search phase needs a search space; leave it out of the phases otherwise")
    if "search" in phases:
        chosen, trials, scored = search(train, features, family, chosen, space, options)
        reports["search_subsample_cv"] = evaluation_report(scored, options.label, "score", family, "search_subsample_cv")
        threshold = reports["search_subsample_cv"]["metrics"]["threshold"]
    if "validate" in phases:
        scored = out_of_fold(train, features, family, chosen, options)
        reports["out_of_fold"] = evaluation_report(scored, options.label, "score", family, "out_of_fold")
        threshold = reports["out_of_fold"]["metrics"]["threshold"]
    scorer = importance = submission = None
    if "final_fit" in phases:
        scorer, importance = final_fit(train, features, family, chosen, options)
        if test is not None:
            if options.label in test.columns:
                raise ValueError(f"{options.label} must not be part of the test rows")
            submission = scorer.predict(tidy_columns(test), options.label)
    run = TrainingRun(metadata, chosen, threshold, reports, scorer, importance, submission, trials)
    if folder:
        save_run(run, folder, spark, test, options)
    return run


def final_fit(train: DataFrame, features: Sequence[str], family: str, params: Mapping, options: TrainingOptions) -> tuple[Scorer, DataFrame]:
    from riskloom.operators.balance import resample

    prep = fit_preprocessing(train, features, options)
    prepared = prep.apply(train.select(as_column(options.key), as_column(options.label), *map(as_column, features)))
    prepared = resample(prepared, options.label, options.key, prep.output, options.balance, options.seed, **options.sampler_options)
    if "is_synthetic" in prepared.columns:
        prepared = settle(prepared.drop(options.key).withColumn(options.key, F.monotonically_increasing_id()), "resampled")
    model = fit_model(family, params, prepared, prep.output, options)
    importance = feature_importances(model, prep.output, train.sparkSession)
    return Scorer(FittedModel(model, prep.output), prep, options.key, options.label), importance


def explain_scorer(scorer: Scorer, df: DataFrame, rows: int | None = 5000, seed: int = 42, importance: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(contributions, summary) of a fitted scorer on ``df``, by a stratified sample of ``rows`` rows where it holds the label.

    Contributions are in long form. Those of trees add up to the margin less its expected value, those of a logistic
    model to the margin less its mean over the sample.
    """
    features = scorer.model.features
    model = getattr(scorer.model, "model", scorer.model)
    if rows is not None and scorer.target in df.columns:
        df = stratified_sample(df, scorer.target, scorer.key, rows=rows, seed=seed)
    ready = scorer.preprocessing.apply(df) if scorer.preprocessing else df
    prepared = settle(ready.select(as_column(scorer.key), *map(as_column, features)), "explained")
    if isinstance(model, LinearWeights):
        contributions = linear_contributions(prepared, model, scorer.key)
    elif hasattr(model, "coefficients"):
        weights = dict(zip(features, model.coefficients.toArray().tolist()))
        contributions = linear_contributions(prepared, LinearWeights(weights, float(model.intercept)), scorer.key)
    else:
        contributions = tree_contributions(prepared, from_spark(model, features), scorer.key)
    return contributions, contribution_summary(contributions, importance)


def save_run(run: TrainingRun, folder: str, spark, test: DataFrame | None, options: TrainingOptions) -> None:
    facts = {"metadata": run.metadata, "params": run.params, "threshold": run.threshold}
    facts["metrics"] = {scope: r["metrics"] for scope, r in run.reports.items()}
    write_document(spark, facts, f"{folder}/run")
    for scope, report in run.reports.items():
        write_reports({k: v for k, v in report.items() if k != "metrics"}, f"{folder}/reports/{scope}")
    if run.threshold:
        row = [(float(run.threshold["threshold"]), run.threshold["objective"], run.threshold["source"])]
        write_reports({"threshold": spark.createDataFrame(row, "threshold double, objective string, source string")}, folder)
    if run.scorer:
        run.scorer.save(spark, f"{folder}/scorer")
        write_reports({"feature_importance": run.importance}, folder)
    if run.submission is not None:
        named = run.submission.withColumnRenamed(options.label, "__p")
        write_submission(named, test, f"{folder}/submission", options.key, options.label, "__p")


@dataclass(frozen=True)
class Baseline:
    metrics: dict
    report: DataFrame
    scored: DataFrame
    trees: int


def raw_table_baseline(train: DataFrame, key: str, label: str, fraction: float = 0.2, seed: int = 42, threshold: float = 0.5,
                       missing_label: str = "Missing", trees: int = 20, test: DataFrame | None = None) -> Baseline:
    """A boosted model on the base table alone, checked on a stratified holdout, then refitted on all rows.

    The number of trees of the refit is the best one seen on the holdout.
    """
    train = spread(train, "raw-table")
    texts, numbers = string_columns(train, skip=[key, label]), numeric_columns(train, skip=[key, label])
    lows = train.agg(*[F.min(as_column(c)).cast("double").alias(f"v{i}") for i, c in enumerate(numbers)]).first() if numbers else ()
    # missing numbers become a value below all others, which a tree can split off
    below = {c: (v if v is not None else 0.0) - 1.0 for c, v in zip(numbers, lows)}

    def ready(df: DataFrame) -> DataFrame:
        keep = [as_column(c).cast("double").alias(c) if c == label else as_column(c) for c in (key, label) if c in df.columns]
        filled = [F.coalesce(as_column(c), F.lit(missing_label)).alias(c) for c in texts]
        return df.select(*keep, *[F.coalesce(as_column(c).cast("double"), F.lit(below[c])).alias(c) for c in numbers], *filled)

    rows = mark_holdout(ready(train), label, key, fraction, seed)
    weights = class_weights({int(k): v for k, v in class_counts(train, label).items()})
    rows = settle(rows.withColumn(WEIGHT, weight_column(label, weights)), "baseline")
    # texts are coded by the labels of the rows before, so that no list of categories is brought to the driver
    assembler = VectorAssembler(inputCols=[*numbers, *(c + SUFFIX for c in texts)], outputCol="features")

    def boosted(**extra):
        return FAMILIES["gbt"](labelCol=label, weightCol=WEIGHT, seed=seed, maxBins=100, **extra)

    def code(part: DataFrame, others: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
        """Rows to fit on, each without its own label, and others by all of them."""
        if not texts:
            return assembler.transform(part), None if others is None else assembler.transform(others)
        codes = fit_target_statistics(part, texts, label, key, seed=seed)
        return assembler.transform(codes.ordered(part)), None if others is None else assembler.transform(codes.apply(others))

    held = as_column(HOLDOUT)
    fitted, judged = (settle(df, "baseline-rows") for df in code(rows.where(~held), rows.where(held)))
    first = boosted(maxIter=trees, validationIndicatorCol=HOLDOUT).fit(fitted.unionByName(judged))
    valid = first.transform(judged).select(key, label, positive_probability().alias("score"))
    valid = settle(valid, "baseline-holdout")
    ranks = ranking_metrics(valid, label, "score").first()
    coded, target = code(rows, None if test is None else ready(test))
    coded = settle(coded, "baseline-rows")
    refit = boosted(maxIter=first.getNumTrees).fit(coded)
    scored = refit.transform(coded if test is None else target).select(key, positive_probability().alias("probability"))
    metrics = {
        "scope": "raw_table_holdout", "roc_auc": ranks["roc_auc"], "average_precision": ranks["average_precision"],
        "classification_threshold": threshold, "train_rows": rows.where(~as_column(HOLDOUT)).count(), "valid_rows": ranks["rows"],
        "feature_count": len(texts) + len(numbers), "categorical_feature_count": len(texts),
    }
    return Baseline(metrics, classification_report(valid, label, "score", threshold), scored, first.getNumTrees)
