"""Splits, fitted preprocessing, model fits, cross-validation and search."""

from __future__ import annotations

import json
import math
import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import as_column
from riskloom.functions.text import name
from riskloom.operators.balance import class_weights, resample, weight_column
from riskloom.operators.metrics import single_metric
from riskloom.operators.ranking import class_counts, shuffled_rank, take_per_class
from riskloom.operators.scale import Scaling, fit_scaling
from riskloom.session import settle, shared_folder

VECTOR, WEIGHT, HOLDOUT, FOLD = "__features", "__weight", "__holdout", "fold"
FAMILIES = {"gbt": GBTClassifier, "random_forest": RandomForestClassifier, "logistic": LogisticRegression}


# --- splits -----------------------------------------------------------------------------------------------------


def allocate(counts: Mapping, total: int) -> dict:
    """``total`` rows shared out to the classes by their sizes, with the largest remainders rounded up."""
    rows = sum(counts.values())
    exact = {c: total * n / rows for c, n in counts.items()} if rows else {c: 0.0 for c in counts}
    sizes = {c: math.floor(x + 1e-9) for c, x in exact.items()}
    for c in sorted(counts, key=lambda c: (sizes[c] - exact[c], -counts[c], str(c)))[:total - sum(sizes.values())]:
        sizes[c] += 1
    return sizes


def stratified_sample(df: DataFrame, label: str, key: str, rate: float | None = None, rows: int | None = None, seed: int = 42) -> DataFrame:
    """A share of all rows (rounded up), or ``rows`` rows, with the class shares kept."""
    counts = class_counts(df, label)
    total = sum(counts.values())
    if rate is not None:
        rows = math.ceil(rate * total - 1e-9)
    elif rows is None or rows <= 0:
        raise ValueError("give a positive sample size or a rate")
    if rows >= total:
        return df
    return take_per_class(df, label, key, allocate(counts, rows), seed)


def mark_holdout(df: DataFrame, label: str, key: str, fraction: float, seed: int = 42, mark: str = HOLDOUT) -> DataFrame:
    """The same stratified draw as a boolean column."""
    counts = class_counts(df, label)
    return take_per_class(df, label, key, allocate(counts, math.ceil(fraction * sum(counts.values()) - 1e-9)), seed, inside=mark)


def assign_folds(df: DataFrame, label: str, key: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """Every row in exactly one fold; class counts differ by at most one between folds."""
    ranked = shuffled_rank(df, label, key, seed)
    return ranked.withColumn(FOLD, F.pmod(F.col("draw_rank") - 1, F.lit(folds)).cast("int")).drop("draw_rank")


# --- preprocessing ----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Preprocessing:
    """Scaling, then selected columns, then pruned columns. Plain data, stored as JSON."""

    features: list[str]
    scaling: Scaling
    selected: list[str] | None = None
    pruned: list[str] | None = None

    @property
    def output(self) -> list[str]:
        return self.pruned or self.selected or self.features

    def apply(self, df: DataFrame) -> DataFrame:
        missing = [c for c in self.output if c not in df.columns]
        if missing:
            raise ValueError(f"columns needed by the fitted preprocessing are missing: {missing[:10]}")
        inputs, kept = set(self.features), set(self.output)
        narrow = df.selectExpr(*[name(c) for c in df.columns if c not in inputs], *map(name, self.output))
        scaling = Scaling(
            self.scaling.kind, {c: v for c, v in self.scaling.centre.items() if c in kept},
            {c: v for c, v in self.scaling.width.items() if c in kept},
        )
        return scaling.apply(narrow)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> "Preprocessing":
        raw = json.loads(text)
        return Preprocessing(raw["features"], Scaling(**raw["scaling"]), raw["selected"], raw["pruned"])


@dataclass(frozen=True)
class TrainingOptions:
    label: str = "TARGET"
    key: str = "SK_ID_CURR"
    scaler: str | None = "robust"
    selection: str | None = "gbt"
    max_features: int = 150
    selector_trees: int = 20
    select_in_search: bool = False
    pruning: bool = False
    min_importance: float = 0.0
    keep_top_n: int | None = None
    always_keep: tuple[str, ...] = ()
    balance: str | None = "class_weight"
    weighting: str = "balanced"
    sampler_options: dict = field(default_factory=dict)
    folds: int = 5
    seed: int = 42
    metric: str = "roc_auc"
    threshold: float = 0.5
    holdout_fraction: float | None = 0.1
    search_rate: float = 0.15
    trials: int = 5
    parallel: int = 2


def rank_features(importance: DataFrame, top: int | None = None, minimum: float = -math.inf) -> DataFrame:
    """(feature, importance, rank) by importance, then name; one row per feature."""
    order = Window.orderBy(F.desc("importance"), "feature")
    ranked = importance.where(F.col("importance") >= F.lit(minimum)).withColumn("rank", F.row_number().over(order))
    return ranked if top is None else ranked.where(F.col("rank") <= top)


def prune_features(importance: DataFrame, minimum: float = 0.0, keep_top_n: int | None = None, always_keep: Sequence[str] = ()) -> DataFrame:
    """(feature, place): the reserved features in the given order, then the best others.

    ``importance`` holds (feature, importance), one row per feature. A feature stays for its importance if that reaches
    the minimum and is among the ``keep_top_n`` highest; ties go by name.
    """
    reserved = F.array(*map(F.lit, always_keep)).cast("array<string>")
    best = rank_features(importance, keep_top_n, minimum).select("feature", F.lit(True).alias("good"))
    own = importance.join(best, "feature", "left").withColumn("own", F.array_position(reserved, F.col("feature")))
    kept = own.where((F.col("own") > 0) | F.col("good"))
    place = F.row_number().over(Window.orderBy(F.col("own") == 0, "own", F.desc("importance"), "feature"))  # one row per feature
    return kept.select("feature", place.cast("long").alias("place"))


def fit_preprocessing(train: DataFrame, features: Sequence[str], options: TrainingOptions, select: bool = True) -> Preprocessing:
    """Fitted on the given rows only, so inside cross-validation once per fold."""
    features = list(features)
    scaling = fit_scaling(train, features, options.scaler)
    selected = scores = None
    if options.selection not in (None, "none", "gbt"):
        raise ValueError(f"unknown feature selection {options.selection!r}")
    if select and options.selection == "gbt":
        scaled = scaling.apply(train.select(as_column(options.key), as_column(options.label), *map(as_column, features)))
        rows = settle(assemble(scaled, features, options.label), "selector-rows")  # a fit reads its rows several times before it keeps them
        model = FAMILIES["gbt"](
            featuresCol=VECTOR, labelCol=options.label, maxIter=options.selector_trees, maxDepth=5, seed=options.seed
        ).fit(rows)
        scores = dict(zip(features, model.featureImportances.toArray().tolist()))
        # the highest scores win; ties keep the earlier column
        best = sorted(range(len(features)), key=lambda i: (-scores[features[i]], i))[:options.max_features]
        selected = [features[i] for i in sorted(best)]
    pruned = None
    if options.pruning:
        rows = [(c, 1.0 if scores is None else float(scores[c])) for c in selected or features]
        found = prune_features(
            train.sparkSession.createDataFrame(rows, "feature string, importance double"), options.min_importance, options.keep_top_n, options.always_keep)
        pruned = [r["feature"] for r in found.orderBy("place").collect()]
        if not pruned:
            raise ValueError("feature pruning left no columns; relax its limits")
    return Preprocessing(features, scaling, selected, pruned)


def assemble(df: DataFrame, features: Sequence[str], label: str | None = None) -> DataFrame:
    """Feature columns as one dense vector; the label as a double."""
    values = ", ".join(f"CAST({name(c)} AS DOUBLE)" for c in features)
    vector = array_to_vector(F.expr(f"array({values})")).alias(VECTOR)
    inside = set(features)
    rest = [as_column(c).cast("double").alias(c) if c == label else as_column(c) for c in df.columns if c not in inside]
    return df.select(*rest, vector)


# --- models -----------------------------------------------------------------------------------------------------


def positive_probability(vector: str = "probability") -> Column:
    return vector_to_array(F.col(vector))[1]


def fit_model(family: str, params: Mapping, prepared: DataFrame, features: Sequence[str], options: TrainingOptions):
    """Fit one model family on preprocessed rows, with class weights and, for boosting, early stopping."""
    rows, columns = fit_rows(family, prepared, features, options)
    return fit_on(family, params, rows, columns, options)


def fit_rows(family: str, prepared: DataFrame, features: Sequence[str], options: TrainingOptions) -> tuple[DataFrame, dict]:
    """The rows that a family is fitted on, written, and the names of their weight and holdout columns. No parameter changes them."""
    if family not in FAMILIES:
        raise ValueError(f"unknown model family {family!r}; known: {sorted(FAMILIES)}")
    label, columns = options.label, {}
    shared_folder(prepared.sparkSession)  # boosting cuts its lineage in this folder
    prepared = settle(prepared, "prepared")  # counts, the holdout draw and the fit read it again
    counts = class_counts(prepared, label)
    rows = assemble(prepared, features, label)
    if options.balance == "class_weight":
        weights = class_weights({int(k): v for k, v in counts.items()}, options.weighting)
        rows = rows.withColumn(WEIGHT, weight_column(label, weights))
        columns["weightCol"] = WEIGHT
    if family == "gbt" and options.holdout_fraction:
        rows = mark_holdout(rows, label, options.key, options.holdout_fraction, options.seed)
        columns["validationIndicatorCol"] = HOLDOUT
    return settle(rows, "fit-rows"), columns


def fit_on(family: str, params: Mapping, rows: DataFrame, columns: Mapping, options: TrainingOptions):
    """One model on the rows of ``fit_rows``."""
    params = {**params, **columns}
    if HOLDOUT in columns.values():
        params.setdefault("validationTol", 0.001)
    if family != "logistic":
        params.setdefault("seed", options.seed)
    return FAMILIES[family](featuresCol=VECTOR, labelCol=options.label, **params).fit(rows)


def feature_importances(model, features: Sequence[str], spark: SparkSession) -> DataFrame:
    """(feature, importance) descending. Linear models give the size of their weights."""
    if hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray().tolist()
    elif hasattr(model, "coefficients"):
        values = [abs(v) for v in model.coefficients.toArray().tolist()]
    else:
        raise ValueError(f"{type(model).__name__} has no feature importance")
    if len(values) != len(features):
        raise ValueError(f"{len(values)} importances for {len(features)} features")
    return spark.createDataFrame(list(zip(features, values)), "feature string, importance double").orderBy(F.desc("importance"), "feature")


@dataclass(frozen=True)
class Fold:
    """What one fold needs for any candidate: all of it comes from the other folds' rows, but for the rows to be scored."""

    prep: Preprocessing
    rows: DataFrame
    columns: dict
    valid: DataFrame


def prepare_fold(train: DataFrame, valid: DataFrame, features, family: str, options: TrainingOptions, select: bool) -> Fold:
    """Everything is fitted on ``train``."""
    prep = fit_preprocessing(train, features, options, select)
    prepared = prep.apply(train.select(as_column(options.key), as_column(options.label), *map(as_column, features)))
    prepared = resample(prepared, options.label, options.key, prep.output, options.balance, options.seed, **options.sampler_options)
    if options.balance in ("smote", "borderline_smote", "adasyn"):
        # synthetic rows carry their source key; a fresh key keeps the holdout draw per row
        prepared = settle(prepared.drop(options.key).withColumn(options.key, F.monotonically_increasing_id()), "resampled")
    return Fold(prep, *fit_rows(family, prepared, prep.output, options), valid)


def fit_predict(fold: Fold, family: str, params: Mapping, options: TrainingOptions) -> DataFrame:
    """(key, label, fold, score) of the rows that the model has not seen."""
    model = fit_on(family, params, fold.rows, fold.columns, options)
    scored = model.transform(assemble(fold.prep.apply(fold.valid), fold.prep.output))
    return scored.select(as_column(options.key), as_column(options.label), as_column(FOLD), positive_probability().alias("score"))


def _each(run, items, options: TrainingOptions) -> list:
    with ThreadPoolExecutor(max_workers=max(1, options.parallel)) as pool:
        return list(pool.map(run, items))


def prepare_folds(df: DataFrame, features, family: str, options: TrainingOptions, select: bool = True) -> tuple[DataFrame, list[Fold]]:
    """``df`` written with its folds, and each fold made ready, once for all candidates."""
    folded = settle(assign_folds(df, options.label, options.key, options.folds, options.seed), "folds")

    def one(fold: int) -> Fold:
        train, valid = folded.where(as_column(FOLD) != fold), folded.where(as_column(FOLD) == fold)
        return prepare_fold(train, valid, features, family, options, select)

    return folded, _each(one, range(options.folds), options)


def out_of_fold(df: DataFrame, features, family: str, params: Mapping, options: TrainingOptions, select: bool = True) -> DataFrame:
    """One held-out score per row. ``df`` is written with its folds first, and so are the scores."""
    return score_folds(*prepare_folds(df, features, family, options, select), family, params, options)


def score_folds(folded: DataFrame, folds: Sequence[Fold], family: str, params: Mapping, options: TrainingOptions) -> DataFrame:
    """The held-out scores of one candidate."""
    parts = _each(lambda fold: fit_predict(fold, family, params, options), folds, options)
    scored = settle(reduce(DataFrame.unionByName, parts), "oof")
    check = scored.agg(F.count(F.lit(1)).alias("n"), F.count("score").alias("s")).first()
    if check["s"] != check["n"] or check["n"] != folded.count():
        raise ValueError("out-of-fold scores are incomplete")
    return scored


# --- search -----------------------------------------------------------------------------------------------------


def sample_candidates(space: Mapping[str, Mapping], trials: int, seed: int = 42) -> list[dict]:
    """Seeded random candidates; ``log`` ranges are uniform in the logarithm."""
    source, out = random.Random(seed), []
    for _ in range(trials):
        candidate = {}
        for field_name, spec in space.items():
            kind = spec["type"]
            if kind == "categorical":
                candidate[field_name] = source.choice(list(spec["choices"]))
            elif kind in ("int", "float"):
                low, high = spec["low"], spec["high"]
                if spec.get("log", False):
                    value = math.exp(source.uniform(math.log(low), math.log(high)))
                else:
                    value = source.uniform(low, high) if kind == "float" else source.randint(low, high)
                candidate[field_name] = int(min(max(round(value), low), high)) if kind == "int" else value
            else:
                raise ValueError(f"unknown search space type for {field_name}: {kind!r}")
        out.append(candidate)
    return out


def search(df: DataFrame, features, family: str, params: Mapping, space: Mapping, options: TrainingOptions):
    """(best params, trial table, out-of-fold scores of the best candidate) on a stratified subsample."""
    sample = settle(stratified_sample(df, options.label, options.key, rate=options.search_rate, seed=options.seed), "search")
    trials, best = [], None
    folded, folds = prepare_folds(sample, features, family, options, options.select_in_search)
    for number, candidate in enumerate(sample_candidates(space, options.trials, options.seed)):
        merged = {**params, **candidate}
        scored = score_folds(folded, folds, family, merged, options)
        value = single_metric(scored, options.label, "score", options.metric, options.threshold)
        trials.append((number, json.dumps(candidate, sort_keys=True), float(value)))
        if best is None or value > best[0]:
            best = (value, merged, scored)
    table = df.sparkSession.createDataFrame(trials, "trial int, params string, value double")
    return best[1], table, best[2]


def champion(runs: DataFrame, gate: float, metric: str = "roc_auc", when: str = "finished_at") -> DataFrame:
    """The latest run that reaches the gate; runs without the metric never qualify."""
    passed = runs.where(as_column(metric).isNotNull() & (as_column(metric) >= F.lit(gate)))
    return passed.orderBy(as_column(when).desc()).limit(1)


def gate_status(runs: DataFrame, gate: float, metric: str = "roc_auc") -> DataFrame:
    value = as_column(metric)
    status = (
        F.when(value.isNull(), f"skipped_missing_{metric}").when(value < gate, "skipped_metric_gate").otherwise("registered")
    )
    return runs.withColumn("registry_status", status)
