"""Alignment of incoming rows to a fitted model, and scoring."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.columns import as_column, at_or_above
from riskloom.functions.names import tidy_columns
from riskloom.functions.text import name
from riskloom.operators.training import Preprocessing, assemble, positive_probability
from riskloom.sources.sinks import read_document, write_document

PROBABILITY, PREDICTION = "TARGET_PROBABILITY", "TARGET_PREDICTION"


@dataclass(frozen=True)
class Alignment:
    missing: list[str] = field(default_factory=list)
    extra: list[str] = field(default_factory=list)


def align_features(df: DataFrame, expected: Sequence[str], key: str = "SK_ID_CURR", target: str = "TARGET",
                   allow_target: bool = False, strategy: str = "fill", fill: float = 0,
                   most_missing: int | None = 20) -> tuple[DataFrame, Alignment]:
    """(key + expected columns in order, what was missing or ignored).

    Only schemas are compared. Rows without a key get a generated one.
    """
    if target in df.columns and not allow_target:
        raise ValueError(f"{target} is part of the rows to score; allow it to have it dropped")
    if strategy not in ("fill", "error"):
        raise ValueError(f"unknown strategy for missing features: {strategy!r}")
    own_key = key in df.columns
    if not own_key:
        df = df.withColumn(key, F.monotonically_increasing_id())
    features = tidy_columns(df.drop(key, target) if own_key else df.drop(target, key))
    names = dict(zip([c for c in df.columns if c not in (key, target)], features.columns))
    present = set(names.values())
    missing = [c for c in expected if c not in present]
    extra = [c for c in features.columns if c not in set(expected)]
    if missing and strategy == "error":
        raise ValueError(f"{len(missing)} required features are missing: {missing[:10]}")
    if most_missing is not None and len(missing) > int(most_missing):
        raise ValueError(f"{len(missing)} features are missing, more than the {most_missing} that may be filled: {missing[:10]}")
    source = {clean: raw for raw, clean in names.items()}
    columns = [f"{name(source[c])} AS {name(c)}" if c in source else f"{fill} AS {name(c)}" for c in expected]
    return df.selectExpr(name(key), *columns), Alignment(missing, extra)


@dataclass(frozen=True)
class Diagnostics:
    recognized_columns: list[str]
    ignored_columns: list[str]
    filled_missing_count: int
    filled_missing_preview: list[str]


# Declared model input types and the column types they are cast to.
SIGNATURE_TYPES = {"double": "double", "float": "double", "long": "long", "integer": "long", "string": "string", "boolean": "boolean"}


def align_to_signature(df: DataFrame, signature: Mapping[str, str], key: str = "SK_ID_CURR") -> tuple[DataFrame, Diagnostics]:
    """Signature columns in order and type. A value that cannot be cast is an error naming its columns."""
    recognized = [c for c in df.columns if c in signature]
    ignored = [c for c in df.columns if c not in signature]
    if not [c for c in recognized if c != key]:
        raise ValueError("no known model feature among the given columns")
    missing = [c for c in signature if c not in df.columns]

    def cast(c: str) -> Column:
        kind = SIGNATURE_TYPES.get(signature[c].lower(), "string")
        return _narrowed(as_column(c), kind) if c in df.columns else F.lit(0).cast(kind)

    bad = uncastable(df, {c: SIGNATURE_TYPES.get(signature[c].lower(), "string") for c in recognized})
    failed = [c for c, n in bad.items() if n]
    if failed:
        raise ValueError(f"columns cannot be converted to their declared type: {failed}")
    return df.select([cast(c).alias(c) for c in signature]), Diagnostics(recognized, ignored, len(missing), missing[:10])


def _narrowed(column: Column, kind: str) -> Column:
    """The value in the wanted type; text with decimals is read as a number before it becomes a whole one."""
    if kind != "long":
        return column.try_cast(kind)
    return F.coalesce(column.try_cast("long"), column.try_cast("double").try_cast("long"))


def uncastable(df: DataFrame, kinds: Mapping[str, str]) -> dict[str, int]:
    """Values per column that do not fit the wanted type, from one pass."""
    current = dict(df.dtypes)
    wanted = {c: k for c, k in kinds.items() if current[c] != k and k != "string"}
    if not wanted:
        return {}
    row = df.agg(*[
        F.count_if(as_column(c).isNotNull() & _narrowed(as_column(c), k).isNull()).alias(f"n{i}") for i, (c, k) in enumerate(wanted.items())
    ]).first()
    return {c: row[f"n{i}"] for i, c in enumerate(wanted)}


@dataclass(frozen=True)
class LinearWeights:
    """A linear model as plain numbers: probability = 1 / (1 + exp(-(intercept + sum of w * x)))."""

    weights: dict[str, float]
    intercept: float = 0.0

    @property
    def features(self) -> list[str]:
        return list(self.weights)

    def margin(self) -> Column:
        total = F.lit(float(self.intercept))
        for c, w in self.weights.items():
            total = total + F.lit(float(w)) * as_column(c).cast("double")
        return total

    def probability(self, df: DataFrame, out: str) -> DataFrame:
        return df.withColumn(out, F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin())))

    @staticmethod
    def of(model, features: Sequence[str]) -> "LinearWeights":
        return LinearWeights(dict(zip(features, model.coefficients.toArray().tolist())), float(model.intercept))


@dataclass(frozen=True)
class FittedModel:
    """A Spark ML classification model with its feature order."""

    model: object
    features: list[str]

    def probability(self, df: DataFrame, out: str) -> DataFrame:
        scored = self.model.transform(assemble(df.select(*df.columns), self.features))
        rest = [c for c in df.columns if c not in self.features]
        return scored.select(*map(as_column, rest), positive_probability().alias(out))


@dataclass(frozen=True)
class Scorer:
    """Preprocessing and model in one callable."""

    model: LinearWeights | FittedModel
    preprocessing: Preprocessing | None = None
    key: str = "SK_ID_CURR"
    target: str = "TARGET"

    @property
    def inputs(self) -> list[str]:
        return self.preprocessing.features if self.preprocessing else self.model.features

    def predict(self, df: DataFrame, out: str = PROBABILITY) -> DataFrame:
        """(key, probability): target dropped, names cleaned, any number of missing features filled."""
        aligned, _ = align_features(df, self.inputs, self.key, self.target, allow_target=True, most_missing=None)
        return self.score_aligned(aligned, out)

    def score_aligned(self, aligned: DataFrame, out: str = PROBABILITY) -> DataFrame:
        prepared = self.preprocessing.apply(aligned) if self.preprocessing else aligned
        return self.model.probability(prepared, out).select(as_column(self.key), as_column(out))

    def save(self, spark: SparkSession, folder: str) -> None:
        facts = {"key": self.key, "target": self.target, "features": self.model.features}
        facts["preprocessing"] = asdict(self.preprocessing) if self.preprocessing else None
        if isinstance(self.model, LinearWeights):
            facts["linear"] = asdict(self.model)
        else:
            PipelineModel([self.model.model]).write().overwrite().save(f"{folder}/model")
        write_document(spark, facts, f"{folder}/scorer")

    @staticmethod
    def load(spark: SparkSession, folder: str) -> "Scorer":
        facts = read_document(spark, f"{folder}/scorer")
        if facts.get("linear"):
            model = LinearWeights(**facts["linear"])
        else:
            model = FittedModel(PipelineModel.load(f"{folder}/model").stages[0], facts["features"])
        prep = Preprocessing.from_json(json.dumps(facts["preprocessing"])) if facts["preprocessing"] else None
        return Scorer(model, prep, facts["key"], facts["target"])


def resolve_threshold(spark: SparkSession, argument: float | None = None, source: str = "artifact",
                      configured: float = 0.5, artifact: str | None = None) -> float:
    """An explicit value wins, then the configured source."""
    if argument is not None:
        return float(argument)
    if source == "config":
        return float(configured)
    if source != "artifact":
        raise ValueError(f"unknown threshold source {source!r}")
    try:
        row = spark.read.parquet(artifact).select("threshold").first() if artifact else None
    except Exception as error:
        raise FileNotFoundError(f"no threshold table at {artifact}") from error
    if row is None:
        raise FileNotFoundError(f"no threshold table at {artifact}")
    return float(row["threshold"])


def score_batch(df: DataFrame, scorer: Scorer, threshold: float | None = 0.5, label: bool = True, **alignment) -> tuple[DataFrame, Alignment]:
    """(key, probability[, label]) of every row; the label uses ``>=``."""
    aligned, found = align_features(df, scorer.inputs, scorer.key, scorer.target, **alignment)
    out = scorer.score_aligned(aligned)
    return (out.withColumn(PREDICTION, at_or_above(PROBABILITY, F.lit(float(threshold)))) if label else out), found


def score_request(df: DataFrame, scorer: Scorer, signature: Mapping[str, str], model_name: str, model_alias: str,
                  threshold: float = 0.5, most_rows: int | None = 128, label: bool = True) -> tuple[DataFrame, Diagnostics]:
    """Scored request rows with the model's name, and diagnostics of the input.

    ``most_rows`` is the limit of one request; None takes a whole table, whose rows are never gathered to be counted.
    """
    if df.isEmpty():
        raise ValueError("the request holds no rows")
    if most_rows is not None and df.limit(most_rows + 1).count() > most_rows:
        raise ValueError(f"the request holds more than {most_rows} rows")
    own_key = scorer.key in df.columns
    keyed = df if own_key else df.withColumn(scorer.key, F.monotonically_increasing_id())
    wanted = dict(signature) if scorer.key in signature else {scorer.key: "long", **signature}
    aligned, diagnostics = align_to_signature(keyed, wanted, scorer.key)
    known = [c for c in diagnostics.recognized_columns if c in df.columns]
    diagnostics = Diagnostics(known, diagnostics.ignored_columns, diagnostics.filled_missing_count, diagnostics.filled_missing_preview)
    out = scorer.score_aligned(aligned).withColumns({"model_name": F.lit(model_name), "model_alias": F.lit(model_alias)})
    return (out.withColumn(PREDICTION, at_or_above(PROBABILITY, F.lit(float(threshold)))) if label else out), diagnostics
