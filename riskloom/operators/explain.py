"""Additive attributions of a linear model and their summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import as_column
from riskloom.operators.quantiles import exact_quantiles
from riskloom.operators.scoring import LinearWeights


def linear_contributions(df: DataFrame, model: LinearWeights, key: str) -> DataFrame:
    """(key, feature, value, contribution): ``w * (x - mean x)``.

    The contributions of a row add up to its margin minus the average margin.
    """
    features = model.features
    means = df.agg(*[F.avg(as_column(c).cast("double")).alias(f"m{i}") for i, c in enumerate(features)]).first()
    entries = []
    for i, c in enumerate(features):
        value = as_column(c).cast("double")
        part = F.lit(float(model.weights[c])) * (value - F.lit(float(means[f"m{i}"] or 0.0)))
        entries.append(F.struct(F.lit(c).alias("feature"), value.alias("value"), part.alias("contribution")))
    return df.select(as_column(key), F.explode(F.array(*entries)).alias("e")).select(as_column(key), "e.*")


def contribution_summary(contributions: DataFrame, importance: DataFrame | None = None) -> DataFrame:
    """(feature, mean_abs_shap, mean_shap, std_shap, native_importance, rank); one row per feature."""
    summed = contributions.groupBy("feature").agg(
        F.avg(F.abs("contribution")).alias("mean_abs_shap"), F.avg("contribution").alias("mean_shap"),
        F.stddev_pop("contribution").alias("std_shap"),
    )
    if importance is not None:
        summed = summed.join(importance.select("feature", F.col("importance").alias("native_importance")), "feature", "left")
    else:
        summed = summed.withColumn("native_importance", F.lit(None).cast("double"))
    return summed.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("mean_abs_shap"), "feature")))


def plot_scale(df: DataFrame, columns: Sequence[str], low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Each column mapped to [0, 1] between two of its quantiles; a flat column gives 0."""
    points = exact_quantiles(df, columns, [low, high])
    out = []
    for c in df.columns:
        if c not in columns:
            out.append(as_column(c))
            continue
        a, b = points[c]
        if a is None or abs(b - a) <= 1e-8 + 1e-5 * abs(b):
            out.append(F.lit(0.0).alias(c))
            continue
        scaled = (as_column(c).cast("double") - F.lit(a)) / F.lit(b - a)
        out.append(F.when(scaled < 0, F.lit(0.0)).when(scaled > 1, F.lit(1.0)).otherwise(scaled).alias(c))
    return df.select(*out)
