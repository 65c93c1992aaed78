"""Class balance: weights, undersampling and synthetic minority rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import as_column
from riskloom.functions.text import name, text
from riskloom.operators.neighbors import nearest
from riskloom.operators.ranking import class_counts, shuffled_rank, take_per_class, unit_draw
from riskloom.session import settle

WEIGHTINGS = ("balanced", "negative_over_positive", "fixed")
SAMPLERS = ("smote", "borderline_smote", "adasyn", "random_undersample")
FIXED_POSITIVE_WEIGHT = 11.3
CHUNK = 1_000


def class_weights(counts: dict, rule: str = "balanced", fixed: float = FIXED_POSITIVE_WEIGHT) -> dict:
    """Weight per class: largest class over own class, or one weight for the positives."""
    if rule == "balanced":
        return {c: max(counts.values()) / n for c, n in counts.items()}
    if rule == "negative_over_positive":
        return {0: 1.0, 1: counts[0] / counts[1]}
    if rule == "fixed":
        return {0: 1.0, 1: fixed}
    raise ValueError(f"unknown weighting {rule!r}; known: {WEIGHTINGS}")


def weight_column(label: str, weights: dict) -> Column:
    column = None
    for value, weight in weights.items():
        test = as_column(label) == F.lit(value)
        column = F.when(test, F.lit(float(weight))) if column is None else column.when(test, F.lit(float(weight)))
    return column


def undersample(df: DataFrame, label: str, key: str, seed: int) -> DataFrame:
    """Every class cut to the size of the smallest, by repeatable draw."""
    counts = class_counts(df, label)
    smallest = min(counts.values())
    return take_per_class(df, label, key, {c: smallest for c in counts}, seed)


def _minority(counts: dict):
    value = min(counts, key=lambda c: (counts[c], c))
    return value, max(counts.values()) - counts[value]


def oversample(df: DataFrame, label: str, key: str, features: Sequence[str], strategy: str = "smote",
               neighbors: int = 5, seed: int = 42, border_neighbors: int = 10, exact: bool = False) -> DataFrame:
    """Original rows plus synthetic minority rows ``x + u * (neighbour - x)``.

    Output: (source key, label, features, is_synthetic). The three strategies
    differ in which minority rows are used and how often. Neighbours are found
    by hashing unless ``exact`` (see ``neighbors.nearest``).
    """
    counts = class_counts(df, label)
    rare, needed = _minority(counts)
    features = list(features)
    plain = df.selectExpr(name(key), name(label), *[f"CAST({name(c)} AS DOUBLE) AS {name(c)}" for c in features])
    kept = plain.withColumn("is_synthetic", F.lit(False))
    if needed <= 0:
        return kept
    if counts[rare] < 2:
        raise ValueError(f"{strategy} needs at least two rows of the smaller class, found {counts[rare]}")
    vectors = settle(
        plain.select(as_column(key).alias("id"), (as_column(label) == F.lit(rare)).alias("rare"), F.expr(f"array({', '.join(map(name, features))})").alias("vec")),
        "rows",
    )
    rare_rows = vectors.where("rare")
    draws = seed_draws(vectors, rare_rows, strategy, needed, neighbors, seed, border_neighbors, exact)
    return kept.unionByName(_synthesize(rare_rows, draws, key, label, rare, features, neighbors, seed, plain, exact))


def seed_draws(vectors, rare_rows, strategy: str, needed: int, neighbors: int, seed: int, border_neighbors: int, exact: bool = False):
    """(id, draws): how many synthetic rows start from each minority row."""
    if strategy == "smote":
        return _even_draws(rare_rows.select("id"), needed, seed)
    if strategy == "borderline_smote":
        around = majority_share(rare_rows, vectors, border_neighbors, seed, exact)
        danger = around.where((F.col("others") * 2 >= border_neighbors) & (F.col("others") < border_neighbors)).select("id")
        danger = settle(danger, "danger")
        if danger.isEmpty():
            raise ValueError("borderline_smote found no row of the smaller class near the border")
        return _even_draws(danger, needed, seed)
    if strategy == "adasyn":
        around = settle(majority_share(rare_rows, vectors, neighbors, seed, exact), "around")
        total = around.agg(F.sum("others").alias("t")).first()["t"]
        if not total:
            raise ValueError("adasyn found no row of the larger class near a row of the smaller one")
        weighed = F.bround(F.col("others") / F.lit(float(total)) * F.lit(float(needed))).cast("long")
        return around.select("id", weighed.alias("draws")).where("draws > 0")
    raise ValueError(f"unknown sampler {strategy!r}; known: {SAMPLERS}")


def majority_share(rare_rows: DataFrame, vectors: DataFrame, neighbors: int, seed: int, exact: bool = False) -> DataFrame:
    """(id, others): majority rows among the nearest neighbours of each minority row."""
    found = nearest(rare_rows, vectors, "id", "vec", neighbors, seed, exact)
    flags = vectors.select(F.col("id").alias("neighbor"), "rare")
    return found.join(flags, "neighbor").groupBy(F.col("query").alias("id")).agg(F.count_if(~F.col("rare")).alias("others"))


def _even_draws(ids: DataFrame, needed: int, seed: int) -> DataFrame:
    """``needed`` draws shared out evenly, the remainder by repeatable shuffle."""
    count = ids.count()
    each, rest = divmod(needed, count)
    ranked = shuffled_rank(ids.withColumn("all", F.lit(0)), "all", "id", seed)
    draws = F.lit(each) + (F.col("draw_rank") <= F.lit(rest)).cast("long")
    return ranked.select("id", draws.alias("draws")).where("draws > 0")


def _synthesize(rare_rows, draws, key, label, rare, features, neighbors, seed, plain, exact) -> DataFrame:
    found = settle(nearest(rare_rows, rare_rows, "id", "vec", neighbors, seed, exact), "near")
    available = found.groupBy(F.col("query").alias("id")).agg(F.max("rank").alias("available"))
    # long runs of draws are cut into chunks first, so one heavy row is shared out over tasks
    chunks = draws.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("draws") - 1, F.lit(CHUNK).cast("long"))))
    shared = chunks.repartition("id", "from")
    numbered = shared.withColumn("i", F.explode(F.sequence("from", F.least(F.col("from") + CHUNK, F.col("draws")) - 1)))
    picked = (
        numbered.join(available, "id")
        .withColumn("rank", (F.floor(unit_draw("id", "i", seed=seed) * F.col("available")) + 1).cast("int"))
        .withColumn("u", unit_draw("id", "i", seed=seed + 1))
        .join(found.select(F.col("query").alias("id"), "rank", "neighbor"), ["id", "rank"])
        .join(rare_rows.select("id", "vec"), "id")
        .join(rare_rows.select(F.col("id").alias("neighbor"), F.col("vec").alias("other")), "neighbor")
    )
    values = [f"vec[{j}] + u * (other[{j}] - vec[{j}]) AS {name(c)}" for j, c in enumerate(features)]
    kind = plain.schema[label].dataType.simpleString()
    value = text(rare) if isinstance(rare, str) else str(rare)
    return picked.selectExpr(f"id AS {name(key)}", f"CAST({value} AS {kind}) AS {name(label)}", *values, "true AS is_synthetic")


def resample(df: DataFrame, label: str, key: str, features: Sequence[str], strategy: str | None, seed: int = 42, **options) -> DataFrame:
    """The configured balance step of a training set; weights are handled at the fit."""
    if strategy in (None, "none", "class_weight"):
        return df
    if strategy == "random_undersample":
        return undersample(df, label, key, seed)
    if strategy not in SAMPLERS:
        raise ValueError(f"unknown sampler {strategy!r}; known: {SAMPLERS}")
    return oversample(df, label, key, features, strategy, seed=seed, **options)
