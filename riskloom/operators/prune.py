"""Column pruning fitted on training rows: correlated and near-constant columns."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.text import name, number, text
from riskloom.operators.gram import strong_pairs
from riskloom.operators.quality import count_flags
from riskloom.session import discard


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Pearson correlations of null-free columns; NaN for constant ones.

    Dense vectors make Spark centre the data before multiplying, which matters
    for columns with a large mean.
    """
    values = ", ".join(f"CAST({name(c)} AS DOUBLE)" for c in columns)
    packed = df.select(array_to_vector(F.expr(f"array({values})")).alias("v"))
    return Correlation.corr(packed, "v").first()[0].toArray()


def correlated_columns(df: DataFrame, columns: Sequence[str], threshold: float) -> list[str]:
    """Columns strongly tied to any earlier column, dropped or not. Order matters."""
    if len(set(columns)) < 2:
        return []
    pairs = strong_pairs(df, columns, threshold)
    found = {r[0] for r in pairs.select("second").distinct().collect()}
    discard(pairs)
    return [c for c in columns if c in found]


def value_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, top_count, rows, share) of the most frequent value, null included.

    Values are compared as text of their own type, so each column keeps its
    distinctions; the counts combine before the shuffle.
    """
    entries = ", ".join(f"named_struct('column', {text(c)}, 'value', CAST({name(c)} AS STRING))" for c in columns)
    counted = df.selectExpr(f"explode(array({entries})) AS e").groupBy("e.column", "e.value").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("column").agg(
        F.max("n").alias("top_count"), F.sum("n").alias("rows"), (F.max("n") / F.sum("n")).alias("share")
    )


def near_constant_columns(df: DataFrame, columns: Sequence[str], threshold: float) -> list[str]:
    """Columns whose most frequent value covers more than ``threshold`` of the rows.

    For thresholds of a half or more no value counting is needed: a value that
    frequent covers the middle of the sorted column, so it is the approximate
    median. One pass finds that candidate and a second one counts it exactly,
    both without a shuffle of the data.
    """
    if not columns:
        return []
    if threshold < 0.6:
        rows = value_shares(df, columns).where(F.col("share") > threshold).select("column").collect()
        dropped = {r[0] for r in rows}
        return [c for c in columns if c in dropped]
    kinds = dict(df.dtypes)
    # the sketch works on doubles; types that do not fit one exactly go in as a 52-bit hash
    exact = {"tinyint", "smallint", "int", "float", "double"}

    def comparable(c):
        return name(c) if kinds[c] in exact else f"pmod(xxhash64({name(c)}), {1 << 52})"

    middle = df.selectExpr(
        "count(1) AS rows",
        *[f"percentile_approx(CASE WHEN {name(c)} IS NOT NULL THEN {comparable(c)} END, 0.5D, 100) AS m{i}" for i, c in enumerate(columns)],
    ).first()
    if not middle["rows"]:
        return []
    hits = {}
    for i, c in enumerate(columns):
        found = middle[f"m{i}"]
        if found is not None:
            value = number(found) if isinstance(found, float) else str(int(found))
            hits[c] = f"{name(c)} IS NOT NULL AND {comparable(c)} = {value}"
    counts = count_flags(df, [*[f"{name(c)} IS NULL" for c in columns], *hits.values()])
    nulls, same = dict(zip(columns, counts)), dict(zip(hits, counts[len(columns):]))
    shares = {c: max(nulls[c], same.get(c, 0)) / middle["rows"] for c in columns}
    # two values behind one hash are told apart by counting values, which practically never happens
    hashed = [c for c, n in same.items() if kinds[c] not in exact and n / middle["rows"] > threshold]
    if hashed:
        one = [f"CASE WHEN {hits[c]} THEN {name(c)} END" for c in hashed]
        alike = df.selectExpr(*[f"min({v}) <=> max({v}) AS same{i}" for i, v in enumerate(one)]).first()
        mixed = [c for c, same_value in zip(hashed, alike) if not same_value]
        shares |= {r["column"]: r["share"] for r in value_shares(df, mixed).collect()} if mixed else {}
    return [c for c in columns if shares[c] > threshold]
