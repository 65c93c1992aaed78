"""Ordered target statistics: categories coded by the labels of the rows before.

A category's mean label tells a row its own label. Here the training rows stand
in a repeatable shuffle, and each is coded by the rows of its category that come
before it, pulled towards a prior; rows to be scored are coded by all training
rows. No list of categories is brought to the driver, all columns are coded in
one pass over long rows, and a category that holds a large part of the table is
split by ranges of the shuffle, with an offset for each range.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import as_column
from riskloom.functions.text import name
from riskloom.operators.ranking import PREFIX, draw
from riskloom.session import settle

SUFFIX = "_CODE"


def _long(df: DataFrame, key: str, columns: Sequence[str], label: str | None = None) -> DataFrame:
    """(key, label, field, value): a row per row and column; null is a category of its own."""
    entries = ", ".join(f"named_struct('field', {i}, 'value', coalesce(concat('v', CAST({name(c)} AS STRING)), 'null'))" for i, c in enumerate(columns))
    own = [] if label is None else [as_column(label).cast("double").alias("label")]
    return df.select(as_column(key), *own, F.expr(f"explode(array({entries}))").alias("e")).select(as_column(key), *(["label"] if own else []), "e.*")


@dataclass(frozen=True)
class TargetStatistics:
    """``table``: (field, value, total, rows), the label sum and row count of every category of the training rows."""

    columns: list[str]
    key: str
    label: str
    prior: float
    weight: float
    seed: int
    table: DataFrame

    def _code(self, total: Column, rows: Column) -> Column:
        return (F.coalesce(total, F.lit(0.0)) + F.lit(self.prior * self.weight)) / (F.coalesce(rows, F.lit(0)) + F.lit(self.weight))

    def _joined(self, df: DataFrame, coded: DataFrame) -> DataFrame:
        wide = coded.groupBy(as_column(self.key)).agg(*[F.max(F.when(F.col("field") == i, F.col("code"))).alias(c + SUFFIX) for i, c in enumerate(self.columns)])
        return df.join(wide, self.key)

    def ordered(self, train: DataFrame) -> DataFrame:
        """``train`` with a column ``<column>_CODE`` for each column, from the rows before each row. ``key`` is unique."""
        long = _long(train, self.key, self.columns, self.label)
        drawn = long.withColumn("draw", draw(self.key, self.seed)).withColumn("part", F.substring("draw", 1, PREFIX))
        before = Window.partitionBy("field", "value").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = drawn.groupBy("field", "value", "part").agg(F.sum("label").alias("s"), F.count(F.lit(1)).alias("n")).select(
            "field", "value", "part", F.coalesce(F.sum("s").over(before), F.lit(0.0)).alias("s"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n"))
        inside = Window.partitionBy("field", "value", "part").orderBy("draw", as_column(self.key)).rowsBetween(Window.unboundedPreceding, -1)
        total = F.col("s") + F.coalesce(F.sum("label").over(inside), F.lit(0.0))
        rows = F.col("n") + F.count(F.lit(1)).over(inside)
        coded = drawn.join(offsets, ["field", "value", "part"]).select(as_column(self.key), "field", self._code(total, rows).alias("code"))
        return self._joined(train, coded)

    def apply(self, df: DataFrame) -> DataFrame:
        """Other rows coded by all training rows; unseen categories get the prior."""
        coded = _long(df, self.key, self.columns).join(self.table, ["field", "value"], "left")
        return self._joined(df, coded.select(as_column(self.key), "field", self._code(F.col("total"), F.col("rows")).alias("code")))


def fit_target_statistics(train: DataFrame, columns: Sequence[str], label: str, key: str, prior: float = 0.5, weight: float = 1.0, seed: int = 42) -> TargetStatistics:
    """The prior does not come from the labels, so that no row's code depends on its own."""
    if weight <= 0:
        raise ValueError("the prior needs a positive weight, else the first row of a category has no code")
    long = _long(train, key, columns, label)
    table = settle(long.groupBy("field", "value").agg(F.sum("label").alias("total"), F.count(F.lit(1)).alias("rows")), "target-statistics")
    return TargetStatistics(list(columns), key, label, prior, weight, seed, table)
