"""Scalers fitted on training rows: standard, robust and min-max."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from riskloom.functions.text import name, number
from riskloom.operators.quantiles import exact_quantiles

KINDS = ("standard", "robust", "minmax")


@dataclass(frozen=True)
class Scaling:
    """(value - centre) / width per column; a zero width counts as 1."""

    kind: str | None
    centre: dict[str, float] = field(default_factory=dict)
    width: dict[str, float] = field(default_factory=dict)

    def apply(self, df: DataFrame) -> DataFrame:
        if not self.centre:
            return df
        return df.selectExpr(*[
            f"(CAST({name(c)} AS DOUBLE) - {number(self.centre[c])}) / {number(self.width[c])} AS {name(c)}" if c in self.centre else name(c)
            for c in df.columns
        ])


def fit_scaling(train: DataFrame, columns: Sequence[str], kind: str | None = "robust") -> Scaling:
    columns = list(columns)
    if kind in (None, "none") or not columns:
        return Scaling(None)
    if kind not in KINDS:
        raise ValueError(f"unknown scaler {kind!r}; known: {KINDS}")
    if kind == "robust":
        points = exact_quantiles(train, columns, [0.25, 0.5, 0.75])
        centre = {c: (points[c][1] or 0.0) for c in columns}
        width = {c: ((points[c][2] - points[c][0]) if points[c][0] is not None else 0.0) for c in columns}
    else:
        first, second = ("avg", "stddev_pop") if kind == "standard" else ("min", "max")
        row = train.selectExpr(
            *[f"{first}(CAST({name(c)} AS DOUBLE)) AS a{i}" for i, c in enumerate(columns)],
            *[f"{second}(CAST({name(c)} AS DOUBLE)) AS b{i}" for i, c in enumerate(columns)],
        ).first()
        centre = {c: (row[f"a{i}"] or 0.0) for i, c in enumerate(columns)}
        width = {
            c: ((row[f"b{i}"] or 0.0) if kind == "standard" else (row[f"b{i}"] or 0.0) - centre[c])
            for i, c in enumerate(columns)
        }
    return Scaling(kind, centre, {c: (w if w else 1.0) for c, w in width.items()})
