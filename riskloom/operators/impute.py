"""Median imputation with missing flags, fitted on training rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from riskloom.functions.columns import numeric_columns
from riskloom.functions.text import name, number
from riskloom.operators.quantiles import exact_quantiles


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, int]:
    """Nulls per column from a single pass."""
    columns = list(df.columns if columns is None else columns)
    if not columns:
        return {}
    row = df.selectExpr(*[f"count_if({name(c)} IS NULL) AS n{i}" for i, c in enumerate(columns)]).first()
    return {c: row[f"n{i}"] for i, c in enumerate(columns)}


@dataclass(frozen=True)
class Imputation:
    """Zero-filled history columns, median-filled columns, and those that get a flag."""

    zero_filled: list[str] = field(default_factory=list)
    medians: dict[str, float] = field(default_factory=dict)
    flagged: list[str] = field(default_factory=list)
    zero: float = 0

    def apply(self, df: DataFrame) -> DataFrame:
        zero, flagged = set(self.zero_filled), set(self.flagged)
        kinds = dict(df.dtypes)
        out = []
        flags = {f"{c}_is_missing": f"CAST({name(c)} IS NULL AS INT)" for c in df.columns if c in flagged}
        for c in df.columns:
            if c in flags:
                # a flag made earlier keeps its place and takes the new value
                out.append(f"{flags.pop(c)} AS {name(c)}")
            elif c in zero:
                out.append(f"coalesce({name(c)}, CAST({number(self.zero)} AS {kinds[c]})) AS {name(c)}")
            elif c in self.medians:
                out.append(f"coalesce(CAST({name(c)} AS DOUBLE), {number(self.medians[c])}) AS {name(c)}")
            else:
                out.append(name(c))
        return df.selectExpr(*out, *[f"{e} AS {name(c)}" for c, e in flags.items()])


def fit_imputation(
    train: DataFrame, skip: Sequence[str], history_prefixes: Sequence[str], no_median: float = 0, zero: float = 0,
    nulls: Mapping[str, int] | None = None, base_rows: DataFrame | None = None,
) -> Imputation:
    """Flags are made only for columns with nulls among the *training* rows.

    Every base column keeps its training median, so nulls that occur only later
    are still filled, without a flag. ``nulls`` are the null counts where they
    are known already, and ``base_rows`` the training rows with the base columns
    alone where those are quicker to read.
    """
    prefixes = tuple(history_prefixes)
    history = [c for c in train.columns if prefixes and c.startswith(prefixes)]
    base = numeric_columns(train, skip=[*skip, *history])
    rows = train if base_rows is None else base_rows
    nulls = null_counts(rows, base) if nulls is None else nulls
    middle = exact_quantiles(rows, base, [0.5])
    medians = {c: (middle[c][0] if middle[c][0] is not None else no_median) for c in base}
    return Imputation(history, medians, [c for c in base if nulls[c] > 0], zero)
