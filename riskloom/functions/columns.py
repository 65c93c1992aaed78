"""Column expressions. Everything here stays inside generated JVM code."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import add, mul

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPSILON = 1e-9
DAYS_PER_YEAR = 365.25

__all__ = [
    "EPSILON", "as_column", "numeric_columns", "string_columns", "ratio", "blank_value", "age_years", "gap_pair",
    "null_flag", "row_sum", "row_mean", "row_min", "row_max", "row_range", "row_product",
    "row_std", "floor_at", "between_zero_one", "finite_or", "is_invalid_number", "strictly_above",
    "at_or_above",
]


def as_column(value) -> Column:
    """Columns pass through; strings are exact column names (dots allowed)."""
    return value if isinstance(value, Column) else F.col(f"`{value}`")


def _double(value) -> Column:
    return as_column(value).cast("double")


def numeric_columns(df: DataFrame, skip: Iterable[str] = ()) -> list[str]:
    dropped = set(skip)
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in dropped
    ]


def string_columns(df: DataFrame, skip: Iterable[str] = ()) -> list[str]:
    dropped = set(skip)
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in dropped
    ]


def ratio(top, bottom, epsilon: float = EPSILON) -> Column:
    """top / (bottom + epsilon); a zero bottom gives a huge number, not null."""
    return F.try_divide(_double(top), _double(bottom) + F.lit(epsilon))


def blank_value(column, unwanted) -> Column:
    """Null where the column holds a placeholder value; nulls stay null."""
    c = as_column(column)
    return F.when(c != F.lit(unwanted), c)


def age_years(days) -> Column:
    return F.abs(_double(days)) / F.lit(DAYS_PER_YEAR)


def gap_pair(left, right, epsilon: float = EPSILON) -> tuple[Column, Column]:
    """(left - right, that gap relative to right)."""
    gap = _double(left) - _double(right)
    return gap, F.try_divide(gap, _double(right) + F.lit(epsilon))


def null_flag(column, type_name: str = "byte") -> Column:
    return as_column(column).isNull().cast(type_name)


def _lenient(columns: Sequence) -> list[Column]:
    return [as_column(c).try_cast("double") for c in columns]


def row_sum(columns: Sequence) -> Column:
    """Sum across columns; nulls count as nothing, an all-null row gives 0."""
    return reduce(add, [F.coalesce(c, F.lit(0.0)) for c in _lenient(columns)])


def _present(columns: list[Column]) -> Column:
    return reduce(add, [c.isNotNull().cast("int") for c in columns])


def row_mean(columns: Sequence) -> Column:
    values = _lenient(columns)
    total = reduce(add, [F.coalesce(c, F.lit(0.0)) for c in values])
    return F.try_divide(total, _present(values))


def row_min(columns: Sequence) -> Column:
    return F.least(*_lenient(columns))


def row_max(columns: Sequence) -> Column:
    return F.greatest(*_lenient(columns))


def row_range(columns: Sequence) -> Column:
    return row_max(columns) - row_min(columns)


def row_product(columns: Sequence) -> Column:
    """Null as soon as one factor is null."""
    return reduce(mul, _lenient(columns))


def row_std(columns: Sequence) -> Column:
    """Population standard deviation over the non-null values of a row."""
    centre = row_mean(columns)
    return F.sqrt(row_mean([F.pow(c - centre, F.lit(2.0)) for c in _lenient(columns)]))


def floor_at(column, low: float) -> Column:
    """Raise smaller values to ``low``. Not ``greatest``: that would fill nulls."""
    c = as_column(column)
    return F.when(c < F.lit(low), F.lit(low)).otherwise(c)


def between_zero_one(column) -> Column:
    c = as_column(column)
    return F.when(c < 0, F.lit(0.0)).when(c > 1, F.lit(1.0)).otherwise(c)


def is_invalid_number(column, data_type: T.DataType) -> Column:
    """True for NaN and both infinities, false for null; only floats can be invalid."""
    c = as_column(column)
    if not isinstance(data_type, (T.DoubleType, T.FloatType)):
        return F.lit(False)
    infinite = F.abs(c) == F.lit(float("inf"))
    return F.isnan(c) | F.coalesce(infinite, F.lit(False))


def finite_or(column, data_type: T.DataType, fill=0) -> Column:
    """NaN, infinity and null become ``fill``; the column type is kept."""
    c = as_column(column)
    value = F.lit(fill).cast(data_type)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return F.when(is_invalid_number(c, data_type), value).otherwise(F.coalesce(c, value))
    return F.coalesce(c, value)


def strictly_above(score, threshold) -> Column:
    """Decision rule of the evaluation reports."""
    return (as_column(score) > threshold).cast("int")


def at_or_above(score, threshold) -> Column:
    """Decision rule of scoring; differs from the reports exactly at the threshold."""
    return (as_column(score) >= threshold).cast("int")
