"""SQL text for projections and aggregates over hundreds of columns.

One text per column costs one parse; the same expression built from column
objects costs a driver round trip per operator, which adds up to minutes on
wide feature tables.
"""

from __future__ import annotations

import math

from pyspark.sql import types as T

__all__ = ["name", "text", "number", "finite_text", "invalid_text"]


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def text(value) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def number(value: float) -> str:
    value = float(value)
    if math.isnan(value) or math.isinf(value):
        return f"CAST('{value}' AS DOUBLE)"
    return f"{value!r}D"


def _is_float(kind: T.DataType) -> bool:
    return isinstance(kind, (T.DoubleType, T.FloatType))


def invalid_text(column: str, kind: T.DataType) -> str:
    """True for NaN and both infinities, false for null; only floats can be invalid."""
    if not _is_float(kind):
        return "false"
    c = name(column)
    return f"coalesce(isnan({c}) OR abs({c}) = CAST('Infinity' AS DOUBLE), false)"


def finite_text(column: str, kind: T.DataType, fill: float = 0) -> str:
    """NaN, infinity and null become ``fill``; the column type is kept."""
    c, value = name(column), f"CAST({number(fill)} AS {kind.simpleString()})"
    if _is_float(kind):
        return f"CASE WHEN {invalid_text(column, kind)} THEN {value} ELSE coalesce({c}, {value}) END"
    return f"coalesce({c}, {value})"
