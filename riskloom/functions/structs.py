"""Nested columns to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.columns import as_column


def _leaves(schema: T.StructType, parent: Column | None, path: str) -> list[tuple[str, Column]]:
    found = []
    for f in schema.fields:
        column = as_column(f.name) if parent is None else parent.getField(f.name)
        name = f"{path}.{f.name}" if path else f.name
        if isinstance(f.dataType, T.StructType):
            found += _leaves(f.dataType, column, name)
        elif isinstance(f.dataType, T.NumericType):
            found.append((name, column.cast("double")))
    return found


def numeric_fields(df: DataFrame, key: str) -> DataFrame:
    """(key, metric, value): one row per numeric leaf, nested names joined by dots."""
    rest = T.StructType([f for f in df.schema.fields if f.name != key])
    entries = [F.struct(F.lit(n).alias("metric"), c.alias("value")) for n, c in _leaves(rest, None, "")]
    return df.select(as_column(key), F.explode(F.array(*entries)).alias("e")).select(as_column(key), "e.metric", "e.value")
