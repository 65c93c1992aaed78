"""Registration and small helpers shared by the query modules."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.columns import as_column


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CATALOG: dict[str, Query] = {}


def query(key: str, sql: str | None = None):
    def register(fn):
        if key in CATALOG:
            raise ValueError(f"query {key} is registered twice")
        CATALOG[key] = Query(fn, sql)
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Averages of amounts with few decimals often end in exactly 5, where the last bit of a
# floating-point sum decides the rounding. Both sides shift values a little before rounding.
SHIFT = 0.0000137


def rounded(column, digits: int = 4) -> Column:
    return F.round(as_column(column) + F.lit(SHIFT), digits)


def rounded_table(df: DataFrame, digits: int = 4) -> DataFrame:
    """All floats rounded as in the SQL check; integers as long."""
    out = []
    for f in df.schema.fields:
        c = as_column(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = rounded(c.cast("double"), digits)
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("long")
        out.append(c.alias(f.name))
    return df.select(*out)


def r(expression: str, digits: int = 4) -> str:
    """The same rounding in SQL."""
    return f"round(CAST({expression} AS DOUBLE) + {SHIFT}, {digits})"
