"""Column naming rules."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame

from riskloom.functions.columns import as_column

__all__ = ["tidy_name", "tidy_columns", "add_prefix"]


def tidy_name(name: str) -> str:
    """Letters, digits and single underscores only."""
    return re.sub("_+", "_", re.sub("[^0-9A-Za-z_]+", "_", str(name)).strip("_"))


def tidy_columns(df: DataFrame) -> DataFrame:
    names = [tidy_name(c) for c in df.columns]
    clashes = [n for n, times in Counter(names).items() if times > 1]
    if clashes:
        raise ValueError(f"cleaned column names collide: {sorted(clashes)}")
    return df.toDF(*names)


def add_prefix(df: DataFrame, prefix: str, keep: set[str] | list[str] | tuple[str, ...]) -> DataFrame:
    return df.select([as_column(c) if c in keep else as_column(c).alias(prefix + c) for c in df.columns])
