"""Writing result tables and reports."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from riskloom.functions.columns import as_column
from riskloom.session import settle

FORMATS = ("parquet", "csv", "json")


def write_table(df: DataFrame, path: str, kind: str = "parquet", partition_by: list[str] | None = None) -> str:
    """Overwrite ``path`` with the table. Parquet keeps the types; CSV carries a header."""
    if kind not in FORMATS:
        raise ValueError(f"unknown table format {kind!r}; known: {FORMATS}")
    writer = df.write.mode("overwrite").format(kind)
    if kind == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def write_document(spark: SparkSession, payload: Mapping, path: str) -> str:
    """A small nested report (manifest, metrics, fitted state) as one JSON line."""
    spark.createDataFrame([(json.dumps(payload, default=str),)], "document string").coalesce(1).write.mode("overwrite").text(path)
    return path


def read_document(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=False).first()[0])


def write_submission(scored: DataFrame, source: DataFrame, path: str, key: str, target: str, probability: str, kind: str = "parquet") -> str:
    """(key, probability as target) for every row of the scored table, none lost.

    The rows are counted before ``path`` is touched.
    """
    if target in source.columns:
        raise ValueError(f"{target} must not be part of the rows to score")
    out = settle(scored.select(as_column(key), as_column(probability).alias(target)), "submission")
    held, expected = out.count(), source.count()
    if held != expected:
        raise ValueError(f"{held} scored rows for {expected} rows to score; {path} was not written")
    return write_table(out, path, kind)


def write_reports(tables: Mapping[str, DataFrame], folder: str, kind: str = "parquet") -> dict[str, str]:
    return {name: write_table(df, f"{folder.rstrip('/')}/{name}", kind) for name, df in tables.items()}
