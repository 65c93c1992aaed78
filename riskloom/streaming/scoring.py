"""Stateless scoring of a stream with the batch scorer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from riskloom.functions.columns import at_or_above
from riskloom.operators.scoring import PREDICTION, PROBABILITY, Scorer, align_features


def open_stream(spark: SparkSession, folder: str, schema: StructType | str, kind: str = "json", files: str | None = None,
                files_per_batch: int | None = None) -> DataFrame:
    """Rows arriving as files in a folder, with a declared schema."""
    reader = spark.readStream.schema(schema).format(kind)
    if files:
        reader = reader.option("pathGlobFilter", files)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def score_stream(rows: DataFrame, scorer: Scorer, threshold: float = 0.5) -> DataFrame:
    """The batch scorer applied to a stream: projections only, no state, no watermark needed."""
    if scorer.key not in rows.columns:
        raise ValueError(f"streamed rows need their key {scorer.key}")
    aligned, _ = align_features(rows, scorer.inputs, scorer.key, scorer.target, allow_target=True, most_missing=None)
    return scorer.score_aligned(aligned).withColumn(PREDICTION, at_or_above(PROBABILITY, F.lit(float(threshold))))


def write_stream(scored: DataFrame, path: str, checkpoint: str, kind: str = "parquet", all_available: bool = True) -> StreamingQuery:
    """Exactly-once file output; with ``all_available`` the query ends when the input is used up."""
    writer = scored.writeStream.format(kind).outputMode("append").option("checkpointLocation", checkpoint)
    if all_available:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)
