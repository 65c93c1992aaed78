"""The corpus pipeline: stages over documents, each applied to all that the one before it kept.

Every stage takes and returns the columns of documents (doc_id, text, lang, source, n_chars), the last returns the
encoded texts. run() writes what a stage returns to the shared folder and reads it again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.decontaminate import find_contamination
from riskloom.llm.line_dedup import dedup_lines
from riskloom.llm.piece_tokens import encode_and_decode
from riskloom.llm.queries import PIECES, tokenizer_path
from riskloom.llm.simhash import near_duplicates
from riskloom.llm.toxicity import score_toxicity
from riskloom.session import settle

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def _numbered(docs: DataFrame) -> DataFrame:
    """Documents with a number of their own for each row, written so that it stays the same; ids may be missing or repeated."""
    return settle(_documents(docs).withColumn("row", F.monotonically_increasing_id()), "rows")


def _by_row(rows: DataFrame) -> DataFrame:
    """What an operator needs to decide on each row: its text, and its number in place of the id."""
    return rows.select(F.col("row").alias("doc_id"), "text")


def _but(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows without those of the given numbers."""
    return _documents(rows.join(gone.select("row"), "row", "left_anti"))


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic."""
    scored = score_toxicity(_documents(docs), spark.read.parquet(f"{sf_dir}/labels.parquet"), keep_text=True)
    return scored.where(F.col("predicted") == 0).select("doc_id", *(f"rest.{c}" for c in COLUMNS[1:]))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that others repeat; their length is counted anew."""
    out = dedup_lines(_documents(docs))
    return out.select("doc_id", F.col("kept_text").alias("text"), "rest.lang", "rest.source", F.length("kept_text").cast("long").alias("n_chars"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row, that with the smallest id; a row without id comes before all others.

    Of several rows with that id the one with the smallest hash of all columns stays.
    """
    rows = _numbered(docs)
    found = near_duplicates(_by_row(rows)).select(F.col("doc_id").alias("row"), "component_id")
    order = rows.select("row", F.struct("doc_id", F.xxhash64(*COLUMNS).alias("hash"), "row").alias("place"))
    kept = found.join(order, "row").groupBy("component_id").agg(F.min("place").alias("first")).select(F.col("first.row").alias("row"))
    return _but(rows, rows.select("row").join(kept, "row", "left_anti"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs; every row is judged by its own text."""
    rows = _numbered(docs)
    found = find_contamination(_by_row(rows), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _but(rows, found.where("contaminated").select(F.col("doc_id").alias("row")))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every remaining text, with the text that they decode to."""
    out = encode_and_decode(_documents(docs), tokenizer_path(PIECES))
    return out.select("doc_id", F.col("decoded").alias("text"), "rest.lang", "rest.source", "rest.n_chars", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("piece_tokens", encoded),
]

#: The stages learn a classifier, hash with XXH64 and run a tokenizer, none of which SQL expresses; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
