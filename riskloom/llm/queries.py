"""Registered queries of the text operators. Each applies one operator to its whole table and derives the digest columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.catalog.registry import Query, table
from riskloom.llm import sql
from riskloom.llm.chat import rotate_perspectives
from riskloom.llm.class_ngrams import score_texts
from riskloom.llm.conversation_trie import conversation_trie
from riskloom.llm.decontaminate import find_contamination
from riskloom.llm.line_dedup import dedup_lines
from riskloom.llm.order_minhash import fingerprint_documents
from riskloom.llm.piece_tokens import encode_and_decode
from riskloom.llm.resample import resample
from riskloom.llm.secrets import BASE, RULES, find_secrets
from riskloom.llm.simhash import near_duplicates
from riskloom.llm.substring_dedup import dedup_substrings
from riskloom.llm.token_counts import count_tokens
from riskloom.llm.toxicity import score_toxicity

PIECES = "piece_bpe_32k.model"
BYTES = "byte_bpe_50k.json"
QUERIES: dict[str, Query] = {}


def query(key: str, text: str | None = None):
    def register(fn):
        QUERIES[key] = Query(fn, text)
        return fn

    return register


def tokenizer_path(name: str) -> str:
    from public_tokenizers import path

    return path(name)


def digest(text: str | Column) -> Column:
    return F.sha2(F.col(text) if isinstance(text, str) else text, 256)


@query("op1_substring_dedup", sql.SUBSTRINGS)
def substrings(spark: SparkSession, folder: str) -> DataFrame:
    out = dedup_substrings(table(spark, folder, "documents"))
    return out.select("doc_id", "n_words", "n_removed", digest("kept_text").alias("kept_sha256"))


@query("op2_order_minhash")
def order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    out = fingerprint_documents(table(spark, folder, "documents"))
    return out.select("doc_id", "n_chars", digest("edited").alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@query("op3_perspective_rotation", sql.PERSPECTIVES)
def perspectives(spark: SparkSession, folder: str) -> DataFrame:
    return rotate_perspectives(table(spark, folder, "conversations"))


def _listed(spans: str | Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query("op4_secrets", sql.secrets(RULES, BASE))
def secrets(spark: SparkSession, folder: str) -> DataFrame:
    out = find_secrets(table(spark, folder, "documents"))
    base = [r.kind for r in RULES[:BASE]]

    def of_kind(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return out.select(
        "doc_id", *map(of_kind, base), digest(_listed(F.filter("spans", lambda s: s["kind"].isin(*base)))).alias("base_sha256"), _listed("spans").alias("spans"))


@query("op5_decontamination", sql.CONTAMINATION)
def contamination(spark: SparkSession, folder: str) -> DataFrame:
    out = find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        digest(F.array_join("item_ids", ",")).alias("items_sha256"), "contaminated")


@query("op6_simhash")
def simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


@query("op7_line_dedup", sql.LINES)
def lines(spark: SparkSession, folder: str) -> DataFrame:
    out = dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", digest("kept_text").alias("kept_sha256"))


@query("op8_piece_tokens")
def piece_tokens(spark: SparkSession, folder: str) -> DataFrame:
    out = encode_and_decode(table(spark, folder, "documents").select("doc_id", "text"), tokenizer_path(PIECES))
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest(ids).alias("ids_sha256"), digest("decoded").alias("decoded_sha256"))


@query("op9_toxicity")
def toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return score_toxicity(docs, table(spark, folder, "labels")).select("doc_id", "held_out", "score", "predicted", "offending")


@query("op10_class_ngrams")
def class_ngrams(spark: SparkSession, folder: str) -> DataFrame:
    return score_texts(table(spark, folder, "documents"))


@query("op11_conversation_trie", sql.TRIE)
def trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie(table(spark, folder, "conversations")).drop("size")


@query("op12_target_resampling", sql.RESAMPLED)
def target_resampling(spark: SparkSession, folder: str) -> DataFrame:
    out = resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


@query("op13_token_counts")
def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    with open(tokenizer_path(BYTES), encoding="utf-8") as file:
        return count_tokens(table(spark, folder, "documents"), file.read())
