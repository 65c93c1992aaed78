"""Toxicity by multiple-instance learning: sentence probabilities, joined by noisy-or, fitted to labels of documents.

A document is a bag of sentences. p = sigmoid(bias + weights of the sentence's distinct words) is the probability that a
sentence is offensive, and a document is toxic unless every sentence is harmless: P = 1 - product(1 - p). The weights are
fitted to document labels through P, so that the fit itself finds which sentences carry the label.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import fsum

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm import common as C
from riskloom.session import settle

SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
BEGINNINGS = (4, 5, 6, 7)
WORD = re.compile(r"\w+")
#: Words whose features a worker remembers.
REMEMBERED = 300_000
OFFENDING = "array<struct<start: long, end: long, probability: double>>"


def held_out(doc_id: Column, folds: int = 5, fold: int = 0) -> Column:
    """True for rows that labels are never learnt from; a row without id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def features(word: str) -> tuple[str, ...]:
    """The word, and its beginnings where it is longer (marked by a hyphen)."""
    return (word, *(word[:k] + "-" for k in BEGINNINGS if len(word) > k))


def sentences(text: str) -> list[tuple[int, int, list[str]]]:
    """Start, end and words of every sentence with a word."""
    found = ((m.start(), m.end(), WORD.findall(m.group().lower())) for m in SENTENCE.finditer(text))
    return [x for x in found if x[2]]


class NoisyOr:
    """Weights of features and the bias of a sentence."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias
        self._met: dict[str, tuple[str, ...]] = {}

    def _weighted(self, word: str) -> tuple[str, ...]:
        if len(self._met) >= REMEMBERED:
            self._met.clear()
        out = self._met[word] = tuple(f for f in features(word) if f in self.weights)
        return out

    def probabilities(self, bag: list[tuple[int, int, list[str]]]) -> np.ndarray:
        """Probability of each sentence; a feature counts once in a sentence."""
        met, weighted, weight = self._met.get, self._weighted, self.weights
        z = np.full(len(bag), self.bias)
        for i, (_, _, words) in enumerate(bag):
            own = set()
            for w in words:
                known = met(w)
                if known is None:
                    known = weighted(w)
                if known:
                    own.update(known)
            if own:
                z[i] += fsum(weight[f] for f in own)
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    @staticmethod
    def either(p: np.ndarray) -> float:
        return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())) if len(p) else 0.0


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts, and how many toxic ones, hold each feature."""
    seen, bad = Counter(), Counter()

    def out():
        names = list(seen)
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([seen[f] for f in names], pa.int64()), pa.array([bad[f] for f in names], pa.int64())], ["feature", "seen", "bad"])

    for batch in batches:
        for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
            own = {f for _, _, words in sentences(text.as_py()) for w in words for f in features(w)}
            seen.update(own)
            if toxic:
                bad.update(own)
            if len(seen) > REMEMBERED:
                yield out()
                seen.clear()
                bad.clear()
    if seen:
        yield out()


def associated_features(sample: DataFrame, least_texts: int = 3, least_score: float = 4.0, most: int = 20_000) -> list[str]:
    """Features that go with the label beyond chance, the strongest first; the rest could only explain single documents."""
    n, k = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not k:
        return []
    counts = sample.mapInArrow(_count_features, "feature string, seen long, bad long").groupBy("feature").agg(F.sum("seen").alias("seen"), F.sum("bad").alias("bad"))
    expected = F.col("seen") * (k / n)
    score = (F.col("bad") - expected) / F.sqrt(expected * (1 - k / n) + 0.25)
    strong = counts.where(F.col("seen") >= least_texts).withColumn("score", score).where(F.col("score") >= least_score)
    return [r.feature for r in strong.orderBy(F.desc("score"), "feature").limit(most).collect()]


BAGS = "toxic int, quiet long, sizes array<int>, active array<int>"


def _bags(index):
    """Per text: the sentences without any known feature, and the known features of the others, sentence after sentence."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for batch in batches:
            quiet, sizes, active = [], [], []
            for text in batch.column("text"):
                found = [{own[f] for w in words for f in features(w) if f in own} for _, _, words in sentences(text.as_py())]
                held = [sorted(x) for x in found if x]
                quiet.append(len(found) - len(held))
                sizes.append([len(x) for x in held])
                active.append([f for x in held for f in x])
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(quiet, pa.int64()), pa.array(sizes, pa.list_(pa.int32())), pa.array(active, pa.list_(pa.int32()))],
                ["toxic", "quiet", "sizes", "active"])

    return rows


def fit(names: list[str], bags: list, rounds: int = 400, rate: float = 0.05, decay: float = 3e-5, unexplained: float = 0.02) -> NoisyOr:
    """Adam on the log-likelihood of the document labels, with weights held small.

    A bag is (toxic, quiet, sizes, active) as above. ``unexplained`` is the share of toxic labels taken to have no
    sentence that accounts for them; it is no part of a score. Without features every score is 0.
    """
    if not names:
        return NoisyOr({}, -40.0)
    y = np.array([bool(b[0]) for b in bags])
    quiet = np.array([b[1] for b in bags], float)
    doc = np.repeat(np.arange(len(bags)), [len(b[2]) for b in bags])
    row = np.repeat(np.arange(len(doc)), np.array([k for b in bags for k in b[2]], np.int64))
    column = np.array([f for b in bags for f in b[3]], np.int64)
    weights = np.zeros(len(names) + 1)
    weights[-1] = np.log(max(y.mean(), 1e-3) / ((quiet.sum() + len(doc)) / len(y))) - 1
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, weights[column], len(doc)) + weights[-1], -30, 30)))
        still = 1 / (1 + np.exp(-weights[-1]))
        none = (1 - unexplained) * np.exp(np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-12)), len(y)) + quiet * np.log1p(-still))
        pull = np.where(y, -none / np.maximum(1 - none, 1e-9), 1.0) / len(y)
        pulls = pull[doc] * p
        slope = np.append(np.bincount(column, pulls[row], len(names)) + decay * weights[:-1], pulls.sum() + (pull * quiet).sum() * still)
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        weights -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-6)
    return NoisyOr({f: float(w) for f, w in zip(names, weights) if abs(w) > 1e-3}, float(weights[-1]))


def learn(docs: DataFrame, labels: DataFrame, rows: int, chars: int) -> NoisyOr:
    """Counts and bags are made by tasks; the driver gets the bags' feature numbers, not the texts."""
    sample = settle(training_sample(docs, labels, rows, chars), "labelled")
    names = associated_features(sample)
    index = docs.sparkSession.sparkContext.broadcast({f: i for i, f in enumerate(names)})
    return fit(names, [tuple(r) for r in sample.mapInArrow(_bags(index), BAGS).collect()] if names else [])


def _scores(model, least: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: NoisyOr = model.value
        for batch in batches:
            score, found = [], []
            for text in batch.column("text"):
                bag = sentences(text.as_py())
                p = own.probabilities(bag)
                score.append(own.either(p))
                found.append([{"start": s, "end": e, "probability": q} for (s, e, _), q in zip(bag, p.tolist()) if q >= least])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))
            yield C.carried(batch, 0, batch.num_rows, score=pa.array(score, pa.float64()), offending=pa.array(found, kind))

    return rows


def training_sample(docs: DataFrame, labels: DataFrame, rows: int, chars: int) -> DataFrame:
    """Texts and labels of at most ``rows`` labelled documents outside the held-out fold, drawn by a hash of the id."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    texts = C.packed(docs).select("doc_id", "text").where(F.length("text") <= chars)
    return texts.join(F.broadcast(known), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("doc_id", "text", "toxic")


def score_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, sample_chars: int = 20_000, sentence_threshold: float = 0.5, keep_text: bool = False) -> DataFrame:
    """Probability that each whole text is toxic, and the sentences that make it so.

    Learns from ``labels.toxic`` of rows whose crc32(doc_id as text) mod 5 is not 0, on a bounded sample: at most
    ``sample_rows`` labelled documents of at most ``sample_chars`` code points each, drawn by a hash of the id. Tasks turn
    them into counts and feature numbers, and the driver fits the weights. All documents are scored, whole, in parallel; labels and other columns play no part in a score.

    Result, one row per input row: doc_id, held_out, score (0 to 1), predicted (1 from 0.5), offending (start, end in
    code points and probability of each sentence at or above ``sentence_threshold``) and, if the input has more columns,
    those (with ``keep_text`` the text too) in the struct ``rest``. Null and empty texts have no sentence and score 0. Of repeated labels the largest
    counts, rows without label or id teach nothing, and without any positive label every score is 0.
    """
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, sample_rows, sample_chars))
    texts = C.packed(docs, keep_text)
    scored = texts.mapInArrow(_scores(model, sentence_threshold), C.schema_with(texts, score="double", offending=OFFENDING))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
        "offending", *(["rest"] if "rest" in scored.columns else []))
