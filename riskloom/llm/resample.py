"""Importance resampling towards a target distribution, with exact ranks by parallel sorting by regular sampling."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import common as C
from riskloom.session import settle

#: Regular samples per segment, and rows that a segment is meant to hold.
OVERSAMPLE, SEGMENT_ROWS = 32, 1_000_000
#: Words are hashed byte by byte, all at once, up to this length; the rest of longer ones goes through zlib.
IN_STEP = 64

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, _CRC >> 1 ^ np.uint32(0xEDB88320), _CRC >> 1)
_ONES = np.uint32(0xFFFFFFFF)


def words_of(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and size in bytes of every word of all texts; words do not reach across texts."""
    inside = _WORD[raw]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    heads = at[:-1][at[:-1] < at[1:]]
    first[heads] = inside[heads]
    ends = at[1:][at[:-1] < at[1:]] - 1
    last[ends] = inside[ends]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1 - starts


def crc_over(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray, state: np.ndarray) -> np.ndarray:
    """CRC-32 registers after the bytes of each word."""
    order = np.argsort(-np.minimum(sizes, IN_STEP).astype(np.int16), kind="stable")
    begin, size, now = starts[order], sizes[order], state[order]
    shorter = -np.minimum(size, IN_STEP)
    for p in range(min(int(size.max(initial=0)), IN_STEP)):
        n = np.searchsorted(shorter, -p)
        now[:n] = _CRC[(now[:n] ^ raw[begin[:n] + p]) & 255] ^ now[:n] >> 8
    for i in range(np.searchsorted(shorter, -IN_STEP, "right")):
        if size[i] > IN_STEP:
            now[i] = zlib.crc32(raw[begin[i] + IN_STEP:begin[i] + size[i]].tobytes(), int(now[i] ^ _ONES)) ^ 0xFFFFFFFF
    out = np.empty_like(now)
    out[order] = now
    return out


def features(raw: np.ndarray, at: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all words, of all word pairs by their second word, whether a word has one before it, and words up to each text."""
    low = _FOLD[raw]
    starts, sizes = words_of(low, at)
    upto = np.searchsorted(starts, at)
    single = crc_over(low, starts, sizes, np.full(len(starts), _ONES))
    before = np.append(_ONES, single[:-1])[:len(single)]
    blank = _CRC[(before ^ np.uint32(32)) & 255] ^ before >> 8
    double = crc_over(low, starts, sizes, blank)
    paired = np.ones(len(starts), bool)
    paired[upto[:-1][upto[:-1] < upto[1:]]] = False
    return (single ^ _ONES) % np.uint32(buckets), (double ^ _ONES) % np.uint32(buckets), paired, upto


def _counted(buckets: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            for a, b in C.chunks(batch):
                single, double, paired, _ = features(*C.bytes_of(batch.column("text").slice(a, b - a)), buckets)
                n += np.bincount(single, minlength=buckets) + np.bincount(double[paired], minlength=buckets)
        found = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(n[found], pa.int64())], ["bucket", "n"])

    return rows


def bucket_counts(docs: DataFrame, buckets: int) -> np.ndarray:
    """Features of all texts by bucket; one number per bucket comes to the driver."""
    out = np.zeros(buckets, np.int64)
    for r in docs.mapInArrow(_counted(buckets), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's share in the target and in the source, one added to every count."""
    s_all, t_all, n = float(source.sum()), float(target.sum()), len(source)
    pairs = zip(source.tolist(), target.tolist())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n)))) for s, t in pairs], np.int64)


def _weighed(gain: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in C.chunks(batch):
                single, double, paired, upto = features(*C.bytes_of(batch.column("text").slice(a, b - a)), len(gain))
                words = np.diff(upto)
                total = np.diff(np.concatenate([[0], np.cumsum(gain[single] + np.where(paired, gain[double], 0))])[upto])
                number = words + np.maximum(words - 1, 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), batch.column("mark").slice(a, b - a), pa.array(words, pa.int64()), pa.array(number, pa.int64()),
                     pa.array(total // np.maximum(number, 1), pa.int64())], ["doc_id", "mark", "n_words", "n_features", "weight"])

    return rows


ORDER = ("score", "doc_id", "mark", "place")
_FIELDS = "doc_id long, mark long, n_words long, n_features long, weight long, score long, place long"


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    """Order keys (score downwards, then upwards) as strings of 32 bytes that compare alike."""
    columns = np.stack([np.asarray(batch.column(c), dtype=np.int64) for c in ORDER], axis=1)
    columns[:, 0] *= -1
    flipped = columns.view(np.uint64) ^ np.uint64(1 << 63)
    return np.ascontiguousarray(flipped.astype(">u8")).view("S32").ravel()


def _regular(step: int):
    """Every step-th row of a sorted run; where it begins depends on the run's number, so that short runs have their share."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        skip = zlib.crc32(str(TaskContext.get().partitionId()).encode()) % step
        for batch in batches:
            taken = np.arange(skip, batch.num_rows, step)
            skip = (skip - batch.num_rows) % step
            yield batch.take(pa.array(taken, pa.int64()))

    return rows


def _dealt(splitters: np.ndarray, least_words: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            segment = np.searchsorted(splitters, _keys(batch), "right").astype(np.int32)
            segment[np.asarray(batch.column("n_words")) < least_words] = -1
            yield batch.append_column("segment", pa.array(segment, pa.int32()))

    return rows


def _ranked(offsets: dict[int, int], drawn: int):
    """Ranks of sorted segments: the rows of all segments before, and the place among the segment's own."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, count = -1, 0
        for batch in batches:
            segment = np.asarray(batch.column("segment"))
            starts = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))[:len(segment)]
            rank = np.zeros(len(segment), np.int64)
            for a, b in zip(starts.tolist(), np.append(starts[1:], len(segment)).tolist()):
                last, count = (last, count) if segment[a] == last else (int(segment[a]), 0)
                rank[a:b] = offsets[last] + count + 1 + np.arange(b - a)
                count += b - a
            yield batch.append_column("rank", pa.array(rank, pa.int64(), mask=rank > drawn))

    return rows


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, buckets: int = 10_000, seed: int = 7,
             segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Documents drawn without replacement in proportion to how much likelier they are under the target than here.

    Result, one row per row of ``docs``: doc_id, n_words, n_features, weight, score, rank. Words are runs of ASCII
    letters (lower-cased), digits and characters beyond ASCII; features are words and pairs, hashed into ``buckets``.
    A bucket's gain is the log ratio of its shares in target and source, in thousandths; the weight is the mean gain of
    a document, the score adds a Gumbel draw by the id. Of the N documents with at least ``least_words`` words the
    floor(percent * N / 100) best scores get the ranks 1, 2, 3...; all others null. Ties go to the smaller doc_id.

    Sorting: every task of the scored table is written as a sorted run; regular samples of the runs (OVERSAMPLE per
    segment) give the splitters; each segment gets its part of every run and merges it in one task; the counts of the
    segments before it make its places ranks. Segments behind the last drawn rank are not exchanged.

    Null texts have no words, and weight 0; an empty target has no features. Rows without doc_id share the draw of an
    empty id and come before all others among equal scores; rows of one id and score are ordered by a hash of the text,
    equal rows in any order. Other columns are not read.
    """
    if not 0 <= percent <= 100 or buckets < 1:
        raise ValueError("percent is from 0 to 100, and there is at least one bucket")
    spark = docs.sparkSession
    texts = C.slim(docs)
    wanted = target.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    gain = gains(bucket_counts(texts.select("text"), buckets), bucket_counts(wanted, buckets))
    number = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.when(F.col("doc_id") == C.NO_ID, "").otherwise(F.col("doc_id").cast("string"))), 256), 1, 8), 16, 10)
    draw = F.floor(-1000 * F.log(-F.log((number.cast("double") + 0.5) / 4294967296.0))).cast("long")
    scored = (
        texts.withColumn("mark", F.xxhash64("text")).mapInArrow(_weighed(gain), _FIELDS.split(", score")[0])
        .withColumn("score", F.col("weight") + draw).withColumn("place", F.monotonically_increasing_id())
    )
    runs = settle(scored.sortWithinPartitions(F.desc("score"), "doc_id", "mark", "place"), "runs")
    able = runs.where(F.col("n_words") >= least_words)
    total = able.count()
    segments = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // segment_rows))
    step = max(1, total // (OVERSAMPLE * segments))
    sample = able.select(*ORDER).mapInArrow(_regular(step), "score long, doc_id long, mark long, place long").toArrow().combine_chunks()
    found = np.sort(np.concatenate([_keys(b) for b in sample.to_batches()])) if sample.num_rows else np.zeros(0, "S32")
    splitters = np.unique(found[[len(found) * k // segments for k in range(1, segments)]]) if len(found) else found
    placed = runs.mapInArrow(_dealt(splitters, least_words), f"{_FIELDS}, segment int")
    counts = {r.segment: r["count"] for r in placed.where("segment >= 0").groupBy("segment").count().collect()}
    drawn, offsets, upto = percent * total // 100, {}, 0
    for s in sorted(counts):
        offsets[s] = upto
        upto += counts[s]
    cut = 1 + max((s for s, before in offsets.items() if before < drawn), default=-1)
    ranked = (
        placed.where(f"segment >= 0 and segment < {cut}").repartitionById(max(cut, 1), F.col("segment"))
        .sortWithinPartitions(F.desc("score"), "doc_id", "mark", "place").mapInArrow(_ranked(offsets, drawn), f"{_FIELDS}, segment int, rank long")
    )
    others = placed.where(f"segment < 0 or segment >= {cut}").withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(others).select(C.real_id(), "n_words", "n_features", "weight", "score", "rank")
