"""Removal of lines that many documents hold, with two Bloom filters before the exact count.

The first pass puts the hash of every line into two filters, one for hashes seen once and one for hashes seen again.
Each task fills its own pair; pairs are merged by segments of the bit range, where a bit counts as seen again if it was
so in either pair, or seen once in both. Both filters have a fixed number of bits, so their size does not grow with the
data; a fuller filter lets more lines through to the shuffle and never loses a repeat.

The second pass lets only suspected repeats out, as (line key, document). They are counted exactly, by the key itself,
and the documents that must drop a line get the key back.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import common as C
from riskloom.session import settle

SEGMENT = 1 << 16


def line_key(line: bytes) -> bytes:
    """ASCII white space stripped at both ends, A-Z in lower case."""
    return line.strip().lower()


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (key.isascii() or len(key.decode()) >= least)


def _keys(text: str, least: int) -> set[bytes]:
    return {k for k in map(line_key, text.encode().split(b"\n")) if _long_enough(k, least)}


class SeenTwice:
    """Two Bloom filters of ``bits`` bits with two probes each: hashes seen once, and hashes seen again."""

    def __init__(self, bits: int):
        self.bits = bits
        self.once, self.again = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)

    @staticmethod
    def probes(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        low, high = hashes & np.uint64(bits - 1), (hashes >> np.uint64(32)) & np.uint64(bits - 1)
        return low.astype(np.int64), high.astype(np.int64)

    @staticmethod
    def holds(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        a, b = SeenTwice.probes(hashes, table.size * 8)
        return ((table[a >> 3] >> (a & 7).astype(np.uint8)) & (table[b >> 3] >> (b & 7).astype(np.uint8)) & 1).astype(bool)

    def _put(self, table: np.ndarray, hashes: np.ndarray) -> None:
        for at in self.probes(hashes, self.bits):
            np.bitwise_or.at(table, at >> 3, np.left_shift(np.uint8(1), (at & 7).astype(np.uint8)))

    def add(self, hashes: np.ndarray) -> None:
        each, n = np.unique(hashes, return_counts=True)
        self._put(self.again, each[(n > 1) | self.holds(self.once, each)])
        self._put(self.once, each)

    def segments(self) -> Iterator[tuple[int, bytes]]:
        for i in range(0, self.once.size, SEGMENT):
            once = self.once[i:i + SEGMENT]
            if once.any():
                yield i // SEGMENT, zlib.compress(once.tobytes() + self.again[i:i + SEGMENT].tobytes(), 1)


def _hashes(keys) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))


def _fill(least: int, bits: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = SeenTwice(bits)
        for batch in batches:
            texts = batch.column("text")
            for a, b in C.chunks(batch):
                seen.add(_hashes([k for i in range(a, b) for k in _keys(texts[i].as_py(), least)]))
        for segment, packed in seen.segments():
            yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([packed], pa.binary())], ["segment", "filters"])

    return rows


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by segment; one pair of filters is held at a time."""
    now, once, again = None, None, None

    def out():
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([zlib.compress(again.tobytes(), 1)], pa.binary())], ["segment", "again"])

    for batch in batches:
        for segment, filters in zip(batch.column("segment").to_pylist(), batch.column("filters")):
            pair = np.frombuffer(zlib.decompress(filters.as_py()), np.uint8).reshape(2, -1)
            if segment != now:
                if now is not None:
                    yield out()
                now, once, again = segment, pair[0].copy(), pair[1].copy()
            else:
                again |= pair[1] | (once & pair[0])
                once |= pair[0]
    if now is not None:
        yield out()


def _suspects(least: int, filters):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, parts = filters.value
        again = np.zeros(bits // 8, np.uint8)
        for segment, packed in parts.items():
            part = np.frombuffer(zlib.decompress(packed), np.uint8)
            again[segment * SEGMENT:segment * SEGMENT + part.size] = part
        for batch in batches:
            texts, ids = batch.column("text"), np.asarray(batch.column("doc_id"), dtype=np.int64)
            for a, b in C.chunks(batch):
                per_doc = [list(_keys(texts[i].as_py(), least)) for i in range(a, b)]
                keys = [k for own in per_doc for k in own]
                hit = SeenTwice.holds(again, _hashes(keys))
                if hit.any():
                    doc = np.repeat(ids[a:b], [len(own) for own in per_doc])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k for k, h in zip(keys, hit) if h], pa.binary()), pa.array(doc[hit])], ["key", "doc_id"])

    return rows


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, drops = batch.column("text"), batch.column("drops")
        n_lines, n_dropped, kept = [], [], []
        for i in range(batch.num_rows):
            lines = texts[i].as_py().encode().split(b"\n")
            gone = set(drops[i].as_py() or ())
            stay = [x for x in lines if line_key(x) not in gone] if gone else lines
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(stay))
            kept.append(b"\n".join(stay).decode())
        yield C.carried(batch, 0, batch.num_rows, n_lines=pa.array(n_lines, pa.int64()), n_dropped=pa.array(n_dropped, pa.int64()), kept_text=pa.array(kept, pa.string()))


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, filter_bits: int = 1 << 27) -> DataFrame:
    """Texts without the lines whose key is in ``min_docs`` documents or more; the largest doc_id keeps its copies.

    A line's key is the line stripped of ASCII white space with A-Z in lower case; keys shorter than ``min_chars`` code
    points stay everywhere. Result, one row per input row: doc_id, n_lines (before), n_dropped, kept_text and, if the
    input has more columns, those in the struct ``rest``.

    A null or empty text is one empty line. Rows without doc_id are neither counted nor cut. Rows that share a doc_id
    count as one document and lose the same keys. ``filter_bits`` (a power of two up to 2**32) fixes the size of each
    filter: 16 MiB at the default, which the driver merges and every worker holds.
    """
    if filter_bits < 8 * SEGMENT or filter_bits & (filter_bits - 1) or filter_bits > 1 << 32:
        raise ValueError(f"filter_bits must be a power of two from {8 * SEGMENT} to 2**32")
    if min_docs < 2:
        raise ValueError("min_docs must be at least 2: the filters find lines that occur again")
    texts = C.packed(docs)
    named = texts.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    merged = (
        named.mapInArrow(_fill(min_chars, filter_bits), "segment int, filters binary")
        .repartition("segment").sortWithinPartitions("segment").mapInArrow(_merge, "segment int, again binary")
    )
    filters = docs.sparkSession.sparkContext.broadcast((filter_bits, {r.segment: bytes(r.again) for r in merged.collect()}))
    suspects = named.mapInArrow(_suspects(min_chars, filters), "key binary, doc_id long")
    # written, so that the join below reads a plain table and adaptive execution can split a line that very many documents hold
    repeated = settle(suspects.groupBy("key").agg(F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("keeper")).where(F.col("n") >= min_docs), "repeated-lines")
    drops = (
        suspects.join(repeated, "key").where(F.col("doc_id") < F.col("keeper"))
        .groupBy("doc_id").agg(F.collect_list("key").alias("drops"))
    )
    schema = C.schema_with(texts, n_lines="long", n_dropped="long", kept_text="string")
    return texts.join(drops, "doc_id", "left").mapInArrow(_cut, schema)
