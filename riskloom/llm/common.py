"""What the text operators share: places of rows, Arrow chunks of texts, word hashes."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NO_ID = -(2**63)
WORDS = r"[^\x20\x09-\x0D]+"
#: Text bytes that a task turns into arrays at one time; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20


def slim(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` (long; rows without one come before all others) and ``text`` (null as the empty text)."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def real_id(column: str = "doc_id") -> Column:
    """The id as it was given, null where there was none."""
    return F.nullif(F.col(column), F.lit(NO_ID)).alias("doc_id")


def lower_ascii(column: Column) -> Column:
    """A-Z in lower case; every other character stays."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


ASCII_LOWER = {upper: upper + 32 for upper in range(65, 91)}


def chunks(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, int]]:
    """Row ranges of about CHUNK_BYTES of text each."""
    sizes = np.asarray(pc.binary_length(batch.column(column)).fill_null(0), dtype=np.int64)
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > CHUNK_BYTES:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in one array, and the offset at which each text starts (one more at the end)."""
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (multiply and xor-shift)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_RNG = np.random.default_rng(20)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE[_SPACE] = 0
_IN_WORD = 0x9E3779B97F4A7C15
_OVER_WORDS = 0xC2B2AE3D27D4EB4F


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), base % 2**64, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (a run without ASCII white space) of all texts, and the word offset at which each text starts."""
    blank = _SPACE[raw]
    first = ~blank
    first[1:] &= blank[:-1]
    heads = at[:-1][at[:-1] < at[1:]]
    first[heads] = ~blank[heads]
    starts = np.flatnonzero(first)
    per_text = np.searchsorted(starts, at)
    if not len(starts):
        return np.zeros(0, np.uint64), per_text
    ends = np.append(starts[1:], len(raw))
    place = np.arange(len(raw)) - np.repeat(starts, ends - starts)[: len(raw)] if starts[0] == 0 else None
    if place is None:
        place = np.zeros(len(raw), np.int64)
        place[starts[0]:] = np.arange(starts[0], len(raw)) - np.repeat(starts, ends - starts)
    value = _BYTE[raw] * powers(_IN_WORD, int(place.max()) + 1)[place]
    return mixed(np.add.reduceat(value, starts)), per_text


class Spans:
    """Hashes of word ranges of one array of word hashes, each in constant time."""

    def __init__(self, words: np.ndarray, salt: int = 0):
        base = (_OVER_WORDS + 2 * salt) % 2**64
        n = len(words) + 1
        self._back = powers(pow(base, -1, 2**64), n)
        values = mixed(words ^ np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)) * powers(base, n)[:-1]
        self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self._sums[end] - self._sums[start]) * self._back[start] + (end - start).astype(np.uint64))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def text_mark(text: bytes) -> int:
    """31 bits that tell apart different texts under one doc_id."""
    return zlib.crc32(text) >> 1


def run_starts(*columns: np.ndarray) -> np.ndarray:
    """True where a row differs from the row before it in any column."""
    out = np.zeros(len(columns[0]), bool)
    if len(out):
        out[0] = True
        for c in columns:
            out[1:] |= c[1:] != c[:-1]
    return out


def packed(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """``doc_id`` (long), ``text`` (null as empty) and, if there are more columns, all of them in one struct ``rest``.

    With ``keep_text`` the struct holds the text as it was given, too.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != "doc_id" and (keep_text or c != "text")]
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *([F.struct(*others).alias("rest")] if others else []),
    )


def schema_with(df: DataFrame, **columns: str) -> str:
    """DDL of doc_id, the given columns and, where ``df`` has it, ``rest``."""
    rest = [f"rest {f.dataType.simpleString()}" for f in df.schema.fields if f.name == "rest"]
    if rest:
        inner = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in df.schema["rest"].dataType.fields)
        rest = [f"rest struct<{inner}>"]
    return ", ".join(["doc_id long", *(f"{k} {v}" for k, v in columns.items()), *rest])


def carried(batch: pa.RecordBatch, start: int, size: int, **columns: pa.Array) -> pa.RecordBatch:
    """Rows of a batch with doc_id, new columns and ``rest`` as it was."""
    names = ["doc_id", *columns, *(["rest"] if "rest" in batch.schema.names else [])]
    return pa.RecordBatch.from_arrays([columns[n] if n in columns else batch.column(n).slice(start, size) for n in names], names)



def zipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id``, the mark of the text, and the text as zstd frames, for a shuffle of whole texts."""
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        for a, b in chunks(batch):
            part = batch.slice(a, b - a)
            raw = [t.as_buffer() for t in part.column("text")]
            packed, marks = pa.array([press.compress(t) for t in raw], pa.binary()), pa.array([text_mark(t) for t in raw], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), marks, packed], ["doc_id", "mark", "zip"])


def unzipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about a chunk each, with the text in place of its frame."""
    press = zstandard.ZstdDecompressor()
    for batch in batches:
        for a, b in chunks(batch, "zip"):
            part = batch.slice(a, b - a)
            texts = [press.decompress(z.as_buffer()) for z in part.column("zip")]
            names = [n for n in part.schema.names if n != "zip"]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()).cast(pa.string()), *(part.column(n) for n in names)], ["text", *names])
