"""Token counts of whole texts: a broadcast table of frequent pre-tokens, then caches in the workers for all others."""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import common as C

LETTER, NUMBER, OTHER, SPACE = range(4)
#: Longest pre-token, in bytes, that the table can hold; a key is these bytes themselves.
KEY_BYTES = 24
#: A task reports pre-tokens that make up at least one in so many of its own, hence at most so many of them.
REPORTED = 1 << 16
#: Distinct pre-tokens that a task counts at one time; beyond it the rarest half goes.
COUNTED = 1 << 18
#: Bounds of a worker's cache, the longest pre-token it keeps, and how many are looked up at one time.
CACHE_ENTRIES, CACHED_BYTES, AT_ONCE = 1 << 20, 256, 1 << 16


def _library(vocabulary: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _probed(tokenizer, points: list[int]) -> np.ndarray:
    """Classes of code points, each from whether the library parts it from a letter, a number and another character before it."""
    probe = "".join(f"a{c}1{c}!{c}\n" for c in map(chr, points))
    begins = np.zeros(len(probe) + 1, bool)
    begins[[at for _, (at, _) in tokenizer.pre_tokenizer.pre_tokenize_str(probe)]] = True
    parted = begins[:-1].reshape(-1, 7)[:, [1, 3, 5]]
    return np.select([~parted[:, 0], ~parted[:, 1], ~parted[:, 2]], [LETTER, NUMBER, OTHER], SPACE)


def character_classes(tokenizer) -> np.ndarray:
    """Letter, number, other or white space for every code point, as the library's own pre-tokenizer tells them apart.

    Unicode tables differ by version: a guess by ``regex`` is put to the library block by block, as one run per class,
    and blocks that it parts otherwise are probed character by character.
    """
    out = np.full(0x110000, OTHER, np.uint8)
    guesses = {kind: regex.compile(p) for kind, p in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (OTHER, r"[^\s\p{L}\p{N}]"), (SPACE, r"\s"))}
    for start in range(0, 0x110000, 1 << 12):
        points = [p for p in range(start, start + (1 << 12)) if not 0xD800 <= p < 0xE000]
        block, agreed = "".join(map(chr, points)), True
        for kind, guess in guesses.items():
            found = "".join(guess.findall(block))
            agreed &= not found or len(tokenizer.pre_tokenizer.pre_tokenize_str("a1!\t"[kind] + found)) == 1
            out[[ord(c) for c in found]] = kind
        if not agreed:
            out[points] = _probed(tokenizer, points)
    return out


@functools.lru_cache(2)
def _classes_of(vocabulary: str) -> np.ndarray:
    return character_classes(_library(vocabulary))


def _code_points(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and the byte at which each starts."""
    at = np.flatnonzero((raw & 0xC0) != 0x80)
    points = raw[at].astype(np.uint32)
    for least, size, bits in ((0xC0, 2, 0x1F), (0xE0, 3, 0x0F), (0xF0, 4, 0x07)):
        long = np.flatnonzero(raw[at] >= least)
        if not len(long):
            break
        value = raw[at[long]].astype(np.uint32) & bits
        for k in range(1, size):
            value = value << 6 | (raw[np.minimum(at[long] + k, len(raw) - 1)] & 0x3F)
        points[long] = value
    return points, at


def pieces(raw: np.ndarray, heads: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Bytes at which pre-tokens start. ``heads``: bytes at which texts (or their parts) start.

    The rule is that of byte-level BPE: contractions, runs of letters, numbers or other characters with at most one
    blank before them, and white space, the last of which goes on its own if something follows.
    """
    points, at = _code_points(raw)
    n = len(points)
    if not n:
        return at
    kind = classes[points]
    head = np.zeros(n + 4, bool)
    head[np.searchsorted(at, heads)] = True
    head[n:] = True
    cut = C.run_starts(kind) | head[:n]
    last = np.flatnonzero((kind == SPACE) & np.append(cut[1:], True) & ~head[1:n + 1])
    cut[last] = True
    cut[last[points[last] == 32] + 1] = False
    padded = np.append(points, np.zeros(4, points.dtype))
    quote = np.flatnonzero((points == 39) & cut & ~head[1:n + 1])
    one, two = padded[quote + 1], padded[quote + 2]
    short = np.isin(one, [ord(c) for c in "stmd"])
    pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    pair &= ~head[quote + 2]
    cut = np.append(cut, np.zeros(4, bool))
    cut[quote[short | pair] + 1] = False
    cut[quote[short] + 2] = True
    cut[quote[pair] + 3] = True
    return at[cut[:n]]


_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def keys_of(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of each pre-token (those up to KEY_BYTES) as three numbers, zeros behind its end."""
    padded = np.append(raw, np.zeros(KEY_BYTES + 8, np.uint8))
    eights = np.lib.stride_tricks.sliding_window_view(padded, 8)
    out = np.zeros((3, len(starts)), np.uint64)
    for k in range(3):
        rows = np.flatnonzero(sizes > 8 * k) if k else slice(None)
        window = np.ascontiguousarray(eights[starts[rows] + 8 * k]).view("<u8").ravel()
        out[k, rows] = window & _MASKS[np.minimum(sizes[rows] - 8 * k, 8)]
    return out


def hashed(keys: np.ndarray) -> np.ndarray:
    return C.mixed(keys[0] ^ C.mixed(keys[1] ^ C.mixed(keys[2])))


class LengthTable:
    """Token counts of pre-tokens of up to KEY_BYTES bytes, in an open-addressed table of numbers.

    Two pre-tokens are the same if their bytes and their sizes are.
    """

    def __init__(self, slots: int):
        self.keys, self.sizes, self.lengths = np.zeros((3, slots), np.uint64), np.zeros(slots, np.uint8), np.zeros(slots, np.uint8)
        self.used = 0

    @classmethod
    def of(cls, keys: np.ndarray, sizes: np.ndarray, lengths: np.ndarray) -> LengthTable:
        """A table from its arrays, to look up only."""
        out = cls(0)
        out.keys, out.sizes, out.lengths = keys, sizes, lengths
        return out

    def _same(self, here: np.ndarray, keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return (self.sizes[here] == sizes) & (self.keys[0, here] == keys[0]) & (self.keys[1, here] == keys[1]) & (self.keys[2, here] == keys[2])

    def find(self, keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Token counts, 0 where the table has none."""
        out = np.zeros(len(sizes), np.int64)
        top = len(self.sizes) - 1
        slot, left = (hashed(keys) & np.uint64(top)).astype(np.int64), np.arange(len(sizes))
        while len(left):
            same = self._same(slot, keys[:, left], sizes[left])
            out[left[same]] = self.lengths[slot[same]]
            further = ~same & (self.sizes[slot] > 0)
            slot, left = (slot[further] + 1) & top, left[further]
        return out

    def add(self, keys: np.ndarray, sizes: np.ndarray, count) -> np.ndarray:
        """Token counts; those the table lacks come from ``count(numbers of pre-tokens)`` and are kept. There is room for all."""
        top = len(self.sizes) - 1
        slot, left = (hashed(keys) & np.uint64(top)).astype(np.int64), np.arange(len(sizes))
        place, fresh = slot.copy(), []
        while len(left):
            empty = np.flatnonzero(self.sizes[slot] == 0)
            taken, first = np.unique(slot[empty], return_index=True)
            owner = left[empty[first]]
            self.keys[:, taken], self.sizes[taken] = keys[:, owner], sizes[owner]
            fresh.append((taken, owner))
            other = ~self._same(slot, keys[:, left], sizes[left])
            slot, left = (slot[other] + 1) & top, left[other]
            place[left] = slot
        taken, owner = (np.concatenate(c) for c in zip(*fresh)) if fresh else (place, place)
        if len(owner):
            self.lengths[taken] = count(owner)
            self.used += len(owner)
        return self.lengths[place].astype(np.int64)


def lengths_by(library, words: list[bytes]) -> np.ndarray:
    """Token counts of pre-tokens by the library."""
    found = library.encode([w.decode() for w in words], is_pretokenized=True, add_special_tokens=False)
    return np.bincount(np.array(found.word_ids, np.int64), minlength=len(words))


def _specials(raw: np.ndarray, at: np.ndarray, words: list[bytes]) -> list[tuple[int, int, int]]:
    """(text, start, end) of special strings, leftmost first, the first listed of those that start together."""
    out, blob = [], raw.tobytes()
    if any(w in blob for w in words):
        for t in range(len(at) - 1):
            here = int(at[t])
            while found := min(((p, i) for i, w in enumerate(words) if (p := blob.find(w, here, at[t + 1])) >= 0), default=None):
                here = found[0] + len(words[found[1]])
                out.append((t, found[0], here))
    return out


def _parts(batch: pa.RecordBatch, classes: np.ndarray, specials: list[bytes]):
    """For each chunk: rows, bytes, text offsets, special strings, and starts and sizes of the pre-tokens outside them."""
    for a, b in C.chunks(batch):
        raw, at = C.bytes_of(batch.column("text").slice(a, b - a))
        marked = _specials(raw, at, specials)
        heads = np.concatenate([at[:-1][at[:-1] < at[1:]], *([p for p in (s, e) if p < len(raw)] for _, s, e in marked)]).astype(np.int64)
        starts = pieces(raw, heads, classes)
        sizes = np.diff(np.append(starts, len(raw)))
        if marked:
            begin, end = (np.array([m[k] for m in marked]) for k in (1, 2))
            inside = np.searchsorted(begin, starts, "right") - 1
            free = (inside < 0) | (starts >= end[inside])
            starts, sizes = starts[free], sizes[free]
        yield a, b, raw, at, marked, starts, sizes


def _counted(classes, specials: list[bytes]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts, total = np.zeros((3, 0), np.uint64), np.zeros(0, np.int64), 0
        wide = np.zeros(0, np.uint8)
        waiting: list[tuple] = []

        def merged():
            keys = np.concatenate([held, *(w[0] for w in waiting)], axis=1)
            sizes = np.concatenate([wide, *(w[1] for w in waiting)])
            number = np.concatenate([counts, np.ones(keys.shape[1] - len(counts), np.int64)])
            _, first, which = np.unique(hashed(keys), return_index=True, return_inverse=True)
            summed = np.bincount(which, number, len(first)).astype(np.int64)
            if len(first) > COUNTED:
                top = np.argpartition(-summed, COUNTED // 2)[:COUNTED // 2]
                first, summed = first[top], summed[top]
            return keys[:, first], sizes[first], summed

        for batch in batches:
            for *_, raw, _, _, starts, sizes in _parts(batch, classes.value, specials):
                total += len(starts)
                short = sizes <= KEY_BYTES
                waiting.append((keys_of(raw, starts[short], sizes[short]), sizes[short].astype(np.uint8)))
                if sum(len(w[1]) for w in waiting) > 1 << 20:
                    held, wide, counts = merged()
                    waiting = []
        held, wide, counts = merged()
        often = np.flatnonzero(counts * REPORTED >= max(total, 1))
        raw = held[:, often].T.astype("<u8").tobytes()
        words = [raw[KEY_BYTES * i:KEY_BYTES * i + n] for i, n in enumerate(wide[often].tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(counts[often], pa.int64())], ["piece", "n"])

    return rows


class Cache:
    """A worker's own token counts of pre-tokens that the broadcast table lacks; it starts anew when it is full."""

    def __init__(self, vocabulary: str):
        self.library, self.table, self.long = _library(vocabulary), LengthTable(2 * CACHE_ENTRIES), {}

    def short(self, blob: bytes, starts: np.ndarray, sizes: np.ndarray, keys: np.ndarray) -> np.ndarray:
        out = []
        for a in range(0, len(starts), AT_ONCE):
            if self.table.used > CACHE_ENTRIES:
                self.table = LengthTable(2 * CACHE_ENTRIES)
            begin, size = starts[a:a + AT_ONCE], sizes[a:a + AT_ONCE]
            out.append(self.table.add(
                keys[:, a:a + AT_ONCE], size, lambda new: lengths_by(self.library, [blob[x:x + n] for x, n in zip(begin[new].tolist(), size[new].tolist())])))
        return np.concatenate(out)

    def others(self, words: list[bytes]) -> list[int]:
        known = self.long
        new = [w for w in dict.fromkeys(words) if w not in known]
        fresh = dict(zip(new, lengths_by(self.library, new).tolist()))
        out = [fresh[w] if w in fresh else known[w] for w in words]
        if len(known) + len(fresh) > CACHE_ENTRIES // 4:
            known.clear()
        known.update((w, n) for w, n in fresh.items() if len(w) <= CACHED_BYTES)
        return out


_CACHES: dict[int, Cache] = {}


def _cache(vocabulary: str) -> Cache:
    """The worker's cache for this vocabulary; it outlives tasks."""
    mark = hash(vocabulary)
    if mark not in _CACHES:
        _CACHES.clear()
        _CACHES[mark] = Cache(vocabulary)
    return _CACHES[mark]


def _lengths(classes, table, vocabulary, specials: list[bytes]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = LengthTable.of(*table.value)
        for batch in batches:
            cache = _cache(vocabulary.value)
            for a, b, raw, at, marked, starts, sizes in _parts(batch, classes.value, specials):
                number, blob = np.zeros(len(starts), np.int64), raw.tobytes()
                short, long = np.flatnonzero(sizes <= KEY_BYTES), np.flatnonzero(sizes > KEY_BYTES)
                keys = keys_of(raw, starts[short], sizes[short])
                number[short] = often.find(keys, sizes[short])
                missed = np.flatnonzero(number[short] == 0)
                if len(missed):
                    number[short[missed]] = cache.short(blob, starts[short[missed]], sizes[short[missed]], keys[:, missed])
                if len(long):
                    number[long] = cache.others([blob[x:x + n] for x, n in zip(starts[long].tolist(), sizes[long].tolist())])
                upto = np.concatenate([[0], np.cumsum(number)])
                tokens = np.diff(upto[np.searchsorted(starts, at)])
                np.add.at(tokens, [t for t, _, _ in marked], 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(np.diff(at), pa.int64()), pa.array(tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return rows


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 1024, frequent: int = 65_536) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    ``vocabulary`` is the text of a tokenizers JSON file with byte-level pre-tokenization and no normalizer. Counts are
    those of the library's encode without added tokens; special strings inside a text count as their one token.

    First pass: each task counts its pre-tokens and reports those with a share of at least 1 in REPORTED; no other
    pre-token leaves its task. The ``frequent`` most common ones are tokenized once and broadcast as a table of numbers
    (at most 14 MB by default). Second pass: pre-tokens are looked up in the table by their own bytes; those it lacks are
    tokenized by the worker and kept in its cache. The table decides the speed only, never a count.

    Null texts count as empty (0 tokens); rows without doc_id keep a null id; repeated rows get one result each; other
    columns are not read. Memory per task is bounded by CHUNK_BYTES, the longest text, COUNTED and CACHE_ENTRIES.
    """
    library = _library(vocabulary)
    told = json.loads(vocabulary)
    if (told.get("pre_tokenizer") or {}) != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} or told.get("normalizer"):
        raise ValueError("only byte-level pre-tokenization without a normalizer and without an added blank is known")
    context = docs.sparkSession.sparkContext
    specials = [t["content"].encode() for t in told.get("added_tokens", [])]
    classes = context.broadcast(_classes_of(vocabulary))
    texts = C.slim(docs)
    often = (
        texts.mapInArrow(_counted(classes, specials), "piece binary, n long")
        .groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(frequent).select("piece").toPandas()["piece"]
    )
    frequent_lengths = LengthTable(1 << max(4, (4 * len(often)).bit_length()))
    if len(often):
        words = list(map(bytes, often))
        raw, sizes = np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words])
        frequent_lengths.add(keys_of(raw, np.cumsum(sizes) - sizes, sizes), sizes, lambda new: lengths_by(library, [words[i] for i in new.tolist()]))
    f = frequent_lengths
    table = context.broadcast((f.keys, f.sizes, f.lengths))
    out = texts.mapInArrow(_lengths(classes, table, context.broadcast(vocabulary), specials), "doc_id long, n_bytes long, n_tokens long")
    return out.select(C.real_id(), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

