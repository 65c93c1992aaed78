"""Exact removal of repeated passages, by anchors at difference-cover positions.

A difference cover D of a period v holds, for any two starts i and j, a shift d < v with i + d and j + d both at a
position that is in D modulo v. Two equal windows of ``window`` words therefore share an anchor (``anchor`` words,
hashed only at cover positions) at the same shift, as long as anchor + v - 1 <= window.

1. Every anchor goes out as one row: its hash, and a hash of its whole context (the anchor and up to v - 1 words on
   either side, so all windows that hold it). 4 of 13 positions are rows, not all.
2. Rows meet by anchor hash. Where the context occurs earlier, all windows around the anchor do: the extension is
   settled. An anchor hash with one context only is settled too. Only anchors that are the first with their context,
   while the same anchor has others, stay open; they lie at the borders of repeated passages.
3. Windows around open anchors are hashed in full (128 bits) and the first place of each is found by a grouped minimum.
4. Marks go back to the texts by doc_id and a checksum of the text, and the covered words are taken out.

A frequent anchor is thinned inside each chunk before the shuffle: a context repeated inside the chunk is settled there,
and beyond two contexts the rest are known to be open, so that a chunk sends at most two rows per anchor hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import common as C

TO_MEET, REPEATED, OPEN = 0, 1, 2


def difference_cover(period: int) -> tuple[int, ...]:
    """A smallest set whose differences give every number modulo ``period``."""
    for size in range(1, period + 1):
        for rest in combinations(range(1, period), size - 1):
            cover = (0, *rest)
            if len({(a - b) % period for a in cover for b in cover}) == period:
                return cover
    raise ValueError("the period must be at least 1")


class _Texts:
    """Word hashes of a chunk of texts and where each text starts and ends in them."""

    def __init__(self, texts: pa.Array):
        raw, at = C.bytes_of(texts)
        self.words, self.at = C.word_hashes(raw, at)
        self.mark = np.array([C.text_mark(raw[a:b].tobytes()) for a, b in zip(at[:-1], at[1:])], np.int64) << 32

    def anchors(self, window: int, anchor: int, cover: np.ndarray, period: int) -> tuple[np.ndarray, np.ndarray]:
        """Text number and start (from the first word of the chunk) of all anchors of texts with a window."""
        size = np.diff(self.at)
        text = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(self.words)) - self.at[:-1][text]
        keep = cover[place % period] & (size[text] >= window) & (place + anchor <= size[text])
        return text[keep], np.flatnonzero(keep)


def _anchor_rows(window: int, anchor: int, period: int):
    cover = np.zeros(period, bool)
    cover[list(difference_cover(period))] = True

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in C.chunks(batch):
                part = batch.slice(a, b - a)
                texts = _Texts(part.column("text"))
                text, start = texts.anchors(window, anchor, cover, period)
                if not len(start):
                    continue
                spans = C.Spans(texts.words)
                left = np.maximum(start - (period - 1), texts.at[:-1][text])
                right = np.minimum(start + anchor + period - 1, texts.at[1:][text])
                hashed = C.signed(spans.of(start, start + anchor))
                context = C.signed(spans.of(left, right) ^ C.mixed((start - left).astype(np.uint64)))
                doc = np.asarray(part.column("doc_id"), dtype=np.int64)[text]
                place = texts.mark[text] | (start - texts.at[:-1][text])
                order = np.lexsort((place, doc, context, hashed))
                hashed, context, doc, place = (x[order] for x in (hashed, context, doc, place))
                new_hash, new_context = C.run_starts(hashed), C.run_starts(hashed, context)
                nth = np.cumsum(new_context)
                nth -= np.maximum.accumulate(np.where(new_hash, nth, 0))
                kind = np.where(~new_context, REPEATED, np.where(nth > 1, OPEN, TO_MEET)).astype(np.int8)
                route = np.where(kind == TO_MEET, hashed, C.signed(C.mixed((doc ^ (place >> 32)).view(np.uint64))))
                back = np.argsort(order, kind="stable")  # in the order of the texts the rows compress better
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[back]) for x in (route, context, doc, place, kind)], ["route", "context", "doc_id", "place", "kind"])

    return rows


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks from rows sorted by route, kind, context, doc_id and place; remembers one anchor hash between batches."""
    last_route = last_context = waiting = None
    for batch in batches:
        route, context, doc, place, kind = (np.asarray(batch.column(c)) for c in ("route", "context", "doc_id", "place", "kind"))
        passed = kind != TO_MEET
        out = [(doc[passed], place[passed], kind[passed])]
        route, context, doc, place = (x[~passed] for x in (route, context, doc, place))
        if n := len(route):
            new_route, new_context = C.run_starts(route), C.run_starts(route, context)
            if last_route == route[0]:
                new_route[0], new_context[0] = False, last_context != context[0]
            out.append((doc[~new_context], place[~new_context], np.full((~new_context).sum(), REPEATED, np.int8)))
            group = np.cumsum(new_route)
            contexts = np.bincount(group, weights=new_context, minlength=group[-1] + 1)
            if waiting is not None:
                if contexts[0]:
                    out.append((*waiting, np.full(1, OPEN, np.int8)))
                if contexts[0] or group[-1] > 0:
                    waiting = None
            first = new_route & new_context
            opened = new_context & (~first | (contexts[group] > 1))
            out.append((doc[opened], place[opened], np.full(opened.sum(), OPEN, np.int8)))
            last_route, last_context = route[-1], context[-1]
            if group[-1] > 0 and contexts[group[-1]] == 1:
                i = np.flatnonzero(new_route)[-1]
                waiting = doc[i:i + 1].copy(), place[i:i + 1].copy()
        columns = [np.concatenate(c) for c in zip(*out)]
        if len(columns[0]):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc_id", "place", "kind"])


def _list_arrays(column: pa.Array, mark: int) -> np.ndarray:
    """The word starts of a row's marks that belong to its text."""
    values = np.asarray(column, dtype=np.int64)
    return np.sort(values[(values >> 32 << 32) == mark] & 0xFFFFFFFF)


class _Marked:
    """The windows of one text that open anchors leave to be compared, and the words that repeated anchors cover."""

    def __init__(self, n: int, repeated: np.ndarray, opened: np.ndarray, window: int, anchor: int, period: int):
        self.window = window
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, np.maximum(repeated - (period - 1), 0), 1)
        np.add.at(edge, np.minimum(repeated + anchor + period - 1, n), -1)
        self.covered = np.cumsum(edge)[:n] > 0
        settled, asked = np.zeros(n, bool), np.zeros(n, bool)
        for starts, flags in ((repeated, settled), (opened, asked)):
            near = (starts[:, None] - np.arange(period)[None, :]).ravel()
            flags[near[near >= 0]] = True
        asked &= ~settled
        asked[max(n - window + 1, 0):] = False
        self.asked = np.flatnonzero(asked)

    def cover(self, starts: np.ndarray) -> np.ndarray:
        edge = np.zeros(len(self.covered) + 1, np.int64)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + self.window, -1)
        return self.covered | (np.cumsum(edge)[:-1] > 0)


def _marked_rows(batch: pa.RecordBatch, window: int, anchor: int, period: int):
    """For each row: its number in the batch, its words' place in the chunk, hashes of the asked windows, and the marks."""
    for a, b in C.chunks(batch):
        part = batch.slice(a, b - a)
        texts = _Texts(part.column("text"))
        one, two = C.Spans(texts.words), C.Spans(texts.words, salt=7)
        for i in range(b - a):
            repeated, opened = part.column("repeated")[i].values, part.column("opened")[i].values
            if repeated is None and opened is None:
                yield a + i, int(texts.at[i + 1] - texts.at[i]), texts.mark[i], None, None
                continue
            n = int(texts.at[i + 1] - texts.at[i])
            marked = _Marked(n, _list_arrays(repeated, texts.mark[i]), _list_arrays(opened, texts.mark[i]), window, anchor, period)
            s = marked.asked + texts.at[i]
            keys = np.stack([C.signed(one.of(s, s + window)), C.signed(two.of(s, s + window))], axis=1)
            first = np.zeros(len(s), bool)
            if len(s):
                first[np.unique(keys, axis=0, return_index=True)[1]] = True
            yield a + i, n, texts.mark[i], marked, (keys, first)


def _open_windows(window: int, anchor: int, period: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.unzipped(batches):
            doc = np.asarray(batch.column("doc_id"), dtype=np.int64)
            found = []
            for i, _, mark, marked, windows in _marked_rows(batch, window, anchor, period):
                if marked is not None and len(marked.asked):
                    keys, first = windows
                    found.append((keys[first, 0], keys[first, 1], np.full(first.sum(), doc[i]), mark | marked.asked[first]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], ["one", "two", "doc_id", "place"])

    return rows


def _cut(window: int, anchor: int, period: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.unzipped(batches):
            n_words, n_removed, kept = [], [], []
            texts, owned = batch.column("text"), batch.column("owned")
            for i, n, mark, marked, windows in _marked_rows(batch, window, anchor, period):
                words = texts[i].as_py().encode().split()
                gone = 0
                if marked is not None:
                    _, first = windows
                    own = owned[i].values
                    held = np.zeros(0, np.int64) if own is None else _list_arrays(own, mark)
                    covered = marked.cover(marked.asked[~(first & np.isin(marked.asked, held))])
                    gone = int(covered.sum())
                    words = [w for w, c in zip(words, covered.tolist()) if not c] if gone else words
                n_words.append(n)
                n_removed.append(gone)
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_text"])

    return rows


def dedup_substrings(docs: DataFrame, window: int = 20, anchor: int = 8) -> DataFrame:
    """Each text without the words of windows whose words start earlier too.

    "Earlier" is a smaller doc_id, or the same document and an earlier start; windows are judged on the input. Result,
    one row per input row: doc_id, n_words, n_removed, kept_text (kept words joined by one space).

    Null texts count as empty; rows without doc_id come before all others and keep a null id; a text shorter than the
    window loses nothing. Rows that share a doc_id but differ in text are ordered by a checksum of the text; exact
    copies of a row are one place and each get the same result. Other columns are not read. Memory per task is bounded
    by CHUNK_BYTES and the longest text; a text may have up to 2**32 words.
    """
    period = window - anchor + 1
    if anchor < 1 or period < 1:
        raise ValueError("an anchor needs at least one word and at most as many as the window")
    texts = C.slim(docs)
    shape = (window, anchor, period)
    anchors = texts.mapInArrow(_anchor_rows(*shape), "route long, context long, doc_id long, place long, kind byte")
    own = F.shiftright("place", 32).alias("mark")  # of the text, so that rows of one id, or of none, have lists of their own
    marks = (
        anchors.repartition("route").sortWithinPartitions("route", "context", "doc_id", "place")
        .mapInArrow(_meet, "doc_id long, place long, kind byte")
        .groupBy("doc_id", own).agg(
            F.collect_list(F.when(F.col("kind") == REPEATED, F.col("place"))).alias("repeated"),
            F.collect_list(F.when(F.col("kind") == OPEN, F.col("place"))).alias("opened"))
    )
    # keys that cannot be null keep both uses of the texts one plan, so that they share one shuffle
    zipped = texts.mapInArrow(C.zipped, "doc_id long, mark long, zip binary").select(
        F.coalesce("doc_id", F.lit(C.NO_ID)).alias("doc_id"), F.coalesce("mark", F.lit(0)).alias("mark"), "zip")
    marked = zipped.join(marks, ["doc_id", "mark"], "left")
    owned = (
        marked.where(F.size("opened") > 0).mapInArrow(_open_windows(*shape), "one long, two long, doc_id long, place long")
        .groupBy("one", "two").agg(F.min(F.struct("doc_id", "place")).alias("first"))
        .select("first.*").groupBy("doc_id", own).agg(F.collect_list("place").alias("owned"))
    )
    cut = marked.join(owned, ["doc_id", "mark"], "left").mapInArrow(_cut(*shape), "doc_id long, n_words long, n_removed long, kept_text string")
    return cut.select(C.real_id(), "n_words", "n_removed", "kept_text")
