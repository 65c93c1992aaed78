"""SimHash near-duplicates by covering locality-sensitive hashing, without false negatives.

Give bit i of a fingerprint a nonzero vector m(i) of r + 1 bits. For each of the 2**(r+1) - 1 nonzero vectors v the mask
a(v) keeps the bits i with an odd product of v and m(i). Up to r differing bits have r vectors at most, so some v is
orthogonal to all of them, and the two fingerprints agree on all bits that its mask keeps: every pair within radius r
meets in one of 15 tables (r = 3), which fix 34 of 64 bits or so each.

Copies are one class before anything else. A bucket gives a spanning forest of its links, never its pairs. A bucket
above a bound is hashed once more by the same construction over the bits its mask leaves free; what then shares a bucket
agrees on all but 14 bits or so, and cannot have more than 2**14 or so classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import common as C
from riskloom.llm.components import components
from riskloom.session import settle

BITS = 64
EDGE = -1


def covering_masks(radius: int, bits: list[int] | None = None) -> list[int]:
    """Masks over the given bit numbers such that any ``radius`` of them are all outside some mask."""
    bits = list(range(BITS)) if bits is None else bits
    most = 2 ** (radius + 1) - 1
    vector = {bit: 1 + k % most for k, bit in enumerate(bits)}
    return [sum(1 << bit for bit in bits if (v & vector[bit]).bit_count() % 2) for v in range(1, most + 1)]


def as_long(x: int) -> int:
    return x - (1 << BITS) if x >= 1 << (BITS - 1) else x


def fingerprint(text: str, shingle: int) -> int:
    """Majority bits of the hashes of all word shingles, with repeats; 0 without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(len(words) - shingle + 1, 1)
    last = ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), last)), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, n, 1 << 15):
        part = hashes[i:i + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def _prints(shingle: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [as_long(fingerprint(t.as_py(), shingle)) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.int64())], ["doc_id", "bits"])

    return rows


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id (as in ``common.slim``) and the 64-bit fingerprint of each text."""
    return C.slim(docs).mapInArrow(_prints(shingle), "doc_id long, bits long")


def forest(prints: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect all fingerprints that links within the radius connect."""
    left, out = prints, []
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            one = front.pop()
            near = np.bitwise_count(left ^ one) <= radius
            if near.any():
                out.append((np.full(near.sum(), one), left[near]))
                front.extend(left[near])
                left = left[~near]
    return out


def _links(radius: int, most: int):
    """Links of sorted buckets; the members of buckets above ``most`` pass through with their table number."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3
        crowded = None

        def of(mask, value, bits, final):
            nonlocal held, crowded
            out = []
            if crowded is not None and len(mask):
                same = (mask == crowded[0]) & (value == crowded[1])
                out.append((bits[same], bits[same], mask[same]))
                if not same.all():
                    crowded = None
                mask, value, bits = mask[~same], value[~same], bits[~same]
            if not len(mask):
                held = [mask, value, bits]
                return out
            at = np.append(np.flatnonzero(C.run_starts(mask, value)), len(mask))
            size = np.diff(at)
            cut = len(size) if final else len(size) - 1
            two = at[:cut][size[:cut] == 2]
            near = two[np.bitwise_count((bits[two] ^ bits[two + 1]).view(np.uint64)) <= radius]
            out.append((bits[near], bits[near + 1], np.full(len(near), EDGE)))
            for i in np.flatnonzero(size[:cut] > 2):
                own = bits[at[i]:at[i + 1]]
                if len(own) > most:
                    out.append((own, own, mask[at[i]:at[i + 1]]))
                else:
                    out += [(a.view(np.int64), b.view(np.int64), np.full(len(a), EDGE)) for a, b in forest(own.view(np.uint64), radius)]
            held = [x[at[cut]:] for x in (mask, value, bits)]
            if len(held[0]) > most:
                crowded = int(held[0][0]), int(held[1][0])
                out.append((held[2], held[2], held[0]))
                held = [x[:0] for x in held]
            return out

        def batch_of(found):
            columns = [np.concatenate(c).astype(np.int64) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 3
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "kind"])

        for batch in batches:
            new = [np.asarray(batch.column(c), dtype=np.int64) for c in ("mask", "value", "bits")]
            yield batch_of(of(*(np.concatenate(x) for x in zip(held, new)), final=False))
        yield batch_of(of(*held, final=True))

    return rows


def _bucketed(classes: DataFrame, masks: list[tuple[int, int]]) -> DataFrame:
    """One row per class and table: table number, the bits its mask keeps, and the fingerprint."""
    kept = F.explode(F.array(*(F.struct(F.lit(number).cast("long").alias("mask"), F.col("bits").bitwiseAND(F.lit(as_long(mask))).alias("value")) for number, mask in masks)))
    return classes.select("bits", kept.alias("t")).select("t.mask", "t.value", "bits")


def _met(rows: DataFrame, radius: int, most: int) -> DataFrame:
    return rows.repartition("mask", "value").sortWithinPartitions("mask", "value", "bits").mapInArrow(_links(radius, most), "a long, b long, kind long")


def links(classes: DataFrame, radius: int = 3, crowd: int = 4096) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``bits`` that connect what links within the radius connect."""
    first = covering_masks(radius)
    met = settle(_met(_bucketed(classes, list(enumerate(first))), radius, crowd), "links")
    crowded = met.where(F.col("kind") != EDGE).select(F.col("a").alias("bits"), F.col("kind").alias("table"))
    again = []
    for number, mask in enumerate(first):
        free = [bit for bit in range(BITS) if not mask >> bit & 1]
        again += [(number, number * len(first) + j, mask | inner) for j, inner in enumerate(covering_masks(radius, free))]
    finer = F.explode(F.filter(
        F.array(*(F.struct(F.lit(table).cast("long").alias("table"), F.lit(number).cast("long").alias("mask"), F.col("bits").bitwiseAND(F.lit(as_long(mask))).alias("value")) for table, number, mask in again)),
        lambda t: t["table"] == F.col("table")))
    rest = _met(crowded.select("bits", "table", finer.alias("t")).select("t.mask", "t.value", "bits"), radius, 1 << BITS)
    edges = met.where(F.col("kind") == EDGE).select("a", "b").unionByName(rest.select("a", "b"))
    return edges.distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, crowd: int = 4096) -> DataFrame:
    """The fingerprint of every document and the smallest doc_id that links lead to.

    Texts have A-Z lowered and are cut at ASCII white space; a text with fewer words than a shingle is one shingle, one
    without words has fingerprint zero and links like any other. Result, one row per input row: doc_id, fingerprint (16
    hexadecimal digits), component_id. A null text counts as empty; rows without doc_id come before all others, and a
    component they are in has a null component_id. Rows that share a doc_id are linked by their own texts.

    Only 64-bit fingerprints, their smallest doc_id and their links are shuffled. ``crowd`` bounds what a task compares
    in a bucket before it is hashed again; it changes the plan, not the result.
    """
    prints = settle(fingerprints(docs, shingle), "fingerprints")
    classes = settle(prints.groupBy("bits").agg(F.min("doc_id").alias("low")), "classes")
    roots = components(links(classes, radius, crowd))
    rooted = classes.join(roots, classes["bits"] == roots["node"], "left").select("bits", "low", F.coalesce("root", "bits").alias("root"))
    rooted = settle(rooted, "roots")
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    ids = rooted.join(lowest, "root").select("bits", "component_id")
    return prints.join(ids, "bits").select(
        C.real_id(), F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), F.nullif(F.col("component_id"), F.lit(C.NO_ID)).alias("component_id"))
