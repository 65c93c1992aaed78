"""Benchmark decontamination: a prefix-filtered set join of benchmark windows with documents, in DataFrame functions only.

A window (``window`` consecutive words of an item; a shorter item is one window) is a set of word shingles, and occurs in
a document only if all of them do, one after another. With all shingles needed, a prefix of one is enough: the rarest.

1. How often each benchmark shingle occurs in all documents; a window with a shingle that never occurs is out.
2. Each remaining window joins the documents on its rarest shingle alone.
3. Length and position: the window must lie in the document around the place of the shingle.
4. The words at that place are compared with the window's words, exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import common as C
from riskloom.session import settle

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Benchmark shingles or windows up to this number are broadcast (they are counted first); more are joined by a shuffle.
BROADCAST_ROWS = 100_000


def words_of(text: Column) -> Column:
    """Words of letters, digits and characters beyond ASCII, A-Z in lower case."""
    return F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.when(w == F.lower(w), w).otherwise(C.lower_ascii(w)))


def _hash(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *(F.get(words, at + i) for i in range(size)))


def _windows(items: DataFrame, window: int) -> DataFrame:
    """item_id and the words of each of its windows, joined by one space."""
    words = items.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("words"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
    return words.where(F.size("words") > 0).select(
        "item_id", F.explode(F.transform(starts, lambda i: F.array_join(F.slice("words", i, F.lit(window)), " "))).alias("window")).distinct()


def _window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """The shingles of each distinct window with their offsets; a window shorter than a shingle is one."""
    words = windows.select("window").distinct().select("window", F.split("window", " ").alias("words"))
    parts = [
        words.where(F.size("words") == n if n < shingle else F.size("words") >= n)
        .select("window", F.size("words").alias("length"), F.lit(n).alias("size"), F.col("words"), F.explode(F.sequence(F.lit(0), F.size("words") - n)).alias("offset"))
        .select("window", "length", "size", "offset", _hash(F.col("words"), F.col("offset"), n).alias("hash"))
        for n in range(1, shingle + 1)
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _document_shingles(words: DataFrame, sizes: list[int]) -> DataFrame:
    """One row per word place and shingle size; ``at`` is the place, -1 in the one row that stands for the document.

    No higher-order function follows the explode, so that the rows stay in generated code up to the join and the words of
    the document are not copied for each of them.
    """
    placed = words.select("*", F.posexplode(F.concat(F.array(F.lit(None).cast("string")), F.col("words"))).alias("at", "word")).withColumn("at", F.col("at") - 1)
    inside = lambda n: F.when((F.col("at") >= 0) & (F.col("at") + n <= F.col("n_words")), _hash(F.col("words"), F.col("at"), n))
    if len(sizes) == 1:
        return placed.withColumn("hash", inside(sizes[0]))
    each = F.explode(F.array(*(F.struct(F.lit(n).alias("size"), inside(n).alias("hash")) for n in sizes)))
    out = placed.withColumn("s", each).withColumn("hash", F.col("s.hash"))
    return out.where(F.col("hash").isNotNull() | ((F.col("at") == -1) & (F.col("s.size") == sizes[0]))).drop("s")


def find_contamination(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 3) -> DataFrame:
    """Which words of each document lie in an occurrence of a benchmark window, and which items have such windows.

    Words are runs of letters, digits and characters beyond ASCII, with A-Z in lower case. Result, one row per input
    row: doc_id, n_words, n_hit, spans (first word and end of each occurrence, sorted), item_ids (as strings, sorted),
    contaminated.

    Null texts have no words; items without words are left out; words in windows of items without id are hit, though no id
    is listed for them; repeated items count once; with an empty benchmark nothing is hit. Rows that share a doc_id are
    judged each by its own text, exact copies of a row get the same result.
    """
    shingles = settle(_window_shingles(settle(_windows(items, window), "windows"), shingle), "shingles")
    pairs = _windows(items, window)
    sizes = sorted(r.size for r in shingles.select("size").distinct().collect())
    texts = C.slim(docs)
    words = texts.select("doc_id", F.xxhash64("text").alias("mark"), words_of(F.col("text")).alias("words")).withColumn("n_words", F.size("words"))
    placed = _document_shingles(words, sizes or [shingle])
    counted = shingles.select("hash").distinct()
    asked = placed.select("hash").where(F.col("hash").isNotNull())
    seen = asked.join(F.broadcast(counted) if counted.count() <= BROADCAST_ROWS else counted, "hash", "left_semi").groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    rarest = Window.partitionBy("window").orderBy("n", "offset")
    known = shingles.join(seen, "hash", "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("rank", F.row_number().over(rarest))
    prefix = settle(known.where((F.col("rank") == 1) & (F.col("n") > 0)).select("hash", "window", "length", "offset"), "prefix")
    if prefix.count() <= BROADCAST_ROWS:
        met, first = placed.withColumn("near", F.col("words")).join(F.broadcast(prefix), "hash", "left"), F.lit(0)
    else:  # rows that are shuffled take along the words around the place only
        first = F.greatest(F.col("at") - window + 1, F.lit(0))
        placed = placed.withColumn("hash", F.when(F.col("at") == -1, F.xxhash64("doc_id", "mark")).otherwise(F.col("hash")))
        placed = placed.where(F.col("hash").isNotNull())
        met = placed.withColumn("near", F.slice("words", first + 1, F.lit(2 * window))).drop("words", "word").join(prefix, "hash", "left")
    start = F.col("at") - F.col("offset")
    fits = (start >= 0) & (start + F.col("length") <= F.col("n_words"))
    same = F.array_join(F.slice("near", F.greatest(start - first, F.lit(0)) + 1, F.col("length")), " ") == F.col("window")
    found = (
        met.where((F.col("at") == -1) | (fits & same))
        .select("doc_id", "mark", "at", "n_words", start.alias("start"), (start + F.col("length")).alias("end"), "window")
    )
    found = settle(found, "occurrences")
    by_doc = found.groupBy("doc_id", "mark").agg(
        F.max("n_words").cast("long").alias("n_words"), F.count(F.when(F.col("at") == -1, 1)).cast("int").alias("copies"),
        F.array_sort(F.collect_set(F.when(F.col("at") >= 0, F.struct("start", "end")))).alias("spans"))
    matched = (
        found.where(F.col("at") >= 0).select("doc_id", "mark", "window").distinct().join(pairs, "window")
        .groupBy("doc_id", "mark").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    )
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach")),
        lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], a["reach"]))).alias("n"), F.greatest(a["reach"], x["end"]).alias("reach")),
        lambda a: a["n"].cast("long"))
    return (
        by_doc.join(matched, ["doc_id", "mark"], "left").withColumn("n_hit", covered)
        .select(C.real_id(), "n_words", "n_hit", "spans", F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
                (F.col("n_hit") > 0).alias("contaminated"), F.explode(F.array_repeat(F.lit(1), F.col("copies"))).alias("copy"))
        .drop("copy")
    )
