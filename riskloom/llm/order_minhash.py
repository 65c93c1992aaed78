"""Document fingerprints by Order MinHash, in DataFrame functions only.

The k-mers of a text are runs of k words, numbered by occurrence, so that a repeat is an element of its own. The hashes of
all elements lie on a circle with ``components`` evenly spaced points. Each component takes the two elements that follow
its point on the circle, which are minimal in the order that begins there, retains their order in the text, and hashes the
pair. Two texts agree in a component if the same elements come first and in the same order, which falls with the edit
distance and not only with the common words. Where no element lies between two points, both look further along the circle,
so a component of a short text is chosen as a component of a long one; short texts have fewer different pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import common as C

#: Low bits of a sorted number that hold a place; no array of longs has more places.
PLACE_BITS = 28


def _with(value: Column, use) -> Column:
    """``use(value)``, with the value computed once for each row."""
    return F.transform(F.array(value), use)[0]


def signature(text: Column, k: int = 5, components: int = 64) -> Column:
    """array<int> of tuple hashes; texts without words give the hashes of no element, texts of one element pair it with itself.

    An element is a k-mer and the number of its occurrence, and its hash is of both; the first occurrence has the hash of
    the k-mer. A text without repeats needs no numbers. ``components`` is a power of two.
    """
    element = lambda e, i: F.struct(e.alias("e"), i.alias("i"))
    step = 2**64 // components

    def of_kmers(kmers: Column) -> Column:
        return F.when(F.size(F.array_distinct(kmers)) < F.size(kmers), _with(kmers, numbered)).otherwise(F.transform(kmers, element))

    def numbered(kmers: Column) -> Column:
        """Elements of all k-mers, from runs of equal ones in an array sorted by hash and place."""
        def runs(ordered: Column) -> Column:
            starts = F.array_compact(F.transform(ordered, lambda x, j: F.when((j == 0) | (x["h"] != F.get(ordered, j - 1)["h"]), j)))

            def run(starts: Column, first: Column, g: Column) -> Column:
                places = F.sequence(first, F.coalesce(F.get(starts, g + 1), F.size(ordered)) - 1)
                return F.transform(places, lambda p, n: _with(F.get(ordered, p), lambda x: element(
                    F.when(n == 0, x["h"]).otherwise(F.xxhash64(x["h"], n)), x["i"])))

            return _with(starts, lambda s: F.flatten(F.transform(s, lambda first, g: run(s, first, g))))

        return _with(F.sort_array(F.transform(kmers, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), runs)

    def tuples(elements: Column) -> Column:
        """Points are sorted together with the elements; a point is a number without a place."""
        place = F.lit(2**PLACE_BITS - 1).cast("long")
        points = F.array(*(F.lit(-(2**63) + c * step) for c in range(components)))
        packed = F.transform(elements, lambda x, j: x["e"].bitwiseAND(F.lit(-(2**PLACE_BITS))).bitwiseOR((j + 1).cast("long")))

        def on_circle(circle: Column) -> Column:
            found = F.array_compact(F.transform(circle, lambda v, j: F.when(v.bitwiseAND(place) == 0, j)))
            inner = F.filter(circle, lambda v: v.bitwiseAND(place) != 0)
            return _with(F.struct(found.alias("points"), inner.alias("inner")), lambda t: F.transform(t["points"], lambda at, c: pair(t["inner"], at - c, c)))

        def pair(inner: Column, first: Column, c: Column) -> Column:
            def nth(n: Column) -> Column:
                return F.get(elements, (F.get(inner, n % F.greatest(F.size(inner), F.lit(1))).bitwiseAND(place) - 1).cast("int"))

            return _with(F.struct(nth(first).alias("a"), nth(first + 1).alias("b")), lambda t: F.when(
                t["b"]["i"] < t["a"]["i"], F.xxhash64(t["b"]["e"], t["a"]["e"], c)).otherwise(F.xxhash64(t["a"]["e"], t["b"]["e"], c)))

        return F.transform(_with(F.sort_array(F.concat(packed, points)), on_circle), lambda h: h.bitwiseAND(F.lit(2**31 - 1)).cast("int"))

    words = F.regexp_extract_all(text, F.lit(C.WORDS), F.lit(0))
    kmers = lambda w: F.when(F.size(w) > 0, F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(w) - k + 1, F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, k)))).otherwise(F.array().cast("array<long>"))
    return _with(_with(_with(words, kmers), of_kmers), tuples)


def fingerprint(signed: Column) -> Column:
    """Eight hexadecimal digits for each component."""
    return F.lower(F.array_join(F.transform(signed, lambda c: F.lpad(F.hex(c), 8, "0")), ""))


def likeness(one: Column, other: Column) -> Column:
    """Share of equal components, from 0 to 1."""
    return F.size(F.filter(F.zip_with(one, other, lambda a, b: a == b), lambda x: x)) / F.size(one)


def neighbours(docs: DataFrame, parts: int, **columns: Column) -> DataFrame:
    """Each row with ``text`` (and the named columns) of the next one by doc_id as ``next_...``; the first follows the last.

    Rows go to ranges of about equal numbers of documents, found by percentiles of the ids, and look to the next one in
    their range. Rows of one id follow each other by the XXH64 of their texts; an id that is several percentiles has as
    many ranges of that hash. The last of a range takes the first of the range after it from a table with one row per range.
    """
    texts = C.slim(docs)
    bounds = texts.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 10_000)).first()[0] or []
    borders = F.array(*map(F.lit, sorted(bounds))).cast("array<long>")
    equal = F.size(F.filter(borders, lambda b: F.col("doc_id") == b))
    slot = F.least(F.floor((F.col("tie") / 2.0**64 + 0.5) * equal), F.greatest(equal - 1, F.lit(0))).cast("int")
    part = F.size(F.filter(borders, lambda b: F.col("doc_id") > b)) + slot
    carried = ["text", *columns]
    texts = texts.withColumn("tie", F.xxhash64("text"))
    ranged = texts.select("doc_id", "text", "tie", part.alias("part"), *(c.alias(n) for n, c in columns.items()))
    order = Window.partitionBy("part").orderBy("doc_id", "tie", "text")
    led = ranged.repartition("part").select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in carried), F.row_number().over(order).alias("nth"))
    heads = led.where(F.col("nth") == 1).select("part", *carried)
    lap = Window.orderBy("part")
    after = heads.select(
        F.col("part"),
        *(F.coalesce(F.lead(c).over(lap), F.first(c).over(lap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias(f"head_{c}") for c in carried))
    return led.join(after, "part", "left").select("doc_id", *carried, *(F.coalesce(f"next_{c}", f"head_{c}").alias(f"next_{c}") for c in carried))


def fingerprint_documents(docs: DataFrame, k: int = 5, components: int = 64) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, and how alike they are.

    The edited text has the last half of its code points (rounded down) replaced by as many of the first ones of the next
    document by doc_id, or by all if it is shorter; the first document follows the last. Result, one row per input row:
    doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next.

    Null texts count as empty; all texts without words share one fingerprint, and equal texts have equal ones. Rows
    without doc_id come first; rows of one doc_id follow each other by the XXH64 of their texts, exact copies included; a
    single row follows itself. A text is shuffled once.
    """
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sign = lambda c: signature(F.col(c), k, components)
    led = neighbours(docs, parts, signed=sign("text"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = led.select("*", F.concat(F.left(F.col("text"), F.length("text") - half), F.left(F.col("next_text"), half)).alias("edited"))
    out = edited.select("*", sign("edited").alias("edited_signed"))
    return out.select(
        C.real_id(), F.length("text").cast("long").alias("n_chars"), "edited", fingerprint(F.col("signed")).alias("fingerprint"),
        fingerprint(F.col("edited_signed")).alias("edited_fingerprint"), likeness(F.col("signed"), F.col("edited_signed")).alias("near_edited"),
        likeness(F.col("signed"), F.col("next_signed")).alias("near_next"))
