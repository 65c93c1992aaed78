"""Small tables with everything that rows can lack or repeat, and plain versions of the operators to compare with."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, rest string, mark long, place long, kind string, bits long, key string"


def frame(spark, rows, schema=SCHEMA):
    """Rows (doc_id, text) with columns whose names the operators use themselves."""
    if schema is not SCHEMA:
        return spark.createDataFrame(rows, schema)
    return spark.createDataFrame([(d, t, "en", "r", 1, 2, "k", 3, "y") for d, t in rows], SCHEMA).repartition(3)


def odd_rows():
    """Nulls in any column, empty, long, repeated and tied rows."""
    words = [f"w{i % 977}" for i in range(30_000)]
    return [
        (None, None), (None, "no id but text enough to be a line\nand more"), (1, None), (2, ""), (3, "  \t\n "), (4, "one"), (5, "one two"),
        (6, "same row again, long enough to count\nx"), (6, "same row again, long enough to count\nx"), (7, "tie a b c d e f g"), (7, "tie h i j k l m n"),
        (8, " ".join(words)), (9, "x" * 120_000), (10, "É Ünïcode ﬁ 日本語🎉 \x00 end"),
        (11, "same row again, long enough to count\ny"), (12, "SAME row again, long enough to count \nz"), (13, "A" * 30 + "\n" + "a" * 30),
    ]


def passages(seed: int, documents: int = 60, vocabulary: str = "abcdé", pool: int = 1500):
    """Documents cut out of one word sequence, so that long and short passages repeat within and across them."""
    r = random.Random(seed)
    base = [r.choice(vocabulary) + r.choice(("", "x", "Y")) for _ in range(pool)]
    rows = []
    for d in range(documents):
        text = []
        for _ in range(r.randint(0, 4)):
            i = r.randint(0, pool - 70)
            text += base[i:i + r.randint(3, 60)]
        rows.append((d, r.choice((" ", "  ", "\n")).join(text)))
    return rows
