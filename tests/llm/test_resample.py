import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from cases import frame, odd_rows

from riskloom.llm import resample as R

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def counted(texts, buckets):
    out = [0] * buckets
    for t in texts:
        w = words(t)
        for f in w + [a + b" " + b for a, b in zip(w, w[1:])]:
            out[zlib.crc32(f) % buckets] += 1
    return out


def plain(rows, target, percent=25, least=20, buckets=10_000):
    s, t = counted([x for _, x in rows], buckets), counted(target, buckets)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    out = []
    for d, x in rows:
        w = words(x)
        f = w + [a + b" " + b for a, b in zip(w, w[1:])]
        weight = sum(gain[zlib.crc32(y) % buckets] for y in f) // max(len(f), 1)
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append((d, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], -2**63 if r[0] is None else r[0]))
    return out, [(r[0], r[4]) for r in able[:percent * len(able) // 100]]


def compared(got, rows, target, **options):
    every, best = plain(rows, target, **options)
    assert sorted([tuple(r)[:5] for r in got], key=repr) == sorted(every, key=repr)
    ranked = sorted((r for r in got if r.rank is not None), key=lambda r: r.rank)
    assert [r.rank for r in ranked] == list(range(1, len(best) + 1))
    assert [(r.doc_id, r.score) for r in ranked] == best


def texts(seed, n):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdé日XY9") for _ in range(r.randint(1, 7))) for _ in range(300)]
    return [(d, r.choice((" ", ", ", "\n")).join(r.choices(vocabulary, k=r.randint(0, 60)))) for d in range(n)]


def test_equals_plain_version(spark):
    rows, target = texts(1, 400) + odd_rows(), [t for _, t in texts(2, 30)] + [None, ""]
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    compared(R.resample(frame(spark, rows), wanted).collect(), rows, target)
    compared(R.resample(frame(spark, rows), wanted, percent=100, least_words=0, buckets=97).collect(), rows, target, percent=100, least=0, buckets=97)
    compared(R.resample(frame(spark, rows), wanted, segment_rows=9).collect(), rows, target)


def test_nothing_to_draw(spark):
    none = spark.createDataFrame([], "text string")
    assert R.resample(frame(spark, []), none).collect() == []
    compared(R.resample(frame(spark, [(1, "few words")]), none).collect(), [(1, "few words")], [])
    compared(R.resample(frame(spark, texts(3, 50)), none, percent=0).collect(), texts(3, 50), [], percent=0)
    with pytest.raises(ValueError):
        R.resample(frame(spark, []), none, percent=101)


def test_a_third_of_the_rows_have_one_key(spark):
    hot = [(7, "one text of many words " * 6)] * 500
    rows = texts(5, 1000) + hot
    got = R.resample(frame(spark, rows), spark.createDataFrame([("one text",)], "text string"), percent=60, segment_rows=40)
    parts = [len(p) for p in got.where("rank is not null").rdd.glom().collect()]
    compared(got.collect(), rows, ["one text"], percent=60)
    assert max(parts) < 150, "equal keys are told apart by their place, so that no segment holds them all"


def test_checksums():
    r = random.Random(6)
    parts = [bytes(r.randrange(256) for _ in range(r.choice((1, 2, 5, 63, 64, 65, 300)))) for _ in range(200)]
    raw, sizes = np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts])
    got = R.crc_over(raw, np.cumsum(sizes) - sizes, sizes, np.full(len(parts), 0xFFFFFFFF, np.uint32)) ^ np.uint32(0xFFFFFFFF)
    assert got.tolist() == [zlib.crc32(p) for p in parts]
