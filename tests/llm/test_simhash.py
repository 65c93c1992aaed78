import random
from itertools import combinations

import numpy as np
import xxhash
from cases import frame, odd_rows, passages

from riskloom.llm import simhash as S
from riskloom.llm.components import components


def plain_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(prints, radius=3):
    root = {p: p for p in prints}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in combinations(sorted(root), 2):
        if (a ^ b).bit_count() <= radius:
            root[find(a)] = find(b)
    return {p: find(p) for p in root}


def test_every_pair_within_the_radius_meets():
    masks = S.covering_masks(3)
    assert len(masks) == 15
    for bits in combinations(range(64), 3):
        gone = sum(1 << b for b in bits)
        assert any(not m & gone for m in masks)
    free = [b for b in range(64) if not masks[0] >> b & 1]
    inner = S.covering_masks(3, free)
    for bits in combinations(free, 3):
        assert any(not m & sum(1 << b for b in bits) for m in inner)
    assert all(len(free) - m.bit_count() <= 14 for m in inner)


def links_of(spark, prints, **options):
    frame_ = spark.createDataFrame([(S.as_long(p), 0) for p in prints], "bits long, low long").repartition(4)
    return {tuple(r) for r in S.links(frame_, **options).collect()}


def test_links_connect_what_pairs_connect(spark):
    r = random.Random(4)
    prints = set()
    for _ in range(40):
        p = r.getrandbits(64)
        for _ in range(r.randint(1, 12)):
            prints.add(p)
            for b in r.sample(range(64), r.randint(1, 5)):
                p ^= 1 << b
    dense = r.getrandbits(64)
    prints |= {dense ^ r.getrandbits(9) for _ in range(300)}
    expected = plain_components(prints)
    for crowd in (4096, 20):
        edges = links_of(spark, prints, crowd=crowd)
        assert all((np.uint64(a & (2**64 - 1)) ^ np.uint64(b & (2**64 - 1))).item().bit_count() <= 3 for a, b in edges)
        assert len(edges) < 15 * len(prints)
        roots = {x.node: x.root for x in components(spark.createDataFrame(sorted(edges), "a long, b long")).collect()}
        groups, own = {}, {}
        for p, root in expected.items():
            groups.setdefault(root, set()).add(S.as_long(p))
        for p in prints:
            own.setdefault(roots.get(S.as_long(p), S.as_long(p)), set()).add(S.as_long(p))
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, own.values()))


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(201)) and all(got[i] == 1000 for i in range(1000, 1300)) and 5000 not in got
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def check(spark, rows):
    got = sorted(map(tuple, S.near_duplicates(frame(spark, rows)).collect()), key=repr)
    prints = [plain_print(t) for _, t in rows]
    roots = plain_components(set(prints))
    low = {}
    for (d, _), p in zip(rows, prints):
        low[roots[p]] = min(low.get(roots[p], 2**63), -(2**63) if d is None else d)
    expected = [(d, f"{p:016x}", None if low[roots[p]] == -(2**63) else low[roots[p]]) for (d, _), p in zip(rows, prints)]
    assert got == sorted(expected, key=repr)


def test_equals_plain_version(spark):
    rows = passages(7, 80)
    check(spark, rows + [(1000 + d, t + " more") for d, t in rows[:20]] + [(2000 + d, t) for d, t in rows[:20]])


def test_odd_rows(spark):
    check(spark, odd_rows())
    assert S.near_duplicates(frame(spark, [])).collect() == []
