import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from riskloom.llm import conversation_trie as T

SCHEMA = "conv_id long, turn long, role string, text string, depth long, x1 string, size string, steps long"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], SCHEMA).repartition(3)


def plain(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[c].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[tuple(p[:d])].append(c)
    children = defaultdict(list)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    saved, leaves = {}, {}
    for k in sorted(members, key=len, reverse=True):
        saved[k] = (len(members[k]) - 1) * (len(k[-1][1].encode()) if k else 0) + sum(saved[x] for x in children[k])
        leaves[k] = sum(leaves[x] for x in children[k]) or 1
    out = []
    for k, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(paths[c]) == len(k))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children[k]), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def talks(seed, n, longest=12, words=6):
    r = random.Random(seed)
    return [(c, t, r.choice(("user", "assistant")) if t else "user", "é" * r.randint(0, words)) for c in range(n) for t in range(r.randint(1, longest))]


def test_equals_plain_version(spark, monkeypatch):
    rows = talks(1, 120) + [(c, t, "u", f"same {t}") for c in range(200, 260) for t in range(6)]
    rows += [(3, None, None, None), (None, 1, "user", "no id"), (5, 2, "user", None), (5, 2, None, "tie"), (5, 2, None, "tie"), (400, None, "", "")]
    assert result(T.conversation_trie(table(spark, rows))) == plain(rows)
    # levels of few turns, shards of few turns and blocks of few ids give the same
    monkeypatch.setattr(T, "SHARD_TURNS", 7)
    monkeypatch.setattr(T, "BLOCK_IDS", 2)
    assert result(T.conversation_trie(table(spark, rows), level_turns=3)) == plain(rows)


def test_one_conversation_has_most_turns(spark):
    rows = talks(2, 40) + [(7, t, "user", f"turn {t % 50}") for t in range(20, 3000)] + [(11, None, "user", "again")] * 900
    assert result(T.conversation_trie(table(spark, rows), level_turns=64)) == plain(rows)


def test_nothing(spark):
    assert T.conversation_trie(table(spark, [])).collect() == []
    assert result(T.conversation_trie(table(spark, [(1, 1, "user", "a")]))) == plain([(1, 1, "user", "a")])


@pytest.mark.parametrize("seed", range(4))
def test_double_array_holds_just_its_sequences(seed):
    r = random.Random(seed)
    sequences = [[0, *(r.randrange(1, r.choice((3, 40, 500))) for _ in range(r.randint(0, 8)))] for _ in range(300)]
    flat, at = np.array([s for q in sequences for s in q]), np.cumsum([0, *map(len, sequences)])
    trie = T.DoubleArray(flat, at)
    slots = trie.walk(flat, at)
    prefixes = {}
    for q, a in zip(sequences, at):
        for d in range(len(q)):
            assert prefixes.setdefault(tuple(q[:d + 1]), slots[a + d]) == slots[a + d] > 0
    assert len(set(prefixes.values())) == len(prefixes) == (trie.check >= 0).sum()
    strange = [s for s in ([0, *(r.randrange(1, 500) for _ in range(3))] for _ in range(200)) if tuple(s) not in prefixes]
    at = np.arange(len(strange) + 1) * 4
    assert (trie.walk(np.array([x for s in strange for x in s]), at)[3::4] == -1).all()
