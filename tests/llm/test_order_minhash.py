import random

import numpy as np
import pytest
import xxhash
from cases import frame, odd_rows

from riskloom.llm import order_minhash as O

HEAD = 2**63


def result(spark, rows, **options):
    return O.fingerprint_documents(frame(spark, rows), **options).collect()


def signed_hash(text):
    h = xxhash.xxh64(text.encode(), seed=42).intdigest()
    return h - 2**64 if h >= HEAD else h


def edited(rows):
    ordered = sorted(((-HEAD if d is None else d, t or "") for d, t in rows), key=lambda r: (r[0], signed_hash(r[1]), r[1]))
    out = []
    for i, (d, t) in enumerate(ordered):
        other, half = ordered[(i + 1) % len(ordered)][1], len(t) // 2
        out.append((None if d == -HEAD else d, len(t), t[:len(t) - half] + other[:half]))
    return sorted(out, key=repr)


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("aeioubcd") for _ in range(r.randint(2, 7))) for _ in range(n))


def test_edited_texts_and_edges(spark):
    rows = odd_rows() + [(d, prose(d, d % 50)) for d in range(20, 400)]
    got = result(spark, rows)
    assert sorted(((r.doc_id, r.n_chars, r.edited) for r in got), key=repr) == edited(rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and len(r.fingerprint) == 512 for r in got)
    assert result(spark, []) == []
    one = result(spark, [(1, "a b c d e f g h")])
    assert one[0].near_next == 1.0 and one[0].edited == "a b c d a b c d "[:8] + "a b c d"


def test_equal_texts_and_order(spark):
    text = prose(1, 300)
    words = text.split()
    swapped = " ".join(words[150:] + words[:150])
    rows = [(1, text), (2, text), (3, swapped), (4, prose(2, 300)), (5, "same words " * 40), (6, "same words " * 41), (7, None), (8, " ")]
    got = {r.doc_id: r for r in result(spark, rows)}
    assert got[1].fingerprint == got[2].fingerprint and got[1].near_next == 1.0
    assert 0.2 < got[2].near_next < 0.9  # the same k-mers but for the seam, in another order
    assert got[3].near_next < 0.1 and got[7].near_next == 1.0
    assert got[5].fingerprint != got[6].fingerprint or got[5].near_next == 1.0


def test_likeness_falls_with_edits(spark):
    text = prose(3, 400).split()
    rows = []
    for i, changed in enumerate((0, 4, 40, 200)):
        r = random.Random(i)
        other = list(text)
        for at in r.sample(range(400), changed):
            other[at] = "zz"
        rows += [(2 * i, " ".join(text)), (2 * i + 1, " ".join(other))]
    got = {r.doc_id: r.near_next for r in result(spark, rows)}
    assert got[0] == 1.0 and got[0] > got[2] > got[4] >= got[6] and got[2] > 0.5


def test_repeated_words_are_counted(spark):
    """Repeats are elements of their own before the sample is taken."""
    head = prose(4, 200)
    rows = [(1, "la " * 1_000), (2, "la " * 100_000), (3, "same words " * 4_000), (4, "same words " * 1_000), (5, "la " * 5_000 + head), (6, "la " * 5_000 + prose(5, 200))]
    got = {r.doc_id: r for r in result(spark, rows)}
    assert len({r.fingerprint for r in got.values()}) == 6
    assert got[1].near_next < 0.2 and got[3].near_next < 0.4
    assert got[5].near_next > 0.5  # 5,000 of about 5,200 elements are the same
    halves = result(spark, [(1, "la " * 1_000), (2, "la " * 1_020)])
    assert halves[0].near_next > 0.6  # 996 of 1,016 elements are the same


def plain_components(text, k=5, components=64):
    """The ordered pair of (k-mer, occurrence) of each component, by walking the circle."""
    words = text.split()
    met, elements = {}, []
    for i in range(max(len(words) - k + 1, 1) if words else 0):
        kmer = tuple(words[i:i + k])
        n = met[kmer] = met.get(kmer, -1) + 1
        elements.append((kmer, n))
    hashes = []
    for kmer, n in elements:
        h = 42 % 2**64
        for w in kmer:
            h = xxhash.xxh64(w.encode(), seed=h).intdigest()
        if n:
            first = xxhash.xxh64(h.to_bytes(8, "little"), seed=42).intdigest()
            h = xxhash.xxh64(n.to_bytes(4, "little"), seed=first).intdigest()
        hashes.append((h - 2**64 if h >= HEAD else h) >> 28)
    order = sorted(range(len(elements)), key=lambda j: (hashes[j], j))
    out = []
    for c in range(components):
        point = (-HEAD + c * (2**64 // components)) >> 28
        nth = sum(hashes[j] < point for j in order)
        pair = sorted(order[(nth + n) % len(order)] for n in (0, 1)) if order else []
        out.append(tuple(elements[j] for j in pair))
    return out


def true_share(a, b):
    """The chance that a random order of all elements gives both texts the same first two, in the same order of the text."""
    one, two = (plain_elements(t) for t in (a, b))
    common = sorted(set(one) & set(two), key=one.get)
    n = len(set(one) | set(two))
    places = np.array([two[e] for e in common])
    agree = sum(int((places[i + 1:] > places[i]).sum()) for i in range(len(places)))
    return agree / (n * (n - 1) / 2)


def plain_elements(text, k=5):
    words, met, out = text.split(), {}, {}
    for i in range(len(words) - k + 1):
        kmer = tuple(words[i:i + k])
        n = met[kmer] = met.get(kmer, -1) + 1
        out[kmer, n] = i
    return out


def test_equals_a_plain_walk_along_the_circle(spark):
    """Likeness of neighbours, over texts with and without repeats, short and long."""
    r = random.Random(9)
    rows = []
    for d in range(60):
        text = prose(d // 4, r.choice((1, 4, 6, 30, 300))).split() * r.choice((1, 1, 3))
        for at in r.sample(range(len(text)), min(len(text), r.choice((0, 1, 5)))):
            text[at] = "zz"
        rows.append((d, " ".join(text)))
    parts = {d: plain_components(t) for d, t in rows}
    for row in result(spark, rows):
        other = parts[(row.doc_id + 1) % 60]
        assert row.near_next == sum(a == b for a, b in zip(parts[row.doc_id], other)) / 64


@pytest.mark.parametrize("n, bias, error", [(30, 0.05, 0.15), (300, 0.03, 0.08), (3000, 0.03, 0.09)])
def test_error_of_the_likeness(spark, n, bias, error):
    """Mean and root mean square of (estimate - chance over all orders) for 60 pairs with a tenth of their words changed."""
    rows, truth = [], {}
    for d in range(60):
        r = random.Random(d)
        text = prose(d, n).split()
        other = list(text)
        start = r.randint(0, n - n // 10)
        for at in range(start, start + n // 10):
            other[at] = f"z{r.random()}"
        rows += [(2 * d, " ".join(text)), (2 * d + 1, " ".join(other))]
        truth[2 * d] = true_share(rows[-2][1], rows[-1][1])
    got = {r.doc_id: r.near_next for r in result(spark, rows)}
    off = np.array([got[d] - x for d, x in truth.items()])
    assert abs(off.mean()) < bias and np.sqrt((off**2).mean()) < error


def test_many_rows_without_id(spark):
    rows = [(None, prose(d, 8)) for d in range(3000)] + [(5, prose(1, 20)), (6, None)]
    got = result(spark, rows)
    assert sorted(((r.doc_id, r.n_chars, r.edited) for r in got), key=repr) == edited(rows)
