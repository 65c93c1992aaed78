import pytest
from cases import frame, odd_rows, passages

from riskloom.llm import substring_dedup as S


def plain(rows, window):
    """Windows in order of doc_id and start; exact copies of a row are one place."""
    seen, out = {}, []
    for d, t in sorted({(-(2**63) if d is None else d, t or "") for d, t in rows}):
        words = t.encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            k = tuple(words[i:i + window])
            if k in seen:
                gone[i:i + window] = [True] * window
            seen.setdefault(k, (d, i))
        out.append((None if d == -(2**63) else d, len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode()))
    return out


def result(spark, rows, **options):
    return sorted(map(tuple, S.dedup_substrings(frame(spark, rows), **options).collect()), key=repr)


@pytest.mark.parametrize("seed,window,anchor", [(1, 20, 8), (2, 20, 8), (3, 6, 3), (4, 9, 9), (5, 5, 1)])
def test_equals_plain_version(spark, seed, window, anchor):
    rows = passages(seed)
    assert result(spark, rows, window=window, anchor=anchor) == sorted(plain(rows, window), key=repr)


def test_one_passage_in_a_third_of_all_documents(spark, monkeypatch):
    monkeypatch.setattr("riskloom.llm.common.CHUNK_BYTES", 2000)
    common = " ".join(f"c{i}" for i in range(25))
    rows = [(d, f"a{d} b{d} {common} e{d}" if d % 3 == 0 else f"only {d}") for d in range(300)] + [(500 + d, common) for d in range(40)]
    got = {r[0]: r[2] for r in result(spark, rows)}
    assert got[0] == 0 and all(got[d] == 25 for d in range(3, 300, 3)) and all(got[500 + d] == 25 for d in range(40))
    assert not any(got[d] for d in range(300) if d % 3)


def test_odd_rows(spark):
    rows = odd_rows()
    expected = {x[:3] for x in plain(rows, 20) if x[0] not in (None, 7)}
    got = result(spark, rows)
    assert len(got) == len(rows)
    assert {x[:3] for x in got if x[0] not in (None, 7)} == expected
    assert [x for x in got if x[0] == 8][0][2] == 30_000 - 977 - 19 + 19
    assert sum(x[2] for x in got if x[0] == 7) == 0


def test_rows_of_one_id_and_empty_table(spark):
    text = " ".join(f"t{i}" for i in range(30))
    got = sorted(r[2] for r in result(spark, [(1, text), (1, text), (1, "x " + text), (2, text)]))
    assert got == [0, 0, 30, 30] or got == [0, 30, 30, 30]
    assert result(spark, []) == []


def test_many_rows_without_id(spark):
    """Rows without id share nothing but their place in the order: 5,000 different texts with one passage and one text repeated."""
    common = " ".join(f"c{i}" for i in range(300))
    rows = [(None, f"own{d} {common} end{d}") for d in range(5000)] + [(None, common + " same")] * 500 + [(4, common)]
    got = S.dedup_substrings(frame(spark, rows)).groupBy("doc_id", "n_words", "n_removed").count().collect()
    found = {(r.doc_id, r.n_words, r.n_removed): r["count"] for r in got}
    # one text without id comes first and keeps the passage, all others lose it
    assert found.pop((4, 300, 300)) == 1
    assert sum(n for (_, words, gone), n in found.items() if gone == 300 and words == 302) == 4999 + (found.get((None, 301, 0), 0) > 0)
    assert sum(found.values()) == 5500


def test_cover():
    assert S.difference_cover(13) == (0, 1, 3, 9)
    for v in range(1, 17):
        c = S.difference_cover(v)
        assert {(a - b) % v for a in c for b in c} == set(range(v))
    with pytest.raises(ValueError):
        S.dedup_substrings(None, window=5, anchor=6)
