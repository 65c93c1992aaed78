import random
import re

from cases import frame, odd_rows

from riskloom.llm import decontaminate as D
from riskloom.llm.common import ASCII_LOWER

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(ASCII_LOWER))


def plain(rows, items, window=10):
    wanted = {}
    for i, t in items:
        w = words(t)
        for a in range(max(len(w) - window + 1, 1) if w else 0):
            wanted.setdefault(tuple(w[a:a + window]), set()).update([] if i is None else [str(i)])
    sizes = {len(k) for k in wanted}
    out = []
    for d, t in rows:
        w, hit, found = words(t), set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                if (k := tuple(w[a:a + n])) in wanted:
                    hit |= set(range(a, a + n))
                    found |= wanted[k]
        out.append((d, len(w), len(hit), sorted(found), bool(hit)))
    return sorted(out, key=repr)


def result(spark, rows, items, schema="item_id long, text string, hash long, n int, window string", **options):
    table = spark.createDataFrame([(i, t, 1, 2, "w") for i, t in items], schema)
    out = D.find_contamination(frame(spark, rows), table, **options)
    return sorted((tuple(r) for r in out.select("doc_id", "n_words", "n_hit", "item_ids", "contaminated").collect()), key=repr)


def corpus(seed):
    r = random.Random(seed)
    pool = [r.choice("abcdef") + r.choice("xyz") for _ in range(400)]
    items = []
    for i in range(25):
        a = r.randint(0, 360)
        items.append((i, " ".join(pool[a:a + r.choice((1, 2, 3, 7, 10, 11, 30))]).upper() + "."))
    rows = [(d, ", ".join(pool[a:a + r.randint(0, 40)])) for d in range(60) for a in [r.randint(0, 360)]]
    return rows, items


def test_equals_plain_version(spark):
    for seed in (1, 2):
        rows, items = corpus(seed)
        assert result(spark, rows, items) == plain(rows, items)
    assert result(spark, rows, items, window=5, shingle=2) == plain(rows, items, 5)


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    rows, items = corpus(3)
    assert result(spark, rows, items) == plain(rows, items)


def test_odd_rows(spark):
    rows = odd_rows()
    items = [(1, None), (2, ""), (None, "one two"), (3, "ONE"), (3, "ONE"), (4, "日本語🎉"), (5, " ".join(f"w{i % 977}" for i in range(40, 60))), (-6, "one")]
    assert result(spark, rows, items) == plain(rows, items)
    assert result(spark, rows, []) == plain(rows, [])
    assert result(spark, [], items) == []


def test_a_passage_in_a_third_of_all_documents(spark):
    passage = " ".join(f"p{i}" for i in range(15))
    rows = [(d, f"own{d} {passage} end{d}" if d % 3 == 0 else f"own{d} clean words only {d}") for d in range(120)]
    assert result(spark, rows, [(1, passage), (2, passage)]) == plain(rows, [(1, passage), (2, passage)])


def test_items_without_id_are_hit(spark, monkeypatch):
    passage = " ".join(f"p{i}" for i in range(15))
    rows = [(d, f"own{d} {passage} end" if d % 3 == 0 else "clean words only") for d in range(30)] + [(None, passage), (None, None)]
    items = [(None, passage), (None, passage), (7, "p3 p4 p5 p6 p7 p8 p9 p10 p11 p12")]
    for most in (D.BROADCAST_ROWS, 0):
        monkeypatch.setattr(D, "BROADCAST_ROWS", most)
        got = result(spark, rows, items)
        assert got == plain(rows, items) and sum(r[4] for r in got) == 11
        assert {tuple(r[3]) for r in result(spark, rows, items[:2])} == {()}
