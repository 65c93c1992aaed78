import numpy as np
import pytest
from cases import frame, odd_rows

from riskloom.llm import line_dedup as L


def plain(rows, least=20, documents=3):
    holders = {}
    for d, t in rows:
        if d is not None:
            for line in (t or "").encode().split(b"\n"):
                holders.setdefault(line.strip().lower(), set()).add(d)
    out = []
    for d, t in rows:
        lines = (t or "").encode().split(b"\n")
        kept = []
        for line in lines:
            k = line.strip().lower()
            own = holders.get(k, set())
            if not (d is not None and len(k.decode()) >= least and len(own) >= documents and d < max(own)):
                kept.append(line)
        out.append((d, len(lines), len(lines) - len(kept), b"\n".join(kept).decode()))
    return sorted(out, key=repr)


def result(df):
    return sorted(map(tuple, df.select("doc_id", "n_lines", "n_dropped", "kept_text").collect()), key=repr)


def test_equals_plain_version(spark):
    common = ["  Read the terms and conditions here ", "read THE terms and conditions HERE", "Ääääääääääääääääääää", "short", "in two documents only, no more"]
    rows = [(d, "\n".join(["own line of document number %d" % d, common[d % 2], common[2], common[3], *(common[4:] if d < 2 else []), common[2]])) for d in range(40)]
    assert result(L.dedup_lines(frame(spark, rows))) == plain(rows)
    assert result(L.dedup_lines(frame(spark, rows), filter_bits=8 * L.SEGMENT, min_docs=2)) == plain(rows, documents=2)


def test_odd_rows_keep_their_columns(spark):
    rows = odd_rows()
    got = L.dedup_lines(frame(spark, rows))
    assert result(got) == plain(rows)
    first = got.first()
    assert first.rest.lang == "en" and first.rest.rest == "r" and first.rest.key == "y"
    assert result(L.dedup_lines(frame(spark, []))) == []
    assert result(L.dedup_lines(spark.createDataFrame([(1, "a")], "doc_id int, text string"))) == [(1, 1, 0, "a")]


def test_filters_lose_no_repeat():
    r = np.random.default_rng(1)
    bits = 8 * L.SEGMENT
    parts = [r.integers(0, 2**63, 3000, dtype=np.uint64) for _ in range(4)]
    again = np.concatenate([parts[0][:500], parts[1][:500]])
    parts[2][:500], parts[3][:500] = parts[0][:500], parts[1][:500]
    rows = []
    for p in parts:
        seen = L.SeenTwice(bits)
        for x in np.array_split(p, 3):
            seen.add(x)
        rows += list(seen.segments())
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([s for s, _ in sorted(rows, key=lambda x: x[0])], pa.int32()), pa.array([f for _, f in sorted(rows, key=lambda x: x[0])], pa.binary())], ["segment", "filters"])
    import zlib

    table = np.zeros(bits // 8, np.uint8)
    for out in L._merge(iter([batch])):
        part = np.frombuffer(zlib.decompress(out.column("again")[0].as_py()), np.uint8)
        at = out.column("segment")[0].as_py() * L.SEGMENT
        table[at:at + part.size] = part
    assert L.SeenTwice.holds(table, again).all()
    assert L.SeenTwice.holds(table, parts[0][500:]).mean() < 0.2


def test_bad_options(spark):
    for options in ({"filter_bits": 1000}, {"min_docs": 1}):
        with pytest.raises(ValueError):
            L.dedup_lines(frame(spark, []), **options)
