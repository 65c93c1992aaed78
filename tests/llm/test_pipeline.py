"""Each stage on its own input against plain versions, and the whole run."""

import corpus_pipeline as P
from pyspark.sql import functions as F
from test_decontaminate import plain as plain_hits
from test_line_dedup import plain as plain_lines
from test_simhash import plain_components, plain_print

import __spark_entry__ as contract


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=repr)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(P.STAGES)
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "piece_tokens"]
    clean = stages["toxicity"](spark, docs, folder)
    assert clean.columns == docs.columns
    kept, given = rows_of(clean), rows_of(docs)
    assert set(kept) <= set(given) and len(kept) > 0.8 * len(given)

    fewer = stages["line_dedup"](spark, clean, folder)
    assert fewer.columns == docs.columns
    lines = rows_of(fewer)
    assert lines == sorted(((d, t) for d, _, _, t in plain_lines(kept)), key=repr)
    assert fewer.where(F.length("text") != F.col("n_chars")).count() == 0

    single = stages["near_dedup"](spark, fewer, folder)
    prints = {d: plain_print(t) for d, t in lines}
    roots, low = plain_components(set(prints.values())), {}
    for d, p in prints.items():
        low[roots[p]] = min(low.get(roots[p], d), d)
    alone = rows_of(single)
    assert alone == [(d, t) for d, t in lines if low[roots[prints[d]]] == d]

    pure = stages["decontamination"](spark, single, folder)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    hit = {d for d, _, _, _, bad in plain_hits(alone, items) if bad}
    assert rows_of(pure) == [(d, t) for d, t in alone if d not in hit] and pure.columns == docs.columns

    last = stages["piece_tokens"](spark, pure, folder)
    assert rows_of(last) == rows_of(pure)
    assert rows_of(contract.queries()["pipeline"](spark, folder)) == rows_of(last)


def test_nulls_and_nothing(spark, folder, tmp_path):
    docs = spark.createDataFrame(
        [(None, None, None, None, None), (1, None, "en", None, 3), (2, "", None, "s", 0), (2, "", None, "s", 0), (3, "a b c", "en", "s", 5)],
        "doc_id long, text string, lang string, source string, n_chars long")
    for some in (docs, docs.limit(0)):
        now = some
        for _, stage in P.STAGES:
            now = stage(spark, now, folder)
        now.collect()


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_missing_and_repeated_ids_lose_no_clean_row(spark, folder):
    item = next(r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").where("item_id is not null").collect() if len((r.text or "").split()) > 20)
    rows = [(None, item), (None, "clean without an id"), (None, None), (1, "x " + item), (1, "clean with the same id"), (1, "clean with the same id"), (2, "clean"), (3, item)]
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOCS).repartition(3)
    got = dict(P.STAGES)["decontamination"](spark, docs, folder)
    assert rows_of(got) == sorted([r for r in rows if item not in (r[1] or "")], key=repr) and got.columns == docs.columns


def test_one_row_of_each_group_stays(spark, folder):
    a, b, c, d = (" ".join(f"{w}{i}" for i in range(60)) for w in "abcd")
    rows = [(None, a), (None, a), (5, a), (1, a), (None, b), (2, c), (2, c), (2, d), (4, d), (3, c), (7, a + " " + b), (6, None), (8, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS).repartition(3)
    got = dict(P.STAGES)["near_dedup"](spark, docs, folder)
    assert rows_of(got) == sorted([(None, a), (None, b), (2, c), (2, d), (7, a + " " + b), (6, None)], key=repr)
    empty = spark.createDataFrame([], DOCS)
    assert dict(P.STAGES)["near_dedup"](spark, empty, folder).collect() == []
