"""Checks, readers and writers."""

import pytest

from riskloom.operators import quality as q
from riskloom.plans import fixed_values as fv
from riskloom.sources import sinks, tables


def test_missing_and_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n1\n")
    (tmp_path / "b.csv").write_text("")
    checks = q.source_files({"a": str(tmp_path / "a.csv"), "b": str(tmp_path / "b.csv"), "c": str(tmp_path / "c.csv")}, spark)
    with pytest.raises(q.CheckFailure) as e:
        q.raise_on_failure(checks, "source")
    assert "raw_path_non_empty.b" in str(e.value) and "raw_path_exists.c" in str(e.value) and ".a" not in str(e.value)


def test_raw_tables_name_every_failure(spark):
    train = spark.createDataFrame([(1, 0), (1, 1)], "SK_ID_CURR long, TARGET int")
    test = spark.createDataFrame([(2,)], "SK_ID_CURR long")
    keys = spark.createDataFrame([(1, 1)], "SK_ID_CURR long, SK_ID_PREV long")
    histories = {n: keys for n in fv.REQUIRED_COLUMNS}
    histories["bureau"] = spark.createDataFrame([(1,)], "SK_ID_CURR long")
    histories["bureau_balance"] = spark.createDataFrame([(1,)], "SK_ID_BUREAU long")
    with pytest.raises(q.CheckFailure) as e:
        q.raise_on_failure(q.raw_table_checks(train, test, histories, fv.REQUIRED_COLUMNS, "SK_ID_CURR", "TARGET"), "raw")
    assert "unique_id.application_train" in str(e.value) and "required_columns.bureau" in str(e.value)
    assert "required_columns.bureau_balance" not in str(e.value)


def test_final_tables(spark):
    train = spark.createDataFrame([(1, 0, 1.0), (2, 2, 2.0)], "SK_ID_CURR long, TARGET int, A double")
    test = spark.createDataFrame([(3, 1.0)], "SK_ID_CURR long, B double")
    failed = {c.name for c in q.final_table_checks(train, test, "SK_ID_CURR", "TARGET") if not c.passed}
    assert failed == {"binary_target.final_train", "feature_alignment.final_test"}


def test_unique_key_counts_null_as_a_value(spark):
    assert q.unique_key("t", spark.createDataFrame([(None,), (1,)], "k int"), "k").passed
    assert not q.unique_key("t", spark.createDataFrame([(None,), (None,)], "k int"), "k").passed


def test_report_round_trip(spark, tmp_path):
    checks = [q.Check("s", "n", True, {"a": 1}), q.Check("s", "m", False)]
    path = sinks.write_table(q.report(spark, checks), str(tmp_path / "r"), "json")
    assert {(r.name, r.passed) for r in spark.read.json(path).collect()} == {("n", True), ("m", False)}


def test_csv_types_and_markers(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("SK_ID_CURR,AMT_CREDIT,flag,ratio,word,empty,ok\n1,NA,1,0.5,x,,true\n2,3,NaN,nan,NULL,,False\n3,4.5,7,2,NA,,NA\n")
    df = tables.read_csv(spark, str(path))
    assert dict(df.dtypes) == {"SK_ID_CURR": "bigint", "AMT_CREDIT": "double", "flag": "bigint", "ratio": "double", "word": "string", "empty": "string", "ok": "boolean"}
    rows = {r.SK_ID_CURR: r for r in df.collect()}
    assert rows[1].AMT_CREDIT is None and rows[2].flag is None and rows[2].ratio is None and rows[2].word is None and rows[3].ok is None
    with pytest.raises(ValueError, match="unknown column type"):
        tables.named_type("Float16")


def test_bad_values_are_fatal(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("SK_ID_CURR,x\nabc,1\n")
    with pytest.raises(Exception):
        tables.read_csv(spark, str(path)).collect()


def test_json_input(spark):
    assert tables.scoring_input(spark, json_text='{"A": 1, "B": 2.5}').collect()[0].asDict() == {"A": 1, "B": 2.5}
    assert tables.scoring_input(spark, json_text='[{"A": 1}, {"A": 2}]').count() == 2
    for bad in ("[]", "123", "[1, 2]", '[{"A": 1}, 2]'):
        with pytest.raises(ValueError):
            tables.rows_from_json(spark, bad)
    with pytest.raises(ValueError, match="more than 1"):
        tables.rows_from_json(spark, '[{"A": 1}, {"A": 2}]', max_rows=1)
    with pytest.raises(ValueError, match="not both"):
        tables.scoring_input(spark, "x.csv", "{}")
    with pytest.raises(ValueError, match="no scoring input"):
        tables.scoring_input(spark)


def test_payload_table(spark):
    df = spark.createDataFrame([(1, '{"k": 1}'), (2, '[{"k": 2}, {"k": 3}]'), (3, "[]"), (4, "7"), (5, "nonsense"), (6, None), (7, '[{"k": 1}, 2]')], "id int, body string")
    rows, bad = tables.split_payloads(df, "body", "struct<k:bigint>")
    assert sorted((r.id, r.row_index, r.k) for r in rows.collect()) == [(1, 0, 1), (2, 0, 2), (2, 1, 3)]
    assert sorted(r.id for r in bad.collect()) == [3, 4, 5, 6, 7]


def test_submission_rejects_a_target(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5)], "SK_ID_CURR long, p double")
    with pytest.raises(ValueError):
        sinks.write_submission(df, spark.createDataFrame([(1, 1)], "SK_ID_CURR long, TARGET int"), str(tmp_path / "s"), "SK_ID_CURR", "TARGET", "p")
    two = spark.createDataFrame([(1,), (2,)], "SK_ID_CURR long")
    with pytest.raises(ValueError, match="1 scored rows for 2"):
        sinks.write_submission(df, two, str(tmp_path / "s"), "SK_ID_CURR", "TARGET", "p")


def test_fingerprint(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y")], "k int, v string")
    same = a.select("v", "k").repartition(3)
    other = spark.createDataFrame([(1, "x"), (3, "z"), (3, "z")], "k int, v string")
    assert q.fingerprint(a).first() == q.fingerprint(same).first()
    assert q.fingerprint(a).first() != q.fingerprint(other).first()


def test_cluster_needs_a_shared_folder(spark, monkeypatch):
    from riskloom import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Fake:
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Fake())
    Fake.conf = type("C", (), {"get": staticmethod(lambda k, d=None: "hdfs:///shared" if k == "spark.checkpoint.dir" else d)})
    assert session.shared_folder(Fake()) == "hdfs:///shared"


def test_types_come_from_all_rows(spark, tmp_path):
    path = str(tmp_path / "late.csv")
    rows = [f"{i},{i}" for i in range(10_020)] + ["10020,0.5", "10021,7"]
    with open(path, "w") as f:
        f.write("id,value\n" + "\n".join(rows) + "\n")
    df = tables.read_csv(spark, path)
    assert dict(df.dtypes) == {"id": "bigint", "value": "double"} and df.where("value = 0.5").count() == 1


def test_submission_is_checked_before_the_write(spark, tmp_path):
    path = str(tmp_path / "out")
    source = spark.range(5).withColumnRenamed("id", "k")
    scored = source.selectExpr("k", "0.5D AS p")
    sinks.write_submission(scored, source, path, "k", "t", "p")
    with pytest.raises(ValueError, match="not written"):
        sinks.write_submission(scored.where("k < 3"), source, path, "k", "t", "p")
    assert spark.read.parquet(path).count() == 5


def test_facts_of_a_written_table(spark):
    """Facts equal those of separate passes, on all rows or some; checks that are given them start no job."""
    df = spark.range(1000).repartition(5).selectExpr(
        "id", "CAST(id % 3 AS INT) AS TARGET", "CASE WHEN id % 4 > 0 THEN id END AS a", "CASE id % 50 WHEN 0 THEN CAST('NaN' AS DOUBLE) WHEN 1 THEN CAST('Infinity' AS DOUBLE) ELSE 1D END AS b",
        "CAST(NULL AS STRING) AS c", "id < 600 AS part")
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup("facts"))
    spark.sparkContext.setJobGroup("facts", "facts")
    settled, facts = q.settle_with_facts(df, "seen", "TARGET")
    before = jobs()
    checks = q.completeness("t", settled, facts=facts) + [q.binary_target("t", settled, "TARGET", facts=facts)]
    sparse = q.sparse_columns(settled, ["a", "c"], 0.2, facts)
    assert jobs() == before > 0
    spark.sparkContext.setJobGroup("other", "other")
    assert facts == q.TableFacts(1000, {"id": 0, "TARGET": 0, "a": 250, "b": 0, "c": 1000, "part": 0}, {"b": 40}, 333)
    assert checks == q.completeness("t", settled) + [q.binary_target("t", settled, "TARGET")]
    assert sparse == q.sparse_columns(settled, ["a", "c"], 0.2) == {"a": 0.25, "c": 1.0}
    _, some = q.settle_with_facts(df, "some", only="part")
    assert some.rows == 600 and some.nulls["a"] == 150 and some.nulls["c"] == 600 and some.invalid == {"b": 24}


def test_many_conditions_are_counted_by_place(spark, monkeypatch):
    """Both ways of counting agree, also on no rows and where a condition is null or never holds."""
    df = spark.range(500).selectExpr("id", "CASE WHEN id % 4 > 0 THEN id END AS a", "CASE WHEN id % 50 = 0 THEN CAST('NaN' AS DOUBLE) ELSE 1D END AS b", "CAST(id % 3 AS INT) AS TARGET", "id < 100 AS part")
    flags = ["TRUE", "a IS NULL", "false", "isnan(b)", "a > 250"]
    assert q.count_flags(df, flags) == [500, 125, 0, 10, 187]
    few, none, some = q.table_facts(df, "TARGET"), q.table_facts(df.where("false"), "TARGET"), q.table_facts(df, only="part")
    monkeypatch.setattr(q, "MOST_AGGREGATES", 0)
    assert q.count_flags(df, flags) == [500, 125, 0, 10, 187]
    assert few == q.table_facts(df, "TARGET") and none == q.table_facts(df.where("false"), "TARGET") and some == q.table_facts(df, only="part")


def test_null_bits_tell_nulls_after_they_are_filled(spark):
    columns = [f"c{i}" for i in range(70)]
    df = spark.range(200).selectExpr("id", "id % 5 <> 0 AS part", *[f"CASE WHEN id % {i + 2} <> 0 THEN id END AS {c}" for i, c in enumerate(columns)])
    wanted = q.table_facts(df, only="part")
    kept = df.selectExpr("*", *q.null_bits(columns)).na.fill(0)
    got = q.facts_of_bits(kept, columns, "part")
    assert got.rows == wanted.rows == 160 and got.nulls == {c: wanted.nulls[c] for c in columns}
    assert q.sparse_columns(kept, columns, 0.3, got) == q.sparse_columns(df.where("part"), columns, 0.3)
    empty = q.facts_of_bits(kept.where("id < 0"), columns, "part")
    assert empty.rows == 0 and not any(empty.nulls.values())
