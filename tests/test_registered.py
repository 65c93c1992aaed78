"""Every registered query with a SQL check agrees with it, and the feature job runs as a whole."""

import pytest
from pyspark.sql import functions as F
from sql_check import compare, connect

import __spark_entry__ as contract
from riskloom.catalog import mapping
from riskloom.plans.build import build_features

RUNS, CHECKS = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="session")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_agrees_with_sql(spark, folder, con, name):
    df = RUNS[name](spark, folder)
    cursor = con.execute(CHECKS[name])
    assert compare(df.columns, [tuple(r) for r in df.collect()], [d[0] for d in cursor.description], cursor.fetchall()) is None


def test_contract(spark):
    assert set(CHECKS) <= set(RUNS)
    df = contract.entry(spark)
    assert df.count() == 150 and len(df.columns) == len(set(df.columns)) > 30


def test_feature_job(spark, folder):
    tables = mapping.credit_tables(spark, folder)
    out = build_features(tables)
    assert all(c.passed for c in out.checks)
    assert out.test.columns == [c for c in out.train.columns if c != "TARGET"]
    assert out.train.count() == tables["application_train"].count() and out.test.count() == tables["application_test"].count()
    assert {"EXT_SOURCES_MEAN", "ORGANIZATION_TYPE_FREQ", "NAME_CONTRACT_TYPE", "inst_DPD_mean_365D"} <= set(out.train.columns)
    assert out.manifest["final_feature_count"] == len(out.train.columns) - 2


def test_feature_job_stops_on_bad_tables(spark, folder):
    tables = mapping.credit_tables(spark, folder)
    broken = dict(tables, application_train=tables["application_train"].drop("TARGET"), bureau=tables["bureau"].drop("SK_ID_BUREAU"))
    with pytest.raises(ValueError) as e:
        build_features(broken)
    assert "required_columns.application_train" in str(e.value) and "required_columns.bureau" in str(e.value)


def test_feature_job_writes_its_rows_once(spark, folder, monkeypatch):
    """Tables with the same columns are written once, filled; others are filled apart, and both ways agree."""
    from riskloom.operators import quality
    from riskloom.plans import build

    written = []
    for module in (build, quality):
        monkeypatch.setattr(module, "settle", lambda df, label="table", *codec, settle=module.settle: written.append(label) or settle(df, label, *codec))
    tables = mapping.credit_tables(spark, folder)
    once = build_features(tables)
    assert written == ["filled"]
    more = dict(tables, application_test=tables["application_test"].withColumn("ONLY_IN_TEST", F.lit(1.0)))
    apart = build_features(more)
    assert written == ["filled", "merged", "train", "test"]
    assert once.sparse == apart.sparse and once.sparse
    assert once.manifest == apart.manifest
    for one, two in ((once.train, apart.train), (once.test, apart.test)):
        assert one.columns == two.columns and dict(one.dtypes) == dict(two.dtypes)
        near = [F.round(c, 4).alias(c) if t == "double" else c for c, t in one.dtypes]
        assert one.select(near).exceptAll(two.select(near)).count() == 0 and one.count() == two.count()


def test_feature_job_fills_what_test_rows_lack(spark, folder):
    tables = mapping.credit_tables(spark, folder)
    out = build_features(dict(tables, application_test=tables["application_test"].drop("AMT_GOODS_PRICE")))
    assert "AMT_GOODS_PRICE" in out.manifest["dropped_columns"]["missing_columns_added_to_test"]
    assert out.test.columns == [c for c in out.train.columns if c != "TARGET"]
    assert {r[0] for r in out.test.select("AMT_GOODS_PRICE").collect()} == {0}


def test_feature_job_takes_enough_partitions(spark, folder, monkeypatch):
    """Of few partitions each would hold too many wide rows; the session's own number holds again afterwards."""
    from riskloom.plans import build

    seen = {}
    monkeypatch.setattr(build, "ENTITIES", 6)
    monkeypatch.setattr(build, "settle", lambda df, label="table", *codec, settle=build.settle: seen.update({label: spark.conf.get("spark.sql.shuffle.partitions")}) or settle(df, label, *codec))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    build_features(mapping.credit_tables(spark, folder))
    assert seen == {"filled": "25"} and before == "8" == spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(build, "fit_base", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        build_features(mapping.credit_tables(spark, folder))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
