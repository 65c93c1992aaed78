"""Data check queries: Q01-Q11, S10."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog import mapping as m
from riskloom.catalog.expressions import DIRTY_SQL, _dirty
from riskloom.catalog.registry import query, r, rounded, table
from riskloom.operators import quality as qc
from riskloom.plans import fixed_values as fv
from riskloom.plans.training import check_reuse, run_metadata
from riskloom.session import scratch_path
from riskloom.sources.sinks import write_table

KEY = "SK_ID_CURR"
SOURCES = ("customer", "orders", "lineitem", "events", "part")
CHECKS = "section string, name string, passed boolean"


def _rows(spark, checks):
    return qc.report(spark, checks).select("name", F.col("passed").cast("long").alias("passed"))


@query("q01_source_files", " UNION ALL ".join(
    f"SELECT 'raw_path_{kind}.{t}' AS name, CAST(count(*) > 0 AS BIGINT) AS passed FROM {t}" for t in SOURCES for kind in ("exists", "non_empty")))
def source_files(spark, folder):
    return _rows(spark, qc.source_files({t: f"{folder}/{t}.parquet" for t in SOURCES}, spark))


_HAVE = {"bureau": "bureau", "bureau_balance": "bureau_balance", "pos_cash_balance": "pos_cash"}


@query("q02_required_columns", f"""WITH {m.BUREAU_SQL}, {m.BUREAU_BALANCE_SQL}, {m.POS_SQL} """ + " UNION ALL ".join(
    f"SELECT 'required_columns.{n}' AS name, CAST(count(*) FILTER (WHERE column_name IN ({', '.join(repr(c) for c in fv.REQUIRED_COLUMNS[n])})) = {len(fv.REQUIRED_COLUMNS[n])} AS BIGINT) AS passed FROM (DESCRIBE {t})"
    for n, t in _HAVE.items()) + " UNION ALL SELECT 'required_columns.renamed', CAST(count(*) FILTER (WHERE column_name = 'SK_ID_PREV') = 1 AS BIGINT) FROM (DESCRIBE bureau)")
def required_columns(spark, folder):
    tables = {"bureau": m.bureau(spark, folder), "bureau_balance": m.bureau_balance(spark, folder), "pos_cash_balance": m.pos_cash(spark, folder)}
    checks = [qc.required_columns(n, df.columns, fv.REQUIRED_COLUMNS[n]) for n, df in tables.items()]
    return _rows(spark, [*checks, qc.required_columns("renamed", tables["bureau"].columns, ["SK_ID_PREV"])])


@query("q03_repeated_keys", "SELECT l_orderkey, count(*) AS row_count FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def repeated(spark, folder):
    return qc.repeated_keys(table(spark, folder, "lineitem"), "l_orderkey")


@query("q03_unique_key", """SELECT 'unique_id.customer' AS name, CAST(count(DISTINCT c_custkey) = count(*) AS BIGINT) AS passed FROM customer
 UNION ALL SELECT 'unique_id.lineitem', CAST(count(DISTINCT l_orderkey) = count(*) AS BIGINT) FROM lineitem""")
def unique_key(spark, folder):
    return _rows(spark, [
        qc.unique_key("customer", table(spark, folder, "customer"), "c_custkey"), qc.unique_key("lineitem", table(spark, folder, "lineitem"), "l_orderkey"),
    ])


@query("q04_binary_target", f"""WITH {m.APPLICATION_SQL} SELECT 'binary_target.application' AS name, CAST(count(*) FILTER (WHERE TARGET NOT IN (0, 1)) = 0 AS BIGINT) AS passed FROM application
 UNION ALL SELECT 'binary_target.lines', CAST(count(*) FILTER (WHERE l_linenumber NOT IN (0, 1)) = 0 AS BIGINT) FROM lineitem""")
def binary_target(spark, folder):
    return _rows(spark, [
        qc.binary_target("application", m.application(spark, folder), "TARGET"), qc.binary_target("lines", table(spark, folder, "lineitem"), "l_linenumber"),
    ])


_DESCRIBE = "(SELECT count(*) FROM (DESCRIBE {t}) WHERE column_name = 'TARGET')"


@query("q05_target_presence", f"""WITH {m.APPLICATION_SQL}, train AS (SELECT * FROM application), test AS (SELECT * EXCLUDE (TARGET) FROM application)
 SELECT 'target_present.train' AS name, CAST({_DESCRIBE.format(t='train')} = 1 AS BIGINT) AS passed UNION ALL SELECT 'target_absent.test', CAST({_DESCRIBE.format(t='test')} = 0 AS BIGINT)
 UNION ALL SELECT 'target_absent.train', CAST({_DESCRIBE.format(t='train')} = 0 AS BIGINT)""")
def target_presence(spark, folder):
    train, test = m.application(spark, folder), m.test_rows(m.application(spark, folder))
    return _rows(spark, [
        qc.target_presence("train", train.columns, "TARGET", True), qc.target_presence("test", test.columns, "TARGET", False),
        qc.target_presence("train", train.columns, "TARGET", False),
    ])


@query("q06_column_alignment", f"""WITH {m.APPLICATION_SQL}, test AS (SELECT * EXCLUDE (TARGET) FROM application), moved AS (SELECT * EXCLUDE (TARGET, AMT_CREDIT), AMT_CREDIT FROM application),
 a AS (SELECT list(column_name) AS c FROM (DESCRIBE application) WHERE column_name <> 'TARGET')
 SELECT 'feature_alignment.test' AS name, CAST((SELECT list(column_name) FROM (DESCRIBE test)) = c AS BIGINT) AS passed FROM a
 UNION ALL SELECT 'feature_alignment.moved', CAST((SELECT list(column_name) FROM (DESCRIBE moved)) = c AS BIGINT) FROM a""")
def column_alignment(spark, folder):
    train = m.application(spark, folder)
    test = m.test_rows(train)
    moved = test.select(*[c for c in test.columns if c != "AMT_CREDIT"], "AMT_CREDIT")
    return _rows(spark, [qc.same_columns("test", train.columns, test.columns, "TARGET"), qc.same_columns("moved", train.columns, moved.columns, "TARGET")])


@query("q07_completeness", f"""WITH {DIRTY_SQL} SELECT 'no_nulls.dirty' AS name, CAST(count(*) FILTER (WHERE amount IS NULL OR nation IS NULL) = 0 AS BIGINT) AS passed FROM dirty
 UNION ALL SELECT 'no_invalid_numeric.dirty', CAST(count(*) FILTER (WHERE isnan(amount) OR isinf(amount)) = 0 AS BIGINT) FROM dirty
 UNION ALL SELECT 'no_nulls.customer', CAST(count(*) FILTER (WHERE c_acctbal IS NULL OR c_name IS NULL OR c_nationkey IS NULL OR c_mktsegment IS NULL) = 0 AS BIGINT) FROM customer
 UNION ALL SELECT 'no_invalid_numeric.customer', CAST(count(*) FILTER (WHERE isnan(c_acctbal) OR isinf(c_acctbal)) = 0 AS BIGINT) FROM customer""")
def completeness(spark, folder):
    return _rows(spark, qc.completeness("dirty", _dirty(spark, folder)) + qc.completeness("customer", table(spark, folder, "customer")))


@query("q08_report_and_fail", f"""WITH {DIRTY_SQL} SELECT 'dirty checks failed: unique_id.lineitem, no_nulls.dirty, no_invalid_numeric.dirty' AS message, count(*) AS "rows" FROM dirty
 HAVING count(*) FILTER (WHERE amount IS NULL) > 0 AND count(*) FILTER (WHERE isnan(amount)) > 0""")
def report_and_fail(spark, folder):
    """All failures are collected and named in one error."""
    dirty = _dirty(spark, folder)
    checks = [qc.unique_key("lineitem", table(spark, folder, "lineitem"), "l_orderkey"), qc.unique_key("dirty", dirty, "c_custkey"), *qc.completeness("dirty", dirty)]
    message = "passed"
    try:
        qc.raise_on_failure(checks, "dirty")
    except qc.CheckFailure as failure:
        message = str(failure)
    return dirty.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(message).alias("message"), "rows")


_FINAL = ("target_present.final_train", "target_absent.final_test", "binary_target.final_train", "unique_id.final_train", "unique_id.final_test",
          "feature_alignment.final_test", "no_nulls.final_train", "no_nulls.final_test", "no_invalid_numeric.final_train", "no_invalid_numeric.final_test")
_FINAL_SQL = {
    "binary_target": "(SELECT count(*) FILTER (WHERE TARGET IS NULL OR TARGET NOT IN (0, 1)) = 0 FROM {t})",
    "unique_id": f"(SELECT count(*) = count(DISTINCT {KEY}) AND count(*) FILTER (WHERE {KEY} IS NULL) = 0 FROM {{t}})",
    "no_nulls": "((SELECT count(*) FROM {t} WHERE COLUMNS(*) IS NOT NULL) = (SELECT count(*) FROM {t}))",
}


def _final_sql(faulty: str) -> str:
    return f"WITH {m.APPLICATION_SQL}, {m.SPLIT_SQL.replace('FROM application', faulty)} " + " UNION ALL ".join(
        f"SELECT '{n}' AS name, CAST({_FINAL_SQL.get(n.split('.')[0], 'TRUE').format(t=n.split('_')[-1])} AS BIGINT) AS passed" for n in _FINAL)


@query("q09_final_checks", _final_sql("FROM application"))
def final_checks(spark, folder):
    """All columns of the customers, of which many have nulls."""
    df = m.application(spark, folder)
    return _rows(spark, qc.final_table_checks(m.train_rows(df), m.test_rows(df), KEY, "TARGET"))


@query("q09_final_checks_of_filled", _final_sql(f"FROM (SELECT {KEY} - CAST({KEY} % 100 = 7 AS INT) * 5 AS {KEY}, TARGET + CAST({KEY} % 50 = 3 AS INT) * 2 AS TARGET, AMT_CREDIT FROM application)"))
def final_checks_of_filled(spark, folder):
    """Columns without nulls, but with repeated ids and targets that are neither 0 nor 1."""
    key = F.col(KEY)
    df = m.application(spark, folder).select(
        (key - (key % 100 == 7).cast("int") * 5).alias(KEY), (F.col("TARGET") + (key % 50 == 3).cast("int") * 2).alias("TARGET"), "AMT_CREDIT")
    return _rows(spark, qc.final_table_checks(m.train_rows(df), m.test_rows(df), KEY, "TARGET"))


@query("q10_sparse_columns", f"""WITH {m.APPLICATION_SQL}, {m.POS_SQL}, {m.BUREAU_SQL}, a AS (SELECT SK_ID_CURR, max(SK_DPD) AS d FROM pos_cash GROUP BY 1), b AS (SELECT SK_ID_CURR, max(AMT_CREDIT_SUM) AS s FROM bureau GROUP BY 1),
 j AS (SELECT * FROM application LEFT JOIN a USING (SK_ID_CURR) LEFT JOIN b USING (SK_ID_CURR)),
 x AS (SELECT 'pos_SK_DPD_max' AS name, 1 - count(d) / count(*) AS rate FROM j UNION ALL SELECT 'bureau_AMT_CREDIT_SUM_max', 1 - count(s) / count(*) FROM j) SELECT name, {r('rate')} AS rate FROM x WHERE rate > 0.6""")
def sparse(spark, folder):
    pos = m.pos_cash(spark, folder).groupBy(KEY).agg(F.max("SK_DPD").alias("pos_SK_DPD_max"))
    loans = m.bureau(spark, folder).groupBy(KEY).agg(F.max("AMT_CREDIT_SUM").alias("bureau_AMT_CREDIT_SUM_max"))
    df = m.application(spark, folder).select(KEY).join(pos, KEY, "left").join(loans, KEY, "left")
    found = qc.sparse_columns(df, ["pos_SK_DPD_max", "bureau_AMT_CREDIT_SUM_max"], 0.6)
    return spark.createDataFrame(list(found.items()), "name string, rate double").select("name", rounded("rate").alias("rate"))


@query("q11_fingerprint", "SELECT count(*) AS \"rows\", CAST(1 AS BIGINT) AS same_when_reordered, CAST(1 AS BIGINT) AS differs_when_changed FROM orders")
def fingerprint(spark, folder):
    """Equal for the same rows in another order and layout, different once a value changes."""
    df = table(spark, folder, "orders")
    parts = ["content_xor", "content_sum"]

    def named(d, tag):
        return qc.fingerprint(d).select("rows", *[F.col(c).alias(f"{tag}_{c}") for c in parts]).withColumn("one", F.lit(1))

    moved = df.repartition(7, "o_custkey").select(*reversed(df.columns))
    changed = df.withColumn("o_totalprice", F.when(F.col("o_orderkey") == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    joined = named(df, "a").join(named(moved, "b").drop("rows"), "one").join(named(changed, "c").drop("rows"), "one")
    same = (F.col("a_content_xor") == F.col("b_content_xor")) & (F.col("a_content_sum") == F.col("b_content_sum"))
    return joined.select("rows", same.cast("long").alias("same_when_reordered"), (F.col("a_content_xor") != F.col("c_content_xor")).cast("long").alias("differs_when_changed"))


@query("s10_check_report", """SELECT 'schema' AS section, 'unique_id.orders' AS name, CAST(count(DISTINCT o_orderkey) = count(*) AS BIGINT) AS passed FROM orders
 UNION ALL SELECT 'schema', 'unique_id.lineitem', CAST(count(DISTINCT l_orderkey) = count(*) AS BIGINT) FROM lineitem
 UNION ALL SELECT 'schema', 'binary_target.labels', CAST(count(*) FILTER (WHERE quality NOT IN (0, 1)) = 0 AS BIGINT) FROM labels""")
def check_report(spark, folder):
    """The report is written and read back."""
    checks = [
        qc.unique_key("orders", table(spark, folder, "orders"), "o_orderkey"), qc.unique_key("lineitem", table(spark, folder, "lineitem"), "l_orderkey"),
        qc.binary_target("labels", table(spark, folder, "labels"), "quality"),
    ]
    path = write_table(qc.report(spark, checks), scratch_path(spark, "checks"), "json")
    return spark.read.schema(qc.CHECK_SCHEMA).json(path).select("section", "name", F.col("passed").cast("long").alias("passed"))


@query("q11_reuse_check", """SELECT * FROM (VALUES ('same', 0), ('other_data', 1), ('other_settings', 1)) v(kind, refused), (SELECT count(*) AS "rows", count(*) FILTER (WHERE o_totalprice > 150000) AS positives FROM orders)""")
def reuse_check(spark, folder):
    """A stored run is taken up again only with the same data and the same settings."""
    df = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", (F.col("o_totalprice") > 150000).cast("int").alias("y"))
    stored = run_metadata(df, ["o_totalprice"], "y", family="gbt")
    others = {
        "same": run_metadata(df.orderBy(F.desc("o_totalprice")), ["o_totalprice"], "y", family="gbt"),
        "other_data": run_metadata(df.withColumn("o_totalprice", F.col("o_totalprice") + (F.col("o_orderkey") == 1).cast("int")), ["o_totalprice"], "y", family="gbt"),
        "other_settings": run_metadata(df, ["o_totalprice"], "y", family="logistic"),
    }

    def refused(current) -> int:
        try:
            check_reuse(stored, current)
        except ValueError:
            return 1
        return 0

    rows = [(kind, refused(found), found["row_count"], found["positive_count"]) for kind, found in others.items()]
    return spark.createDataFrame(rows, "kind string, refused long, rows long, positives long")
