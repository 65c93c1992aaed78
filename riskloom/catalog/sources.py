"""Source and sink queries: S01-S09, S11-S13."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog import mapping as m
from riskloom.catalog.registry import query, r, rounded, rounded_table, table
from riskloom.functions.columns import as_column, at_or_above
from riskloom.operators import metrics as mx
from riskloom.operators.scoring import LinearWeights, Scorer
from riskloom.plans.build import feature_manifest
from riskloom.session import scratch_path
from riskloom.sources import sinks, tables

KEY = "SK_ID_CURR"


def _as_csv(df, spark, label, null="NA"):
    """The table as a CSV file whose nulls are written as a marker."""
    path = scratch_path(spark, label)
    df.write.option("header", True).option("nullValue", null).csv(path)
    return path


_APP_COLUMNS = ("SK_ID_CURR", "TARGET", "AMT_INCOME_TOTAL", "AMT_ANNUITY", "DAYS_EMPLOYED", "CNT_FAM_MEMBERS", "EXT_SOURCE_1", "OCCUPATION_TYPE", "NAME_CONTRACT_TYPE", "FLAG_DOCUMENT_2")
_APP_TYPES = {"SK_ID_CURR": "BIGINT", "TARGET": "BIGINT", "FLAG_DOCUMENT_2": "BIGINT"}


@query("s01_csv_table", f"WITH {m.APPLICATION_SQL} SELECT " + ", ".join(
    r(c) + f" AS {c}" if c[:3] in ("AMT", "DAY", "CNT", "EXT") else f"CAST({c} AS {_APP_TYPES.get(c, 'VARCHAR')}) AS \"{c}\"" for c in _APP_COLUMNS) + " FROM application")
def csv_table(spark, folder):
    """Written as text and read back typed: listed types win, the others are guessed."""
    df = m.application(spark, folder).select(*_APP_COLUMNS)
    return rounded_table(tables.read_csv(spark, _as_csv(df, spark, "application")))


@query("s02_csv_scan", f"""WITH {m.BUREAU_BALANCE_SQL} SELECT STATUS, count(*) AS "rows", {r('avg(MONTHS_BALANCE)')} AS months FROM bureau_balance WHERE MONTHS_BALANCE >= -24 GROUP BY 1""")
def csv_scan(spark, folder):
    df = tables.read_csv(spark, _as_csv(m.bureau_balance(spark, folder), spark, "balance"))
    return rounded_table(df.where("MONTHS_BALANCE >= -24").groupBy("STATUS").agg(F.count(F.lit(1)).alias("rows"), F.avg("MONTHS_BALANCE").alias("months")))


@query("s03_null_markers", """SELECT CAST(o_orderkey % 6 AS BIGINT) AS kind, count(*) AS "rows", CAST(count(CASE WHEN o_orderkey % 6 = 5 THEN o_totalprice END) AS BIGINT) AS numbers,
 CAST(count(CASE WHEN o_orderkey % 6 = 5 THEN o_orderstatus END) AS BIGINT) AS texts FROM orders GROUP BY 1""")
def null_markers(spark, folder):
    """Every marker means null, in number and text columns alike."""
    k = F.col("o_orderkey") % 6

    def marked(c):
        out = F.when(k == 0, F.lit("")).when(k == 1, F.lit("NA")).when(k == 2, F.lit("NaN")).when(k == 3, F.lit("nan")).when(k == 4, F.lit("NULL"))
        return out.otherwise(F.col(c).cast("string"))

    path = scratch_path(spark, "markers")
    table(spark, folder, "orders").select(k.alias("kind"), marked("o_totalprice").alias("AMT_CREDIT"), marked("o_orderstatus").alias("status")).write.option("header", True).csv(path)
    read = tables.read_csv(spark, path)
    return read.groupBy("kind").agg(F.count(F.lit(1)).alias("rows"), F.count("AMT_CREDIT").alias("numbers"), F.count("status").alias("texts"))


_NAMED = {"l_orderkey": "Int64", "l_linenumber": "Int8", "l_partkey": "UInt32", "l_suppkey": "Int32", "l_quantity": "Float64", "l_discount": "Float32", "l_returnflag": "String"}


@query("s04_named_types", f"""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, CAST(l_suppkey AS BIGINT) AS l_suppkey, {r('l_quantity')} AS l_quantity,
 {r('CAST(l_discount AS FLOAT)')} AS l_discount, l_returnflag FROM lineitem""")
def named_types(spark, folder):
    df = table(spark, folder, "lineitem").select([as_column(c).cast("string").cast(tables.named_type(t)).alias(c) for c, t in _NAMED.items()])
    return rounded_table(df)


@query("s05_processed_table", "SELECT c_mktsegment, count(*) AS \"rows\" FROM customer WHERE c_acctbal > 0 GROUP BY 1")
def processed(spark, folder):
    path = sinks.write_table(table(spark, folder, "customer"), scratch_path(spark, "processed"))
    return tables.read_table(spark, path).where("c_acctbal > 0").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("rows"))


@query("s05_input_example", "SELECT least(count(*), 20) AS \"rows\", count(*) AS total FROM customer")
def input_example(spark, folder):
    path = f"{folder}/customer.parquet"
    head = tables.read_table(spark, path, sample=20).agg(F.count(F.lit(1)).alias("rows"))
    return head.select("rows", F.lit(table(spark, folder, "customer").count()).alias("total"))


@query("s06_inline_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def inline_json(spark, folder):
    """One JSON object per request becomes one row."""
    rows, _ = tables.split_payloads(table(spark, folder, "events").select("event_id", "props"), "props", "struct<k:bigint>")
    return rows.drop("row_index")


@query("s07_payload_rows", """SELECT event_id, CAST(0 AS BIGINT) AS row_index, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(0 AS BIGINT) AS rejected FROM events WHERE event_id % 5 IN (0, 1)
 UNION ALL SELECT event_id, 1, CAST(json_extract(props, '$.k') AS BIGINT), 0 FROM events WHERE event_id % 5 = 1
 UNION ALL SELECT event_id, NULL, NULL, 1 FROM events WHERE event_id % 5 IN (2, 3, 4)""")
def payload_rows(spark, folder):
    """Objects and non-empty arrays of objects pass; empty arrays, numbers and mixed arrays are rejected."""
    e, p = F.col("event_id") % 5, F.col("props")
    payload = F.when(e == 0, p).when(e == 1, F.concat(F.lit("["), p, F.lit(","), p, F.lit("]"))).when(e == 2, F.lit("[]")).when(e == 3, F.lit("123")).otherwise(F.concat(F.lit("[1,"), p, F.lit("]")))
    rows, bad = tables.split_payloads(table(spark, folder, "events").select("event_id", payload.alias("body")), "body", "struct<k:bigint>")
    kept = rows.select("event_id", F.col("row_index").cast("long").alias("row_index"), "k", F.lit(0).cast("long").alias("rejected"))
    none = F.lit(None).cast("long")
    return kept.unionByName(bad.select("event_id", none.alias("row_index"), none.alias("k"), F.lit(1).cast("long").alias("rejected")))


@query("s08_final_table_sink", f"""SELECT 'parquet' AS kind, count(*) AS "rows", {r('sum(o_totalprice)', 2)} AS total FROM orders UNION ALL SELECT 'csv', count(*), {r('sum(o_totalprice)', 2)} FROM orders""")
def final_sink(spark, folder):
    df = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    a = sinks.write_table(df, scratch_path(spark, "final"))
    b = sinks.write_table(df, scratch_path(spark, "final"), "csv")
    read = spark.read.parquet(a).withColumn("kind", F.lit("parquet")).unionByName(
        spark.read.schema(df.schema).option("header", True).csv(b).withColumn("kind", F.lit("csv")))
    return read.groupBy("kind").agg(F.count(F.lit(1)).alias("rows"), rounded(F.sum("o_totalprice"), 2).alias("total"))


@query("s09_feature_manifest", f"""WITH {m.APPLICATION_SQL}, {m.SPLIT_SQL} SELECT (SELECT count(*) FROM train) AS train_rows, (SELECT count(*) FROM test) AS test_rows,
 (SELECT count(*) FROM (DESCRIBE train)) AS train_columns, (SELECT count(*) - 1 FROM (DESCRIBE train)) AS test_columns, (SELECT count(*) - 2 FROM (DESCRIBE train)) AS features""")
def manifest(spark, folder):
    df = m.application(spark, folder)
    made = feature_manifest(m.train_rows(df), m.test_rows(df), KEY, "TARGET", ["missing_indicators"], ["application_train"], {"dropped_correlated": []})
    read = sinks.read_document(spark, sinks.write_document(spark, made, scratch_path(spark, "manifest")))
    row = (*[read[f"final_{n}_shape"][0] for n in ("train", "test")], *[len(read[f"{n}_columns"]) for n in ("train", "test")], read["final_feature_count"])
    return spark.createDataFrame([row], "train_rows long, test_rows long, train_columns long, test_columns long, features long")


WEIGHTS = LinearWeights({"EXT_SOURCE_2": -2.0, "AMT_CREDIT": 0.00005, "CNT_FAM_MEMBERS": 0.1}, -0.5)
PROBABILITY_SQL = "1 / (1 + exp(-(CAST(-0.5 AS DOUBLE) + CAST(-2.0 AS DOUBLE) * EXT_SOURCE_2 + CAST(0.00005 AS DOUBLE) * AMT_CREDIT + CAST(0.1 AS DOUBLE) * CNT_FAM_MEMBERS)))"


@query("s11_submission", f"WITH {m.APPLICATION_SQL}, {m.SPLIT_SQL} SELECT SK_ID_CURR, {r(PROBABILITY_SQL, 6)} AS \"TARGET\" FROM test")
def submission(spark, folder):
    test = m.test_rows(m.application(spark, folder))
    path = sinks.write_submission(Scorer(WEIGHTS).predict(test, "__p"), test, scratch_path(spark, "submission"), KEY, "TARGET", "__p")
    return spark.read.parquet(path).select(KEY, rounded("TARGET", 6).alias("TARGET"))


@query("s12_scored_output", f"WITH {m.APPLICATION_SQL} SELECT SK_ID_CURR, {r(PROBABILITY_SQL, 6)} AS \"TARGET_PROBABILITY\", CAST({PROBABILITY_SQL} >= 0.3 AS BIGINT) AS \"TARGET_PREDICTION\" FROM application")
def scored_output(spark, folder):
    scored = Scorer(WEIGHTS).predict(m.application(spark, folder))
    labelled = scored.withColumn("TARGET_PREDICTION", at_or_above("TARGET_PROBABILITY", F.lit(0.3)))
    path = sinks.write_table(labelled, scratch_path(spark, "scored"))
    return rounded_table(spark.read.parquet(path), 6)


@query("s13_report_tables", f"""WITH {m.SCORED_SQL} SELECT 'threshold_table' AS report, CAST(99 AS BIGINT) AS "rows" FROM scored HAVING count(*) > 0 UNION ALL SELECT 'lift', least(count(*), 10) FROM scored
 UNION ALL SELECT 'confusion', count(*) FROM (SELECT DISTINCT y, p > 0.5 FROM scored) UNION ALL SELECT 'classes', 5 UNION ALL SELECT 'roc', count(DISTINCT p) FROM scored""")
def report_tables(spark, folder):
    scored = m.scored_documents(spark, folder)
    reports = {
        "threshold_table": mx.threshold_table(scored, "y", "p"), "lift": mx.lift_table(scored, "y", "p"), "confusion": mx.confusion_counts(scored, "y", "p", 0.5),
        "classes": mx.classification_report(scored, "y", "p", 0.5), "roc": mx.roc_points(scored, "y", "p"),
    }
    paths = sinks.write_reports(reports, scratch_path(spark, "reports"))
    return spark.createDataFrame([(n, spark.read.parquet(p).count()) for n, p in paths.items()], "report string, rows long")


@query("s06_scoring_input", """SELECT CAST(c_custkey AS BIGINT) AS id, CAST(c_acctbal AS DOUBLE) AS amount, c_mktsegment AS name, 'file' AS origin FROM customer
 UNION ALL SELECT CAST(r_regionkey AS BIGINT), CAST(r_regionkey AS DOUBLE) / 4, r_name, 'json' FROM region""")
def scoring_input(spark, folder):
    """Rows to score from a file or from inline JSON (a small table here); both at once are an error."""
    people = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("amount"), F.col("c_mktsegment").alias("name"))
    path = _as_csv(people, spark, "to-score")
    regions = table(spark, folder, "region").select(F.col("r_regionkey").alias("id"), (F.col("r_regionkey") / 4).alias("amount"), F.col("r_name").alias("name"))
    text = "[" + ",".join(regions.toJSON().collect()) + "]"  # five rows, as a client would send them
    try:
        tables.scoring_input(spark, path, text)
    except ValueError:
        pass
    else:
        raise AssertionError("a file and inline JSON together must be refused")
    both = tables.scoring_input(spark, path).withColumn("origin", F.lit("file")).unionByName(tables.scoring_input(spark, json_text=text).withColumn("origin", F.lit("json")))
    return both.select("id", F.col("amount").cast("double").alias("amount"), "name", "origin")
