"""The driver's tables seen as the credit tables, in Spark and in SQL.

Nulls, zero denominators, negative delays and placeholder values are placed by
rule, so that every special case of the feature definitions occurs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.catalog.registry import table
from riskloom.session import DENSE, partitions_for, settle

ORDER_ANCHOR = "2001-08-01"
SHIP_ANCHOR = "2001-11-04"
EVENT_ANCHOR = "2024-01-31"
#: Lines of one task where they are joined to their orders.
LINES = 1_000_000


def _unless(every: int, on: str, value):
    return F.when(F.col(on) % every != 0, value)


def application(spark: SparkSession, folder: str) -> DataFrame:
    k, key = F.col("c_custkey"), "c_custkey"
    d = lambda c: c.cast("double")
    nation = F.col("c_nationkey")
    return table(spark, folder, "customer").select(
        k.alias("SK_ID_CURR"),
        (F.col("c_acctbal") < 0).cast("int").alias("TARGET"),
        (F.col("c_acctbal") + 20000).alias("AMT_INCOME_TOTAL"),
        d(5000 + 37 * (k % 1009)).alias("AMT_CREDIT"),
        _unless(11, key, d(500 + k % 251)).alias("AMT_ANNUITY"),
        _unless(13, key, d(4500 + 35 * (k % 1013))).alias("AMT_GOODS_PRICE"),
        d(-(7000 + (k * 7) % 15000)).alias("DAYS_BIRTH"),
        F.when(k % 5 == 0, F.lit(365243.0)).otherwise(d(-((k * 3) % 9000))).alias("DAYS_EMPLOYED"),
        d(-((k * 11) % 12000)).alias("DAYS_REGISTRATION"),
        d(-((k * 13) % 6000)).alias("DAYS_ID_PUBLISH"),
        _unless(17, key, d(-((k * 17) % 4000))).alias("DAYS_LAST_PHONE_CHANGE"),
        d(nation % 5).alias("CNT_FAM_MEMBERS"),
        _unless(3, key, d((k * 31) % 1000) / 1000).alias("EXT_SOURCE_1"),
        (d((k * 57) % 1000) / 1000).alias("EXT_SOURCE_2"),
        _unless(4, key, d((k * 91) % 1000) / 1000).alias("EXT_SOURCE_3"),
        (k % 2).cast("int").alias("FLAG_DOCUMENT_2"),
        (k % 3 == 0).cast("int").alias("FLAG_DOCUMENT_3"),
        *[
            (d(k % m) if m != 7 else _unless(7, key, d(k % 7))).alias(f"AMT_REQ_CREDIT_BUREAU_{name}")
            for name, m in (("HOUR", 2), ("DAY", 3), ("WEEK", 4), ("MON", 5), ("QRT", 6), ("YEAR", 7))
        ],
        F.col("c_mktsegment").alias("ORGANIZATION_TYPE"),
        _unless(7, key, F.concat(F.lit("N"), nation.cast("string"))).alias("OCCUPATION_TYPE"),
        F.when(nation < 20, F.lit("Cash loans")).otherwise(F.lit("Revolving loans")).alias("NAME_CONTRACT_TYPE"),
        _unless(19, key, F.col("c_mktsegment")).alias("NAME_SEGMENT"),
    )


APPLICATION_SQL = """application AS (
 SELECT c_custkey AS SK_ID_CURR, CAST(c_acctbal < 0 AS INT) AS TARGET, c_acctbal + 20000 AS AMT_INCOME_TOTAL,
  CAST(5000 + 37 * (c_custkey % 1009) AS DOUBLE) AS AMT_CREDIT,
  CASE WHEN c_custkey % 11 <> 0 THEN CAST(500 + c_custkey % 251 AS DOUBLE) END AS AMT_ANNUITY,
  CASE WHEN c_custkey % 13 <> 0 THEN CAST(4500 + 35 * (c_custkey % 1013) AS DOUBLE) END AS AMT_GOODS_PRICE,
  CAST(-(7000 + (c_custkey * 7) % 15000) AS DOUBLE) AS DAYS_BIRTH,
  CASE WHEN c_custkey % 5 = 0 THEN CAST(365243 AS DOUBLE) ELSE CAST(-((c_custkey * 3) % 9000) AS DOUBLE) END AS DAYS_EMPLOYED,
  CAST(-((c_custkey * 11) % 12000) AS DOUBLE) AS DAYS_REGISTRATION,
  CAST(-((c_custkey * 13) % 6000) AS DOUBLE) AS DAYS_ID_PUBLISH,
  CASE WHEN c_custkey % 17 <> 0 THEN CAST(-((c_custkey * 17) % 4000) AS DOUBLE) END AS DAYS_LAST_PHONE_CHANGE,
  CAST(c_nationkey % 5 AS DOUBLE) AS CNT_FAM_MEMBERS,
  CASE WHEN c_custkey % 3 <> 0 THEN CAST((c_custkey * 31) % 1000 AS DOUBLE) / 1000 END AS EXT_SOURCE_1,
  CAST((c_custkey * 57) % 1000 AS DOUBLE) / 1000 AS EXT_SOURCE_2,
  CASE WHEN c_custkey % 4 <> 0 THEN CAST((c_custkey * 91) % 1000 AS DOUBLE) / 1000 END AS EXT_SOURCE_3,
  CAST(c_custkey % 2 AS INT) AS FLAG_DOCUMENT_2, CAST(c_custkey % 3 = 0 AS INT) AS FLAG_DOCUMENT_3,
  CAST(c_custkey % 2 AS DOUBLE) AS AMT_REQ_CREDIT_BUREAU_HOUR, CAST(c_custkey % 3 AS DOUBLE) AS AMT_REQ_CREDIT_BUREAU_DAY,
  CAST(c_custkey % 4 AS DOUBLE) AS AMT_REQ_CREDIT_BUREAU_WEEK, CAST(c_custkey % 5 AS DOUBLE) AS AMT_REQ_CREDIT_BUREAU_MON,
  CAST(c_custkey % 6 AS DOUBLE) AS AMT_REQ_CREDIT_BUREAU_QRT,
  CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey % 7 AS DOUBLE) END AS AMT_REQ_CREDIT_BUREAU_YEAR,
  c_mktsegment AS ORGANIZATION_TYPE,
  CASE WHEN c_custkey % 7 <> 0 THEN 'N' || CAST(c_nationkey AS VARCHAR) END AS OCCUPATION_TYPE,
  CASE WHEN c_nationkey < 20 THEN 'Cash loans' ELSE 'Revolving loans' END AS NAME_CONTRACT_TYPE,
  CASE WHEN c_custkey % 19 <> 0 THEN c_mktsegment END AS NAME_SEGMENT
 FROM customer)"""


def train_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("SK_ID_CURR") % 5 != 0)


def test_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("SK_ID_CURR") % 5 == 0).drop("TARGET")


SPLIT_SQL = """train AS (SELECT * FROM application WHERE SK_ID_CURR % 5 <> 0),
test AS (SELECT * FROM application WHERE SK_ID_CURR % 5 = 0)"""


def _days(column: str, anchor: str):
    return F.datediff(F.col(column), F.lit(anchor).cast("date")).cast("double")


def bureau(spark: SparkSession, folder: str) -> DataFrame:
    k, price, days = F.col("o_orderkey"), F.col("o_totalprice"), _days("o_orderdate", ORDER_ANCHOR)
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("SK_ID_CURR"), k.alias("SK_ID_BUREAU"),
        _unless(23, "o_orderkey", days).alias("DAYS_CREDIT"),
        _unless(7, "o_orderkey", price).alias("AMT_CREDIT_SUM"),
        (price * (k % 10).cast("double") / 10).alias("AMT_CREDIT_SUM_DEBT"),
        F.when(F.col("o_orderstatus") == "F", "Closed").when(F.col("o_orderstatus") == "O", "Active").otherwise("Sold").alias("CREDIT_ACTIVE"),
        (price / 8).alias("AMT_CREDIT_SUM_LIMIT"), (k % 3).cast("double").alias("AMT_CREDIT_SUM_OVERDUE"),
        (days + 365).alias("DAYS_CREDIT_ENDDATE"), _unless(4, "o_orderkey", days + 200).alias("DAYS_ENDDATE_FACT"),
    )


BUREAU_SQL = f"""bureau AS (
 SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_BUREAU,
  CASE WHEN o_orderkey % 23 <> 0 THEN CAST(datediff('day', DATE '{ORDER_ANCHOR}', CAST(o_orderdate AS DATE)) AS DOUBLE) END AS DAYS_CREDIT,
  CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS AMT_CREDIT_SUM,
  o_totalprice * CAST(o_orderkey % 10 AS DOUBLE) / 10 AS AMT_CREDIT_SUM_DEBT,
  CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Active' ELSE 'Sold' END AS CREDIT_ACTIVE,
  o_totalprice / 8 AS AMT_CREDIT_SUM_LIMIT, CAST(o_orderkey % 3 AS DOUBLE) AS AMT_CREDIT_SUM_OVERDUE,
  CAST(datediff('day', DATE '{ORDER_ANCHOR}', CAST(o_orderdate AS DATE)) + 365 AS DOUBLE) AS DAYS_CREDIT_ENDDATE,
  CASE WHEN o_orderkey % 4 <> 0 THEN CAST(datediff('day', DATE '{ORDER_ANCHOR}', CAST(o_orderdate AS DATE)) + 200 AS DOUBLE) END AS DAYS_ENDDATE_FACT
 FROM orders)"""


def _months(column: str, anchor: str):
    return -F.floor(-_days(column, anchor) / 30).cast("double")


def bureau_balance(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("SK_ID_BUREAU"),
        _unless(31, "l_partkey", _months("l_shipdate", SHIP_ANCHOR)).alias("MONTHS_BALANCE"),
        _unless(29, "l_partkey", F.col("l_returnflag")).alias("STATUS"),
    )


_MONTHS = f"-floor(datediff('day', CAST(l_shipdate AS DATE), DATE '{SHIP_ANCHOR}') / 30.0)"
BUREAU_BALANCE_SQL = f"""bureau_balance AS (
 SELECT l_orderkey AS SK_ID_BUREAU, CASE WHEN l_partkey % 31 <> 0 THEN CAST({_MONTHS} AS DOUBLE) END AS MONTHS_BALANCE,
  CASE WHEN l_partkey % 29 <> 0 THEN l_returnflag END AS STATUS FROM lineitem)"""


def previous_application(spark: SparkSession, folder: str) -> DataFrame:
    k, price = F.col("o_orderkey"), F.col("o_totalprice")
    status = F.col("o_orderstatus")
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("SK_ID_CURR"), k.alias("SK_ID_PREV"), price.alias("AMT_APPLICATION"),
        _unless(8, "o_orderkey", price * (8 + (k % 5)).cast("double") / 10).alias("AMT_CREDIT"),
        _unless(9, "o_orderkey", price / 24).alias("AMT_ANNUITY"), (12 + (k % 4) * 6).cast("double").alias("CNT_PAYMENT"),
        _unless(23, "o_orderkey", _days("o_orderdate", ORDER_ANCHOR)).alias("DAYS_DECISION"),
        F.when(F.col("o_orderpriority") == "5-LOW", "Unused offer").when(status == "F", "Approved")
        .when(status == "O", "Refused").otherwise("Canceled").alias("NAME_CONTRACT_STATUS"),
    )


PREVIOUS_SQL = f"""previous_application AS (
 SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_PREV, o_totalprice AS AMT_APPLICATION,
  CASE WHEN o_orderkey % 8 <> 0 THEN o_totalprice * CAST(8 + o_orderkey % 5 AS DOUBLE) / 10 END AS AMT_CREDIT,
  CASE WHEN o_orderkey % 9 <> 0 THEN o_totalprice / 24 END AS AMT_ANNUITY, CAST(12 + (o_orderkey % 4) * 6 AS DOUBLE) AS CNT_PAYMENT,
  CASE WHEN o_orderkey % 23 <> 0 THEN CAST(datediff('day', DATE '{ORDER_ANCHOR}', CAST(o_orderdate AS DATE)) AS DOUBLE) END AS DAYS_DECISION,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'Unused offer' WHEN o_orderstatus = 'F' THEN 'Approved' WHEN o_orderstatus = 'O' THEN 'Refused'
   ELSE 'Canceled' END AS NAME_CONTRACT_STATUS
 FROM orders)"""


def pos_cash(spark: SparkSession, folder: str) -> DataFrame:
    e = F.col("event_id")
    return table(spark, folder, "events").select(
        F.col("user_id").alias("SK_ID_CURR"), _unless(6, "event_id", e % 40).alias("SK_ID_PREV"),
        _unless(27, "event_id", _days("ts", EVENT_ANCHOR)).alias("MONTHS_BALANCE"),
        (F.floor("value") % 7 - 1).cast("double").alias("SK_DPD"),
        (e % 24 - 2).cast("double").alias("CNT_INSTALMENT"), _unless(5, "event_id", (e % 12).cast("double")).alias("CNT_INSTALMENT_FUTURE"),
    )


POS_SQL = f"""pos_cash AS (
 SELECT user_id AS SK_ID_CURR, CASE WHEN event_id % 6 <> 0 THEN event_id % 40 END AS SK_ID_PREV,
  CASE WHEN event_id % 27 <> 0 THEN CAST(datediff('day', DATE '{EVENT_ANCHOR}', CAST(ts AS DATE)) AS DOUBLE) END AS MONTHS_BALANCE,
  CAST(floor(value) % 7 - 1 AS DOUBLE) AS SK_DPD, CAST(event_id % 24 - 2 AS DOUBLE) AS CNT_INSTALMENT,
  CASE WHEN event_id % 5 <> 0 THEN CAST(event_id % 12 AS DOUBLE) END AS CNT_INSTALMENT_FUTURE
 FROM events)"""


def _order_lines(spark: SparkSession, folder: str) -> DataFrame:
    owners = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return table(spark, folder, "lineitem").join(owners, "l_orderkey")


_LINE_COLUMNS = ("o_custkey", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate")


def installments(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    due = _days("l_shipdate", SHIP_ANCHOR)
    price = F.col("l_extendedprice")
    return (lines or _order_lines(spark, folder)).select(
        F.col("o_custkey").alias("SK_ID_CURR"), F.col("l_orderkey").alias("SK_ID_PREV"),
        _unless(33, "l_partkey", F.col("l_linenumber")).alias("NUM_INSTALMENT_VERSION"),
        price.alias("AMT_INSTALMENT"), _unless(37, "l_partkey", price * (1 - F.col("l_discount"))).alias("AMT_PAYMENT"),
        _unless(41, "l_partkey", due).alias("DAYS_INSTALMENT"),
        _unless(20, "l_suppkey", due + F.col("l_quantity") - 25).alias("DAYS_ENTRY_PAYMENT"),
    )


_DUE = f"CAST(datediff('day', DATE '{SHIP_ANCHOR}', CAST(l_shipdate AS DATE)) AS DOUBLE)"
INSTALLMENTS_SQL = f"""installments AS (
 SELECT o_custkey AS SK_ID_CURR, l_orderkey AS SK_ID_PREV, CASE WHEN l_partkey % 33 <> 0 THEN l_linenumber END AS NUM_INSTALMENT_VERSION,
  l_extendedprice AS AMT_INSTALMENT, CASE WHEN l_partkey % 37 <> 0 THEN l_extendedprice * (1 - l_discount) END AS AMT_PAYMENT,
  CASE WHEN l_partkey % 41 <> 0 THEN {_DUE} END AS DAYS_INSTALMENT,
  CASE WHEN l_suppkey % 20 <> 0 THEN {_DUE} + l_quantity - 25 END AS DAYS_ENTRY_PAYMENT
 FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"""


def card_balance(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    return (lines or _order_lines(spark, folder)).select(
        F.col("o_custkey").alias("SK_ID_CURR"), F.col("l_orderkey").alias("SK_ID_PREV"),
        _unless(41, "l_partkey", _months("l_shipdate", SHIP_ANCHOR)).alias("MONTHS_BALANCE"),
        (price * F.col("l_discount") * 10).alias("AMT_BALANCE"),
        ((F.col("l_partkey") % 5) * 20000).cast("double").alias("AMT_CREDIT_LIMIT_ACTUAL"),
        _unless(3, "l_suppkey", quantity * 100).alias("AMT_DRAWINGS_CURRENT"), (F.col("l_linenumber") - 1).cast("double").alias("SK_DPD"),
        price.alias("AMT_TOTAL_RECEIVABLE"), (price * 0.75).alias("AMT_RECEIVABLE_PRINCIPAL"),
        _unless(5, "l_suppkey", quantity).alias("CNT_DRAWINGS_CURRENT"),
    )


CARD_SQL = f"""card_balance AS (
 SELECT o_custkey AS SK_ID_CURR, l_orderkey AS SK_ID_PREV, CASE WHEN l_partkey % 41 <> 0 THEN CAST({_MONTHS} AS DOUBLE) END AS MONTHS_BALANCE,
  l_extendedprice * l_discount * 10 AS AMT_BALANCE, CAST((l_partkey % 5) * 20000 AS DOUBLE) AS AMT_CREDIT_LIMIT_ACTUAL,
  CASE WHEN l_suppkey % 3 <> 0 THEN l_quantity * 100 END AS AMT_DRAWINGS_CURRENT, CAST(l_linenumber - 1 AS DOUBLE) AS SK_DPD,
  l_extendedprice AS AMT_TOTAL_RECEIVABLE, l_extendedprice * CAST(0.75 AS DOUBLE) AS AMT_RECEIVABLE_PRINCIPAL,
  CASE WHEN l_suppkey % 5 <> 0 THEN l_quantity END AS CNT_DRAWINGS_CURRENT
 FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"""


def credit_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    base = application(spark, folder)
    with partitions_for(spark, table(spark, folder, "lineitem").count(), LINES):
        lines = settle(_order_lines(spark, folder).select(*_LINE_COLUMNS), "order-lines", DENSE)  # two histories are made of this join
    return {
        "application_train": train_rows(base), "application_test": test_rows(base),
        "bureau": bureau(spark, folder), "bureau_balance": bureau_balance(spark, folder),
        "previous_application": previous_application(spark, folder), "pos_cash_balance": pos_cash(spark, folder),
        "installments_payments": installments(spark, folder, lines), "credit_card_balance": card_balance(spark, folder, lines),
    }


def scored_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents with a score in [0, 1)."""
    score = 1 - 1 / (1 + F.col("n_chars") / 1000)
    return table(spark, folder, "labels").join(table(spark, folder, "documents").select("doc_id", "n_chars"), "doc_id").select(
        "doc_id", F.col("quality").alias("y"), score.alias("p")
    )


SCORED_SQL = """scored AS (
 SELECT doc_id, quality AS y, 1 - 1 / (1 + n_chars / CAST(1000 AS DOUBLE)) AS p FROM labels JOIN documents USING (doc_id))"""
