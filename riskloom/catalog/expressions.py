"""Projection queries: P01-P16, P20, P22-P25, P30, F01-F07."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog import mapping as m
from riskloom.catalog.registry import query, r, rounded, rounded_table, table
from riskloom.functions import columns as fx
from riskloom.functions.names import add_prefix, tidy_columns
from riskloom.plans import application as ap
from riskloom.plans import fixed_values as fv
from riskloom.plans import histories as h

APP = f"WITH {m.APPLICATION_SQL} "
KEY = "SK_ID_CURR"
EPS = "CAST(1e-9 AS DOUBLE)"


def ratio_sql(name: str, top: str, bottom: str) -> str:
    return f'{r(f"{top} / ({bottom} + {EPS})", 2)} AS "{name}"'


@query("p01_safe_ratio", APP + f"SELECT {KEY}, {ratio_sql('INCOME_PER_PERSON', 'AMT_INCOME_TOTAL', 'CNT_FAM_MEMBERS')} FROM application")
def safe_ratio(spark, folder):
    df = m.application(spark, folder)
    return df.select(KEY, rounded(fx.ratio("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"), 2).alias("INCOME_PER_PERSON"))


@query("p02_placeholder_to_null", APP + f"SELECT {KEY}, CASE WHEN DAYS_EMPLOYED <> 365243 THEN DAYS_EMPLOYED END AS DAYS_EMPLOYED FROM application")
def placeholder(spark, folder):
    return m.application(spark, folder).select(KEY, fx.blank_value("DAYS_EMPLOYED", fv.UNKNOWN_EMPLOYMENT).alias("DAYS_EMPLOYED"))


@query("p03_age_years", APP + f"SELECT {KEY}, {r('abs(DAYS_BIRTH) / 365.25')} AS AGE_YEARS FROM application")
def age(spark, folder):
    return m.application(spark, folder).select(KEY, rounded(fx.age_years("DAYS_BIRTH")).alias("AGE_YEARS"))


@query("p04_difference_pair", APP + f"""SELECT {KEY}, {r('AMT_GOODS_PRICE - AMT_CREDIT')} AS DOWN_PAYMENT,
 {r(f'(AMT_GOODS_PRICE - AMT_CREDIT) / (AMT_CREDIT + {EPS})')} AS DOWN_PAYMENT_RATIO FROM application""")
def difference(spark, folder):
    gap, relative = fx.gap_pair("AMT_GOODS_PRICE", "AMT_CREDIT")
    return m.application(spark, folder).select(KEY, rounded(gap).alias("DOWN_PAYMENT"), rounded(relative).alias("DOWN_PAYMENT_RATIO"))


_FAMILIES = (*fv.BASE_RATIOS, *fv.GLOBAL_RATIOS, *fv.EXTENDED_RATIOS)


@query("p05_ratio_families", APP + f"SELECT {KEY}, {', '.join(ratio_sql(*f) for f in _FAMILIES)} FROM application")
def ratio_families(spark, folder):
    df = m.application(spark, folder)
    return df.select(KEY, *[rounded(e, 2).alias(n) for n, e in ap.ratio_columns(df, _FAMILIES).items()])


@query("p06_missing_flags", APP + f"""SELECT {KEY}, {', '.join(f'CAST({c} IS NULL AS BIGINT) AS "{c}_is_missing"' for c in fv.FLAGGED_WHEN_MISSING)}
 FROM application""")
def missing_flags(spark, folder):
    df = m.application(spark, folder)
    return df.select(KEY, *[fx.null_flag(c, "long").alias(f"{c}_is_missing") for c in fv.FLAGGED_WHEN_MISSING])


@query("p07_sum_by_prefix", APP + f"SELECT {KEY}, CAST(FLAG_DOCUMENT_2 + FLAG_DOCUMENT_3 AS BIGINT) AS DOCUMENT_COUNT FROM application")
def sum_by_prefix(spark, folder):
    df = m.application(spark, folder)
    return df.select(KEY, fx.row_sum([c for c in df.columns if c.startswith(fv.DOCUMENT_PREFIX)]).cast("long").alias("DOCUMENT_COUNT"))


@query("p08_sum_named", APP + f"""SELECT {KEY}, {r(' + '.join(f'coalesce({c}, 0)' for c in fv.ENQUIRY_COUNTS))} AS AMT_REQ_CREDIT_BUREAU_TOTAL FROM application""")
def sum_named(spark, folder):
    return m.application(spark, folder).select(KEY, rounded(fx.row_sum(fv.ENQUIRY_COUNTS)).alias("AMT_REQ_CREDIT_BUREAU_TOTAL"))


_E = fv.EXTERNAL_SCORES
_N = "(" + " + ".join(f"CAST({c} IS NOT NULL AS INT)" for c in _E) + ")"
_MEAN = "((" + " + ".join(f"coalesce({c}, 0)" for c in _E) + f") / {_N})"


@query("p09_row_statistics", APP + f"""SELECT {KEY}, {r(_MEAN)} AS EXT_SOURCES_MEAN, least({', '.join(_E)}) AS EXT_SOURCES_MIN,
 greatest({', '.join(_E)}) AS EXT_SOURCES_MAX, {r(f"greatest({', '.join(_E)}) - least({', '.join(_E)})")} AS EXT_SOURCES_RANGE FROM application""")
def row_statistics(spark, folder):
    return m.application(spark, folder).select(
        KEY, rounded(fx.row_mean(_E)).alias("EXT_SOURCES_MEAN"), fx.row_min(_E).alias("EXT_SOURCES_MIN"),
        fx.row_max(_E).alias("EXT_SOURCES_MAX"), rounded(fx.row_range(_E)).alias("EXT_SOURCES_RANGE"),
    )


@query("p10_row_product", APP + f"SELECT {KEY}, {r(' * '.join(_E))} AS EXT_SOURCES_PROD FROM application")
def row_product(spark, folder):
    return m.application(spark, folder).select(KEY, rounded(fx.row_product(_E)).alias("EXT_SOURCES_PROD"))


_SQUARES = " + ".join(f"coalesce(pow({c} - {_MEAN}, 2), 0)" for c in _E)


@query("p11_row_std", APP + f"SELECT {KEY}, {r(f'sqrt(({_SQUARES}) / {_N})')} AS EXT_SOURCES_STD FROM application")
def row_std(spark, folder):
    return m.application(spark, folder).select(KEY, rounded(fx.row_std(_E)).alias("EXT_SOURCES_STD"))


_CROSSED = [(f"{n}_TO_{s}", f"{a} / ({b} + {EPS})", s) for n, a, b in fv.GLOBAL_RATIOS if n in fv.CROSS_RATIO_BASES for s in fv.EXTERNAL_SCORES]


@query("p12_cross_ratios", APP + f"SELECT {KEY}, " + ", ".join(f"""coalesce({r(f'({a}) / ({s} + {EPS})', 2)}, 0) AS "{n}" """ for n, a, s in _CROSSED) + " FROM application")
def cross_ratios(spark, folder):
    """Ratios made before, over the external scores; off unless asked for. Nulls are filled with 0 at the end."""
    df = m.application(spark, folder)
    assert not [c for c in ap.add_row_statistics(df).columns if "_TO_EXT_SOURCE_" in c]
    df = ap.add_row_statistics(df, ap.BaseOptions(cross_ratios=True))
    return df.select(KEY, *[F.when(F.col(n) == 0, F.lit(0.0)).otherwise(rounded(n, 2)).alias(n) for n, _, _ in _CROSSED])


_USE = f"AMT_BALANCE / (AMT_CREDIT_LIMIT_ACTUAL + {EPS})"


@query("p13_clip", f"""WITH {m.CARD_SQL}, {m.INSTALLMENTS_SQL},
 a AS (SELECT SK_ID_CURR, count(*) AS card_rows, sum(CASE WHEN {_USE} > 1 THEN 1 WHEN {_USE} < 0 THEN 0 ELSE {_USE} END) AS used FROM card_balance GROUP BY 1),
 b AS (SELECT SK_ID_CURR, sum(CASE WHEN DAYS_ENTRY_PAYMENT < DAYS_INSTALMENT THEN 0 ELSE DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT END) AS late FROM installments GROUP BY 1)
 SELECT SK_ID_CURR, card_rows, {r('used')} AS used, {r('late')} AS late FROM a JOIN b USING (SK_ID_CURR)""")
def clip(spark, folder):
    card = h.card_columns(m.card_balance(spark, folder)).groupBy(KEY).agg(F.count(F.lit(1)).alias("card_rows"), F.sum("UTILIZATION").alias("used"))
    late = h.installment_columns(m.installments(spark, folder)).groupBy(KEY).agg(F.sum("DPD").alias("late"))
    return rounded_table(card.join(late, KEY))


_FLOORED = [f'sum(CASE WHEN {c} < 0 THEN 0 ELSE {c} END)' for c in h.POS_FLOORS]


@query("p14_floor_invalid", f"""WITH {m.POS_SQL} SELECT SK_ID_CURR, {', '.join(f'{r(e)} AS {c}' for c, e in zip(h.POS_FLOORS, _FLOORED))} FROM pos_cash GROUP BY 1""")
def floor_invalid(spark, folder):
    df = h.apply_floors(m.pos_cash(spark, folder), h.POS_FLOORS)
    return rounded_table(df.groupBy(KEY).agg(*[F.sum(c).alias(c) for c in h.POS_FLOORS]))


@query("p14_floor_audit", f"""WITH {m.POS_SQL} SELECT {', '.join(f'count(*) FILTER (WHERE {c} < 0) AS {c}' for c in h.POS_FLOORS)} FROM pos_cash""")
def floor_counts(spark, folder):
    return h.floor_audit(m.pos_cash(spark, folder), h.POS_FLOORS)


@query("p15_money_columns", f"""WITH {m.PREVIOUS_SQL} SELECT SK_ID_PREV, {r('AMT_APPLICATION - AMT_CREDIT')} AS APP_CREDIT_GAP,
 {r('AMT_ANNUITY * CNT_PAYMENT')} AS PREV_TOTAL_PAYMENT, {r('AMT_ANNUITY * CNT_PAYMENT - AMT_CREDIT')} AS PREV_SIMPLE_INTEREST,
 {r(f'AMT_CREDIT / (AMT_ANNUITY + {EPS})')} AS PREV_CREDIT_TO_ANNUITY FROM previous_application""")
def money(spark, folder):
    df = h.interest_columns(m.previous_application(spark, folder))
    return rounded_table(df.select("SK_ID_PREV", "APP_CREDIT_GAP", "PREV_TOTAL_PAYMENT", "PREV_SIMPLE_INTEREST", "PREV_CREDIT_TO_ANNUITY"))


@query("p16_instalment_columns", f"""WITH {m.INSTALLMENTS_SQL} SELECT SK_ID_CURR, {r(f'sum(AMT_PAYMENT / (AMT_INSTALMENT + {EPS}))')} AS PAYMENT_PERC,
 {r('sum(AMT_INSTALMENT - AMT_PAYMENT)')} AS PAYMENT_DIFF, {r('sum(CASE WHEN DAYS_ENTRY_PAYMENT < DAYS_INSTALMENT THEN 0 ELSE DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT END)')} AS DPD,
 {r('sum(CASE WHEN DAYS_ENTRY_PAYMENT > DAYS_INSTALMENT THEN 0 ELSE DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT END)')} AS DBD FROM installments GROUP BY 1""")
def instalments(spark, folder):
    df = h.installment_columns(m.installments(spark, folder))
    return rounded_table(df.groupBy(KEY).agg(*[F.sum(c).alias(c) for c in ("PAYMENT_PERC", "PAYMENT_DIFF", "DPD", "DBD")]))


@query("p20_prefix_rename", f"""WITH {m.BUREAU_SQL} SELECT SK_ID_CURR, {r('avg(AMT_CREDIT_SUM)')} AS "bureau_AMT_CREDIT_SUM", max(DAYS_CREDIT) AS "bureau_DAYS_CREDIT" FROM bureau GROUP BY 1""")
def prefix(spark, folder):
    df = m.bureau(spark, folder).groupBy(KEY).agg(F.avg("AMT_CREDIT_SUM").alias("AMT_CREDIT_SUM"), F.max("DAYS_CREDIT").alias("DAYS_CREDIT"))
    return add_prefix(df, "bureau_", [KEY]).withColumn("bureau_AMT_CREDIT_SUM", rounded("bureau_AMT_CREDIT_SUM"))


def _dirty(spark, folder):
    k = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        k, F.when(k % 5 == 0, F.lit(float("nan"))).when(k % 5 == 1, F.lit(float("inf"))).when(k % 5 == 2, F.lit(float("-inf")))
        .when(k % 5 == 3, F.col("c_acctbal")).alias("amount"),
        F.when(k % 3 != 0, F.col("c_nationkey")).alias("nation"),
    )


DIRTY_SQL = """dirty AS (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'NaN'::DOUBLE WHEN 1 THEN 'Infinity'::DOUBLE WHEN 2 THEN '-Infinity'::DOUBLE
 WHEN 3 THEN c_acctbal END AS amount, CASE WHEN c_custkey % 3 <> 0 THEN c_nationkey END AS nation FROM customer)"""


@query("p22_non_finite_fill", f"""WITH {DIRTY_SQL} SELECT c_custkey, CASE WHEN isnan(amount) OR isinf(amount) OR amount IS NULL THEN 0 ELSE amount END AS amount,
 CAST(coalesce(nation, 0) AS BIGINT) AS nation FROM dirty""")
def non_finite(spark, folder):
    df = _dirty(spark, folder)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select("c_custkey", fx.finite_or("amount", kinds["amount"]).alias("amount"), fx.finite_or("nation", kinds["nation"]).cast("long").alias("nation"))


@query("p23_constant_fill", f"""WITH {m.APPLICATION_SQL}, {m.POS_SQL}, a AS (SELECT SK_ID_CURR, max(SK_DPD) AS d, count(*) AS n FROM pos_cash GROUP BY 1)
 SELECT SK_ID_CURR, coalesce(d, 0) AS "pos_SK_DPD_max", coalesce(n, 0) AS "pos_ROWS", AMT_ANNUITY FROM application LEFT JOIN a USING (SK_ID_CURR)""")
def constant_fill(spark, folder):
    """History columns are filled by prefix, base columns are not."""
    from riskloom.operators.impute import Imputation

    pos = m.pos_cash(spark, folder).groupBy(KEY).agg(F.max("SK_DPD").alias("pos_SK_DPD_max"), F.count(F.lit(1)).alias("pos_ROWS"))
    df = m.application(spark, folder).select(KEY, "AMT_ANNUITY").join(pos, KEY, "left")
    return Imputation(zero_filled=[c for c in df.columns if c.startswith("pos_")]).apply(df)


@query("p24_column_alignment", APP + f"SELECT {KEY}, AMT_CREDIT, CAST(0 AS BIGINT) AS ABSENT, CNT_FAM_MEMBERS FROM application WHERE {KEY} % 5 = 0")
def alignment(spark, folder):
    train_columns = [KEY, "TARGET", "AMT_CREDIT", "ABSENT", "CNT_FAM_MEMBERS"]
    df = ap.Pruning(train_columns).apply(m.test_rows(m.application(spark, folder)), without=["TARGET"])
    return df.withColumn("ABSENT", F.col("ABSENT").cast("long"))


@query("p25_clean_names", """SELECT p_partkey AS "part_key", p_brand AS "brand_no", p_size AS "size_cm_" , p_retailprice AS price FROM part""".replace('"size_cm_"', '"size_cm"').replace("p_size AS", "CAST(p_size AS BIGINT) AS"))
def clean_names(spark, folder):
    df = table(spark, folder, "part").select(
        F.col("p_partkey").alias("part key"), F.col("p_brand").alias("__brand..no"), F.col("p_size").cast("long").alias("size (cm)"), F.col("p_retailprice").alias("price"),
    )
    return tidy_columns(df)


@query("p30_type_selection", f"""SELECT c_custkey, c_name AS text_c_name, c_mktsegment AS text_c_mktsegment, {r('c_acctbal + c_nationkey')} AS number_sum FROM customer""")
def type_selection(spark, folder):
    df = table(spark, folder, "customer")
    texts, numbers = fx.string_columns(df), fx.numeric_columns(df, skip=["c_custkey"])
    return df.select("c_custkey", *[F.col(c).alias(f"text_{c}") for c in texts], rounded(fx.row_sum(numbers)).alias("number_sum"))


@query("f01_math", f"""SELECT c_custkey, abs(c_acctbal) AS a, {r('sqrt(abs(c_acctbal))')} AS s, {r('pow(c_acctbal / 100, 2)')} AS p FROM customer""")
def math_functions(spark, folder):
    c = F.col("c_acctbal")
    return table(spark, folder, "customer").select("c_custkey", F.abs(c).alias("a"), rounded(F.sqrt(F.abs(c))).alias("s"), rounded(F.pow(c / 100, F.lit(2.0))).alias("p"))


@query("f02_float_predicates", f"""WITH {DIRTY_SQL} SELECT c_custkey, CAST(coalesce(isnan(amount) OR isinf(amount), FALSE) AS BIGINT) AS invalid,
 CAST(amount IS NULL AS BIGINT) AS missing FROM dirty""")
def float_predicates(spark, folder):
    df = _dirty(spark, folder)
    return df.select("c_custkey", fx.is_invalid_number("amount", df.schema["amount"].dataType).cast("long").alias("invalid"), fx.null_flag("amount", "long").alias("missing"))


@query("f03_casts", """SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS lead, TRY_CAST(o_orderpriority AS DOUBLE) AS none FROM orders""")
def casts(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).try_cast("double").alias("lead"), F.col("o_orderpriority").try_cast("double").alias("none"),
    )


@query("f04_conditional", """SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 'high' WHEN o_totalprice > 100000 THEN 'middle' ELSE 'low' END AS band,
 coalesce(CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END, '?') AS status FROM orders""")
def conditional(spark, folder):
    price = F.col("o_totalprice")
    return table(spark, folder, "orders").select(
        "o_orderkey", F.when(price > 250000, "high").when(price > 100000, "middle").otherwise("low").alias("band"),
        F.coalesce(F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus")), F.lit("?")).alias("status"),
    )


@query("f05_name_patterns", "SELECT p_partkey, p_name AS p_name, p_brand AS p_brand, p_type AS p_type FROM part")
def name_patterns(spark, folder):
    """Columns picked by prefix and type, in sorted name order."""
    df = table(spark, folder, "part")
    return df.select("p_partkey", *sorted(c for c in fx.string_columns(df) if c.startswith("p_")))


@query("f06_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_field(spark, folder):
    return table(spark, folder, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("f07_flatten", """WITH g AS (SELECT event_type, count(*) AS n, max(value) AS top, min(value) AS low FROM events GROUP BY 1)
 SELECT event_type, 'rows' AS metric, CAST(n AS DOUBLE) AS value FROM g UNION ALL SELECT event_type, 'value.max', top FROM g UNION ALL SELECT event_type, 'value.min', low FROM g""")
def flatten(spark, folder):
    from riskloom.functions.structs import numeric_fields

    nested = table(spark, folder, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"), F.struct(F.max("value").alias("max"), F.min("value").alias("min"), F.lit(True).alias("checked")).alias("value"), F.first(F.lit("x")).alias("note"),
    )
    return numeric_fields(nested, "event_type")
