"""Aggregate, sort and window queries: A01-A08, A19-A25, T01-T05, W02."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog import mapping as m
from riskloom.catalog.expressions import DIRTY_SQL, _dirty
from riskloom.catalog.registry import query, r, rounded, rounded_table, table
from riskloom.catalog.rollups import plan_sql
from riskloom.operators.impute import null_counts
from riskloom.operators.gram import strong_pairs
from riskloom.operators.prune import correlated_columns, correlation_matrix, near_constant_columns, value_shares
from riskloom.operators.quality import invalid_numbers
from riskloom.operators.quantiles import exact_quantiles
from riskloom.operators.rollup import Rollup, Stat, categories, roll_up
from riskloom.operators.training import rank_features
from riskloom.plans.training import run_metadata

KEY = "SK_ID_CURR"


def _simple(key: str, *found: Stat, distinct=()):
    plan = Rollup(KEY, tuple(found), distinct=distinct)

    @query(key, plan_sql(m.PREVIOUS_SQL, "previous_application", plan))
    def run(spark, folder):
        return rounded_table(roll_up(m.previous_application(spark, folder), plan))

    return run


_simple("a01_mean", Stat("mean", "AMT_CREDIT"), Stat("mean", "AMT_ANNUITY"))
_simple("a02_sum", Stat("sum", "AMT_CREDIT"), Stat("sum", "AMT_ANNUITY"))
_simple("a03_max_min", Stat("max", "AMT_CREDIT"), Stat("min", "DAYS_DECISION"))
_simple("a04_count", Stat("count", "DAYS_DECISION"), Stat("count", "AMT_ANNUITY"))
_simple("a05_row_count", Stat("rows", name="ROWS"))
_simple("a06_distinct_count", Stat("rows", name="ROWS"), distinct=("CNT_PAYMENT", "AMT_ANNUITY"))
_simple("a07_conditional_count", Stat("matches", "NAME_CONTRACT_STATUS", "Refused", "REFUSED"))
_simple("a08_conditional_share", Stat("share", "NAME_CONTRACT_STATUS", "Refused", "REFUSED_SHARE"))

_MEDIANS = ("AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "DAYS_LAST_PHONE_CHANGE", "EXT_SOURCE_1", "EXT_SOURCE_3")


@query("a19_medians", f"WITH {m.APPLICATION_SQL}, {m.SPLIT_SQL} " + " UNION ALL ".join(
    f"SELECT '{c}' AS name, {r(f'quantile_cont({c}, 0.5)')} AS median FROM train" for c in _MEDIANS))
def medians(spark, folder):
    found = exact_quantiles(m.train_rows(m.application(spark, folder)), _MEDIANS, [0.5])
    return spark.createDataFrame([(c, found[c][0]) for c in _MEDIANS], "name string, median double").select("name", rounded("median").alias("median"))


@query("a20_null_counts", f"WITH {m.APPLICATION_SQL} " + " UNION ALL ".join(
    f"SELECT '{c}' AS name, count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM application" for c in (*_MEDIANS, "OCCUPATION_TYPE")))
def nulls(spark, folder):
    found = null_counts(m.application(spark, folder), [*_MEDIANS, "OCCUPATION_TYPE"])
    return spark.createDataFrame(list(found.items()), "name string, nulls long")


_SHARED = ("CNT_FAM_MEMBERS", "FLAG_DOCUMENT_3", "NAME_CONTRACT_TYPE", "OCCUPATION_TYPE")


@query("a21_dominant_share", f"WITH {m.APPLICATION_SQL} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(max(n) AS BIGINT) AS top_count, CAST(sum(n) AS BIGINT) AS \"rows\", {r('max(n) / sum(n)')} AS share FROM (SELECT {c}, count(*) AS n FROM application GROUP BY 1)"
    for c in _SHARED))
def dominant(spark, folder):
    return rounded_table(value_shares(m.application(spark, folder), _SHARED))


@query("a21_near_constant", f"""WITH d AS (SELECT 'l_linestatus' AS name, max(n) / sum(n) AS s FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_linestatus)
 UNION ALL SELECT 'rare', max(n) / sum(n) FROM (SELECT count(*) AS n FROM lineitem GROUP BY CASE WHEN l_partkey % 500 = 0 THEN 1 ELSE 0 END)
 UNION ALL SELECT 'mostly_null', max(n) / sum(n) FROM (SELECT count(*) AS n FROM lineitem GROUP BY CASE WHEN l_partkey % 400 = 0 THEN l_quantity END)
 UNION ALL SELECT 'l_quantity', max(n) / sum(n) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_quantity)) SELECT name FROM d WHERE s > 0.995""")
def near_constant(spark, folder):
    df = table(spark, folder, "lineitem").select(
        "l_linestatus", (F.col("l_partkey") % 500 == 0).cast("int").alias("rare"), F.when(F.col("l_partkey") % 400 == 0, F.col("l_quantity")).alias("mostly_null"), "l_quantity",
    )
    found = near_constant_columns(df, df.columns, 0.995)
    return spark.createDataFrame([(c,) for c in found], "name string")


_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _line_columns(spark, folder):
    price = F.col("l_extendedprice")
    return table(spark, folder, "lineitem").select(*_NUMBERS, (price * 2 + F.col("l_tax")).alias("doubled"), F.lit(1.0).alias("constant"))


@query("a22_correlation", f"WITH l AS (SELECT *, l_extendedprice * 2 + l_tax AS doubled FROM lineitem) " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {r(f'corr({a}, {b})')} AS r FROM l" for i, a in enumerate((*_NUMBERS, "doubled")) for b in (*_NUMBERS, "doubled")[i + 1:]))
def correlation(spark, folder):
    columns = [*_NUMBERS, "doubled"]
    found = correlation_matrix(_line_columns(spark, folder), columns)
    rows = [(a, b, float(found[i][j])) for i, a in enumerate(columns) for j, b in enumerate(columns) if i < j]
    return spark.createDataFrame(rows, "a string, b string, r double").select("a", "b", rounded("r").alias("r"))


@query("a22_correlation_prune", """WITH l AS (SELECT *, l_extendedprice * 2 + l_tax AS doubled FROM lineitem)
 SELECT 'doubled' AS name FROM l HAVING greatest(abs(corr(l_quantity, doubled)), abs(corr(l_extendedprice, doubled)), abs(corr(l_discount, doubled)), abs(corr(l_tax, doubled))) > 0.99
 UNION ALL SELECT 'l_extendedprice' FROM l HAVING abs(corr(l_quantity, l_extendedprice)) > 0.99
 UNION ALL SELECT 'l_discount' FROM l HAVING greatest(abs(corr(l_quantity, l_discount)), abs(corr(l_extendedprice, l_discount))) > 0.99
 UNION ALL SELECT 'l_tax' FROM l HAVING greatest(abs(corr(l_quantity, l_tax)), abs(corr(l_extendedprice, l_tax)), abs(corr(l_discount, l_tax))) > 0.99""")
def correlation_prune(spark, folder):
    df = _line_columns(spark, folder)
    return spark.createDataFrame([(c,) for c in correlated_columns(df, df.columns, 0.99)], "name string")


@query("a22_strong_pairs", "WITH l AS (SELECT *, l_extendedprice * 2 + l_tax AS doubled FROM lineitem), p AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS c FROM l" for i, a in enumerate((*_NUMBERS, "doubled")) for b in (*_NUMBERS, "doubled")[i + 1:])
    + f") SELECT a, b, {r('c')} AS r FROM p WHERE abs(c) > 0.5")
def pairs_by_tiles(spark, folder):
    """The long list of pairs from tiles of two columns each, read in bands."""
    found = strong_pairs(_line_columns(spark, folder), [*_NUMBERS, "doubled", "constant"], 0.5, block=2, held=100)
    return found.select(F.col("first").alias("a"), F.col("second").alias("b"), rounded("correlation").alias("r"))


@query("a23_distinct_values", f"WITH {m.APPLICATION_SQL} SELECT DISTINCT NAME_SEGMENT AS category FROM application WHERE NAME_SEGMENT IS NOT NULL")
def distinct_values(spark, folder):
    return spark.createDataFrame([(c,) for c in categories(m.application(spark, folder), "NAME_SEGMENT")], "category string")


@query("a24_invalid_numbers", f"""WITH {DIRTY_SQL} SELECT 'amount' AS name, count(*) FILTER (WHERE isnan(amount) OR isinf(amount)) AS invalid FROM dirty""")
def invalid(spark, folder):
    return spark.createDataFrame(list(invalid_numbers(_dirty(spark, folder)).items()), "name string, invalid long")


@query("a25_run_counts", f"""WITH {m.APPLICATION_SQL}, {m.SPLIT_SQL} SELECT count(*) AS row_count, CAST(sum(TARGET) AS BIGINT) AS positive_count, CAST(30 AS BIGINT) AS feature_count FROM train""".replace(
    "CAST(30 AS BIGINT)", "CAST((SELECT count(*) - 2 FROM (DESCRIBE application)) AS BIGINT)"))
def run_counts(spark, folder):
    df = m.train_rows(m.application(spark, folder))
    facts = run_metadata(df, [c for c in df.columns if c not in (KEY, "TARGET")], "TARGET")
    return spark.createDataFrame([(facts["row_count"], facts["positive_count"], facts["feature_count"])], "row_count long, positive_count long, feature_count long")


def _importance(spark, folder):
    """A long importance table made from the parts: one row per brand."""
    return table(spark, folder, "part").groupBy(F.col("p_brand").alias("feature")).agg(F.sum("p_retailprice").alias("importance"))


_IMP = "imp AS (SELECT p_brand AS feature, sum(p_retailprice) AS importance FROM part GROUP BY 1)"


@query("t01_two_key_sort", f"WITH {m.PREVIOUS_SQL} SELECT SK_ID_CURR, SK_ID_PREV, DAYS_DECISION FROM previous_application ORDER BY SK_ID_CURR, DAYS_DECISION DESC NULLS FIRST, SK_ID_PREV")
def two_key_sort(spark, folder):
    """A global sort: Spark cuts its ranges on the whole sort key, so one frequent key is spread over ranges."""
    df = m.previous_application(spark, folder).select(KEY, "SK_ID_PREV", "DAYS_DECISION")
    return df.orderBy(F.col(KEY).asc(), F.col("DAYS_DECISION").desc_nulls_first(), F.col("SK_ID_PREV").asc())


@query("t02_top_importance", f"WITH {_IMP} SELECT feature, {r('importance')} AS importance FROM imp ORDER BY importance DESC, feature LIMIT 10")
def top_importance(spark, folder):
    return rounded_table(_importance(spark, folder).orderBy(F.desc("importance"), "feature").limit(10))


@query("t04_top_features", f"""WITH {_IMP}, k AS (SELECT feature, importance, row_number() OVER (ORDER BY importance DESC, feature) AS rank FROM imp WHERE importance >= 1000)
 SELECT feature, {r('importance')} AS importance, rank FROM k WHERE rank <= 8""")
def top_features(spark, folder):
    return rounded_table(rank_features(_importance(spark, folder), top=8, minimum=1000.0))


@query("t05_distinct", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def distinct(spark, folder):
    return table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus").distinct()
