"""Encoder and imputer queries: E01-E08, J04."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog import mapping as m
from riskloom.catalog.expressions import EPS, _E, _MEAN, _N, _SQUARES, ratio_sql
from riskloom.catalog.registry import query, r, rounded, rounded_table
from riskloom.catalog.rollups import INST_CTES
from riskloom.functions import columns as fx
from riskloom.operators.encode import fit_codes, fit_frequency
from riskloom.operators.impute import fit_imputation
from riskloom.plans import application as ap
from riskloom.plans import fixed_values as fv
from riskloom.plans.build import build_features

KEY = "SK_ID_CURR"
BASE = f"WITH {m.APPLICATION_SQL}, {m.SPLIT_SQL} "
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def _marked(split) -> str:
    """Both tables with the split that a row is in."""
    return f"(SELECT *, '{split[0]}' AS split FROM {split[0]} UNION ALL BY NAME SELECT *, '{split[1]}' AS split FROM {split[1]})"


BOTH = _marked(("train", "test"))


def both_parts(spark, folder, apply):
    """``apply`` on train and on test rows, each marked by its split."""
    train, test = _both(spark, folder)
    return apply(train).withColumn("split", F.lit("train")).unionByName(apply(test).withColumn("split", F.lit("test")))


def _both(spark, folder):
    df = m.application(spark, folder)
    return m.train_rows(df), m.test_rows(df)


@query("e01_frequency", BASE + f"""SELECT {KEY}, coalesce(n, 1) AS "OCCUPATION_TYPE_FREQ" FROM application LEFT JOIN
 (SELECT OCCUPATION_TYPE, count(*) AS n FROM train WHERE OCCUPATION_TYPE IS NOT NULL GROUP BY 1) USING (OCCUPATION_TYPE)""")
def frequency(spark, folder):
    """Training counts, with null and unseen as 1."""
    train, _ = _both(spark, folder)
    return fit_frequency(train, "OCCUPATION_TYPE").apply(m.application(spark, folder).select(KEY, "OCCUPATION_TYPE"))


@query("j04_lookup_join", BASE + f"""SELECT {KEY}, {r('coalesce(n, 1)')} AS "ORGANIZATION_TYPE_FREQ" FROM application LEFT JOIN
 (SELECT ORGANIZATION_TYPE, count(*) / (SELECT count(*) FROM train) AS n FROM train GROUP BY 1) USING (ORGANIZATION_TYPE)""")
def lookup(spark, folder):
    """Training shares joined to all rows, also to those they were not fitted on."""
    train, _ = _both(spark, folder)
    return rounded_table(fit_frequency(train, "ORGANIZATION_TYPE", normalize=True).apply(m.application(spark, folder).select(KEY, "ORGANIZATION_TYPE")))


@query("e02_binary", BASE + f"SELECT {KEY}, CAST(CASE NAME_CONTRACT_TYPE WHEN 'Cash loans' THEN 0 WHEN 'Revolving loans' THEN 1 ELSE -1 END AS BIGINT) AS NAME_CONTRACT_TYPE, split FROM {BOTH}")
def binary(spark, folder):
    codes = fit_codes(_both(spark, folder)[0], ["NAME_CONTRACT_TYPE"])
    return rounded_table(both_parts(spark, folder, lambda df: codes.apply(df.select(KEY, "NAME_CONTRACT_TYPE"))))


_HOT = ", ".join(f"""CAST(coalesce(NAME_SEGMENT, '__NULL__') = '{s}' AS BIGINT) AS "NAME_SEGMENT_{s}" """ for s in (*SEGMENTS, "__NULL__"))


@query("e03_one_hot", BASE + f"SELECT {KEY}, {_HOT} FROM application")
def one_hot(spark, folder):
    train, _ = _both(spark, folder)
    return rounded_table(fit_codes(train, ["NAME_SEGMENT"]).apply(m.application(spark, folder).select(KEY, "NAME_SEGMENT")))


_NATIONS = [f"N{i}" for i in range(25)]
_OCC = ", ".join(f"""CAST(coalesce(OCCUPATION_TYPE, '__NULL__') = '{s}' AS BIGINT) AS "OCCUPATION_TYPE_{s}" """ for s in (*_NATIONS, "__NULL__"))
_ORG = ", ".join(f"""CAST(ORGANIZATION_TYPE = '{s}' AS BIGINT) AS "ORGANIZATION_TYPE_{s}" """ for s in SEGMENTS)
_BIN = "CAST(CASE NAME_CONTRACT_TYPE WHEN 'Cash loans' THEN 0 WHEN 'Revolving loans' THEN 1 ELSE -1 END AS BIGINT) AS NAME_CONTRACT_TYPE"


@query("e04_all_categories", BASE + f"SELECT {KEY}, {_BIN}, {_HOT}, {_OCC}, {_ORG}, split FROM {BOTH}")
def all_categories(spark, folder):
    """Every text column of the training rows, applied to both tables."""
    train, _ = _both(spark, folder)
    texts = fx.string_columns(train, skip=[KEY, "TARGET"])
    codes = fit_codes(train, texts)
    return rounded_table(both_parts(spark, folder, lambda df: codes.apply(df.select(KEY, *texts))))


_FILLED = ("AMT_ANNUITY", "AMT_GOODS_PRICE", "EXT_SOURCE_1", "EXT_SOURCE_3", "AMT_CREDIT")


@query("e05_median_impute", BASE + f"SELECT {KEY}, " + ", ".join(
    f"{r(f'coalesce({c}, (SELECT median({c}) FROM train))')} AS {c}" for c in _FILLED) + ", " + ", ".join(
    f'CAST({c} IS NULL AS BIGINT) AS "{c}_is_missing"' for c in _FILLED[:-1]) + " FROM application")
def impute(spark, folder):
    train, _ = _both(spark, folder)
    columns = [KEY, *_FILLED]
    return rounded_table(fit_imputation(train.select(columns), [KEY], []).apply(m.application(spark, folder).select(columns)))


_E06_COLS = ", ".join([
    f"{KEY}", "CASE WHEN DAYS_EMPLOYED <> 365243 THEN DAYS_EMPLOYED END AS DAYS_EMPLOYED", f"{r('abs(DAYS_BIRTH) / 365.25')} AS AGE_YEARS",
    f"{r('AMT_GOODS_PRICE - AMT_CREDIT')} AS DOWN_PAYMENT", f"{r(f'(AMT_GOODS_PRICE - AMT_CREDIT) / (AMT_CREDIT + {EPS})', 2)} AS DOWN_PAYMENT_RATIO",
    *[ratio_sql(*f) for f in fv.EXTENDED_RATIOS],
    ratio_sql("DAYS_EMPLOYED_PERC", "CASE WHEN DAYS_EMPLOYED <> 365243 THEN DAYS_EMPLOYED END", "DAYS_BIRTH"), ratio_sql(*fv.BASE_RATIOS[1]),
    *[f'CAST({c} IS NULL AS BIGINT) AS "{c}_is_missing"' for c in fv.FLAGGED_WHEN_MISSING], "CAST(FLAG_DOCUMENT_2 + FLAG_DOCUMENT_3 AS DOUBLE) AS DOCUMENT_COUNT",
    """coalesce((SELECT n FROM o WHERE o.ORGANIZATION_TYPE = b.ORGANIZATION_TYPE), 1) AS "ORGANIZATION_TYPE_FREQ" """,
    """coalesce((SELECT n FROM c WHERE c.OCCUPATION_TYPE = b.OCCUPATION_TYPE), 1) AS "OCCUPATION_TYPE_FREQ" """, _BIN, _HOT,
])
E06_NAMES = ["DAYS_EMPLOYED", "AGE_YEARS", "DOWN_PAYMENT", "DOWN_PAYMENT_RATIO", *[f[0] for f in (*fv.EXTENDED_RATIOS, *fv.BASE_RATIOS)],
             *[f"{c}_is_missing" for c in fv.FLAGGED_WHEN_MISSING], "DOCUMENT_COUNT", "ORGANIZATION_TYPE_FREQ", "OCCUPATION_TYPE_FREQ", "NAME_CONTRACT_TYPE",
             *[f"NAME_SEGMENT_{s}" for s in (*SEGMENTS, "__NULL__")]]
_TWO_DIGITS = {"DOWN_PAYMENT_RATIO", *[f[0] for f in (*fv.EXTENDED_RATIOS, *fv.BASE_RATIOS)]}


@query("e06_base_transform", BASE + f""", o AS (SELECT ORGANIZATION_TYPE, count(*) AS n FROM train GROUP BY 1), c AS (SELECT OCCUPATION_TYPE, count(*) AS n FROM train GROUP BY 1)
 SELECT {_E06_COLS}, split FROM {BOTH} b""")
def base_transform(spark, folder):
    base = ap.fit_base(_both(spark, folder)[0])
    df = both_parts(spark, folder, lambda part: base.apply(part.drop("TARGET")))
    whole = {"DAYS_EMPLOYED", "DOCUMENT_COUNT"}
    out = [F.col(KEY)]
    for c in E06_NAMES:
        kind = dict(df.dtypes)[c]
        if kind != "double":
            out.append(F.col(c).cast("long").alias(c))
        elif c in whole:
            out.append(F.col(c))
        else:
            out.append(rounded(c, 2 if c in _TWO_DIGITS else 4).alias(c))
    return df.select(*out, "split")


def _filled(e: str, digits: int = 4) -> str:
    return f"coalesce({r(e, digits)}, 0)"


@query("e07_global_features", BASE + f"""SELECT {KEY}, CASE WHEN split = 'train' THEN CAST(TARGET AS BIGINT) ELSE 0 END AS "TARGET", """ + ", ".join([
    *[f'{_filled(f"{a} / ({b} + {EPS})", 2)} AS "{n}"' for n, a, b in fv.GLOBAL_RATIOS], f"{_filled(_MEAN)} AS EXT_SOURCES_MEAN",
    f"{_filled('least(' + ', '.join(_E) + ')')} AS EXT_SOURCES_MIN", f"{_filled('greatest(' + ', '.join(_E) + ')')} AS EXT_SOURCES_MAX",
    f"{_filled('greatest(' + ', '.join(_E) + ') - least(' + ', '.join(_E) + ')')} AS EXT_SOURCES_RANGE", f"{_filled(' * '.join(_E))} AS EXT_SOURCES_PROD",
    f"{_filled(f'sqrt(({_SQUARES}) / {_N})')} AS EXT_SOURCES_STD", f"{_filled(' + '.join(f'coalesce({c}, 0)' for c in fv.ENQUIRY_COUNTS))} AS AMT_REQ_CREDIT_BUREAU_TOTAL",
]) + f", split FROM {BOTH}")
def global_features(spark, folder):
    df = both_parts(spark, folder, lambda part: ap.add_row_statistics(part if "TARGET" in part.columns else part.withColumn("TARGET", F.lit(None).cast("int"))))
    ratios = [n for n, _, _ in fv.GLOBAL_RATIOS]
    stats = ["EXT_SOURCES_MEAN", "EXT_SOURCES_MIN", "EXT_SOURCES_MAX", "EXT_SOURCES_RANGE", "EXT_SOURCES_PROD", "EXT_SOURCES_STD", "AMT_REQ_CREDIT_BUREAU_TOTAL"]

    def shown(c, digits):
        # the fill happens before rounding here and after it in the check
        return F.when(F.col(c) == 0, F.lit(0.0)).otherwise(rounded(c, digits)).alias(c)

    return df.select(KEY, F.col("TARGET").cast("long").alias("TARGET"), *[shown(c, 2) for c in ratios], *[shown(c, 4) for c in stats], "split")


_CLEAN = ("DAYS_BIRTH", "DAYS_TWICE", "AMT_CREDIT", "EXT_SOURCE_2", "ALMOST_ALWAYS_0")


def _tied(j: int) -> str:
    pairs = [f"CASE WHEN isnan(corr({a}, {_CLEAN[j]})) THEN 0 ELSE abs(corr({a}, {_CLEAN[j]})) END" for a in _CLEAN[:j]]
    return f"(SELECT greatest(0, {', '.join(pairs)}) > 0.99 FROM c)" if pairs else "FALSE"


@query("e08_cleanup", BASE + f""", c AS (SELECT *, DAYS_BIRTH * 2 + 1 AS DAYS_TWICE, CAST({KEY} % 401 = 1 AS INT) AS ALMOST_ALWAYS_0 FROM train) """ + " UNION ALL ".join(
    f"SELECT 'correlated' AS reason, '{c}' AS name WHERE {_tied(j)}" for j, c in enumerate(_CLEAN)) + " UNION ALL " + " UNION ALL ".join(
    f"SELECT 'near_constant', '{c}' WHERE NOT {_tied(j)} AND (SELECT max(n) / sum(n) > 0.995 FROM (SELECT count(*) AS n FROM c GROUP BY {c}))" for j, c in enumerate(_CLEAN)))
def cleanup(spark, folder):
    train, _ = _both(spark, folder)
    df = train.select(
        KEY, "TARGET", "DAYS_BIRTH", (F.col("DAYS_BIRTH") * 2 + 1).alias("DAYS_TWICE"), "AMT_CREDIT", "EXT_SOURCE_2",
        (F.col(KEY) % 401 == 1).cast("int").alias("ALMOST_ALWAYS_0"),
    )
    found = ap.fit_pruning(df)
    rows = [("correlated", c) for c in found.correlated] + [("near_constant", c) for c in found.near_constant]
    return spark.createDataFrame(rows, "reason string, name string")


_JOB = (("AMT_ANNUITY", "a"), ("EXT_SOURCE_1", "e1"), ("EXT_SOURCE_3", "e3"))


@query("e08_feature_job", f"""WITH {m.APPLICATION_SQL}, {INST_CTES}, i AS (SELECT SK_ID_CURR, avg(DPD) FILTER (WHERE DAYS_INSTALMENT >= -365) AS "inst_DPD_mean_365D" FROM inst GROUP BY 1),
 j AS (SELECT * FROM application LEFT JOIN i USING (SK_ID_CURR)), f AS (SELECT {', '.join(f'median("{c}") AS {short}' for c, short in _JOB)} FROM j WHERE {KEY} % 5 <> 0),
 o AS (SELECT ORGANIZATION_TYPE, count(*) AS n FROM application WHERE {KEY} % 5 <> 0 GROUP BY 1),
 k AS (SELECT * REPLACE ({', '.join(f'coalesce("{c}", {short}) AS "{c}"' for c, short in _JOB)}) FROM j CROSS JOIN f)
 SELECT {KEY}, CASE WHEN {KEY} % 5 <> 0 THEN 'train' ELSE 'test' END AS split, CASE WHEN {KEY} % 5 <> 0 THEN CAST(TARGET AS BIGINT) ELSE -1 END AS "TARGET", {_BIN},
  {r('AMT_ANNUITY', 2)} AS "AMT_ANNUITY", {r('(EXT_SOURCE_1 + EXT_SOURCE_2 + EXT_SOURCE_3) / 3')} AS "EXT_SOURCES_MEAN", coalesce({r('"inst_DPD_mean_365D"')}, 0) AS "inst_DPD_mean_365D",
  CAST(o.n AS DOUBLE) AS "ORGANIZATION_TYPE_FREQ" FROM k LEFT JOIN o USING (ORGANIZATION_TYPE)""")
def feature_job(spark, folder):
    """The whole job, from source tables to the final train and test tables; some columns of each of its stages."""
    done = build_features(m.credit_tables(spark, folder))
    both = done.train.withColumn("split", F.lit("train")).unionByName(done.test.withColumns({"TARGET": F.lit(-1), "split": F.lit("test")}))
    return both.select(
        KEY, "split", F.col("TARGET").cast("long").alias("TARGET"), F.col("NAME_CONTRACT_TYPE").cast("long").alias("NAME_CONTRACT_TYPE"),
        rounded("AMT_ANNUITY", 2).alias("AMT_ANNUITY"), rounded("EXT_SOURCES_MEAN").alias("EXT_SOURCES_MEAN"),
        F.when(F.col("inst_DPD_mean_365D") == 0, F.lit(0.0)).otherwise(rounded("inst_DPD_mean_365D")).alias("inst_DPD_mean_365D"), F.col("ORGANIZATION_TYPE_FREQ").cast("double").alias("ORGANIZATION_TYPE_FREQ"))
