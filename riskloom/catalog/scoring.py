"""Scoring and attribution queries: P28, P29, C01-C05, X01-X04."""

from __future__ import annotations

from itertools import combinations
from math import factorial

from pyspark.sql import functions as F

from riskloom.catalog import mapping as m
from riskloom.catalog.modelling import _DRAWN, _features, KEY, LABEL, PARAMS, SEED, SMALL, taken, training_table
from riskloom.catalog.registry import query, r, rounded, rounded_table, table
from riskloom.catalog.sources import PROBABILITY_SQL, WEIGHTS
from riskloom.operators import explain as ex
from riskloom.operators import metrics as mx
from riskloom.operators import scoring as sc
from riskloom.operators import training as tr
from riskloom.operators import tree_explain as tx
from riskloom.session import scratch_path
from riskloom.sources import sinks
from riskloom.streaming.scoring import open_stream, score_stream, write_stream


@query("p28_feature_alignment", f"WITH {m.APPLICATION_SQL} SELECT SK_ID_CURR, EXT_SOURCE_2, CAST(0 AS BIGINT) AS \"NOT_THERE\", AMT_CREDIT FROM application")
def align(spark, folder):
    """Expected columns in order, missing ones filled, extra ones ignored, the target dropped."""
    df, _ = sc.align_features(m.application(spark, folder), ["EXT_SOURCE_2", "NOT_THERE", "AMT_CREDIT"], allow_target=True)
    return df.withColumn("NOT_THERE", F.col("NOT_THERE").cast("long"))


@query("p28_alignment_report", """SELECT 'extra' AS kind, column_name AS name FROM (DESCRIBE customer) WHERE column_name NOT IN ('c_custkey', 'c_acctbal') UNION ALL SELECT 'missing', 'c_age' FROM (DESCRIBE customer) WHERE column_name = 'c_custkey'""")
def align_report(spark, folder):
    _, found = sc.align_features(table(spark, folder, "customer"), ["c_acctbal", "c_age"], key="c_custkey")
    return spark.createDataFrame([("extra", c) for c in found.extra] + [("missing", c) for c in found.missing], "kind string, name string")


@query("p29_signature_alignment", "SELECT c_custkey, CAST(c_nationkey AS DOUBLE) AS c_nationkey, CAST(0 AS DOUBLE) AS absent, c_custkey % 10 AS digit, c_custkey % 7 AS decimals FROM customer")
def signature(spark, folder):
    """Text and whole numbers are cast to the declared types, text with decimals is read and cut, absent columns are 0."""
    df = table(spark, folder, "customer").select("c_custkey", "c_nationkey", (F.col("c_custkey") % 10).cast("string").alias("digit"),
                                                     F.concat((F.col("c_custkey") % 7).cast("string"), F.lit(".5")).alias("decimals"), "c_name")
    aligned, _ = sc.align_to_signature(df, {"c_custkey": "long", "c_nationkey": "double", "absent": "double", "digit": "long", "decimals": "long"}, "c_custkey")
    return aligned


@query("p29_uncastable_values", "SELECT 'o_orderpriority' AS name, count(*) FILTER (WHERE TRY_CAST(o_orderpriority AS DOUBLE) IS NULL) AS bad FROM orders UNION ALL SELECT 'text_price', 0 FROM orders GROUP BY 1")
def uncastable(spark, folder):
    df = table(spark, folder, "orders").select("o_orderpriority", F.col("o_totalprice").cast("string").alias("text_price"))
    return spark.createDataFrame(list(sc.uncastable(df, {"o_orderpriority": "double", "text_price": "double"}).items()), "name string, bad long")


_INPUTS = ("EXT_SOURCE_2", "AMT_CREDIT", "CNT_FAM_MEMBERS")
_SCALED_WEIGHTS = sc.LinearWeights({"EXT_SOURCE_2": -1.5, "AMT_CREDIT": 0.5, "CNT_FAM_MEMBERS": 0.25}, -1.0)
_SCALED_P = "1 / (1 + exp(-(CAST(-1.0 AS DOUBLE) + " + " + ".join(
    f"CAST({w} AS DOUBLE) * ({c} - {c}_c) / {c}_w" for c, w in _SCALED_WEIGHTS.weights.items()) + ")))"
_FITTED = "f AS (SELECT " + ", ".join(f"median({c}) AS {c}_c, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS {c}_w" for c in _INPUTS) + " FROM train)"


def scaled_scorer(spark, folder) -> sc.Scorer:
    """Robust scaling fitted on the training customers, then a linear model."""
    train = m.train_rows(m.application(spark, folder)).select(KEY, LABEL, *_INPUTS)
    return sc.Scorer(_SCALED_WEIGHTS, tr.fit_preprocessing(train, _INPUTS, tr.TrainingOptions(selection=None)))


@query("c01_batch_scoring", f"""WITH {m.APPLICATION_SQL}, {m.SPLIT_SQL}, {_FITTED} SELECT SK_ID_CURR, {r(_SCALED_P, 6)} AS "TARGET_PROBABILITY", CAST({_SCALED_P} >= 0.25 AS BIGINT) AS "TARGET_PREDICTION" FROM application CROSS JOIN f""")
def batch(spark, folder):
    scored, _ = sc.score_batch(m.application(spark, folder).drop(LABEL), scaled_scorer(spark, folder), 0.25)
    return rounded_table(scored, 6)


@query("c02_threshold_lookup", f"""WITH {m.SCORED_SQL}, grid AS (SELECT CAST(i AS DOUBLE) / 100 AS threshold FROM range(1, 100) t(i)),
 c AS (SELECT threshold, count(*) FILTER (WHERE p > threshold AND y = 1) AS tp, count(*) FILTER (WHERE p > threshold AND y = 0) AS fp, count(*) FILTER (WHERE p <= threshold AND y = 1) AS fn FROM grid CROSS JOIN scored GROUP BY 1),
 b AS (SELECT threshold FROM c ORDER BY CASE WHEN tp = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END DESC, CASE WHEN tp = 0 THEN 0 ELSE tp / (tp + fp) END DESC, threshold LIMIT 1)
 SELECT 'argument' AS source, CAST(0.7 AS DOUBLE) AS threshold FROM b UNION ALL SELECT 'config', CAST(0.5 AS DOUBLE) FROM b UNION ALL SELECT 'artifact', threshold FROM b""")
def threshold(spark, folder):
    """An argument wins, then the configured source: a value, or the written result of the evaluation."""
    found = mx.best_threshold(mx.threshold_table(m.scored_documents(spark, folder), "y", "p"), "out_of_fold")
    path = sinks.write_table(found, scratch_path(spark, "threshold"))
    rows = [
        ("argument", sc.resolve_threshold(spark, 0.7, artifact=path)), ("config", sc.resolve_threshold(spark, source="config", configured=0.5)),
        ("artifact", sc.resolve_threshold(spark, artifact=path)),
    ]
    return spark.createDataFrame(rows, "source string, threshold double")


@query("c03_request_scoring", f"""WITH {m.APPLICATION_SQL} SELECT SK_ID_CURR, {r(PROBABILITY_SQL.replace('CNT_FAM_MEMBERS', '0'), 6)} AS "TARGET_PROBABILITY", 'credit-risk' AS model_name, 'champion' AS model_alias,
 CAST({PROBABILITY_SQL.replace('CNT_FAM_MEMBERS', '0')} >= 0.3 AS BIGINT) AS "TARGET_PREDICTION" FROM application""")
def request(spark, folder):
    """Request rows with text numbers, an unknown column and a missing feature."""
    rows = m.application(spark, folder).select(KEY, F.col("EXT_SOURCE_2").cast("string").alias("EXT_SOURCE_2"), F.col("AMT_CREDIT").cast("long").alias("AMT_CREDIT"), "NAME_SEGMENT")
    signature = {KEY: "long", "EXT_SOURCE_2": "double", "AMT_CREDIT": "double", "CNT_FAM_MEMBERS": "double"}
    scored, _ = sc.score_request(rows, sc.Scorer(WEIGHTS), signature, "credit-risk", "champion", 0.3, most_rows=None)
    return rounded_table(scored, 6)


@query("c03_request_diagnostics", """SELECT 'recognized' AS kind, CAST(count(*) AS BIGINT) AS n FROM (DESCRIBE customer) WHERE column_name IN ('c_custkey', 'c_acctbal') UNION ALL
 SELECT 'ignored', count(*) FROM (DESCRIBE customer) WHERE column_name NOT IN ('c_custkey', 'c_acctbal') UNION ALL SELECT 'filled', 1 FROM (DESCRIBE customer) WHERE column_name = 'c_custkey'""")
def request_diagnostics(spark, folder):
    weights = sc.LinearWeights({"c_acctbal": 0.001, "c_age": 0.1})
    signature = {"c_custkey": "long", "c_acctbal": "double", "c_age": "double"}
    _, seen = sc.score_request(table(spark, folder, "customer"), sc.Scorer(weights, key="c_custkey"), signature, "m", "a", most_rows=None)
    rows = [("recognized", len(seen.recognized_columns)), ("ignored", len(seen.ignored_columns)), ("filled", seen.filled_missing_count)]
    return spark.createDataFrame(rows, "kind string, n long")


_BALANCE = sc.LinearWeights({"c_acctbal": -0.0005, "c_nationkey": 0.02}, 0.25)
_BALANCE_SQL = "1 / (1 + exp(-(CAST(0.25 AS DOUBLE) + CAST(-0.0005 AS DOUBLE) * c_acctbal + CAST(0.02 AS DOUBLE) * c_nationkey)))"


@query("c04_stream_scoring", f"SELECT c_custkey, {r(_BALANCE_SQL, 6)} AS \"TARGET_PROBABILITY\", CAST({_BALANCE_SQL} >= 0.5 AS BIGINT) AS \"TARGET_PREDICTION\" FROM customer")
def stream(spark, folder):
    """The customer file read as a stream, scored in micro-batches and written exactly once."""
    schema = table(spark, folder, "customer").schema
    rows = open_stream(spark, folder, schema, "parquet", files="customer.parquet")
    out = scratch_path(spark, "stream")
    write_stream(score_stream(rows, sc.Scorer(_BALANCE, key="c_custkey")), f"{out}/rows", f"{out}/state").awaitTermination()
    return rounded_table(spark.read.parquet(f"{out}/rows"), 6)


@query("c05_composed_scorer", f"""WITH {m.APPLICATION_SQL}, {m.SPLIT_SQL}, {_FITTED} SELECT SK_ID_CURR, {r(_SCALED_P, 6)} AS "TARGET_PROBABILITY" FROM application CROSS JOIN f""")
def composed(spark, folder):
    """Preprocessing and model saved together, loaded and applied; the target is dropped, other columns are ignored."""
    path = scratch_path(spark, "scorer")
    scaled_scorer(spark, folder).save(spark, path)
    return rounded_table(sc.Scorer.load(spark, path).predict(m.application(spark, folder)), 6)


_PARTS = {c: w for c, w in WEIGHTS.weights.items()}
_CONTRIBUTIONS = f"""WITH {m.APPLICATION_SQL}, c AS (""" + " UNION ALL ".join(
    f"SELECT SK_ID_CURR, '{c}' AS feature, {c} AS value, CAST({w} AS DOUBLE) * ({c} - avg({c}) OVER ()) AS contribution FROM application" for c, w in _PARTS.items()) + ")"


@query("x01_contributions", _CONTRIBUTIONS + f" SELECT SK_ID_CURR, feature, {r('value')} AS value, {r('contribution', 6)} AS contribution FROM c")
def contributions(spark, folder):
    found = ex.linear_contributions(m.application(spark, folder), WEIGHTS, KEY)
    return found.select(KEY, "feature", rounded("value").alias("value"), rounded("contribution", 6).alias("contribution"))


@query("x02_contribution_summary", _CONTRIBUTIONS + f""", s AS (SELECT feature, avg(abs(contribution)) AS a, avg(contribution) AS b, stddev_pop(contribution) AS d FROM c GROUP BY 1)
 SELECT feature, {r('a', 6)} AS mean_abs_shap, {r('b', 6)} AS mean_shap, {r('d', 6)} AS std_shap, CASE feature WHEN 'EXT_SOURCE_2' THEN CAST(2 AS DOUBLE) WHEN 'AMT_CREDIT' THEN 0.00005 ELSE 0.1 END AS native_importance,
 row_number() OVER (ORDER BY a DESC, feature) AS rank FROM s""")
def summary(spark, folder):
    native = spark.createDataFrame([(c, abs(w)) for c, w in WEIGHTS.weights.items()], "feature string, importance double")
    found = ex.contribution_summary(ex.linear_contributions(m.application(spark, folder), WEIGHTS, KEY), native)
    return found.select("feature", *[rounded(c, 6).alias(c) for c in ("mean_abs_shap", "mean_shap", "std_shap")], "native_importance", F.col("rank").cast("long").alias("rank"))


_TREE_INPUTS = ["EXT_SOURCE_2", "AMT_CREDIT", "CNT_FAM_MEMBERS"]
_TREES = [
    tx.Tree([0, -1, 1, -1, -1], [0.4, 0, 20_000.0, 0, 0], [1, -1, 3, -1, -1], [2, -1, 4, -1, -1], [0, 0.4, 0, -0.2, 0.9], []),
    tx.Tree([1, 0, -1, -1, 1, -1, 2, -1, -1], [15_000.0, 0.6, 0, 0, 30_000.0, 0, 2.5, 0, 0], [1, 2, -1, -1, 5, -1, 7, -1, -1],
            [4, 3, -1, -1, 6, -1, 8, -1, -1], [0, 0, -0.5, 0.3, 0, 0.1, 0, 0.7, -0.6], []),
]


def _subset_value(tree: tx.Tree, number: int, known: frozenset, node: int = 0) -> str:
    """The expected output of a tree where only some features are known, by its definition."""
    f = tree.feature[node]
    if f < 0:
        return f"CAST({tree.value[node]} AS DOUBLE)"
    low, high = (_subset_value(tree, number, known, child[node]) for child in (tree.left, tree.right))
    if f in known:
        return f"CASE WHEN {_TREE_INPUTS[f]} <= {tree.threshold[node]} THEN {low} ELSE {high} END"
    return f"CASE WHEN n{number}_{node} = 0 THEN ({low} + {high}) / 2 ELSE (n{number}_{tree.left[node]} * {low} + n{number}_{tree.right[node]} * {high}) / n{number}_{node} END"


def _cover_sql(tree: tx.Tree, number: int, node: int = 0, inside: str = "TRUE") -> list[str]:
    out = [f"CAST(count(*) FILTER (WHERE {inside}) AS DOUBLE) AS n{number}_{node}"]
    if tree.feature[node] >= 0:
        low = f"coalesce({_TREE_INPUTS[tree.feature[node]]} <= {tree.threshold[node]}, FALSE)"
        out += _cover_sql(tree, number, tree.left[node], f"{inside} AND {low}") + _cover_sql(tree, number, tree.right[node], f"{inside} AND NOT {low}")
    return out


def _shapley_sql(f: int) -> str:
    """The average gain by a feature over all orders in which the features become known."""
    others, n = [i for i in range(len(_TREE_INPUTS)) if i != f], len(_TREE_INPUTS)
    value = lambda known: " + ".join(_subset_value(t, k, frozenset(known)) for k, t in enumerate(_TREES))
    terms = [f"CAST({factorial(k)} * {factorial(n - k - 1)} AS DOUBLE) / {factorial(n)} * (({value((*s, f))}) - ({value(s)}))" for k in range(n) for s in combinations(others, k)]
    return f"SELECT SK_ID_CURR, '{_TREE_INPUTS[f]}' AS feature, CAST({_TREE_INPUTS[f]} AS DOUBLE) AS value, {' + '.join(terms)} AS contribution FROM application CROSS JOIN covers"


_TREE_CONTRIBUTIONS = f"WITH {m.APPLICATION_SQL}, covers AS (SELECT {', '.join(x for k, t in enumerate(_TREES) for x in _cover_sql(t, k))} FROM application), c AS ({' UNION ALL '.join(map(_shapley_sql, range(3)))})"


def counted_trees(spark, folder) -> tx.TreeEnsemble:
    """Two fixed trees over three features of the customers, one of them twice on a path."""
    return tx.with_covers(m.application(spark, folder), tx.TreeEnsemble(_TREE_INPUTS, _TREES))


@query("x01_tree_values", _TREE_CONTRIBUTIONS + f" SELECT SK_ID_CURR, feature, {r('value')} AS value, {r('contribution', 6)} AS contribution FROM c")
def tree_values(spark, folder):
    """Attributions of two trees, checked against the sum over all subsets of features."""
    found = tx.tree_contributions(m.application(spark, folder), counted_trees(spark, folder), KEY)
    return found.select(KEY, "feature", rounded("value").alias("value"), rounded("contribution", 6).alias("contribution"))


@query("x02_tree_summary", _TREE_CONTRIBUTIONS + f""", s AS (SELECT feature, avg(abs(contribution)) AS a, avg(contribution) AS b, stddev_pop(contribution) AS d FROM c GROUP BY 1)
 SELECT feature, {r('a', 6)} AS mean_abs_shap, {r('b', 6)} AS mean_shap, {r('d', 6)} AS std_shap, row_number() OVER (ORDER BY a DESC, feature) AS rank FROM s""")
def tree_summary(spark, folder):
    found = ex.contribution_summary(tx.tree_contributions(m.application(spark, folder), counted_trees(spark, folder), KEY))
    return found.select("feature", *[rounded(c, 6).alias(c) for c in ("mean_abs_shap", "mean_shap", "std_shap")], F.col("rank").cast("long").alias("rank"))


@query("x01_tree_contributions", f"WITH {m.APPLICATION_SQL} SELECT SK_ID_CURR, CAST(1 AS BIGINT) AS adds_up, CAST(1 AS BIGINT) AS all_features FROM application")
def boosted_contributions(spark, folder):
    """A boosted model on all features of the customers: attributions and base add up to the margin that Spark computes."""
    df = training_table(spark, folder)
    features = _features(df)
    model = tr.fit_model("gbt", PARAMS, df, features, SMALL)
    trees = tx.from_spark(model, features)
    told = tx.tree_contributions(df, trees, KEY).groupBy(KEY).agg(F.sum("contribution").alias("told"), F.count(F.lit(1)).alias("n"))
    scored = model.transform(tr.assemble(df, features)).select(KEY, (F.log(tr.positive_probability() / (1 - tr.positive_probability())) / 2).alias("margin"))
    near = lambda a, b: (F.abs(a - b) < 1e-9).cast("long")
    return told.join(scored, KEY).select(KEY, near(F.col("told") + trees.base, F.col("margin")).alias("adds_up"), (F.col("n") == len(features)).cast("long").alias("all_features"))


@query("w02_report_rank", _CONTRIBUTIONS + " SELECT feature, row_number() OVER (ORDER BY avg(abs(contribution)) DESC, feature) AS rank FROM c GROUP BY 1")
def report_rank(spark, folder):
    found = ex.contribution_summary(ex.linear_contributions(m.application(spark, folder), WEIGHTS, KEY))
    return found.select("feature", F.col("rank").cast("long").alias("rank"))


@query("x03_explain_sample", _DRAWN + taken("(SELECT least(500, count(*)) FROM drawn)") + " SELECT SK_ID_CURR, CAST(TARGET AS BIGINT) AS \"TARGET\" FROM drawn JOIN sizes USING (TARGET) WHERE place <= take")
def explain_sample(spark, folder):
    return rounded_table(tr.stratified_sample(m.application(spark, folder).select(KEY, LABEL), LABEL, KEY, rows=500, seed=SEED))


@query("x04_plot_scale", f"""WITH q AS (SELECT quantile_cont(l_extendedprice, 0.01) AS a, quantile_cont(l_extendedprice, 0.99) AS b FROM lineitem), s AS (SELECT l_orderkey, (l_extendedprice - a) / (b - a) AS v FROM lineitem CROSS JOIN q)
 SELECT l_orderkey, {r('sum(CASE WHEN v < 0 THEN 0 WHEN v > 1 THEN 1 ELSE v END)', 6)} AS price, CAST(0 AS DOUBLE) AS flat FROM s GROUP BY 1""")
def plot_scale(spark, folder):
    df = table(spark, folder, "lineitem").select("l_orderkey", "l_extendedprice", F.lit(7.0).alias("flat"))
    scaled = ex.plot_scale(df, ["l_extendedprice", "flat"])
    return scaled.groupBy("l_orderkey").agg(rounded(F.sum("l_extendedprice"), 6).alias("price"), F.max("flat").alias("flat"))
