"""Evaluation queries: V01-V12, W03, W04, T03, P26, P27."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog import mapping as m
from riskloom.catalog.registry import query, r, rounded, rounded_table
from riskloom.functions.columns import at_or_above, strictly_above
from riskloom.operators import metrics as mx

Y, P = "y", "p"
CUT = 0.5

_CURVE = f"""WITH {m.SCORED_SQL}, g AS (SELECT p, CAST(sum(y) AS DOUBLE) AS pos, CAST(count(*) AS DOUBLE) AS n FROM scored GROUP BY p),
 c AS (SELECT *, sum(pos) OVER w AS tp, sum(n - pos) OVER w AS fp FROM g WINDOW w AS (ORDER BY p DESC ROWS UNBOUNDED PRECEDING)),
 t AS (SELECT CAST(sum(y) AS DOUBLE) AS pp, CAST(sum(1 - y) AS DOUBLE) AS nn FROM scored)"""
_AUC = "sum((n - pos) * (tp - pos / 2)) / max(pp * nn)"
_AP = "sum(pos / pp * tp / (tp + fp))"


def _ranking(key, expression, column):
    @query(key, _CURVE + f" SELECT {r(expression, 6)} AS {column} FROM c CROSS JOIN t")
    def run(spark, folder):
        return mx.ranking_metrics(m.scored_documents(spark, folder), Y, P).select(rounded(column, 6).alias(column))

    return run


_ranking("v01_roc_auc", _AUC, "roc_auc")
_ranking("v02_average_precision", _AP, "average_precision")


@query("v03_brier_score", f"WITH {m.SCORED_SQL} SELECT {r('avg(pow(p - y, 2))', 6)} AS brier_score FROM scored")
def brier(spark, folder):
    return mx.ranking_metrics(m.scored_documents(spark, folder), Y, P).select(rounded("brier_score", 6).alias("brier_score"))


_GRID = "grid AS (SELECT CAST(i AS DOUBLE) / 100 AS threshold FROM range(1, 100) t(i))"


@query("v04_threshold_grid", f"WITH {m.SCORED_SQL}, {_GRID} SELECT threshold, count(p) AS above FROM grid LEFT JOIN scored ON p > threshold GROUP BY 1")
def grid(spark, folder):
    """The 99 cuts with the number of scores above each."""
    scored = m.scored_documents(spark, folder)
    tallied = mx.threshold_counts(scored, Y, P, mx.threshold_grid())
    return tallied.select("threshold", F.col("seen").alias("above"))


_TABLE = f"""WITH {m.SCORED_SQL}, {_GRID}, c AS (SELECT threshold, count(*) FILTER (WHERE p > threshold AND y = 1) AS tp, count(*) FILTER (WHERE p > threshold AND y = 0) AS fp,
 count(*) FILTER (WHERE p <= threshold AND y = 1) AS fn, count(*) FILTER (WHERE p <= threshold AND y = 0) AS tn FROM grid CROSS JOIN scored GROUP BY 1),
 s AS (SELECT threshold, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall,
 CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1, (tp + tn) / (tp + fp + fn + tn) AS accuracy FROM c)"""
_FOUR = ("precision", "recall", "f1", "accuracy")


@query("v05_threshold_table", _TABLE + f" SELECT threshold, {', '.join(f'{r(c, 6)} AS {c}' for c in _FOUR)} FROM s")
def thresholds(spark, folder):
    table = mx.threshold_table(m.scored_documents(spark, folder), Y, P)
    return table.select("threshold", *[rounded(c, 6).alias(c) for c in _FOUR])


_BEST = " SELECT threshold, 'f1' AS objective, 'oof_max_f1' AS source, " + r("f1", 6) + " AS score FROM s ORDER BY f1 DESC, precision DESC, threshold LIMIT 1"


@query("t03_best_threshold", _TABLE + _BEST)
def best(spark, folder):
    table = mx.threshold_table(m.scored_documents(spark, folder), Y, P)
    return mx.best_threshold(table, "out_of_fold").withColumn("score", rounded("score", 6))


@query("v06_choose_threshold", _TABLE + """, b AS (SELECT * FROM s ORDER BY f1 DESC, precision DESC, threshold LIMIT 1)
 SELECT threshold, 'f1' AS objective, 'search_subsample_cv_max_f1' AS source FROM b UNION ALL SELECT CAST(0.5 AS DOUBLE), 'configured', 'config_classification_threshold' FROM b""")
def choose(spark, folder):
    table = mx.threshold_table(m.scored_documents(spark, folder), Y, P)
    tuned, fixed = mx.choose_threshold(table, "search_subsample_cv"), mx.choose_threshold(table, "search_subsample_cv", tuned=False)
    return tuned.unionByName(fixed).drop("score")


@query("v07_single_metric", _CURVE + f""", k AS (SELECT count(*) FILTER (WHERE p > {CUT} AND y = 1) AS tp, count(*) FILTER (WHERE p > {CUT} AND y = 0) AS fp,
 count(*) FILTER (WHERE p <= {CUT} AND y = 1) AS fn FROM scored)
 SELECT 'roc_auc' AS metric, {r(_AUC, 6)} AS value FROM c CROSS JOIN t UNION ALL SELECT 'average_precision', {r(_AP, 6)} FROM c CROSS JOIN t
 UNION ALL SELECT 'f1', {r('2 * tp / (2 * tp + fp + fn)', 6)} FROM k""")
def single(spark, folder):
    scored = m.scored_documents(spark, folder)
    rows = [(name, mx.single_metric(scored, Y, P, name, CUT)) for name in mx.METRICS]
    return spark.createDataFrame(rows, "metric string, value double").withColumn("value", rounded("value", 6))


@query("v08_confusion", f"WITH {m.SCORED_SQL} SELECT CAST(y AS BIGINT) AS actual, CAST(p > {CUT} AS BIGINT) AS predicted, count(*) AS row_count FROM scored GROUP BY 1, 2")
def confusion(spark, folder):
    return rounded_table(mx.confusion_counts(m.scored_documents(spark, folder), Y, P, CUT))


@query("v09_roc_points", _CURVE + f" SELECT {r('p', 6)} AS score, {r('fp / nn', 6)} AS fpr, {r('tp / pp', 6)} AS tpr FROM c CROSS JOIN t")
def roc(spark, folder):
    points = mx.roc_points(m.scored_documents(spark, folder), Y, P)
    return points.select(*[rounded(c, 6).alias(c) for c in ("score", "fpr", "tpr")])


@query("w04_cumulative_curve", _CURVE + f" SELECT {r('p', 6)} AS score, CAST(tp AS BIGINT) AS tp, CAST(tp + fp AS BIGINT) AS seen FROM c")
def curve(spark, folder):
    stored = mx.stored_counts(m.scored_documents(spark, folder), Y, P)
    return mx.cumulative_counts(stored).select(rounded("score", 6).alias("score"), "tp", "seen")


@query("v10_classification_report", f"""WITH {m.SCORED_SQL}, k AS (SELECT CAST(count(*) FILTER (WHERE p > {CUT} AND y = 1) AS DOUBLE) AS tp, CAST(count(*) FILTER (WHERE p > {CUT} AND y = 0) AS DOUBLE) AS fp,
 CAST(count(*) FILTER (WHERE p <= {CUT} AND y = 1) AS DOUBLE) AS fn, CAST(count(*) FILTER (WHERE p <= {CUT} AND y = 0) AS DOUBLE) AS tn FROM scored),
 e AS (SELECT *, tp / (tp + fp) AS p1, tp / (tp + fn) AS r1, 2 * tp / (2 * tp + fp + fn) AS f1, tn / (tn + fn) AS p0, tn / (tn + fp) AS r0, 2 * tn / (2 * tn + fp + fn) AS f0,
  tp + fn AS n1, tn + fp AS n0, (tp + tn) / (tp + fp + fn + tn) AS acc FROM k),
 l AS (SELECT '0' AS class, p0 AS a, r0 AS b, f0 AS c, n0 AS n FROM e UNION ALL SELECT '1', p1, r1, f1, n1 FROM e UNION ALL SELECT 'accuracy', acc, acc, acc, n0 + n1 FROM e
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n0 + n1 FROM e
  UNION ALL SELECT 'weighted avg', (p0 * n0 + p1 * n1) / (n0 + n1), (r0 * n0 + r1 * n1) / (n0 + n1), (f0 * n0 + f1 * n1) / (n0 + n1), n0 + n1 FROM e)
 SELECT class, {r('a', 6)} AS precision, {r('b', 6)} AS recall, {r('c', 6)} AS f1, CAST(n AS BIGINT) AS support FROM l""")
def classes(spark, folder):
    return rounded_table(mx.classification_report(m.scored_documents(spark, folder), Y, P, CUT), 6)


_METRIC_ROWS = _TABLE + f""", g AS (SELECT p, CAST(sum(y) AS DOUBLE) AS pos, CAST(count(*) AS DOUBLE) AS n FROM scored GROUP BY p),
 cc AS (SELECT *, sum(pos) OVER w AS tp, sum(n - pos) OVER w AS fp FROM g WINDOW w AS (ORDER BY p DESC ROWS UNBOUNDED PRECEDING)),
 t AS (SELECT CAST(sum(y) AS DOUBLE) AS pp, CAST(sum(1 - y) AS DOUBLE) AS nn FROM scored),
 b AS (SELECT * FROM s ORDER BY f1 DESC, precision DESC, threshold LIMIT 1)
 SELECT 'ranking.roc_auc' AS metric, {r(_AUC, 6)} AS value FROM cc CROSS JOIN t UNION ALL SELECT 'ranking.average_precision', {r(_AP, 6)} FROM cc CROSS JOIN t
 UNION ALL SELECT 'ranking.brier_score', {r('avg(pow(p - y, 2))', 6)} FROM scored UNION ALL SELECT 'threshold.threshold', {r('threshold', 6)} FROM b UNION ALL SELECT 'threshold.score', {r('f1', 6)} FROM b
 """ + " ".join(f"UNION ALL SELECT 'threshold_metrics.{c}', {r(c, 6)} FROM b" for c in _FOUR)


@query("v11_evaluation_report", _METRIC_ROWS)
def report(spark, folder):
    found = mx.evaluation_report(m.scored_documents(spark, folder), Y, P, "documents", "out_of_fold")
    return mx.metric_rows(spark, found["metrics"]).withColumn("value", rounded("value", 6))


@query("v12_metric_rows", f"""WITH {m.SCORED_SQL} SELECT 'counts.rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM scored UNION ALL SELECT 'counts.positives', CAST(sum(y) AS DOUBLE) FROM scored
 UNION ALL SELECT 'scores.highest', {r('max(p)', 6)} FROM scored""")
def metric_rows(spark, folder):
    """Text and flags of a nested report are skipped, its numbers become rows."""
    row = m.scored_documents(spark, folder).agg(F.count(F.lit(1)).alias("n"), F.sum(Y).alias("s"), F.max(P).alias("h")).first()
    nested = {"name": "documents", "complete": True, "counts": {"rows": row["n"], "positives": row["s"]}, "scores": {"highest": row["h"]}}
    rows = mx.metric_rows(spark, nested)
    return rows.withColumn("value", F.when(F.col("metric") == "scores.highest", rounded("value", 6)).otherwise(F.col("value")))


@query("w03_lift_deciles", f"""WITH {m.SCORED_SQL}, d AS (SELECT *, ntile(10) OVER (ORDER BY p DESC, y) AS decile FROM scored),
 g AS (SELECT decile, count(*) AS row_count, CAST(sum(y) AS BIGINT) AS default_count, min(p) AS lo, max(p) AS hi FROM d GROUP BY 1)
 SELECT CAST(decile AS BIGINT) AS decile, row_count, default_count, {r('default_count / row_count', 6)} AS default_rate, {r('lo', 6)} AS min_score, {r('hi', 6)} AS max_score,
 CAST(sum(default_count) OVER (ORDER BY decile) AS BIGINT) AS cumulative_default_count, {r('sum(default_count) OVER (ORDER BY decile) / sum(default_count) OVER ()', 6)} AS cumulative_default_capture FROM g""")
def lift(spark, folder):
    return rounded_table(mx.lift_table(m.scored_documents(spark, folder), Y, P), 6)


_ON_CUT = "CASE WHEN doc_id % 4 = 0 THEN CAST(0.5 AS DOUBLE) ELSE p END"


def _some_on_cut(spark, folder):
    return m.scored_documents(spark, folder).withColumn("p", F.when(F.col("doc_id") % 4 == 0, F.lit(0.5)).otherwise(F.col("p")))


@query("p26_strict_decision", f"WITH {m.SCORED_SQL} SELECT doc_id, CAST({_ON_CUT} > 0.5 AS BIGINT) AS decision FROM scored")
def strict(spark, folder):
    return _some_on_cut(spark, folder).select("doc_id", strictly_above("p", F.lit(CUT)).cast("long").alias("decision"))


@query("p27_inclusive_decision", f"WITH {m.SCORED_SQL} SELECT doc_id, CAST({_ON_CUT} >= 0.5 AS BIGINT) AS decision FROM scored")
def inclusive(spark, folder):
    return _some_on_cut(spark, folder).select("doc_id", at_or_above("p", F.lit(CUT)).cast("long").alias("decision"))
