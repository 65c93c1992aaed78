"""Ranking, threshold, lift and confusion tables of scored rows, all exact.

Scored rows are first counted per distinct score. Everything after works on
these counts, so a score shared by very many rows costs one row.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import as_column, strictly_above
from riskloom.functions.structs import numeric_fields
from riskloom.operators.ranking import running_totals
from riskloom.session import settle

SCOPES = ("out_of_fold", "search_subsample_cv", "final_train_fit")
METRICS = ("roc_auc", "average_precision", "f1")


def threshold_grid(low: float = 0.01, high: float = 0.99, step: float = 0.01) -> list[float]:
    """Evenly spaced cuts, both ends included, rounded to 10 digits."""
    count = int(round((high - low) / step)) + 1
    if count == 1:
        return [round(low, 10)]
    return [round(low + i * (high - low) / (count - 1), 10) for i in range(count)]


def score_counts(scored: DataFrame, label: str, score: str) -> DataFrame:
    """(score, pos, n): positives and rows per distinct score."""
    return scored.groupBy(as_column(score).cast("double").alias("score")).agg(
        F.sum(as_column(label).cast("long")).alias("pos"), F.count(F.lit(1)).alias("n")
    )


@dataclass(frozen=True)
class Counted:
    """Written counts per score; every function of this module takes it in place of the scored rows."""

    table: DataFrame

    @property
    def sparkSession(self):
        return self.table.sparkSession


def count_once(scored: DataFrame, label: str, score: str) -> Counted:
    return Counted(settle(score_counts(scored, label, score), "scores"))


def stored_counts(scored: DataFrame | Counted, label: str, score: str) -> DataFrame:
    """Counts per score as a written table, since several jobs read them."""
    return scored.table if isinstance(scored, Counted) else count_once(scored, label, score).table


def cumulative_counts(stored: DataFrame) -> DataFrame:
    """(score, pos, n, tp, seen): running positives and rows by descending score."""
    return running_totals(stored, "score", {"tp": "pos", "seen": "n"})


def class_totals(stored: DataFrame) -> tuple[int, int]:
    """(positives, rows)."""
    row = stored.agg(F.sum("pos").alias("p"), F.sum("n").alias("n")).first()
    return int(row["p"] or 0), int(row["n"] or 0)


def roc_points(scored: DataFrame, label: str, score: str) -> DataFrame:
    """(score, tp, fp, tpr, fpr) for every distinct score."""
    stored = stored_counts(scored, label, score)
    p, rows = class_totals(stored)
    fp, positives, negatives = F.col("seen") - F.col("tp"), F.lit(float(p)), F.lit(float(rows - p))
    return cumulative_counts(stored).select(
        "score", "tp", fp.alias("fp"), F.try_divide(F.col("tp"), positives).alias("tpr"), F.try_divide(fp, negatives).alias("fpr")
    )


def ranking_metrics(scored: DataFrame, label: str, score: str) -> DataFrame:
    """One row: roc_auc (ties half), average_precision (step sum), brier_score, rows, positives."""
    steps = cumulative_counts(stored_counts(scored, label, score))
    neg = (F.col("n") - F.col("pos")).cast("double")
    pos = F.col("pos").cast("double")
    precision = F.col("tp") / F.col("seen")
    areas = steps.agg(
        F.sum(neg * (F.col("tp") - pos / 2)).alias("area"), F.sum(pos * precision).alias("steps"),
        F.sum(pos).alias("p"), F.sum(neg).alias("q"),
        F.sum(pos * F.pow(F.col("score") - 1, F.lit(2.0)) + neg * F.pow(F.col("score"), F.lit(2.0))).alias("squares"),
    )
    return areas.select(
        F.try_divide("area", F.col("p") * F.col("q")).alias("roc_auc"),
        F.try_divide("steps", F.col("p")).alias("average_precision"),
        F.try_divide("squares", F.col("p") + F.col("q")).alias("brier_score"),
        (F.col("p") + F.col("q")).cast("long").alias("rows"), F.col("p").cast("long").alias("positives"),
    )


def _over_zero(top: Column, bottom: Column) -> Column:
    """top / bottom with 0 / 0 counted as 0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def decision_columns(tp: Column, fp: Column, fn: Column, tn: Column) -> list[Column]:
    precision, recall = _over_zero(tp, tp + fp), _over_zero(tp, tp + fn)
    return [
        precision.alias("precision"), recall.alias("recall"), _over_zero(2 * tp, 2 * tp + fp + fn).alias("f1"),
        _over_zero(tp + tn, tp + fp + fn + tn).alias("accuracy"),
    ]


def threshold_counts(scored: DataFrame, label: str, score: str, grid: Sequence[float]) -> DataFrame:
    """(threshold, tp, seen, p, total): rows and positives above each cut, and in all.

    Each score falls once into the interval between two cuts; at most
    ``len(grid) + 1`` rows are left for the cumulative sums.
    """
    grid = sorted(grid)
    # intervals are closed on the left, so binning the negated score puts a score equal to a cut below it
    edges = [-float("inf"), *[-t for t in reversed(grid)], float("inf")]
    counts = scored.table if isinstance(scored, Counted) else score_counts(scored, label, score)
    counted = counts.withColumn("__neg", -F.col("score"))
    binned = Bucketizer(splits=edges, inputCol="__neg", outputCol="__bin", handleInvalid="error").transform(counted)
    per_bin = binned.groupBy(F.col("__bin").cast("int").alias("bin")).agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    cuts = F.array(*[F.lit(float(t)) for t in reversed(grid)], F.lit(None).cast("double"))
    one = scored.sparkSession.range(1, numPartitions=1)
    bins = one.select(F.posexplode(cuts).alias("bin", "threshold")).join(F.broadcast(per_bin), "bin", "left")
    # one row per cut from here on
    upto = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def summed(column, window):
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    return bins.select(
        "threshold", summed("pos", upto).alias("tp"), summed("n", upto).alias("seen"),
        summed("pos", everything).alias("p"), summed("n", everything).alias("total"),
    ).where(F.col("threshold").isNotNull())


def threshold_table(scored: DataFrame, label: str, score: str, grid: Sequence[float] | None = None) -> DataFrame:
    """(threshold, precision, recall, f1, accuracy) with the rule ``score > threshold``."""
    tallied = threshold_counts(scored, label, score, grid or threshold_grid())
    tp, fp = F.col("tp"), F.col("seen") - F.col("tp")
    fn = F.col("p") - tp
    tn = F.col("total") - F.col("seen") - fn
    return tallied.select("threshold", *decision_columns(tp, fp, fn, tn))


def best_threshold(table: DataFrame, scope: str) -> DataFrame:
    """One row: the cut with the highest f1, then precision, then the lowest cut."""
    source = "oof_max_f1" if scope == "out_of_fold" else f"{scope}_max_f1"
    top = table.orderBy(F.desc("f1"), F.desc("precision"), F.asc("threshold")).limit(1)
    return top.select("threshold", F.lit("f1").alias("objective"), F.lit(source).alias("source"), F.col("f1").alias("score"))


def choose_threshold(table: DataFrame, scope: str, tuned: bool = True, objective: str = "f1", configured: float = 0.5) -> DataFrame:
    if not tuned:
        fixed = [(float(configured), "configured", "config_classification_threshold", None)]
        return table.sparkSession.createDataFrame(fixed, "threshold double, objective string, source string, score double")
    if objective != "f1":
        raise ValueError(f"unknown threshold objective {objective!r}")
    return best_threshold(table, scope)


def confusion_counts(scored: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    if isinstance(scored, Counted):
        both = F.array(*[F.struct(F.lit(y).alias("actual"), n.alias("k")) for y, n in ((0, F.col("n") - F.col("pos")), (1, F.col("pos")))])
        rows = scored.table.select(strictly_above("score", F.lit(float(threshold))).alias("predicted"), F.explode(both).alias("e")).where("e.k > 0")
        return rows.groupBy("e.actual", "predicted").agg(F.sum("e.k").alias("row_count"))
    return scored.groupBy(
        as_column(label).cast("int").alias("actual"), strictly_above(score, F.lit(float(threshold))).alias("predicted")
    ).agg(F.count(F.lit(1)).alias("row_count"))


def confusion_row(scored: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    if isinstance(scored, Counted):
        above = F.col("score") > F.lit(float(threshold))
        total = lambda rows, n: F.coalesce(F.sum(F.when(rows, n)), F.lit(0))
        neg = F.col("n") - F.col("pos")
        return scored.table.agg(
            total(above, F.col("pos")).alias("tp"), total(above, neg).alias("fp"), total(~above, F.col("pos")).alias("fn"), total(~above, neg).alias("tn"))
    hit, pos = as_column(score) > F.lit(float(threshold)), as_column(label) == 1
    return scored.agg(
        F.count_if(hit & pos).alias("tp"), F.count_if(hit & ~pos).alias("fp"),
        F.count_if(~hit & pos).alias("fn"), F.count_if(~hit & ~pos).alias("tn"),
    )


def decision_metrics(scored: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return confusion_row(scored, label, score, threshold).select(*decision_columns(tp, fp, fn, tn))


def classification_report(scored: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    """(class, precision, recall, f1, support): both classes, accuracy, macro and weighted averages."""
    counts = confusion_row(scored, label, score, threshold)
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))

    def line(name, p, r, f, support):
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1"), support.cast("long").alias("support"))

    p1, r1, f1 = _over_zero(tp, tp + fp), _over_zero(tp, tp + fn), _over_zero(2 * tp, 2 * tp + fp + fn)
    p0, r0, f0 = _over_zero(tn, tn + fn), _over_zero(tn, tn + fp), _over_zero(2 * tn, 2 * tn + fp + fn)
    n1, n0 = tp + fn, tn + fp
    accuracy = _over_zero(tp + tn, n1 + n0)

    def weighted(a, b):
        return _over_zero(a * n0 + b * n1, n0 + n1)

    lines = F.array(
        line("0", p0, r0, f0, n0), line("1", p1, r1, f1, n1),
        line("accuracy", accuracy, accuracy, accuracy, n0 + n1),
        line("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n0 + n1),
        line("weighted avg", weighted(p0, p1), weighted(r0, r1), weighted(f0, f1), n0 + n1),
    )
    return counts.select(F.explode(lines).alias("l")).select("l.*")


def lift_table(scored: DataFrame, label: str, score: str, pieces: int = 10) -> DataFrame:
    """Equal-sized groups by descending score, earlier groups taking the extra rows.

    Rows with equal scores are ordered with negatives first, so where a group
    border cuts through a tie the counts follow from the counts per score and no
    row has to be moved or ranked.
    """
    stored = stored_counts(scored, label, score)
    positives, total = class_totals(stored)
    steps = cumulative_counts(stored)
    start = F.col("seen") - F.col("n")
    neg = F.col("n") - F.col("pos")
    runs = F.array(
        F.struct(F.lit(0).alias("y"), start.alias("a"), (start + neg).alias("b")),
        F.struct(F.lit(1).alias("y"), (start + neg).alias("a"), F.col("seen").alias("b")),
    )
    base, extra = divmod(total, pieces)
    wide = extra * (base + 1)

    def group_of(row_index: Column) -> Column:
        early = F.floor(row_index / F.lit(base + 1))
        late = F.lit(extra) + F.floor((row_index - wide) / F.lit(max(base, 1)))
        return F.when(row_index < wide, early).otherwise(late).cast("int")

    def first_row(group: Column) -> Column:
        return group * base + F.least(group, F.lit(extra))

    spread = (
        steps.withColumn("run", F.explode(runs)).where("run.b > run.a")
        .withColumn("g", F.explode(F.sequence(group_of(F.col("run.a")), group_of(F.col("run.b") - 1))))
    )
    held = F.least(F.col("run.b"), first_row(F.col("g") + 1)) - F.greatest(F.col("run.a"), first_row(F.col("g")))
    groups = spread.withColumn("held", held).groupBy((F.col("g") + 1).alias("decile")).agg(
        F.sum("held").cast("long").alias("row_count"),
        F.sum(F.when(F.col("run.y") == 1, F.col("held")).otherwise(0)).cast("long").alias("default_count"),
        F.min("score").alias("min_score"), F.max("score").alias("max_score"),
    )
    upto = Window.orderBy("decile").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # ``pieces`` rows
    running = F.sum("default_count").over(upto)
    return groups.select(
        "decile", "row_count", "default_count", (F.col("default_count") / F.col("row_count")).alias("default_rate"),
        "min_score", "max_score", running.alias("cumulative_default_count"),
        F.try_divide(running, F.lit(float(positives))).alias("cumulative_default_capture"),
    )


def single_metric(scored: DataFrame, label: str, score: str, metric: str, threshold: float = 0.5) -> float:
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; known: {METRICS}")
    if metric == "f1":
        return decision_metrics(scored, label, score, threshold).first()["f1"]
    return ranking_metrics(scored, label, score).first()[metric]


def evaluation_report(scored: DataFrame, label: str, score: str, model: str, scope: str, tuned: bool = True,
                      configured: float = 0.5, grid: Sequence[float] | None = None) -> dict:
    """Nested metrics plus the report tables, for one scope. The scored rows are read and grouped once."""
    if scope not in SCOPES:
        raise ValueError(f"unknown evaluation scope {scope!r}; known: {SCOPES}")
    scored = count_once(scored, label, score)
    table = settle(threshold_table(scored, label, score, grid), "thresholds")
    chosen = choose_threshold(table, scope, tuned=tuned, configured=configured).first().asDict()
    ranking = ranking_metrics(scored, label, score).first().asDict()
    cut = chosen["threshold"]
    return {
        "metrics": {
            "model": model,
            "evaluation_scope": scope,
            "threshold": chosen,
            "ranking": {k: ranking[k] for k in ("roc_auc", "average_precision", "brier_score")},
            "threshold_metrics": decision_metrics(scored, label, score, cut).first().asDict(),
        },
        "threshold_table": table,
        "confusion": confusion_counts(scored, label, score, cut),
        "roc": roc_points(scored, label, score),
        "classes": classification_report(scored, label, score, cut),
        "lift": lift_table(scored, label, score),
    }


def metric_rows(spark, metrics: dict) -> DataFrame:
    """Nested report -> (metric, value) rows of its numeric leaves."""
    text = json.dumps(metrics, default=str)
    one = spark.range(1, numPartitions=1)
    shape = one.select(F.schema_of_json(F.lit(text))).first()[0]
    read = one.select("id", F.from_json(F.lit(text), shape).alias("report")).select("id", "report.*")
    return numeric_fields(read, "id").where("value IS NOT NULL").select("metric", "value").orderBy("metric")
