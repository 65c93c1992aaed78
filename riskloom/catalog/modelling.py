"""Split, scaling, balance, selection and training queries: M01-M16, M18-M24."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import functions as F

from riskloom.catalog import mapping as m
from riskloom.catalog.registry import query, r, rounded_table, table
from riskloom.functions.names import tidy_columns
from riskloom.operators import balance as bal
from riskloom.operators import target_stats as ts
from riskloom.operators import training as tr
from riskloom.operators.impute import fit_imputation
from riskloom.operators.neighbors import nearest
from riskloom.operators.ranking import class_counts
from riskloom.operators.scale import fit_scaling
from riskloom.plans import application as ap
from riskloom.plans import training as job
from riskloom.session import settle, spread

KEY, LABEL = "SK_ID_CURR", "TARGET"
SEED = 42
_DRAWN = f"""WITH {m.APPLICATION_SQL}, drawn AS (SELECT SK_ID_CURR, TARGET, row_number() OVER (PARTITION BY TARGET ORDER BY md5('{SEED}|' || CAST(SK_ID_CURR AS VARCHAR)), SK_ID_CURR) AS place,
 count(*) OVER (PARTITION BY TARGET) AS n FROM application)"""


def taken(total: str) -> str:
    """How many rows of each class make up ``total`` rows: shares rounded down, the largest remainders up."""
    return f""", classes AS (SELECT TARGET, count(*) AS k FROM drawn GROUP BY 1), shares AS (SELECT TARGET, k, {total} AS wanted, {total} * k / (SELECT sum(k) FROM classes) AS exact FROM classes),
 sizes AS (SELECT TARGET, floor(exact + 1e-9) + CASE WHEN row_number() OVER (ORDER BY floor(exact + 1e-9) - exact, -k, TARGET) <= wanted - sum(floor(exact + 1e-9)) OVER () THEN 1 ELSE 0 END AS take FROM shares) """


def share_of_rows(rate: float) -> str:
    return f"(SELECT ceil(CAST({rate} AS DOUBLE) * count(*) - 1e-9) FROM drawn)"


def _people(spark, folder):
    return m.application(spark, folder).select(KEY, LABEL)


@query("m01_stratified_sample", _DRAWN + taken(share_of_rows(0.15)) + " SELECT SK_ID_CURR, CAST(TARGET AS BIGINT) AS \"TARGET\" FROM drawn JOIN sizes USING (TARGET) WHERE place <= take")
def sample(spark, folder):
    return rounded_table(tr.stratified_sample(_people(spark, folder), LABEL, KEY, rate=0.15, seed=SEED))


@query("m02_holdout", _DRAWN + taken(share_of_rows(0.1)) + " SELECT SK_ID_CURR, CAST(TARGET AS BIGINT) AS \"TARGET\", CAST(place <= take AS BIGINT) AS held_out FROM drawn JOIN sizes USING (TARGET)")
def holdout(spark, folder):
    marked = tr.mark_holdout(_people(spark, folder), LABEL, KEY, 0.1, SEED, "held_out")
    return rounded_table(marked.withColumn("held_out", F.col("held_out").cast("int")))


@query("m03_folds", _DRAWN + " SELECT SK_ID_CURR, CAST(TARGET AS BIGINT) AS \"TARGET\", (place - 1) % 5 AS fold FROM drawn")
def folds(spark, folder):
    return rounded_table(tr.assign_folds(_people(spark, folder), LABEL, KEY, 5, SEED))


_PARTS = "parts AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, p_retailprice, CAST(3 AS DOUBLE) AS flat FROM part)"
_SCALED = ("p_size", "p_retailprice", "flat")


def _scaler(key, kind, expression):
    sql = f"WITH {_PARTS}, f AS (SELECT " + ", ".join(expression(c) for c in _SCALED) + " FROM parts) SELECT p_partkey, " + ", ".join(
        f"{r(f'({c} - {c}_c) / CASE WHEN {c}_w = 0 THEN 1 ELSE {c}_w END', 6)} AS {c}" for c in _SCALED) + " FROM parts CROSS JOIN f"

    @query(key, sql)
    def run(spark, folder):
        df = table(spark, folder, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice", F.lit(3.0).alias("flat"))
        return rounded_table(fit_scaling(df, _SCALED, kind).apply(df), 6)

    return run


_scaler("m04_standard_scaler", "standard", lambda c: f"avg({c}) AS {c}_c, stddev_pop({c}) AS {c}_w")
_scaler("m05_robust_scaler", "robust", lambda c: f"quantile_cont({c}, 0.5) AS {c}_c, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS {c}_w")
_scaler("m06_minmax_scaler", "minmax", lambda c: f"min({c}) AS {c}_c, max({c}) - min({c}) AS {c}_w")

_CHAIN = ("AMT_CREDIT", "DAYS_BIRTH", "EXT_SOURCE_2")


@query("m07_fit_transform_chain", _DRAWN + f""", a AS (SELECT application.*, (place - 1) % 5 AS fold FROM application JOIN drawn USING (SK_ID_CURR)),
 f AS (SELECT k.fold, """ + ", ".join(f"median({c}) AS {c}_c, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS {c}_w" for c in _CHAIN) + """
  FROM a JOIN (SELECT DISTINCT fold FROM a) k ON a.fold <> k.fold GROUP BY 1)
 SELECT SK_ID_CURR, fold, """ + ", ".join(f"{r(f'({c} - {c}_c) / {c}_w', 6)} AS {c}" for c in _CHAIN) + " FROM a JOIN f USING (fold)")
def chain(spark, folder):
    """For each fold: fitted on the other four, applied to it."""
    df = tr.assign_folds(m.application(spark, folder).select(KEY, LABEL, *_CHAIN), LABEL, KEY, 5, SEED)
    df = settle(df, "folds")

    def one(fold: int):
        prep = tr.fit_preprocessing(df.where(F.col("fold") != fold), _CHAIN, tr.TrainingOptions(selection=None))
        return prep.apply(df.where(F.col("fold") == fold).select(KEY, "fold", *_CHAIN))

    return rounded_table(reduce(lambda a, b: a.unionByName(b), map(one, range(5))), 6)


@query("m09_feature_pruning", f"""WITH i AS (SELECT p_brand AS feature, sum(p_retailprice) AS importance FROM part GROUP BY 1), k AS (SELECT feature, row_number() OVER (ORDER BY importance DESC, feature) AS place FROM i WHERE importance >= 5000),
 c AS (SELECT 'Brand#1' AS feature, 0 AS place UNION ALL SELECT feature, place FROM k WHERE place <= 6 AND feature <> 'Brand#1')
 SELECT feature, row_number() OVER (ORDER BY place) AS place FROM c""")
def pruning(spark, folder):
    """Reserved features first, then the most important ones above a minimum."""
    importance = table(spark, folder, "part").groupBy(F.col("p_brand").alias("feature")).agg(F.sum("p_retailprice").alias("importance"))
    return tr.prune_features(importance, minimum=5000.0, keep_top_n=6, always_keep=["Brand#1"])


@query("m10_class_weights", f"WITH {m.APPLICATION_SQL}, c AS (SELECT TARGET, count(*) AS n FROM application GROUP BY 1) SELECT CAST(TARGET AS BIGINT) AS \"TARGET\", n AS \"rows\", {r('(SELECT max(n) FROM c) / n', 6)} AS weight FROM c")
def weights(spark, folder):
    df = _people(spark, folder)
    weighted = df.withColumn("weight", bal.weight_column(LABEL, bal.class_weights(class_counts(df, LABEL))))
    return rounded_table(weighted.groupBy(LABEL).agg(F.count(F.lit(1)).alias("rows"), F.max("weight").alias("weight")), 6)


@query("m11_undersample", _DRAWN + " SELECT SK_ID_CURR, CAST(TARGET AS BIGINT) AS \"TARGET\" FROM drawn WHERE place <= (SELECT min(n) FROM drawn)")
def undersample(spark, folder):
    return rounded_table(bal.undersample(_people(spark, folder), LABEL, KEY, SEED))


# --- neighbours and synthetic rows on the embeddings; label 0 is the rare class ------------------------------------

_VECTORS = "v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, label = 0 AS rare FROM embeddings)"
_NEAR = _VECTORS + """, pairs AS (SELECT a.vec_id AS query, b.vec_id AS neighbor, b.rare AS rare, list_distance(a.e, b.e) AS distance FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE {where}),
 near AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY distance, neighbor) AS rank FROM pairs)"""


def _rare(spark, folder):
    return table(spark, folder, "embeddings").select("vec_id", (F.col("label") == 0).cast("int").alias("y"), "embedding")


def _wide(spark, folder, size=64):
    return _rare(spark, folder).selectExpr("vec_id", "y", *[f"CAST(embedding[{i}] AS DOUBLE) AS e{i}" for i in range(size)])


FEATURES = [f"e{i}" for i in range(64)]


@query("m15_nearest_neighbors", "WITH " + _NEAR.format(where="TRUE") + f" SELECT query, neighbor, rank, {r('distance')} AS distance FROM near WHERE rank <= 5")
def neighbors(spark, folder):
    df = table(spark, folder, "embeddings")
    return rounded_table(nearest(df, df, "vec_id", "embedding", 5, exact=True))


@query("m15_inverted_file", """WITH n AS (SELECT count(*) FILTER (WHERE vec_id % 20 = 0) AS queries FROM embeddings)
 SELECT queries, 5 * queries AS "rows", 5 * queries AS in_order, CAST(1 AS BIGINT) AS recall_reached FROM n""")
def inverted_neighbors(spark, folder):
    """The default search for every 20th vector against all: five rows each, in order, and at least nine in ten of the true neighbours."""
    df = table(spark, folder, "embeddings")
    asked = df.where("vec_id % 20 = 0")
    found = settle(nearest(asked, df, "vec_id", "embedding", 5, few=100), "found")
    true = nearest(asked, df, "vec_id", "embedding", 5, exact=True).select("query", "neighbor", F.col("rank").alias("true_rank"))
    both = found.join(true, ["query", "neighbor"], "left")
    # a found neighbour is never nearer than its true rank says
    facts = both.agg(F.count_distinct("query").alias("queries"), F.count(F.lit(1)).alias("rows"), F.count_if(F.coalesce("true_rank", F.lit(6)) >= F.col("rank")).alias("in_order"),
                     F.count("true_rank").alias("hits"))
    return facts.select("queries", "rows", "in_order", (F.col("hits") >= 0.9 * F.col("rows")).cast("long").alias("recall_reached"))


_BALANCED = "SELECT {a} AS y, CAST(0 AS BIGINT) AS synthetic, count(*) AS \"rows\" FROM embeddings GROUP BY 1 UNION ALL SELECT CAST(1 AS BIGINT), 1, count(*) FILTER (WHERE label <> 0) - count(*) FILTER (WHERE label = 0) FROM embeddings"


def _tally(df):
    return df.groupBy(F.col("y").cast("long").alias("y"), F.col("is_synthetic").cast("long").alias("synthetic")).agg(F.count(F.lit(1)).alias("rows"))


@query("m12_smote", _BALANCED.format(a="CAST(label = 0 AS BIGINT)"))
def smote(spark, folder):
    return _tally(bal.oversample(_wide(spark, folder), "y", "vec_id", FEATURES, "smote", exact=True))


def _on_segments(made, rows, near):
    """(id, draws, on_segment): made rows of each source, and those on the way to one of its nearest rare neighbours."""
    x = F.array(*[F.col(c) for c in FEATURES])
    dot = lambda p, q: F.aggregate(F.zip_with(p, q, lambda i, j: i * j), F.lit(0.0), lambda t, v: t + v)
    minus = lambda p, q: F.zip_with(p, q, lambda i, j: i - j)
    vectors = rows.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))
    ways = (
        near.select(F.col("query").alias("id"), "neighbor").join(vectors, "id").join(vectors.select(F.col("id").alias("neighbor"), F.col("vec").alias("other")), "neighbor")
        .select("id", "vec", minus(F.col("other"), F.col("vec")).alias("way"))
        .groupBy("id").agg(F.first("vec").alias("vec"), F.collect_list("way").alias("ways"))
    )
    placed = made.where("is_synthetic").select(F.col("vec_id").alias("id"), x.alias("x")).join(ways, "id").withColumn("step", minus(F.col("x"), F.col("vec")))

    # the place along a way is a field, as an expression it would be worked out again for each of the numbers of a vector
    fitted = F.transform("ways", lambda way: F.struct(way.alias("way"), (dot(F.col("step"), way) / dot(way, way)).alias("u")))

    def along(fit):
        off = F.zip_with("step", fit["way"], lambda s, w: (s - w * fit["u"]) * (s - w * fit["u"]))
        return (fit["u"] >= -1e-9) & (fit["u"] <= 1 + 1e-9) & (F.aggregate(off, F.lit(0.0), lambda t, v: t + v) < 1e-12)

    return placed.groupBy("id").agg(F.count(F.lit(1)).alias("draws"), F.count_if(F.exists(fitted, along)).alias("on_segment"))


@query("m12_smote_segments", f"""WITH {_VECTORS}, n AS (SELECT count(*) FILTER (WHERE NOT rare) - count(*) FILTER (WHERE rare) AS needed, count(*) FILTER (WHERE rare) AS k FROM v),
 d AS (SELECT vec_id AS id, needed // k + CASE WHEN row_number() OVER (ORDER BY md5('{SEED}|' || vec_id), vec_id) <= needed % k THEN 1 ELSE 0 END AS draws FROM v CROSS JOIN n WHERE rare)
 SELECT id, CAST(draws AS BIGINT) AS draws, CAST(draws AS BIGINT) AS on_segment FROM d WHERE draws > 0""")
def smote_segments(spark, folder):
    """Every made row lies between its source and one of the five nearest rows of the rare class."""
    rare = table(spark, folder, "embeddings").where("label = 0")
    made = bal.oversample(_wide(spark, folder), "y", "vec_id", FEATURES, "smote", exact=True)
    return _on_segments(made, rare, nearest(rare, rare, "vec_id", "embedding", 5, exact=True))


@query("m14_adasyn_segments", "WITH " + _NEAR.format(where="a.rare") + """, o AS (SELECT query AS id, count(*) FILTER (WHERE NOT rare) AS others FROM near WHERE rank <= 5 GROUP BY 1),
 n AS (SELECT CAST(count(*) FILTER (WHERE label <> 0) - count(*) FILTER (WHERE label = 0) AS DOUBLE) AS needed FROM embeddings), d AS (SELECT id, CAST(round_even(others / (SELECT CAST(sum(others) AS DOUBLE) FROM o) * needed, 0) AS BIGINT) AS draws FROM o CROSS JOIN n)
 SELECT id, draws, draws AS on_segment FROM d WHERE draws > 0""")
def adasyn_segments(spark, folder):
    rare = table(spark, folder, "embeddings").where("label = 0")
    made = bal.oversample(_wide(spark, folder), "y", "vec_id", FEATURES, "adasyn", exact=True)
    return _on_segments(made, rare, nearest(rare, rare, "vec_id", "embedding", 5, exact=True))


@query("m13_borderline_seeds", "WITH " + _NEAR.format(where="a.rare") + """, o AS (SELECT query AS id, count(*) FILTER (WHERE NOT rare) AS others FROM near WHERE rank <= 10 GROUP BY 1)
 SELECT id, others, CAST(others * 2 >= 10 AND others < 10 AS BIGINT) AS danger FROM o""")
def borderline_seeds(spark, folder):
    df = _rare(spark, folder).select(F.col("vec_id").alias("id"), (F.col("y") == 1).alias("rare"), F.col("embedding").alias("vec"))
    around = bal.majority_share(df.where("rare"), df, 10, SEED, exact=True)
    return around.withColumn("danger", ((F.col("others") * 2 >= 10) & (F.col("others") < 10)).cast("long"))


@query("m13_borderline_smote", "WITH " + _NEAR.format(where="a.rare") + """, o AS (SELECT query, count(*) FILTER (WHERE NOT rare) AS others FROM near WHERE rank <= 10 GROUP BY 1)
 SELECT CAST(label = 0 AS BIGINT) AS y, CAST(0 AS BIGINT) AS synthetic, count(*) AS "rows" FROM embeddings GROUP BY 1
 UNION ALL SELECT CAST(1 AS BIGINT), 1, count(*) FILTER (WHERE label <> 0) - count(*) FILTER (WHERE label = 0) FROM embeddings HAVING (SELECT count(*) FROM o WHERE others * 2 >= 10 AND others < 10) > 0""")
def borderline(spark, folder):
    return _tally(bal.oversample(_wide(spark, folder), "y", "vec_id", FEATURES, "borderline_smote", exact=True))


@query("m13_borderline_segments", "WITH " + _NEAR.format(where="a.rare") + f""", o AS (SELECT query AS id, count(*) FILTER (WHERE NOT rare) AS others FROM near WHERE rank <= 10 GROUP BY 1),
 danger AS (SELECT id FROM o WHERE others * 2 >= 10 AND others < 10), n AS (SELECT count(*) FILTER (WHERE NOT rare) - count(*) FILTER (WHERE rare) AS needed, (SELECT count(*) FROM danger) AS k FROM v),
 d AS (SELECT id, needed // k + CASE WHEN row_number() OVER (ORDER BY md5('{SEED}|' || id), id) <= needed % k THEN 1 ELSE 0 END AS draws FROM danger CROSS JOIN n)
 SELECT id, CAST(draws AS BIGINT) AS draws, CAST(draws AS BIGINT) AS on_segment FROM d WHERE draws > 0""")
def borderline_segments(spark, folder):
    """Rows are made from the rare rows near the border only, each on the way to one of their five nearest rare rows."""
    rare = table(spark, folder, "embeddings").where("label = 0")
    made = bal.oversample(_wide(spark, folder), "y", "vec_id", FEATURES, "borderline_smote", exact=True)
    return _on_segments(made, rare, nearest(rare, rare, "vec_id", "embedding", 5, exact=True))


@query("m14_adasyn", "WITH " + _NEAR.format(where="a.rare") + """, o AS (SELECT query AS id, count(*) FILTER (WHERE NOT rare) AS others FROM near WHERE rank <= 5 GROUP BY 1),
 n AS (SELECT CAST(count(*) FILTER (WHERE label <> 0) - count(*) FILTER (WHERE label = 0) AS DOUBLE) AS needed FROM embeddings), d AS (SELECT id, CAST(round_even(others / (SELECT CAST(sum(others) AS DOUBLE) FROM o) * needed, 0) AS BIGINT) AS draws FROM o CROSS JOIN n)
 SELECT id, draws FROM d WHERE draws > 0""")
def adasyn(spark, folder):
    """How many rows are made from each rare row."""
    made = bal.oversample(_wide(spark, folder), "y", "vec_id", FEATURES, "adasyn", exact=True)
    return made.where("is_synthetic").groupBy(F.col("vec_id").alias("id")).agg(F.count(F.lit(1)).alias("draws"))


# --- model fits: their numbers are Spark ML's own, so there is no SQL check unless the shape can be checked ------------

SMALL = tr.TrainingOptions(folds=3, selector_trees=3, max_features=8, trials=2, search_rate=0.5, parallel=3)
PARAMS = {"maxIter": 4, "maxDepth": 3}


def training_table(spark, folder):
    """Encoded and imputed customers; columns that give the target away are left out."""
    df = spread(m.application(spark, folder).drop("AMT_INCOME_TOTAL"), "application")
    coded = tidy_columns(ap.fit_base(df).apply(df))
    filled = fit_imputation(coded, [KEY, LABEL], []).apply(coded)
    return settle(ap.add_row_statistics(filled), "training")


def _features(df):
    return [c for c in df.columns if c not in (KEY, LABEL)]


@query("m08_importance_selector")
def selector(spark, folder):
    df = training_table(spark, folder)
    prep = tr.fit_preprocessing(df, _features(df), SMALL)
    return spark.createDataFrame([(i, c) for i, c in enumerate(prep.selected)], "position int, feature string")


@query("m16_fit_model")
def fit(spark, folder):
    """A boosted model with class weights and early stopping; the score of every row."""
    df = training_table(spark, folder)
    features = _features(df)
    model = tr.fit_model("gbt", PARAMS, df, features, SMALL)
    return model.transform(tr.assemble(df, features)).select(KEY, LABEL, tr.positive_probability().alias("score"))


SPACE = {"maxDepth": {"type": "int", "low": 2, "high": 4}, "stepSize": {"type": "float", "low": 0.01, "high": 0.3, "log": True}}


@query("m18_search")
def search(spark, folder):
    """Seeded random candidates (M17), each judged by cross-validation on a stratified subsample."""
    df = training_table(spark, folder)
    _, trials, _ = tr.search(df, _features(df), "gbt", {"maxIter": 2}, SPACE, SMALL)
    return trials


@query("m19_out_of_fold", _DRAWN + " SELECT SK_ID_CURR, CAST(TARGET AS BIGINT) AS \"TARGET\", (place - 1) % 3 AS fold, CAST(1 AS BIGINT) AS scores FROM drawn")
def out_of_fold(spark, folder):
    """Each row scored once, by the model that has not seen its fold."""
    df = training_table(spark, folder)
    scored = tr.out_of_fold(df, _features(df), "gbt", PARAMS, SMALL)
    counted = scored.where("score BETWEEN 0 AND 1").groupBy(KEY, LABEL, "fold").agg(F.count("score").alias("scores"))
    return rounded_table(counted)


@query("m19_folds_do_not_leak", "SELECT count(*) AS \"rows\", CAST(1 AS BIGINT) AS near_chance, CAST(1 AS BIGINT) AS learnt_by_heart FROM customer")
def folds_do_not_leak(spark, folder):
    """Noise tells a label only to a model that has seen the row: scores near chance out of fold, far above it in sample."""
    from riskloom.operators.metrics import single_metric

    noise = ["N0", "N1", "N2"]
    mixed = lambda i: F.pmod(F.xxhash64(KEY, F.lit(i)), F.lit(10_007))
    df = m.application(spark, folder).select(KEY, (mixed(9) % 2).cast("int").alias(LABEL), *[mixed(i).cast("double").alias(c) for i, c in enumerate(noise)])
    df = settle(spread(df), "noise")
    deep, plain = {"numTrees": 12, "maxDepth": 14}, replace(SMALL, scaler=None, selection=None, balance=None)
    held = single_metric(tr.out_of_fold(df, noise, "random_forest", deep, plain), LABEL, "score", "roc_auc", 0.5)
    model = tr.fit_model("random_forest", deep, df, noise, plain)
    seen = model.transform(tr.assemble(df, noise, LABEL)).select(KEY, LABEL, tr.positive_probability().alias("score"))
    known = single_metric(seen, LABEL, "score", "roc_auc", 0.5)
    return spark.createDataFrame([(df.count(), int(abs(held - 0.5) < 0.15), int(known > 0.75))], "rows long, near_chance long, learnt_by_heart long")


@query("m20_final_fit")
def final_fit(spark, folder):
    """Fitted, saved, loaded again and applied."""
    from riskloom.operators.scoring import Scorer
    from riskloom.session import scratch_path

    df = training_table(spark, folder)
    scorer, _ = job.final_fit(df, _features(df), "gbt", PARAMS, SMALL)
    path = scratch_path(spark, "scorer")
    scorer.save(spark, path)
    return Scorer.load(spark, path).predict(df)


@query("m21_importance_table")
def importance(spark, folder):
    df = training_table(spark, folder)
    _, found = job.final_fit(df, _features(df), "random_forest", {"numTrees": 5, "maxDepth": 4}, SMALL)
    return found


@query("m22_training_phases")
def phases(spark, folder):
    """Validation and final fit; the metrics of the out-of-fold scores."""
    from riskloom.operators.metrics import metric_rows

    run = job.run_training(training_table(spark, folder), None, "gbt", PARAMS, None, SMALL, ("validate", "final_fit"))
    return metric_rows(spark, {**run.metadata, **run.reports["out_of_fold"]["metrics"]})


@query("m23_raw_table_baseline")
def baseline(spark, folder):
    from riskloom.operators.metrics import metric_rows

    df = m.application(spark, folder).drop("AMT_INCOME_TOTAL")
    return metric_rows(spark, job.raw_table_baseline(df, KEY, LABEL, trees=4).metrics)


# --- facts about fits that SQL can state --------------------------------------------------------------------------

PLANTED = "PLANTED"


def planted_table(spark, folder):
    """The training table with one feature that follows the target, but for every 29th customer."""
    told = F.when(F.col(KEY) % 29 == 0, 0.5).otherwise(F.col(LABEL) * 2.0 + F.col(KEY) % 3 / 10)
    return settle(training_table(spark, folder).withColumn(PLANTED, told), "planted")


@query("m08_selector_finds_planted", "SELECT 'PLANTED' AS feature, CAST(8 AS BIGINT) AS selected, CAST(1 AS BIGINT) AS known, count(*) AS \"rows\" FROM customer")
def planted_selector(spark, folder):
    """With one feature to select it is the planted one; with eight, eight known ones."""
    df = planted_table(spark, folder)
    one = tr.fit_preprocessing(df, _features(df), replace(SMALL, max_features=1)).selected
    some = tr.fit_preprocessing(df, _features(df), SMALL).selected
    return spark.createDataFrame([(one[0], len(some), int(set(some) <= set(_features(df))), df.count())], "feature string, selected long, known long, rows long")


@query("m16_scores_every_row", f"WITH {m.APPLICATION_SQL} SELECT SK_ID_CURR, CAST(TARGET AS BIGINT) AS \"TARGET\", CAST(1 AS BIGINT) AS scores, CAST(CASE WHEN SK_ID_CURR % 29 = 0 THEN 1 ELSE TARGET END AS BIGINT) AS sides FROM application")
def scores_every_row(spark, folder):
    """One score in 0..1 for each customer, on the right side where the planted feature tells the target."""
    df = planted_table(spark, folder)
    features = _features(df)
    model = tr.fit_model("gbt", PARAMS, df, features, SMALL)
    scored = model.transform(tr.assemble(df, features)).select(KEY, LABEL, tr.positive_probability().alias("score")).where("score BETWEEN 0 AND 1")
    side = F.when(F.col(KEY) % 29 == 0, 1).otherwise((F.col("score") > 0.5).cast("int"))
    return scored.groupBy(KEY, F.col(LABEL).cast("long").alias(LABEL)).agg(F.count("score").alias("scores"), F.max(side).cast("long").alias("sides"))


@query("m18_trials_in_range", "SELECT CAST(i AS BIGINT) AS trial, CAST(1 AS BIGINT) AS depth_in_range, CAST(1 AS BIGINT) AS step_in_range, CAST(1 AS BIGINT) AS value_in_range FROM range(2) t(i) WHERE EXISTS (SELECT 1 FROM customer)")
def trials_in_range(spark, folder):
    """Candidates lie in their ranges (M17) and each has a metric between 0 and 1."""
    df = training_table(spark, folder)
    _, trials, _ = tr.search(df, _features(df), "gbt", {"maxIter": 2}, SPACE, SMALL)
    drawn = trials.select("trial", "value", F.from_json("params", "maxDepth int, stepSize double").alias("p"))
    inside = lambda c, low, high: F.col(c).between(low, high).cast("long")
    return drawn.select(
        F.col("trial").cast("long").alias("trial"), inside("p.maxDepth", 2, 4).alias("depth_in_range"), inside("p.stepSize", 0.01, 0.3).alias("step_in_range"),
        inside("value", 0.0, 1.0).alias("value_in_range"))


@query("m20_loaded_scores_alike", f"WITH {m.APPLICATION_SQL} SELECT SK_ID_CURR, CAST(1 AS BIGINT) AS same, CAST(1 AS BIGINT) AS inside FROM application")
def loaded_scores_alike(spark, folder):
    """A saved and loaded scorer gives every row the score of the fitted one."""
    from riskloom.operators.scoring import PROBABILITY, Scorer
    from riskloom.session import scratch_path

    df = training_table(spark, folder)
    scorer, _ = job.final_fit(df, _features(df), "gbt", PARAMS, SMALL)
    path = scratch_path(spark, "scorer")
    scorer.save(spark, path)
    both = scorer.predict(df, "fitted").join(Scorer.load(spark, path).predict(df, PROBABILITY), KEY)
    return both.select(KEY, (F.col("fitted") == F.col(PROBABILITY)).cast("long").alias("same"), F.col("fitted").between(0, 1).cast("long").alias("inside"))


@query("m21_importance_facts", "SELECT 'PLANTED' AS best, CAST(1 AS DOUBLE) AS total, CAST(1 AS BIGINT) AS sorted, CAST(0 AS BIGINT) AS unknown FROM customer GROUP BY 1")
def importance_facts(spark, folder):
    """Importances add up to 1, fall, belong to known features, and the planted one leads."""
    df = planted_table(spark, folder)
    _, found = job.final_fit(df, _features(df), "gbt", PARAMS, SMALL)
    rows = found.collect()  # one row per feature
    falls = all(a["importance"] >= b["importance"] for a, b in zip(rows, rows[1:]))
    unknown = len({r["feature"] for r in rows} - set(_features(df)))
    return spark.createDataFrame([(rows[0]["feature"], round(sum(r["importance"] for r in rows), 6), int(falls), unknown)], "best string, total double, sorted long, unknown long")


@query("m22_all_phases", f"""WITH {m.APPLICATION_SQL}, c AS (SELECT count(*) AS n, count(*) FILTER (WHERE TARGET = 1) AS p FROM application)
 SELECT 'data' AS part, n AS "rows", p AS positives FROM c UNION ALL SELECT 'out_of_fold', n, p FROM c UNION ALL SELECT 'search_trials', 2, 0 FROM c UNION ALL SELECT 'submission', n, 0 FROM c""")
def all_phases(spark, folder):
    """Search, validation and final fit in one run: rows of what each leaves."""
    df = training_table(spark, folder)
    run = job.run_training(df, df.drop(LABEL), "gbt", PARAMS, SPACE, SMALL, ("search", "validate", "final_fit"))
    held = run.reports["out_of_fold"]["confusion"].agg(F.sum("row_count").alias("n"), F.sum(F.when(F.col("actual") == 1, F.col("row_count"))).alias("p")).first()
    assert set(run.reports) == {"search_subsample_cv", "out_of_fold"}
    rows = [("data", run.metadata["row_count"], run.metadata["positive_count"]), ("out_of_fold", held["n"], held["p"]), ("search_trials", run.trials.count(), 0),
            ("submission", run.submission.where(F.col(LABEL).between(0, 1)).count(), 0)]
    return spark.createDataFrame(rows, "part string, rows long, positives long")


@query("m23_baseline_rows", _DRAWN + taken(share_of_rows(0.2)) + """ SELECT (SELECT count(*) FROM drawn) - (SELECT sum(take) FROM sizes) AS train_rows, (SELECT sum(take) FROM sizes) AS valid_rows, CAST(4 AS DOUBLE) AS texts, CAST(1 AS DOUBLE) AS auc_in_range""")
def baseline_rows(spark, folder):
    """The baseline learns from four fifths of the customers and is judged on the rest."""
    df = m.application(spark, folder).drop("AMT_INCOME_TOTAL")
    found = job.raw_table_baseline(df, KEY, LABEL, trees=2).metrics
    row = (float(found["train_rows"]), float(found["valid_rows"]), float(found["categorical_feature_count"]), float(0 <= found["roc_auc"] <= 1))
    return spark.createDataFrame([row], "train_rows double, valid_rows double, texts double, auc_in_range double")


_TEXTS = ("NAME_CONTRACT_TYPE", "OCCUPATION_TYPE", "NAME_SEGMENT")


def _ordered(c: str) -> str:
    over = "OVER (PARTITION BY {c} ORDER BY md5('{seed}|' || CAST(SK_ID_CURR AS VARCHAR)), SK_ID_CURR ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)".format(c=c, seed=SEED)
    return f"(coalesce(sum(CAST(TARGET AS DOUBLE)) {over}, 0) + CAST(0.5 AS DOUBLE)) / (count(*) {over} + 1)"


@query("m23_ordered_statistics", f"WITH {m.APPLICATION_SQL} SELECT SK_ID_CURR, " + ", ".join(f'{r(_ordered(c), 6)} AS "{c}_CODE"' for c in _TEXTS) + " FROM application")
def ordered_statistics(spark, folder):
    """Categories coded by the labels of the rows before them in a repeatable shuffle."""
    df = m.application(spark, folder).select(KEY, LABEL, *_TEXTS)
    coded = ts.fit_target_statistics(df, _TEXTS, LABEL, KEY, seed=SEED).ordered(df)
    return rounded_table(coded.select(KEY, *[c + ts.SUFFIX for c in _TEXTS]), 6)


@query("m23_statistics_of_others", f"WITH {m.APPLICATION_SQL}, {m.SPLIT_SQL} SELECT SK_ID_CURR, " + ", ".join(
    f'{r(f"(coalesce((SELECT sum(CAST(t.TARGET AS DOUBLE)) FROM train t WHERE t.{c} IS NOT DISTINCT FROM a.{c}), 0) + 0.5) / ((SELECT count(*) FROM train t WHERE t.{c} IS NOT DISTINCT FROM a.{c}) + 1)", 6)} AS "{c}_CODE"' for c in _TEXTS)
    + " FROM application a")
def statistics_of_others(spark, folder):
    """All customers coded by the training customers, as rows to be scored are."""
    df = m.application(spark, folder).select(KEY, LABEL, *_TEXTS)
    coded = ts.fit_target_statistics(m.train_rows(df), _TEXTS, LABEL, KEY, seed=SEED).apply(df)
    return rounded_table(coded.select(KEY, *[c + ts.SUFFIX for c in _TEXTS]), 6)


_RUNS = "runs AS (SELECT user_id AS run_id, CASE WHEN user_id % 9 <> 0 THEN round(avg(value) / 100, 6) END AS roc_auc, max(event_id) AS finished_at FROM events GROUP BY user_id)"


def _runs(spark, folder):
    return table(spark, folder, "events").groupBy(F.col("user_id").alias("run_id")).agg(
        F.round(F.avg("value") / 100, 6).alias("auc"), F.max("event_id").alias("finished_at")
    ).select("run_id", F.when(F.col("run_id") % 9 != 0, F.col("auc")).alias("roc_auc"), "finished_at")


@query("m24_champion_gate", f"WITH {_RUNS} SELECT run_id, {r('roc_auc')} AS roc_auc, finished_at FROM runs WHERE roc_auc >= 0.5 ORDER BY finished_at DESC LIMIT 1")
def champion(spark, folder):
    return rounded_table(tr.champion(_runs(spark, folder), 0.5))


@query("m24_gate_status", f"""WITH {_RUNS} SELECT run_id, CASE WHEN roc_auc IS NULL THEN 'skipped_missing_roc_auc' WHEN roc_auc < 0.5 THEN 'skipped_metric_gate' ELSE 'registered' END AS registry_status FROM runs""")
def gate(spark, folder):
    return tr.gate_status(_runs(spark, folder), 0.5).select("run_id", "registry_status")
