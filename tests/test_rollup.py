"""Roll-ups against pandas, with the special cases of the feature definitions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators.rollup import (
    Latest, Recency, Rollup, Split, Stat, categories, categories_by_recency, child_means, latest_rows, roll_up, share_stats,
)
from riskloom.operators import rollup
from riskloom.plans import histories


def rows(df, key="k"):
    return {r[key]: r.asDict() for r in df.collect()}


HISTORY = [
    # k, day, amount, status, loan
    (1, -10.0, 5.0, "A", 1), (1, -100.0, 7.0, "R", 1), (1, None, 100.0, "A", None), (1, -400.0, None, None, 2),
    (2, -5.0, None, "A", 5), (2, -6.0, None, "R", 5),
    (3, -500.0, 4.0, "C", 9),
]
SCHEMA = "k long, day double, amount double, status string, loan long"


@pytest.fixture(scope="module")
def history(spark):
    return spark.createDataFrame(HISTORY, SCHEMA)


PLAN = Rollup(
    "k", (Stat("rows", name="n"), Stat("sum", "amount"), Stat("mean", "amount"), Stat("max", "amount"), Stat("min", "amount"), Stat("count", "amount")),
    Recency("day", (30, 365), "D", (Stat("rows", name="n"), Stat("sum", "amount"), Stat("mean", "amount"), Stat("count", "amount")), ("amount",)),
    (Split("status", "A", "ACTIVE", (Stat("rows", name="ACTIVE_COUNT"), Stat("sum", "amount"))),),
    Latest("day", (1, 2), (Stat("count", "loan"), Stat("mean", "amount"), Stat("sum", "amount"))), ("loan",), "t_",
)


def test_sum_of_nulls_is_zero_inside_a_group_and_null_without_rows(history, spark):
    got = rows(roll_up(history, PLAN))
    assert got[2]["t_amount_sum"] == 0 and got[2]["t_amount_mean"] is None and got[2]["t_amount_count"] == 0
    assert got[2]["t_amount_sum_30D"] == 0 and got[2]["t_amount_count_30D"] == 0
    assert got[3]["t_amount_sum_365D"] is None and got[3]["t_n_365D"] is None and got[3]["t_amount_count_365D"] is None
    base = spark.createDataFrame([(1,), (4,)], "k long")
    joined = rows(base.join(roll_up(history, PLAN), "k", "left"))
    assert joined[4]["t_amount_sum"] is None


def test_rows_without_order_are_outside_windows_and_inside_every_last_n(history):
    got = rows(roll_up(history, PLAN))[1]
    assert got["t_n_30D"] == 1 and got["t_amount_sum_365D"] == 12
    assert got["t_LAST_1_amount_sum"] == 105 and got["t_LAST_2_amount_sum"] == 112
    assert got["t_LAST_1_loan_count"] == 1
    kept = latest_rows(history.where("k = 1"), "k", "day", 1).count()
    assert kept == 2


def test_distinct_counts_null_as_a_value(history):
    got = rows(roll_up(history, PLAN))
    assert got[1]["t_loan_nunique"] == 3 and got[2]["t_loan_nunique"] == 1


def test_split_keeps_its_given_name_and_trend_needs_recent_rows(history):
    got = rows(roll_up(history, PLAN))
    assert got[1]["t_ACTIVE_ACTIVE_COUNT"] == 2 and got[3]["t_ACTIVE_ACTIVE_COUNT"] is None
    assert got[1]["t_amount_mean_trend_30D"] == pytest.approx(5 - 112 / 3)
    assert got[3]["t_amount_mean_trend_30D"] is None


def test_shares_skip_nulls_and_use_categories_of_their_window(history):
    assert categories(history, "status") == ["A", "C", "R"]
    by_window = categories_by_recency(history, "status", "day", (30, 365, 1000))
    assert by_window[30] == ["A", "R"] and by_window[1000] == ["A", "C", "R"]
    got = rows(roll_up(history, Rollup("k", share_stats("status", ["A", "C", "R"]))))
    assert got[1]["status_A_prop"] == pytest.approx(2 / 3) and got[1]["status_C_prop"] == 0
    with pytest.raises(ValueError, match="categories"):
        categories(history, "status", limit=2)


def test_category_text_is_quoted(spark):
    df = spark.createDataFrame([(1, "it's"), (1, "a\\b"), (1, None)], "k long, s string")
    got = rows(roll_up(df, Rollup("k", share_stats("s", categories(df, "s")))))[1]
    assert got["s_it's_prop"] == 0.5 and got["s_a\\b_prop"] == 0.5


def test_child_means_are_unweighted(spark):
    parent = spark.createDataFrame([(1, 10), (1, 11), (1, 12)], "k long, loan long")
    child = spark.createDataFrame([(10, 1.0), (11, 3.0)], "loan long, v double")
    assert rows(child_means(parent, child, "k", "loan"))[1]["v_mean"] == 2


def frame(seed=0, n=4000):
    rng = np.random.default_rng(seed)
    df = pd.DataFrame({
        "k": np.where(rng.random(n) < 0.4, 7, rng.integers(0, 200, n)),  # one key holds well over a third
        "day": -rng.integers(0, 900, n).astype(float), "amount": np.round(rng.normal(size=n), 3), "loan": np.arange(n),
        "status": rng.choice(["A", "B", "C"], n),
    })
    df.loc[rng.random(n) < 0.05, "day"] = np.nan
    df.loc[rng.random(n) < 0.1, "amount"] = np.nan
    return df


def test_hot_key_gives_the_same_numbers_as_pandas(spark):
    pdf = frame()
    df = spark.createDataFrame(pdf).selectExpr("k", "nanvl(day, null) AS day", "nanvl(amount, null) AS amount", "loan", "status")
    plan = Rollup(
        "k", (Stat("rows", name="n"), Stat("mean", "amount")), Recency("day", (60, 365), "D", (Stat("rows", name="n"), Stat("sum", "amount"), Stat("max", "amount"))),
        (Split("status", "A", "A", (Stat("mean", "amount"),)),), Latest("day", (1, 3, 10), (Stat("sum", "amount"), Stat("count", "loan")), ("loan",)),
    )
    got = rows(roll_up(df, plan))
    for k, g in pdf.groupby("k"):
        r = got[k]
        assert r["n"] == len(g) and r["amount_mean"] == pytest.approx(g.amount.mean())
        recent = g[g.day >= -60]
        if len(recent):
            assert r["n_60D"] == len(recent) and r["amount_sum_60D"] == pytest.approx(recent.amount.sum())
        else:
            assert r["n_60D"] is None
        dated = g[g.day.notna()].sort_values(["day", "loan"], ascending=[False, True])
        for n in (1, 3, 10):
            part = pd.concat([g[g.day.isna()], dated.head(n)])
            assert r[f"LAST_{n}_loan_count"] == len(part) and r[f"LAST_{n}_amount_sum"] == pytest.approx(part.amount.sum())


def test_plan_cuts_rows_before_they_travel(spark):
    df = spark.createDataFrame(frame(n=100))
    plan = Rollup("k", (Stat("rows", name="n"),), Recency("day", (60,), "D", (Stat("rows", name="n"),)), latest=Latest("day", (3,), (Stat("sum", "amount"),), ("loan",)))
    text = roll_up(df, plan)._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2  # before and after the exchange
    assert "partial_count" in text and "Join" not in text


def scattered(spark, n=6_000):
    """Few rows per key, some of them undated, without status or without key."""
    pdf = frame(3, n)
    pdf["k"] = np.arange(n) * 7 % 1_500
    df = spark.createDataFrame(pdf).selectExpr(
        "CASE WHEN k <> 11 THEN k END AS k", "nanvl(day, null) AS day", "nanvl(amount, null) AS amount", "CASE WHEN loan % 5 <> 0 THEN loan % 3 END AS loan", "status", "loan AS row")
    return df, Rollup(
        "k", (Stat("rows", name="n"), Stat("max", "amount"), *share_stats("status", ["A", "B"])),
        Recency("day", (60, 365), "D", (Stat("rows", name="n"), Stat("sum", "amount"), Stat("min", "amount")), (), {60: share_stats("status", ["A"], "status_60D")}),
        (Split("status", "A", "A", (Stat("mean", "amount"),)),),
        Latest("day", (1, 3), (Stat("sum", "amount"), Stat("count", "loan"), Stat("max", "amount"), *share_stats("status", ["C"])), ("row",)), ("loan",),
    )


def test_few_rows_per_key_travel_once(spark, monkeypatch):
    df, plan = scattered(spark)
    alone = Rollup(plan.key, plan.overall, plan.recency, plan.splits, plan.latest)
    text = roll_up(df, alone)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1, text
    once = roll_up(df, plan)
    monkeypatch.setattr(rollup, "MOST_ROWS", 0)  # every key counts as one with too many rows
    cells = roll_up(df, plan)
    assert "WindowGroupLimit" not in once._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in cells._jdf.queryExecution().executedPlan().toString()
    one, two = rows(once), rows(cells)
    assert one.keys() == two.keys() and None in one
    for k, r in one.items():
        for c, v in r.items():
            assert v == two[k][c] or v == pytest.approx(two[k][c]), (k, c)


def many_rows(spark, clustered=False):
    """Forty rows per key, which tasks hold scattered or all together."""
    pdf = frame(5, 12_000)
    pdf["k"] = np.arange(12_000) % 300
    df = spark.createDataFrame(pdf).selectExpr("k", "nanvl(day, null) AS day", "nanvl(amount, null) AS amount", "loan % 7 AS loan", "status", "loan AS row")
    plan = Rollup(
        "k", (Stat("rows", name="n"), Stat("max", "amount"), Stat("mean", "twice"), *share_stats("status", ["A"])),
        Recency("day", (60, 365), "D", (Stat("rows", name="n"), Stat("sum", "twice"), Stat("min", "amount"))),
        (Split("status", "A", "A", (Stat("mean", "amount"),)),),
        Latest("day", (1, 3), (Stat("sum", "twice"), Stat("count", "loan"), Stat("max", "amount"), *share_stats("status", ["A"])), ("row",)), ("loan",),
    )
    return df.repartition(8, "k") if clustered else df.repartition(64), plan, lambda d: d.withColumn("twice", F.col("amount") * 2)


def test_many_scattered_rows_per_key_travel_once(spark, monkeypatch):
    """Cells and newest rows would be as many as the rows before the trip; after it, older rows share cells."""
    df, plan, derive = many_rows(spark)
    settled = rollup.settle(df)
    alone = roll_up(settled, Rollup(plan.key, plan.overall, plan.recency, plan.splits, plan.latest), derive)._jdf.queryExecution().executedPlan().toString()
    assert alone.count("Exchange") == 1 and "WindowGroupLimit" not in alone, alone
    assert "twice" not in alone[alone.index("Exchange"):], "derived columns are made after the trip"
    assert rollup._trips(settled, plan, rollup._dimensions(plan)) == (True, True)
    once = roll_up(settled, plan, derive)
    monkeypatch.setattr(rollup, "MOST_ROWS", 0)  # every key counts as one with too many rows
    cells = roll_up(settled, plan, derive)
    assert "WindowGroupLimit" in cells._jdf.queryExecution().executedPlan().toString()
    one, two = rows(once), rows(cells)
    assert len(one) == 300 and one.keys() == two.keys()
    for k, r in one.items():
        for c, v in r.items():
            assert v == two[k][c] or v == pytest.approx(two[k][c]), (k, c)


def test_rows_that_tasks_hold_together_become_cells_before_they_travel(spark):
    df, plan, _ = many_rows(spark, clustered=True)
    assert rollup._trips(rollup.settle(df), plan, rollup._dimensions(plan))[0] is False


def test_hot_keys_are_found_in_full_lots(spark):
    """A lot with many rows of many keys is no hot key."""
    df = spark.range(40_000).selectExpr("CASE WHEN id % 10 = 0 THEN 7 WHEN id % 10 = 1 THEN NULL ELSE id % 900 END AS k")
    assert rollup._has_hot_key(df, "k", 40_000)
    assert rollup._has_hot_key(df.where("k IS NULL OR k <> 7"), "k", 36_000)
    rest = df.where("k <> 7")
    assert not rollup._has_hot_key(rest, "k", rest.count())
    few = spark.range(40_000).selectExpr("id % 17 AS k")
    assert not rollup._has_hot_key(few, "k", 40_000)
    assert rollup._has_hot_key(spark.range(3).selectExpr("1 AS k"), "k", 3)
    assert not rollup._has_hot_key(few.where("false"), "k", 0)


def test_newest_rows_do_not_travel_after_the_union(spark, monkeypatch):
    monkeypatch.setattr(rollup, "MOST_ROWS", 0)
    df, plan = scattered(spark)
    text = roll_up(df, plan)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text[:text.index("Union")], text
    counts = roll_up(df.repartition(40), plan)
    assert counts.count() == 1_500 and counts.select("k").distinct().count() == 1_500


def test_two_histories_of_one_join_read_it_written(spark, folder):
    from riskloom.catalog import mapping

    t = mapping.credit_tables(spark, folder)
    for name, alone in (("installments_payments", mapping.installments), ("credit_card_balance", mapping.card_balance)):
        assert not rollup._is_derived(t[name])
        assert sorted(map(str, t[name].collect())) == sorted(map(str, alone(spark, folder).collect()))


def test_optional_inputs_and_feature_sets(spark):
    pos = spark.createDataFrame([(1, 5, -1.0, -2.0)], "SK_ID_CURR long, SK_ID_PREV long, MONTHS_BALANCE double, SK_DPD double")
    full = histories.pos_rollup(pos)
    assert full.first()["pos_SK_DPD_max"] == 0 and "pos_CNT_INSTALMENT_mean" not in full.columns
    bare = histories.pos_rollup(pos, sets=())
    assert bare.columns == ["SK_ID_CURR", "pos_SK_DPD_max", "pos_SK_DPD_mean", "pos_SK_ID_PREV_nunique"]
    assert bare.first()["pos_SK_DPD_max"] == -2


def test_feature_counts_of_the_five_tables(spark, folder):
    from riskloom.catalog import mapping

    t = mapping.credit_tables(spark, folder)
    sizes = {
        "bureau": (histories.bureau_rollup(t["bureau"], t["bureau_balance"]), 39 + 5 * 3),
        "prev": (histories.previous_rollup(t["previous_application"]), 82 + 4),
        "pos": (histories.pos_rollup(t["pos_cash_balance"]), 43), "inst": (histories.installment_rollup(t["installments_payments"]), 62),
        "cc": (histories.card_rollup(t["credit_card_balance"]), 63),
    }
    for name, (df, wanted) in sizes.items():
        assert len(df.columns) - 1 == wanted, name
    names = set(sizes["bureau"][0].columns) | set(sizes["prev"][0].columns) | set(sizes["inst"][0].columns) | set(sizes["cc"][0].columns) | set(sizes["pos"][0].columns)
    assert {
        "bureau_DAYS_CREDIT_max", "inst_DPD_mean_365D", "cc_UTILIZATION_mean_3M", "inst_PAYMENT_PERC_mean_trend_60D", "pos_LAST_3_CNT_INSTALMENT_mean",
        "prev_APPROVED_AMT_CREDIT_mean", "prev_NAME_CONTRACT_STATUS_Refused_prop", "bureau_STATUS_3M_A_prop_mean", "bureau_BUREAU_COUNT_730D",
        "bureau_ACTIVE_ACTIVE_LOANS_COUNT", "bureau_ACTIVE_LOANS_COUNT",
    } <= names


def test_a_loan_id_held_by_many_rows_is_split(spark):
    from riskloom.session import settle

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        parent = spark.range(200_000, numPartitions=8).selectExpr("id % 5000 AS k", "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 20000 END AS loan")
        child = settle(spark.range(20_000).selectExpr("id AS loan", "CAST(id AS DOUBLE) AS v"), "loans")
        got = child_means(parent, child, "k", "loan")
        total = got.selectExpr("count(1)", "sum(v_mean)").first()
        plan = got._jdf.queryExecution()
        joined = got.collect()
        assert "skew=true" in plan.executedPlan().toString(), plan.executedPlan().toString()
        expected = parent.toPandas().groupby("k").loan.mean()
        assert total[0] == 5000 and len(joined) == 5000
        assert sum(r.v_mean for r in joined) == pytest.approx(expected.sum())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_parents_without_children_stay(spark):
    parent = spark.createDataFrame([(1, 10), (1, 11), (2, 12)], "k long, loan long")
    child = spark.createDataFrame([(10, 4.0), (11, 6.0)], "loan long, v double")
    got = {r.k: r.v_mean for r in child_means(parent, child, "k", "loan").collect()}
    assert got == {1: 5.0, 2: None}


def test_any_number_of_categories(spark):
    df = spark.range(2_500).selectExpr("id AS k", "concat('c', id) AS s")
    assert len(categories(df, "s")) == 2_500
    with pytest.raises(ValueError):
        categories(df, "s", limit=2_000)


def test_sketches_count_distinct_values_within_their_error(spark):
    """A hot key with 60,000 values, many small keys, windows and newest rows; null is one more value."""
    df = spark.range(90_000).select(
        F.when(F.col("id") < 60_000, 1).otherwise(F.col("id") % 500 + 2).alias("k"), F.when(F.col("id") % 50 != 3, F.col("id") % 45_000).alias("v"),
        F.when(F.col("id") % 9 != 0, -(F.col("id") % 100)).alias("age"), "id")
    sketch = (Stat("approx_distinct", "v"),)
    plan = Rollup("k", sketch, Recency("age", (10, 60), "D", sketch), latest=Latest("age", (2, 8), sketch, ("id",)), distinct=("v",))
    got = {r["k"]: r for r in roll_up(df, plan).collect()}
    rows = df.toPandas()
    for key in (1, 2, 77, 501):
        own = rows[rows.k == key]
        within = lambda part: part.v.nunique() + int(part.v.isna().any()) if len(part) else None
        newest = own[own.age.notna()].sort_values(["age", "id"], ascending=[False, True])
        undated = own[own.age.isna()]
        expected = {"v_approx_distinct": within(own), "v_approx_distinct_10D": within(own[own.age >= -10]), "v_approx_distinct_60D": within(own[own.age >= -60])}
        expected |= {f"LAST_{n}_v_approx_distinct": within(pd.concat([newest.head(n), undated])) for n in (2, 8)}
        assert got[key]["v_nunique"] == expected["v_approx_distinct"]
        for c, n in expected.items():
            assert got[key][c] == n or n > 400 and abs(got[key][c] - n) <= 0.05 * n, (key, c, got[key][c], n)
