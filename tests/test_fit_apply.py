"""Encoders, imputation, pruning and scaling: fitted on training rows only."""

import numpy as np
import pytest

from riskloom.operators.encode import fit_codes, fit_frequency
from riskloom.operators.impute import fit_imputation
from riskloom.operators.scale import fit_scaling
from riskloom.plans import application as ap


def values(df, key="id"):
    return {r[key]: {k: v for k, v in r.asDict().items() if k != key} for r in df.collect()}


def test_frequency_gives_one_to_null_and_unseen(spark):
    train = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "b")], "id int, c string")
    test = spark.createDataFrame([(5, "a"), (6, "z"), (7, None)], "id int, c string")
    assert values(fit_frequency(train, "c").apply(test)) == {5: {"c_FREQ": 2}, 6: {"c_FREQ": 1}, 7: {"c_FREQ": 1}}
    assert values(fit_frequency(train, "c", normalize=True).apply(test)) == {5: {"c_FREQ": 0.5}, 6: {"c_FREQ": 1.0}, 7: {"c_FREQ": 1.0}}


def test_codes(spark):
    train = spark.createDataFrame([(1, "F", "x", "q"), (2, "M", None, "q"), (3, None, "y", "q"), (4, "M", "z", "q")], "id int, g string, h string, i string")
    codes = fit_codes(train, ["g", "h", "i"])
    assert codes.binary == {"g": {"F": 0, "M": 1}} and codes.one_hot == {"h": ["x", "y", "z", "__NULL__"], "i": ["q"]}
    test = spark.createDataFrame([(5, "X", "w"), (6, "F", None)], "id int, g string, h string")
    got = values(codes.apply(test))
    assert got[5] == {"g": -1, "h_x": 0, "h_y": 0, "h_z": 0, "h___NULL__": 0, "i_q": 0}
    assert got[6]["g"] == 0 and got[6]["h___NULL__"] == 1
    without = codes.apply(test.drop("g"))
    assert {r.g for r in without.collect()} == {-1}
    assert fit_codes(train, ["h"], drop_first=True).one_hot == {"h": ["y", "z", "__NULL__"]}
    with pytest.raises(ValueError, match="too many"):
        fit_codes(train, ["h"], limit=1)


def test_a_real_category_named_like_the_null_label_merges_with_it(spark):
    train = spark.createDataFrame([(1, "__NULL__"), (2, None), (3, "a"), (4, "b"), (5, "c")], "id int, c string")
    codes = fit_codes(train, ["c"])
    assert codes.one_hot["c"] == ["__NULL__", "a", "b", "c"]
    got = values(codes.apply(train))
    assert got[1]["c___NULL__"] == 1 and got[2]["c___NULL__"] == 1


def test_imputation_flags_only_training_nulls(spark):
    train = spark.createDataFrame([(1, 1.0, 5.0, None, None), (2, None, 6.0, 2.0, None), (3, 4.0, 9.0, 1.0, None)], "id int, a double, b double, prev_x double, empty double")
    test = spark.createDataFrame([(4, None, None, None, 3.0)], "id int, a double, b double, prev_x double, empty double")
    fitted = fit_imputation(train, ["id"], ["prev_"])
    got = values(fitted.apply(test))[4]
    assert got == {"a": 2.5, "b": 6.0, "prev_x": 0.0, "empty": 3.0, "a_is_missing": 1, "empty_is_missing": 0}
    assert values(fitted.apply(train))[1]["empty"] == 0


def test_an_earlier_flag_is_replaced_in_place(spark):
    df = spark.createDataFrame([(1, None, 9), (2, 3.0, 9)], "id int, a double, a_is_missing int")
    out = fit_imputation(df, ["id"], []).apply(df)
    assert out.columns == ["id", "a", "a_is_missing"]
    assert {r.id: r.a_is_missing for r in out.collect()} == {1: 1, 2: 0}


def test_statistics_stage_fills_keys_and_target_too(spark):
    df = spark.createDataFrame([(None, None, float("inf"), "t")], "SK_ID_CURR long, TARGET int, x double, s string")
    row = ap.add_row_statistics(df).first()
    assert (row.SK_ID_CURR, row.TARGET, row.x, row.s) == (0, 0, 0.0, "t")


def test_cross_ratios_are_off_unless_asked_for(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 10.0)], "EXT_SOURCE_1 double, EXT_SOURCE_2 double, EXT_SOURCE_3 double, CREDIT_INCOME_RATIO double")
    assert not [c for c in ap.add_row_statistics(df).columns if "_TO_" in c]
    on = ap.add_row_statistics(df, ap.BaseOptions(cross_ratios=True))
    assert on.first()["CREDIT_INCOME_RATIO_TO_EXT_SOURCE_2"] == pytest.approx(5)


def test_base_features_follow_their_inputs(spark):
    df = spark.createDataFrame([(365243.0, -3652.5)], "DAYS_EMPLOYED double, DAYS_BIRTH double")
    got = ap.derive_base(df).first().asDict()
    assert got == {"DAYS_EMPLOYED": None, "DAYS_BIRTH": -3652.5, "AGE_YEARS": 10.0, "DAYS_EMPLOYED_PERC": None}
    assert ap.derive_base(df, ap.BaseOptions(sets=())).columns == ["DAYS_EMPLOYED", "DAYS_BIRTH", "DAYS_EMPLOYED_PERC"]


def test_cleanup_pads_test_columns(spark):
    train = spark.createDataFrame([(i, i % 2, float(i), 2.0 * i, float(i * i % 7)) for i in range(40)], "SK_ID_CURR long, TARGET int, a double, b double, c double")
    fitted = ap.fit_pruning(train)
    assert fitted.correlated == ["b"] and fitted.kept == ["SK_ID_CURR", "TARGET", "a", "c"]
    test = spark.createDataFrame([(99, 1.5, 7)], "SK_ID_CURR long, c double, other int")
    assert fitted.apply(test, without=["TARGET"]).collect()[0].asDict() == {"SK_ID_CURR": 99, "a": 0, "c": 1.5}
    assert fitted.padded(test, ["TARGET"]) == ["a"]


def test_scalers(spark):
    x = [1.0, 2.0, 3.0, 10.0]
    df = spark.createDataFrame([(v, 5.0) for v in x], "x double, flat double")
    a = np.array(x)
    q1, q2, q3 = np.quantile(a, [0.25, 0.5, 0.75])
    wanted = {"standard": (a - a.mean()) / a.std(), "robust": (a - q2) / (q3 - q1), "minmax": (a - 1) / 9}
    for kind, expected in wanted.items():
        got = fit_scaling(df, ["x", "flat"], kind).apply(df).toPandas()
        assert np.allclose(got.x, expected) and (got.flat == 0).all()
    with pytest.raises(ValueError):
        fit_scaling(df, ["x"], "log")
    assert fit_scaling(df, ["x"], None).apply(df).columns == ["x", "flat"]


def test_categories_that_differ_in_case(spark):
    train = spark.createDataFrame([(1, "Yes"), (2, "yes"), (3, "no")], "id int, c string")
    assert values(fit_codes(train, ["c"]).apply(train))[2] == {"c_Yes": 0, "c_no": 0, "c_yes": 1}
    spark.conf.set("spark.sql.caseSensitive", "false")
    try:
        with pytest.raises(ValueError, match="case"):
            fit_codes(train, ["c"])
    finally:
        spark.conf.set("spark.sql.caseSensitive", "true")


def test_any_number_of_encoded_categories(spark):
    df = spark.range(2_300).selectExpr("id AS k", "concat('c', id) AS s")
    assert len(fit_codes(df, ["s"]).one_hot["s"]) == 2_300
    with pytest.raises(ValueError, match="too many"):
        fit_codes(df, ["s"], limit=2_299)
    assert fit_codes(df, ["s"], limit=2_300)


def test_cross_ratios_over_ratios_made_in_the_same_step(spark):
    df = spark.createDataFrame([(1, 100.0, 50.0, 5.0, 0.5, 0.25, None)], "SK_ID_CURR long, AMT_INCOME_TOTAL double, AMT_CREDIT double, AMT_ANNUITY double, EXT_SOURCE_1 double, EXT_SOURCE_2 double, EXT_SOURCE_3 double")
    row = ap.add_row_statistics(df, ap.BaseOptions(cross_ratios=True)).first()
    assert row.CREDIT_INCOME_RATIO_TO_EXT_SOURCE_1 == pytest.approx(1.0) and row.ANNUITY_INCOME_RATIO_TO_EXT_SOURCE_2 == pytest.approx(0.2)
    assert row.CREDIT_INCOME_RATIO_TO_EXT_SOURCE_3 == 0
