"""Hand-made tables of a few rows whose expected values are worked out by hand
(the quirks listed in FIXTURES.md section 3)."""

import math

import pytest
from pyspark.sql import functions as F

from tabforge.operators import assoc, clean, encode, features, metrics, outliers, profile, scale
from tabforge.operators.impute import apply_impute, fit_impute


def test_lifecycle_boundaries(spark):
    df = spark.createDataFrame([(t,) for t in [0, 6, 12, 13, 24, 25, 48, 49, None]], "tenure int")
    rows = {r["tenure"]: r for r in features.tenure_buckets(df, "tenure").collect()}
    assert rows[12]["tenure_group_new"] == 1 and rows[13]["tenure_group_growing"] == 1
    assert rows[24]["tenure_group_growing"] == 1 and rows[25]["tenure_group_mature"] == 1
    assert rows[48]["tenure_group_mature"] == 1 and rows[48]["is_loyal_customer"] == 1
    assert rows[49]["tenure_group_loyal"] == 1
    assert rows[6]["is_new_customer"] == 1 and rows[12]["is_new_customer"] == 0
    n = rows[None]
    assert all(n[c] == 0 for c in n.asDict() if c != "tenure")


def test_null_in_membership(spark):
    df = spark.createDataFrame([("No", None), (None, "Yes"), ("Yes", "No internet service")], "a string, b string")
    out = features.active_count(df, ["a", "b"], ["No", "No internet service"], "n")
    out = features.count_equal(out, ["a", "b"], "Yes", "yes")
    got = [(r["n"], r["yes"]) for r in out.collect()]
    # NULL is "active" (~isin is True for NULL) but never equal to "Yes".
    assert got == [(1, 0), (2, 1), (1, 1)]


def test_subscription_features(spark):
    df = spark.createDataFrame(
        [("Fiber optic", "Month-to-month", "Bank transfer (automatic)", 5, 50.0, "250", "Yes", "No")],
        "InternetService string, Contract string, PaymentMethod string, tenure int, MonthlyCharges double, "
        "TotalCharges string, Partner string, Dependents string")
    df = df.withColumn("TotalCharges", F.col("TotalCharges").cast("double"))
    r = features.subscription_features(df).first()
    assert r["has_fiber"] == 1 and r["has_internet"] == 1 and r["auto_payment"] == 1
    assert r["is_month_to_month"] == 1 and r["has_family"] == 1 and r["family_size"] == 1
    assert r["AvgMonthlyCharges"] == pytest.approx(250 / 6)


def _v(spark, pairs):
    df = spark.createDataFrame(pairs, "x string, y string")
    return assoc.cramers_v_pairs(df, [("x", "y")], decimals=None).first()


def test_cramers_v_yates_2x2(spark):
    rows = [("a", "p")] * 10 + [("a", "q")] * 20 + [("b", "p")] * 20 + [("b", "q")] * 10
    r = _v(spark, rows)
    # E = 15 everywhere, |O-E| = 5 -> Yates (4.5^2/15)*4 = 5.4; V = sqrt(5.4/60)
    assert r["chi2"] == pytest.approx(5.4)
    assert r["cramers_v"] == pytest.approx(math.sqrt(5.4 / 60))


def test_cramers_v_3x2_no_yates_and_zero_cell(spark):
    rows = [("a", "p")] * 10 + [("a", "q")] * 20 + [("b", "p")] * 20 + [("c", "q")] * 10
    r = _v(spark, rows)
    # grid with a zero cell (b,q) and (c,p): chi2 from all 6 cells
    obs = {("a", "p"): 10, ("a", "q"): 20, ("b", "p"): 20, ("b", "q"): 0, ("c", "p"): 0, ("c", "q"): 10}
    rt = {"a": 30, "b": 20, "c": 10}
    ct = {"p": 30, "q": 30}
    chi2 = sum((obs[(i, j)] - rt[i] * ct[j] / 60) ** 2 / (rt[i] * ct[j] / 60) for i in rt for j in ct)
    assert r["chi2"] == pytest.approx(chi2)
    assert r["cramers_v"] == pytest.approx(math.sqrt(chi2 / 60))


def test_cramers_v_degenerate(spark):
    assert _v(spark, [("a", "p"), ("a", "q")])["cramers_v"] == 0.0


def test_mode_tie_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "s string")
    p = fit_impute(df, numeric_cols=[], categorical_cols=["s"])
    assert [r["s"] for r in apply_impute(df, p).collect()][-1] == "a"


@pytest.mark.parametrize("method", ["standard", "minmax", "robust"])
def test_constant_column_scales_to_zero(spark, method):
    df = spark.createDataFrame([(3.0,), (3.0,), (3.0,)], "x double")
    out, _ = scale.scale(df, method, ["x"])
    assert [r["x"] for r in out.collect()] == [0.0, 0.0, 0.0]


def test_constant_column_stats_are_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 5.0), (1.0, 9.0)], "x double, y double")
    u = {r["feature"]: r for r in profile.univariate_numeric(df, ["x", "y"]).collect()}
    assert u["x"]["skewness"] is None and u["x"]["kurtosis"] is None
    r = profile.correlation_long(df, ["x", "y"]).first()
    assert r["correlation"] is None


def test_histogram_max_in_last_bin_and_single_value(spark):
    df = spark.createDataFrame([(0.0, 7.0), (10.0, 7.0), (5.0, 7.0)], "x double, c double")
    h = {(r["feature"], r["bin"]): r["n"] for r in profile.histogram(df, ["x", "c"], 30).collect()}
    assert h[("x", 29)] == 1 and h[("x", 0)] == 1 and h[("x", 15)] == 1
    assert h == {("x", 0): 1, ("x", 15): 1, ("x", 29): 1, ("c", 0): 3}


def test_target_encoding_min_samples(spark):
    rows = [("small", 1)] * 9 + [("big", 1)] * 5 + [("big", 0)] * 5 + [(None, 0)] * 2
    df = spark.createDataFrame(rows, "cat string, y int")
    out = encode.target_encode(df, ["cat"], "y")
    g = 14 / 21
    got = {r["cat"]: r["cat_target_encoded"] for r in out.distinct().collect()}
    assert got["small"] == pytest.approx(g)                       # 9 rows -> global mean
    assert got["big"] == pytest.approx((10 * 0.5 + g) / 11)        # 10 rows -> smoothed
    assert got[None] == pytest.approx(g)


def test_bin_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (2.0,), (3.0,)], "x double")
    out, _ = features.binning_features(df, {"x": [0.0, 1.0, 2.0]})
    got = [r["x_binned"] for r in out.orderBy("x").collect()]
    assert got == [None, 0, 1, 1, None]


def test_equal_width_bins_match_pandas_rule(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 6, 7, 8, 9, 10]], "x double")
    out, edges = features.binning_features(df, {"x": 3})
    assert edges["x"][0] == pytest.approx(1 - 0.009) and edges["x"][-1] == 10
    got = [r["x_binned"] for r in out.orderBy("x").collect()]
    assert got == [0, 0, 0, 0, 1, 1, 1, 2, 2, 2]


def test_auc_ties_count_half(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "label int, score double")
    assert metrics.roc_auc(df).first()["auc"] == pytest.approx((1 + 0.5 + 1 + 1) / 4)


def test_iqr_cap_keeps_nulls(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]] + [(None,)], "x double")
    out, p = outliers.handle_outliers(df, "iqr", 1.5, ["x"])
    got = [r["x"] for r in out.collect()]
    assert got[-1] is None and max(v for v in got if v is not None) == pytest.approx(4 + 1.5 * 2)


def test_empty_and_one_row_inputs(spark):
    empty = spark.createDataFrame([], "x double, s string")
    assert profile.univariate_numeric(empty, ["x"]).collect() == []
    one = spark.createDataFrame([(1.0, "a")], "x double, s string")
    r = profile.describe_numeric(one, ["x"]).first()
    assert r["count"] == 1 and r["std"] is None and r["q50"] == 1.0


def test_drop_sparse_strictly_greater(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 1), (4, 1)], "a int, b int")
    out, dropped = clean.drop_sparse_columns(df, 0.5)
    assert dropped == [] and out.columns == ["a", "b"]


def test_filter_rejects_non_dict_condition(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        clean.filter_rows(df, {"a": 5})


def test_unknown_strategies_raise(spark):
    df = spark.createDataFrame([(1.0,)], "a double")
    with pytest.raises(ValueError):
        scale.fit_scaler(df, "zscore", ["a"])
    with pytest.raises(ValueError):
        fit_impute(df, "knn")


def test_target_strategy_routes_to_target_encoding(spark):
    rows = [("x", 1)] * 12 + [("y", 0)] * 12
    df = spark.createDataFrame(rows, "cat string, y int")
    out, fitted = encode.encode_categorical(df, "target", ["cat"], target="y")
    got = {r["cat"]: r["cat_target_encoded"] for r in out.distinct().collect()}
    assert got["x"] == pytest.approx((12 * 1 + 0.5) / 13)


@pytest.mark.parametrize("r,n,expected", [
    (0.5, 10, 0.14111),     # t = 1.633, 8 dof
    (0.3, 50, 0.034286),    # t = 2.179, 48 dof
    (0.0, 30, 1.0),
    (-0.9, 5, 0.037386),    # t = -3.576, 3 dof
])
def test_pearson_p_value_matches_student_t(r, n, expected):
    assert assoc.pearson_p_value(r, n) == pytest.approx(expected, abs=2e-5)


def test_missing_predictions_count_in_no_metric(spark):
    rows = [(1.0, 1.5), (2.0, 1.5), (3.0, 3.5), (100.0, None), (-50.0, float("nan"))]
    df = spark.createDataFrame(rows, "label double, prediction double")
    m = metrics.regression_metrics(df).first()
    assert m["r2"] == pytest.approx(1 - 0.75 / 2.0) and m["mse"] == pytest.approx(0.25)
    s = metrics.residual_stats(df).first()
    assert s["explained_variance"] == pytest.approx(1 - (0.25 - (1 / 6) ** 2) / (2 / 3))
    long, _ = metrics.model_comparison(df.withColumn("model", F.lit("a")), score=None, problem_type="regression")
    assert {r.metric: r.value for r in long.collect()}["r2"] == pytest.approx(0.625)
    acc = metrics.accuracy(spark.createDataFrame([(1, 1), (0, 1), (1, None)], "label int, prediction int")).first()
    assert acc["accuracy"] == 0.5 and acc["n"] == 2


def test_equal_width_bins_skip_nan(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,), (float("nan"),), (None,)], "a double")
    out, edges = features.binning_features(df, {"a": 2})
    assert [r["a_binned"] for r in out.collect()] == [0, 0, 1, None, None]


def test_mode_takes_the_smallest_of_the_most_frequent(spark):
    from tabforge.operators.impute import most_frequent
    df = spark.createDataFrame([("f", "b"), ("f", "a"), ("f", "b"), ("f", "a"), ("f", "c"), ("g", None)], "feature string, value string")
    assert [tuple(r) for r in most_frequent(df).collect()] == [("f", "a", 2)]


def test_dummy_vector_equals_the_wide_form(spark):
    """Sparse vectors against the columns of the wide form, NULLs, a constant and an empty column included."""
    rows = [(i, "abcd"[i % 4] if i % 5 else None, f"v{i % 7}", "same", None) for i in range(40)]
    df = spark.createDataFrame(rows, "k int, a string, b string, one string, none string")
    cols = ["b", "one", "a", "none"]
    vectors, positions = encode.dummy_vector(df, cols)
    names = [f"{r.feature}_{r.value}" for r in positions.orderBy("position").collect()]
    wide = {r.k: r for r in encode.dummy_encode(df, cols).collect()}
    got = vectors.collect()
    assert vectors.columns == ["k", "dummies"] and len(got) == 40 and len(names) == 9
    for r in got:
        assert r.dummies.toArray().tolist() == [wide[r.k][n] for n in names]
    unseen = spark.createDataFrame([(1, "zz", "v3", "same", "x")], df.schema)
    again, _ = encode.dummy_vector(unseen, cols, positions=positions)
    assert [names[i] for i in again.first().dummies.indices] == ["b_v3"]


def test_many_dummies_stay_off_the_driver(spark):
    """A hundred thousand categories: the wide form raises, the sparse one has a place for each."""
    df = spark.range(100_000).select("id", F.concat(F.lit("c"), F.format_string("%06d", "id")).alias("name"))
    with pytest.raises(ValueError, match="dummy_vector"):
        encode.dummy_encode(df, ["name"])
    out, _ = encode.dummy_vector(df, ["name"])
    row = out.where("id = 70000").first().dummies
    assert (row.size, list(row.indices)) == (99_999, [69_999])
    assert out.where("id = 0").first().dummies.numNonzeros() == 0
