"""Fits, scoring, jobs and metrics against independent computations and planted signals."""

import json
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabforge.ml import models as M
from tabforge.ml.registry import read_registry, recommend
from tabforge.ml.scoring import Preprocessor, batch_predict, infer
from tabforge.operators import encode as E
from tabforge.operators import metrics as N
from tabforge.operators import select as S
from tabforge.operators.clean import drop_null_rows, null_ratios
from tabforge.operators.impute import fit_impute, apply_impute
from tabforge.operators.outliers import fit_outliers
from tabforge.operators.profile import missing_profile
from tabforge.operators.assoc import pearson_matrix, point_biserial
from tabforge.operators.scale import scale
from tabforge.operators.split import split
from tabforge.plans import jobs as Q
from tabforge.session import scratch_path

KEY = ["k"]
NAN = float("nan")


@pytest.fixture(scope="module")
def planted(spark):
    """y depends on a and b; c is noise."""
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(400, 3))
    y = (2 * x[:, 0] - x[:, 1] + 0.1 * rnd.normal(size=400) > 0).astype(int)
    z = 3 * x[:, 0] - 2 * x[:, 1] + 5 + 0.01 * rnd.normal(size=400)
    rows = [(i, *map(float, x[i]), int(y[i]), float(z[i]), int(np.digitize(x[i, 0], [-0.5, 0.5]))) for i in range(400)]
    return spark.createDataFrame(rows, "k long, a double, b double, c double, y int, z double, three int").cache()


# ---------------------------------------------------------------- NaN counts as missing

@pytest.fixture(scope="module")
def holes(spark):
    rows = [(1.0, 1.0, 0), (NAN, 2.0, 1), (3.0, None, 0), (None, 4.0, 1), (7.0, NAN, 1), (7.0, 9.0, 0)]
    return spark.createDataFrame(rows, "x double, w double, y int")


def test_nan_is_missing(holes):
    assert null_ratios(holes, ["x", "w"]) == {"x": pytest.approx(2 / 6), "w": pytest.approx(2 / 6)}
    assert {r.feature: r.missing for r in missing_profile(holes).collect()} == {"x": 2, "w": 2, "y": 0}
    assert drop_null_rows(holes).count() == 2
    pdf = holes.toPandas()
    r = {(r.feature1, r.feature2): r.correlation for r in pearson_matrix(holes, ["x", "w"]).collect()}
    assert r[("x", "w")] == pytest.approx(pdf[["x", "w"]].corr().iloc[0, 1])
    got, _ = scale(holes, "standard", ["x"])
    v = pdf["x"].dropna()
    want = ((v - v.mean()) / v.std(ddof=0)).tolist()
    assert [r.x for r in got.collect() if r.x is not None] == pytest.approx(want)
    assert point_biserial(holes, "y", ["x"]).first().correlation is not None


@pytest.mark.parametrize("strategy, fill", [("mean", 4.5), ("median", 5.0), ("constant", 0.0), ("most_frequent", 7.0)])
def test_imputers_fill_nan(holes, strategy, fill):
    out = apply_impute(holes, fit_impute(holes, strategy, numeric_cols=["x"], categorical_cols=[]))
    assert [r.x for r in out.collect()] == [1.0, fill, 3.0, fill, 7.0, 7.0]


def test_regression_metrics_skip_nan(spark):
    df = spark.createDataFrame([(1.0, 2.0), (NAN, 1.0), (3.0, NAN), (5.0, 5.0)], "label double, prediction double")
    r = N.regression_metrics(df).first()
    assert r.mse == pytest.approx(0.5) and r.mae == pytest.approx(0.5)


def test_knn_keeps_every_row_and_takes_donors(spark):
    from tabforge.operators.impute import handle_missing_values
    rows = [(1, 1.0, 10.0, "a"), (2, 1.1, 12.0, "a"), (None, 1.05, None, None), (3, 9.0, 90.0, "b"), (3, 9.1, NAN, "a"), (4, 8.9, 88.0, "a")]
    df = spark.createDataFrame(rows, "k int, x double, y double, s string")
    out, _ = handle_missing_values(df, "knn", key="k", n_neighbors=2)
    got = sorted((r.x, r.y, r.s) for r in out.collect())
    assert got == [(1.0, 10.0, "a"), (1.05, 11.0, "a"), (1.1, 12.0, "a"), (8.9, 88.0, "a"), (9.0, 90.0, "b"), (9.1, 89.0, "a")]
    late = spark.createDataFrame([(7, 9.2, None, None)], "k int, x double, y double, s string")
    out, _ = handle_missing_values(late, "knn", threshold=1.0, key="k", n_neighbors=2, donors=df)
    assert (out.first().y, out.first().s) == (89.0, "a")


# ---------------------------------------------------------------- wrong answers of the past

def test_best_model_ignores_nan(spark):
    rows = [("a", 1.0, 1.0), ("a", 2.0, 2.5), ("a", 3.0, 3.0), ("b", 1.0, 3.0), ("b", 2.0, 1.0), ("b", 3.0, 9.0),
            ("flat", 2.0, 2.0), ("flat", 2.0, 2.0)]
    df = spark.createDataFrame(rows, "model string, label double, prediction double")
    _, best = N.model_comparison(df, score=None, problem_type="regression")
    got = {r.metric: r.best_model for r in best.collect()}
    assert set(got) == {"mse", "rmse", "mae", "r2"} and got["r2"] == "a" and got["mse"] == "flat"


def test_continuous_columns_are_binned_by_default(planted):
    ids = planted.withColumn("id", F.col("k").cast("double") + 0.5)
    mi = {r.feature: r.mi for r in S.mutual_information(ids, ["id", "a", "c"], "y").collect()}
    assert mi["a"] > 0.2 and mi["a"] > 3 * mi["id"] and mi["a"] > 3 * mi["c"]
    assert S.feature_selection(ids, ["id", "a", "c"], "y", "mutual_info", 1) == ["a"]


def test_split_is_exact_with_repeated_keys(spark):
    df = spark.range(1000).select((F.col("id") % 34).alias("k"), "id")
    assert split(df, ["k"], 0.2, 1).where("is_test").count() == 200
    same = spark.range(50).select(F.lit(1).alias("k"))
    assert split(same, ["k"], 0.3, 1).where("is_test").count() == 15


def test_auc_only_for_two_classes(spark):
    rows = [("m", i % 3, i % 3, 0.1 * i) for i in range(9)] + [("two", i % 2, i % 2, 0.1 * i) for i in range(8)]
    df = spark.createDataFrame(rows, "model string, label int, prediction int, score double")
    long, _ = N.model_comparison(df)
    auc = {r.model: r.value for r in long.where("metric = 'roc_auc'").collect()}
    assert auc["m"] is None and auc["two"] is not None


def test_outliers_keep_three_valued_columns(spark):
    df = spark.range(100).select(*[F.when(F.col("id") == i, 50.0).when(F.col("id") % 2 == 0, 1.0).otherwise(0.0).alias(f"x{i}")
                                   for i in range(60)], (F.col("id") % 2).cast("double").alias("flag"))
    got = {r.feature for r in fit_outliers(df, "iqr").select("feature").distinct().collect()}
    assert got == {f"x{i}" for i in range(60)}


def test_onehot_tells_null_from_the_text_nan(spark):
    df = spark.createDataFrame([("nan",), (None,), ("b",)], "a string")
    out, _ = E.onehot_encode(df, ["a"])
    assert out.columns == ["a_b", "a_nan", "a_nan_null"]
    assert [tuple(r) for r in out.collect()] == [(0, 1, 0), (0, 0, 1), (1, 0, 0)]


def test_unknown_arguments_raise(planted):
    for hp in ({"max_depth": 50}, {"depth": 3}):
        with pytest.raises(ValueError):
            M.train(planted, ["a"], "y", "random_forest", "classification", hp)
    with pytest.raises(ValueError):
        M.grid_search(planted, ["a"], "y", KEY, "logistic_regression", scoring="nonsense", param_grid={"C": [1.0]})


# ---------------------------------------------------------------- fits

def test_linear_regression_is_least_squares(planted):
    m = M.train(planted, ["a", "b", "c"], "z", "linear_regression", "regression")
    pdf = planted.toPandas()
    x = np.column_stack([pdf[["a", "b", "c"]], np.ones(len(pdf))])
    want = np.linalg.lstsq(x, pdf["z"], rcond=None)[0]
    assert [*m.stages[-1].coefficients, m.stages[-1].intercept] == pytest.approx(want.tolist(), abs=1e-6)


@pytest.mark.parametrize("kind", ["random_forest", "logistic_regression", "svm"])
def test_classifiers_find_the_planted_signal(planted, kind):
    s = split(planted, KEY, 0.3, 1, stratify_by="y")
    hp = {"n_estimators": 20, "max_depth": 5} if kind == "random_forest" else {"C": 1.0, "max_iter": 50, "class_weight": "balanced"}
    m = M.train(s.where("not is_test"), ["a", "b", "c"], "y", kind, "classification", hp)
    got = {r.metric: r.value for r in M.evaluate(m, s.where("is_test"), KEY, "y").collect()}
    assert got["accuracy"] > 0.85 and got.get("roc_auc") is None or got["roc_auc"] > 0.9


def test_three_class_svm_keeps_class_weights(planted):
    m = M.train(planted, ["a", "b"], "three", "svm", "classification", {"C": 10.0, "class_weight": "balanced"})
    assert m.stages[-1].getWeightCol() == "_class_weight"
    assert {r.metric: r.value for r in M.evaluate(m, planted, KEY, "three").collect()}["accuracy"] > 0.6


def test_regression_forest(planted):
    m = M.train(planted, ["a", "b", "c"], "z", "random_forest", "regression", {"n_estimators": 20, "max_depth": 8})
    assert {r.metric: r.value for r in M.evaluate(m, planted, KEY, "z", "regression").collect()}["r2"] > 0.9


def test_grid_search_prefers_the_better_setting(planted):
    _, results, best = M.grid_search(planted, ["a", "b", "c"], "y", KEY, "random_forest", "classification",
                                     {"max_depth": [1, 6]}, cv_folds=3, scoring="f1", hyperparameters={"n_estimators": 10})
    assert best["maxDepth"] == 6 and results.count() == 2


def test_recursive_elimination_keeps_the_signal(planted):
    assert M.rfe_select(planted, ["c", "a", "b"], "y", 2, n_trees=15) == ["a", "b"]


def test_cross_validation_summary(planted):
    cv = M.cross_validate(planted, ["a", "b"], "y", KEY, "logistic_regression", "classification", {"C": 1.0}, 3).toPandas()
    for (side, metric), g in cv.groupby(["side", "metric"]):
        folds = g[g.fold >= 0]["value"]
        assert len(folds) == 3 and folds.min() > 0.8
        assert g[g.fold == -1]["value"].iloc[0] == pytest.approx(folds.mean())
        assert g[g.fold == -2]["value"].iloc[0] == pytest.approx(folds.std(ddof=0))


def test_learning_curve_sizes(planted):
    lc = M.learning_curve(planted, ["a", "b"], "y", KEY, train_sizes=[0.2, 1.0], cv_folds=2).toPandas()
    assert len(lc) == 4 and (lc["mean"] > 0.8).all() and (lc["std"] >= 0).all()


def test_linear_folds_equal_single_fits(planted):
    """All folds from one pass against a fit by numpy per fold; two equal columns change nothing."""
    df = planted.withColumn("c", F.col("c") + 1e4).withColumn("twin", F.col("b"))
    cv = M.cross_validate(df, ["a", "b", "c"], "z", KEY, "linear_regression", "regression", {}, 4)
    got = {(r.fold, r.side, r.metric): r.value for r in cv.where("fold >= 0").collect()}
    rows = M.assign_folds(df, KEY, 4, 42).select("fold", "a", "b", "c", "z").toPandas()
    for i in range(4):
        tr = rows[rows.fold != i]

        def design(x):
            return np.column_stack([np.ones(len(x)), x[["a", "b", "c"]]])

        beta = np.linalg.lstsq(design(tr), tr.z, rcond=None)[0]
        for side, part in (("train", tr), ("test", rows[rows.fold == i])):
            e = part.z - design(part) @ beta
            want = {"mse": (e * e).mean(), "rmse": math.sqrt((e * e).mean()), "mae": e.abs().mean(),
                    "r2": 1 - (e * e).sum() / ((part.z - part.z.mean()) ** 2).sum()}
            for metric, value in want.items():
                assert got[i, side, metric] == pytest.approx(value, rel=1e-6)
    twin = M.cross_validate(df, ["a", "b", "c", "twin"], "z", KEY, "linear_regression", "regression", {}, 4)
    for r in twin.where("fold >= 0").collect():
        assert r.value == pytest.approx(got[r.fold, r.side, r.metric], rel=1e-6)


def test_linear_folds_refuse_missing_values(planted):
    with pytest.raises(ValueError, match="missing"):
        M.cross_validate(planted.withColumn("a", F.when(F.col("k") > 3, F.col("a"))), ["a"], "z", KEY, "linear_regression",
                         "regression", {}, 3)
    with pytest.raises(ValueError, match="Unknown"):
        M.cross_validate(planted, ["a"], "z", KEY, "linear_regression", "regression", {"C": 1}, 3)


def test_linear_curve_equals_single_fits(planted):
    """The curve of least squares against fits on the same subsets."""
    lc = M.learning_curve(planted, ["a", "c"], "z", KEY, "linear_regression", "regression", [1.0, 0.05], 3, metric="mse")
    got = {(r.train_size, r.side): (r["mean"], r["std"]) for r in lc.collect()}
    folds = M.assign_folds(planted, KEY, 3, 42).cache()
    want: dict = {}
    for i in range(3):
        tr = M.hash_positions(folds.where(F.col("fold") != i), KEY, 42 + i).toPandas()
        te = folds.where(F.col("fold") == i).toPandas()
        for size in (1.0, 0.05):
            sub = tr[tr._pos < math.ceil(size * len(tr))]
            beta = np.linalg.lstsq(np.column_stack([np.ones(len(sub)), sub[["a", "c"]]]), sub.z, rcond=None)[0]
            for side, part in (("train", sub), ("test", te)):
                e = part.z - np.column_stack([np.ones(len(part)), part[["a", "c"]]]) @ beta
                want.setdefault((size, side), []).append((e * e).mean())
    assert got.keys() == want.keys()
    for key, values in want.items():
        assert got[key] == pytest.approx((np.mean(values), np.std(values)), rel=1e-6)


# ---------------------------------------------------------------- saving and scoring

def test_saved_model_scores_the_same_everywhere(spark, planted):
    m = M.train(planted, ["a", "b"], "y", "logistic_regression", "classification", {"C": 1.0})
    base = scratch_path(spark, "test-model")
    M.save_model(m, f"{base}/m", {"model_type": "logistic_regression", "problem_type": "classification", "features": ["a", "b"],
                                  "hyperparameters": {"C": 1.0}, "evaluation_metrics": {"accuracy": 0.9}, "dataset_size": 400},
                 f"{base}/registry")
    meta = M.load_metadata(spark, f"{base}/m")
    assert meta["features"] == ["a", "b"] and meta["classes"] == [0.0, 1.0]
    told = {r.k: (r.prediction, round(r.score, 9)) for r in M.predict(m, planted, KEY).collect()}
    assert len(told) == 400
    planted.write.parquet(f"{base}/input")
    files = [batch_predict(spark, f"{base}/m", f"{base}/input", f"{base}/out", KEY),
             Q.scoring_job(spark, f"{base}/m", planted, f"{base}/out2", KEY)]
    for f in files:
        rows = spark.read.parquet(f).collect()
        assert all(math.isclose(r.prob_class_0 + r.prob_class_1, 1, abs_tol=1e-9) for r in rows)
        assert {r.k: (r.predictions, round(r.prob_class_1, 9)) for r in rows} == told
    assert {r.k: (r.prediction, round(r.score, 9)) for r in infer(f"{base}/m", planted, KEY).collect()} == told
    report = Q.validation_job(f"{base}/m", planted, KEY, "y")["report"].collect()
    support = {r.row: r.support for r in report}
    ones = planted.where("y = 1").count()
    assert support["1.0"] == ones and support["0.0"] == 400 - ones and support["accuracy"] == 400
    cv = Q.cross_validation_job(f"{base}/m", planted, KEY, "y", 2)
    assert cv.where("fold >= 0 and metric = 'accuracy'").count() == 4
    row = read_registry(spark, f"{base}/registry").first()
    assert row.accuracy == 0.9 and row.dataset_size == 400


def test_training_job_can_be_scored_and_is_registered(spark, sf_dir):
    from tabforge.plans.fixtures import c360
    base = scratch_path(spark, "test-job")
    res = Q.churn_training_job(spark, sf_dir, base, model_types=("logistic_regression",), cv_folds=None, eda=False)
    raw = c360(spark, sf_dir).join(res.predictions.select("customer_id"), "customer_id", "left_semi")
    pre = Preprocessor.load(spark, f"{base}/preprocessor")
    assert pre.order == res.preprocessor.order and pre.columns == res.features
    back = {r.customer_id: int(r.prediction) for r in infer(f"{base}/models/logistic_regression", raw, ["customer_id"], pre).collect()}
    assert back == {r.customer_id: r.prediction for r in res.predictions.collect()} and back
    lb = read_registry(spark, f"{base}/registry")
    assert lb.first().accuracy is not None and lb.first().dataset_size > 0
    assert recommend(lb).first().recommended_model == "logistic_regression"


def test_label_and_generic_features_survive_saving(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 4.0), (None, 9.0)], "s string, v double")
    maps = E.fit_label(df, "s").select(F.lit("s").alias("feature"), "value", "code")
    pre = Preprocessor({"label": maps}, feature_config={"polynomial_features": ["v"], "binning_features": {"v": 2}},
                       bin_edges={"v": [0.0, 5.0, 10.0]})
    path = pre.save(scratch_path(spark, "test-pre"))
    a, b = pre.apply(df), Preprocessor.load(spark, path).apply(df)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert {(r.s, r.v_binned) for r in b.collect()} == {(1, 0), (0, 0), (2, 1)}


def _neighbour_mi(x, y, k=3):
    """Ross' estimator by all pairs."""
    keep = np.array([(y == c).sum() > 1 for c in y])
    x, y = x[keep], y[keep]
    h = np.concatenate(([0.0], np.cumsum(1 / np.arange(1, len(x) + 2))))  # psi(n) = h[n - 1] - gamma
    total = 0.0
    for xi, yi in zip(x, y):
        same = np.sort(np.abs(x[y == yi] - xi))
        kk = min(k, len(same) - 1)
        r = same[kk]  # itself comes first
        m = (np.abs(x - xi) < r).sum() if r else (x == xi).sum()
        total += h[kk - 1] - h[len(same) - 1] - h[m - 1]
    return max(0.0, h[len(x) - 1] + total / len(x))


@pytest.mark.parametrize("partitions", [8, 40])
def test_neighbour_information_against_all_pairs(spark, partitions):
    rng = np.random.default_rng(6)
    n = 700
    y = rng.choice(["a", "b", "c", "rare"], n, p=[.6, .3, .099, .001])
    y[:3] = ["one", "two", "two"]
    a = np.where(y == "a", 0, 3) + rng.integers(-2560, 2560, n) / 1024  # exact differences
    hot = np.where(rng.random(n) < .4, 7.0, rng.integers(0, 9, n))      # a hot value
    noise = rng.integers(0, 10 ** 6, n).astype(float)
    rows = [(str(c), float(p), float(q), float(r)) for c, p, q, r in zip(y, a, hot, noise)]
    rows += [(None, 1.0, 1.0, 1.0), ("a", None, None, float("nan"))]
    df = spark.createDataFrame(rows, "y string, a double, hot double, noise double")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = {r.feature: r.mi for r in S.mutual_information(df, ["a", "hot", "noise"], "y").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for name, x in (("a", a), ("hot", hot), ("noise", noise)):
        assert got[name] == pytest.approx(_neighbour_mi(x, y), abs=1e-9), name
    assert got["a"] > 0.2 > got["noise"]


def test_neighbour_information_edges(spark):
    none = spark.createDataFrame([], "y string, a double")
    assert [tuple(r) for r in S.mutual_information(none, ["a"], "y").collect()] == [("a", 0.0)]
    with pytest.raises(ValueError):
        S.mutual_information(none, ["a"], "y", estimator="magic")


def test_balanced_weights_change_forests(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(rng.normal(2.0 if i % 12 == 0 else 0.0, 1.5)), int(i % 12 == 0)) for i in range(600)]
    df = spark.createDataFrame(rows, "k long, a double, y int")

    def share(hp):
        m = M.train(df, ["a"], "y", "random_forest", "classification", {"n_estimators": 10, "max_depth": 4} | hp)
        return M.predict(m, df, ["k"], "y").agg(F.avg(F.col("prediction"))).first()[0]

    assert share({"class_weight": "balanced"}) > share({}) + 0.1
    best, results, _ = M.grid_search(df, ["a"], "y", ["k"], "random_forest", "classification", {"max_depth": [4]}, 3,
                                     hyperparameters={"n_estimators": 10, "class_weight": "balanced"}, scoring="recall")
    plain = M.grid_search(df, ["a"], "y", ["k"], "random_forest", "classification", {"max_depth": [4]}, 3,
                          hyperparameters={"n_estimators": 10}, scoring="recall")[1]
    assert results.first()["mean_score"] < plain.first()["mean_score"] - 0.02  # more rows are called positive


def test_rbf_svm_separates_rings(spark, tmp_path):
    rng = np.random.default_rng(2)
    angle, ring = rng.uniform(0, 2 * np.pi, 500), np.arange(500) % 2
    radius = 1 + 2 * ring + rng.normal(0, .1, 500)
    rows = [(i, float(r * np.cos(a)), float(r * np.sin(a)), int(y)) for i, (r, a, y) in enumerate(zip(radius, angle, ring))]
    df = spark.createDataFrame(rows, "k long, a double, b double, y int")

    def right(model):
        return M.predict(model, df, ["k"], "y").agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0]

    model = M.train(df, ["a", "b"], "y", "svm", "classification", {"C": 10.0, "max_iter": 100})
    assert right(model) > 0.98
    assert right(M.train(df, ["a", "b"], "y", "svm", "classification", {"kernel": "linear", "max_iter": 50})) < 0.7
    M.save_model(model, str(tmp_path / "rings"))
    again = M.load_model(str(tmp_path / "rings"))
    one, two = ([tuple(r) for r in M.predict(m, df, ["k"], "y").select("k", "prediction").orderBy("k").collect()]
                for m in (model, again))
    assert one == two
    with pytest.raises(ValueError):
        M.train(df, ["a", "b"], "y", "svm", "classification", {"kernel": "poly"})


def test_fourier_features_approximate_the_kernel(spark):
    from pyspark.ml.feature import VectorAssembler
    from tabforge.ml.kernel import RandomFourierFeatures
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (40, 3))
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(
        spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "k long, a double, b double, c double"))
    exact = np.exp(-0.4 * ((x[:, None] - x[None]) ** 2).sum(2))
    for size in (256, 4096):
        out = RandomFourierFeatures(size=3, gamma=0.4, components=size, seed=5).transform(df).orderBy("k").collect()
        z = np.array([r.kernel_features.toArray() for r in out])
        assert np.sqrt(((z @ z.T - exact) ** 2).mean()) < 1 / np.sqrt(size)


def test_scoring_job_uses_the_metadata(spark, planted):
    m = M.train(planted, ["a", "b"], "y", "logistic_regression", "classification", {"C": 1.0})
    base = scratch_path(spark, "test-scoring")
    M.save_model(m, f"{base}/m", {"model_type": "logistic_regression", "features": ["a", "b"], "training_date": "2024-05-01"})
    row = spark.read.parquet(Q.scoring_job(spark, f"{base}/m", planted, f"{base}/out", KEY)).first()
    assert row.model_type == "logistic_regression" and row.training_date == "2024-05-01" and row.total_predictions == 400
    with pytest.raises(ValueError, match="needs the columns b"):
        Q.scoring_job(spark, f"{base}/m", planted.drop("b"), f"{base}/out", KEY)


# ---------------------------------------------------------------- full EDA report

def test_full_report_agrees_with_the_single_operators(spark, tmp_path):
    """Every section against the operator it stands for; report and summary are written."""
    from tabforge.operators import assoc, profile, report
    from tabforge.sources.files import save_eda_report
    rnd = np.random.default_rng(8)
    rows = [(float(x), float(x * 2 + rnd.normal()), None if i % 7 == 0 else "pqr"[i % 3], "uv"[int(x > 0)], int(x + rnd.normal() > 0))
            for i, x in enumerate(rnd.normal(size=300))]
    df = spark.createDataFrame(rows, "a double, b double, s string, t string, y int").cache()
    rep, summary = report.full_report(df, "y")
    got = {(r.section, r.feature, r.stat): r.value for r in rep.collect()}
    assert len(got) == rep.count()
    for r in assoc.cramers_v_matrix(df, ["s", "t"]).collect():
        assert got["cramers", f"{r.feature1}|{r.feature2}", "cramers_v"] == r.cramers_v
    for r in assoc.target_association(df, "y", ["s", "t"]).collect():
        assert got["association", r.feature, "cramers_v"] == pytest.approx(r.cramers_v)
    for r in assoc.spearman_matrix(df, ["a", "b"]).collect():
        assert got["spearman", "a|b", "correlation"] == pytest.approx(r.correlation)
    for r in profile.crosstab_pct(df, "y", ["s", "t"]).collect():
        key = f"{r.feature}={r.value}|{r.target}"
        assert got["crosstab", key, "n"] == r.n and got["crosstab", key, "pct"] == pytest.approx(r.pct)
    importance = {r.feature: r.mi for r in S.feature_importance(df, "y", ["s", "t"], ["a", "b"]).collect()}
    assert {k[1]: v for k, v in got.items() if k[0] == "importance"} == pytest.approx(importance)
    assert got["level", "s", "n"] == 43 and got["univariate", "s", "n_unique"] == 3
    line = summary.first()
    assert line.n_high_correlations == 1 and line.top_features.split(",")[0] == max(importance, key=importance.get)
    paths = save_eda_report(rep, str(tmp_path), summary)
    assert spark.read.parquet(paths["full_parquet"]).count() == len(got)
    assert spark.read.json(paths["summary"]).first().top_features == line.top_features


def test_full_report_without_target_or_categories(spark):
    from tabforge.operators import report
    rep, summary = report.full_report(spark.createDataFrame([(1.0, 2), (2.0, 4), (4.0, 8)], "a double, b int"))
    assert {r.section for r in rep.select("section").distinct().collect()} == {"overview", "missing", "describe", "shape",
                                                                               "correlation", "spearman"}
    assert tuple(summary.first()) == (1, 0, "")
