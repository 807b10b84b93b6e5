"""Queries for model training, evaluation loops, scoring and composed jobs
(sections M, N10, N11, I3, O, Q).  Iterative / randomised fits are checked by rows
only; the deterministic re-applied preprocessing (O4) has an SQL oracle."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stats import r6
from ..ml import models as M
from ..ml.scoring import Preprocessor, batch_predict, infer
from ..operators.impute import fit_impute
from ..operators.scale import fit_scaler
from ..session import scratch_path
from ..sources.files import save_predictions
from ..streaming.score_stream import run_scoring_stream
from . import jobs as Q
from .catalog import query
from .fixtures import c360, order_preds, with_views

FEATS = ["acctbal", "tenure_months", "n_orders", "total_charges", "avg_charges", "returned_items"]
KEY = ["customer_id"]


def _c360_split(spark, d):
    from ..operators.split import split
    df = c360(spark, d).select(*KEY, *FEATS, "churn")
    s = split(df, KEY, 0.2, 42, stratify_by="churn")
    return s.where(~F.col("is_test")).drop("is_test"), s.where(F.col("is_test")).drop("is_test")


def _fit_eval(spark, d, model_type, hp, problem="classification", label="churn", feats=FEATS):
    tr, te = _c360_split(spark, d)
    m = M.train(tr, feats, label, model_type, problem, hp)
    return M.evaluate(m, te, KEY, label, problem).select("metric", r6(F.col("value")).alias("value"))


@query("train_rf")
def train_rf(spark, d):
    return _fit_eval(spark, d, "random_forest", Q.RF_PARAMS)


@query("train_logreg")
def train_logreg(spark, d):
    return _fit_eval(spark, d, "logistic_regression", Q.LR_PARAMS)


@query("train_svm")
def train_svm(spark, d):
    return _fit_eval(spark, d, "svm", {"C": 1.0, "max_iter": 200})


REG_FEATS = ["acctbal", "tenure_months", "n_orders", "returned_items"]


@query("train_rf_reg")
def train_rf_reg(spark, d):
    return _fit_eval(spark, d, "random_forest", {"n_estimators": 50, "max_depth": 8}, "regression",
                     "total_charges", REG_FEATS)


@query("train_linreg")
def train_linreg(spark, d):
    return _fit_eval(spark, d, "linear_regression", {}, "regression", "total_charges", REG_FEATS)


@query("grid_search")
def grid_search(spark, d):
    tr, _ = _c360_split(spark, d)
    _, results, _ = M.grid_search(tr, FEATS, "churn", KEY, "random_forest", "classification",
                                  {"n_estimators": [20, 50], "max_depth": [4, 8]}, cv_folds=3)
    return results


@query("model_roundtrip")
def model_roundtrip(spark, d):
    tr, te = _c360_split(spark, d)
    m = M.train(tr, FEATS, "churn", "logistic_regression", "classification", Q.LR_PARAMS)
    base = scratch_path(spark, "model")
    M.save_model(m, f"{base}/model", {"model_type": "logistic_regression", "features_count": len(FEATS)},
                 registry_dir=f"{base}/registry")
    back = M.load_model(f"{base}/model")
    return M.predict(back, te, KEY, "churn").drop("probability")


@query("rfe_select")
def rfe_select(spark, d):
    tr, _ = _c360_split(spark, d)
    chosen = M.rfe_select(tr, FEATS, "churn", 3, n_trees=30)
    # chosen is at most k names.
    return spark.createDataFrame([(x, FEATS.index(x)) for x in chosen], "feature string, position int")


@query("cross_validate")
def cross_validate(spark, d):
    df = c360(spark, d).select(*KEY, *FEATS, "churn")
    cv = M.cross_validate(df, FEATS, "churn", KEY, "logistic_regression", "classification",
                          {"C": 1.0, "max_iter": 100}, cv_folds=3)
    return cv.select("fold", "side", "metric", r6(F.col("value")).alias("value"))


_FOLDED = """folded AS (SELECT x, y, (row_number() OVER (ORDER BY md5(concat(k, '|42')), k) - 1) % 4 AS fold
FROM (SELECT CAST(customer_id AS VARCHAR) AS k, n_orders AS x, total_charges AS y FROM c360)),
fits AS (SELECT f.fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM folded t
  JOIN (SELECT DISTINCT fold FROM folded) f ON t.fold <> f.fold GROUP BY f.fold),
scored AS (SELECT f.fold, CASE WHEN t.fold = f.fold THEN 'test' ELSE 'train' END AS side, y, y - a - b * x AS e
  FROM folded t, fits f)"""


@query("cross_validate_linear", with_views(["c360"], f"""SELECT * FROM (WITH {_FOLDED}
SELECT CAST(fold AS INTEGER) AS fold, side, round(avg(abs(e)) / 1000, 6) AS mae,
  round(1 - sum(e * e) / (var_pop(y) * count(y)), 6) AS r2 FROM scored GROUP BY fold, side)"""))
def cross_validate_linear(spark, d):
    """N10 for least squares: mean absolute error (in thousands) and r2 of all folds."""
    df = c360(spark, d).select(F.col("customer_id").cast("string").alias("k"), "n_orders", "total_charges")
    cv = M.cross_validate(df, ["n_orders"], "total_charges", ["k"], "linear_regression", "regression", {}, cv_folds=4)
    one = {m: F.max(F.when(F.col("metric") == m, F.col("value"))) for m in ("mae", "r2")}
    return cv.where("fold >= 0").groupBy("fold", "side").agg(r6(one["mae"] / 1000).alias("mae"), r6(one["r2"]).alias("r2"))


@query("learning_curve")
def learning_curve(spark, d):
    df = c360(spark, d).select(*KEY, *FEATS, "churn")
    lc = M.learning_curve(df, FEATS, "churn", KEY, "logistic_regression", "classification",
                          [0.25, 0.5, 0.75, 1.0], cv_folds=3)
    return lc.select("train_size", "side", r6(F.col("mean")).alias("mean"), r6(F.col("std")).alias("std"))


@query("predict")
def predict_q(spark, d):
    tr, _ = _c360_split(spark, d)
    m = M.train(tr, FEATS, "churn", "random_forest", "classification", {"n_estimators": 30, "max_depth": 6})
    all_rows = c360(spark, d).select(*KEY, *FEATS)
    return M.predict(m, all_rows, KEY)


@query("batch_predict")
def batch_predict_q(spark, d):
    tr, _ = _c360_split(spark, d)
    m = M.train(tr, FEATS, "churn", "logistic_regression", "classification", Q.LR_PARAMS)
    base = scratch_path(spark, "batch")
    M.save_model(m, f"{base}/model")
    c360(spark, d).select(*KEY, *FEATS).write.mode("overwrite").parquet(f"{base}/input")
    out = batch_predict(spark, f"{base}/model", f"{base}/input", f"{base}/output", KEY, batch_size=1000)
    return spark.read.parquet(out)


@query("save_predictions")
def save_predictions_q(spark, d):
    p = order_preds(spark, d).select("key", "prediction",
                                     F.array(1 - F.col("score"), F.col("score")).alias("probability"))
    out = save_predictions(p, scratch_path(spark, "preds"), ["key"], "prediction", "probability", 2)
    return spark.read.parquet(out)


@query("infer")
def infer_q(spark, d):
    tr, te = _c360_split(spark, d)
    pre = Preprocessor({"impute": fit_impute(tr, "mean", numeric_cols=FEATS, categorical_cols=[])})
    m = M.train(pre.apply(tr), FEATS, "churn", "logistic_regression", "classification", Q.LR_PARAMS)
    path = M.save_model(m, scratch_path(spark, "infer-model"))
    return infer(path, te.select(*KEY, *FEATS), KEY, pre).drop("probability")


APPLY_COLS = ["acctbal", "total_charges", "avg_discount"]


def _apply_params_sql() -> str:
    imp = ", ".join(["acctbal", "total_charges",
                     "coalesce(avg_discount, (SELECT avg(avg_discount) FROM c360)) AS avg_discount"])
    cols = ", ".join(f"round(({x} - (SELECT avg({x}) FROM imp)) / (SELECT CASE WHEN stddev_pop({x}) = 0 "
                     f"THEN 1.0 ELSE stddev_pop({x}) END FROM imp), 6) AS {x}" for x in APPLY_COLS)
    return with_views(["c360"], f"""SELECT * FROM (WITH imp AS (SELECT customer_id, {imp} FROM c360)
SELECT customer_id, {cols} FROM imp)""")


@query("apply_params", _apply_params_sql())
def apply_params(spark, d):
    """O4: fit impute + scale, save the bundle, load it back and re-apply."""
    df = c360(spark, d).select("customer_id", *APPLY_COLS)
    pre = Preprocessor({"impute": fit_impute(df, "mean", numeric_cols=APPLY_COLS, categorical_cols=[])})
    pre.tables["scale"] = fit_scaler(pre.apply(df), "standard", APPLY_COLS)
    path = pre.save(scratch_path(spark, "preprocessor"))
    back = Preprocessor.load(spark, path)
    out = back.apply(df)
    return out.select("customer_id", *[r6(F.col(x)).alias(x) for x in APPLY_COLS])


@query("churn_training_job")
def churn_training_job(spark, d):
    """Q1 end to end; returns test metrics and the CV summary (fold -1 mean, -2 std)."""
    res = Q.churn_training_job(spark, d, scratch_path(spark, "training-job"))
    test = res.metrics.select("model", F.lit("test").alias("side"), F.lit(None).cast("int").alias("fold"),
                              "metric", "value")
    cv = res.cv.where(F.col("fold") < 0).select("model", "side", "fold", "metric", "value")
    return test.unionByName(cv).select("model", "side", "fold", "metric", r6(F.col("value")).alias("value"))


@query("validation_job")
def validation_job(spark, d):
    tr, te = _c360_split(spark, d)
    m = M.train(tr, FEATS, "churn", "random_forest", "classification", {"n_estimators": 30, "max_depth": 6})
    path = M.save_model(m, scratch_path(spark, "validation-model"))
    out = Q.validation_job(path, te, KEY, "churn")
    return out["report"].select("row", *[r6(F.col(x)).alias(x) for x in ["precision", "recall", "f1"]], "support")


STREAM_SCHEMA = T.StructType([T.StructField("customer_id", T.LongType())] +
                             [T.StructField(x, T.DoubleType()) for x in FEATS])


@query("stream_score")
def stream_score(spark, d):
    """Q6: land the table as several files, score them with an availableNow stream."""
    tr, _ = _c360_split(spark, d)
    m = M.train(tr, FEATS, "churn", "logistic_regression", "classification", Q.LR_PARAMS)
    base = scratch_path(spark, "stream")
    rows = c360(spark, d).select(F.col("customer_id").cast("long").alias("customer_id"),
                                 *[F.col(x).cast("double").alias(x) for x in FEATS])
    rows.repartition(4, "customer_id").write.mode("overwrite").parquet(f"{base}/landing")
    run_scoring_stream(spark, m, f"{base}/landing", f"{base}/scored", f"{base}/checkpoint", STREAM_SCHEMA, KEY)
    return spark.read.parquet(f"{base}/scored").drop("prediction_timestamp")


@query("scoring_job")
def scoring_job(spark, d):
    """Q2: saved model -> predictions with class probabilities and metadata."""
    tr, _ = _c360_split(spark, d)
    m = M.train(tr, FEATS, "churn", "random_forest", "classification", {"n_estimators": 30, "max_depth": 6})
    base = scratch_path(spark, "scoring-job")
    path = M.save_model(m, f"{base}/model")
    out = Q.scoring_job(spark, path, c360(spark, d).select(*KEY, *FEATS), f"{base}/predictions", KEY)
    return spark.read.parquet(out).drop("prediction_timestamp")


_TEST_ROWS = with_views(["c360"], """SELECT CAST(sum(ceil(CAST(0.3 AS DOUBLE) * n)) AS BIGINT) AS n_test,
CAST(0 AS BIGINT) AS n_different FROM (SELECT churn, count(*) AS n FROM c360 GROUP BY churn)""")


@query("train_then_infer", _TEST_ROWS)
def train_then_infer(spark, d):
    """The training job's saved model and preprocessor, loaded again and applied to raw
    rows, predict what the job predicted: test rows and how many differ (0)."""
    base = scratch_path(spark, "train-then-infer")
    res = Q.churn_training_job(spark, d, base, model_types=("logistic_regression",), cv_folds=None, eda=False)
    raw = res.source.join(res.predictions.select(*KEY), KEY, "left_semi")
    back = infer(f"{base}/models/logistic_regression", raw, KEY, Preprocessor.load(spark, f"{base}/preprocessor"))
    both = res.predictions.select(*KEY, F.col("prediction").alias("told")).join(
        back.select(*KEY, F.col("prediction").cast("int").alias("got")), KEY, "left")
    return both.agg(F.count(F.lit(1)).alias("n_test"),
                    F.count_if(~F.col("told").eqNullSafe(F.col("got"))).alias("n_different"))
