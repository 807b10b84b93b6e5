"""Model training, tuning, persistence and cross-validation on Spark ML (section M,
N10, N11, I3).

Parameter mapping from the reference's estimator arguments:

* random forest: n_estimators -> numTrees, max_depth -> maxDepth (None -> 30, Spark's
  limit; more raises), min_samples_leaf -> minInstancesPerNode, random_state -> seed,
  feature subset 'sqrt' (classifier) / 'all' (regressor); min_samples_split has no
  Spark equivalent and is accepted without effect.  Unknown arguments raise.
* logistic regression / linear SVM: C -> regParam = 1 / (C * n) (scikit-learn sums
  the loss, Spark averages it), max_iter -> maxIter, class_weight='balanced' -> a
  weight column n / (k * n_class).  The SVM's kernel is ``rbf`` by default (``gamma``: scale,
  auto or a number), by ``n_components`` random Fourier features before a linear SVM
  (:mod:`.kernel`; the kernel's error falls with the root of their number), or ``linear``; more than
  two classes use one-vs-rest.
* linear regression: ordinary least squares (regParam 0, normal equations); its cross-validation and
  learning curve need no fit per subset (:mod:`.linear_folds`).

Every fit is a distributed Spark ML job; only loops over a bounded number of fits
(folds, grid points, RFE steps) run on the driver.
"""

from __future__ import annotations

import datetime as _dt
import json
import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import c
from ..operators.metrics import balanced_weights, model_comparison
from ..operators.split import assign_folds, hash_positions
from ..session import ensure_checkpoint_dir, materialise, reliable_checkpoint
from .kernel import RandomFourierFeatures, default_gamma
from .linear_folds import curve_scores, fold_scores

CLASSIFIERS = ("random_forest", "logistic_regression", "svm")
REGRESSORS = ("random_forest", "linear_regression")
MAX_SPARK_DEPTH = 30
HYPERPARAMETERS = {
    "random_forest": {"n_estimators", "max_depth", "min_samples_split", "min_samples_leaf", "random_state",
                      "max_memory_mb", "class_weight"},
    "logistic_regression": {"C", "max_iter", "class_weight", "random_state"},
    "svm": {"C", "max_iter", "class_weight", "random_state", "kernel", "gamma", "n_components"},
    "linear_regression": set(),
}


SCORING = {"classification": {"accuracy": "accuracy", "f1": "f1", "precision": "weightedPrecision",
                              "recall": "weightedRecall"},
           "regression": {x: x for x in ("mse", "rmse", "mae", "r2")}}


class UnsupportedModelError(ValueError):
    pass


def _check(model_type: str, problem_type: str):
    if problem_type == "classification" and model_type not in CLASSIFIERS:
        raise UnsupportedModelError(f"Unsupported classification model: {model_type}")
    if problem_type == "regression" and model_type not in REGRESSORS:
        raise UnsupportedModelError(f"Unsupported regression model: {model_type}")
    if problem_type not in ("classification", "regression"):
        raise UnsupportedModelError(f"Unsupported problem type: {problem_type}")


def _rbf(model_type: str, hp: dict | None) -> bool:
    kernel = (hp or {}).get("kernel", "rbf")
    if kernel not in ("rbf", "linear"):
        raise ValueError(f"Unknown kernel: {kernel}")
    return model_type == "svm" and kernel == "rbf"


def _stages(df: DataFrame, features: list[str], model_type: str, hp: dict | None, est, invalid: str) -> list:
    """Assembler, the kernel's features for an RBF SVM, estimator."""
    stages = [VectorAssembler(inputCols=features, outputCol="features", handleInvalid=invalid)]
    if _rbf(model_type, hp):
        hp = hp or {}
        stages.append(RandomFourierFeatures(
            size=len(features), gamma=default_gamma(df, [c(x) for x in features], hp.get("gamma", "scale")),
            components=int(hp.get("n_components", 256)), seed=int(hp.get("random_state", 42))))
    return [*stages, est]


def build_estimator(model_type: str, problem_type: str, hp: dict | None, n_rows: int,
                    n_classes: int = 2, label: str = "label", weight_col: str | None = None):
    _check(model_type, problem_type)
    hp = dict(hp or {})
    unknown = set(hp) - HYPERPARAMETERS[model_type]
    if unknown:
        raise ValueError(f"Unknown arguments for {model_type}: {', '.join(sorted(unknown))}")
    seed = int(hp.get("random_state", 42))
    common = {"featuresCol": "kernel_features" if _rbf(model_type, hp) else "features", "labelCol": label}
    wkw = {"weightCol": weight_col} if weight_col else {}
    if model_type == "random_forest":
        depth = hp.get("max_depth")
        if depth is not None and int(depth) > MAX_SPARK_DEPTH:
            raise ValueError(f"max_depth {depth}: Spark's trees have at most {MAX_SPARK_DEPTH} levels")
        kw = dict(numTrees=int(hp.get("n_estimators", 100)),
                  maxDepth=MAX_SPARK_DEPTH if depth is None else int(depth),
                  minInstancesPerNode=int(hp.get("min_samples_leaf", 1)), seed=seed,
                  maxMemoryInMB=int(hp.get("max_memory_mb", 1024)),
                  # Node ids are cached on the executors (checkpointed every 10 iterations)
                  # instead of shipping the growing trees each level: same model, ~2x faster.
                  cacheNodeIds=True, checkpointInterval=10, **wkw, **common)
        if problem_type == "classification":
            return RandomForestClassifier(featureSubsetStrategy="sqrt", **kw)
        return RandomForestRegressor(featureSubsetStrategy="all", **kw)
    if model_type == "linear_regression":
        return LinearRegression(regParam=0.0, solver="normal", **common)
    reg = 1.0 / (float(hp.get("C", 1.0)) * max(n_rows, 1))
    if model_type == "logistic_regression":
        return LogisticRegression(regParam=reg, elasticNetParam=0.0, standardization=False,
                                  maxIter=int(hp.get("max_iter", 1000)), **wkw, **common)
    svc = LinearSVC(regParam=reg, maxIter=int(hp.get("max_iter", 1000)), tol=1e-3,  # tolerance as scikit-learn's SVC
                    standardization=False, **wkw, **common)
    return svc if n_classes <= 2 else OneVsRest(classifier=svc, **wkw, **common)


def _weighted(df: DataFrame, label: str, problem_type: str, hp: dict | None) -> tuple[DataFrame, str | None]:
    """``df`` with the balanced class weights and their column's name, when asked for."""
    if (hp or {}).get("class_weight") == "balanced" and problem_type == "classification":
        return balanced_weights(df, label, "_class_weight"), "_class_weight"
    return df, None


def train(df: DataFrame, features: list[str], label: str, model_type: str = "random_forest",
          problem_type: str = "classification", hyperparameters: dict | None = None) -> PipelineModel:
    """Fit ``VectorAssembler -> estimator``.  Feature columns must be numeric and
    imputed (see :mod:`tabforge.operators.impute`)."""
    _check(model_type, problem_type)
    ensure_checkpoint_dir(df.sparkSession)  # tree fits checkpoint their node-id cache
    hp = dict(hyperparameters or {})
    stats = df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(c(label)).alias("k")).first()
    data, weight_col = _weighted(df, label, problem_type, hp)
    est = build_estimator(model_type, problem_type, hp, stats["n"], stats["k"], label, weight_col)
    return Pipeline(stages=_stages(data, features, model_type, hp, est, "error")).fit(data)


def predict(model: PipelineModel, df: DataFrame, key_cols: list[str], label: str | None = None,
            return_probabilities: bool = True) -> DataFrame:
    """(key..., [label], prediction, [probability array, p1])."""
    out = model.transform(df)
    cols = [c(k) for k in key_cols]
    if label:
        cols.append(c(label).alias("label"))
    cols.append(F.col("prediction"))
    if return_probabilities and "probability" in out.columns:
        arr = vector_to_array(F.col("probability"))
        cols += [arr.alias("probability"), arr[1].alias("score")]
    return out.select(*cols)


def class_list(model: PipelineModel) -> list[float]:
    """The class that each place of ``probability`` stands for."""
    return [float(i) for i in range(getattr(model.stages[-1], "numClasses", 0))]


def evaluate(model: PipelineModel, df: DataFrame, key_cols: list[str], label: str,
             problem_type: str = "classification") -> DataFrame:
    """Long metrics (metric, value) of one model on one table."""
    pred = predict(model, df, key_cols, label).withColumn("model", F.lit("m"))
    has_score = "score" in pred.columns and problem_type == "classification"
    long, _ = model_comparison(pred.withColumn("prediction", F.col("prediction").cast("double"))
                               .withColumn("label", F.col("label").cast("double")), "model", "label",
                               "prediction", "score" if has_score else None, problem_type)
    return long.drop("model")


def save_model(model: PipelineModel, path: str, metadata: dict | None = None,
               registry_dir: str | None = None) -> str:
    """Write the pipeline (overwrite) and, with ``registry_dir``, append one registry
    row (model_type, problem_type, training_date, metrics JSON ...)."""
    model.write().overwrite().save(path)
    spark = SparkSession.getActiveSession()
    meta = dict(metadata or {})
    spark.createDataFrame([(json.dumps({**meta, "classes": class_list(model)}, default=str),)], "meta string") \
        .write.mode("overwrite").text(f"{path.rstrip('/')}_metadata")
    if registry_dir is not None:
        row = {"model_path": path,
               "model_type": str(meta.get("model_type", "unknown")),
               "problem_type": str(meta.get("problem_type", "classification")),
               "training_date": meta.get("training_date") or _dt.datetime.now(_dt.timezone.utc).isoformat(),
               "dataset_size": int(meta.get("dataset_size", 0)),
               "features_count": int(meta.get("features_count", 0)),
               "evaluation_metrics": json.dumps(meta.get("evaluation_metrics", {}))}
        spark.createDataFrame([row]).write.mode("append").json(registry_dir)
    return path


def load_model(path: str) -> PipelineModel:
    """Load a saved pipeline; a missing path raises."""
    return PipelineModel.load(path)


def load_metadata(spark: SparkSession, path: str) -> dict:
    """What :func:`save_model` was told about the model, and its class list."""
    return json.loads(spark.read.text(f"{path.rstrip('/')}_metadata").where("value <> ''").first()[0])


def grid_search(df: DataFrame, features: list[str], label: str, key_cols: list[str],
                model_type: str = "random_forest", problem_type: str = "classification",
                param_grid: dict | None = None, cv_folds: int = 5, seed: int = 42,
                parallelism: int = 2, scoring: str | None = None, hyperparameters: dict | None = None):
    """k-fold grid search (deterministic hash folds), refit of the best model on all
    rows.  ``scoring``: accuracy, f1, precision, recall (weighted) or mse, rmse, mae, r2;
    ``hyperparameters`` are the fixed ones.  Returns (best PipelineModel, results
    DataFrame(params, mean_score), best params)."""
    _check(model_type, problem_type)
    stats = df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(c(label)).alias("k")).first()
    data, weight_col = _weighted(df, label, problem_type, hyperparameters)
    est = build_estimator(model_type, problem_type, hyperparameters, stats["n"], stats["k"], label, weight_col)
    pipe = Pipeline(stages=_stages(data, features, model_type, hyperparameters, est, "error"))
    builder = ParamGridBuilder()
    names = {"n_estimators": "numTrees", "max_depth": "maxDepth", "min_samples_leaf": "minInstancesPerNode",
             "max_iter": "maxIter"}
    for k, vals in (param_grid or {}).items():
        if k == "C":
            builder = builder.addGrid(est.regParam, [1.0 / (float(v) * stats["n"]) for v in vals])
        else:
            builder = builder.addGrid(est.getParam(names.get(k, k)), list(vals))
    grid = builder.build()
    # All folds read one cached table instead of ranking the rows again for each.
    folds = assign_folds(data, key_cols, cv_folds, seed,
                         stratify_by=label if problem_type == "classification" else None).cache()
    scoring = scoring or ("accuracy" if problem_type == "classification" else "mse")
    known = SCORING[problem_type]
    if scoring not in known:
        raise ValueError(f"Unknown scoring: {scoring}")
    ev = (MulticlassClassificationEvaluator if problem_type == "classification" else RegressionEvaluator)(
        labelCol=label, metricName=known[scoring])
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=grid, evaluator=ev, numFolds=cv_folds,
                        foldCol="fold", parallelism=parallelism, seed=seed)
    fitted = cv.fit(folds)
    folds.unpersist()
    spark = df.sparkSession
    rows = [(json.dumps({p.name: v for p, v in pm.items()}), float(m)) for pm, m in zip(grid, fitted.avgMetrics)]
    results = spark.createDataFrame(rows, "params string, mean_score double")
    best_i = (max if ev.isLargerBetter() else min)(range(len(rows)), key=lambda i: rows[i][1])
    return fitted.bestModel, results, json.loads(rows[best_i][0])


def _fold_predictions(df, features, label, key_cols, model_type, problem_type, hp, k, seed, parallelism=1):
    folds = reliable_checkpoint(assign_folds(df, key_cols, k, seed,
                                             stratify_by=label if problem_type == "classification" else None))

    def fit(i):
        return train(folds.where(F.col("fold") != i), features, label, model_type, problem_type, hp)

    # Independent fits run as concurrent Spark jobs (like CrossValidator's parallelism).
    if parallelism > 1:
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            models = list(pool.map(fit, range(k)))
    else:
        models = [fit(i) for i in range(k)]
    parts = []
    for i, m in enumerate(models):
        for side, part in (("train", folds.where(F.col("fold") != i)), ("test", folds.where(F.col("fold") == i))):
            parts.append(predict(m, part, key_cols, label).withColumn("model", F.lit(f"{i}|{side}")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, folds


def cross_validate(df: DataFrame, features: list[str], label: str, key_cols: list[str],
                   model_type: str = "random_forest", problem_type: str = "classification",
                   hyperparameters: dict | None = None, cv_folds: int = 5, seed: int = 42,
                   parallelism: int = 1) -> DataFrame:
    """Per-fold train and test scores plus mean and population std per (side, metric):
    (fold, side, metric, value) with fold = -1 for 'mean' and -2 for 'std' rows.  All folds of a
    linear regression come from one pass (:mod:`.linear_folds`)."""
    if model_type == "linear_regression":
        _check(model_type, problem_type)
        build_estimator(model_type, problem_type, hyperparameters, 0)  # unknown arguments raise
        return _with_summary(materialise(fold_scores(assign_folds(df, key_cols, cv_folds, seed), features, label, cv_folds),
                                         "fold-scores"))
    preds, folds = _fold_predictions(df, features, label, key_cols, model_type, problem_type,
                                     hyperparameters, cv_folds, seed, parallelism)
    # All fold predictions are materialised once (reliable checkpoint) before the
    # grouped metrics, which read them several times.
    preds = preds.withColumn("prediction", F.col("prediction").cast("double")) \
        .withColumn("label", F.col("label").cast("double")).transform(reliable_checkpoint)
    long, _ = model_comparison(preds, "model", "label", "prediction",
                               "score" if problem_type == "classification" else None, problem_type)
    per = long.select(F.split("model", r"\|")[0].cast("int").alias("fold"),
                      F.split("model", r"\|")[1].alias("side"), "metric", "value")
    return _with_summary(per)


def _with_summary(per: DataFrame) -> DataFrame:
    summ = per.groupBy("side", "metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
    return per.unionByName(summ.select(F.lit(-1).alias("fold"), "side", "metric", F.col("mean").alias("value"))) \
        .unionByName(summ.select(F.lit(-2).alias("fold"), "side", "metric", F.col("std").alias("value")))


def learning_curve(df: DataFrame, features: list[str], label: str, key_cols: list[str],
                   model_type: str = "logistic_regression", problem_type: str = "classification",
                   train_sizes: list[float] | None = None, cv_folds: int = 5, seed: int = 42,
                   metric: str = "accuracy", parallelism: int = 4) -> DataFrame:
    """For each train fraction and fold: fit on the first ``ceil(size * n)`` rows (hash
    order) of the fold's training part, score that subset and the test fold.
    Returns (train_size, side, mean, std) over folds."""
    sizes = train_sizes or [round(0.1 * i, 1) for i in range(1, 11)]
    if model_type == "linear_regression":
        return _linear_curve(df, features, label, key_cols, sizes, cv_folds, seed, metric, problem_type)
    folds = reliable_checkpoint(assign_folds(df, key_cols, cv_folds, seed,
                                             stratify_by=label if problem_type == "classification" else None))
    tasks = []
    for i in range(cv_folds):
        tr_all = reliable_checkpoint(hash_positions(folds.where(F.col("fold") != i), key_cols, seed + i))
        n_i = tr_all.count()
        for s in sizes:
            tr = tr_all.where(F.col("_pos") < int(math.ceil(s * n_i))).drop("_pos")
            tasks.append((s, i, tr, folds.where(F.col("fold") == i)))

    def fit(t):
        return train(t[2], features, label, model_type, problem_type)

    if parallelism > 1:
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            models = list(pool.map(fit, tasks))
    else:
        models = [fit(t) for t in tasks]
    parts = []
    for (s, i, tr, te), m in zip(tasks, models):
        for side, part in (("train", tr), ("test", te)):
            parts.append(predict(m, part, key_cols, label).withColumn("model", F.lit(f"{s}|{i}|{side}")))
    preds = parts[0]
    for p in parts[1:]:
        preds = preds.unionByName(p)
    preds = preds.withColumn("prediction", F.col("prediction").cast("double")) \
        .withColumn("label", F.col("label").cast("double")).transform(reliable_checkpoint)
    long, _ = model_comparison(preds, "model", "label", "prediction", None, problem_type)
    per = long.where(F.col("metric") == metric).select(
        F.split("model", r"\|")[0].cast("double").alias("train_size"),
        F.split("model", r"\|")[2].alias("side"), "value")
    return per.groupBy("train_size", "side").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def _linear_curve(df, features, label, key_cols, sizes, k, seed, metric, problem_type) -> DataFrame:
    """The learning curve of least squares: the same subsets, all models from one pass over their rows."""
    _check("linear_regression", problem_type)
    steps = reliable_checkpoint(assign_folds(df.select(*[c(x) for x in dict.fromkeys([*key_cols, *features, label])]),
                                             key_cols, k, seed))
    n = {r["fold"]: r["count"] for r in steps.groupBy("fold").count().collect()}
    order = sorted(sizes)
    for i in range(k):
        rest = sum(n.values()) - n.get(i, 0)
        steps = hash_positions(steps.withColumn("_tests", F.col("fold") == i), key_cols, seed + i, "_tests", "_pos")
        step = F.lit(len(order))
        for j in reversed(range(len(order))):
            step = F.when(F.col("_pos") < int(math.ceil(order[j] * rest)), j).otherwise(step)
        steps = steps.withColumn(f"_step{i}", F.when(F.col("_tests"), -1).otherwise(step)).drop("_tests", "_pos")
    steps = steps.withColumn("_steps", F.array(*[F.col(f"_step{i}") for i in range(k)]))
    per = curve_scores(steps, features, label, order, k, "_steps").where(F.col("metric") == metric)
    return per.groupBy("train_size", "side").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def rfe_select(df: DataFrame, features: list[str], label: str, k: int, step: int = 1,
               n_trees: int = 50, seed: int = 42) -> list[str]:
    """Recursive feature elimination with forest importances: drop the weakest
    ``step`` features per round until k remain (input order kept)."""
    k = max(1, min(k, len(features)))
    current = list(features)
    data = df.select(*[c(x) for x in features], c(label)).cache()
    while len(current) > k:
        m = train(data, current, label, "random_forest", "classification",
                  {"n_estimators": n_trees, "random_state": seed, "max_depth": 10})
        imp = list(m.stages[-1].featureImportances.toArray())
        drop = min(step, len(current) - k)
        order = sorted(range(len(current)), key=lambda i: (imp[i], current[i]))
        removed = {current[i] for i in order[:drop]}
        current = [x for x in current if x not in removed]
    data.unpersist()
    return [x for x in features if x in current]
