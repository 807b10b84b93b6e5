"""Model registry views (section P): leaderboard, recommendation, current model.

The reference serves these from metric files; here the registry is a table with one
row per model (model_type, accuracy, precision, recall, f1_score, training_date),
built from evaluation output.  It holds one row per registered model, so the
windows below run over a bounded table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.metrics import model_comparison

# Fixed recommendation confidence cut-offs of the reference.
HIGH_CONFIDENCE = 0.8
MEDIUM_CONFIDENCE = 0.7


def leaderboard(metrics_long: DataFrame, trained: DataFrame) -> DataFrame:
    """Wide leaderboard from long metrics (model, metric, value) and a (model,
    training_date) table."""
    wide = metrics_long.groupBy("model").agg(*[
        F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m)
        for m in ["accuracy", "precision", "recall", "f1_score"]])
    return wide.join(trained, "model").select(F.col("model").alias("model_type"), "accuracy", "precision",
                                              "recall", "f1_score", "training_date")


def leaderboard_from_predictions(spark, sf_dir: str) -> DataFrame:
    """Registry of the rule models over orders; a model's training date is the last
    order date plus one hour per model (in name order)."""
    from ..plans.fixtures import order_models, table
    long, _ = model_comparison(order_models(spark, sf_dir))
    last = table(spark, sf_dir, "orders").agg(F.max("o_orderdate").alias("t"))
    models = long.select("model").distinct()
    w = Window.orderBy("model")  # one row per model: bounded
    # models and last are both tiny (one row per model / one row): a scalar join.
    trained = models.select("model", F.row_number().over(w).alias("_h")).join(F.broadcast(last)).select(
        "model", (F.col("t") + F.make_dt_interval(hours=F.col("_h"))).alias("training_date"))
    return leaderboard(long, trained)


METRICS_SCHEMA = "accuracy double, precision double, recall double, f1_score double"


def read_registry(spark, registry_dir: str) -> DataFrame:
    """Leaderboard from registry rows written by :func:`tabforge.ml.models.save_model`
    (one JSON row per saved model; ``evaluation_metrics`` is a JSON string)."""
    reg = spark.read.schema("model_path string, model_type string, problem_type string, training_date string, "
                            "dataset_size bigint, features_count int, evaluation_metrics string") \
        .json(registry_dir)
    m = F.from_json("evaluation_metrics", METRICS_SCHEMA)
    return reg.select("model_type", m["accuracy"].alias("accuracy"), m["precision"].alias("precision"),
                      m["recall"].alias("recall"), m["f1_score"].alias("f1_score"),
                      F.to_timestamp("training_date").alias("training_date"), "model_path",
                      "dataset_size", "features_count")


def recommend(lb: DataFrame) -> DataFrame:
    """Highest accuracy (> 0), confidence label, improvement % over the runner-up (0 if none)."""
    w = Window.orderBy(F.col("accuracy").desc(), F.col("model_type"))
    r = lb.where(F.col("accuracy") > 0).select("model_type", "accuracy", F.row_number().over(w).alias("rn"),
                                               F.lead("accuracy").over(w).alias("runner_up"))
    conf = (F.when(F.col("accuracy") > HIGH_CONFIDENCE, "high").when(F.col("accuracy") > MEDIUM_CONFIDENCE, "medium")
            .otherwise("low"))
    imp = F.coalesce(F.try_divide(F.col("accuracy") - F.col("runner_up"), F.col("runner_up")) * 100, F.lit(0.0))
    return r.where(F.col("rn") == 1).select(F.col("model_type").alias("recommended_model"), "accuracy",
                                            conf.alias("confidence"), imp.alias("improvement_pct"))


def current_model(lb: DataFrame) -> DataFrame:
    """Latest model with version id ``<name>_vYYYYMMDD_HHMM``."""
    best = lb.agg(F.max_by(F.struct("model_type", "training_date"), "training_date").alias("m")).select("m.*")
    return best.select("model_type", "training_date",
                       F.concat(F.col("model_type"), F.lit("_v"),
                                F.date_format("training_date", "yyyyMMdd_HHmm")).alias("version_id"))
