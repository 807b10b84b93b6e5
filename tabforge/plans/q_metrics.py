"""Queries for evaluation metrics and the model registry (sections N and P), on
rule-based prediction tables derived from orders (no fitted model involved)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.stats import r6, rsig
from ..ml import registry as P
from ..operators import metrics as N
from . import sqlgen as S
from .catalog import query
from .fixtures import order_models, order_preds, order_preds_mc, order_reg, with_views


@query("accuracy", with_views(["order_preds"], """SELECT round(avg(CAST(label = prediction AS DOUBLE)), 6) AS accuracy,
  count(*) AS n FROM order_preds"""))
def accuracy(spark, d):
    a = N.accuracy(order_preds(spark, d))
    return a.select(r6(F.col("accuracy")).alias("accuracy"), "n")


@query("confusion_matrix", with_views(["order_preds_mc"], """SELECT g.label, g.prediction, coalesce(c.n, 0) AS n
FROM (SELECT a.v AS label, b.v AS prediction FROM
        (SELECT label AS v FROM order_preds_mc UNION SELECT prediction FROM order_preds_mc) a,
        (SELECT label AS v FROM order_preds_mc UNION SELECT prediction FROM order_preds_mc) b) g
LEFT JOIN (SELECT label, prediction, count(*) AS n FROM order_preds_mc GROUP BY ALL) c
  ON c.label = g.label AND c.prediction = g.prediction"""))
def confusion_matrix(spark, d):
    return N.confusion_matrix(order_preds_mc(spark, d))


PER_CLASS_SQL = """pc AS (
  SELECT k.v AS cls,
         coalesce((SELECT count(*) FROM order_preds_mc WHERE label = k.v AND prediction = k.v), 0) AS tp,
         (SELECT count(*) FROM order_preds_mc WHERE label = k.v) AS support,
         (SELECT count(*) FROM order_preds_mc WHERE prediction = k.v) AS pred_n
  FROM (SELECT label AS v FROM order_preds_mc UNION SELECT prediction FROM order_preds_mc) k),
sc AS (SELECT cls, support,
         CASE WHEN pred_n = 0 THEN 0.0 ELSE tp * 1.0 / pred_n END AS p,
         CASE WHEN support = 0 THEN 0.0 ELSE tp * 1.0 / support END AS r FROM pc),
sf AS (SELECT cls, support, p, r, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f FROM sc)"""


@query("classification_report", with_views(["order_preds_mc"], f"""SELECT row, round(precision, 6) AS precision,
  round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM (
WITH {PER_CLASS_SQL}
SELECT cls AS row, p AS precision, r AS recall, f AS f1, support FROM sf
UNION ALL SELECT 'accuracy', a, a, a, n FROM
  (SELECT avg(CAST(label = prediction AS DOUBLE)) AS a, count(*) AS n FROM order_preds_mc)
UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM sf
UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
  sum(f * support) / sum(support), sum(support) FROM sf)"""))
def classification_report(spark, d):
    rep = N.classification_report(order_preds_mc(spark, d))
    return rep.select("row", *[r6(F.col(x)).alias(x) for x in ["precision", "recall", "f1"]],
                      F.col("support").cast("bigint").alias("support"))


@query("macro_weighted_scores", with_views(["order_preds_mc"], f"""SELECT * FROM (
WITH {PER_CLASS_SQL}
SELECT round((SELECT avg(CAST(label = prediction AS DOUBLE)) FROM order_preds_mc), 6) AS accuracy,
  round(avg(p), 6) AS precision_macro, round(avg(r), 6) AS recall_macro, round(avg(f), 6) AS f1_macro,
  round(sum(p * support) / sum(support), 6) AS precision_weighted,
  round(sum(r * support) / sum(support), 6) AS recall_weighted,
  round(sum(f * support) / sum(support), 6) AS f1_weighted,
  CAST(sum(support) AS BIGINT) AS n_samples,
  (SELECT count(DISTINCT label) FROM order_preds_mc) AS n_classes FROM sf)"""))
def macro_weighted_scores(spark, d):
    m = N.macro_weighted_scores(order_preds_mc(spark, d))
    dbl = ["accuracy", "precision_macro", "recall_macro", "f1_macro", "precision_weighted", "recall_weighted",
           "f1_weighted"]
    return m.select(*[r6(F.col(x)).alias(x) for x in dbl], "n_samples", "n_classes")


AUC_SQL = """SELECT round(sum(CASE WHEN a.label = 1 AND b.label = 0 THEN
  CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0.0 END END)
  / (count(*) FILTER (WHERE a.label = 1 AND b.label = 0)), 6) AS auc
FROM order_preds a, order_preds b WHERE a.label = 1 AND b.label = 0"""


@query("roc_auc", with_views(["order_preds"], """SELECT round((
  (SELECT sum(r) FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r
                       FROM order_preds) WHERE label = 1)
  - p * (p + 1) / 2.0) / (p * q), 6) AS auc
FROM (SELECT count(*) FILTER (WHERE label = 1) * 1.0 AS p, count(*) FILTER (WHERE label <> 1) * 1.0 AS q
      FROM order_preds)"""))
def roc_auc(spark, d):
    a = N.roc_auc(order_preds(spark, d), "label", "score", 1)
    return a.select(r6(F.col("auc")).alias("auc"))


@query("roc_curve", with_views(["order_preds"], """SELECT round(score, 6) AS threshold,
  round(sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) * 1.0 / sum(neg) OVER (), 6) AS fpr,
  round(sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) * 1.0 / sum(pos) OVER (), 6) AS tpr
FROM (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
      FROM order_preds GROUP BY score)"""))
def roc_curve(spark, d):
    r = N.roc_curve(order_preds(spark, d), "label", "score", 1)
    return r.select(*[r6(F.col(x)).alias(x) for x in ["threshold", "fpr", "tpr"]])


@query("regression_metrics", with_views(["order_reg"], "SELECT " + ", ".join([
    f"{S.rsig('avg(pow(label - prediction, 2))')} AS mse",
    f"{S.rsig('sqrt(avg(pow(label - prediction, 2)))')} AS rmse",
    f"{S.rsig('avg(abs(label - prediction))')} AS mae",
    f"{S.rsig('1 - sum(pow(label - prediction, 2)) / (var_pop(label) * count(label))')} AS r2"]) + " FROM order_reg"))
def regression_metrics(spark, d):
    m = N.regression_metrics(order_reg(spark, d))
    return m.select(*[rsig(F.col(x)).alias(x) for x in ["mse", "rmse", "mae", "r2"]])


@query("residual_stats", with_views(["order_reg"], "SELECT " + ", ".join([
    f"{S.rsig('avg(abs((label - prediction) / nullif(label, 0))) * 100')} AS mape",
    f"{S.rsig('1 - var_pop(label - prediction) / var_pop(label)')} AS explained_variance",
    f"{S.rsig('avg(label - prediction)')} AS residual_mean",
    f"{S.rsig('stddev_pop(label - prediction)')} AS residual_std",
    f"{S.rsig('min(label - prediction)')} AS residual_min",
    f"{S.rsig('max(label - prediction)')} AS residual_max"]) + " FROM order_reg"))
def residual_stats(spark, d):
    m = N.residual_stats(order_reg(spark, d))
    return m.select(*[rsig(F.col(x)).alias(x) for x in m.columns])


MODEL_METRICS_SQL = """mm AS (
  SELECT model, sum(tp) * 1.0 / sum(support) AS accuracy,
         sum(p * support) / sum(support) AS precision, sum(r * support) / sum(support) AS recall,
         sum(f * support) / sum(support) AS f1_score FROM (
    SELECT model, support, tp, p, r, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f FROM (
      SELECT model, support, tp, CASE WHEN pred_n = 0 THEN 0.0 ELSE tp * 1.0 / pred_n END AS p,
             CASE WHEN support = 0 THEN 0.0 ELSE tp * 1.0 / support END AS r FROM (
        SELECT m.model, k.v AS cls,
          (SELECT count(*) FROM order_models z WHERE z.model = m.model AND z.label = k.v) AS support,
          (SELECT count(*) FROM order_models z WHERE z.model = m.model AND z.prediction = k.v) AS pred_n,
          (SELECT count(*) FROM order_models z WHERE z.model = m.model AND z.label = k.v AND z.prediction = k.v) AS tp
        FROM (SELECT DISTINCT model FROM order_models) m,
             (SELECT label AS v FROM order_models UNION SELECT prediction FROM order_models) k)))
  GROUP BY model),
auc AS (SELECT model, (sum(r) FILTER (WHERE label = 1) - p * (p + 1) / 2.0) / (p * q) AS roc_auc FROM (
  SELECT model, label, rank() OVER (PARTITION BY model ORDER BY score)
         + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0 AS r,
         count(*) FILTER (WHERE label = 1) OVER (PARTITION BY model) * 1.0 AS p,
         count(*) FILTER (WHERE label <> 1) OVER (PARTITION BY model) * 1.0 AS q
  FROM order_models) GROUP BY model, p, q),
long AS (SELECT model, 'accuracy' AS metric, accuracy AS value FROM mm
  UNION ALL SELECT model, 'precision', precision FROM mm UNION ALL SELECT model, 'recall', recall FROM mm
  UNION ALL SELECT model, 'f1_score', f1_score FROM mm UNION ALL SELECT model, 'roc_auc', roc_auc FROM auc)"""


@query("model_comparison", with_views(["order_models"], f"""SELECT * FROM (WITH {MODEL_METRICS_SQL}
SELECT model, metric, round(value, 6) AS value FROM long)"""))
def model_comparison(spark, d):
    long, _ = N.model_comparison(order_models(spark, d))
    return long.select("model", "metric", r6(F.col("value")).alias("value"))


@query("model_comparison_best", with_views(["order_models"], f"""SELECT * FROM (WITH {MODEL_METRICS_SQL}
SELECT l.metric, min(l.model) AS best_model, round(any_value(l.value), 6) AS value FROM long l
JOIN (SELECT metric, max(value) AS v FROM long GROUP BY metric) b ON l.metric = b.metric AND l.value = b.v
GROUP BY l.metric)"""))
def model_comparison_best(spark, d):
    _, best = N.model_comparison(order_models(spark, d))
    return best.select("metric", "best_model", r6(F.col("value")).alias("value"))


@query("balanced_weights", with_views(["order_preds_mc"], """SELECT key, label,
  round((SELECT count(*) FROM order_preds_mc) * 1.0
        / ((SELECT count(DISTINCT label) FROM order_preds_mc) * count(*) OVER (PARTITION BY label)), 6) AS weight
FROM order_preds_mc"""))
def balanced_weights(spark, d):
    w = N.balanced_weights(order_preds_mc(spark, d).select("key", "label"), "label")
    return w.select("key", "label", r6(F.col("weight")).alias("weight"))


# ------------------------------------------------------------------ P: registry

@query("model_leaderboard", with_views(["order_models"], f"""SELECT * FROM (WITH {MODEL_METRICS_SQL},
reg AS (SELECT model, (SELECT max(o_orderdate) FROM orders)
               + to_hours(CAST(row_number() OVER (ORDER BY model) AS BIGINT)) AS training_date FROM mm)
SELECT mm.model AS model_type, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision,
  round(recall, 6) AS recall, round(f1_score, 6) AS f1_score, reg.training_date
FROM mm JOIN reg ON mm.model = reg.model)"""))
def model_leaderboard(spark, d):
    lb = P.leaderboard_from_predictions(spark, d)
    return lb.select("model_type", *[r6(F.col(x)).alias(x) for x in ["accuracy", "precision", "recall", "f1_score"]],
                     "training_date")


@query("model_recommendation", with_views(["order_models"], f"""SELECT * FROM (WITH {MODEL_METRICS_SQL},
ranked AS (SELECT model, accuracy, row_number() OVER (ORDER BY accuracy DESC, model) AS rn FROM mm WHERE accuracy > 0)
SELECT b.model AS recommended_model, round(b.accuracy, 6) AS accuracy,
  CASE WHEN b.accuracy > 0.8 THEN 'high' WHEN b.accuracy > 0.7 THEN 'medium' ELSE 'low' END AS confidence,
  round(coalesce((b.accuracy - s.accuracy) / s.accuracy * 100, 0.0), 6) AS improvement_pct
FROM ranked b LEFT JOIN ranked s ON s.rn = 2 WHERE b.rn = 1)"""))
def model_recommendation(spark, d):
    rec = P.recommend(P.leaderboard_from_predictions(spark, d))
    return rec.select("recommended_model", r6(F.col("accuracy")).alias("accuracy"), "confidence",
                      r6(F.col("improvement_pct")).alias("improvement_pct"))


@query("current_model", with_views(["order_models"], f"""SELECT * FROM (WITH {MODEL_METRICS_SQL},
reg AS (SELECT model, (SELECT max(o_orderdate) FROM orders)
               + to_hours(CAST(row_number() OVER (ORDER BY model) AS BIGINT)) AS training_date FROM mm)
SELECT model AS model_type, training_date,
  model || '_v' || strftime(training_date, '%Y%m%d_%H%M') AS version_id
FROM reg ORDER BY training_date DESC LIMIT 1)"""))
def current_model(spark, d):
    return P.current_model(P.leaderboard_from_predictions(spark, d))
