"""Evaluation metrics (section N) on a predictions table
``(key..., label, prediction[, score])``.  Everything is an aggregate over counts;
ROC / AUC use distributed running totals over per-score counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c, numeric
from ..functions.ranks import prefix_sums
from ..session import materialise


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of equal pairs among the ``n`` rows that have both values."""
    return pred.agg(F.avg((c(label) == c(prediction)).cast("double")).alias("accuracy"),
                    F.count(c(label) == c(prediction)).alias("n"))


def _counts(pred: DataFrame, label: str, prediction: str) -> DataFrame:
    """(label, prediction, n): the only pass over the predictions."""
    return pred.groupBy(c(label).alias("label"), c(prediction).alias("prediction")) \
        .agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n) for every pair of classes, zeros included.  The grid is
    made by Spark from the distinct classes of the counts (classes^2 rows are the
    result itself)."""
    cnt = materialise(_counts(pred, label, prediction), "confusion")
    classes = cnt.select(F.col("label").alias("v")).union(cnt.select(F.col("prediction").alias("v"))) \
        .where(F.col("v").isNotNull()).distinct()
    zero = F.lit(0).cast("bigint")
    grid = classes.select(F.col("v").alias("label")).join(classes.select(F.col("v").alias("prediction")), how="cross")
    return grid.select("label", "prediction", zero.alias("n")).unionByName(
        cnt.where(F.col("label").isNotNull() & F.col("prediction").isNotNull())) \
        .groupBy("label", "prediction").agg(F.sum("n").alias("n"))


def _class_scores(cnt: DataFrame, keys: list[str] = ()) -> DataFrame:
    """(keys..., cls, tp, pred_n, support, precision, recall, f1) from counts (keys...,
    label, prediction, n): every count goes to its label and to its prediction, one
    aggregate; zero division -> 0."""
    zero = F.lit(0).cast("bigint")
    same = F.col("label") == F.col("prediction")
    sides = F.array(
        F.struct(F.col("label").alias("cls"), F.when(same, F.col("n")).otherwise(zero).alias("tp"),
                 F.col("n").alias("support"), zero.alias("pred_n")),
        F.struct(F.col("prediction").alias("cls"), zero.alias("tp"), zero.alias("support"), F.col("n").alias("pred_n")))
    agg = cnt.select(*keys, F.inline(sides)).where(F.col("cls").isNotNull()).groupBy(*keys, "cls").agg(
        *[F.sum(x).alias(x) for x in ("tp", "support", "pred_n")])
    p = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("pred_n")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), F.lit(0.0))
    f = F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
    return agg.select(*keys, "cls", "tp", "pred_n", "support", p.alias("precision"), r.alias("recall"), f.alias("f1"))


def per_class_scores(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(cls, precision, recall, f1, support); zero division -> 0."""
    return _class_scores(_counts(pred, label, prediction)).select("cls", "precision", "recall", "f1", "support")


def _averages(scores: DataFrame):
    """One row: accuracy, macro and weighted averages, samples and label classes."""
    def weighted(x):
        return F.try_divide(F.sum(F.col(x) * F.col("support")), F.sum("support"))

    return scores.agg(
        F.try_divide(F.sum("tp").cast("double"), F.sum("support")).alias("acc"), F.sum("support").cast("bigint").alias("n"),
        *[F.avg(x).alias("macro_" + x) for x in ("precision", "recall", "f1")],
        *[weighted(x).alias("weighted_" + x) for x in ("precision", "recall", "f1")],
        F.count_if(F.col("support") > 0).alias("k"))


def classification_report(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                          class_names: dict | None = None) -> DataFrame:
    """Rows per class plus ``accuracy``, ``macro avg``, ``weighted avg``:
    (row, precision, recall, f1, support).  One pass over the predictions; everything
    else is arithmetic on the table of counts."""
    pcs = materialise(_class_scores(_counts(pred, label, prediction)), "class-scores")
    name = F.col("cls").cast("string")
    if class_names:
        m = F.create_map(*[x for k, v in class_names.items() for x in (F.lit(str(k)), F.lit(v))])
        name = F.coalesce(m[name], name)
    rows = pcs.select(name.alias("row"), "precision", "recall", "f1", F.col("support").cast("bigint").alias("support"))

    def line(row, p, r, f):
        return F.struct(F.lit(row).alias("row"), F.col(p).alias("precision"), F.col(r).alias("recall"),
                        F.col(f).alias("f1"), F.col("n").alias("support"))

    extra = _averages(pcs).select(F.inline(F.array(
        line("accuracy", "acc", "acc", "acc"), line("macro avg", "macro_precision", "macro_recall", "macro_f1"),
        line("weighted avg", "weighted_precision", "weighted_recall", "weighted_f1"))))
    return rows.unionByName(extra)


def macro_weighted_scores(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy, macro / weighted precision, recall, f1, n_samples, n_classes."""
    return _averages(_class_scores(_counts(pred, label, prediction))).select(
        F.col("acc").alias("accuracy"), F.col("macro_precision").alias("precision_macro"),
        F.col("macro_recall").alias("recall_macro"), F.col("macro_f1").alias("f1_macro"),
        F.col("weighted_precision").alias("precision_weighted"), F.col("weighted_recall").alias("recall_weighted"),
        F.col("weighted_f1").alias("f1_weighted"), F.col("n").alias("n_samples"), F.col("k").alias("n_classes"))


def _score_counts(pred: DataFrame, label: str, score: str, positive=1) -> DataFrame:
    pos = F.coalesce(c(label) == F.lit(positive), F.lit(False))
    return pred.where(c(score).isNotNull()).groupBy(c(score).cast("double").alias("score")).agg(
        F.count_if(pos).alias("pos"), F.count_if(~pos).alias("neg"))


def roc_auc(pred: DataFrame, label: str = "label", score: str = "score", positive=1) -> DataFrame:
    """Exact Mann-Whitney AUC (ties count one half): one row (auc)."""
    ps = prefix_sums(_score_counts(pred, label, score, positive), [], "score", ["pos", "neg"])
    below = F.col("cum_neg") - F.col("neg")
    return ps.agg(F.try_divide(F.sum(F.col("pos") * (below + 0.5 * F.col("neg"))),
                               F.first("tot_pos").cast("double") * F.first("tot_neg")).alias("auc"))


def roc_curve(pred: DataFrame, label: str = "label", score: str = "score", positive=1) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score (collinear points kept)."""
    ps = prefix_sums(_score_counts(pred, label, score, positive), [], "score", ["pos", "neg"])
    ge_pos = F.col("tot_pos") - F.col("cum_pos") + F.col("pos")
    ge_neg = F.col("tot_neg") - F.col("cum_neg") + F.col("neg")
    return ps.select(F.col("score").alias("threshold"),
                     F.try_divide(ge_neg.cast("double"), F.col("tot_neg")).alias("fpr"),
                     F.try_divide(ge_pos.cast("double"), F.col("tot_pos")).alias("tpr"))


def _pairs(pred: DataFrame, label: str, prediction: str):
    """Label and prediction; a row without a prediction counts in no part of a metric."""
    y, p = numeric(pred, label), numeric(pred, prediction)
    return F.when(p.isNotNull(), y), p


def regression_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    y, p = _pairs(pred, label, prediction)
    e = y - p
    return pred.agg(F.avg(e * e).alias("mse"), F.sqrt(F.avg(e * e)).alias("rmse"),
                    F.avg(F.abs(e)).alias("mae"),
                    (1 - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count(y)))
                    .alias("r2"))


def residual_stats(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """MAPE %, explained variance and residual mean / population std / min / max."""
    y, p = _pairs(pred, label, prediction)
    e = y - p
    return pred.agg(
        (F.avg(F.abs(F.try_divide(e, y))) * 100).alias("mape"),
        (1 - F.try_divide(F.var_pop(e), F.var_pop(y))).alias("explained_variance"),
        F.avg(e).alias("residual_mean"), F.stddev_pop(e).alias("residual_std"),
        F.min(e).alias("residual_min"), F.max(e).alias("residual_max"))


LOWER_IS_BETTER = ("mse", "rmse", "mae")


def model_comparison(preds: DataFrame, model_col: str = "model", label: str = "label",
                     prediction: str = "prediction", score: str | None = "score",
                     problem_type: str = "classification") -> tuple[DataFrame, DataFrame]:
    """Metrics of several models on one test set (predictions unioned with a ``model``
    column) and the best model per metric (min for mse/rmse/mae, max otherwise).
    Returns (long metrics (model, metric, value), best (metric, best_model, value))."""
    if problem_type == "classification":
        cm = preds.groupBy(c(model_col).alias("model"), c(label).alias("label"),
                           c(prediction).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))
        per = _class_scores(cm, ["model"]).select("model", "support", "tp", F.col("precision").alias("p"),
                                                  F.col("recall").alias("r"), F.col("f1").alias("f"))
        m = per.groupBy("model").agg(
            (F.sum("tp") / F.sum("support")).alias("accuracy"),
            (F.sum(F.col("p") * F.col("support")) / F.sum("support")).alias("precision"),
            (F.sum(F.col("r") * F.col("support")) / F.sum("support")).alias("recall"),
            (F.sum(F.col("f") * F.col("support")) / F.sum("support")).alias("f1_score"))
        names = ["accuracy", "precision", "recall", "f1_score"]
        if score:
            auc = _grouped_auc(preds, model_col, label, score)
            m = m.join(auc, "model", "left")
            names.append("roc_auc")
    else:
        y, p = _pairs(preds, label, prediction)
        e = y - p
        m = preds.groupBy(c(model_col).alias("model")).agg(
            F.avg(e * e).alias("mse"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
            (1 - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count(y))).alias("r2"))
        names = ["mse", "rmse", "mae", "r2"]
    long = m.select("model", F.inline(F.array(*[F.struct(F.lit(x).alias("metric"), F.col(x).alias("value"))
                                                for x in names])))
    # The best value is picked by (value, name) in one aggregate; NaN and NULL never win.
    real = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    order = F.when(F.col("metric").isin(*LOWER_IS_BETTER), F.col("value")).otherwise(-F.col("value"))
    best = real.groupBy("metric").agg(F.min(F.struct(order.alias("o"), F.col("model").alias("best_model"), "value")).alias("b")) \
        .select("metric", "b.best_model", "b.value")
    return long, best


def _grouped_auc(preds: DataFrame, model_col: str, label: str, score: str, positive=1) -> DataFrame:
    pos = F.coalesce(c(label) == F.lit(positive), F.lit(False))
    sc = preds.where(c(score).isNotNull()).groupBy(c(model_col).alias("model"),
                                                  c(score).cast("double").alias("score")) \
        .agg(F.count_if(pos).alias("pos"), F.count_if(~pos).alias("neg"))
    # Defined for two classes only (one-against-rest scores are not comparable).
    two = preds.groupBy(c(model_col).alias("model")).agg(F.count_distinct(c(label)).alias("k")).where("k <= 2")
    ps = prefix_sums(sc.join(two.select("model"), "model", "left_semi"), ["model"], "score", ["pos", "neg"])
    below = F.col("cum_neg") - F.col("neg")
    return ps.groupBy("model").agg(F.try_divide(F.sum(F.col("pos") * (below + 0.5 * F.col("neg"))),
                                                F.first("tot_pos").cast("double") * F.first("tot_neg"))
                                   .alias("roc_auc"))


def balanced_weights(df: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    """scikit-learn ``class_weight='balanced'``: n / (k * n_class), joined per class."""
    cnt = df.groupBy(c(label).alias("_cls")).agg(F.count(F.lit(1)).alias("_nc"))
    tot = cnt.agg(F.sum("_nc").alias("n"), F.count(F.lit(1)).alias("k")).first()
    w = cnt.select("_cls", (F.lit(float(tot["n"])) / (F.lit(float(tot["k"])) * F.col("_nc"))).alias(weight_col))
    # One row per class; written, so that the planner knows its size.
    w = materialise(w, "class-weights")
    return df.join(w, c(label).eqNullSafe(F.col("_cls")), "left").drop("_cls")
