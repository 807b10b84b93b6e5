"""Feature selection (section I).

* mutual information (I1) in nats.  Discrete columns: the plug-in estimate from counts,
  ``sum p(x,y) ln(p(x,y) / (p(x) p(y)))``, exact.  Continuous columns (by default every float or
  decimal column, so that an ID-like column of unique values does not look
  informative): the nearest-neighbour estimate of :mod:`.neighbour_mi`, or with
  ``estimator="bins"`` the plug-in estimate over ``bins`` quantile bins.
* chi2 (I2): scikit-learn's ``chi2`` on ``X - min + 1``: observed = per-class sums,
  expected = class share x column total.
* variance threshold (I4): population variance strictly above the threshold.
* top-k (I5): k clipped, result in input column order.
* RFE (I3) lives in :mod:`tabforge.ml.models` (it fits forests).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import c, is_numeric, numeric, unpivot_numeric, unpivot_strings
from ..functions.ranks import quantile_table
from ..session import materialise
from .neighbour_mi import neighbour_information


def discretised(df: DataFrame, cols: list[str], continuous: list[str], bins: int = 10) -> DataFrame:
    """One string column per feature, continuous ones cut at their exact quantiles (a
    value equal to a cut belongs to the bin below it; equal cuts are one)."""
    cuts: dict[str, set[float]] = {}
    if continuous:
        probs = [k / bins for k in range(1, bins)]
        for r in quantile_table(df, list(continuous), probs).collect():  # columns x (bins - 1) rows
            cuts.setdefault(r["feature"], set()).add(r["quantile"])
    vals = []
    for x in cols:
        v = numeric(df, x) if is_numeric(df.schema[x].dataType) else c(x)
        if x in continuous:
            code = sum([(v > F.lit(q)).cast("int") for q in sorted(cuts.get(x, ()))], F.lit(0))
            v = F.when(v.isNotNull(), code)
        vals.append(v.cast("string"))
    return vals


def continuous_columns(df: DataFrame, cols: list[str]) -> list[str]:
    return [x for x in cols if isinstance(df.schema[x].dataType, (T.DoubleType, T.FloatType, T.DecimalType))]


def mutual_information(df: DataFrame, features: list[str], target: str,
                       continuous: list[str] | None = None, bins: int = 10, estimator: str = "neighbours",
                       n_neighbors: int = 3) -> DataFrame:
    """(feature, mi) for every feature against a class target; rows with a NULL
    feature value or target are left out of that feature's estimate.  ``continuous``
    names the continuous columns (None: :func:`continuous_columns`), ``estimator`` how they
    are treated: ``neighbours`` or ``bins``."""
    if estimator not in ("neighbours", "bins"):
        raise ValueError(f"Unknown estimator: {estimator}")
    continuous = (continuous_columns(df, features) if continuous is None else
                  [x for x in continuous if x in features])
    if estimator == "neighbours" and continuous:
        near = neighbour_information(df, continuous, target, n_neighbors)
        rest = [x for x in features if x not in continuous]
        return near.unionByName(mutual_information(df, rest, target, [])) if rest else near
    vals = discretised(df, features, continuous, bins)
    arr = F.array(*[F.struct(F.lit(x).alias("feature"), v.alias("x")) for x, v in zip(features, vals)])
    long = df.select(c(target).cast("string").alias("y"), F.inline(arr)) \
        .where(F.col("x").isNotNull() & F.col("y").isNotNull())
    nxy = long.groupBy("feature", "x", "y").agg(F.count(F.lit(1)).alias("nxy"))
    nx = nxy.groupBy("feature", "x").agg(F.sum("nxy").alias("nx"))
    ny = nxy.groupBy("feature", "y").agg(F.sum("nxy").alias("ny"))
    n = ny.groupBy("feature").agg(F.sum("ny").alias("n"))
    j = nxy.join(nx, ["feature", "x"]).join(ny, ["feature", "y"]).join(n, "feature")
    term = F.col("nxy") / F.col("n") * F.log(F.col("nxy") * F.col("n") / (F.col("nx") * F.col("ny")))
    mi = j.groupBy("feature").agg(F.sum(term).alias("mi"))
    return mi.select("feature", F.greatest(F.col("mi"), F.lit(0.0)).alias("mi"))


def indicator_information(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    """(feature, mi) of the indicator of every category but the lowest of each string
    column, named ``<column>_<category>``: the dummy-encoded columns' mutual information
    straight from the (column, category, class) counts, however many categories there
    are.  A NULL is in no category; rows with a NULL target are left out."""
    data = df.where(c(target).isNotNull())
    y = c(target).cast("string").alias("y")
    classes = materialise(data.groupBy(y).agg(F.count(F.lit(1)).alias("ny")), "classes")
    cells = unpivot_strings(data.withColumn("_y", y), cols, keep=["_y"], drop_nulls=True) \
        .groupBy("feature", "value", F.col("_y").alias("y")).agg(F.count(F.lit(1)).alias("nvy"))
    return indicator_information_counts(cells, classes)


def indicator_information_counts(cells: DataFrame, classes: DataFrame) -> DataFrame:
    """:func:`indicator_information` from the counts (feature, value, y, nvy) and (y, ny)."""
    n = classes.agg(F.coalesce(F.sum("ny"), F.lit(0)).cast("double")).first()[0]
    of_value = Window.partitionBy("feature", "value")
    lows = cells.groupBy("feature").agg(F.min("value").alias("low"))
    cells = (cells.withColumn("nv", F.sum("nvy").over(of_value)).join(lows, "feature")
             .where(F.col("value") > F.col("low")).join(classes, "y"))
    rest = F.lit(n) - F.col("nv")
    outside = F.when(rest > 0, F.log(F.lit(n) / rest)).otherwise(0.0)
    left = F.col("ny") - F.col("nvy")

    def term(cell, margin):
        return F.when(cell > 0, cell / n * F.log(cell * n / (margin * F.col("ny")))).otherwise(0.0)

    # Classes without a row of the category contribute ny / n * outside each: they are
    # the sum over all classes, less the classes that have rows.
    per = term(F.col("nvy"), F.col("nv")) + term(left, rest) - F.col("ny") / n * outside
    return cells.groupBy("feature", "value").agg((F.sum(per) + F.max(outside)).alias("mi")).select(
        F.concat_ws("_", "feature", "value").alias("feature"), F.greatest("mi", F.lit(0.0)).alias("mi"))


def feature_importance(df: DataFrame, target: str, str_cols: list[str], num_cols: list[str],
                       estimator: str = "neighbours") -> DataFrame:
    """J17: (feature, mi) of category indicators and numeric columns."""
    return indicator_information(df, str_cols, target).unionByName(
        mutual_information(df, num_cols, target, estimator=estimator))


def chi2_scores(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """(feature, chi2) of scikit-learn's chi2 on the min-shifted features (+1)."""
    mins = df.agg(*[F.min(numeric(df, x)).alias(x) for x in features]).first()
    shifted = [(numeric(df, x) - F.lit(float(mins[x] or 0.0)) + 1.0) for x in features]
    per_class = df.where(c(target).isNotNull()).groupBy(c(target).alias("y")).agg(
        F.count(F.lit(1)).alias("ny"), *[F.sum(s).alias(f"s{i}") for i, s in enumerate(shifted)])
    long = per_class.select("y", "ny", F.inline(F.array(*[
        F.struct(F.lit(x).alias("feature"), F.col(f"s{i}").alias("obs")) for i, x in enumerate(features)])))
    tot = long.groupBy("feature").agg(F.sum("obs").alias("tot"), F.sum("ny").alias("n"))
    j = long.join(tot, "feature")
    exp = F.col("ny") / F.col("n") * F.col("tot")
    return j.groupBy("feature").agg(F.sum(F.pow(F.col("obs") - exp, 2) / exp).alias("chi2"))


def variances(df: DataFrame, features: list[str]) -> DataFrame:
    return unpivot_numeric(df, features).groupBy("feature").agg(F.var_pop("value").alias("variance"))


def variance_select(df: DataFrame, features: list[str], threshold: float = 0.01) -> list[str]:
    got = {r["feature"]: r["variance"] for r in variances(df, features).collect()}
    return [x for x in features if got.get(x) is not None and got[x] > threshold]


def select_k_best(scores: DataFrame, features: list[str], k: int, score_col: str) -> list[str]:
    """Top-k feature names by score (ties by name), returned in input order."""
    k = max(0, min(k, len(features)))
    top = scores.orderBy(F.col(score_col).desc(), "feature").limit(k).collect()
    chosen = {r["feature"] for r in top}
    return [x for x in features if x in chosen]


def feature_selection(df: DataFrame, features: list[str], target: str, method: str = "mutual_info",
                      k: int = 20, continuous: list[str] | None = None, estimator: str = "neighbours") -> list[str]:
    """Return the selected column names (apply with ``select``)."""
    if method == "mutual_info":
        return select_k_best(mutual_information(df, features, target, continuous, estimator=estimator), features, k, "mi")
    if method == "chi2":
        return select_k_best(chi2_scores(df, features, target), features, k, "chi2")
    if method == "variance":
        kept = variance_select(df, features)
        if len(kept) > k:
            return select_k_best(mutual_information(df, kept, target, continuous, estimator=estimator), kept, k, "mi")
        return kept
    if method == "rfe":
        from ..ml.models import rfe_select
        return rfe_select(df, features, target, k)
    raise ValueError(f"Unknown selection method: {method}")
