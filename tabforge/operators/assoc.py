"""Association measures (section K).

* Pearson (K1): upper triangle in one aggregate, pairwise-complete, NULL for constants; many
  columns by masked Gram matrices (:mod:`.gram`).
* Spearman (K2): average ranks per pair over its complete rows (as pandas), computed once per
  column and class of partners with the same missing rows, then Gram matrices of the ranks.
* Cramér's V (K4/K5): chi-square from observed cells only,
  ``chi2 = sum(O^2 / E) - n`` (zero cells contribute nothing), and for 2x2 tables the
  Yates-corrected form ``max(|d| - 0.5, 0)^2 * n * sum(1/r_i) * sum(1/c_j)`` where
  ``|d| = |O - E|`` is the same in every cell of a 2x2 table.  No category grid is
  ever materialised.
* Point-biserial (K6) and strength labels (K7).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import c, numeric, numeric_columns, string_columns
from ..functions.ranks import average_ranks
from ..functions.columns import as_double, unpivot_numeric
from ..functions.stats import pearson, rnd
from .gram import pearson_wide, spearman_wide
from .profile import correlation_long, pair_list



NARROW = 12  # columns whose pairs still fit into one aggregate as expressions


def pearson_matrix(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(feature1, feature2, correlation) of all pairs, pairwise-complete; by Gram matrices
    when there are too many pairs for one aggregate (same results)."""
    cols = cols if cols is not None else numeric_columns(df)
    return correlation_long(df, cols) if len(cols) <= NARROW else pearson_wide(df, cols)


def spearman_matrix(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Spearman r per pair, exactly as pandas: each pair is ranked over its own
    complete rows (average ranks for ties)."""
    cols = cols if cols is not None else numeric_columns(df)
    if len(cols) < 2:
        return df.sparkSession.createDataFrame([], "feature1 string, feature2 string, correlation double")
    return spearman_wide(df, cols)


def high_correlations(corr_long: DataFrame, threshold: float = 0.7, decimals: int = 3) -> DataFrame:
    """Pairs with |r| >= threshold: (feature1, feature2, correlation, abs_correlation)."""
    return corr_long.where(F.abs("correlation") >= threshold).select(
        "feature1", "feature2", rnd("correlation", decimals).alias("correlation"),
        rnd(F.abs("correlation"), decimals).alias("abs_correlation"))


def contingency_counts(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """(feature1, feature2, v1, v2, o) for every pair; rows with a NULL in the pair
    are excluded.  One exploded aggregate for all pairs (map-side combined)."""
    arr = F.array(*[F.struct(F.lit(a).alias("feature1"), F.lit(b).alias("feature2"),
                             c(a).cast("string").alias("v1"), c(b).cast("string").alias("v2"))
                    for a, b in pairs])
    long = df.select(F.inline(arr)).where(F.col("v1").isNotNull() & F.col("v2").isNotNull())
    return long.groupBy("feature1", "feature2", "v1", "v2").agg(F.count(F.lit(1)).alias("o"))


def cramers_v_pairs(df: DataFrame, pairs: list[tuple[str, str]], decimals: int | None = 3) -> DataFrame:
    """(feature1, feature2, cramers_v, chi2, n) with scipy's default Yates correction
    for 2x2 tables; degenerate tables (one row or column) give V = 0."""
    return cramers_v_counts(contingency_counts(df, pairs), decimals)


def cramers_v_counts(o: DataFrame, decimals: int | None = 3) -> DataFrame:
    """:func:`cramers_v_pairs` from the cells (feature1, feature2, v1, v2, o)."""
    k = ["feature1", "feature2"]

    def margin(*by):
        return Window.partitionBy(*k, *by)

    # Row and column totals are window sums over the cells (never larger than the cells);
    # 1 / (cells of the row) makes each row count once in the sums over all cells.
    cell = (o.withColumn("r", F.sum("o").over(margin("v1"))).withColumn("in_r", F.count("*").over(margin("v1")))
            .withColumn("cc", F.sum("o").over(margin("v2"))).withColumn("in_c", F.count("*").over(margin("v2"))))
    n = o.groupBy(*k).agg(F.sum("o").alias("n"))
    cell = cell.join(n, k)
    e = F.col("r") * F.col("cc") / F.col("n")
    per = cell.groupBy(*k).agg(
        F.sum(F.col("o") * F.col("o") / e).alias("s"), F.max(F.abs(F.col("o") - e)).alias("d"), F.first("n").alias("n"),
        F.round(F.sum(1.0 / F.col("in_r"))).alias("nr"), F.round(F.sum(1.0 / F.col("in_c"))).alias("nc"),
        F.sum(1.0 / F.col("r") / F.col("in_r")).alias("inv_r"), F.sum(1.0 / F.col("cc") / F.col("in_c")).alias("inv_c"))
    yates = F.pow(F.greatest(F.col("d") - 0.5, F.lit(0.0)), 2) * F.col("n") * F.col("inv_r") * F.col("inv_c")
    chi2 = F.when((F.col("nr") == 2) & (F.col("nc") == 2), yates) \
        .otherwise(F.greatest(F.col("s") - F.col("n"), F.lit(0.0)))
    min_dim = F.least(F.col("nr"), F.col("nc")) - 1
    v = F.when(min_dim <= 0, F.lit(0.0)).otherwise(F.sqrt(chi2 / (F.col("n") * min_dim)))
    if decimals is not None:
        v = rnd(v, decimals)
    return per.select(*k, v.alias("cramers_v"), chi2.alias("chi2"), "n")


def cramers_v_matrix(df: DataFrame, cols: list[str] | None = None, decimals: int = 3) -> DataFrame:
    """Upper triangle of the Cramér's V matrix over all string columns (diagonal is 1)."""
    cols = cols if cols is not None else string_columns(df)
    return cramers_v_pairs(df, pair_list(cols), decimals).select("feature1", "feature2", "cramers_v")


def association_strength(v):
    """Fixed strength labels: < 0.1 negligible, < 0.3 weak, < 0.5 moderate, else strong."""
    return (F.when(v < 0.1, "negligible").when(v < 0.3, "weak").when(v < 0.5, "moderate")
            .otherwise("strong"))


def target_association(df: DataFrame, target: str, cols: list[str] | None = None) -> DataFrame:
    """(feature, cramers_v, association_strength) of each string feature with the target."""
    cols = cols if cols is not None else string_columns(df, [target])
    v = cramers_v_pairs(df, [(x, target) for x in cols], decimals=None)
    return v.select(F.col("feature1").alias("feature"), rnd("cramers_v", 3).alias("cramers_v"),
                    association_strength(F.col("cramers_v")).alias("association_strength"))


def _point_biserial(df: DataFrame, target: str, cols: list[str]):
    """One row: r of every (mean-filled feature, indicator of the first sorted target
    class) and the number of rows."""
    first = df.agg(F.min(c(target)).alias("f")).first()["f"]
    ind = F.coalesce(c(target) == F.lit(first), F.lit(False)).cast("double")
    means = df.agg(*[F.avg(numeric(df, x)).alias(x) for x in cols]).first()
    filled = df.select(ind.alias("_ind"), *[F.coalesce(numeric(df, x), F.lit(means[x])).alias(x) for x in cols])
    return filled.agg(*[pearson(F.col(x), F.col("_ind")).alias(x) for x in cols], F.count(F.lit(1)).alias("_n"))


def point_biserial(df: DataFrame, target: str, cols: list[str] | None = None) -> DataFrame:
    """(feature, correlation rounded to 3, n); an undefined correlation is 0."""
    cols = cols if cols is not None else numeric_columns(df, [target])
    pairs = F.array(*[F.struct(F.lit(x).alias("feature"), c(x).alias("r")) for x in cols])
    return _point_biserial(df, target, cols).select(F.inline(pairs), F.col("_n").alias("n")).select(
        "feature", rnd(F.coalesce("r", F.lit(0.0)), 3).alias("correlation"), "n")


# -- Student t tail for the p-value: evaluated on the driver over one row per feature.

def _betacf(a: float, b: float, x: float) -> float:
    """Continued fraction of the regularised incomplete beta (modified Lentz)."""
    tiny, eps = 1e-300, 3e-16
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    cc, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        cc = 1.0 + aa / cc
        cc = cc if abs(cc) > tiny else tiny
        h *= d * cc
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        cc = 1.0 + aa / cc
        cc = cc if abs(cc) > tiny else tiny
        delta = d * cc
        h *= delta
        if abs(delta - 1.0) < eps:
            break
    return h


def reg_incomplete_beta(a: float, b: float, x: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbeta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    front = math.exp(lbeta)
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _betacf(a, b, x) / a
    return 1.0 - front * _betacf(b, a, 1.0 - x) / b


def pearson_p_value(r: float, n: int) -> float:
    """Two-sided p-value of Pearson r under H0 (Student t with n-2 dof)."""
    if r is None or n is None or n < 3:
        return 1.0
    if abs(r) >= 1.0:
        return 0.0
    dof = n - 2
    t2 = r * r * dof / (1.0 - r * r)
    return reg_incomplete_beta(dof / 2.0, 0.5, dof / (dof + t2))


def point_biserial_with_p(df: DataFrame, target: str, cols: list[str] | None = None) -> DataFrame:
    """Adds p_value (4 decimals) and significant (p < 0.05); failure -> (0, 1, false)."""
    spark = df.sparkSession
    cols = cols if cols is not None else numeric_columns(df, [target])
    rows = []
    agg = _point_biserial(df, target, cols).first()
    for x in cols:
        r = agg[x]
        if r is None or math.isnan(r):
            rows.append((x, 0.0, 1.0, False))
        else:
            p = pearson_p_value(r, agg["_n"])
            rows.append((x, round(r, 3), round(p, 4), p < 0.05))
    return spark.createDataFrame(rows, "feature string, correlation double, p_value double, significant boolean")
