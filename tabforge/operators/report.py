"""The full EDA report (A9, J18): every section of :func:`.profile.eda_report_long` and those about
categories, associations and importance.

All categorical sections come from one table of cells (feature1, feature2, v1, v2, o), counted in one
pass over the input and written once: pairs of string columns, string columns with the target,
and every string column and the target by themselves (feature2 ``*``, NULL counted).  Its size is the number of
distinct cells, not of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c, numeric_columns, string_columns
from ..session import materialise
from .assoc import cramers_v_counts, point_biserial, spearman_matrix
from .profile import eda_key_findings, eda_report_long, pair_list
from .select import indicator_information_counts, mutual_information

ALONE = "*"


def category_cells(df: DataFrame, cols: list[str], target: str | None = None) -> DataFrame:
    """(feature1, feature2, v1, v2, o) of all pairs, of columns with the target and of columns alone."""
    own = [*cols, *([target] if target and target not in cols else [])]
    pairs = pair_list([x for x in cols if x != target]) + [(x, target) for x in cols if target and x != target]
    cells = [F.struct(F.lit(a).alias("feature1"), F.lit(b).alias("feature2"), c(a).cast("string").alias("v1"),
                      c(b).cast("string").alias("v2")) for a, b in pairs]
    cells += [F.struct(F.lit(a).alias("feature1"), F.lit(ALONE).alias("feature2"), c(a).cast("string").alias("v1"),
                       F.lit("").alias("v2")) for a in own]
    return (df.select(F.inline(F.array(*cells))).where((F.col("feature2") == ALONE) | (F.col("v1").isNotNull() & F.col("v2").isNotNull()))
            .groupBy("feature1", "feature2", "v1", "v2").agg(F.count(F.lit(1)).alias("o")))


def _long(d: DataFrame, section: str, stats: list[str], feature=None) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(x).alias("stat"), F.col(x).cast("double").alias("value")) for x in stats])
    name = F.col("feature") if feature is None else feature
    return d.select(F.lit(section).alias("section"), name.alias("feature"), F.inline(pairs))


def category_sections(cells: DataFrame, target: str | None = None) -> dict[str, DataFrame]:
    """Sections (section, feature, stat, value) that follow from the cells alone:

    * ``univariate``: n_unique, most and least frequent value's count of every string column;
    * ``level``: n of every value (feature ``column=value``, a NULL as ``column``);
    * ``cramers``: V of every pair (``a|b``);
    * with a target ``crosstab``: n and row percentage (``column=value|class``); ``association``: V with the
      target; ``importance``: mutual information of every category but the lowest (``column_value``).
    """
    alone = cells.where((F.col("feature2") == ALONE) & (F.col("feature1") != (target or "")))
    known = alone.where("v1 is not null").groupBy(F.col("feature1").alias("feature")).agg(
        F.count(F.lit(1)).alias("n_unique"), F.max("o").alias("most_frequent_count"), F.min("o").alias("least_frequent_count"))
    out = {"univariate": _long(known, "univariate", ["n_unique", "most_frequent_count", "least_frequent_count"]),
           "level": _long(alone.withColumnRenamed("o", "n"), "level", ["n"], F.concat_ws("=", "feature1", "v1"))}
    v = cramers_v_counts(cells.where(F.col("feature2") != ALONE))
    name = F.concat_ws("|", "feature1", "feature2")
    out["cramers"] = _long(v.where(F.col("feature2") != (target or "")), "cramers", ["cramers_v"], name)
    if target:
        with_class = cells.where(F.col("feature2") == target)
        totals = with_class.groupBy("feature1", "v1").agg(F.sum("o").alias("total"))
        cross = with_class.join(totals, ["feature1", "v1"]).select("feature1", "v1", "v2", F.col("o").alias("n"),
                                                                   (F.col("o") * 100.0 / F.col("total")).alias("pct"))
        out["crosstab"] = _long(cross, "crosstab", ["n", "pct"],
                                F.concat(F.col("feature1"), F.lit("="), F.col("v1"), F.lit("|"), F.col("v2")))
        out["association"] = _long(v.where(F.col("feature2") == target), "association", ["cramers_v"], F.col("feature1"))
        classes = cells.where((F.col("feature1") == target) & (F.col("feature2") == ALONE) & F.col("v1").isNotNull()).select(
            F.col("v1").alias("y"), F.col("o").alias("ny"))
        mi = indicator_information_counts(with_class.select(F.col("feature1").alias("feature"), F.col("v1").alias("value"),
                                                            F.col("v2").alias("y"), F.col("o").alias("nvy")), classes)
        out["importance"] = _long(mi, "importance", ["mi"])
    return out


def full_report(df: DataFrame, target: str | None = None, estimator: str = "neighbours") -> tuple[DataFrame, DataFrame]:
    """(report (section, feature, stat, value), summary of one row): the sections of ``eda_report_long`` and
    :func:`category_sections`, and ``spearman``, with a target also ``point_biserial`` and the numeric columns'
    ``importance``.  The summary counts strong pairs and names the most informative features."""
    num, strs = numeric_columns(df, [target] if target else []), string_columns(df, [target] if target else [])
    spark = df.sparkSession
    parts = [eda_report_long(df, target)]
    name = F.concat_ws("|", "feature1", "feature2")
    if len(num) > 1:
        parts.append(_long(spearman_matrix(df, num), "spearman", ["correlation"], name))
    if strs:
        cells = materialise(category_cells(df, strs, target), "category-cells")
        parts += category_sections(cells, target).values()
    if target and num:
        parts.append(_long(point_biserial(df, target, num), "point_biserial", ["correlation"]))
        parts.append(_long(mutual_information(df, num, target, estimator=estimator), "importance", ["mi"]))
    report = parts[0]
    for x in parts[1:]:
        report = report.unionByName(x)
    report = materialise(report, "eda-report")

    def section(which, value):
        return report.where(F.col("section") == which).select("feature", F.col("value").alias(value))

    summary = eda_key_findings(section("correlation", "correlation"), section("cramers", "cramers_v"), section("importance", "mi"))
    return report, summary
