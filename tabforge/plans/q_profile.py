"""Queries for profiling / EDA (section J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.stats import r6
from ..operators import clean
from ..operators import profile as P
from ..operators import report as R
from ..operators.select import feature_importance
from . import sqlgen as S
from .catalog import query
from .fixtures import c360, li_nulls, table, with_views

LI_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
C360_MEASURES = ["acctbal", "n_orders", "total_charges", "avg_charges", "tenure_months", "returned_items"]


def _univariate_sql(src: str, cols: list[str]) -> str:
    return S.union([f"""SELECT '{x}' AS feature, round(avg({x}), 2) AS mean,
  round(quantile_cont({x}, 0.5), 2) AS median, round(stddev_samp({x}), 2) AS std,
  round(skewness({x}), 2) AS skewness, round(kurtosis({x}), 2) AS kurtosis,
  CAST(min({x}) AS DOUBLE) AS min, CAST(max({x}) AS DOUBLE) AS max,
  round(quantile_cont({x}, 0.25), 6) AS q25, round(quantile_cont({x}, 0.75), 6) AS q75 FROM {src}"""
                    for x in cols])


def _univariate_out(df):
    return df.select("feature", "mean", "median", "std", "skewness", "kurtosis", "min", "max",
                     r6(F.col("q25")).alias("q25"), r6(F.col("q75")).alias("q75"))


FLAGSHIP_FILTER = {"l_quantity": {"min": 1, "max": 50}, "l_discount": {"min": 0.0, "max": 0.1}}


def flagship(spark, d):
    """Scan -> range filter (pushed into the Parquet scan) -> duplicate removal ->
    exact univariate profile of the measures."""
    li = table(spark, d, "lineitem")
    kept = clean.dedup_rows(clean.filter_rows(li, FLAGSHIP_FILTER))
    return _univariate_out(P.univariate_numeric(kept, LI_MEASURES))


@query("profile_flagship", "\n".join([
    "WITH fl AS (SELECT DISTINCT * FROM lineitem",
    "  WHERE l_quantity BETWEEN 1 AND 50 AND l_discount BETWEEN 0.0 AND 0.1)",
    _univariate_sql("fl", LI_MEASURES)]))
def profile_flagship(spark, d):
    return flagship(spark, d)


@query("univariate_numeric", _univariate_sql("lineitem", LI_MEASURES))
def univariate_numeric(spark, d):
    return _univariate_out(P.univariate_numeric(table(spark, d, "lineitem"), LI_MEASURES))


@query("overview_shape", "SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem")
def overview_shape(spark, d):
    return P.overview_shape(table(spark, d, "lineitem"))


LI_NULL_COLS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                "l_returnflag", "l_linestatus"]


@query("missing_profile", with_views(["li_nulls"], S.union([
    f"SELECT '{x}' AS feature, count(*) - count({x}) AS missing, "
    f"round((count(*) - count({x})) * 100.0 / count(*), 2) AS missing_pct FROM li_nulls" for x in LI_NULL_COLS])))
def missing_profile(spark, d):
    return P.missing_profile(li_nulls(spark, d))


DUP_COLS = ["l_orderkey", "l_returnflag", "l_linestatus", "l_quantity"]


@query("duplicate_count", f"""SELECT CAST((SELECT count(*) FROM lineitem) -
  (SELECT count(*) FROM (SELECT DISTINCT {', '.join(DUP_COLS)} FROM lineitem)) AS BIGINT) AS duplicates""")
def duplicate_count(spark, d):
    return P.duplicate_count(table(spark, d, "lineitem").select(*DUP_COLS))


@query("target_distribution", "SELECT l_returnflag AS value, count(*) AS n FROM lineitem GROUP BY 1")
def target_distribution(spark, d):
    return P.target_distribution(table(spark, d, "lineitem"), "l_returnflag")


LI_NULL_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("describe_numeric", with_views(["li_nulls"], S.union([f"""SELECT '{x}' AS feature, count({x}) AS count,
  round(avg({x}), 6) AS mean, round(stddev_samp({x}), 6) AS std, CAST(min({x}) AS DOUBLE) AS min,
  round(quantile_cont({x}, 0.25), 6) AS q25, round(quantile_cont({x}, 0.5), 6) AS q50,
  round(quantile_cont({x}, 0.75), 6) AS q75, CAST(max({x}) AS DOUBLE) AS max FROM li_nulls""" for x in LI_NULL_NUM])))
def describe_numeric(spark, d):
    out = P.describe_numeric(li_nulls(spark, d), LI_NULL_NUM)
    return out.select("feature", "count", *[r6(F.col(x)).alias(x) for x in ["mean", "std", "q25", "q50", "q75"]],
                      "min", "max")


LI_NULL_STR = ["l_returnflag", "l_linestatus"]


@query("categorical_profile", with_views(["li_nulls"], "SELECT v.feature, v.value, v.n, m.n_unique, m.mode FROM ("
                                         + S.union([f"SELECT '{x}' AS feature, {x} AS value, count(*) AS n "
                                                    f"FROM li_nulls GROUP BY {x}" for x in LI_NULL_STR])
                                         + ") v JOIN (" + S.union([
                                             f"SELECT '{x}' AS feature, count(DISTINCT {x}) AS n_unique, "
                                             f"(SELECT {x} FROM li_nulls WHERE {x} IS NOT NULL GROUP BY {x} "
                                             f"ORDER BY count(*) DESC, {x} LIMIT 1) AS mode FROM li_nulls"
                                             for x in LI_NULL_STR]) + ") m ON v.feature = m.feature"))
def categorical_profile(spark, d):
    return P.categorical_profile(li_nulls(spark, d), LI_NULL_STR)


HIST_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"]


@query("histogram30", S.union([f"""SELECT '{x}' AS feature, bin, round(mn + bin * (mx - mn) / 30, 6) AS bin_lo,
  count(*) AS n FROM (
    SELECT CAST(CASE WHEN mx = mn THEN 0 ELSE least(floor((CAST({x} AS DOUBLE) - mn) / (mx - mn) * 30), 29) END
                AS INTEGER) AS bin, mn, mx
    FROM lineitem, (SELECT CAST(min({x}) AS DOUBLE) AS mn, CAST(max({x}) AS DOUBLE) AS mx FROM lineitem)
    WHERE {x} IS NOT NULL)
  GROUP BY bin, mn, mx""" for x in HIST_COLS]))
def histogram30(spark, d):
    h = P.histogram(table(spark, d, "lineitem"), HIST_COLS, 30)
    return h.select("feature", "bin", r6(F.col("bin_lo")).alias("bin_lo"), "n")


def _box_sql(src: str, cols: list[str], target: str | None = None) -> str:
    parts = []
    for x in cols:
        g = f", {target} AS target" if target else ""
        gb = f" GROUP BY {target}" if target else ""
        jn = f" AND s.{target} = q.target" if target else ""
        q = (f"SELECT '{x}' AS feature{g}, quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.5) AS median, "
             f"quantile_cont({x}, 0.75) AS q3 FROM {src} WHERE {x} IS NOT NULL"
             + (f" AND {target} IS NOT NULL" if target else "") + gb)
        tsel = ", q.target" if target else ""
        parts.append(f"""SELECT q.feature{tsel}, round(q.q1, 6) AS q1, round(q.median, 6) AS median,
  round(q.q3, 6) AS q3, round(q.q3 - q.q1, 6) AS iqr,
  CAST(min(CASE WHEN s.{x} >= q.q1 - 1.5 * (q.q3 - q.q1) THEN s.{x} END) AS DOUBLE) AS lower_whisker,
  CAST(max(CASE WHEN s.{x} <= q.q3 + 1.5 * (q.q3 - q.q1) THEN s.{x} END) AS DOUBLE) AS upper_whisker,
  count(*) FILTER (WHERE s.{x} < q.q1 - 1.5 * (q.q3 - q.q1) OR s.{x} > q.q3 + 1.5 * (q.q3 - q.q1)) AS n_outliers
FROM {src} s JOIN ({q}) q ON s.{x} IS NOT NULL{jn}
GROUP BY q.feature{tsel}, q.q1, q.median, q.q3""")
    return S.union(parts)


def _box_out(df, target: bool = False):
    return df.select("feature", *(["target"] if target else []),
                     *[r6(F.col(x)).alias(x) for x in ["q1", "median", "q3", "iqr"]],
                     "lower_whisker", "upper_whisker", "n_outliers")


@query("boxplot_stats", with_views(["c360"], _box_sql("c360", C360_MEASURES)))
def boxplot_stats(spark, d):
    return _box_out(P.boxplot_stats(c360(spark, d), C360_MEASURES))


@query("boxplot_by_target", with_views(["c360"], _box_sql("c360", C360_MEASURES, "churn")))
def boxplot_by_target(spark, d):
    return _box_out(P.boxplot_by_target(c360(spark, d), "churn", C360_MEASURES), target=True)


PART_STR = ["p_name", "p_brand", "p_type"]


@query("univariate_categorical", S.union([f"""SELECT '{x}' AS feature, count(*) AS n_unique,
  min(value) FILTER (WHERE n = mx) AS most_frequent, any_value(mx) AS most_frequent_count,
  min(value) FILTER (WHERE n = mn) AS least_frequent, any_value(mn) AS least_frequent_count
FROM (SELECT value, n, max(n) OVER () AS mx, min(n) OVER () AS mn FROM
      (SELECT {x} AS value, count(*) AS n FROM part WHERE {x} IS NOT NULL GROUP BY {x}))""" for x in PART_STR]))
def univariate_categorical(spark, d):
    return P.univariate_categorical(table(spark, d, "part"), PART_STR)


@query("numeric_by_target", S.union([f"""SELECT '{x}' AS feature, l_returnflag AS target,
  round(avg({x}), 2) AS mean, round(quantile_cont({x}, 0.5), 2) AS median, round(stddev_samp({x}), 2) AS std
FROM lineitem WHERE {x} IS NOT NULL AND l_returnflag IS NOT NULL GROUP BY l_returnflag""" for x in LI_MEASURES]))
def numeric_by_target(spark, d):
    return P.numeric_by_target(table(spark, d, "lineitem"), "l_returnflag", LI_MEASURES)


C360_STR = ["region", "segment", "last_priority"]


@query("crosstab_pct", with_views(["c360"], "SELECT feature, value, target, n, round(n * 100.0 / sum(n) OVER "
                                  "(PARTITION BY feature, value), 6) AS pct FROM (" + S.union([
                                      f"SELECT '{x}' AS feature, {x} AS value, churn AS target, count(*) AS n "
                                      f"FROM c360 WHERE {x} IS NOT NULL AND churn IS NOT NULL GROUP BY {x}, churn"
                                      for x in C360_STR]) + ")"))
def crosstab_pct(spark, d):
    ct = P.crosstab_pct(c360(spark, d), "churn", C360_STR)
    return ct.select("feature", "value", "target", "n", r6(F.col("pct")).alias("pct"))


C360_CORR = ["acctbal", "tenure_months", "n_orders", "total_charges", "avg_charges", "returned_items",
             "avg_discount"]


@query("top_numeric_pairs", with_views(["c360"], f"""SELECT feature1, feature2, round(correlation, 6) AS correlation
FROM ({S.pearson_long('c360', C360_CORR)}) WHERE abs(correlation) > 0.3
ORDER BY abs(correlation) DESC, feature1, feature2 LIMIT 6"""))
def top_numeric_pairs(spark, d):
    t = P.top_numeric_pairs(c360(spark, d), C360_CORR, 0.3, 6)
    return t.select("feature1", "feature2", r6(F.col("correlation")).alias("correlation"))


@query("trend_line", with_views(["c360"], f"""SELECT feature1, feature2, round(slope, 6) AS slope,
  round(intercept, 6) AS intercept
FROM ({S.pearson_long('c360', C360_CORR, extra=True)}) WHERE abs(correlation) > 0.3
ORDER BY abs(correlation) DESC, feature1, feature2 LIMIT 6"""))
def trend_line(spark, d):
    t = P.trend_line_top_pairs(c360(spark, d), C360_CORR, 0.3, 6)
    return t.select("feature1", "feature2", r6(F.col("slope")).alias("slope"),
                    r6(F.col("intercept")).alias("intercept"))


# ---- J17: mutual information of dummy-encoded features with the target

MI_STR = ["region", "segment", "last_priority"]
MI_NUM = ["n_orders", "returned_items"]


def _importance_sql(top: int) -> str:
    # One indicator per category except the lowest (drop_first), plus discrete numerics.
    cats = S.union([f"SELECT '{x}' AS col, {x} AS cat FROM c360 WHERE {x} IS NOT NULL GROUP BY {x} "
                    f"HAVING {x} > (SELECT min({x}) FROM c360)" for x in MI_STR])
    rows = S.union([f"SELECT k.col || '_' || k.cat AS feature, "
                    f"CAST(CAST(coalesce(c.{x} = k.cat, false) AS INTEGER) AS VARCHAR) AS x, "
                    f"CAST(c.churn AS VARCHAR) AS y FROM c360 c, ({cats}) k WHERE k.col = '{x}'"
                    for x in MI_STR] +
                   [f"SELECT '{x}' AS feature, CAST({x} AS VARCHAR) AS x, CAST(churn AS VARCHAR) AS y FROM c360"
                    for x in MI_NUM])
    return with_views(["c360"], f"""SELECT feature, round(mi, 6) AS mi FROM (
WITH mi_rows AS (SELECT * FROM ({rows}) WHERE x IS NOT NULL AND y IS NOT NULL),
mi_xy AS (SELECT feature, x, y, count(*) AS nxy FROM mi_rows GROUP BY feature, x, y),
mi_x AS (SELECT feature, x, count(*) AS nx FROM mi_rows GROUP BY feature, x),
mi_y AS (SELECT feature, y, count(*) AS ny FROM mi_rows GROUP BY feature, y),
mi_n AS (SELECT feature, count(*) AS n FROM mi_rows GROUP BY feature)
SELECT a.feature, greatest(sum(a.nxy / n.n * ln(a.nxy * n.n / (x.nx * y.ny))), 0) AS mi
FROM mi_xy a JOIN mi_x x ON a.feature = x.feature AND a.x = x.x
JOIN mi_y y ON a.feature = y.feature AND a.y = y.y JOIN mi_n n ON a.feature = n.feature
GROUP BY a.feature) ORDER BY mi DESC, feature LIMIT {top}""")


@query("feature_importance_mi", _importance_sql(15))
def feature_importance_mi(spark, d):
    mi = feature_importance(c360(spark, d), "churn", MI_STR, MI_NUM, estimator="bins").orderBy(F.desc("mi"), "feature").limit(15)
    return mi.select("feature", r6(F.col("mi")).alias("mi"))


def _key_findings_sql() -> str:
    from .q_profile import C360_CORR as NUMS
    corr = S.pearson_long("c360", NUMS)
    cv = S.cramers_v_grid("c360", S.pairs(MI_STR), 3)
    imp = _importance_sql(10 ** 6)
    imp_body = imp[imp.index("SELECT feature, round(mi, 6)"):]
    return with_views(["c360"], f"""SELECT
  (SELECT count(*) FROM ({corr}) WHERE abs(correlation) >= 0.7) AS n_high_correlations,
  (SELECT count(*) FROM {cv} WHERE cramers_v > 0.5) AS n_high_associations,
  (SELECT string_agg(feature, ',' ORDER BY mi DESC, feature) FROM (
     SELECT * FROM ({imp_body}) ORDER BY mi DESC, feature LIMIT 5)) AS top_features""")


@query("eda_key_findings", _key_findings_sql())
def eda_key_findings(spark, d):
    from ..operators.assoc import cramers_v_matrix
    df = c360(spark, d)
    imp = feature_importance(df, "churn", MI_STR, MI_NUM, estimator="bins")
    # MI rounded as in the importance report, so ties order the same way as the oracle.
    imp = imp.select("feature", r6(F.col("mi")).alias("mi"))
    return P.eda_key_findings(P.correlation_long(df, C360_CORR), cramers_v_matrix(df, MI_STR), imp)


_CAT = ["l_linestatus", "l_status2", "l_quantity_text"]
_CAT_ROWS = """(SELECT l_returnflag, CASE WHEN l_orderkey % 9 = 0 THEN NULL ELSE l_linestatus END AS l_linestatus,
  CAST(l_linenumber AS VARCHAR) AS l_status2, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS l_quantity_text FROM lineitem)"""


def _category_sql() -> str:
    parts = []
    for x in _CAT:
        counts = f"(SELECT {x} AS v, count(*) AS n FROM {_CAT_ROWS} GROUP BY 1)"
        for stat, e in (("n_unique", "count(*)"), ("most_frequent_count", "max(n)"), ("least_frequent_count", "min(n)")):
            parts.append(f"SELECT 'univariate' AS section, '{x}' AS feature, '{stat}' AS stat, "
                         f"CAST({e} AS DOUBLE) AS value FROM {counts} WHERE v IS NOT NULL")
        parts.append(f"SELECT 'level', '{x}' || coalesce('=' || v, ''), 'n', CAST(n AS DOUBLE) FROM {counts}")
        cross = f"""(SELECT {x} AS v, l_returnflag AS y, count(*) AS n, sum(count(*)) OVER (PARTITION BY {x}) AS total
          FROM {_CAT_ROWS} WHERE {x} IS NOT NULL GROUP BY 1, 2)"""
        parts.append(f"SELECT 'crosstab', '{x}=' || v || '|' || y, 'n', CAST(n AS DOUBLE) FROM {cross}")
        parts.append(f"SELECT 'crosstab', '{x}=' || v || '|' || y, 'pct', round(n * 100.0 / total, 6) FROM {cross}")
    return " UNION ALL ".join(parts)


@query("eda_category_sections", _category_sql())
def eda_category_sections(spark, d):
    """A9: levels, univariate statistics and crosstabs from the report's one table of cells."""
    li = table(spark, d, "lineitem").select(
        "l_returnflag", F.when(F.col("l_orderkey") % 9 != 0, F.col("l_linestatus")).alias("l_linestatus"),
        F.col("l_linenumber").cast("string").alias("l_status2"), F.col("l_quantity").cast("long").cast("string").alias("l_quantity_text"))
    got = R.category_sections(R.category_cells(li, _CAT, "l_returnflag"), "l_returnflag")
    out = got["univariate"].unionByName(got["level"]).unionByName(got["crosstab"])
    return out.select("section", "feature", "stat", r6(F.col("value")).alias("value"))
