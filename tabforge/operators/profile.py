"""Profiling / EDA (section J).  Every statistic family is one aggregate over all
columns (numeric columns through a long ``(feature, value)`` table), quantiles are
exact and distributed (:mod:`tabforge.functions.ranks`), results are long tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c, is_missing, numeric, numeric_columns, string_columns, unpivot_numeric, unpivot_strings
from ..functions.ranks import exact_quantiles, quantiles_wide
from ..functions.stats import pearson, sample_kurtosis, sample_skewness, rnd
from ..sources.schema import dtype_counts as _dtype_counts

HIST_BINS = 30
WHISKER = 1.5


def overview_shape(df: DataFrame) -> DataFrame:
    """(n_rows, n_columns)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).alias("n_columns"))


def dtype_counts(df: DataFrame) -> DataFrame:
    return _dtype_counts(df)


def missing_profile(df: DataFrame) -> DataFrame:
    """(feature, missing, missing_pct) with the percentage rounded to 2 decimals."""
    n = F.count(F.lit(1))
    structs = F.array(*[F.struct(F.lit(x).alias("feature"),
                                 F.count_if(is_missing(x, df.schema[x].dataType)).alias("missing"))
                        for x in df.columns])
    return df.agg(structs.alias("s"), n.alias("n")).select(F.inline("s"), "n").select(
        "feature", "missing",
        rnd(F.try_divide(F.col("missing") * 100.0, F.col("n")), 2).alias("missing_pct"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows minus distinct rows (NULLs equal), in one grouped aggregate."""
    g = df.groupBy(*[c(x) for x in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum("_n") - F.count(F.lit(1)), F.lit(0)).cast("bigint").alias("duplicates"))


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """Value counts of the target (NULL excluded, as pandas)."""
    return df.where(c(target).isNotNull()).groupBy(c(target).alias("value")) \
        .agg(F.count(F.lit(1)).alias("n"))


def _moments_and_quartiles(long: DataFrame, names: dict[float, str]) -> DataFrame:
    """Moments (one aggregate) and exact quartiles per feature."""
    stats = long.groupBy("feature").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"), sample_skewness(F.col("value")).alias("skewness"),
        sample_kurtosis(F.col("value")).alias("kurtosis"))
    q = exact_quantiles(long, ["feature"], list(names))
    qw = q.groupBy("feature").agg(*[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n)
                                    for p, n in names.items()])
    return stats.join(qw, "feature", "left")


def describe_numeric(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """pandas ``describe``: count, mean, std (n-1), min, 25/50/75 % (exact), max."""
    cols = cols if cols is not None else numeric_columns(df)
    j = _moments_and_quartiles(unpivot_numeric(df, cols), {0.25: "q25", 0.5: "q50", 0.75: "q75"})
    return j.select("feature", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def univariate_numeric(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """mean, median, std, skewness, kurtosis rounded to 2 decimals; min, max, q25, q75."""
    cols = cols if cols is not None else numeric_columns(df)
    j = _moments_and_quartiles(unpivot_numeric(df, cols), {0.25: "q25", 0.5: "median", 0.75: "q75"})
    return j.select("feature", rnd("mean", 2).alias("mean"), rnd("median", 2).alias("median"),
                    rnd("std", 2).alias("std"), rnd("skewness", 2).alias("skewness"),
                    rnd("kurtosis", 2).alias("kurtosis"), "min", "max", "q25", "q75")


def histogram(df: DataFrame, cols: list[str] | None = None, bins: int = HIST_BINS) -> DataFrame:
    """Equal-width histogram per feature: (feature, bin, bin_lo, n); the maximum lands
    in the last bin, a one-value column has a single bin 0; empty bins are omitted."""
    cols = cols if cols is not None else numeric_columns(df)
    long = unpivot_numeric(df, cols)
    rng = long.groupBy("feature").agg(F.min("value").alias("mn"), F.max("value").alias("mx"))
    # rng has one row per feature: bounded.
    j = long.join(F.broadcast(rng), "feature")
    width = F.col("mx") - F.col("mn")
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - F.col("mn")) / width * bins).cast("int"), F.lit(bins - 1)))
    h = j.select("feature", b.alias("bin"), "mn", "mx").groupBy("feature", "bin") \
        .agg(F.count(F.lit(1)).alias("n"), F.first("mn").alias("mn"), F.first("mx").alias("mx"))
    return h.select("feature", "bin", (F.col("mn") + F.col("bin") * (F.col("mx") - F.col("mn")) / bins)
                    .alias("bin_lo"), "n")


def _box(long: DataFrame, group: list[str]) -> DataFrame:
    q = exact_quantiles(long, group, [0.25, 0.5, 0.75]).groupBy(*group).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n)
          for p, n in [(0.25, "q1"), (0.5, "median"), (0.75, "q3")]])
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    lo = F.col("q1") - WHISKER * F.col("iqr")
    hi = F.col("q3") + WHISKER * F.col("iqr")
    j = long.join(q, group)
    return j.groupBy(*group).agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.first("iqr").alias("iqr"),
        F.min(F.when(F.col("value") >= lo, F.col("value"))).alias("lower_whisker"),
        F.max(F.when(F.col("value") <= hi, F.col("value"))).alias("upper_whisker"),
        F.count_if((F.col("value") < lo) | (F.col("value") > hi)).alias("n_outliers"))


def boxplot_stats(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = cols if cols is not None else numeric_columns(df)
    return _box(unpivot_numeric(df, cols), ["feature"])


def boxplot_by_target(df: DataFrame, target: str, cols: list[str] | None = None) -> DataFrame:
    cols = cols if cols is not None else numeric_columns(df, [target])
    long = unpivot_numeric(df, cols, keep=[target]).where(c(target).isNotNull()) \
        .withColumnRenamed(target, "target")
    return _box(long, ["feature", "target"])


def _value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    return unpivot_strings(df, cols).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def categorical_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(feature, value, n, n_unique, mode): value counts with NULL as its own row
    (``unique()`` lists NULL), ``n_unique`` without NULL, mode ties -> smallest."""
    cols = cols if cols is not None else string_columns(df)
    vc = _value_counts(df, cols)
    nn = vc.where(F.col("value").isNotNull())
    best = nn.groupBy("feature").agg(F.max("n").alias("_m"), F.count(F.lit(1)).alias("n_unique"))
    mode = nn.join(best, "feature").where(F.col("n") == F.col("_m")).groupBy("feature", "n_unique") \
        .agg(F.min("value").alias("mode"))
    # mode has one row per column: bounded.
    return vc.join(F.broadcast(mode), "feature", "left").select("feature", "value", "n", "n_unique", "mode")


def univariate_categorical(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(feature, n_unique, most_frequent, most_frequent_count, least_frequent,
    least_frequent_count); ties broken by the smallest value."""
    cols = cols if cols is not None else string_columns(df)
    vc = _value_counts(df, cols).where(F.col("value").isNotNull())
    agg = vc.groupBy("feature").agg(F.count(F.lit(1)).alias("n_unique"), F.max("n").alias("mx"),
                                    F.min("n").alias("mn"))
    j = vc.join(F.broadcast(agg), "feature")
    return j.groupBy("feature").agg(
        F.first("n_unique").alias("n_unique"),
        F.min(F.when(F.col("n") == F.col("mx"), F.col("value"))).alias("most_frequent"),
        F.first("mx").alias("most_frequent_count"),
        F.min(F.when(F.col("n") == F.col("mn"), F.col("value"))).alias("least_frequent"),
        F.first("mn").alias("least_frequent_count"))


def numeric_by_target(df: DataFrame, target: str, cols: list[str] | None = None,
                      limit: int | None = None) -> DataFrame:
    """(feature, target, mean, median, std) per class, rounded to 2 decimals.
    The reference shows only the first 6 numeric columns; ``limit`` restores that."""
    cols = cols if cols is not None else numeric_columns(df, [target])
    if limit:
        cols = cols[:limit]
    long = unpivot_numeric(df, cols, keep=[target]).where(c(target).isNotNull()) \
        .withColumnRenamed(target, "target")
    m = long.groupBy("feature", "target").agg(F.avg("value").alias("mean"),
                                              F.stddev_samp("value").alias("std"))
    q = exact_quantiles(long, ["feature", "target"], [0.5]).select("feature", "target",
                                                                    F.col("quantile").alias("median"))
    return m.join(q, ["feature", "target"], "left").select(
        "feature", "target", rnd("mean", 2).alias("mean"), rnd("median", 2).alias("median"),
        rnd("std", 2).alias("std"))


def crosstab_pct(df: DataFrame, target: str, cols: list[str] | None = None,
                 limit: int | None = None) -> DataFrame:
    """(feature, value, target, n, pct): counts and row percentages (rows with a NULL
    feature or target are excluded, as ``pd.crosstab``)."""
    cols = cols if cols is not None else string_columns(df, [target])
    if limit:
        cols = cols[:limit]
    long = unpivot_strings(df, cols, keep=[target], drop_nulls=True).where(c(target).isNotNull())
    cnt = long.groupBy("feature", "value", c(target).alias("target")).agg(F.count(F.lit(1)).alias("n"))
    rows = cnt.groupBy("feature", "value").agg(F.sum("n").alias("_row"))
    return cnt.join(rows, ["feature", "value"]).select(
        "feature", "value", "target", "n", (F.col("n") * 100.0 / F.col("_row")).alias("pct"))


def pair_list(cols: list[str]) -> list[tuple[str, str]]:
    return [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i + 1, len(cols))]


def correlation_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """Upper triangle (i < j) of the pairwise-complete Pearson matrix in one aggregate:
    (feature1, feature2, correlation)."""
    pairs = pair_list(cols)
    if not pairs:
        return df.sparkSession.createDataFrame([], "feature1 string, feature2 string, correlation double")
    arr = F.array(*[F.struct(F.lit(a).alias("feature1"), F.lit(b).alias("feature2"),
                             pearson(numeric(df, a), numeric(df, b)).alias("correlation"))
                    for a, b in pairs])
    return df.agg(arr.alias("s")).select(F.inline("s"))


def top_numeric_pairs(df: DataFrame, cols: list[str] | None = None, threshold: float = 0.3,
                      top: int = 6) -> DataFrame:
    """Pairs with |r| > threshold (strict), strongest first, at most ``top``."""
    cols = cols if cols is not None else numeric_columns(df)
    r = correlation_long(df, cols).where(F.abs("correlation") > threshold)
    return r.orderBy(F.abs("correlation").desc(), "feature1", "feature2").limit(top)


def trend_lines(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Degree-1 least-squares fit y = slope*x + intercept per pair (pairwise-complete)."""
    arr = F.array(*[F.struct(F.lit(a).alias("feature1"), F.lit(b).alias("feature2"),
                             F.regr_slope(numeric(df, b), numeric(df, a)).alias("slope"),
                             F.regr_intercept(numeric(df, b), numeric(df, a)).alias("intercept"))
                    for a, b in pairs])
    return df.agg(arr.alias("s")).select(F.inline("s"))


def trend_line_top_pairs(df: DataFrame, cols: list[str] | None = None, threshold: float = 0.3,
                         top: int = 6) -> DataFrame:
    tp = top_numeric_pairs(df, cols, threshold, top).collect()  # at most `top` rows
    pairs = [(r["feature1"], r["feature2"]) for r in tp]
    if not pairs:
        return df.sparkSession.createDataFrame(
            [], "feature1 string, feature2 string, slope double, intercept double")
    return trend_lines(df, pairs)


def eda_key_findings(corr_long: DataFrame, cramers_long: DataFrame, importance: DataFrame,
                     corr_threshold: float = 0.7, assoc_threshold: float = 0.5, top: int = 5) -> DataFrame:
    """J18 summary row: number of numeric pairs with |r| >= 0.7, of categorical pairs
    with V > 0.5, and the top features by importance (comma separated, best first)."""
    nc = corr_long.agg(F.count_if(F.abs("correlation") >= corr_threshold).alias("n")).first()["n"]
    na = cramers_long.agg(F.count_if(F.col("cramers_v") > assoc_threshold).alias("n")).first()["n"]
    tf = ",".join(r["feature"] for r in importance.orderBy(F.desc("mi"), "feature").limit(top).collect())
    spark = corr_long.sparkSession
    return spark.createDataFrame([(int(nc), int(na), tf)],
                                 "n_high_correlations bigint, n_high_associations bigint, top_features string")


def eda_report_long(df: DataFrame, target: str | None = None) -> DataFrame:
    """The EDA report as one long table (section, feature, stat, value):

    * ``overview``: n_rows, n_columns;  ``missing``: missing, missing_pct per column;
    * ``describe``: count, mean, std, min, quartiles, max per numeric column;
    * ``shape``: bias-corrected skewness and excess kurtosis per numeric column;
    * ``categorical``: n_unique per string column;
    * ``correlation``: Pearson r per numeric pair (feature ``a|b``);
    * ``target``: class counts of the target, when given.
    """
    num = numeric_columns(df, [target] if target else [])
    strs = string_columns(df, [target] if target else [])

    def long(d, section, stats, feature=F.col("feature")):
        return d.select(F.lit(section).alias("section"), feature.alias("feature"),
                        F.explode(F.create_map(*[x for st in stats for x in (F.lit(st), F.col(st).cast("double"))])))

    parts = [long(overview_shape(df), "overview", ["n_rows", "n_columns"], F.lit("*")),
             long(missing_profile(df), "missing", ["missing", "missing_pct"])]
    if num:
        parts.append(long(describe_numeric(df, num), "describe",
                          ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]))
        shape = unpivot_numeric(df, num).groupBy("feature").agg(
            sample_skewness(F.col("value")).alias("skewness"), sample_kurtosis(F.col("value")).alias("kurtosis"))
        parts.append(long(shape, "shape", ["skewness", "kurtosis"]))
    if strs:
        nu = unpivot_strings(df, strs, drop_nulls=True).distinct().groupBy("feature") \
            .agg(F.count(F.lit(1)).alias("n_unique"))
        parts.append(long(nu, "categorical", ["n_unique"]))
    if len(num) > 1:
        corr = correlation_long(df, num)
        parts.append(long(corr, "correlation", ["correlation"],
                          F.concat_ws("|", F.col("feature1"), F.col("feature2"))))
    if target:
        td = target_distribution(df, target)
        parts.append(long(td, "target", ["n"], F.col("value").cast("string")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("section", "feature", F.col("key").alias("stat"), "value")


__all__ = [n for n in dir() if not n.startswith("_")] + ["quantiles_wide"]
