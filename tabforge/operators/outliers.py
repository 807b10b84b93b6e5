"""Outlier capping and replacement (section F).

iqr:    cap at q25 - t*IQR and q75 + t*IQR (exact linear quantiles), NULL kept.
zscore: |x - mean| / population std > t -> median (std 0 -> no outliers), NULL kept.
Two-valued (0/1) columns are skipped unless ``include_binary`` (the reference caps
sparse flags to a constant, see SURVEY F).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c, default_outlier_columns, numeric, present, unpivot_numeric
from ..functions.params import load_params, params_from_rows
from ..functions.ranks import quantiles_wide


def _many_valued(df: DataFrame, cols: list[str]) -> list[str]:
    """Columns with more than two values, exactly: some value lies strictly between the
    smallest and the largest.  Two aggregates for all columns."""
    ends = df.agg(*[f(numeric(df, x)).alias(f"{n}{i}") for i, x in enumerate(cols)
                    for n, f in (("lo", F.min), ("hi", F.max))]).first()
    inner = df.agg(*[F.count_if((numeric(df, x) > F.lit(ends[f"lo{i}"])) & (numeric(df, x) < F.lit(ends[f"hi{i}"])))
                     .alias(f"n{i}") for i, x in enumerate(cols)]).first()
    return [x for i, x in enumerate(cols) if inner[f"n{i}"]]


def fit_outliers(df: DataFrame, method: str = "iqr", threshold: float = 1.5,
                 cols: list[str] | None = None, targets: list[str] = (),
                 include_binary: bool = False) -> DataFrame:
    if method not in ("iqr", "zscore"):
        raise ValueError(f"Unknown outlier method: {method}")
    cols = present(df, cols) if cols is not None else default_outlier_columns(df, targets)
    if cols and not include_binary:
        cols = _many_valued(df, cols)
    spark = df.sparkSession
    rows = []
    if not cols:
        return params_from_rows(spark, rows)
    if method == "iqr":
        q = {r["feature"]: r for r in quantiles_wide(df, cols, [0.25, 0.75], ["q25", "q75"]).collect()}
        for col in cols:
            r = q.get(col)
            if r is None:
                continue
            iqr = r["q75"] - r["q25"]
            rows += [("iqr", col, "lo", r["q25"] - threshold * iqr, None),
                     ("iqr", col, "hi", r["q75"] + threshold * iqr, None)]
    else:
        med = {r["feature"]: r["q50"] for r in quantiles_wide(df, cols, [0.5], ["q50"]).collect()}
        mom = {r["feature"]: r for r in unpivot_numeric(df, cols).groupBy("feature").agg(
            F.avg("value").alias("m"), F.stddev_pop("value").alias("s")).collect()}
        for col in cols:
            if col not in mom:
                continue
            rows += [("zscore", col, "mean", mom[col]["m"], None),
                     ("zscore", col, "std", mom[col]["s"], None),
                     ("zscore", col, "median", med.get(col), None),
                     ("zscore", col, "threshold", float(threshold), None)]
    return params_from_rows(spark, rows)


def _flag(p: dict, col: str, x):
    if "lo" in p:
        return (x < F.lit(p["lo"])) | (x > F.lit(p["hi"]))
    s = p.get("std")
    if not s:
        return F.lit(False)
    return F.abs((x - F.lit(p["mean"])) / F.lit(s)) > F.lit(p["threshold"])


def apply_outliers(df: DataFrame, params: DataFrame) -> DataFrame:
    p = {**load_params(params, "iqr"), **load_params(params, "zscore")}
    out = []
    for f in df.columns:
        if f not in p:
            out.append(c(f))
            continue
        x = numeric(df, f)
        q = p[f]
        if "lo" in q:
            # least/greatest skip NULLs, so guard NULL explicitly.
            v = F.when(x.isNull(), x).otherwise(F.greatest(F.least(x, F.lit(q["hi"])), F.lit(q["lo"])))
        else:
            v = F.when(F.coalesce(_flag(q, f, x), F.lit(False)), F.lit(q["median"])).otherwise(x)
        out.append(v.alias(f))
    return df.select(*out)


def outlier_counts(df: DataFrame, params: DataFrame) -> DataFrame:
    """(feature, outliers) per column plus a ``__total__`` row; one aggregate."""
    p = {**load_params(params, "iqr"), **load_params(params, "zscore")}
    cols = [x for x in df.columns if x in p]
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], "feature string, outliers bigint")
    row = df.agg(*[F.count_if(F.coalesce(_flag(p[x], x, numeric(df, x)), F.lit(False))).alias(x)
                   for x in cols]).first()
    rows = [(x, int(row[x])) for x in cols]
    rows.append(("__total__", sum(v for _, v in rows)))
    return spark.createDataFrame(rows, "feature string, outliers bigint")


def handle_outliers(df: DataFrame, method: str = "iqr", threshold: float = 1.5,
                    cols: list[str] | None = None, include_binary: bool = False):
    p = fit_outliers(df, method, threshold, cols, include_binary=include_binary)
    return apply_outliers(df, p), p
