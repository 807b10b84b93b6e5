"""Scalers (section E) as fit -> params, apply -> projection.

standard: (x - mean) / population std, std 0 -> divisor 1;
minmax:   (x - min) / (max - min), constant column -> 0;
robust:   (x - median) / (q75 - q25), exact linear quantiles, IQR 0 -> divisor 1.
Spark ML's scalers differ (sample std, 0.5 for a constant, approximate quantiles),
so these are plain aggregates + projections.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c, default_scale_columns, numeric, present, unpivot_numeric
from ..functions.params import load_params, params_from_rows
from ..functions.ranks import quantiles_wide

METHODS = ("standard", "minmax", "robust")


def fit_scaler(df: DataFrame, method: str = "standard", cols: list[str] | None = None,
               targets: list[str] = ()) -> DataFrame | None:
    if method not in METHODS:
        raise ValueError(f"Unknown scaling method: {method}")
    cols = present(df, cols) if cols is not None else default_scale_columns(df, targets)
    if not cols:
        return None
    spark = df.sparkSession
    rows = []
    if method == "robust":
        q = quantiles_wide(df, cols, [0.25, 0.5, 0.75], ["q25", "q50", "q75"]).collect()
        got = {r["feature"]: r for r in q}
        for col in cols:
            r = got.get(col)
            med = r["q50"] if r else None
            iqr = (r["q75"] - r["q25"]) if r else None
            rows += [("robust", col, "center", med, None),
                     ("robust", col, "scale", 1.0 if iqr in (None, 0.0) else iqr, None)]
    else:
        long = unpivot_numeric(df, cols)
        if method == "standard":
            aggs = [F.avg("value").alias("a"), F.stddev_pop("value").alias("b")]
        else:
            aggs = [F.min("value").alias("a"), F.max("value").alias("b")]
        got = {r["feature"]: r for r in long.groupBy("feature").agg(*aggs).collect()}
        for col in cols:
            r = got.get(col)
            a, b = (r["a"], r["b"]) if r else (None, None)
            if method == "standard":
                rows += [("standard", col, "center", a, None),
                         ("standard", col, "scale", 1.0 if b in (None, 0.0) else b, None)]
            else:
                rng = None if a is None else b - a
                rows += [("minmax", col, "center", a, None),
                         ("minmax", col, "scale", 1.0 if rng in (None, 0.0) else rng, None)]
    return params_from_rows(spark, rows)


def apply_scaler(df: DataFrame, params: DataFrame | None) -> DataFrame:
    if params is None:
        return df
    p = {}
    for op in METHODS:
        p.update(load_params(params, op))
    out = []
    for f in df.columns:
        if f in p:
            ctr, scl = p[f].get("center"), p[f].get("scale")
            x = numeric(df, f)
            out.append(((x - F.lit(ctr)) / F.lit(scl)).alias(f) if ctr is not None else x.alias(f))
        else:
            out.append(c(f))
    return df.select(*out)


def scale(df: DataFrame, method: str = "standard", cols: list[str] | None = None):
    p = fit_scaler(df, method, cols)
    return apply_scaler(df, p), p
