"""Missing-value imputation (section C): fit -> params table, apply -> projection.

Strategies: numeric ``mean`` / ``median`` / ``constant`` (0) / ``most_frequent``;
categorical ``most_frequent`` / ``constant`` (``missing_value``).  ``drop`` removes
rows with any NULL.  Before imputing, columns with a null ratio strictly above
``threshold`` are dropped.  Divergences from the reference: fit is meant to run on
the training part only, the target is excluded, an unknown strategy raises.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c, numeric, numeric_columns, string_columns, unpivot_numeric, unpivot_strings
from ..functions.params import load_params, params_from_rows
from ..functions.ranks import quantile_table
from .clean import drop_null_rows, drop_sparse_columns
from .knn import knn_impute

NUMERIC_STRATEGIES = ("mean", "median", "constant", "most_frequent")
CATEGORICAL_STRATEGIES = ("most_frequent", "constant")
# Fixed fill values of scikit-learn's SimpleImputer(strategy="constant") defaults.
NUMERIC_CONSTANT = 0.0
STRING_CONSTANT = "missing_value"


def most_frequent(long_df: DataFrame) -> DataFrame:
    """Mode per feature, ties -> smallest value: (feature, value, count).

    Value counts are one aggregate, the best (count, value) per feature another, both
    combined before their shuffle, so no task sees a feature as a whole."""
    vc = long_df.where(F.col("value").isNotNull()).groupBy("feature", "value") \
        .agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("b")
    return vc.groupBy("feature").agg(best).select("feature", "b.value", (-F.col("b.n")).alias("n"))


def fit_impute(df: DataFrame, numeric_strategy: str = "mean",
               categorical_strategy: str = "most_frequent",
               numeric_cols: list[str] | None = None, categorical_cols: list[str] | None = None,
               exclude: list[str] = ()) -> DataFrame:
    if numeric_strategy not in NUMERIC_STRATEGIES:
        raise ValueError(f"Unknown numeric strategy: {numeric_strategy}")
    if categorical_strategy not in CATEGORICAL_STRATEGIES:
        raise ValueError(f"Unknown categorical strategy: {categorical_strategy}")
    spark = df.sparkSession
    num = numeric_cols if numeric_cols is not None else numeric_columns(df, exclude)
    cat = categorical_cols if categorical_cols is not None else string_columns(df, exclude)
    rows: list[tuple] = []
    if num:
        if numeric_strategy == "mean":
            r = unpivot_numeric(df, num).groupBy("feature").agg(F.avg("value").alias("v")).collect()
            got = {x["feature"]: x["v"] for x in r}
            rows += [("impute_num", k, "fill", got.get(k), None) for k in num]
        elif numeric_strategy == "median":
            got = {x["feature"]: x["quantile"] for x in quantile_table(df, num, [0.5]).collect()}
            rows += [("impute_num", k, "fill", got.get(k), None) for k in num]
        elif numeric_strategy == "constant":
            rows += [("impute_num", k, "fill", NUMERIC_CONSTANT, None) for k in num]
        else:
            got = {x["feature"]: x["value"] for x in most_frequent(unpivot_numeric(df, num)).collect()}
            rows += [("impute_num", k, "fill", got.get(k), None) for k in num]
    if cat:
        if categorical_strategy == "constant":
            rows += [("impute_cat", k, "fill", None, STRING_CONSTANT) for k in cat]
        else:
            got = {x["feature"]: x["value"] for x in most_frequent(unpivot_strings(df, cat)).collect()}
            rows += [("impute_cat", k, "fill", None, got.get(k)) for k in cat]
    return params_from_rows(spark, rows)


def apply_impute(df: DataFrame, params: DataFrame) -> DataFrame:
    """Numeric columns become double (as the reference's imputer returns floats)."""
    num = load_params(params, "impute_num")
    cat = load_params(params, "impute_cat")
    out = []
    for f in df.columns:
        if f in num:
            v = num[f].get("fill")
            col = numeric(df, f)
            out.append((F.coalesce(col, F.lit(v).cast("double")) if v is not None else col).alias(f))
        elif f in cat:
            v = cat[f].get("fill")
            out.append((F.coalesce(c(f), F.lit(v)) if v is not None else c(f)).alias(f))
        else:
            out.append(c(f))
    return df.select(*out)


def handle_missing_values(df: DataFrame, strategy: str = "simple", numeric_strategy: str = "mean",
                          categorical_strategy: str = "most_frequent", threshold: float = 0.5,
                          exclude: list[str] = (), key: str | None = None, n_neighbors: int = 5,
                          donors: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Drop sparse columns, then impute (``simple``), impute numeric columns from the
    nearest rows and strings by their mode (``knn``; ``key`` orders equal distances and
    ``donors`` are the training rows, by default the table itself), or drop rows
    (``drop``)."""
    kept, _ = drop_sparse_columns(df, threshold)
    if strategy == "drop":
        return drop_null_rows(kept), None
    if strategy == "knn":
        if key is None:
            raise ValueError("strategy 'knn' needs a key column")
        num = [x for x in numeric_columns(kept, [*exclude, key]) if donors is None or x in donors.columns]
        params = fit_impute(kept if donors is None else donors, "mean", categorical_strategy, numeric_cols=[],
                            categorical_cols=string_columns(kept, [*exclude, key]))
        return apply_impute(knn_impute(kept, num, key, n_neighbors, donors), params), params
    if strategy != "simple":
        raise ValueError(f"Unknown strategy: {strategy}")
    params = fit_impute(kept, numeric_strategy, categorical_strategy, exclude=exclude)
    return apply_impute(kept, params), params
