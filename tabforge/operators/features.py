"""Feature construction (sections G and H): pure projections, one fitted binning.

Generic building blocks take column/value lists; :func:`subscription_features`
applies them with the subscription-table column names when those are present.
pandas null semantics are kept where the reference relies on them: ``~isin`` and
``!=`` are True for NULL, ``==`` / ``isin`` / ``str.contains(na=False)`` are False.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import c, is_numeric, numeric

# ---------------------------------------------------------------- G: flags, counts


def _flag(pred: Column) -> Column:
    """pandas-style boolean -> int: a NULL comparison is False."""
    return F.coalesce(pred, F.lit(False)).cast("int")


def active_count(df: DataFrame, cols: list[str], inactive_values: list[str], out: str) -> DataFrame:
    """Number of columns whose value is NOT in ``inactive_values``; NULL counts as
    active (``~isin``); absent columns are skipped."""
    terms = [(~F.coalesce(c(x).isin(inactive_values), F.lit(False))).cast("int")
             for x in cols if x in df.columns]
    return df.withColumn(out, sum(terms, F.lit(0)) if terms else F.lit(0))


def count_equal(df: DataFrame, cols: list[str], value, out: str) -> DataFrame:
    """Number of columns equal to ``value`` (NULL counts 0)."""
    terms = [_flag(c(x) == F.lit(value)) for x in cols if x in df.columns]
    return df.withColumn(out, sum(terms, F.lit(0)) if terms else F.lit(0))


def ratio(df: DataFrame, num: str, den: str, out: str, plus: float = 1.0) -> DataFrame:
    """``num / (den + plus)``; division by zero gives NULL (ANSI mode would raise)."""
    return df.withColumn(out, F.try_divide(c(num).cast("double"), c(den).cast("double") + F.lit(plus)))


def equality_flag(df: DataFrame, col: str, value, out: str) -> DataFrame:
    return df.withColumn(out, _flag(c(col) == F.lit(value)))


def membership_flag(df: DataFrame, col: str, values: list, out: str) -> DataFrame:
    return df.withColumn(out, _flag(c(col).isin(values)))


def not_equal_flag(df: DataFrame, col: str, value, out: str) -> DataFrame:
    """pandas ``!=``: NULL counts as different (1)."""
    return df.withColumn(out, (~c(col).eqNullSafe(F.lit(value))).cast("int"))


def substring_flag(df: DataFrame, col: str, needle: str, out: str) -> DataFrame:
    """Case-insensitive substring test; NULL -> 0."""
    return df.withColumn(out, _flag(F.lower(c(col)).contains(needle.lower())))


def any_equal_flag(df: DataFrame, cols: list[str], value, out: str) -> DataFrame:
    preds = [F.coalesce(c(x) == F.lit(value), F.lit(False)) for x in cols]
    e = preds[0]
    for p in preds[1:]:
        e = e | p
    return df.withColumn(out, e.cast("int"))


# Fixed lifecycle boundaries (months) of the reference's tenure groups.
TENURE_NEW_MAX = 12
TENURE_GROWING_MAX = 24
TENURE_MATURE_MAX = 48
TENURE_VERY_NEW_MAX = 6
TENURE_LOYAL_MIN = 48


def tenure_buckets(df: DataFrame, col: str, prefix: str = "tenure_group") -> DataFrame:
    """new <= 12, growing (12, 24], mature (24, 48], loyal > 48; is_new_customer <= 6;
    is_loyal_customer >= 48 (48 is mature and loyal customer at once); NULL -> 0."""
    x = c(col)
    return df.select("*",
                     _flag(x <= TENURE_NEW_MAX).alias(f"{prefix}_new"),
                     _flag((x > TENURE_NEW_MAX) & (x <= TENURE_GROWING_MAX)).alias(f"{prefix}_growing"),
                     _flag((x > TENURE_GROWING_MAX) & (x <= TENURE_MATURE_MAX)).alias(f"{prefix}_mature"),
                     _flag(x > TENURE_MATURE_MAX).alias(f"{prefix}_loyal"),
                     _flag(x <= TENURE_VERY_NEW_MAX).alias("is_new_customer"),
                     _flag(x >= TENURE_LOYAL_MIN).alias("is_loyal_customer"))


# Fixed column names and values of the subscription (churn) table.
SERVICE_COLUMNS = ["PhoneService", "MultipleLines", "InternetService", "OnlineSecurity",
                   "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies"]
INACTIVE_SERVICE_VALUES = ["No", "No internet service", "No phone service"]
PREMIUM_COLUMNS = ["OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport"]


def subscription_features(df: DataFrame) -> DataFrame:
    """The reference's eight domain feature groups on a subscription table; groups
    whose input columns are absent are skipped."""
    has = set(df.columns)
    out = active_count(df, SERVICE_COLUMNS, INACTIVE_SERVICE_VALUES, "total_services")
    if {"MonthlyCharges", "tenure"} <= has:
        out = ratio(out, "TotalCharges", "tenure", "AvgMonthlyCharges")
        out = ratio(out, "MonthlyCharges", "total_services", "ChargesPerService")
    if "Contract" in has:
        out = equality_flag(out, "Contract", "Month-to-month", "is_month_to_month")
        out = membership_flag(out, "Contract", ["One year", "Two year"], "has_long_contract")
    if "PaymentMethod" in has:
        out = equality_flag(out, "PaymentMethod", "Electronic check", "risky_payment")
        out = substring_flag(out, "PaymentMethod", "automatic", "auto_payment")
    if "tenure" in has:
        out = tenure_buckets(out, "tenure")
    if "InternetService" in has:
        out = equality_flag(out, "InternetService", "Fiber optic", "has_fiber")
        out = not_equal_flag(out, "InternetService", "No", "has_internet")
        out = equality_flag(out, "InternetService", "DSL", "has_dsl")
    if {"Partner", "Dependents"} <= has:
        out = any_equal_flag(out, ["Partner", "Dependents"], "Yes", "has_family")
        out = count_equal(out, ["Partner", "Dependents"], "Yes", "family_size")
    return count_equal(out, PREMIUM_COLUMNS, "Yes", "premium_services_count")


# ---------------------------------------------------------------- H: generic features


def _numeric(df: DataFrame, col: str) -> bool:
    return col in df.columns and is_numeric(df.schema[col].dataType)


def poly_features(df: DataFrame, cols: list[str]) -> DataFrame:
    """``<c>_squared``, ``<c>_cubed`` (double, to stay clear of ANSI overflow)."""
    new = []
    for x in cols:
        if _numeric(df, x):
            v = c(x).cast("double")
            new += [(v * v).alias(f"{x}_squared"), (v * v * v).alias(f"{x}_cubed")]
    return df.select("*", *new)


def interaction_features(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    new = [(c(a).cast("double") * c(b).cast("double")).alias(f"{a}_{b}_interaction")
           for a, b in pairs if _numeric(df, a) and _numeric(df, b)]
    return df.select("*", *new)


def date_features(df: DataFrame, cols: list[str]) -> DataFrame:
    """year, month, day, dayofweek (Monday = 0), quarter; unparsable text -> NULL."""
    new = []
    for x in cols:
        if x not in df.columns:
            continue
        dt = df.schema[x].dataType
        ts = c(x) if isinstance(dt, (T.TimestampType, T.DateType, T.TimestampNTZType)) \
            else F.try_to_timestamp(c(x).cast("string"))
        new += [F.year(ts).alias(f"{x}_year"), F.month(ts).alias(f"{x}_month"),
                F.dayofmonth(ts).alias(f"{x}_day"), F.weekday(ts).alias(f"{x}_dayofweek"),
                F.quarter(ts).alias(f"{x}_quarter")]
    return df.select("*", *new)


def log_features(df: DataFrame, cols: list[str]) -> DataFrame:
    """``<c>_log = log1p(c)``; values <= -1 give NULL (NumPy gives -inf / NaN)."""
    return df.select("*", *[F.log1p(c(x).cast("double")).alias(f"{x}_log")
                            for x in cols if _numeric(df, x)])


def equal_width_edges(lo: float, hi: float, bins: int) -> list[float]:
    """pandas ``cut(bins=int)`` edges: linspace(min, max), lowest edge lowered by 0.1 %
    of the range; a constant column is widened by 0.1 % on both sides first."""
    if lo == hi:
        lo = lo - (0.001 * abs(lo) if lo != 0 else 0.001)
        hi = hi + (0.001 * abs(hi) if hi != 0 else 0.001)
        edges = np.linspace(lo, hi, bins + 1)
    else:
        edges = np.linspace(lo, hi, bins + 1)
        edges[0] -= (hi - lo) * 0.001
    return [float(e) for e in edges]


def bin_by_edges(x: Column, edges: list[float]) -> Column:
    """Right-closed bins ``(e_i, e_{i+1}]`` -> code i; outside (or the first edge) -> NULL."""
    inside = (x > F.lit(edges[0])) & (x <= F.lit(edges[-1]))
    code = sum([(x > F.lit(e)).cast("int") for e in edges[1:-1]], F.lit(0))
    return F.when(inside, code)


def fit_equal_width(df: DataFrame, bins: dict[str, int]) -> dict[str, list[float]]:
    cols = [x for x in bins if _numeric(df, x)]
    if not cols:
        return {}
    row = df.agg(*[F.min(numeric(df, x)).alias(f"mn_{i}") for i, x in enumerate(cols)],
                 *[F.max(numeric(df, x)).alias(f"mx_{i}") for i, x in enumerate(cols)]).first()
    out = {}
    for i, x in enumerate(cols):
        if row[f"mn_{i}"] is not None:
            out[x] = equal_width_edges(float(row[f"mn_{i}"]), float(row[f"mx_{i}"]), int(bins[x]))
    return out


def binning_features(df: DataFrame, spec: dict[str, int | list[float]],
                     fitted: dict[str, list[float]] | None = None) -> tuple[DataFrame, dict]:
    """``<c>_binned``: an int spec means equal-width bins fitted on df (edges returned
    so that scoring re-applies them); a list is explicit edges."""
    edges = dict(fitted or {})
    need = {k: v for k, v in spec.items() if isinstance(v, int) and k not in edges}
    edges.update(fit_equal_width(df, need))
    for k, v in spec.items():
        if not isinstance(v, int):
            edges[k] = [float(e) for e in v]
    new = [bin_by_edges(numeric(df, k), e).alias(f"{k}_binned") for k, e in edges.items()
           if k in df.columns]
    return df.select("*", *new), edges


def feature_engineering(df: DataFrame, config: dict | None = None,
                        fitted_edges: dict | None = None) -> tuple[DataFrame, dict]:
    """Config keys as the reference: polynomial_features, interaction_features,
    date_features, binning_features, log_transform.  Returns (df, fitted bin edges);
    passing the edges back at scoring time re-applies the same bins (H7)."""
    config = config or {}
    out = poly_features(df, config.get("polynomial_features", []))
    out = interaction_features(out, [tuple(p) for p in config.get("interaction_features", [])
                                     if len(p) == 2])
    out = date_features(out, config.get("date_features", []))
    out, edges = binning_features(out, config.get("binning_features", {}), fitted_edges)
    out = log_features(out, config.get("log_transform", []))
    return out, edges
