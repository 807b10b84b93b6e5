"""Projection, filter, dedup and recode operators (section B)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c, is_missing, normalise_nan


def dedup_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Full-row (or subset) duplicate removal; one hash aggregate with map-side combine."""
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop columns, ignoring absent ones."""
    return df.drop(*[x for x in columns if x in df.columns])


def filter_rows(df: DataFrame, conditions: dict) -> DataFrame:
    """``{col: {"min": a, "max": b}}`` (inclusive, both optional) and
    ``{col: {"values": [...]}}``; conditions are ANDed, NULL fails, absent columns
    are ignored.  A condition that is not a dict raises (the reference ignores it)."""
    out = df
    for col, cond in conditions.items():
        if not isinstance(cond, dict):
            raise ValueError(f"Condition for {col} must be a dict, got {type(cond).__name__}")
        if col not in df.columns:
            continue
        if "min" in cond or "max" in cond:
            out = range_filter(out, col, cond.get("min"), cond.get("max"))
        if "values" in cond:
            out = membership_filter(out, col, cond["values"])
    return out


def range_filter(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    """Inclusive range; stays a native predicate so Parquet pushdown applies."""
    if lo is not None and hi is not None:
        return df.where(c(col).between(lo, hi))
    if lo is not None:
        return df.where(c(col) >= lo)
    if hi is not None:
        return df.where(c(col) <= hi)
    return df


def membership_filter(df: DataFrame, col: str, values) -> DataFrame:
    """``col IN values``: a list is a literal predicate whatever its length (pushed to
    the scan); values that are data come as a DataFrame and are a semi join."""
    if isinstance(values, DataFrame):
        v = values.select(values.columns[0]).withColumnRenamed(values.columns[0], "_v")
        return df.join(v, c(col) == F.col("_v"), "left_semi")
    return df.where(c(col).isin(list(values)))


def blank_to_number(df: DataFrame, col: str, blank: str = " ", out: str | None = None) -> DataFrame:
    """Blank text -> NULL, then numeric coercion (unparsable -> NULL)."""
    v = F.try_cast(F.nullif(c(col), F.lit(blank)), "double") if hasattr(F, "try_cast") else \
        F.expr(f"try_cast(nullif(`{col}`, '{blank}') as double)")
    return df.withColumn(out or col, v)


def recode_values(df: DataFrame, col: str, mapping: dict, out: str | None = None,
                  value_type: str | None = None) -> DataFrame:
    """Dictionary recode; an unmapped value (or NULL) becomes NULL.  For a mapping
    given as a DataFrame (key, value) a left join is used instead of literals."""
    if isinstance(mapping, DataFrame):
        k, v = mapping.columns[:2]
        m = mapping.select(F.col(k).alias("_rk"), F.col(v).alias("_rv"))
        target = out or col
        j = df.join(m, c(col) == F.col("_rk"), "left").drop("_rk")
        if target in df.columns:
            j = j.drop(target)
        return j.withColumnRenamed("_rv", target)
    expr = None
    for k, v in mapping.items():
        expr = (F.when(c(col) == F.lit(k), F.lit(v)) if expr is None
                else expr.when(c(col) == F.lit(k), F.lit(v)))
    if expr is None:
        expr = F.lit(None)
    if value_type:
        expr = expr.cast(value_type)
    return df.withColumn(out or col, expr)


def drop_null_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return normalise_nan(df, subset or df.columns).na.drop("any", subset=subset)


def null_ratios(df: DataFrame, cols: list[str] | None = None) -> dict[str, float]:
    """Missing ratio (NULL or NaN) of every column in one aggregate (one row comes back)."""
    cols = cols or df.columns
    row = df.agg(*[F.avg(is_missing(x, df.schema[x].dataType).cast("double")).alias(x) for x in cols]).first()
    return {x: (row[x] if row[x] is not None else 0.0) for x in cols}


def drop_sparse_columns(df: DataFrame, threshold: float = 0.5) -> tuple[DataFrame, list[str]]:
    """Drop columns whose null ratio is strictly above ``threshold``."""
    ratios = null_ratios(df)
    dropped = [x for x, r in ratios.items() if r > threshold]
    return df.drop(*dropped), dropped
