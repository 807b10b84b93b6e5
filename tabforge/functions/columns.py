"""Schema helpers: column classes, quoting, NaN normalisation, name filters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def c(name: str) -> Column:
    """Column reference that tolerates dots, dashes and spaces in the name."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_numeric(dt: T.DataType) -> bool:
    # Booleans and timestamps are in neither class, like pandas' select_dtypes.
    return isinstance(dt, T.NumericType)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in ex]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in ex]


def present(df: DataFrame, cols: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [x for x in cols if x in have]


def as_double(name: str, dt: T.DataType | None = None) -> Column:
    """Numeric column as double with NaN turned into NULL (Spark treats NaN as a value)."""
    col = c(name).cast("double")
    if dt is None or isinstance(dt, (T.FloatType, T.DoubleType)):
        return F.when(F.isnan(col), F.lit(None).cast("double")).otherwise(col)
    return col


def is_missing(name: str, dt: T.DataType) -> Column:
    """NULL, or NaN in a float column (pandas counts both as missing)."""
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return c(name).isNull() | F.isnan(c(name))
    return c(name).isNull()


def numeric(df: DataFrame, name: str) -> Column:
    """The column as double, NaN as NULL."""
    return as_double(name, df.schema[name].dataType)


def normalise_nan(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Replace NaN by NULL in float columns so that aggregates follow pandas' skipna."""
    cols = set(cols) if cols is not None else None
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)) and (cols is None or f.name in cols):
            out.append(F.when(F.isnan(c(f.name)), F.lit(None).cast(f.dataType))
                       .otherwise(c(f.name)).alias(f.name))
        else:
            out.append(c(f.name))
    return df.select(*out)


# Fixed name patterns used by the reference's default column choices.
EXCLUDED_SCALE_PREFIXES = ("is_", "has_", "risky_", "auto_")
EXCLUDED_SCALE_SUFFIXES = ("_binary",)
EXCLUDED_OUTLIER_SUFFIXES = ("_binary", "_encoded")


def default_scale_columns(df: DataFrame, targets: Iterable[str] = ()) -> list[str]:
    cols = numeric_columns(df, exclude=targets)
    return [x for x in cols if not x.startswith(EXCLUDED_SCALE_PREFIXES)
            and not x.endswith(EXCLUDED_SCALE_SUFFIXES)]


def default_outlier_columns(df: DataFrame, targets: Iterable[str] = ()) -> list[str]:
    cols = numeric_columns(df, exclude=targets)
    return [x for x in cols if not x.endswith(EXCLUDED_OUTLIER_SUFFIXES)]


def unpivot_numeric(df: DataFrame, cols: list[str], keep: list[str] | None = None,
                    drop_nulls: bool = True) -> DataFrame:
    """Long form (keep..., feature, value double); one row per input row and column."""
    keep = keep or []
    types = {f.name: f.dataType for f in df.schema.fields}
    pairs = F.array(*[F.struct(F.lit(x).alias("feature"), as_double(x, types[x]).alias("value"))
                      for x in cols])
    out = df.select(*[c(k) for k in keep], F.inline(pairs))
    if drop_nulls:
        out = out.where(F.col("value").isNotNull())
    return out


def unpivot_strings(df: DataFrame, cols: list[str], keep: list[str] | None = None,
                    drop_nulls: bool = False) -> DataFrame:
    """Long form (keep..., feature, value string)."""
    keep = keep or []
    pairs = F.array(*[F.struct(F.lit(x).alias("feature"), c(x).cast("string").alias("value"))
                      for x in cols])
    out = df.select(*[c(k) for k in keep], F.inline(pairs))
    if drop_nulls:
        out = out.where(F.col("value").isNotNull())
    return out
