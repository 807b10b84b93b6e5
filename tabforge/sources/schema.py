"""Schema checks and best-effort coercion (no job runs except one bounded aggregate)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import c, is_numeric


class MissingColumnsError(ValueError):
    pass


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Raise listing every required column that is absent; otherwise return df unchanged."""
    missing = [x for x in required if x not in df.columns]
    if missing:
        raise MissingColumnsError(f"Missing required columns: {missing}")
    return df


def coerce_types(df: DataFrame, schema_config: dict[str, str]) -> tuple[DataFrame, dict[str, bool]]:
    """Cast each listed column only if every non-null value converts; otherwise keep it
    unchanged (pandas ``astype`` either converts a whole column or raises).  Unknown
    columns are ignored.  One aggregate decides for all columns at once.

    Returns (new df, {column: converted?}).
    """
    todo = {k: v for k, v in schema_config.items() if k in df.columns}
    if not todo:
        return df, {}
    fails = df.agg(*[
        F.sum(F.when(c(k).isNotNull() & F.try_cast(c(k), v).isNull() if hasattr(F, "try_cast")
                     else F.expr(f"`{k}` is not null and try_cast(`{k}` as {v}) is null"), 1)
              .otherwise(0)).alias(k)
        for k, v in todo.items()]).first().asDict()
    ok = {k: (fails[k] or 0) == 0 for k in todo}
    out = df.select(*[c(f).cast(todo[f]).alias(f) if ok.get(f) else c(f) for f in df.columns])
    return out, ok


def _kind(dt: T.DataType) -> str:
    if is_numeric(dt):
        return "numeric"
    if isinstance(dt, T.StringType):
        return "object"
    return "other"


def feature_types(df: DataFrame) -> DataFrame:
    """(position, feature, dtype, kind, n_non_null): kind is numeric / object / other;
    the non-null counts of all columns come from one aggregate over the table."""
    spark = df.sparkSession
    counts = df.agg(*[F.count(c(f.name)).alias(f"_n{i}") for i, f in enumerate(df.schema.fields)]).first()
    rows = [(i + 1, f.name, f.dataType.simpleString(), _kind(f.dataType), int(counts[f"_n{i}"]))
            for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, feature string, dtype string, kind string, n_non_null bigint")


def dtype_counts(df: DataFrame) -> DataFrame:
    """Number of columns per type name (J2) and their non-null values."""
    return feature_types(df).groupBy("dtype").agg(F.count(F.lit(1)).alias("n_columns"),
                                                  F.sum("n_non_null").alias("n_values"))


def split_types(df: DataFrame) -> tuple[list[str], list[str]]:
    num = [f.name for f in df.schema.fields if is_numeric(f.dataType)]
    obj = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return num, obj


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
