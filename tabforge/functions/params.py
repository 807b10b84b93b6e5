"""Fitted state as a small long table: (op, feature, key, num, text).

Whatever an operator learns (means, quantiles, category lists, bin edges) is a
row set in this shape.  It can be written to Parquet, read back, inspected and
re-applied; apply functions read it once (its size is bounded by
columns x keys) and turn it into literal projections.  Large per-value maps
(label, target, frequency encodings) are separate tables joined by value.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARAMS_SCHEMA = "op string, feature string, key string, num double, text string"


def params_from_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, PARAMS_SCHEMA)


def load_params(params: DataFrame, op: str | None = None) -> dict[str, dict[str, object]]:
    """{column: {key: value}} for one op (bounded: columns x keys)."""
    if op is not None:
        params = params.where(F.col("op") == op)
    out: dict[str, dict[str, object]] = defaultdict(dict)
    for r in params.collect():
        out[r["feature"]][r["key"]] = r["num"] if r["text"] is None else r["text"]
    return dict(out)


def save_params(params: DataFrame, path: str) -> str:
    params.write.mode("overwrite").parquet(path)
    return path


def read_params(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PARAMS_SCHEMA).parquet(path)
