"""File sources and sinks (CSV, JSON records, Parquet), fitted-params and report sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import c

SUPPORTED_FORMATS = ("csv", "parquet", "json")
# Text sinks keep microseconds (Spark's default text timestamp format stops at millis).
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
TS_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True, **options) -> DataFrame:
    """CSV scan with an explicit schema (no inference in production).  A missing path
    raises at analysis time; transient read failures are retried by Spark's task retry."""
    r = spark.read.option("header", header).option("timestampFormat", TS_FORMAT).option("timestampNTZFormat", TS_NTZ_FORMAT).options(**options)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", True)
    return r.csv(path)


def read_json_records(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                      **options) -> DataFrame:
    """JSON-records source (one object per line, or a JSON array with ``multiLine``)."""
    r = spark.read.option("timestampFormat", TS_FORMAT).option("timestampNTZFormat", TS_NTZ_FORMAT).options(**options)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def save_json_records(df: DataFrame, output_path: str) -> str:
    df.write.mode("overwrite").option("timestampFormat", TS_FORMAT).option("timestampNTZFormat", TS_NTZ_FORMAT).json(output_path)
    return output_path


def parse_json_column(df: DataFrame, column: str, schema: T.StructType | str,
                      prefix: str = "") -> DataFrame:
    """Expand a JSON string column into typed columns with ``from_json``."""
    parsed = F.from_json(c(column), schema)
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    return df.select("*", *[parsed[f.name].alias(prefix + f.name) for f in st.fields])


def save_raw(df: DataFrame, output_path: str) -> str:
    """Raw CSV sink with header and no index column; parents are created by the writer."""
    df.write.mode("overwrite").option("header", True).option("timestampFormat", TS_FORMAT).option("timestampNTZFormat", TS_NTZ_FORMAT).csv(output_path)
    return output_path


def save_datasets(datasets: dict[str, DataFrame | None], output_dir: str,
                  file_format: str = "parquet") -> dict[str, str]:
    """Write each named dataset to ``output_dir/name``; ``None`` entries are skipped."""
    if file_format not in SUPPORTED_FORMATS:
        raise ValueError(f"Unsupported format: {file_format}")
    out = {}
    for name, df in datasets.items():
        if df is None:
            continue
        path = f"{output_dir.rstrip('/')}/{name}"
        w = df.write.mode("overwrite")
        if file_format in ("csv", "json"):
            w = w.option("header", True).option("timestampFormat", TS_FORMAT).option("timestampNTZFormat", TS_NTZ_FORMAT)
        w.format(file_format).save(path)
        out[name] = path
    return out


def read_dataset(spark: SparkSession, path: str, file_format: str = "parquet",
                 schema: T.StructType | None = None) -> DataFrame:
    r = spark.read.format(file_format)
    if file_format in ("csv", "json"):
        r = r.option("header", True).option("timestampFormat", TS_FORMAT).option("timestampNTZFormat", TS_NTZ_FORMAT)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def save_predictions(pred: DataFrame, output_path: str, key_cols: list[str],
                     prediction_col: str = "prediction", probability_col: str | None = "probability",
                     n_classes: int | None = None, include_metadata: bool = True,
                     max_records_per_file: int | None = None, file_format: str = "parquet") -> str:
    """Prediction sink: key, ``predictions``, ``prob_class_<i>``, and optionally
    ``prediction_timestamp`` and ``total_predictions`` (a scalar count)."""
    from pyspark.ml.functions import vector_to_array
    cols = [c(k) for k in key_cols] + [c(prediction_col).alias("predictions")]
    if probability_col and n_classes:
        dt = pred.schema[probability_col].dataType
        arr = c(probability_col) if isinstance(dt, T.ArrayType) else vector_to_array(c(probability_col))
        cols += [arr[i].alias(f"prob_class_{i}") for i in range(n_classes)]
    out = pred.select(*cols)
    if include_metadata:
        total = out.count()  # one scalar, added as a literal
        out = out.withColumn("prediction_timestamp", F.current_timestamp()) \
            .withColumn("total_predictions", F.lit(total).cast("bigint"))
    w = out.write.mode("overwrite")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if file_format == "csv":
        w = w.option("header", True)
    w.format(file_format).save(output_path)
    return output_path


def save_eda_report(long_stats: DataFrame, output_dir: str, summary: DataFrame | None = None) -> dict:
    """EDA sink: the long statistics table as JSON and Parquet, plus a summary table."""
    paths = {"full_json": f"{output_dir}/eda_report_json", "full_parquet": f"{output_dir}/eda_report"}
    long_stats.write.mode("overwrite").json(paths["full_json"])
    long_stats.write.mode("overwrite").parquet(paths["full_parquet"])
    if summary is not None:
        paths["summary"] = f"{output_dir}/eda_summary"
        summary.coalesce(1).write.mode("overwrite").json(paths["summary"])
    return paths
