"""Incremental scoring (Q6): the reference re-runs its flow on a 2-minute schedule;
here newly arrived files are scored by a Structured Streaming query.

``readStream`` (explicit schema) -> the same preprocessing tables as training ->
``model.transform`` -> file sink with a checkpoint.  Stateless, so exactly-once
output comes from the checkpoint + file sink commit protocol; ``availableNow``
processes whatever has landed and stops (a scheduler can trigger it), while a
processing-time trigger keeps it running.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..ml.scoring import Preprocessor, apply_preprocessing


def scoring_stream(spark: SparkSession, model: PipelineModel, input_dir: str, schema: T.StructType,
                   key_cols: list[str], preprocess: Preprocessor | None = None,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    src = r.parquet(input_dir)
    scored = model.transform(apply_preprocessing(src, preprocess))
    cols = [F.col(k) for k in key_cols] + [F.col("prediction")]
    if "probability" in scored.columns:
        arr = vector_to_array(F.col("probability"))
        cols.append(arr[1].alias("score"))
    return scored.select(*cols, F.current_timestamp().alias("prediction_timestamp"))


def run_scoring_stream(spark: SparkSession, model: PipelineModel, input_dir: str, output_dir: str,
                       checkpoint_dir: str, schema: T.StructType, key_cols: list[str],
                       preprocess: Preprocessor | None = None, available_now: bool = True,
                       processing_time: str = "2 minutes"):
    """Start (and with ``available_now`` wait for) the scoring query."""
    q = scoring_stream(spark, model, input_dir, schema, key_cols, preprocess) \
        .writeStream.format("parquet").option("path", output_dir) \
        .option("checkpointLocation", checkpoint_dir).outputMode("append")
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime=processing_time)
    handle = q.start()
    if available_now:
        handle.awaitTermination()
    return handle
