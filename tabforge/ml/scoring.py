"""Scoring (section O): re-applied preprocessing, prediction, batch and one-off inference.

A :class:`Preprocessor` holds everything a training run fitted and the order in which it
is applied: domain features, imputation, target / frequency / label maps, generic
features with their bin edges, outlier caps, one-hot categories, scaling and the chosen
columns.  Training and scoring go through the same ``apply``.  It is saved as Parquet
tables + one JSON file under a folder (the reference's writer and reader disagree on
file names, so its encoders are never found at inference).
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.params import PARAMS_SCHEMA
from ..operators import features as G
from ..operators.encode import apply_frequency, apply_label, apply_onehot, apply_target_encoding
from ..operators.features import feature_engineering
from ..operators.impute import apply_impute
from ..operators.outliers import apply_outliers
from ..operators.scale import apply_scaler
from ..sources.files import save_predictions
from .models import load_model, predict

STEPS = ("domain", "impute", "target", "frequency", "label", "features", "outliers", "onehot", "scale")


@dataclass
class Preprocessor:
    """``tables`` holds fitted tables by step.  ``ratios`` ([numerator, denominator, name])
    and ``buckets`` (columns cut into tenure groups) are the domain features;
    ``target_mean`` fills categories that the target map does not hold; ``order`` is the
    order of the steps (those without anything fitted are skipped)."""
    tables: dict[str, DataFrame] = field(default_factory=dict)
    feature_config: dict = field(default_factory=dict)
    bin_edges: dict = field(default_factory=dict)
    ratios: list = field(default_factory=list)
    buckets: list = field(default_factory=list)
    target_mean: float | None = None
    order: list = field(default_factory=lambda: list(STEPS))
    columns: list | None = None

    def _mapped(self, step: str) -> list[str]:
        # one row per encoded column
        return sorted(r["feature"] for r in self.tables[step].select("feature").distinct().collect())

    def _step(self, step: str, df: DataFrame) -> DataFrame:
        if step == "domain":
            for num, den, name in self.ratios:
                df = G.ratio(df, num, den, name)
            for col in self.buckets:
                df = G.tenure_buckets(df, col)
            return df
        if step == "features":
            return feature_engineering(df, self.feature_config, self.bin_edges)[0] if self.feature_config else df
        if step not in self.tables:
            return df
        t = self.tables[step]
        if step == "impute":
            return apply_impute(df, t)
        if step == "target":
            return apply_target_encoding(df, self._mapped(step), self.target_mean, t)
        if step == "frequency":
            return apply_frequency(df, self._mapped(step), t)
        if step == "label":
            for col in self._mapped(step):
                df = apply_label(df, col, t.where(F.col("feature") == col))
            return df
        if step == "outliers":
            return apply_outliers(df, t)
        if step == "onehot":
            return apply_onehot(df, t)
        return apply_scaler(df, t)

    def apply(self, df: DataFrame, steps: list[str] | None = None) -> DataFrame:
        """Apply all steps, or those named (in this preprocessor's order)."""
        for step in self.order:
            if steps is None or step in steps:
                df = self._step(step, df)
        return df

    def save(self, path: str) -> str:
        """Persist every fitted table by name (A7) and the configuration."""
        spark = SparkSession.getActiveSession()
        for name, t in self.tables.items():
            t.write.mode("overwrite").parquet(f"{path}/{name}")
        meta = {"steps": sorted(self.tables), "feature_config": self.feature_config, "bin_edges": self.bin_edges,
                "ratios": self.ratios, "buckets": self.buckets, "target_mean": self.target_mean,
                "order": self.order, "columns": self.columns}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").text(f"{path}/_meta")
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> Preprocessor:
        meta = json.loads(spark.read.text(f"{path}/_meta").where("value <> ''").first()[0])
        tables = {name: spark.read.parquet(f"{path}/{name}") for name in meta["steps"]}
        return Preprocessor(tables, meta.get("feature_config") or {}, meta.get("bin_edges") or {},
                            meta.get("ratios") or [], meta.get("buckets") or [], meta.get("target_mean"),
                            meta.get("order") or list(STEPS), meta.get("columns"))


def apply_preprocessing(df: DataFrame, pre: Preprocessor | dict | None) -> DataFrame:
    """O4: a Preprocessor, or a dict {step: params DataFrame}, or None (no-op)."""
    if pre is None:
        return df
    if isinstance(pre, dict):
        pre = Preprocessor(pre)
    return pre.apply(df)


def batch_predict(spark: SparkSession, model_path: str, data_path: str, output_path: str,
                  key_cols: list[str], batch_size: int | None = None, data_format: str = "parquet",
                  preprocess: Preprocessor | None = None, n_classes: int | None = 2) -> str:
    """O2: file -> file scoring; partitions are scored in parallel.  ``batch_size``, if
    given, bounds the rows per output file."""
    model = load_model(model_path)
    df = spark.read.format(data_format).load(data_path)
    pred = predict(model, apply_preprocessing(df, preprocess), key_cols)
    return save_predictions(pred, output_path, key_cols, "prediction",
                            "probability" if "probability" in pred.columns else None, n_classes,
                            include_metadata=True, max_records_per_file=batch_size)


def infer(model_path: str, data: DataFrame | dict | list[dict], key_cols: list[str],
          preprocess: Preprocessor | None = None) -> DataFrame:
    """O3: one-off inference on a DataFrame or on records (a dict becomes one row)."""
    spark = SparkSession.getActiveSession()
    if isinstance(data, dict):
        data = [data]
    if isinstance(data, list):
        data = spark.createDataFrame(data)
    model = load_model(model_path)
    return predict(model, apply_preprocessing(data, preprocess), key_cols) \
        .withColumn("prediction_timestamp", F.current_timestamp())


__all__ = ["Preprocessor", "apply_preprocessing", "batch_predict", "infer", "PARAMS_SCHEMA", "STEPS"]
