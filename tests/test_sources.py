"""Sources, sinks and schema handling (section A)."""

import pytest
from pyspark.sql import functions as F

from tabforge.functions.params import read_params, save_params
from tabforge.ml.scoring import Preprocessor
from tabforge.operators.impute import fit_impute
from tabforge.operators.scale import fit_scaler
from tabforge.sources import files, schema


def test_missing_csv_path_raises(spark, tmp_path):
    with pytest.raises(Exception):
        files.read_csv(spark, str(tmp_path / "nope.csv"), "a int").collect()


def test_require_columns_lists_missing(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    with pytest.raises(schema.MissingColumnsError, match=r"\['c', 'd'\]"):
        schema.require_columns(df, ["a", "c", "d"])


def test_coerce_keeps_column_when_one_value_fails(spark):
    df = spark.createDataFrame([("1", "2"), ("x", "3"), (None, "4")], "a string, b string")
    out, ok = schema.coerce_types(df, {"a": "int", "b": "int", "zzz": "int"})
    assert ok == {"a": False, "b": True}
    assert dict(out.dtypes) == {"a": "string", "b": "int"}


def test_save_datasets_skips_none_and_rejects_unknown_format(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    paths = files.save_datasets({"one": df, "none": None}, str(tmp_path), "csv")
    assert list(paths) == ["one"]
    assert files.read_dataset(spark, paths["one"], "csv", df.schema).collect()[0]["a"] == 1
    with pytest.raises(ValueError):
        files.save_datasets({"one": df}, str(tmp_path), "pickle")


def test_params_and_preprocessor_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1.0, None), (3.0, 4.0), (None, 8.0)], "a double, b double")
    pre = Preprocessor({"impute": fit_impute(df, "mean", numeric_cols=["a", "b"], categorical_cols=[])})
    pre.tables["scale"] = fit_scaler(pre.apply(df), "minmax", ["a", "b"])
    p = pre.save(str(tmp_path / "pre"))
    back = Preprocessor.load(spark, p)
    assert sorted(back.apply(df).collect()) == sorted(pre.apply(df).collect())
    t = save_params(pre.tables["scale"], str(tmp_path / "scale"))
    assert sorted(read_params(spark, t).collect()) == sorted(pre.tables["scale"].collect())


def test_prediction_sink_columns(spark, tmp_path):
    df = spark.createDataFrame([(1, 0, [0.9, 0.1]), (2, 1, [0.2, 0.8])], "k int, prediction int, probability array<double>")
    out = files.save_predictions(df, str(tmp_path / "p"), ["k"], "prediction", "probability", 2)
    got = spark.read.parquet(out)
    assert set(got.columns) == {"k", "predictions", "prob_class_0", "prob_class_1", "prediction_timestamp",
                                "total_predictions"}
    assert {r["total_predictions"] for r in got.collect()} == {2}


def test_json_column_parse(spark):
    df = spark.createDataFrame([('{"k": 5}',), ("not json",)], "props string")
    out = files.parse_json_column(df, "props", "k bigint")
    assert [r["k"] for r in out.collect()] == [5, None]
