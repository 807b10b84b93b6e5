"""Random Fourier features: a map whose inner products approximate the RBF kernel.

``z(x) = sqrt(2 / D) cos(W x + b)`` with rows of W drawn from N(0, 2 gamma) and b from [0, 2 pi); then
``z(x).z(y)`` has mean ``exp(-gamma |x - y|^2)`` and, for D features, a standard error below
``1 / sqrt(D)`` (Rahimi and Recht 2007).  W and b follow from the seed, so a saved stage
is its parameters.  A linear model behind the map is a kernel machine that Spark fits like any linear
one; rows are mapped in Arrow batches, with no shuffle.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import functions as F

from ..session import ship_package


class RandomFourierFeatures(Transformer, HasInputCol, HasOutputCol, HasSeed, DefaultParamsReadable,
                            DefaultParamsWritable):
    gamma = Param(Params._dummy(), "gamma", "width of the kernel exp(-gamma d^2)", TypeConverters.toFloat)
    size = Param(Params._dummy(), "size", "number of columns of the input vector", TypeConverters.toInt)
    components = Param(Params._dummy(), "components", "number of features", TypeConverters.toInt)

    def __init__(self, inputCol: str = "features", outputCol: str = "kernel_features", size: int = 1, gamma: float = 1.0,
                 components: int = 256, seed: int = 42):
        super().__init__()
        self._setDefault(inputCol="features", outputCol="kernel_features", size=1, gamma=1.0, components=256, seed=42)
        self._set(inputCol=inputCol, outputCol=outputCol, size=size, gamma=gamma, components=components, seed=seed)

    def draw(self):
        """(W, b) of the seed."""
        rng = np.random.default_rng(self.getSeed())
        d = self.getOrDefault(self.components)
        w = rng.normal(0.0, np.sqrt(2 * self.getOrDefault(self.gamma)), (self.getOrDefault(self.size), d))
        return w, rng.uniform(0.0, 2 * np.pi, d)

    def _transform(self, dataset):
        w, b = self.draw()
        scale = np.sqrt(2.0 / len(b))
        ship_package(dataset.sparkSession)

        @F.pandas_udf("array<double>")
        def mapped(x: pd.Series) -> pd.Series:
            rows = np.array(x.tolist(), dtype=float).reshape(len(x), len(w))
            return pd.Series(list(scale * np.cos(rows @ w + b)))

        return dataset.withColumn(self.getOutputCol(), array_to_vector(mapped(vector_to_array(F.col(self.getInputCol())))))


def default_gamma(df, columns, kind: str | float) -> float:
    """``scale``: 1 / (columns x variance of all their values); ``auto``: 1 / columns; or a number."""
    if not isinstance(kind, str):
        return float(kind)
    if kind not in ("scale", "auto"):
        raise ValueError(f"Unknown gamma: {kind}")
    if kind == "auto":
        return 1.0 / len(columns)
    values = df.select(F.explode(F.array(*[c.cast("double") for c in columns])).alias("v"))
    var = values.agg(F.var_pop("v")).first()[0]
    return 1.0 / (len(columns) * var) if var else 1.0
