"""Least squares for many training subsets of one table without a fit per subset.

A linear model needs of its rows only the products of (1, features, label).  Every row belongs to
disjoint parts (its fold; for learning curves one part per fold and size step), the products are
summed per part in one pass over the rows, and the products of a training subset are sums of
parts (or all rows less the left-out fold).  Each model is then a system of as many equations as
there are features, and one more pass over the rows scores all models at once.

Values are shifted by their mean and divided by their deviation first, so the sums lose no
digits to a large mean.  The driver holds parts x (features + 2)^2 numbers.  Rows with a missing feature
or label raise, as in a single fit.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_double, c
from ..session import materialise, ship_package

MODEL_SUMS = "model int, n double, sy double, sy2 double, se2 double, sae double"


def _standardised(rows: DataFrame, features: list[str], label: str, keep: list):
    """(``z``: standardised features and label, then ``keep``), the label's mean and deviation."""
    types = {f.name: f.dataType for f in rows.schema.fields}
    cols = [as_double(x, types[x]) for x in [*features, label]]
    stats = rows.agg(F.count(F.lit(1)).alias("n"), *[f(v).alias(f"{name}{i}") for i, v in enumerate(cols) for name, f in
                                                     (("c", F.count), ("m", F.avg), ("s", F.stddev_pop))]).first()
    if any(stats[f"c{i}"] != stats["n"] for i in range(len(cols))):
        raise ValueError("rows with a missing feature or label")
    scale = [(stats[f"m{i}"] or 0.0, stats[f"s{i}"] or 1.0) for i in range(len(cols))]
    z = F.array(*[(v - F.lit(m)) / F.lit(s) for v, (m, s) in zip(cols, scale)])
    return rows.select(z.alias("z"), *keep), scale[-1]


def part_products(rows: DataFrame, width: int) -> dict[int, np.ndarray]:
    """Products of (1, z) summed per part; ``rows`` has z and ``parts``, an array of part numbers."""
    w = width + 1
    at = np.triu_indices(w)

    def run(frames):
        import pandas as pd
        sums: dict[int, np.ndarray] = {}
        for df in frames:
            if not len(df):
                continue
            x = np.column_stack([np.ones(len(df)), np.array(df["z"].tolist(), dtype=float)])
            lens = df["parts"].str.len().to_numpy().astype(int)
            row, part = np.repeat(np.arange(len(df)), lens), np.concatenate([np.asarray(p, int) for p in df["parts"]])
            for p in np.unique(part):
                mine = x[row[part == p]]
                sums[p] = sums.get(p, 0) + mine.T @ mine
        for p, g in sums.items():
            yield pd.DataFrame({"part": np.int32(p), "i": at[0].astype("int32"), "j": at[1].astype("int32"), "v": g[at]})

    ship_package(rows.sparkSession)
    out: dict[int, np.ndarray] = {}
    for r in (rows.select("z", "parts").mapInPandas(run, "part int, i int, j int, v double")
              .groupBy("part", "i", "j").agg(F.sum("v").alias("v")).collect()):
        g = out.setdefault(r["part"], np.zeros((w, w)))
        g[r["i"], r["j"]] = g[r["j"], r["i"]] = r["v"]
    return out


def solve(products: np.ndarray) -> np.ndarray:
    """Intercept and coefficients of least squares from the products of (1, features, label); of
    several solutions the one of least norm."""
    n, s = products[0, 0], products[0, 1:]
    centred = products[1:, 1:] - np.outer(s, s) / max(n, 1)
    beta = np.linalg.lstsq(centred[:-1, :-1], centred[:-1, -1], rcond=1e-12)[0] if len(s) > 1 else np.zeros(0)
    return np.concatenate(([(s[-1] - s[:-1] @ beta) / max(n, 1)], beta))


def _scores(rows: DataFrame, models: list[np.ndarray], sides) -> DataFrame:
    """(model, metric, value) with model 2 * number + 1 for the training side.  ``sides(tags)`` gives for the
    rows' ``tag`` arrays a matrix (row, model) of 1 training, 0 test and -1 neither."""
    beta = np.array(models)  # (model, 1 + features)

    def run(frames):
        import pandas as pd
        total = np.zeros((2 * len(beta), 5))
        for df in frames:
            if not len(df):
                continue
            z = np.array(df["z"].tolist(), dtype=float)
            y, side = z[:, -1:], sides(np.array(df["tag"].tolist(), dtype=int))
            e = y - beta[:, 0] - z[:, :-1] @ beta[:, 1:].T
            for s in (0, 1):
                on = (side == s).astype(float)
                total[s::2] += np.column_stack([on.sum(0), (on * y).sum(0), (on * y * y).sum(0), (on * e * e).sum(0),
                                                (on * np.abs(e)).sum(0)])
        yield pd.DataFrame(np.column_stack([np.arange(len(total)), total]),
                           columns=["model", "n", "sy", "sy2", "se2", "sae"]).astype({"model": "int32"})

    ship_package(rows.sparkSession)
    sums = rows.select("z", "tag").mapInPandas(run, MODEL_SUMS).groupBy("model").agg(
        *[F.sum(v).alias(v) for v in ("n", "sy", "sy2", "se2", "sae")])
    return sums.where("n > 0")


def _metrics(sums: DataFrame, deviation: float) -> DataFrame:
    mse = F.col("se2") / F.col("n") * deviation ** 2
    spread = F.col("sy2") - F.col("sy") * F.col("sy") / F.col("n")
    values = {"mse": mse, "rmse": F.sqrt(mse), "mae": F.col("sae") / F.col("n") * deviation,
              "r2": 1 - F.try_divide(F.col("se2"), F.when(spread > 1e-13 * F.col("n"), spread))}
    return sums.select("model", F.inline(F.array(*[F.struct(F.lit(k).alias("metric"), v.alias("value"))
                                                   for k, v in values.items()])))


def fold_scores(folds: DataFrame, features: list[str], label: str, k: int, fold_col: str = "fold") -> DataFrame:
    """(fold, side, metric, value) of the k models, each fitted without one fold."""
    fold = c(fold_col).cast("int")
    rows, (_, dev) = _standardised(folds, features, label, [F.array(fold).alias("parts"), F.array(fold).alias("tag")])
    rows = materialise(rows, "linear-folds")
    parts = part_products(rows, len(features) + 1)
    zero = np.zeros((len(features) + 2, len(features) + 2))
    total = sum(parts.values(), zero)
    models = [solve(total - parts.get(i, zero)) for i in range(k)]
    sums = _scores(rows, models, lambda tag: (tag != np.arange(k)).astype(int))
    return _metrics(sums, dev).select(
        F.floor(F.col("model") / 2).cast("int").alias("fold"),
        F.when(F.col("model") % 2 == 1, "train").otherwise("test").alias("side"), "metric", "value")


def curve_scores(steps: DataFrame, features: list[str], label: str, sizes: list[float], k: int,
                 step_col: str = "steps") -> DataFrame:
    """(train_size, fold, side, metric, value).  ``steps`` has per fold the number of the smallest size whose
    training subset holds the row, -1 where the fold tests on it (len(sizes): in none)."""
    s = len(sizes)
    parts = F.filter(F.transform(c(step_col), lambda v, i: F.when((v >= 0) & (v < s), i * s + v)), lambda v: v.isNotNull())
    rows, (_, dev) = _standardised(steps, features, label, [parts.cast("array<int>").alias("parts"), c(step_col).alias("tag")])
    rows = materialise(rows, "linear-curve")
    got = part_products(rows, len(features) + 1)
    zero = np.zeros((len(features) + 2, len(features) + 2))
    models = []
    for i in range(k):
        grown = zero
        for j in range(s):
            grown = grown + got.get(i * s + j, zero)
            models.append(solve(grown))

    def sides(tag):
        at = np.repeat(tag, s, axis=1)
        return np.where(at < 0, 0, np.where(at <= np.tile(np.arange(s), k), 1, -1))

    number = F.floor(F.col("model") / 2).cast("int")
    return _metrics(_scores(rows, models, sides), dev).select(
        F.get(F.array(*[F.lit(float(x)) for x in sizes]), number % s).alias("train_size"),
        F.floor(number / s).cast("int").alias("fold"),
        F.when(F.col("model") % 2 == 1, "train").otherwise("test").alias("side"), "metric", "value")
