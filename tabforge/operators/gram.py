"""Correlation matrices of many columns from masked Gram matrices.

For values ``X`` (missing ones as zero), their squares ``Q`` and presence ``M``, the products
``X'X``, ``X'M``, ``Q'M`` and ``M'M`` hold the five sums that the pairwise-complete correlation of
every pair of columns needs.  Every task adds up the products of its Arrow batches; one grouped
sum over (i, j) joins the tasks.  The plan grows with the number of columns, not of pairs, and
a row is read once.

For rank correlations a column has several values per row, one for every class of partners (columns
that are present in the same rows), because a pair is ranked over its own complete rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_double, unpivot_numeric
from ..functions.ranks import prefix_sums
from ..session import materialise, ship_package

SUMS = ("n", "sa", "sb", "qa", "qb", "c")
#: A share of the sum of squares below which a variance is rounding noise of a constant.
NOISE = 1e-13


def correlations(rows: DataFrame, cols: list[str], classes: list[int]) -> DataFrame:
    """(feature1, feature2, correlation) of all pairs in column order.  ``rows.x`` is an array with, per
    column, one value for each class (NaN: missing); column a meets column b with its value for b's class.
    NULL for pairs with a constant column or without complete rows."""
    p, k = len(cols), max(classes, default=0) + 1
    members = [np.flatnonzero(np.array(classes) == m) for m in range(k)]

    def run(batches):
        import pandas as pd
        n, c = np.zeros((p, p)), np.zeros((p, p))
        s, q = np.zeros((p, p)), np.zeros((p, p))  # of the row's column over rows where the other is present
        for b in batches:
            if not len(b):
                continue
            x = np.array(b["x"].tolist(), dtype=float).reshape(len(b), p, k)
            has = ~np.isnan(x).all(2)
            mask, x = has.astype(float), np.where(np.isnan(x), 0.0, x)
            n += mask.T @ mask
            for m1, one in enumerate(members):
                for m2, two in enumerate(members):
                    mine, other = x[:, one, m2], x[:, two, m1]
                    at = np.ix_(one, two)
                    c[at] += mine.T @ other
                    s[at] += mine.T @ mask[:, two]
                    q[at] += (mine * mine).T @ mask[:, two]
        i, j = np.triu_indices(p, 1)
        yield pd.DataFrame({"i": i.astype("int32"), "j": j.astype("int32"), "n": n[i, j], "sa": s[i, j], "sb": s[j, i],
                            "qa": q[i, j], "qb": q[j, i], "c": c[i, j]})

    spark = ship_package(rows.sparkSession)
    sums = rows.select("x").mapInPandas(run, "i int, j int, " + ", ".join(f"{v} double" for v in SUMS))
    sums = sums.groupBy("i", "j").agg(*[F.sum(v).alias(v) for v in SUMS])

    def spread(q, s):
        v = F.col(q) - F.try_divide(F.col(s) * F.col(s), F.col("n"))
        return F.when(v > NOISE * F.col(q), v)

    r = F.try_divide(F.col("c") - F.try_divide(F.col("sa") * F.col("sb"), F.col("n")),
                     F.sqrt(spread("qa", "sa")) * F.sqrt(spread("qb", "sb")))
    sums = sums.select("i", "j", F.when(F.abs(r) > 1, F.signum(r)).otherwise(r).alias("correlation"))
    pairs = spark.range(p).select(F.col("id").cast("int").alias("i")).withColumn(
        "j", F.explode(F.sequence(F.col("i") + 1, F.lit(p)))).where(F.col("j") < p)
    names = F.array(*map(F.lit, cols))
    return pairs.join(sums, ["i", "j"], "left").select(F.get(names, F.col("i")).alias("feature1"),
                                                       F.get(names, F.col("j")).alias("feature2"), "correlation")


def _doubles(df: DataFrame, cols: list[str]):
    types = {f.name: f.dataType for f in df.schema.fields}
    return [as_double(x, types[x]) for x in cols]


def pearson_wide(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pairwise-complete Pearson matrix.  Columns are shifted by their approximate median, so sums
    lose no digits to a large mean and a constant column gives exact zeros."""
    middle = {r["feature"]: r["v"] for r in unpivot_numeric(df, cols).groupBy("feature").agg(
        F.percentile_approx("value", 0.5, 100).alias("v")).collect()}
    x = F.array(*[F.coalesce(v - F.lit(middle.get(name, 0.0)), F.lit(math.nan)) for v, name in zip(_doubles(df, cols), cols)])
    return correlations(df.select(x.alias("x")), cols, [0] * len(cols))


def spearman_wide(df: DataFrame, cols: list[str]) -> DataFrame:
    """Spearman matrix as pandas: every pair is ranked over its own complete rows.

    Columns present in the same rows form a class.  One count per (column, value) over the rows of
    each class and one running sum give the average ranks of a column under every class; the ranks
    return to the rows by one join on (column, value)."""
    p = len(cols)
    data = materialise(df.select(F.monotonically_increasing_id().alias("row"), F.array(*_doubles(df, cols)).alias("x")),
                       "spearman-rows")
    marks = []
    for i in range(p):  # two hashes of the set of rows without the column
        gone = F.col("x")[i].isNull()
        marks += [F.coalesce(F.bit_xor(F.when(gone, F.xxhash64("row"))), F.lit(0)).alias(f"a{i}"),
                  F.coalesce(F.bit_xor(F.when(gone, F.xxhash64(F.lit(1), "row"))), F.lit(0)).alias(f"b{i}"),
                  F.count_if(gone).alias(f"n{i}")]
    seen = data.agg(*marks).first()
    known: dict[tuple, int] = {}
    classes = [known.setdefault((seen[f"a{i}"], seen[f"b{i}"], seen[f"n{i}"]), len(known)) for i in range(p)]
    first = {m: classes.index(m) for m in known.values()}
    there = F.array(*[F.col("x")[first[m]].isNotNull() for m in range(len(known))])
    long = data.select("row", there.alias("there"), F.posexplode("x").alias("i", "value")).where("value is not null")
    long = long.withColumn("value", F.col("value") + F.lit(0.0))  # no negative zero
    counts = long.groupBy("i", "value").agg(*[F.count_if(F.col("there")[m]).alias(f"n{m}") for m in range(len(known))])
    sums = prefix_sums(counts, ["i"], "value", [f"n{m}" for m in range(len(known))])
    # Ranks less their mean: (cum - (n - 1) / 2) - (total + 1) / 2.
    ranks = F.array(*[F.when(F.col(f"n{m}") > 0, F.col(f"cum_n{m}") - F.col(f"n{m}") / 2 - F.col(f"tot_n{m}") / 2)
                      for m in range(len(known))])
    ranks = materialise(sums.select("i", "value", ranks.alias("r")), "spearman-ranks")
    placed = long.join(ranks, ["i", "value"]).groupBy("row").agg(F.map_from_entries(F.collect_list(
        F.struct("i", "r"))).alias("at"))
    blank = F.array_repeat(F.lit(math.nan), len(known))
    x = F.flatten(F.array(*[F.coalesce(F.transform(F.col("at")[i], lambda v: F.coalesce(v, F.lit(math.nan))), blank)
                            for i in range(p)]))
    return correlations(placed.select(x.alias("x")), cols, classes)
