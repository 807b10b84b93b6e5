"""Mutual information of continuous columns and a class by nearest neighbours (I1).

Estimator (Ross 2014, the one behind scikit-learn's ``mutual_info_classif``, without its random
jitter): for every row, ``r`` is the distance to its k-th nearest neighbour of the same class
(``k`` at most the class's rows less one) and ``m`` the number of rows of any class strictly nearer than
``r``, itself included (equal ones if ``r`` is zero); then
``psi(N) + mean(psi(k)) - mean(psi(N_class)) - mean(psi(m))``, not below zero.  Classes of
one row take no part.

Everything is exact and distributed; no class, column or value goes to one task:

1. rows are counted per (feature, class, value), so a hot value is one row with a count;
2. these are range-partitioned by value; a partition sees the k values before and behind it through a
   table of the partitions' edges (halo rows).  The k-th neighbour of a value lies among its k distinct
   neighbours on either side, so the radius is an expression over ``lag`` and ``lead``;
3. ``m`` is a difference of two running counts of the feature's values.  The interval's ends enter the
   table of values as rows without a count, and one distributed running sum answers all of them.

``x - r`` and ``x + r`` are compared exactly: the rounding error of the sum (two-sum) decides whether a
value equal to the rounded end lies inside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import c, unpivot_numeric
from ..functions.ranks import default_partitions, prefix_sums
from ..session import materialise, reliable_checkpoint


def digamma(n: Column) -> Column:
    """psi of a positive number: shifted by ten, then the asymptotic series."""
    x = n.cast("double")
    y = x + 10
    series = F.log(y) - 1 / (2 * y) - 1 / (12 * y * y) + 1 / (120 * y * y * y * y) - 1 / (252 * y * y * y * y * y * y)
    return series - sum((1 / (x + i) for i in range(1, 10)), 1 / x)


def two_sum(a: Column, b: Column) -> tuple[Column, Column]:
    """(rounded sum, its error): a + b is exactly the sum of both."""
    s = a + b
    bb = s - a
    return s, (a - (s - bb)) + (b - bb)


def _with_halo(cells: DataFrame, k: int) -> DataFrame:
    """``cells`` (feature, y, value, n) with ``part`` and, marked ``own = false``, the k values
    before and behind every (feature, y, part)."""
    group = ["feature", "y"]
    ranged = cells.repartitionByRange(default_partitions(cells.sparkSession), *group, "value")
    ranged = reliable_checkpoint(ranged.withColumn("part", F.spark_partition_id()))
    by = Window.partitionBy(*group, "part")
    ends = ranged.withColumn("up", F.row_number().over(by.orderBy("value"))).withColumn(
        "down", F.row_number().over(by.orderBy(F.desc("value")))).where((F.col("up") <= k) | (F.col("down") <= k))
    item = F.struct("value", "n")
    edges = ends.groupBy(*group, "part").agg(
        F.array_sort(F.collect_list(F.when(F.col("up") <= k, item))).alias("low"),
        F.array_sort(F.collect_list(F.when(F.col("down") <= k, item))).alias("high"))
    along = Window.partitionBy(*group).orderBy("part")
    # Every part has a value, so the k values before lie in the k parts before.
    before = F.flatten(F.collect_list("high").over(along.rowsBetween(-k, -1)))
    behind = F.flatten(F.collect_list("low").over(along.rowsBetween(1, k)))
    halo = edges.select(*group, "part", F.slice(before, F.greatest(F.size(before) - k + 1, F.lit(1)), k).alias("a"),
                        F.slice(behind, 1, k).alias("b"))
    halo = halo.select(*group, F.inline(F.transform(F.concat("a", "b"), lambda e: F.struct(
        e["value"].alias("value"), e["n"].alias("n")))), "part", F.lit(False).alias("own"))
    return ranged.withColumn("own", F.lit(True)).unionByName(materialise(halo, "halo"))


def _radius(cells: DataFrame, k: int) -> tuple[DataFrame, Column]:
    """(cells with their neighbours, the distance to the kk-th neighbour within the class as an
    expression over them and ``kk``)."""
    w = Window.partitionBy("feature", "y", "part").orderBy("value")
    seen = _with_halo(cells, k)
    for a in range(1, k + 1):
        for side, fn in (("l", F.lag), ("r", F.lead)):
            seen = seen.withColumn(f"{side}{a}", fn("value", a).over(w)).withColumn(f"{side}n{a}", fn("n", a).over(w))
    options = []
    for a in range(k + 1):
        for b in range(k + 1 - a):
            have = sum([F.coalesce(F.col(f"ln{i}"), F.lit(0)) for i in range(1, a + 1)]
                       + [F.coalesce(F.col(f"rn{i}"), F.lit(0)) for i in range(1, b + 1)], F.col("n") - 1)
            far = [F.lit(0.0)] + ([F.col("value") - F.col(f"l{a}")] if a else []) + ([F.col(f"r{b}") - F.col("value")] if b else [])
            reach = F.greatest(*far) if len(far) > 1 else far[0]
            there = F.lit(True)
            if a:
                there = there & F.col(f"l{a}").isNotNull()
            if b:
                there = there & F.col(f"r{b}").isNotNull()
            options.append(F.when(there & (have >= F.col("kk")), reach))
    return seen.where("own"), F.least(*options)


def neighbour_information(df: DataFrame, features: list[str], target: str, k: int = 3) -> DataFrame:
    """(feature, mi) for every continuous feature against a class target; rows with a NULL or NaN
    value, or a NULL target, are left out of that feature's estimate."""
    if k < 1:
        raise ValueError("k must be positive")
    rows = df.where(c(target).isNotNull()).withColumn("_y", c(target).cast("string"))
    long = unpivot_numeric(rows, features, keep=["_y"])
    value = F.col("value") + F.lit(0.0)  # no negative zero
    cells = materialise(long.groupBy("feature", F.col("_y").alias("y"), value.alias("value"))
                        .agg(F.count(F.lit(1)).alias("n")), "mi-cells")
    sizes = cells.groupBy("feature", "y").agg(F.sum("n").alias("ny")).where("ny > 1")
    sizes = materialise(sizes, "mi-classes")  # one row per feature and class
    cells = cells.join(sizes.select("feature", "y"), ["feature", "y"], "left_semi")
    seen, radius = _radius(cells, k)
    own = seen.join(sizes, ["feature", "y"]).withColumn("kk", F.least(F.lit(k), F.col("ny") - 1))
    own = own.withColumn("r", radius).select("feature", "y", "value", "n", "ny", "kk", "r")
    hi, hi_err = two_sum(F.col("value"), F.col("r"))
    lo, lo_err = two_sum(F.col("value"), -F.col("r"))
    zero = F.col("r") == 0
    # Rows up to the upper end less those before the lower end; an end counts if it is inside.
    own = materialise(own.select(
        "feature", "n", "ny", "kk", hi.alias("hi"), (zero | (hi_err > 0)).alias("hi_in"), (lo + F.lit(0.0)).alias("lo"),
        (zero | (lo_err < 0)).alias("lo_in")), "mi-ends")
    values = cells.select("feature", "value", "n")
    asked = own.select("feature", F.explode(F.array("hi", "lo")).alias("value"), F.lit(0).cast("long").alias("n"))
    marks = values.unionByName(asked).groupBy("feature", "value").agg(F.sum("n").alias("n"))
    ranks = materialise(prefix_sums(marks, ["feature"], "value", ["n"]).select("feature", "value", "n", "cum_n"), "mi-ranks")

    def at(end: str, name: str):
        return ranks.select("feature", F.col("value").alias(end), F.col("cum_n").alias(f"{name}_c"), F.col("n").alias(f"{name}_n"))

    found = own.join(at("hi", "u"), ["feature", "hi"]).join(at("lo", "d"), ["feature", "lo"])
    upper = F.when(F.col("hi_in"), F.col("u_c")).otherwise(F.col("u_c") - F.col("u_n"))
    lower = F.when(F.col("lo_in"), F.col("d_c") - F.col("d_n")).otherwise(F.col("d_c"))
    m = F.greatest(upper - lower, F.col("n"))
    mean = F.sum(F.col("n") * (digamma(F.col("kk")) - digamma(F.col("ny")) - digamma(m))) / F.sum("n")
    out = found.groupBy("feature").agg(F.greatest(digamma(F.sum("n")) + mean, F.lit(0.0)).alias("mi"))
    names = df.sparkSession.createDataFrame([(x,) for x in features], "feature string")  # a row per column asked for
    return names.join(out, "feature", "left").select("feature", F.coalesce("mi", F.lit(0.0)).alias("mi"))
