"""Reproducible exact-size splits and folds (section L, N10 folds).

Rows are ordered by ``md5(key | seed)`` (then key).  The test part is the first
``ceil(test_size * n)`` rows of that order - per class when stratified.  Finding the
cut needs no global sort: rows are counted per hash-prefix bucket (prefix length grows
with n so a bucket holds ~a few hundred rows), running totals over the bucket table
locate the bucket holding the cut, and only that bucket's rows are ordered to find the
exact boundary row.  The split is a pure function of key and seed, independent of
partitioning.  ``randomSplit`` depends on partitioning and is not used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import c
from ..functions.ranks import prefix_sums
from ..session import materialise


def hash_order(key_cols: list[str], seed: int) -> Column:
    """md5 hex of ``key1|key2|...|seed`` (the same string in any SQL engine)."""
    return F.md5(F.concat_ws("|", *[c(k).cast("string") for k in key_cols], F.lit(str(seed))))


def _prefix_digits(n: int) -> int:
    return int(min(12, max(1, math.ceil(math.log(max(n, 1) / 256.0 + 1.0, 16)))))


def _cutoffs(hashed: DataFrame, group_cols: list[str], test_size: float, digits: int) -> DataFrame:
    """(group..., k, bucket*, before) - the cut bucket per group and rows before it."""
    cnt = hashed.groupBy(*[c(g) for g in group_cols], "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    ps = prefix_sums(cnt, group_cols, "_bucket", ["_n"])
    k = F.ceil(F.lit(float(test_size)) * F.col("tot__n")).cast("bigint")
    return ps.where((F.col("cum__n") - F.col("_n") < k) & (k <= F.col("cum__n"))) \
        .select(*[c(g) for g in group_cols], k.alias("_k"), F.col("_bucket").alias("_cut"),
                (F.col("cum__n") - F.col("_n")).alias("_before"))


def split(df: DataFrame, key_cols: list[str], test_size: float = 0.2, seed: int = 42,
          stratify_by: str | None = None, flag: str = "is_test") -> DataFrame:
    """Add a boolean ``is_test``: exactly ``ceil(test_size * n)`` rows (per class when
    stratified).  Rows of one key are ordered by a hash of the whole row; rows that are
    equal as a whole are interchangeable."""
    if not 0.0 <= test_size <= 1.0:
        raise ValueError("test_size must be within [0, 1]")
    if stratify_by is not None and stratify_by not in df.columns:
        raise ValueError(f"Target column {stratify_by} not found")
    n = df.count()
    digits = _prefix_digits(n)
    # _grp is the class (NULL is a class of its own) or one constant group.
    grp = c(stratify_by) if stratify_by else F.lit(0)
    hashed = df.select("*", hash_order(key_cols, seed).alias("_h"), grp.alias("_grp")).withColumn(
        "_bucket", F.conv(F.substring("_h", 1, digits), 16, 10).cast("bigint"))
    # One row per group: the cut bucket, the rows before it and k.  Written, so that
    # the planner knows its size and chooses the join by it.
    cuts = materialise(_cutoffs(hashed, ["_grp"], test_size, digits).withColumnRenamed("_grp", "_cgrp"), "cuts")
    j = hashed.join(cuts, hashed["_grp"].eqNullSafe(cuts["_cgrp"]), "left")
    at_cut = F.coalesce(F.col("_bucket") == F.col("_cut"), F.lit(False))
    # Only the rows of each group's cut bucket (a few hundred) are ordered.
    w = Window.partitionBy("_grp").orderBy("_h", *[c(k) for k in key_cols], F.xxhash64(*[c(x) for x in df.columns]))
    inside = j.where(at_cut).withColumn(flag, F.row_number().over(w) <= F.col("_k") - F.col("_before"))
    outside = j.where(~at_cut).withColumn(flag, F.coalesce(F.col("_bucket") < F.col("_cut"), F.lit(False)))
    return outside.unionByName(inside).drop("_h", "_grp", "_cgrp", "_bucket", "_k", "_cut", "_before")


def train_test(df: DataFrame, key_cols: list[str], test_size: float = 0.2, seed: int = 42,
               stratify_by: str | None = None) -> tuple[DataFrame, DataFrame]:
    s = split(df, key_cols, test_size, seed, stratify_by)
    return s.where(~F.col("is_test")).drop("is_test"), s.where(F.col("is_test")).drop("is_test")


def holdout_anti_join(df: DataFrame, sample: DataFrame, key_cols: list[str]) -> DataFrame:
    """Complement of a sample by key (``left_anti``)."""
    return df.join(sample.select(*[c(k) for k in key_cols]), key_cols, "left_anti")


def hash_positions(df: DataFrame, key_cols: list[str], seed: int = 42, group: str | None = None,
                   pos_col: str = "_pos") -> DataFrame:
    """0-based position of every row in ``md5(key|seed)`` order (then key) within its
    group, exact, without ordering a group as a whole: rows are ranked inside their
    hash-prefix bucket (a few hundred rows each, so a hot group is spread over many
    buckets) and the bucket's offset comes from running totals over the small
    per-bucket count table."""
    n = df.count()
    digits = _prefix_digits(n)
    grp = c(group) if group else F.lit(0)
    hashed = df.select("*", hash_order(key_cols, seed).alias("_h"), grp.alias("_grp")).withColumn(
        "_bucket", F.conv(F.substring("_h", 1, digits), 16, 10).cast("bigint"))
    cnt = hashed.groupBy("_grp", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    offs = prefix_sums(cnt, ["_grp"], "_bucket", ["_n"]).select(
        F.col("_grp").alias("_ogrp"), F.col("_bucket").alias("_obucket"),
        (F.col("cum__n") - F.col("_n")).alias("_off"))
    j = hashed.join(offs, hashed["_grp"].eqNullSafe(offs["_ogrp"]) & (hashed["_bucket"] == offs["_obucket"]))
    w = Window.partitionBy("_grp", "_bucket").orderBy("_h", *[c(x) for x in key_cols])
    return j.withColumn(pos_col, F.row_number().over(w) - 1 + F.col("_off")) \
        .drop("_h", "_grp", "_bucket", "_ogrp", "_obucket", "_off")


def assign_folds(df: DataFrame, key_cols: list[str], k: int = 5, seed: int = 42,
                 stratify_by: str | None = None, fold_col: str = "fold") -> DataFrame:
    """fold = (position in hash order within class) mod k (see :func:`hash_positions`)."""
    pos = hash_positions(df, key_cols, seed, stratify_by, "_pos")
    return pos.withColumn(fold_col, (F.col("_pos") % k).cast("int")).drop("_pos")
