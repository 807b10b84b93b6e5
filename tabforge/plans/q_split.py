"""Queries for splits, samples and folds (section L, N10 folds)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import split as L
from .catalog import query
from .fixtures import c360, table, with_views


def _hash(keys: list[str], seed: int) -> str:
    parts = " , ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"md5(concat_ws('|', {parts}, '{seed}'))"


def _split_sql(src: str, key: str, test_size: float, seed: int, strat: str | None = None,
               cols: str = "") -> str:
    part = f"PARTITION BY {strat} " if strat else ""
    return (f"SELECT {key}{cols}, row_number() OVER ({part}ORDER BY {_hash([key], seed)}, {key}) "
            f"<= ceil({test_size} * count(*) OVER ({part.strip()})) AS is_test FROM {src}")


@query("split_exact", _split_sql("orders", "o_orderkey", 0.2, 42))
def split_exact(spark, d):
    o = table(spark, d, "orders").select("o_orderkey")
    return L.split(o, ["o_orderkey"], 0.2, 42)


@query("split_hash", with_views(["c360"], _split_sql("c360", "customer_id", 0.25, 7)))
def split_hash(spark, d):
    df = c360(spark, d).select("customer_id")
    return L.split(df, ["customer_id"], 0.25, 7)


@query("split_stratified", _split_sql("orders", "o_orderkey", 0.2, 42, "o_orderstatus", ", o_orderstatus"))
def split_stratified(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return L.split(o, ["o_orderkey"], 0.2, 42, stratify_by="o_orderstatus")


@query("holdout_anti_join", f"""SELECT * FROM customer WHERE c_custkey NOT IN (
  SELECT c_custkey FROM ({_split_sql('customer', 'c_custkey', 0.8, 42)}) WHERE is_test)""")
def holdout_anti_join(spark, d):
    cu = table(spark, d, "customer")
    sample = L.split(cu.select("c_custkey"), ["c_custkey"], 0.8, 42).where(F.col("is_test"))
    return L.holdout_anti_join(cu, sample, ["c_custkey"])


@query("stratified_folds", f"""SELECT o_orderkey, o_orderstatus,
  CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_hash(['o_orderkey'], 42)}, o_orderkey) - 1) % 5
       AS INTEGER) AS fold
FROM orders""")
def stratified_folds(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return L.assign_folds(o, ["o_orderkey"], 5, 42, stratify_by="o_orderstatus")
