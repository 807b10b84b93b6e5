"""Queries for projection, filter, dedup, recode and missing values (sections B, C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.stats import r6
from ..operators import clean
from ..operators.impute import apply_impute, fit_impute
from .catalog import query
from .fixtures import li_nulls, li_sparse, table, with_views


@query("dedup_rows", "SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus, l_quantity FROM lineitem")
def dedup_rows(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus", "l_quantity")
    return clean.dedup_rows(li)


@query("drop_columns", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders")
def drop_columns(spark, d):
    return clean.drop_columns(table(spark, d, "orders"), ["o_orderpriority", "o_comment"])


@query("range_filter", """SELECT * FROM lineitem
WHERE l_quantity BETWEEN 10 AND 30 AND l_discount BETWEEN 0.02 AND 0.08""")
def range_filter(spark, d):
    return clean.filter_rows(table(spark, d, "lineitem"), {
        "l_quantity": {"min": 10, "max": 30}, "l_discount": {"min": 0.02, "max": 0.08},
        "no_such_column": {"min": 0, "max": 1}})


@query("membership_filter", "SELECT * FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def membership_filter(spark, d):
    return clean.filter_rows(table(spark, d, "orders"),
                             {"o_orderpriority": {"values": ["1-URGENT", "2-HIGH"]}})


@query("blank_to_number", """SELECT o_orderkey,
  TRY_CAST(NULLIF(CASE WHEN o_orderkey % 50 = 0 THEN ' ' ELSE CAST(o_totalprice AS VARCHAR) END, ' ')
           AS DOUBLE) AS charges
FROM orders""")
def blank_to_number(spark, d):
    o = table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 50 == 0, F.lit(" "))
        .otherwise(F.col("o_totalprice").cast("string")).alias("charges"))
    return clean.blank_to_number(o, "charges")


@query("recode_values", """SELECT o_orderkey, o_orderstatus,
  CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS INTEGER) AS status_binary
FROM orders""")
def recode_values(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return clean.recode_values(o, "o_orderstatus", {"F": 1, "O": 0}, out="status_binary", value_type="int")


@query("drop_null_rows", with_views(["li_nulls"], """SELECT * FROM li_nulls
WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL AND l_returnflag IS NOT NULL
  AND l_linestatus IS NOT NULL"""))
def drop_null_rows(spark, d):
    return clean.drop_null_rows(li_nulls(spark, d))


@query("drop_sparse_columns", with_views(["li_sparse"], """SELECT l_orderkey, l_linenumber, l_quantity,
  l_discount, l_linestatus FROM li_sparse"""))
def drop_sparse_columns(spark, d):
    out, _ = clean.drop_sparse_columns(li_sparse(spark, d), 0.5)
    return out


# ------------------------------------------------------------------ C: imputation

IMPUTE_NUM = ["l_quantity", "l_extendedprice", "l_discount"]
IMPUTE_CAT = ["l_returnflag", "l_linestatus"]


def _impute_sql(num_fill: dict[str, str], cat_fill: dict[str, str]) -> str:
    cols = ["l_orderkey", "l_linenumber"]
    for x in IMPUTE_NUM:
        cols.append(f"round(coalesce(CAST({x} AS DOUBLE), {num_fill[x]}), 6) AS {x}")
    cols.append("l_tax")
    for x in IMPUTE_CAT:
        cols.append(f"coalesce({x}, {cat_fill[x]}) AS {x}")
    return with_views(["li_nulls"], "SELECT " + ", ".join(cols) + " FROM li_nulls")


def _mode_sql(x: str) -> str:
    return (f"(SELECT {x} FROM li_nulls WHERE {x} IS NOT NULL GROUP BY {x} "
            f"ORDER BY count(*) DESC, {x} LIMIT 1)")


def _impute(spark, d, num_strategy, cat_strategy):
    df = li_nulls(spark, d)
    p = fit_impute(df, num_strategy, cat_strategy, numeric_cols=IMPUTE_NUM, categorical_cols=IMPUTE_CAT)
    out = apply_impute(df, p)
    return out.select("l_orderkey", "l_linenumber", *[r6(F.col(x)).alias(x) for x in IMPUTE_NUM], "l_tax",
                      *IMPUTE_CAT)


@query("impute_mean", _impute_sql({x: f"(SELECT avg({x}) FROM li_nulls)" for x in IMPUTE_NUM},
                                  {x: _mode_sql(x) for x in IMPUTE_CAT}))
def impute_mean(spark, d):
    return _impute(spark, d, "mean", "most_frequent")


@query("impute_median", _impute_sql({x: f"(SELECT quantile_cont({x}, 0.5) FROM li_nulls)" for x in IMPUTE_NUM},
                                    {x: _mode_sql(x) for x in IMPUTE_CAT}))
def impute_median(spark, d):
    return _impute(spark, d, "median", "most_frequent")


@query("impute_constant", _impute_sql({x: "0.0" for x in IMPUTE_NUM},
                                      {x: "'missing_value'" for x in IMPUTE_CAT}))
def impute_constant(spark, d):
    return _impute(spark, d, "constant", "constant")


@query("impute_mode", _impute_sql({x: _mode_sql(x) for x in IMPUTE_NUM},
                                  {x: _mode_sql(x) for x in IMPUTE_CAT}))
def impute_mode(spark, d):
    return _impute(spark, d, "most_frequent", "most_frequent")


# ------------------------------------------------------------------ C5: KNN imputation

KNN_COLS = ["p_size", "p_retailprice", "name_len"]


def part_nulls(spark, d):
    pa = table(spark, d, "part")
    k = F.col("p_partkey")
    return pa.select(
        "p_partkey",
        F.when((k % 10 == 0) | (k % 20 == 3), F.lit(None)).otherwise(F.col("p_size").cast("double")).alias("p_size"),
        F.when((k % 10 == 1) | (k % 20 == 3), F.lit(None)).otherwise(F.col("p_retailprice")).alias("p_retailprice"),
        F.when(k % 10 == 2, F.lit(None)).otherwise(F.length("p_name").cast("double")).alias("name_len"))


PART_NULLS_SQL = """SELECT p_partkey,
  CASE WHEN p_partkey % 10 = 0 OR p_partkey % 20 = 3 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS x0,
  CASE WHEN p_partkey % 10 = 1 OR p_partkey % 20 = 3 THEN NULL ELSE p_retailprice END AS x1,
  CASE WHEN p_partkey % 10 = 2 THEN NULL ELSE CAST(length(p_name) AS DOUBLE) END AS x2
FROM part"""


def _knn_sql(k: int = 5) -> str:
    p = len(KNN_COLS)
    parts = []
    for j in range(p):
        others = [i for i in range(p) if i != j]
        m = " + ".join(f"CAST(r.x{i} IS NOT NULL AND d.x{i} IS NOT NULL AS INTEGER)" for i in others)
        ssq = " + ".join(f"coalesce((r.x{i} - d.x{i}) * (r.x{i} - d.x{i}), 0.0)" for i in others)
        parts.append(f"""SELECT {j} AS j, r.p_partkey AS rk, d.p_partkey AS dk, d.x{j} AS xj,
  CASE WHEN ({m}) > 0 THEN sqrt(({p}.0 / ({m})) * ({ssq})) END AS dist
FROM t r JOIN t d ON r.x{j} IS NULL AND d.x{j} IS NOT NULL""")
    pairs = " UNION ALL ".join(parts)
    fill = ", ".join(
        f"round(coalesce(x{j}, (SELECT v FROM imp WHERE imp.rk = t.p_partkey AND imp.j = {j}), "
        f"(SELECT avg(x{j}) FROM t)), 6) AS {col}" for j, col in enumerate(KNN_COLS))
    return f"""WITH t AS ({PART_NULLS_SQL}),
pairs AS ({pairs}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY j, rk ORDER BY dist NULLS LAST, dk) AS rn
           FROM pairs WHERE dist IS NOT NULL),
imp AS (SELECT j, rk, avg(xj) AS v FROM ranked WHERE rn <= {k} GROUP BY j, rk)
SELECT p_partkey, {fill} FROM t"""


@query("impute_knn", _knn_sql())
def impute_knn(spark, d):
    from ..operators.knn import knn_impute
    out = knn_impute(part_nulls(spark, d), KNN_COLS, "p_partkey", k=5)
    return out.select("p_partkey", *[r6(F.col(x)).alias(x) for x in KNN_COLS])


# ------------------------------------------------------------------ C5 on many columns

WIDE = 20


def vector_nulls(spark, d):
    """The first 20 components of the vectors as columns, some missing by a rule on the id."""
    k = F.col("vec_id")
    return table(spark, d, "embeddings").select("vec_id", *[
        F.when((k * (i + 3)) % 17 == 5, F.lit(None)).otherwise(F.col("embedding")[i].cast("double")).alias(f"x{i}")
        for i in range(WIDE)])


VECTOR_NULLS_SQL = "SELECT vec_id, " + ", ".join(
    f"CASE WHEN (vec_id * {i + 3}) % 17 = 5 THEN NULL ELSE CAST(embedding[{i + 1}] AS DOUBLE) END AS x{i}"
    for i in range(WIDE)) + " FROM embeddings"


def _knn_wide_sql(k: int = 5) -> str:
    both = [f"(r.x{i} IS NOT NULL AND d.x{i} IS NOT NULL)" for i in range(WIDE)]
    m = " + ".join(f"CAST({b} AS INTEGER)" for b in both)
    ssq = " + ".join(f"coalesce((r.x{i} - d.x{i}) * (r.x{i} - d.x{i}), 0.0)" for i in range(WIDE))
    missing = " OR ".join(f"x{i} IS NULL" for i in range(WIDE))
    asked = " UNION ALL ".join(
        f"SELECT {j} AS j, rk, dk, x{j} AS v, dist FROM pairs WHERE r{j} AND x{j} IS NOT NULL" for j in range(WIDE))
    fill = ", ".join(f"round(coalesce(t.x{j}, max(CASE WHEN imp.j = {j} THEN imp.v END), "
                     f"(SELECT avg(x{j}) FROM t)), 6) AS x{j}" for j in range(WIDE))
    return f"""WITH t AS ({VECTOR_NULLS_SQL}),
pairs AS (SELECT r.vec_id AS rk, d.vec_id AS dk, {", ".join(f"r.x{i} IS NULL AS r{i}" for i in range(WIDE))},
                 {", ".join(f"d.x{i} AS x{i}" for i in range(WIDE))},
                 CASE WHEN ({m}) > 0 THEN sqrt(({WIDE}.0 / ({m})) * ({ssq})) END AS dist
          FROM (SELECT * FROM t WHERE {missing}) r JOIN t d ON r.vec_id <> d.vec_id),
asked AS ({asked}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY j, rk ORDER BY dist, dk) AS rn FROM asked WHERE dist IS NOT NULL),
imp AS (SELECT j, rk, avg(v) AS v FROM ranked WHERE rn <= {k} GROUP BY j, rk)
SELECT t.vec_id, {fill} FROM t LEFT JOIN imp ON imp.rk = t.vec_id
GROUP BY t.vec_id, {", ".join(f"t.x{j}" for j in range(WIDE))}"""


@query("impute_knn_wide", _knn_wide_sql())
def impute_knn_wide(spark, d):
    from ..operators.knn import knn_impute
    out = knn_impute(vector_nulls(spark, d), [f"x{i}" for i in range(WIDE)], "vec_id", k=5)
    return out.select("vec_id", *[r6(F.col(f"x{i}")).alias(f"x{i}") for i in range(WIDE)])
