"""Queries for association measures (section K)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.stats import r6
from ..operators import assoc as K
from . import sqlgen as S
from .catalog import query
from .fixtures import c360, li_nulls, table, with_views
from .q_profile import C360_CORR


@query("pearson_matrix", with_views(["c360"], f"""SELECT feature1, feature2, round(correlation, 6) AS correlation
FROM ({S.pearson_long('c360', C360_CORR)})"""))
def pearson_matrix(spark, d):
    m = K.pearson_matrix(c360(spark, d), C360_CORR)
    return m.select("feature1", "feature2", r6(F.col("correlation")).alias("correlation"))


COMPONENTS = 64  # of every vector


@query("pearson_matrix_wide", f"""WITH long AS (
  SELECT vec_id, unnest(range({COMPONENTS})) AS i, unnest(embedding[1:{COMPONENTS}])::DOUBLE AS x FROM embeddings)
SELECT 'x' || a.i AS feature1, 'x' || b.i AS feature2, round(
  (count(*) * sum(a.x * b.x) - sum(a.x) * sum(b.x))
  / sqrt((count(*) * sum(a.x * a.x) - sum(a.x) * sum(a.x)) * (count(*) * sum(b.x * b.x) - sum(b.x) * sum(b.x))), 6)
  AS correlation
FROM long a JOIN long b ON a.vec_id = b.vec_id AND a.i < b.i GROUP BY a.i, b.i""")
def pearson_matrix_wide(spark, d):
    """All 2,016 pairs of the vectors' components."""
    x = table(spark, d, "embeddings").select(*[F.col("embedding")[i].cast("double").alias(f"x{i}") for i in range(COMPONENTS)])
    m = K.pearson_matrix(x, x.columns)
    return m.select("feature1", "feature2", r6(F.col("correlation")).alias("correlation"))


SPEAR_COLS = ["p_partkey", "p_size", "p_retailprice"]


def _spearman_sql() -> str:
    ranks = ", ".join(f"{S.avg_rank(x, 'part')} AS {x}" for x in SPEAR_COLS)
    return (f"WITH rk AS (SELECT {ranks} FROM part)\n"
            f"SELECT feature1, feature2, round(correlation, 6) AS correlation FROM ({S.pearson_long('rk', SPEAR_COLS)})")


@query("spearman_matrix", _spearman_sql())
def spearman_matrix(spark, d):
    m = K.spearman_matrix(table(spark, d, "part"), SPEAR_COLS)
    return m.select("feature1", "feature2", r6(F.col("correlation")).alias("correlation"))


@query("high_correlations", with_views(["c360"], f"""SELECT feature1, feature2, round(correlation, 3) AS correlation,
  round(abs(correlation), 3) AS abs_correlation
FROM ({S.pearson_long('c360', C360_CORR)}) WHERE abs(correlation) >= 0.7"""))
def high_correlations(spark, d):
    return K.high_correlations(K.pearson_matrix(c360(spark, d), C360_CORR), 0.7, 3)


OC_SQL = """(SELECT o.o_orderpriority, o.o_orderstatus, c.c_mktsegment,
  CASE WHEN o.o_orderstatus = 'F' THEN 'closed' ELSE 'open' END AS closed_flag,
  CASE WHEN c.c_mktsegment = 'BUILDING' THEN 'building' ELSE 'other' END AS building_flag
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""
OC_PAIRS = [("o_orderpriority", "c_mktsegment"), ("o_orderstatus", "c_mktsegment"),
            ("o_orderpriority", "o_orderstatus"), ("closed_flag", "building_flag"),
            ("closed_flag", "o_orderpriority")]


def _orders_customer(spark, d):
    o = table(spark, d, "orders")
    cu = table(spark, d, "customer")
    j = o.join(cu, o.o_custkey == cu.c_custkey)
    return j.select("o_orderpriority", "o_orderstatus", "c_mktsegment",
                    F.when(F.col("o_orderstatus") == "F", "closed").otherwise("open").alias("closed_flag"),
                    F.when(F.col("c_mktsegment") == "BUILDING", "building").otherwise("other").alias("building_flag"))


@query("cramers_v", f"SELECT * FROM {S.cramers_v_grid(OC_SQL, OC_PAIRS)}")
def cramers_v(spark, d):
    return K.cramers_v_pairs(_orders_customer(spark, d), OC_PAIRS, 3).select("feature1", "feature2", "cramers_v")


C360_STR = ["region", "segment", "last_priority"]


@query("cramers_v_matrix", with_views(["c360"], f"SELECT * FROM {S.cramers_v_grid('c360', S.pairs(C360_STR))}"))
def cramers_v_matrix(spark, d):
    return K.cramers_v_matrix(c360(spark, d), C360_STR)


PB_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _pb_sql() -> str:
    fill = ", ".join(f"coalesce(CAST({x} AS DOUBLE), (SELECT avg({x}) FROM li_nulls)) AS {x}" for x in PB_COLS)
    ind = ("CAST(coalesce(l_returnflag = (SELECT min(l_returnflag) FROM li_nulls), false) AS DOUBLE) AS ind")
    parts = [f"SELECT '{x}' AS feature, round(coalesce(regr_sxy({x}, ind) / sqrt(regr_sxx({x}, ind) * "
             f"regr_syy({x}, ind)), 0.0), 3) AS correlation, count(*) AS n FROM f" for x in PB_COLS]
    return with_views(["li_nulls"], f"SELECT * FROM (WITH f AS (SELECT {ind}, {fill} FROM li_nulls)\n"
                                    + S.union(parts) + ")")


@query("point_biserial", _pb_sql())
def point_biserial(spark, d):
    return K.point_biserial(li_nulls(spark, d), "l_returnflag", PB_COLS)


@query("point_biserial_pvalue")
def point_biserial_pvalue(spark, d):
    """Adds the Student-t p-value (driver-side special function over one row per feature)."""
    return K.point_biserial_with_p(li_nulls(spark, d), "l_returnflag", PB_COLS)


@query("target_association", with_views(["c360"], f"""SELECT feature1 AS feature, round(v, 3) AS cramers_v,
  CASE WHEN v < 0.1 THEN 'negligible' WHEN v < 0.3 THEN 'weak' WHEN v < 0.5 THEN 'moderate' ELSE 'strong' END
    AS association_strength
FROM (SELECT feature1, cramers_v AS v FROM {S.cramers_v_grid('c360', [(x, 'churn') for x in C360_STR], None)})"""))
def target_association(spark, d):
    return K.target_association(c360(spark, d), "churn", C360_STR)
