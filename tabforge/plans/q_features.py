"""Queries for domain and generic features (sections G and H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.stats import r6
from ..operators import features as G
from .catalog import query
from .fixtures import c360, li_nulls, table, with_views

# ------------------------------------------------------------------ G


@query("active_count", with_views(["li_nulls"], """SELECT l_orderkey, l_linenumber,
  CAST(CASE WHEN l_returnflag IN ('N', 'O') THEN 0 ELSE 1 END
     + CASE WHEN l_linestatus IN ('N', 'O') THEN 0 ELSE 1 END AS INTEGER) AS n_active,
  CAST(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END + CASE WHEN l_linestatus = 'A' THEN 1 ELSE 0 END
       AS INTEGER) AS n_equal
FROM li_nulls"""))
def active_count(spark, d):
    df = li_nulls(spark, d).select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    df = G.active_count(df, ["l_returnflag", "l_linestatus", "absent_col"], ["N", "O"], "n_active")
    df = G.count_equal(df, ["l_returnflag", "l_linestatus"], "A", "n_equal")
    return df.drop("l_returnflag", "l_linestatus")


@query("ratio_features", with_views(["c360"], """SELECT customer_id,
  round(total_charges / (tenure_months + 1), 6) AS avg_monthly,
  round(avg_charges / (n_orders + 1), 6) AS per_order FROM c360"""))
def ratio_features(spark, d):
    df = c360(spark, d)
    df = G.ratio(df, "total_charges", "tenure_months", "avg_monthly")
    df = G.ratio(df, "avg_charges", "n_orders", "per_order")
    return df.select("customer_id", r6(F.col("avg_monthly")).alias("avg_monthly"),
                     r6(F.col("per_order")).alias("per_order"))


ORDERS_NULLED = """(SELECT o_orderkey,
  CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus FROM orders)"""


def _orders_nulled(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey",
                    F.when(F.col("o_orderkey") % 10 == 0, F.lit(None)).otherwise(F.col("o_orderpriority"))
                    .alias("o_orderpriority"),
                    F.when(F.col("o_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("o_orderstatus"))
                    .alias("o_orderstatus"))


@query("contract_flags", f"""SELECT o_orderkey,
  CAST(coalesce(o_orderpriority = '1-URGENT', false) AS INTEGER) AS is_urgent,
  CAST(coalesce(o_orderpriority IN ('1-URGENT', '2-HIGH'), false) AS INTEGER) AS is_high_or_urgent
FROM {ORDERS_NULLED}""")
def contract_flags(spark, d):
    o = _orders_nulled(spark, d)
    o = G.equality_flag(o, "o_orderpriority", "1-URGENT", "is_urgent")
    o = G.membership_flag(o, "o_orderpriority", ["1-URGENT", "2-HIGH"], "is_high_or_urgent")
    return o.select("o_orderkey", "is_urgent", "is_high_or_urgent")


@query("substring_flags", """SELECT p_partkey,
  CAST(coalesce(contains(lower(p_name), 'red'), false) AS INTEGER) AS has_red,
  CAST(coalesce(contains(lower(p_type), 'economy'), false) AS INTEGER) AS is_economy
FROM part""")
def substring_flags(spark, d):
    p = table(spark, d, "part")
    p = G.substring_flag(p, "p_name", "RED", "has_red")
    p = G.substring_flag(p, "p_type", "Economy", "is_economy")
    return p.select("p_partkey", "has_red", "is_economy")


@query("tenure_buckets", with_views(["c360"], """SELECT customer_id,
  CAST(coalesce(tenure_months <= 12, false) AS INTEGER) AS tenure_group_new,
  CAST(coalesce(tenure_months > 12 AND tenure_months <= 24, false) AS INTEGER) AS tenure_group_growing,
  CAST(coalesce(tenure_months > 24 AND tenure_months <= 48, false) AS INTEGER) AS tenure_group_mature,
  CAST(coalesce(tenure_months > 48, false) AS INTEGER) AS tenure_group_loyal,
  CAST(coalesce(tenure_months <= 6, false) AS INTEGER) AS is_new_customer,
  CAST(coalesce(tenure_months >= 48, false) AS INTEGER) AS is_loyal_customer
FROM c360"""))
def tenure_buckets(spark, d):
    df = c360(spark, d).select("customer_id", "tenure_months")
    return G.tenure_buckets(df, "tenure_months").drop("tenure_months")


@query("category_flags", with_views(["li_nulls"], """SELECT l_orderkey, l_linenumber,
  CAST(l_returnflag IS DISTINCT FROM 'N' AS INTEGER) AS has_return,
  CAST(coalesce(l_returnflag = 'R', false) AS INTEGER) AS is_returned,
  CAST(coalesce(l_returnflag = 'A', false) AS INTEGER) AS is_accepted
FROM li_nulls"""))
def category_flags(spark, d):
    df = li_nulls(spark, d).select("l_orderkey", "l_linenumber", "l_returnflag")
    df = G.not_equal_flag(df, "l_returnflag", "N", "has_return")
    df = G.equality_flag(df, "l_returnflag", "R", "is_returned")
    df = G.equality_flag(df, "l_returnflag", "A", "is_accepted")
    return df.drop("l_returnflag")


@query("or_and_sum_flags", f"""SELECT o_orderkey,
  CAST(coalesce(urgent_yn = 'Yes', false) OR coalesce(open_yn = 'Yes', false) AS INTEGER) AS has_either,
  CAST(coalesce(urgent_yn = 'Yes', false) AS INTEGER) + CAST(coalesce(open_yn = 'Yes', false) AS INTEGER)
    AS n_yes
FROM (SELECT o_orderkey,
        CASE WHEN o_orderpriority IS NULL THEN NULL WHEN o_orderpriority = '1-URGENT' THEN 'Yes' ELSE 'No' END
          AS urgent_yn,
        CASE WHEN o_orderstatus IS NULL THEN NULL WHEN o_orderstatus = 'O' THEN 'Yes' ELSE 'No' END AS open_yn
      FROM {ORDERS_NULLED})""")
def or_and_sum_flags(spark, d):
    o = _orders_nulled(spark, d)
    yn = lambda col, v: F.when(F.col(col).isNull(), F.lit(None)).when(F.col(col) == v, "Yes").otherwise("No")
    o = o.select("o_orderkey", yn("o_orderpriority", "1-URGENT").alias("urgent_yn"),
                 yn("o_orderstatus", "O").alias("open_yn"))
    o = G.any_equal_flag(o, ["urgent_yn", "open_yn"], "Yes", "has_either")
    o = G.count_equal(o, ["urgent_yn", "open_yn"], "Yes", "n_yes")
    return o.select("o_orderkey", "has_either", "n_yes")


# ------------------------------------------------------------------ H

@query("poly_features", """SELECT l_orderkey, l_linenumber,
  round(l_quantity * l_quantity, 6) AS l_quantity_squared,
  round(l_quantity * l_quantity * l_quantity, 6) AS l_quantity_cubed,
  round(l_discount * l_discount, 6) AS l_discount_squared,
  round(l_discount * l_discount * l_discount, 6) AS l_discount_cubed
FROM lineitem""")
def poly_features(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount",
                                            "l_returnflag")
    out = G.poly_features(li, ["l_quantity", "l_discount", "l_returnflag"])
    new = [x for x in out.columns if x.endswith(("_squared", "_cubed"))]
    return out.select("l_orderkey", "l_linenumber", *[r6(F.col(x)).alias(x) for x in new])


@query("interaction_features", """SELECT l_orderkey, l_linenumber,
  round(l_quantity * l_extendedprice, 6) AS l_quantity_l_extendedprice_interaction,
  round(l_discount * l_tax, 6) AS l_discount_l_tax_interaction
FROM lineitem""")
def interaction_features(spark, d):
    li = table(spark, d, "lineitem")
    out = G.interaction_features(li, [("l_quantity", "l_extendedprice"), ("l_discount", "l_tax"),
                                      ("l_returnflag", "l_tax")])
    new = [x for x in out.columns if x.endswith("_interaction")]
    return out.select("l_orderkey", "l_linenumber", *[r6(F.col(x)).alias(x) for x in new])


@query("date_features", """SELECT o_orderkey,
  CAST(year(o_orderdate) AS INTEGER) AS o_orderdate_year, CAST(month(o_orderdate) AS INTEGER) AS o_orderdate_month,
  CAST(day(o_orderdate) AS INTEGER) AS o_orderdate_day,
  CAST(isodow(o_orderdate) - 1 AS INTEGER) AS o_orderdate_dayofweek,
  CAST(quarter(o_orderdate) AS INTEGER) AS o_orderdate_quarter
FROM orders""")
def date_features(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return G.date_features(o, ["o_orderdate"]).drop("o_orderdate")


def _equal_width_sql(x: str, b: int) -> str:
    step = f"((mx_{x} - mn_{x}) / {b})"
    e0 = f"(mn_{x} - (mx_{x} - mn_{x}) * 0.001)"
    inner = " + ".join(f"CAST({x} > ({i} * {step} + mn_{x}) AS INTEGER)" for i in range(1, b))
    return f"CAST(CASE WHEN {x} > {e0} AND {x} <= mx_{x} THEN {inner} END AS INTEGER) AS {x}_binned"


@query("bin_equal_width", f"""SELECT p_partkey, {_equal_width_sql('p_retailprice', 4)},
  {_equal_width_sql('p_size', 5)}
FROM part, (SELECT min(p_retailprice) AS mn_p_retailprice, max(p_retailprice) AS mx_p_retailprice,
                   CAST(min(p_size) AS DOUBLE) AS mn_p_size, CAST(max(p_size) AS DOUBLE) AS mx_p_size FROM part)""")
def bin_equal_width(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_retailprice", "p_size")
    out, _ = G.binning_features(p, {"p_retailprice": 4, "p_size": 5})
    return out.select("p_partkey", "p_retailprice_binned", "p_size_binned")


PRICE_EDGES = [900.0, 1000.0, 1500.0, 2000.0]
SIZE_EDGES = [0.0, 10.0, 20.0, 30.0, 50.0]


def _edges_sql(x: str, edges: list[float]) -> str:
    inner = " + ".join(f"CAST({x} > {e} AS INTEGER)" for e in edges[1:-1])
    return f"CAST(CASE WHEN {x} > {edges[0]} AND {x} <= {edges[-1]} THEN {inner} END AS INTEGER) AS {x}_binned"


@query("bin_edges", f"""SELECT p_partkey, {_edges_sql('p_retailprice', PRICE_EDGES)},
  {_edges_sql('p_size', SIZE_EDGES)} FROM part""")
def bin_edges(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_retailprice", "p_size")
    out, _ = G.binning_features(p, {"p_retailprice": PRICE_EDGES, "p_size": SIZE_EDGES})
    return out.select("p_partkey", "p_retailprice_binned", "p_size_binned")


@query("log_features", """SELECT o_orderkey, round(ln(1 + o_totalprice), 6) AS o_totalprice_log FROM orders""")
def log_features(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    out = G.log_features(o, ["o_totalprice", "o_orderstatus"])
    return out.select("o_orderkey", r6(F.col("o_totalprice_log")).alias("o_totalprice_log"))


@query("feature_engineering", """SELECT l_orderkey, l_linenumber,
  round(l_quantity * l_quantity, 6) AS l_quantity_squared,
  round(l_quantity * l_quantity * l_quantity, 6) AS l_quantity_cubed,
  round(l_quantity * l_discount, 6) AS l_quantity_l_discount_interaction,
  CAST(year(l_shipdate) AS INTEGER) AS l_shipdate_year, CAST(month(l_shipdate) AS INTEGER) AS l_shipdate_month,
  CAST(day(l_shipdate) AS INTEGER) AS l_shipdate_day,
  CAST(isodow(l_shipdate) - 1 AS INTEGER) AS l_shipdate_dayofweek,
  CAST(quarter(l_shipdate) AS INTEGER) AS l_shipdate_quarter,
  round(ln(1 + l_extendedprice), 6) AS l_extendedprice_log
FROM lineitem""")
def feature_engineering(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount",
                                            "l_shipdate", "l_extendedprice")
    out, _ = G.feature_engineering(li, {"polynomial_features": ["l_quantity"],
                                        "interaction_features": [["l_quantity", "l_discount"]],
                                        "date_features": ["l_shipdate"], "log_transform": ["l_extendedprice"]})
    keep = [x for x in out.columns if x not in li.columns]
    dbl = {"l_quantity_squared", "l_quantity_cubed", "l_quantity_l_discount_interaction", "l_extendedprice_log"}
    return out.select("l_orderkey", "l_linenumber",
                      *[r6(F.col(x)).alias(x) if x in dbl else F.col(x) for x in keep])
