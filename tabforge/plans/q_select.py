"""Queries for feature selection (section I)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.stats import r6, rsig
from ..operators import select as I
from . import sqlgen as S
from .catalog import query
from .fixtures import c360, table, with_views

MI_DISCRETE = ["region", "segment", "last_priority", "n_orders", "returned_items"]
MI_CONT = ["acctbal", "avg_discount"]
MI_ALL = MI_DISCRETE + MI_CONT


def _mi_features() -> list[tuple[str, str]]:
    feats = [(x, x) for x in MI_DISCRETE]
    for x in MI_CONT:
        cuts = [f"(SELECT quantile_cont(CAST({x} AS DOUBLE), {k / 10}) FROM c360)" for k in range(1, 10)]
        code = " + ".join(f"CASE WHEN {x} > {q} THEN 1 ELSE 0 END" for q in cuts)
        feats.append((x, f"CASE WHEN {x} IS NULL THEN NULL ELSE {code} END"))
    return feats


@query("mutual_information", with_views(["c360"], f"SELECT feature, round(mi, 6) AS mi FROM "
                                        f"{S.mi_sql('c360', _mi_features(), 'churn')}"))
def mutual_information(spark, d):
    mi = I.mutual_information(c360(spark, d), MI_ALL, "churn", continuous=MI_CONT, bins=10, estimator="bins")
    return mi.select("feature", r6(F.col("mi")).alias("mi"))


CHI_COLS = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


def _chi2_sql() -> str:
    parts = []
    for x in CHI_COLS:
        sh = f"(CAST({x} AS DOUBLE) - (SELECT min({x}) FROM lineitem) + 1.0)"
        parts.append(f"""SELECT '{x}' AS feature, round(sum(pow(obs - e, 2) / e), 6) AS chi2 FROM (
  SELECT obs, ny * 1.0 / (SELECT count(*) FROM lineitem WHERE l_returnflag IS NOT NULL)
         * (SELECT sum({sh}) FROM lineitem WHERE l_returnflag IS NOT NULL) AS e
  FROM (SELECT l_returnflag, sum({sh}) AS obs, count(*) AS ny FROM lineitem
        WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag))""")
    return S.union(parts)


@query("chi2_scores", _chi2_sql())
def chi2_scores(spark, d):
    sc = I.chi2_scores(table(spark, d, "lineitem"), CHI_COLS, "l_returnflag")
    return sc.select("feature", r6(F.col("chi2")).alias("chi2"))


VAR_COLS = ["acctbal", "tenure_months", "n_orders", "total_charges", "avg_charges", "returned_items",
            "avg_discount"]


@query("variance_select", with_views(["c360"], S.union([
    f"SELECT '{x}' AS feature, {S.rsig(f'var_pop({x})')} AS variance, var_pop({x}) > 0.01 AS selected FROM c360"
    for x in VAR_COLS])))
def variance_select(spark, d):
    df = c360(spark, d)
    v = I.variances(df, VAR_COLS)
    return v.select("feature", rsig(F.col("variance")).alias("variance"), (F.col("variance") > 0.01).alias("selected"))


@query("select_k_best", with_views(["c360"], f"""SELECT feature, position FROM (
  SELECT m.feature, p.position FROM {S.mi_sql('c360', _mi_features(), 'churn')} m
  JOIN (SELECT * FROM (VALUES {', '.join(f"('{x}', {i})" for i, x in enumerate(MI_ALL))}) t(feature, position)) p
    ON m.feature = p.feature
  ORDER BY m.mi DESC, m.feature LIMIT 3)"""))
def select_k_best(spark, d):
    df = c360(spark, d)
    chosen = I.select_k_best(I.mutual_information(df, MI_ALL, "churn", continuous=MI_CONT, estimator="bins"),
                             MI_ALL, 3, "mi")
    # chosen is the k names in input order (bounded by k).
    return spark.createDataFrame([(x, MI_ALL.index(x)) for x in chosen], "feature string, position int")


# ------------------------------------------------------------------ I1 by neighbours

NEAR = {"price_cents": "CAST(round(o_totalprice * 100) AS BIGINT)", "customer": "o_custkey",
        "order_day": "date_diff('day', TIMESTAMP '1990-01-01', CAST(o_orderdate AS TIMESTAMP))"}


def _near_sql(k: int = 3) -> str:
    def psi(n):
        y = f"({n} + 10.0)"
        steps = " - ".join(f"1.0 / ({n} + {i})" for i in range(10))
        return (f"(ln({y}) - 1 / (2 * {y}) - 1 / (12 * {y} * {y}) + 1 / (120 * {y} * {y} * {y} * {y})"
                f" - 1 / (252 * {y} * {y} * {y} * {y} * {y} * {y}) - {steps})")
    parts = []
    for name, expr in NEAR.items():
        parts.append(f"""SELECT '{name}' AS feature, (SELECT greatest(0.0, {psi("sum(n)")}
    + sum(n * ({psi(f"least({k}, ny - 1)")} - {psi("ny")} - {psi("m")})) / sum(n)) FROM (
  SELECT v.n, v.ny, (SELECT sum(o.n) FROM all_{name} o WHERE abs(o.x - v.x) < v.r OR (v.r = 0 AND o.x = v.x)) AS m
  FROM (SELECT a.y, a.x, any_value(a.n) AS n, any_value(a.ny) AS ny,
               min(CASE WHEN b.upto - 1 >= least({k}, a.ny - 1) THEN b.dist END) AS r
        FROM by_{name} a JOIN (
          SELECT p.y, p.x, abs(q.x - p.x) AS dist,
                 sum(q.n) OVER (PARTITION BY p.y, p.x ORDER BY abs(q.x - p.x)) AS upto
          FROM by_{name} p JOIN by_{name} q ON p.y = q.y AND q.i BETWEEN p.i - {k} AND p.i + {k}) b
        ON a.y = b.y AND a.x = b.x GROUP BY a.y, a.x) v)) AS mi""")
    views = ", ".join(f"""by_{name} AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY x) AS i,
    sum(n) OVER (PARTITION BY y) AS ny FROM (SELECT o_orderpriority AS y, {expr} AS x, count(*) AS n FROM orders GROUP BY ALL)),
  all_{name} AS (SELECT x, sum(n) AS n FROM by_{name} GROUP BY x)""" for name, expr in NEAR.items())
    return (f"WITH {views} "
            f"SELECT feature, round(mi, 6) AS mi FROM ({' UNION ALL '.join(parts)})")


@query("mutual_information_neighbours", _near_sql())
def mutual_information_neighbours(spark, d):
    """Price, customer number and day of all orders against their priority."""
    rows = table(spark, d, "orders").select(
        "o_orderpriority", F.round(F.col("o_totalprice") * 100).cast("double").alias("price_cents"),
        F.col("o_custkey").cast("double").alias("customer"),
        F.datediff(F.col("o_orderdate").cast("timestamp"), F.lit("1990-01-01")).cast("double").alias("order_day"))
    mi = I.mutual_information(rows, list(NEAR), "o_orderpriority", continuous=list(NEAR))
    return mi.select("feature", r6(F.col("mi")).alias("mi"))
