"""Derived input tables used by the registered queries, each defined twice: as a
Spark DataFrame builder and as an equivalent SQL view (for the DuckDB oracle).

* ``li_nulls``   lineitem projection with deterministic NULLs (10 % per column)
* ``li_sparse``  lineitem projection where two columns are 60 % / 10 % NULL
* ``c360``       customer feature table (churn-shaped), see FIXTURES.md 2.2
* ``doc_label``  documents joined with labels
* ``order_preds`` rule-based binary predictions on orders (label, score, prediction)
* ``order_preds_mc`` rule-based 3-class predictions on orders
* ``order_reg``  rule-based regression predictions on orders
* ``order_models`` three threshold rules over the same score, with a model column
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stats import md5_unit
from ..session import reliable_checkpoint


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ------------------------------------------------------------------ null-injected views

def li_nulls(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem")
    k = F.col("l_orderkey") % 10
    return li.select(
        "l_orderkey", "l_linenumber",
        F.when(k == 0, F.lit(None)).otherwise(F.col("l_quantity")).alias("l_quantity"),
        F.when(k == 1, F.lit(None)).otherwise(F.col("l_extendedprice")).alias("l_extendedprice"),
        "l_discount", "l_tax",
        F.when(k == 2, F.lit(None)).otherwise(F.col("l_returnflag")).alias("l_returnflag"),
        F.when(k == 3, F.lit(None)).otherwise(F.col("l_linestatus")).alias("l_linestatus"))


LI_NULLS_SQL = """SELECT l_orderkey, l_linenumber,
  CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE l_quantity END AS l_quantity,
  CASE WHEN l_orderkey % 10 = 1 THEN NULL ELSE l_extendedprice END AS l_extendedprice,
  l_discount, l_tax,
  CASE WHEN l_orderkey % 10 = 2 THEN NULL ELSE l_returnflag END AS l_returnflag,
  CASE WHEN l_orderkey % 10 = 3 THEN NULL ELSE l_linestatus END AS l_linestatus
FROM lineitem"""


def li_sparse(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem")
    k = F.col("l_orderkey") % 10
    return li.select("l_orderkey", "l_linenumber", "l_quantity",
                     F.when(k < 6, F.lit(None)).otherwise(F.col("l_tax")).alias("l_tax"),
                     F.when(k == 0, F.lit(None)).otherwise(F.col("l_discount")).alias("l_discount"),
                     F.when(k < 6, F.lit(None)).otherwise(F.col("l_returnflag")).alias("l_returnflag"),
                     "l_linestatus")


LI_SPARSE_SQL = """SELECT l_orderkey, l_linenumber, l_quantity,
  CASE WHEN l_orderkey % 10 < 6 THEN NULL ELSE l_tax END AS l_tax,
  CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE l_discount END AS l_discount,
  CASE WHEN l_orderkey % 10 < 6 THEN NULL ELSE l_returnflag END AS l_returnflag,
  l_linestatus
FROM lineitem"""


# ------------------------------------------------------------------ c360

def c360(spark, d) -> DataFrame:
    """The customer feature table, materialised once (see :func:`c360_plan`)."""
    return reliable_checkpoint(c360_plan(spark, d))


def c360_plan(spark, d) -> DataFrame:
    """Lazy plan of the customer feature table (filters reach the scans)."""
    orders = table(spark, d, "orders")
    li = table(spark, d, "lineitem")
    cust = table(spark, d, "customer")
    nation = table(spark, d, "nation")
    region = table(spark, d, "region")
    cutoff = orders.agg((F.max("o_orderdate") - F.expr("INTERVAL 365 DAYS")).alias("cutoff")).first()["cutoff"]
    cut = F.lit(cutoff)
    pre = orders.where(F.col("o_orderdate") < cut)
    per = pre.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order"), F.count(F.lit(1)).alias("n_orders"),
        F.sum("o_totalprice").alias("total_charges"), F.avg("o_totalprice").alias("avg_charges"),
        F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("last_priority"))
    lines = li.where(F.col("l_shipdate") < cut).join(pre.select("o_orderkey", "o_custkey"),
                                                     F.col("l_orderkey") == F.col("o_orderkey")) \
        .groupBy("o_custkey").agg(F.count_if(F.col("l_returnflag") == "R").alias("returned_items"),
                                  F.avg("l_discount").alias("avg_discount"))
    later = orders.where(F.col("o_orderdate") >= cut).select("o_custkey").distinct() \
        .withColumn("_later", F.lit(1))
    geo = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")) \
        .select("n_nationkey", F.col("r_name").alias("region"))  # 25 rows
    out = per.join(cust, F.col("o_custkey") == F.col("c_custkey")) \
        .join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"), "left") \
        .join(lines, "o_custkey", "left").join(later, "o_custkey", "left")
    # c360() materialises this once: the operators built on it make several passes
    # (fits, cardinality checks, apply); recomputing two large joins each time is waste.
    return (out.select(
        F.col("c_custkey").alias("customer_id"), "region", F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("acctbal"),
        F.floor(F.datediff(cut, F.col("first_order")) / 30).cast("bigint").alias("tenure_months"),
        "n_orders", "total_charges", "avg_charges", "last_priority",
        F.coalesce("returned_items", F.lit(0)).cast("bigint").alias("returned_items"), "avg_discount",
        F.when(F.col("_later").isNull(), 1).otherwise(0).cast("int").alias("churn")))


C360_SQL = """SELECT c.c_custkey AS customer_id, r.r_name AS region, c.c_mktsegment AS segment,
  c.c_acctbal AS acctbal,
  CAST(floor(date_diff('day', p.first_order, (SELECT cutoff FROM c360_cut)) / 30) AS BIGINT) AS tenure_months,
  p.n_orders, p.total_charges, p.avg_charges, p.last_priority,
  CAST(coalesce(l.returned_items, 0) AS BIGINT) AS returned_items, l.avg_discount,
  CAST(CASE WHEN lt.o_custkey IS NULL THEN 1 ELSE 0 END AS INTEGER) AS churn
FROM c360_per p
JOIN customer c ON p.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN c360_lines l ON l.o_custkey = p.o_custkey
LEFT JOIN (SELECT DISTINCT o_custkey FROM orders
           WHERE o_orderdate >= (SELECT cutoff FROM c360_cut)) lt ON lt.o_custkey = p.o_custkey"""

C360_CUT_SQL = "SELECT max(o_orderdate) - INTERVAL 365 DAY AS cutoff FROM orders"
C360_PRE_SQL = "SELECT * FROM orders WHERE o_orderdate < (SELECT cutoff FROM c360_cut)"
C360_PER_SQL = """SELECT o_custkey, min(o_orderdate) AS first_order, count(*) AS n_orders,
  sum(o_totalprice) AS total_charges, avg(o_totalprice) AS avg_charges,
  max(CASE WHEN rn = 1 THEN o_orderpriority END) AS last_priority
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM c360_pre) GROUP BY o_custkey"""
C360_LINES_SQL = """SELECT p.o_custkey, CAST(count(*) FILTER (WHERE l.l_returnflag = 'R') AS BIGINT) AS returned_items,
  avg(l.l_discount) AS avg_discount
FROM lineitem l JOIN c360_pre p ON l.l_orderkey = p.o_orderkey
WHERE l.l_shipdate < (SELECT cutoff FROM c360_cut)
GROUP BY p.o_custkey"""


# ------------------------------------------------------------------ doc_label

def doc_label(spark, d) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(table(spark, d, "labels"), "doc_id")


DOC_LABEL_SQL = """SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""


# ------------------------------------------------------------------ rule-based predictions

SCORE_SQL = "CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8)) AS UBIGINT) / 4294967296.0"


def order_preds(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    label = (F.col("o_orderstatus") == "F").cast("int")
    score = md5_unit(F.col("o_orderkey")) * 0.7 + label * 0.3
    return o.select(F.col("o_orderkey").alias("key"), label.alias("label"), score.alias("score")) \
        .withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


ORDER_PREDS_SQL = f"""SELECT key, label, score, CAST(score >= 0.5 AS INTEGER) AS prediction FROM (
  SELECT o_orderkey AS key, CAST(o_orderstatus = 'F' AS INTEGER) AS label,
         {SCORE_SQL} * 0.7 + CAST(o_orderstatus = 'F' AS INTEGER) * 0.3 AS score
  FROM orders)"""


def order_preds_mc(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    u = md5_unit(F.col("o_orderkey"))
    pred = F.when(u < 0.15, "P").when(u < 0.55, F.col("o_orderstatus")) \
        .when(u < 0.8, "F").otherwise("O")
    return o.select(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("label"),
                    pred.alias("prediction"))


ORDER_PREDS_MC_SQL = f"""SELECT o_orderkey AS key, o_orderstatus AS label,
  CASE WHEN {SCORE_SQL} < 0.15 THEN 'P' WHEN {SCORE_SQL} < 0.55 THEN o_orderstatus
       WHEN {SCORE_SQL} < 0.8 THEN 'F' ELSE 'O' END AS prediction
FROM orders"""


def order_reg(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    u = md5_unit(F.col("o_orderkey"))
    return o.select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("label"),
                    (F.col("o_totalprice") * (0.9 + 0.2 * u) + 1000.0 * (u - 0.5)).alias("prediction"))


ORDER_REG_SQL = f"""SELECT o_orderkey AS key, o_totalprice AS label,
  o_totalprice * (0.9 + 0.2 * {SCORE_SQL}) + 1000.0 * ({SCORE_SQL} - 0.5) AS prediction
FROM orders"""

# Fixed decision thresholds of the three rule "models".
MODEL_THRESHOLDS = {"rule_a": 0.4, "rule_b": 0.5, "rule_c": 0.6}


def order_models(spark, d) -> DataFrame:
    p = order_preds(spark, d).drop("prediction")
    parts = [p.select(F.lit(m).alias("model"), "key", "label", "score",
                      (F.col("score") >= t).cast("int").alias("prediction"))
             for m, t in MODEL_THRESHOLDS.items()]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


ORDER_MODELS_SQL = " UNION ALL ".join(
    f"SELECT '{m}' AS model, key, label, score, CAST(score >= {t} AS INTEGER) AS prediction FROM order_preds"
    for m, t in MODEL_THRESHOLDS.items())


VIEWS = {
    "li_nulls": (LI_NULLS_SQL, []),
    "li_sparse": (LI_SPARSE_SQL, []),
    "c360_cut": (C360_CUT_SQL, []),
    "c360_pre": (C360_PRE_SQL, ["c360_cut"]),
    "c360_per": (C360_PER_SQL, ["c360_pre"]),
    "c360_lines": (C360_LINES_SQL, ["c360_pre", "c360_cut"]),
    "c360": (C360_SQL, ["c360_per", "c360_lines", "c360_cut"]),
    "doc_label": (DOC_LABEL_SQL, []),
    "order_preds": (ORDER_PREDS_SQL, []),
    "order_preds_mc": (ORDER_PREDS_MC_SQL, []),
    "order_reg": (ORDER_REG_SQL, []),
    "order_models": (ORDER_MODELS_SQL, ["order_preds"]),
}


def with_views(names: list[str], body: str) -> str:
    """Prefix ``body`` with the CTEs it needs (dependencies first)."""
    seen: list[str] = []

    def visit(n):
        if n in seen:
            return
        for dep in VIEWS[n][1]:
            visit(dep)
        seen.append(n)

    for n in names:
        visit(n)
    if not seen:
        return body
    ctes = ",\n".join(f"{n} AS (\n{VIEWS[n][0]}\n)" for n in seen)
    return f"WITH {ctes}\n{body}"

