"""Queries for encoders, scalers and outlier handling (sections D, E, F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.stats import r6
from ..operators import encode as D
from ..operators.outliers import apply_outliers, fit_outliers, outlier_counts
from ..operators.scale import apply_scaler, fit_scaler
from . import sqlgen as S
from .catalog import query
from .fixtures import c360, doc_label, table, with_views
from .q_features import ORDERS_NULLED, _orders_nulled

# Fixed category lists of the driver's tables (used only by the SQL oracle, which
# cannot produce data-dependent column names).
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
STATUSES = ["F", "O", "P"]
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def _ind(col: str, val: str | None, typ: str = "DOUBLE") -> str:
    name = f"{col}_{'nan' if val is None else val}"
    cond = f"{col} IS NULL" if val is None else f"coalesce({col} = '{val}', false)"
    return f'CAST({cond} AS {typ}) AS "{name}"'


@query("onehot_encode", f"""SELECT o_orderkey,
  {', '.join(_ind('o_orderpriority', v) for v in PRIORITIES + [None])},
  {', '.join(_ind('o_orderstatus', v) for v in STATUSES + [None])}
FROM {ORDERS_NULLED}""")
def onehot_encode(spark, d):
    out, _ = D.onehot_encode(_orders_nulled(spark, d), ["o_orderpriority", "o_orderstatus"], 10)
    return out


@query("dummy_encode", f"""SELECT o_orderkey,
  {', '.join(_ind('o_orderpriority', v, 'INTEGER') for v in PRIORITIES[1:])},
  {', '.join(_ind('o_orderstatus', v, 'INTEGER') for v in STATUSES[1:])}
FROM {ORDERS_NULLED}""")
def dummy_encode(spark, d):
    return D.dummy_encode(_orders_nulled(spark, d), ["o_orderpriority", "o_orderstatus"])


def _positions(table: str, cols: list[str]) -> str:
    """Places of drop-first dummies, as a subquery (feature, value, position)."""
    long = " UNION ".join(f"SELECT {i} AS i, '{x}' AS feature, CAST({x} AS VARCHAR) AS value FROM {table} WHERE {x} IS NOT NULL"
                          for i, x in enumerate(cols))
    return f"""(SELECT feature, value, row_number() OVER (ORDER BY i, value) - 1 AS position FROM (SELECT *, row_number()
  OVER (PARTITION BY i ORDER BY value) AS r FROM ({long})) WHERE r > 1)"""


_SPARSE = ["o_custkey", "o_orderpriority", "o_orderdate"]
_SPARSE_ROWS = """(SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
  CAST(o_orderdate AS DATE) AS o_orderdate FROM orders)"""


@query("dummy_encode_sparse", f"""SELECT o_orderkey, coalesce(string_agg(CAST(position AS VARCHAR), ',' ORDER BY position), '')
  AS positions FROM (SELECT o_orderkey, unnest([{', '.join(f"'{x}'" for x in _SPARSE)}]) AS feature,
  unnest([{', '.join(f'CAST({x} AS VARCHAR)' for x in _SPARSE)}]) AS value FROM {_SPARSE_ROWS})
  LEFT JOIN {_positions(_SPARSE_ROWS, _SPARSE)} USING (feature, value) GROUP BY o_orderkey""")
def dummy_encode_sparse(spark, d):
    """D6 for many categories: places of the ones in every row's dummy vector."""
    df = table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
        F.to_date("o_orderdate").alias("o_orderdate"))
    out = D.apply_dummy_positions(df, D.fit_dummy_positions(df, _SPARSE), _SPARSE)
    return out.select("o_orderkey", F.array_join("dummies", ",").alias("positions"))


@query("label_encode", """SELECT p_partkey,
  CAST(dense_rank() OVER (ORDER BY coalesce(p_brand, 'nan')) - 1 AS INTEGER) AS p_brand FROM part""")
def label_encode(spark, d):
    out, _ = D.label_encode(table(spark, d, "part").select("p_partkey", "p_brand"), ["p_brand"])
    return out


@query("auto_encode", f"""SELECT p_partkey, p_retailprice,
  CAST(dense_rank() OVER (ORDER BY coalesce(p_name, 'nan')) - 1 AS INTEGER) AS p_name,
  CAST(dense_rank() OVER (ORDER BY coalesce(p_brand, 'nan')) - 1 AS INTEGER) AS p_brand,
  {', '.join(_ind('p_type', v) for v in PART_TYPES)}
FROM part""")
def auto_encode(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    out, _ = D.encode_categorical(p, "onehot", None, 10)
    return out


TE_COLS = ["lang", "source"]


def _target_sql() -> str:
    cols = []
    for x in TE_COLS:
        cols.append(f"""round(coalesce((SELECT (s.n * s.m + 1.0 * g.g) / (s.n + 1.0)
   FROM (SELECT {x} AS v, avg(quality) AS m, count(quality) AS n FROM doc_label
         WHERE {x} IS NOT NULL GROUP BY {x}) s
   WHERE s.v = t.{x} AND s.n >= 10), g.g), 6) AS {x}_target_encoded""")
    return with_views(["doc_label"], f"""SELECT t.doc_id, {', '.join(cols)}
FROM doc_label t, (SELECT avg(quality) AS g FROM doc_label) g""")


@query("target_encode", _target_sql())
def target_encode(spark, d):
    df = doc_label(spark, d)
    out = D.target_encode(df, TE_COLS, "quality", min_samples=10, smoothing=1.0)
    return out.select("doc_id", *[r6(F.col(f"{x}_target_encoded")).alias(f"{x}_target_encoded") for x in TE_COLS])


FREQ_COLS = ["c_name", "c_mktsegment"]


@query("frequency_encode", "SELECT c_custkey, " + ", ".join(
    f"round(CASE WHEN {x} IS NULL THEN NULL ELSE count(*) OVER (PARTITION BY {x}) * 1.0 / "
    f"count({x}) OVER () END, 6) AS {x}_frequency" for x in FREQ_COLS) + " FROM customer")
def frequency_encode(spark, d):
    cu = table(spark, d, "customer").select("c_custkey", *FREQ_COLS)
    out = D.frequency_encode(cu, FREQ_COLS)
    return out.select("c_custkey", *[r6(F.col(f"{x}_frequency")).alias(f"{x}_frequency") for x in FREQ_COLS])


# ------------------------------------------------------------------ E: scaling

SCALE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _scale_sql(center: str, scale: str) -> str:
    cols = ", ".join(f"round((CAST({x} AS DOUBLE) - ({center.format(x=x)})) / ({scale.format(x=x)}), 6) AS {x}"
                     for x in SCALE_COLS)
    return f"SELECT l_orderkey, l_linenumber, {cols} FROM lineitem"


def _scaled(spark, d, method):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *SCALE_COLS)
    out = apply_scaler(li, fit_scaler(li, method, SCALE_COLS))
    return out.select("l_orderkey", "l_linenumber", *[r6(F.col(x)).alias(x) for x in SCALE_COLS])


@query("scale_standard", _scale_sql(
    "SELECT avg({x}) FROM lineitem",
    "SELECT CASE WHEN stddev_pop({x}) = 0 THEN 1.0 ELSE stddev_pop({x}) END FROM lineitem"))
def scale_standard(spark, d):
    return _scaled(spark, d, "standard")


@query("scale_minmax", _scale_sql(
    "SELECT min({x}) FROM lineitem",
    "SELECT CASE WHEN max({x}) = min({x}) THEN 1.0 ELSE max({x}) - min({x}) END FROM lineitem"))
def scale_minmax(spark, d):
    return _scaled(spark, d, "minmax")


@query("scale_robust", _scale_sql(
    "SELECT quantile_cont({x}, 0.5) FROM lineitem",
    "SELECT CASE WHEN quantile_cont({x}, 0.75) = quantile_cont({x}, 0.25) THEN 1.0 "
    "ELSE quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25) END FROM lineitem"))
def scale_robust(spark, d):
    return _scaled(spark, d, "robust")


# ------------------------------------------------------------------ F: outliers

OUT_COLS = ["acctbal", "total_charges", "avg_charges", "returned_items", "n_orders"]


def _iqr_bounds_sql(x: str) -> tuple[str, str]:
    q1 = f"(SELECT quantile_cont({x}, 0.25) FROM c360)"
    q3 = f"(SELECT quantile_cont({x}, 0.75) FROM c360)"
    return f"({q1} - 1.5 * ({q3} - {q1}))", f"({q3} + 1.5 * ({q3} - {q1}))"


def _iqr_sql() -> str:
    cols = []
    for x in OUT_COLS:
        lo, hi = _iqr_bounds_sql(x)
        cols.append(f"round(CASE WHEN {x} IS NULL THEN NULL WHEN {x} < {lo} THEN {lo} WHEN {x} > {hi} THEN {hi} "
                    f"ELSE CAST({x} AS DOUBLE) END, 6) AS {x}")
    return with_views(["c360"], f"SELECT customer_id, {', '.join(cols)} FROM c360")


@query("outlier_iqr_cap", _iqr_sql())
def outlier_iqr_cap(spark, d):
    df = c360(spark, d).select("customer_id", *OUT_COLS)
    out = apply_outliers(df, fit_outliers(df, "iqr", 1.5, OUT_COLS))
    return out.select("customer_id", *[r6(F.col(x)).alias(x) for x in OUT_COLS])


@query("outlier_zscore_median", """SELECT event_id,
  round(CASE WHEN value IS NOT NULL AND s.sd > 0 AND abs((value - s.m) / s.sd) > 3 THEN s.med ELSE value END, 6)
    AS value
FROM events, (SELECT avg(value) AS m, stddev_pop(value) AS sd, quantile_cont(value, 0.5) AS med FROM events) s""")
def outlier_zscore_median(spark, d):
    ev = table(spark, d, "events").select("event_id", "value")
    out = apply_outliers(ev, fit_outliers(ev, "zscore", 3.0, ["value"]))
    return out.select("event_id", r6(F.col("value")).alias("value"))


def _counts_sql() -> str:
    parts = []
    for x in OUT_COLS:
        lo, hi = _iqr_bounds_sql(x)
        parts.append(f"SELECT '{x}' AS feature, count(*) FILTER (WHERE {x} < {lo} OR {x} > {hi}) AS outliers "
                     f"FROM c360")
    body = S.union(parts)
    return with_views(["c360"], f"SELECT * FROM ({body}) UNION ALL "
                                f"SELECT '__total__', CAST(sum(outliers) AS BIGINT) FROM ({body})")


@query("outlier_counts", _counts_sql())
def outlier_counts_q(spark, d):
    df = c360(spark, d).select("customer_id", *OUT_COLS)
    return outlier_counts(df, fit_outliers(df, "iqr", 1.5, OUT_COLS))
