"""Queries for sources, sinks and schema handling (section A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.params import read_params, save_params
from ..functions.stats import r6
from ..operators import profile as P
from ..operators.impute import fit_impute
from ..operators.scale import fit_scaler
from ..session import scratch_path
from ..sources import files, schema
from .catalog import query
from .fixtures import c360, table, with_views

LI_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax"]
LI_ALL = LI_NUMERIC[:4] + ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                           "l_linestatus", "l_shipdate"]
LI_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query("csv_roundtrip", "SELECT * FROM orders")
def csv_roundtrip(spark, d):
    o = table(spark, d, "orders")
    path = files.save_raw(o, scratch_path(spark, "orders-csv"))
    return files.read_csv(spark, path, o.schema)


@query("json_records", """SELECT event_id, ts, user_id, event_type, value,
  CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def json_records(spark, d):
    ev = table(spark, d, "events")
    path = files.save_json_records(ev, scratch_path(spark, "events-json"))
    back = files.read_json_records(spark, path, ev.schema)
    return files.parse_json_column(back, "props", "k bigint").drop("props")


REQUIRED_CUSTOMER = ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"]


@query("require_columns", "SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer")
def require_columns(spark, d):
    cu = schema.require_columns(table(spark, d, "customer"), REQUIRED_CUSTOMER)
    return cu.select(*REQUIRED_CUSTOMER)


@query("coerce_types", r"""SELECT event_id, event_type, value, props,
  CAST(regexp_extract(props, ':\s*(\d+)', 1) AS BIGINT) AS k_text, CAST(user_id AS DOUBLE) AS user_id
FROM events""")
def coerce_types(spark, d):
    ev = table(spark, d, "events").select(
        "event_id", "event_type", "value", "props",
        F.regexp_extract("props", r":\s*(\d+)", 1).alias("k_text"), "user_id")
    out, _ = schema.coerce_types(ev, {"k_text": "bigint", "event_type": "double", "user_id": "double",
                                      "not_a_column": "int"})
    return out


@query("parquet_roundtrip", "SELECT * FROM part")
def parquet_roundtrip(spark, d):
    pa = table(spark, d, "part")
    paths = files.save_datasets({"part": pa, "skipped": None}, scratch_path(spark, "datasets"), "parquet")
    return files.read_dataset(spark, paths["part"], "parquet")


C360_NUM = ["acctbal", "tenure_months", "n_orders", "total_charges", "avg_charges", "returned_items",
            "avg_discount"]


def _params_sql():
    parts = []
    for x in C360_NUM:
        parts.append(f"SELECT 'standard' AS op, '{x}' AS feature, 'center' AS key, round(avg({x}), 6) AS num, "
                     f"CAST(NULL AS VARCHAR) AS text FROM c360")
        parts.append(f"SELECT 'standard', '{x}', 'scale', round(CASE WHEN stddev_pop({x}) = 0 THEN 1.0 "
                     f"ELSE stddev_pop({x}) END, 6), NULL FROM c360")
    for x in ["region", "segment", "last_priority"]:
        parts.append(f"SELECT 'impute_cat', '{x}', 'fill', NULL, (SELECT {x} FROM c360 WHERE {x} IS NOT NULL "
                     f"GROUP BY {x} ORDER BY count(*) DESC, {x} LIMIT 1)")
    return with_views(["c360"], "\nUNION ALL\n".join(parts))


@query("params_roundtrip", _params_sql())
def params_roundtrip(spark, d):
    df = c360(spark, d)
    p = fit_scaler(df, "standard", C360_NUM).unionByName(
        fit_impute(df, numeric_cols=[], categorical_cols=["region", "segment", "last_priority"]))
    path = save_params(p, scratch_path(spark, "params"))
    back = read_params(spark, path)
    return back.select("op", "feature", "key", r6(F.col("num")).alias("num"), "text")


LI_STRINGS = ["l_returnflag", "l_linestatus"]


def _eda_sql():
    from .sqlgen import pearson_long
    parts = ["SELECT 'overview' AS section, '*' AS feature, 'n_rows' AS stat, CAST(count(*) AS DOUBLE) AS value "
             "FROM lineitem",
             f"SELECT 'overview', '*', 'n_columns', CAST({len(LI_COLUMNS)} AS DOUBLE)"]
    for x in LI_COLUMNS:
        parts.append(f"SELECT 'missing', '{x}', 'missing', CAST(count(*) - count({x}) AS DOUBLE) FROM lineitem")
        parts.append(f"SELECT 'missing', '{x}', 'missing_pct', round((count(*) - count({x})) * 100.0 / count(*), 2)"
                     f" FROM lineitem")
    for x in LI_NUMERIC:
        for stat, e in [("count", f"CAST(count({x}) AS DOUBLE)"), ("mean", f"avg({x})"),
                        ("std", f"stddev_samp({x})"), ("min", f"CAST(min({x}) AS DOUBLE)"),
                        ("q25", f"quantile_cont({x}, 0.25)"), ("q50", f"quantile_cont({x}, 0.5)"),
                        ("q75", f"quantile_cont({x}, 0.75)"), ("max", f"CAST(max({x}) AS DOUBLE)"),
                        ("skewness", f"skewness({x})"), ("kurtosis", f"kurtosis({x})")]:
            section = "shape" if stat in ("skewness", "kurtosis") else "describe"
            parts.append(f"SELECT '{section}', '{x}', '{stat}', round({e}, 6) FROM lineitem")
    for x in LI_STRINGS:
        parts.append(f"SELECT 'categorical', '{x}', 'n_unique', CAST(count(DISTINCT {x}) AS DOUBLE) FROM lineitem")
    parts.append(f"SELECT 'correlation', feature1 || '|' || feature2, 'correlation', round(correlation, 6) "
                 f"FROM ({pearson_long('lineitem', LI_NUMERIC)})")
    return "\nUNION ALL\n".join(parts)


@query("eda_report_long", _eda_sql())
def eda_report_long(spark, d):
    li = table(spark, d, "lineitem")
    rep = P.eda_report_long(li)
    files.save_eda_report(rep, scratch_path(spark, "eda"))
    return rep.select("section", "feature", "stat", r6(F.col("value")).alias("value"))


TYPE_CASE = """CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
  WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END"""


def _non_null_sql() -> str:
    return " UNION ALL ".join(f"SELECT '{x}' AS feature, count({x}) AS n_non_null FROM lineitem" for x in LI_COLUMNS)


@query("feature_types", f"""SELECT CAST(ordinal_position AS INTEGER) AS position, column_name AS feature,
  {TYPE_CASE} AS dtype,
  CASE WHEN data_type IN ('BIGINT', 'INTEGER', 'DOUBLE') THEN 'numeric'
       WHEN data_type = 'VARCHAR' THEN 'object' ELSE 'other' END AS kind, nn.n_non_null
FROM information_schema.columns JOIN ({_non_null_sql()}) nn ON nn.feature = column_name
WHERE table_name = 'lineitem'""")
def feature_types(spark, d):
    return schema.feature_types(table(spark, d, "lineitem"))


@query("dtype_counts", f"""SELECT {TYPE_CASE} AS dtype, count(*) AS n_columns, CAST(sum(nn.n_non_null) AS BIGINT) AS n_values
FROM information_schema.columns JOIN ({_non_null_sql()}) nn ON nn.feature = column_name
WHERE table_name = 'lineitem' GROUP BY 1""")
def dtype_counts(spark, d):
    return schema.dtype_counts(table(spark, d, "lineitem"))
