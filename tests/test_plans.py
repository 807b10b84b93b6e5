"""Plan checks: filters reach the Parquet scan, scans read only the needed columns,
and no data-sized input goes through an unpartitioned window."""

import contextlib
import io
import re

import __spark_entry__ as E

Q = E.queries()


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_range_filter_is_pushed_to_parquet(spark, sf_dir):
    plan = _plan(Q["range_filter"](spark, sf_dir))
    pushed = " ".join(re.findall(r"PushedFilters: \[[^\]]*\]", plan))
    assert "GreaterThanOrEqual(l_quantity,10" in pushed and "LessThanOrEqual(l_discount,0.08" in pushed


def test_flagship_prunes_columns_and_pushes_filters(spark, sf_dir):
    from tabforge.operators import clean
    from tabforge.plans.fixtures import table
    from tabforge.plans.q_profile import FLAGSHIP_FILTER
    li = table(spark, sf_dir, "lineitem")
    plan = _plan(clean.filter_rows(li.select("l_quantity", "l_discount", "l_tax"), FLAGSHIP_FILTER))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all("l_comment" not in s and "l_shipdate" not in s for s in schemas)
    assert "l_quantity" in " ".join(re.findall(r"PushedFilters: \[[^\]]*\]", plan))


def test_c360_cutoff_reaches_the_scans(spark, sf_dir):
    from tabforge.plans.fixtures import c360_plan
    plan = _plan(c360_plan(spark, sf_dir))
    pushed = " ".join(re.findall(r"PushedFilters: \[[^\]]*\]", plan))
    assert "LessThan(o_orderdate" in pushed and "LessThan(l_shipdate" in pushed


def test_profile_windows_are_partitioned(spark, sf_dir):
    from tabforge.functions.columns import unpivot_numeric
    from tabforge.functions.ranks import _prefix_quantiles
    from tabforge.plans.fixtures import table
    li = table(spark, sf_dir, "lineitem")
    q = _prefix_quantiles(unpivot_numeric(li, ["l_quantity", "l_extendedprice"]), ["feature"], [0.5], "value", None)
    plan = _plan(q)
    args = [ln for ln in plan.splitlines() if ln.startswith("Arguments:") and "windowspecdefinition" in ln]
    assert args
    for ln in args:
        # "Arguments: [exprs], [partition spec], [order spec]": the partition spec is never empty
        assert not re.search(r"\], \[\](, \[|$)", ln), ln
