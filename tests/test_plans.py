"""Plan-shape guards: pushdown, pruning, one scan per fact table, no Python in hot paths."""

import re

import __spark_entry__ as E
from panelcast.plans import panels as P


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_filters_and_columns_reach_the_scan(spark, sf_small):
    plan = executed(E.queries()["date_open_filter"](spark, sf_small))
    assert "GreaterThan(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    schema = re.search(r"ReadSchema: (struct<[^>]*>)", plan).group(1)
    assert schema == "struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>"


def test_each_fact_table_is_scanned_once_per_panel(spark, sf_small):
    o = P.orders_silver(P.load(spark, sf_small, "orders"))
    li = P.lineitem_silver(P.load(spark, sf_small, "lineitem"))
    assert len(re.findall(r"FileScan parquet", executed(o))) == 1
    assert len(re.findall(r"FileScan parquet", executed(li))) == 1
    panel = executed(P.master_panel(spark, sf_small))
    assert "FileScan parquet" not in panel          # everything downstream reads the silver checkpoints


def test_no_python_in_relational_queries(spark, sf_small):
    q = E.queries()
    for name in ("ffill_bfill", "correlation_matrix", "feature_table", "hierarchical_grid_to_long"):
        plan = executed(q[name](spark, sf_small))
        assert not re.search(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas", plan), name


def test_monthly_and_union_queries_scan_their_facts_once(spark, sf_small):
    q = E.queries()
    for name in ("monthly_sum", "monthly_mean", "zero_fill_then_mean", "two_period_mean_union"):
        assert len(re.findall(r"FileScan parquet", executed(q[name](spark, sf_small)))) == 1, name
    for name in ("union_all", "union_tagged"):
        assert "FileScan parquet" not in executed(q[name](spark, sf_small)), name      # both read the stored silver rows
