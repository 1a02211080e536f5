"""Registered queries: master panel joins and fills."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelcast.operators.joins import inner_merge_chain
from panelcast.plans import panels as P
from panelcast.plans.oracle_panels import panel_ctes
from panelcast.plans import sqlgen as S
from panelcast.plans.registry import register


@register("left_merge_chain", sql=panel_ctes(fill=False) + " SELECT * FROM merged")
def left_merge_chain_q(spark, sf_dir):
    return P.master_panel(spark, sf_dir, fill=False)


@register("inner_merge_chain", sql=panel_ctes(how="INNER", fill=False) + " SELECT * FROM merged")
def inner_merge_chain_q(spark, sf_dir):
    o, li = P.silver_sources(spark, sf_dir)
    anchor = o.select("series", "date", F.col("revenue").alias(P.TARGET))
    return inner_merge_chain(anchor, P.features_from_silver(o, li), keys=P.KEYS)


@register("ffill_bfill", sql=panel_ctes() + " SELECT * FROM master")
def ffill_bfill_q(spark, sf_dir):
    return P.master_panel(spark, sf_dir)


_NATION_SQL = (panel_ctes(fill=False) + """,
cm AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS date, round(sum(o_totalprice), 2) AS rev
       FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2),
nt AS (SELECT n.n_name AS nation, cm.date, round(sum(rev), 2) AS demand
       FROM cm JOIN customer c ON cm.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
       GROUP BY 1, 2),
nm AS (SELECT nt.nation, nt.date, nt.demand, """ + ", ".join(P.QTY_COLS + P.PRICE_COLS + P.PRIORITY_COLS) + """
       FROM nt LEFT JOIN qty USING (date) LEFT JOIN price USING (date) LEFT JOIN rev USING (date))
SELECT nation, date, demand, """ + ", ".join(
    f"{S.ffill_bfill(c, ['nation'])} AS {c}" for c in P.QTY_COLS + P.PRICE_COLS + P.PRIORITY_COLS) + " FROM nm")


@register("nation_panel", sql=_NATION_SQL)
def nation_panel_q(spark, sf_dir):
    """25-series panel by customer nation: pre-aggregated orders joined to customer, merged, filled."""
    return P.nation_panel(spark, sf_dir)


@register("gold_from_silver", sql=panel_ctes() + " SELECT * FROM master")
def gold_from_silver_q(spark, sf_dir):
    """The medallion build: validated silver tables, existence check, merge, fill, gold."""
    from panelcast.plans.layers import build_gold, build_silver
    run = uuid.uuid4().hex[:8]                   # its own databases: runs side by side don't meet
    build_silver(spark, sf_dir, as_of="2002-01-01", layer=f"silver_{run}")
    return build_gold(spark, as_of="2002-01-01", layer=f"gold_{run}", silver=f"silver_{run}")


_GOLD_NAMES = {"demand": "order_revenue", "qty_a": "returned_quantity"}


@register("gold_renamed", sql=panel_ctes() + """ SELECT series, date, demand AS order_revenue, qty_a AS returned_quantity,
""" + ", ".join(c for c in P.FEATURE_COLS if c != "qty_a") + " FROM master")
def gold_renamed_q(spark, sf_dir):
    """The medallion build with the columns' gold names, given before the validation."""
    from panelcast.plans.layers import build_gold, build_silver
    run = uuid.uuid4().hex[:8]
    build_silver(spark, sf_dir, as_of="2002-01-01", layer=f"silver_{run}")
    return build_gold(spark, as_of="2002-01-01", layer=f"gold_{run}", silver=f"silver_{run}", rename=_GOLD_NAMES)
