"""Registered queries: monthly aggregation, pivot/unpivot, unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.operators import monthly as MO
from panelcast.operators.joins import union_all, union_tagged
from panelcast.plans import panels as P
from panelcast.plans import sqlgen as S
from panelcast.plans.oracle_panels import M_ORDER, M_SHIP, panel_ctes
from panelcast.plans.registry import register
from panelcast.session import cut_lineage

SPLIT_DATE = "1998-01-01"
PIVOT_START = "1996-01-01"


def _round(df, cols, d):
    return df.withColumns({c: F.round(c, d) for c in cols})


# -- monthly_sum: revenue per priority, every month between first and last, gap -> 0
@register("monthly_sum", sql=f"""
WITH agg AS (SELECT o_orderpriority, {M_ORDER} AS date, sum(o_totalprice) AS revenue
             FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2),
cal AS ({S.calendar('agg', ['o_orderpriority'])})
SELECT c.o_orderpriority, c.date, round(coalesce(a.revenue, 0), 2) AS revenue
FROM cal c LEFT JOIN agg a ON c.o_orderpriority = a.o_orderpriority AND c.date = a.date""")
def monthly_sum_q(spark, sf_dir):
    o = P.load(spark, sf_dir, "orders")
    out = MO.monthly_sum(o, "o_orderdate", "o_totalprice", keys=["o_orderpriority"],
                         out_names=["revenue"])
    return _round(out, ["revenue"], 2)


_MEAN_SQL = f"""
WITH agg AS (SELECT o_orderpriority, {M_ORDER} AS date, round(sum(o_totalprice), 2) / count(o_totalprice) AS mean_price
             FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2),
cal AS ({S.calendar('agg', ['o_orderpriority'])})
SELECT c.o_orderpriority, c.date, a.mean_price
FROM cal c LEFT JOIN agg a ON c.o_orderpriority = a.o_orderpriority AND c.date = a.date"""


@register("monthly_mean", sql=_MEAN_SQL)
def monthly_mean_q(spark, sf_dir):
    o = P.load(spark, sf_dir, "orders")
    out = MO.monthly_mean(o, "o_orderdate", "o_totalprice", keys=["o_orderpriority"],
                          out_names=["mean_price"], scale=2)
    return out


# Zero-discount lines are read as "not reported" (NULL); the zero-fill mean
# counts them as 0 again, the plain mean skips them.
@register("zero_fill_then_mean", sql=f"""
WITH agg AS (SELECT l_returnflag, {M_SHIP} AS date,
                    round(sum(coalesce(nullif(l_discount, 0.0), 0.0)), 2)
                      / count(coalesce(nullif(l_discount, 0.0), 0.0)) AS mean_zero_filled,
                    round(sum(nullif(l_discount, 0.0)), 2) / count(nullif(l_discount, 0.0)) AS mean_skip_null
             FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1, 2),
cal AS ({S.calendar('agg', ['l_returnflag'])})
SELECT c.l_returnflag, c.date, a.mean_zero_filled, a.mean_skip_null
FROM cal c LEFT JOIN agg a ON c.l_returnflag = a.l_returnflag AND c.date = a.date""")
def zero_fill_then_mean_q(spark, sf_dir):
    li = P.load(spark, sf_dir, "lineitem").withColumn(
        "disc", F.nullif(F.col("l_discount"), F.lit(0.0)))
    return MO.monthly_mean(li, "l_shipdate", ["disc", "disc"], keys=["l_returnflag"],
                           out_names=["mean_zero_filled", "mean_skip_null"],
                           zero_fill=[True, False], scale=2)


@register("two_period_mean_union", sql=f"""
WITH a1 AS (SELECT {M_ORDER} AS date, round(sum(o_totalprice), 2) / count(o_totalprice) AS mean_price FROM orders
            WHERE o_orderdate IS NOT NULL AND o_orderdate < DATE '{SPLIT_DATE}' GROUP BY 1),
a2 AS (SELECT {M_ORDER} AS date, round(sum(o_totalprice), 2) / count(o_totalprice) AS mean_price FROM orders
       WHERE o_orderdate IS NOT NULL AND o_orderdate >= DATE '{SPLIT_DATE}' GROUP BY 1),
c1 AS ({S.calendar('a1')}), c2 AS ({S.calendar('a2')})
SELECT c1.date, a1.mean_price FROM c1 LEFT JOIN a1 ON c1.date = a1.date
UNION ALL
SELECT c2.date, a2.mean_price FROM c2 LEFT JOIN a2 ON c2.date = a2.date""")
def two_period_mean_union_q(spark, sf_dir):
    o = P.load(spark, sf_dir, "orders")
    out = MO.two_period_mean_union(o, "o_orderdate", "o_totalprice", SPLIT_DATE,
                                   out_names=["mean_price"], scale=2)
    return out


_STATUS_COLS = [f"rev_{s.lower()}" for s in P.ORDER_STATUSES]


@register("monthly_pivot", sql=f"""
SELECT o_orderpriority, {M_ORDER} AS date,
       {S.pivot_sums('o_orderstatus', 'o_totalprice', P.ORDER_STATUSES, _STATUS_COLS, 2)}
FROM orders WHERE o_orderdate IS NOT NULL AND o_orderstatus IS NOT NULL GROUP BY 1, 2""")
def monthly_pivot_q(spark, sf_dir):
    o = P.load(spark, sf_dir, "orders")
    out = MO.monthly_pivot(o, "o_orderdate", "o_orderstatus", "o_totalprice", P.ORDER_STATUSES,
                           keys=["o_orderpriority"], names=_STATUS_COLS)
    return _round(out, _STATUS_COLS, 2)


_LS = ["F", "O"]
_LS_COLS = ["qty_f", "qty_o"]


@register("monthly_pivot_filled", sql=f"""
SELECT * FROM (
  SELECT l_returnflag, {M_SHIP} AS date,
         coalesce(round(sum(CASE WHEN l_linestatus = 'F' THEN coalesce(l_quantity, 0) END), 2), 0) AS qty_f,
         coalesce(round(sum(CASE WHEN l_linestatus = 'O' THEN coalesce(l_quantity, 0) END), 2), 0) AS qty_o
  FROM lineitem WHERE l_shipdate IS NOT NULL AND l_linestatus IS NOT NULL GROUP BY 1, 2)
WHERE date > DATE '{PIVOT_START}'""")
def monthly_pivot_filled_q(spark, sf_dir):
    li = P.load(spark, sf_dir, "lineitem")
    return MO.monthly_pivot_filled(li, "l_shipdate", "l_linestatus", "l_quantity", _LS, PIVOT_START,
                                   keys=["l_returnflag"], names=_LS_COLS, scale=2)


# -- melt: the revenue-by-priority pivot back to long form (NULL cells kept)
_MELT_SQL = panel_ctes(fill=False) + " " + " UNION ALL ".join(
    f"SELECT date, '{c}' AS feature, {c} AS value FROM rev" for c in P.PRIORITY_COLS)


@register("melt", sql=_MELT_SQL)
def melt_q(spark, sf_dir):
    rev = P.revenue_by_priority(P.load(spark, sf_dir, "orders"))
    return rev.unpivot(["date"], P.PRIORITY_COLS, "feature", "value")


# -- unions: target and order counts as one long table
_UNION_SQL = panel_ctes(fill=False) + """
SELECT series, date, demand AS value FROM target
UNION ALL SELECT series, date, CAST(n_orders AS DOUBLE) AS value FROM cnt"""


def _long_parts(spark, sf_dir):
    o = cut_lineage(P.orders_silver(P.load(spark, sf_dir, "orders")))     # key-month rows; both parts read these
    return (o.select("series", "date", F.col("revenue").alias("value")),
            o.select("series", "date", F.col("n_orders").cast("double").alias("value")))


@register("union_all", sql=_UNION_SQL)
def union_all_q(spark, sf_dir):
    return union_all(list(_long_parts(spark, sf_dir)))


@register("union_tagged", sql=panel_ctes(fill=False) + """
SELECT series, date, demand AS value, 'demand' AS source FROM target
UNION ALL SELECT series, date, CAST(n_orders AS DOUBLE) AS value, 'orders' AS source FROM cnt""")
def union_tagged_q(spark, sf_dir):
    t, c = _long_parts(spark, sf_dir)
    return union_tagged({"demand": t, "orders": c}, tag_col="source")
