"""Monthly demand panels built from the driver tables.

Mapping of the original sources onto the star schema:
- target series: order revenue per month, one series per order priority
  (``series`` key) — the panel runs every series through the same plans;
- exogenous monthly sources (shared by all series, joined on ``date`` only):
  shipped quantity by return flag (pivot), mean price and discount of the
  shipped lines (calendar-complete mean), revenue by priority (pivot, with
  natural month gaps that the fills close);
- a keyed source (joined on ``series`` + ``date``): number of orders.

Everything is aggregated to key-month grain before any join or window, so the
raw facts are only scanned and partially aggregated, never shuffled row by row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.functions.scalars import to_month
from panelcast.operators.joins import left_merge_chain
from panelcast.operators.monthly import exact_sum, fill_months, monthly_mean, monthly_pivot
from panelcast.operators.windows import ffill_bfill
from panelcast.session import cut_lineage, table_path

# --- fixed values: category domains of the driver tables ---------------------
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
RETURN_FLAGS = ["A", "N", "R"]
ORDER_STATUSES = ["F", "O", "P"]
# ------------------------------------------------------------------------------

PRIORITY_COLS = [f"rev_p{i + 1}" for i in range(len(PRIORITIES))]
QTY_COLS = [f"qty_{f.lower()}" for f in RETURN_FLAGS]
PRICE_COLS = ["price_mean", "discount_mean"]
KEYS = ["series"]
TARGET = "demand"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def demand_target(orders: DataFrame) -> DataFrame:
    """(series, date, demand): order revenue per priority and month."""
    return (orders.filter(F.col("o_orderdate").isNotNull())
            .groupBy(F.col("o_orderpriority").alias("series"),
                     to_month("o_orderdate").alias("date"))
            .agg(exact_sum(F.col("o_totalprice"), 2).alias(TARGET)))


def target_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(series, date, demand) for what needs the target alone: one aggregate of orders."""
    return demand_target(load(spark, sf_dir, "orders"))


def qty_by_flag(lineitem: DataFrame) -> DataFrame:
    return monthly_pivot(lineitem, "l_shipdate", "l_returnflag", "l_quantity",
                         RETURN_FLAGS, names=QTY_COLS, scale=2)


def price_means(lineitem: DataFrame) -> DataFrame:
    return monthly_mean(lineitem, "l_shipdate", ["l_extendedprice", "l_discount"],
                        out_names=PRICE_COLS, scale=2)


def revenue_by_priority(orders: DataFrame) -> DataFrame:
    return monthly_pivot(orders, "o_orderdate", "o_orderpriority", "o_totalprice",
                         PRIORITIES, names=PRIORITY_COLS, scale=2)


def order_counts(orders: DataFrame) -> DataFrame:
    return (orders.filter(F.col("o_orderdate").isNotNull())
            .groupBy(F.col("o_orderpriority").alias("series"), to_month("o_orderdate").alias("date"))
            .agg(F.count(F.lit(1)).alias("n_orders")))


def orders_silver(orders: DataFrame) -> DataFrame:
    """Silver monthly orders: (series, date, revenue, n_orders), one row per priority-month."""
    return (orders.filter(F.col("o_orderdate").isNotNull())
            .groupBy(F.col("o_orderpriority").alias("series"), to_month("o_orderdate").alias("date"))
            .agg(exact_sum(F.col("o_totalprice"), 2).alias("revenue"), F.count(F.lit(1)).alias("n_orders")))


def lineitem_silver(lineitem: DataFrame) -> DataFrame:
    """Silver monthly shipments per return flag with the sums/counts the features need.

    Money and quantity sums are kept at their fixed two decimals, so sums of
    these partial totals are exact and match a sum over the raw lines."""
    return (lineitem.filter(F.col("l_shipdate").isNotNull())
            .groupBy(to_month("l_shipdate").alias("date"), "l_returnflag")
            .agg(exact_sum(F.col("l_quantity"), 2).alias("qty"),
                 exact_sum(F.col("l_extendedprice"), 2).alias("price_sum"),
                 F.count("l_extendedprice").alias("price_n"),
                 exact_sum(F.col("l_discount"), 2).alias("disc_sum"),
                 F.count("l_discount").alias("disc_n")))


def silver_sources(spark: SparkSession, sf_dir: str, materialize: bool = True):
    """Each fact table is scanned once into its monthly silver table.

    The silver tables are tiny (key-month grain) and feed several features, so
    they are checkpointed to the shared folder: the raw facts are read exactly
    once per build and the later joins start from short lineage."""
    o = orders_silver(load(spark, sf_dir, "orders"))
    li = lineitem_silver(load(spark, sf_dir, "lineitem"))
    if materialize:
        # the two scans are independent jobs: submit them together
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=2) as ex:
            o, li = ex.map(cut_lineage, [o, li])
    return o, li


def features_from_silver(o: DataFrame, li: DataFrame) -> list[DataFrame]:
    qty = monthly_pivot(li, "date", "l_returnflag", "qty", RETURN_FLAGS, names=QTY_COLS, scale=2)
    tot = li.groupBy("date").agg(
        F.try_divide(exact_sum(F.col("price_sum"), 2), F.sum("price_n")).alias("price_mean"),
        F.try_divide(exact_sum(F.col("disc_sum"), 2), F.sum("disc_n")).alias("discount_mean"))
    price = fill_months(tot)
    rev = monthly_pivot(o, "date", "series", "revenue", PRIORITIES, names=PRIORITY_COLS, scale=2)
    cnt = o.select("series", "date", "n_orders")
    return [qty, price, rev, cnt]


def master_panel(spark: SparkSession, sf_dir: str, fill: bool = True) -> DataFrame:
    """Gold master panel: target anchor + four sources, forward/backward filled.

    Built from the silver monthly tables (one scan per fact table)."""
    o, li = silver_sources(spark, sf_dir)
    anchor = o.select("series", "date", F.col("revenue").alias(TARGET))
    merged = left_merge_chain(anchor, features_from_silver(o, li), keys=KEYS)
    if not fill:
        return merged
    fill_cols = QTY_COLS + PRICE_COLS + PRIORITY_COLS + ["n_orders"]
    return ffill_bfill(merged, fill_cols, keys=KEYS)


FEATURE_COLS = QTY_COLS + PRICE_COLS + PRIORITY_COLS + ["n_orders"]


def nation_target(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """(nation, date, demand): order revenue per customer nation and month (25 series).

    Orders are reduced to customer-month totals *before* the join with
    ``customer`` (a hot customer then contributes one row per month, not one per
    order), the join is a shuffle join on the customer key chosen by the
    optimizer (AQE splits skewed partitions), and ``nation`` (25 rows, fixed by
    the schema) is broadcast."""
    cm = (orders.filter(F.col("o_orderdate").isNotNull())
          .groupBy("o_custkey", to_month("o_orderdate").alias("date"))
          .agg(exact_sum(F.col("o_totalprice"), 2).alias("rev")))
    cust = customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    joined = cm.join(cust, "o_custkey").join(
        F.broadcast(nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"))),
        "c_nationkey")
    return joined.groupBy("nation", "date").agg(exact_sum(F.col("rev"), 2).alias(TARGET))


def nation_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25-series panel: nation demand + the shared monthly sources, filled per nation."""
    o, li = silver_sources(spark, sf_dir)
    anchor = nation_target(load(spark, sf_dir, "orders"), load(spark, sf_dir, "customer"),
                           load(spark, sf_dir, "nation"))
    feats = features_from_silver(o, li)[:3]          # date-keyed sources only
    merged = left_merge_chain(anchor, feats, keys=["nation"])
    return ffill_bfill(merged, QTY_COLS + PRICE_COLS + PRIORITY_COLS, keys=["nation"])
