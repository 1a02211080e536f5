"""Registered queries: scalar functions and projection/filter operators.

Text inputs that the original sources deliver (``'202301'`` codes, missing
markers, month-name header cells, ``'2024.0'`` years) are produced from the
driver tables by rule and parsed back, so each parse is checked against the
value it was made from.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.functions import scalars as X
from panelcast.operators import clean as C
from panelcast.plans import panels as P
from panelcast.plans.oracle_panels import M_ORDER, panel_ctes
from panelcast.plans.q_stats import MF_SQL, model_frame
from panelcast.plans.registry import register


def _orders(spark, sf_dir):
    return P.load(spark, sf_dir, "orders")


@register("parse_yyyymm", sql="""
SELECT o_orderkey, CAST(strptime(strftime(o_orderdate, '%Y%m'), '%Y%m') AS DATE) AS month FROM orders""")
def parse_yyyymm_q(spark, sf_dir):
    o = _orders(spark, sf_dir).select("o_orderkey", F.date_format("o_orderdate", "yyyyMM").alias("code"))
    return o.select("o_orderkey", X.parse_yyyymm("code").alias("month"))


# Marker text by rule: sizes ending in 0 report '-', sizes ending in 5 report '...'.
def _marker_text():
    return (F.when(F.col("p_size") % 10 == 0, F.lit("-"))
            .when(F.col("p_size") % 10 == 5, F.lit("..."))
            .otherwise(F.col("p_retailprice").cast("string")))


@register("parse_missing_marker", sql="""
SELECT p_partkey, CASE WHEN p_size % 10 = 0 OR p_size % 10 = 5 THEN NULL ELSE p_retailprice END AS value FROM part""")
def parse_missing_marker_q(spark, sf_dir):
    p = P.load(spark, sf_dir, "part").select("p_partkey", _marker_text().alias("raw"))
    return p.select("p_partkey", X.parse_missing_marker("raw").alias("value"))


@register("numeric_coerce", sql="""
SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_retailprice END AS value FROM part""")
def numeric_coerce_q(spark, sf_dir):
    raw = F.when(F.col("p_size") % 7 == 0, F.lit("n/d")).otherwise(F.col("p_retailprice").cast("string"))
    p = P.load(spark, sf_dir, "part").select("p_partkey", raw.alias("raw"))
    return p.select("p_partkey", X.numeric_coerce("raw").alias("value"))


@register("to_date", sql="SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day FROM orders")
def to_date_q(spark, sf_dir):
    return _orders(spark, sf_dir).select("o_orderkey", X.to_date("o_orderdate").alias("order_day"))


@register("trim_text", sql="SELECT o_orderkey, trim(o_orderpriority) AS priority FROM orders")
def trim_text_q(spark, sf_dir):
    o = _orders(spark, sf_dir).select(
        "o_orderkey", F.concat(F.lit("  "), "o_orderpriority", F.lit(" ")).alias("raw"))
    return o.select("o_orderkey", X.trim_text("raw").alias("priority"))


# Header cells as the sheet shows them: Portuguese abbreviation, newline, English.
def month_header_text(date_col: str):
    pt = F.element_at(F.lit(X.MONTH_ABBREVIATIONS), F.month(date_col))
    en = F.date_format(date_col, "MMM")
    return F.concat(F.initcap(pt), F.lit("\n"), en)


@register("month_name_to_number", sql="""
SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS month_no FROM orders""")
def month_name_to_number_q(spark, sf_dir):
    o = _orders(spark, sf_dir).select("o_orderkey", month_header_text("o_orderdate").alias("cell"))
    return o.select("o_orderkey", X.month_name_to_number("cell").alias("month_no"))


@register("clean_year", sql="SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders")
def clean_year_q(spark, sf_dir):
    o = _orders(spark, sf_dir).select(
        "o_orderkey", F.year("o_orderdate").cast("double").cast("string").alias("cell"))
    return o.select("o_orderkey", X.clean_year("cell").alias("year"))


@register("make_month", sql="""
SELECT o_orderkey, make_date(year(o_orderdate), month(o_orderdate), 1) AS month FROM orders""")
def make_month_q(spark, sf_dir):
    o = _orders(spark, sf_dir)
    return o.select("o_orderkey", X.make_month(F.year("o_orderdate"), F.month("o_orderdate")).alias("month"))


@register("month_offset", sql="""
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + INTERVAL 3 MONTH AS DATE) AS due FROM orders""")
def month_offset_q(spark, sf_dir):
    o = _orders(spark, sf_dir)
    return o.select("o_orderkey", X.month_offset(F.to_date("o_orderdate"), 3).alias("due"))


@register("format_year_month", sql="SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS ym FROM orders")
def format_year_month_q(spark, sf_dir):
    return _orders(spark, sf_dir).select("o_orderkey", X.format_year_month("o_orderdate").alias("ym"))


@register("round_n", sql="""
SELECT l_orderkey, l_linenumber, round(l_quantity / 8.0, 2) AS half_up, round_even(l_quantity / 8.0, 2) AS half_even,
       round(l_quantity / 8.0, 1) AS one_digit FROM lineitem""")
def round_n_q(spark, sf_dir):
    li = P.load(spark, sf_dir, "lineitem")
    v = F.col("l_quantity") / F.lit(8.0)
    return li.select("l_orderkey", "l_linenumber", X.round_half_up(v, 2).alias("half_up"),
                     X.round_half_even(v, 2).alias("half_even"), X.round_half_up(v, 1).alias("one_digit"))


def _human_sql(v: str) -> str:
    return (f"CASE WHEN {v} >= 1e9 THEN printf('%.1fB', {v} * 1e-9) WHEN {v} >= 1e6 THEN printf('%.1fM', {v} * 1e-6) "
            f"WHEN {v} >= 1e3 THEN printf('%.1fk', {v} * 1e-3) ELSE CAST(CAST(trunc({v}) AS BIGINT) AS VARCHAR) END")


@register("human_scale", sql=panel_ctes() + f"""
SELECT series, date, {_human_sql('demand')} AS demand_label, {_human_sql('CAST(n_orders AS DOUBLE)')} AS orders_label,
       {_human_sql('demand * 100.0')} AS scaled_label FROM master""")
def human_scale_q(spark, sf_dir):
    m = P.orders_silver(P.load(spark, sf_dir, "orders")).withColumnRenamed("revenue", P.TARGET)
    return m.select("series", "date", X.human_scale("demand").alias("demand_label"),
                    X.human_scale("n_orders").alias("orders_label"),
                    X.human_scale(F.col("demand") * F.lit(100.0)).alias("scaled_label"))


@register("text_match", sql="""
SELECT o_orderkey, CAST(contains(o_orderpriority, 'URGENT') AS INTEGER) AS is_urgent,
       CAST(starts_with(o_orderpriority, '1') AS INTEGER) AS is_first,
       string_split(replace(o_orderpriority, '-', '_'), '_')[-1] AS suffix FROM orders""")
def text_match_q(spark, sf_dir):
    o = _orders(spark, sf_dir)
    return o.select("o_orderkey", X.contains_int("o_orderpriority", "URGENT").alias("is_urgent"),
                    X.startswith_int("o_orderpriority", "1").alias("is_first"),
                    X.suffix_after_last_underscore(F.regexp_replace("o_orderpriority", "-", "_")).alias("suffix"))


# ---------------------------------------------------------------- §2.3 filters

@register("select_existing", sql="SELECT c_custkey, c_name, c_acctbal FROM customer")
def select_existing_q(spark, sf_dir):
    return C.select_existing(P.load(spark, sf_dir, "customer"), ["c_custkey", "c_name", "c_phone", "c_acctbal"])


# Supplier geography: country = region name, state = nation name, where one
# nation's suppliers arrive with a blank state (the NULL must be kept).
_GEO_SQL = """
SELECT s.s_suppkey, nullif(n.n_name, 'UNITED STATES') AS state, s.s_acctbal
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE r.r_name = 'AMERICA' AND nullif(n.n_name, 'UNITED STATES') IS DISTINCT FROM 'BRAZIL'"""


@register("geo_filter", sql=_GEO_SQL)
def geo_filter_q(spark, sf_dir):
    s = P.load(spark, sf_dir, "supplier")
    # nation (25 rows) and region (5 rows) are fixed-size dimension tables
    n = F.broadcast(P.load(spark, sf_dir, "nation"))
    r = F.broadcast(P.load(spark, sf_dir, "region"))
    g = (s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
          .select("s_suppkey", F.col("r_name").alias("country"),
                  F.nullif(F.col("n_name"), F.lit("UNITED STATES")).alias("state"), "s_acctbal"))
    return C.geo_filter(g, "country", "AMERICA", "state", "BRAZIL")


@register("date_open_filter", sql="""
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate > TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'""")
def date_open_filter_q(spark, sf_dir):
    o = _orders(spark, sf_dir).select("o_orderkey", "o_orderdate")
    return C.date_open_filter(o, "o_orderdate", F.lit("1996-01-01").cast("timestamp_ntz"),
                              F.lit("1997-01-01").cast("timestamp_ntz"))


@register("variable_and_section_filter", sql="""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_linestatus = 'F' AND l_returnflag IN ('A', 'R')""")
def variable_and_section_filter_q(spark, sf_dir):
    li = P.load(spark, sf_dir, "lineitem")
    out = C.variable_and_section_filter(li, "l_linestatus", "F", "l_returnflag", ["A", "R"])
    return out.select("l_orderkey", "l_linenumber", "l_quantity")


@register("variable_filter", sql="""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_linestatus = 'O'""")
def variable_filter_q(spark, sf_dir):
    li = P.load(spark, sf_dir, "lineitem")
    return C.variable_filter(li, "l_linestatus", "O").select("l_orderkey", "l_linenumber", "l_quantity")


@register("target_select", sql=f"""
SELECT {M_ORDER} AS date, round(sum(o_totalprice), 2) AS target FROM orders
WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' GROUP BY 1""")
def target_select_q(spark, sf_dir):
    # long (priority, status, month, value) table, then the two-key pick
    o = _orders(spark, sf_dir)
    long = (o.groupBy("o_orderpriority", "o_orderstatus", X.to_month("o_orderdate").alias("month"))
             .agg(F.round(F.sum("o_totalprice"), 2).alias("value")))
    return C.target_select(long, {"o_orderpriority": "1-URGENT", "o_orderstatus": "F"}, "month", "value")


_RENAME = {"series": "priority", "demand": "revenue", "absent_column": "never_used"}


@register("rename_map", sql=panel_ctes() + """
SELECT series AS priority, date, demand AS revenue, qty_a FROM master""")
def rename_map_q(spark, sf_dir):
    m = P.master_panel(spark, sf_dir).select("series", "date", "demand", "qty_a")
    return C.rename_map(m, _RENAME)


@register("drop_if_present", sql=panel_ctes() + """
SELECT series, date, demand, qty_a, qty_n, qty_r, price_mean, discount_mean FROM master""")
def drop_if_present_q(spark, sf_dir):
    m = P.master_panel(spark, sf_dir)
    return C.drop_if_present(m, P.PRIORITY_COLS + ["n_orders", "absent_column"])


@register("select_by_name_match", sql=panel_ctes() + f"""
SELECT series, date, {', '.join(P.PRIORITY_COLS)} FROM master""")
def select_by_name_match_q(spark, sf_dir):
    return C.select_by_name_match(P.master_panel(spark, sf_dir), "rev_", keep=["series", "date"])


@register("row_sum_skip_null", sql=panel_ctes(fill=False) + f"""
SELECT series, date, round({' + '.join(f'coalesce({c}, 0)' for c in P.PRIORITY_COLS)}, 2) AS rev_total FROM merged""")
def row_sum_skip_null_q(spark, sf_dir):
    m = P.master_panel(spark, sf_dir, fill=False)
    out = C.row_sum_skip_null(m, P.PRIORITY_COLS, "rev_total")
    return out.select("series", "date", F.round("rev_total", 2).alias("rev_total"))


@register("numeric_columns", sql=panel_ctes() + f"""
SELECT demand, {', '.join(P.FEATURE_COLS)} FROM master""")
def numeric_columns_q(spark, sf_dir):
    m = P.master_panel(spark, sf_dir)
    return m.select(*C.numeric_columns(m))


@register("fill_constant", sql=panel_ctes(fill=False) + f"""
SELECT series, date, demand, {', '.join(f'coalesce({c}, 0) AS {c}' for c in P.FEATURE_COLS)} FROM merged""")
def fill_constant_q(spark, sf_dir):
    return C.fill_constant(P.master_panel(spark, sf_dir, fill=False), 0)


@register("drop_any_null", sql=panel_ctes(fill=False) + f"""
SELECT * FROM merged WHERE {' AND '.join(f'{c} IS NOT NULL' for c in ['series', 'date', 'demand'] + P.FEATURE_COLS)}""")
def drop_any_null_q(spark, sf_dir):
    return C.drop_any_null(P.master_panel(spark, sf_dir, fill=False))


@register("drop_null_key", sql=panel_ctes(fill=False) + " SELECT * FROM merged WHERE rev_p2 IS NOT NULL")
def drop_null_key_q(spark, sf_dir):
    return C.drop_null_key(P.master_panel(spark, sf_dir, fill=False), "rev_p2")


@register("drop_all_null", sql=panel_ctes(fill=False) + """
SELECT * FROM merged WHERE rev_p2 IS NOT NULL OR rev_p3 IS NOT NULL OR rev_p5 IS NOT NULL""")
def drop_all_null_q(spark, sf_dir):
    return C.drop_all_null(P.master_panel(spark, sf_dir, fill=False), ["rev_p2", "rev_p3", "rev_p5"])


@register("literal_tag", sql=MF_SQL + """
SELECT series, date, split, demand AS y_real, demand_lag_1 AS y_pred, 'naive' AS model FROM mf""")
def literal_tag_q(spark, sf_dir):
    mf = model_frame(spark, sf_dir).select("series", "date", "split", F.col("demand").alias("y_real"),
                                           F.col("demand_lag_1").alias("y_pred"))
    return C.literal_tag(mf, model="naive")
