"""Registered queries: sources, landed-grid decoding, sinks and tables.

Each query first lands a raw artefact derived from the driver tables (see
``sources.landing``) in the shared scratch folder, then runs the decoder on it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from panelcast import sinks as K
from panelcast.functions import scalars as X
from panelcast.operators import clean as C
from panelcast.operators import grid as G
from panelcast.sources import files as FS
from panelcast.sources import landing as L
from panelcast.plans import panels as P
from panelcast.plans import sqlgen as S
from panelcast.plans.oracle_panels import M_ORDER, M_SHIP, panel_ctes
from panelcast.plans.registry import register
from panelcast.session import scratch_path

STATUS_KEYWORDS = [f"Status {s}" for s in P.ORDER_STATUSES]


def _performance_grid(spark, sf_dir):
    path, n = L.land_performance_sheet(spark, P.load(spark, sf_dir, "orders"))
    return FS.scan_landed_grid(spark, path, n)


def _sheet_sql() -> str:
    """The filled cells of the landed performance sheet, rebuilt in SQL."""
    from panelcast.functions.scalars import MONTH_ABBREVIATIONS
    pt = "[" + ", ".join(f"'{m}'" for m in MONTH_ABBREVIATIONS) + "]"
    return f"""WITH agg AS (SELECT o_orderstatus, o_orderpriority, {M_ORDER} AS month, round(sum(o_totalprice), 2) AS v
             FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2, 3),
b AS (SELECT min(month) AS lo, max(month) AS hi FROM agg),
cal AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM b),
cal2 AS (SELECT month, CAST(row_number() OVER (ORDER BY month) AS INTEGER) AS col_idx FROM cal),
vals AS (SELECT '{L.MEMO_LABEL}' AS label, 0 AS kind, '' AS grp, '' AS sub, month, round(sum(v), 2) AS v FROM agg GROUP BY month
         UNION ALL SELECT 'Status ' || o_orderstatus || ' (total)', 1, o_orderstatus, '', month, round(sum(v), 2)
                   FROM agg GROUP BY o_orderstatus, month
         UNION ALL SELECT o_orderpriority, 2, o_orderstatus, o_orderpriority, month, v FROM agg),
ks AS (SELECT DISTINCT label, kind, grp, sub FROM vals),
lay0 AS (SELECT * FROM ks UNION ALL SELECT NULL, 3, grp, '' FROM ks WHERE kind = 1),
lay AS (SELECT *, CAST(row_number() OVER (ORDER BY CASE WHEN kind = 0 THEN 0 ELSE 1 END, grp, kind, sub) + 2 AS INTEGER)
                  AS row_idx FROM lay0),
cells AS (
  SELECT 0 AS row_idx, 0 AS col_idx, '{L.SHEET_TITLE}' AS text
  UNION ALL SELECT 1, 0, '{L.SPEC_HEADER}'
  UNION ALL SELECT 2, 0, NULL
  UNION ALL SELECT 1, col_idx, CASE WHEN month(month) = 1 OR col_idx = 1 THEN CAST(year(month) AS VARCHAR) || '.0' END FROM cal2
  UNION ALL SELECT 2, col_idx, upper({pt}[month(month)][1]) || {pt}[month(month)][2:] || chr(10) || strftime(month, '%b') FROM cal2
  UNION ALL SELECT row_idx, 0, label FROM lay
  UNION ALL SELECT l.row_idx, c.col_idx,
         CASE WHEN v.kind = 0 AND v.month = (SELECT lo FROM b) THEN '{L.JUNK_CELL}' ELSE printf('%.2f', v.v) END
  FROM vals v JOIN lay l ON v.kind = l.kind AND v.grp = l.grp AND v.sub = l.sub JOIN cal2 c ON v.month = c.month)
SELECT 'performance_sheet' AS file, row_idx, col_idx, text AS cell FROM cells WHERE text IS NOT NULL"""


@register("scan_landed_grid", sql=_sheet_sql())
def scan_landed_grid_q(spark, sf_dir):
    """Every filled cell of the landed sheet in long form (its width follows the data)."""
    return G.cells(_performance_grid(spark, sf_dir)).filter(F.col("cell").isNotNull())


@register("grid_header_locate", sql=f"""
WITH sheet AS (SELECT file, row_idx, max(CASE WHEN col_idx = 0 THEN cell END) AS col_0,
                      max(CASE WHEN col_idx = 1 THEN cell END) AS col_1
               FROM ({_sheet_sql()}) GROUP BY file, row_idx),
g AS (SELECT file, row_idx,
             coalesce(contains(lower(col_0), 'especifica') AND contains(lower(col_0), 'specification'), false) AS spec,
             coalesce(contains(lower(col_1), 'jan'), false) AS mon FROM sheet),
m AS (SELECT file, min(CASE WHEN mon AND NOT spec THEN row_idx END) AS month_row FROM g GROUP BY file)
SELECT m.file, m.month_row,
       coalesce(max(CASE WHEN g.spec AND g.row_idx < m.month_row THEN g.row_idx END),
                min(CASE WHEN g.spec AND g.row_idx > m.month_row THEN g.row_idx END)) AS spec_row
FROM m JOIN g ON m.file = g.file GROUP BY m.file, m.month_row""")
def grid_header_locate_q(spark, sf_dir):
    return G.grid_header_locate(_performance_grid(spark, sf_dir), L.SPEC_WORDS)


_CAL_SQL = f"""WITH m AS (SELECT {M_ORDER} AS date FROM orders WHERE o_orderdate IS NOT NULL),
cal AS ({S.calendar('m')})"""


@register("header_ffill", sql=_CAL_SQL + """
SELECT CAST(row_number() OVER (ORDER BY date) AS INTEGER) AS col_idx, date FROM cal""")
def header_ffill_q(spark, sf_dir):
    g = _performance_grid(spark, sf_dir)
    located = G.grid_header_locate(g, L.SPEC_WORDS)
    return G.header_map(g, located).select("col_idx", "date")


_LABELS_SQL = f"""
rows AS (SELECT DISTINCT '{L.NO_CATEGORY}' AS category, '{L.MEMO_LABEL}' AS spec FROM orders
  UNION ALL SELECT DISTINCT 'Status ' || o_orderstatus || ' (total)', 'Status ' || o_orderstatus || ' (total)' FROM orders
  UNION ALL SELECT DISTINCT 'Status ' || o_orderstatus || ' (total)', o_orderpriority FROM orders)"""


@register("category_ffill", sql="WITH " + _LABELS_SQL + " SELECT category, spec FROM rows")
def category_ffill_q(spark, sf_dir):
    g = _performance_grid(spark, sf_dir)
    located = G.grid_header_locate(g, L.SPEC_WORDS)
    rows = g.join(located.select("file", "month_row"), "file") \
            .filter((F.col("row_idx") > F.col("month_row")) & F.col("col_0").isNotNull()) \
            .select("file", "row_idx", F.col("col_0").alias("label"))
    out = G.category_ffill(rows, "label", STATUS_KEYWORDS, L.NO_CATEGORY)
    return out.select("category", F.trim("label").alias("spec"))


@register("hierarchical_grid_to_long", sql=_CAL_SQL + ", " + _LABELS_SQL + f""",
vals AS (
  SELECT '{L.NO_CATEGORY}' AS category, '{L.MEMO_LABEL}' AS spec, {M_ORDER} AS date, round(sum(o_totalprice), 2) AS v
  FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 3
  UNION ALL SELECT 'Status ' || o_orderstatus || ' (total)', 'Status ' || o_orderstatus || ' (total)', {M_ORDER},
         round(sum(o_totalprice), 2) FROM orders WHERE o_orderdate IS NOT NULL GROUP BY o_orderstatus, 3
  UNION ALL SELECT 'Status ' || o_orderstatus || ' (total)', o_orderpriority, {M_ORDER}, round(sum(o_totalprice), 2)
  FROM orders WHERE o_orderdate IS NOT NULL GROUP BY o_orderstatus, o_orderpriority, 3)
SELECT r.category, r.spec, c.date,
       CASE WHEN r.spec = '{L.MEMO_LABEL}' AND c.date = (SELECT min(date) FROM cal) THEN NULL ELSE v.v END AS value
FROM rows r JOIN cal c ON TRUE
LEFT JOIN vals v ON v.category = r.category AND v.spec = r.spec AND v.date = c.date""")
def hierarchical_grid_to_long_q(spark, sf_dir):
    out = G.hierarchical_grid_to_long(_performance_grid(spark, sf_dir), L.SPEC_WORDS,
                                      STATUS_KEYWORDS, L.NO_CATEGORY)
    return out.drop("file")


# -- vehicles sheet -------------------------------------------------------------

def _vehicle_grid(spark, sf_dir):
    path, n = L.land_vehicle_sheet(spark, P.load(spark, sf_dir, "lineitem"), P.RETURN_FLAGS)
    return FS.scan_landed_grid(spark, path, n)


_VEH_COLS = [f"{f}_{s}" for f in P.RETURN_FLAGS for s in L.VEHICLE_VARIABLES]


def _veh_sql(value_expr_fmt: str) -> str:
    parts = [value_expr_fmt.format(
        e=f"round(sum(CASE WHEN l_returnflag = '{f}' AND l_linestatus = '{s}' THEN l_quantity END), 2)",
        n=f"{f}_{s}") for f in P.RETURN_FLAGS for s in L.VEHICLE_VARIABLES]
    return ", ".join(parts)


@register("scan_skip_rows", sql=f"""
SELECT strftime({M_SHIP}, '%Y-%m-%d') AS date_text,
       round(sum(CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN l_quantity END), 2) AS a_f
FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1""")
def scan_skip_rows_q(spark, sf_dir):
    rows = G.skip_rows(_vehicle_grid(spark, sf_dir), 3)
    return rows.select(F.col("col_0").alias("date_text"), X.numeric_coerce("col_1").alias("a_f"))


@register("block_header_rename", sql=f"""
SELECT {M_SHIP} AS Date, {_veh_sql('{e} AS {n}')}
FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1""")
def block_header_rename_q(spark, sf_dir):
    named = G.block_header_rename(_vehicle_grid(spark, sf_dir), 3, L.VEHICLE_VARIABLES)
    return named.select(X.to_date("Date").alias("Date"),
                        *[X.numeric_coerce(c).alias(c) for c in _VEH_COLS])


@register("vehicle_total", sql=f"""
SELECT {M_SHIP} AS Date, {', '.join(f"round(sum(CASE WHEN l_returnflag = '{f}' AND l_linestatus = 'F' THEN l_quantity END), 2) AS {f}_F" for f in P.RETURN_FLAGS)},
       round({' + '.join(f"coalesce(round(sum(CASE WHEN l_returnflag = '{f}' AND l_linestatus = 'F' THEN l_quantity END), 2), 0)" for f in P.RETURN_FLAGS)}, 2) AS total_f
FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1""")
def vehicle_total_q(spark, sf_dir):
    """The vehicles sheet end to end: rename, pick one variable by name, row total."""
    named = G.block_header_rename(_vehicle_grid(spark, sf_dir), 3, L.VEHICLE_VARIABLES)
    typed = named.select(X.to_date("Date").alias("Date"), *[X.numeric_coerce(c).alias(c) for c in _VEH_COLS])
    picked = C.select_by_name_match(typed, "_F", keep=["Date"])
    cols = [c for c in picked.columns if c != "Date"]
    out = C.row_sum_skip_null(picked, cols, "total_f")
    return out.withColumn("total_f", F.round("total_f", 2))


# -- region responses ---------------------------------------------------------------

def _region_grid(spark, sf_dir):
    rows = L.region_response_rows(*(P.load(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region")))
    paths, n = L.land_region_responses(spark, rows)
    return FS.region_union_scan(spark, paths, n)


_RAW_REGION_SQL = f"""
WITH om AS (SELECT o_custkey, o_orderstatus, {M_ORDER} AS month, sum(o_totalprice) AS rev, count(*) AS cnt
            FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2, 3),
agg AS (SELECT r.r_regionkey, r.r_name, o_orderstatus, month, round(sum(rev), 2) AS revenue,
               CAST(sum(cnt) AS DOUBLE) AS orders
        FROM om JOIN customer c ON om.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY 1, 2, 3, 4),
lg AS (SELECT r_regionkey, r_name, o_orderstatus, month, 'revenue' AS variable, revenue AS v FROM agg
       UNION ALL SELECT r_regionkey, r_name, o_orderstatus, month, 'orders', orders FROM agg),
data AS (SELECT 'r_regionkey=' || r_regionkey AS file,
                CAST(row_number() OVER (PARTITION BY r_regionkey ORDER BY month, variable, o_orderstatus) AS INTEGER) AS row_idx,
                CAST(r_regionkey AS VARCHAR) AS col_0, r_name AS col_1, '40' AS col_2, 'BRL' AS col_3,
                CASE WHEN o_orderstatus = 'P' AND month(month) = 1 THEN '-'
                     WHEN o_orderstatus = 'P' AND month(month) = 12 THEN '...' ELSE printf('%.2f', v) END AS col_4,
                strftime(month, '%Y%m') AS col_5, strftime(month, '%B %Y') AS col_6, variable AS col_7,
                o_orderstatus AS col_8 FROM lg),
heads AS (SELECT 'r_regionkey=' || r_regionkey AS file, 0 AS row_idx, {', '.join(f"'{t}' AS col_{i}" for i, t in enumerate(L.REGION_LABELS))}
          FROM region),
raw AS (SELECT * FROM heads UNION ALL SELECT * FROM data)"""


@register("region_union_scan", sql=_RAW_REGION_SQL + " SELECT * FROM raw")
def region_union_scan_q(spark, sf_dir):
    return _region_grid(spark, sf_dir)


@register("promote_header", sql=_RAW_REGION_SQL + " SELECT " + ", ".join(
    f'col_{i} AS "{t}"' for i, t in enumerate(L.REGION_LABELS))
    + " FROM raw WHERE NOT (file = (SELECT min(file) FROM raw) AND row_idx = 0)")
def promote_header_q(spark, sf_dir):
    return G.promote_header(_region_grid(spark, sf_dir))


def _turned_grid(spark, sf_dir):
    """The region responses with the columns of every other region in reverse order."""
    rows = L.region_response_rows(*(P.load(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region")))
    n = len(L.REGION_LABELS)
    odd = F.col("r_regionkey") % 2 == 1
    turned = rows.select("r_regionkey", "row_idx", *[F.when(odd, F.col(f"col_{n - 1 - i}")).otherwise(F.col(f"col_{i}")).alias(f"col_{i}") for i in range(n)])
    paths, n = L.land_region_responses(spark, turned)
    return FS.region_union_scan(spark, paths, n)


@register("region_headers_by_name", sql=_RAW_REGION_SQL + " SELECT file, " + ", ".join(
    f'col_{i} AS "{t}"' for i, t in enumerate(L.REGION_LABELS)) + " FROM data")
def region_headers_by_name_q(spark, sf_dir):
    """Responses whose columns come in two orders, every file by its own header row."""
    return G.promote_headers(_turned_grid(spark, sf_dir), keep=["file"])


_REGION_DATA_SQL = f"""
WITH om AS (SELECT o_custkey, o_orderstatus, {M_ORDER} AS month, sum(o_totalprice) AS rev, count(*) AS cnt
            FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2, 3),
agg AS (SELECT r.r_regionkey, o_orderstatus, month, round(sum(rev), 2) AS revenue, CAST(sum(cnt) AS DOUBLE) AS orders
        FROM om JOIN customer c ON om.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY 1, 2, 3),
lg AS (SELECT r_regionkey, o_orderstatus, month, 'revenue' AS variable, revenue AS v FROM agg
       UNION ALL SELECT r_regionkey, o_orderstatus, month, 'orders', orders FROM agg)
SELECT CAST(r_regionkey AS INTEGER) AS region_code, month, variable, o_orderstatus AS section,
       CASE WHEN o_orderstatus = 'P' AND month(month) IN (1, 12) THEN NULL ELSE v END AS value FROM lg"""


def _region_typed(spark, sf_dir):
    named = G.promote_header(_region_grid(spark, sf_dir))
    clean = C.repeated_header_filter(named, L.REGION_LABELS[0], L.REGION_LABELS[0])
    return clean.select(F.col(f"`{L.REGION_LABELS[0]}`").cast("int").alias("region_code"),
                        X.parse_yyyymm(F.col(f"`{L.REGION_LABELS[5]}`")).alias("month"),
                        F.col(f"`{L.REGION_LABELS[7]}`").alias("variable"),
                        F.col(f"`{L.REGION_LABELS[8]}`").alias("section"),
                        X.parse_missing_marker(F.col(f"`{L.REGION_LABELS[4]}`")).alias("value"))


@register("repeated_header_filter", sql=_REGION_DATA_SQL)
def repeated_header_filter_q(spark, sf_dir):
    return _region_typed(spark, sf_dir)


@register("bronze_responses", sql=_RAW_REGION_SQL + " SELECT * FROM raw")
def bronze_responses_q(spark, sf_dir):
    """The landed responses as a bronze table: every cell as it came, header rows included."""
    from panelcast.plans.layers import save_bronze
    return save_bronze(_region_grid(spark, sf_dir), "region_responses", f"bronze_{uuid.uuid4().hex[:8]}")


_SECTIONS, _SECTION_COLS = ["F", "P"], ["finished", "partial"]


@register("sector_monthly", sql=f"""
WITH base AS ({_REGION_DATA_SQL})
SELECT region_code, month AS date, {S.pivot_sums('section', 'value', _SECTIONS, _SECTION_COLS, 2)} FROM base
WHERE variable = 'revenue' AND section IN ('F', 'P') GROUP BY 1, 2""")
def sector_monthly_q(spark, sf_dir):
    """Responses by sector to a silver table: bronze copy, one variable and two sections,
    markers, monthly pivot; the responses come in two column orders."""
    from panelcast.plans.layers import SectorFlow, build_sector_silver
    run, names = uuid.uuid4().hex[:8], L.REGION_LABELS
    flow = SectorFlow(names[0], names[5], names[7], names[8], names[4], "revenue", _SECTIONS, _SECTION_COLS)
    return build_sector_silver(_turned_grid(spark, sf_dir), flow, "sector_monthly", "2002-01-01", f"bronze_{run}", f"silver_{run}")


@register("region_monthly_sum", sql=f"""
WITH base AS ({_REGION_DATA_SQL}),
agg AS (SELECT region_code, month AS date, sum(value) AS total FROM base WHERE variable = 'orders' GROUP BY 1, 2),
cal AS ({S.calendar('agg', ['region_code'])})
SELECT c.region_code, c.date, coalesce(a.total, 0) AS total
FROM cal c LEFT JOIN agg a ON c.region_code = a.region_code AND c.date = a.date""")
def region_monthly_sum_q(spark, sf_dir):
    """Per-region responses end to end: typed rows, one variable, monthly sum over the calendar."""
    from panelcast.operators.monthly import monthly_sum
    t = C.variable_filter(_region_typed(spark, sf_dir), "variable", "orders")
    return monthly_sum(t, "month", "value", keys=["region_code"], out_names=["total"])


# -- series extracts ----------------------------------------------------------------
# Landed long extract (code, date, value): daily revenue per priority, code = its rank.
_CODES = {name: i + 1 for i, name in enumerate(P.PRIORITIES)}
_PICK = {"urgent": 1, "unspecified": 4}


def _series_long(spark, sf_dir):
    o = P.load(spark, sf_dir, "orders")
    code = F.element_at(F.create_map(*[x for k, v in _CODES.items() for x in (F.lit(k), F.lit(v))]),
                        F.col("o_orderpriority"))
    return o.groupBy(code.alias("code"), F.to_date("o_orderdate").alias("date")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("value"))


def series_to_wide(long, picks: dict[str, int]):
    """Named series by code -> one column per series by date."""
    names = F.create_map(*[x for k, v in picks.items() for x in (F.lit(v), F.lit(k))])
    sel = long.filter(F.col("code").isin(*picks.values())).withColumn("name", F.element_at(names, F.col("code")))
    return sel.groupBy("date").pivot("name", list(picks)).agg(F.max("value"))


_CODE_SQL = "CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in _CODES.items()) + " END"


@register("series_to_wide", sql=f"""
WITH lg AS (SELECT {_CODE_SQL} AS code, CAST(o_orderdate AS DATE) AS date, round(sum(o_totalprice), 2) AS value
            FROM orders GROUP BY 1, 2)
SELECT date, max(CASE WHEN code = 1 THEN value END) AS urgent, max(CASE WHEN code = 4 THEN value END) AS unspecified
FROM lg WHERE code IN (1, 4) GROUP BY date""")
def series_to_wide_q(spark, sf_dir):
    return series_to_wide(_series_long(spark, sf_dir), _PICK)


_META = ["CODE", "RAW DATE", "DAY", "MONTH", "YEAR"]


@register("series_rename_scan", sql="""
SELECT CAST(o_orderdate AS DATE) AS Date, round(sum(o_totalprice), 2) AS revenue_daily FROM orders
WHERE o_orderpriority = '1-URGENT' GROUP BY 1""")
def series_rename_scan_q(spark, sf_dir):
    # raw extract shape: DATE, CODE, RAW DATE, DAY, MONTH, YEAR, VALUE (<unit>)
    lg = _series_long(spark, sf_dir).filter(F.col("code") == 1)
    raw = lg.select(F.col("date").alias("DATE"), F.col("code").cast("string").alias("CODE"),
                    F.date_format("date", "yyyy-MM-dd").alias("RAW DATE"), F.dayofmonth("date").alias("DAY"),
                    F.month("date").alias("MONTH"), F.year("date").alias("YEAR"),
                    F.col("value").alias("VALUE (BRL)"))
    out = C.drop_if_present(raw, _META)
    return C.rename_map(out, {"DATE": "Date", "VALUE (BRL)": "revenue_daily"})


@register("catalog_search", sql="SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'gear')")
def catalog_search_q(spark, sf_dir):
    p = P.load(spark, sf_dir, "part").select("p_partkey", "p_name")
    return p.filter(F.col("p_name").contains("gear"))


_ENC_SCHEMA = StructType([StructField(L.ENCODED_NAMES[0], LongType()), StructField(L.ENCODED_NAMES[1], StringType()),
                          StructField(L.ENCODED_NAMES[2], IntegerType()), StructField(L.ENCODED_NAMES[3], DoubleType()),
                          StructField(L.ENCODED_NAMES[4], StringType())])


@register("scan_csv_encoded", sql="SELECT " + ", ".join(
    f'{c} AS "{n}"' for c, n in zip(["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
                                   L.ENCODED_NAMES)) + " FROM customer")
def scan_csv_encoded_q(spark, sf_dir):
    path = L.land_encoded_csv(spark, P.load(spark, sf_dir, "customer"))
    return FS.scan_csv_encoded(spark, path, _ENC_SCHEMA)


@register("latest_snapshot", sql="""
SELECT * FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)""")
def latest_snapshot_q(spark, sf_dir):
    base = L.land_snapshots(spark, P.load(spark, sf_dir, "orders"))
    return FS.latest_snapshot(spark, f"{base}/snapshot=*")


@register("last_modified_check", sql="SELECT count(*) > 0 AS told, TRUE AS newest FROM orders")
def last_modified_check_q(spark, sf_dir):
    """The time is there, and no file behind the path is newer."""
    base = L.land_snapshots(spark, P.load(spark, sf_dir, "orders"))
    each = spark.read.parquet(base).select(F.max("_metadata.file_modification_time").alias("m"))
    return FS.last_modified(base, spark).join(F.broadcast(each)).select(
        F.col("last_modified").isNotNull().alias("told"), (F.col("last_modified") >= F.col("m")).alias("newest"))


@register("last_modified")
def last_modified_q(spark, sf_dir):
    base = L.land_snapshots(spark, P.load(spark, sf_dir, "orders"))
    return FS.last_modified(base, spark)


# -- tables and sinks -------------------------------------------------------------

def _saved_master(spark, sf_dir):
    """The master panel stored as a table of a database of its own; the database."""
    layer = f"gold_{uuid.uuid4().hex[:8]}"
    K.save_table(P.master_panel(spark, sf_dir), layer, "master_panel", path=scratch_path(spark, "gold-master_panel"))
    return layer


@register("save_table", sql=panel_ctes() + " SELECT *, true AS has_audit FROM master")
def save_table_q(spark, sf_dir):
    # the stored table as written: every column plus a set audit timestamp
    t = spark.table(K.table_name(_saved_master(spark, sf_dir), "master_panel"))
    return t.withColumn("has_audit", F.col(K.AUDIT_COL).isNotNull()).drop(K.AUDIT_COL)


@register("read_table", sql=panel_ctes() + " SELECT * FROM master")
def read_table_q(spark, sf_dir):
    return K.read_table(spark, _saved_master(spark, sf_dir), "master_panel", order_by="date")


@register("load_master", sql=panel_ctes() + " SELECT * FROM master")
def load_master_q(spark, sf_dir):
    return K.load_master(spark, _saved_master(spark, sf_dir))


@register("table_last_modified")
def table_last_modified_q(spark, sf_dir):
    """Time of the last write of a saved table (the UI cache key), from file metadata."""
    return K.table_last_modified(spark, _saved_master(spark, sf_dir), "master_panel")


@register("table_last_modified_check", sql="SELECT count(*) > 0 AS told, TRUE AS recent FROM orders")
def table_last_modified_check_q(spark, sf_dir):
    """The time is there, and not before the table was written."""
    start = spark.range(1).select(F.current_timestamp()).first()[0]
    t = K.table_last_modified(spark, _saved_master(spark, sf_dir), "master_panel")
    return t.select(F.col("last_modified").isNotNull().alias("told"), (F.col("last_modified") >= F.lit(start) - F.expr("INTERVAL 1 MINUTE")).alias("recent"))


@register("normalise_for_write", sql="""
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS o_totalprice FROM orders""")
def normalise_for_write_q(spark, sf_dir):
    # a landed extract where missing prices arrived as NaN (status P by rule)
    o = P.load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_orderstatus") == "P", F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("o_totalprice"))
    return K.normalise_for_write(o, string_cols=["o_custkey"])



# -- validation and export --------------------------------------------------------
AS_OF = "2002-06-01"


@register("validate_output", sql=panel_ctes() + f"""
SELECT 'min_rows' AS "check", CAST(NULL AS VARCHAR) AS col, count(*) >= 60 AS passed FROM master
UNION ALL SELECT 'not_all_null', 'demand', count(demand) > 0 FROM master
UNION ALL SELECT 'not_all_null', 'qty_a', count(qty_a) > 0 FROM master
UNION ALL SELECT 'present', 'absent_column', false
UNION ALL SELECT 'recent', 'date', coalesce(max(date) >= CAST(DATE '{AS_OF}' - INTERVAL 6 MONTH AS DATE), false) FROM master""")
def validate_output_q(spark, sf_dir):
    from panelcast.operators.quality import validation_report
    return validation_report(P.master_panel(spark, sf_dir), min_rows=60,
                             required=["demand", "qty_a", "absent_column"], date_col="date",
                             recent_months=6, as_of=AS_OF)


_EXPORT_SCHEMA = "series string, h int, month string, prediction double, lower double, upper double"


def _export_sql():
    from panelcast.plans.q_stats import preds_sql
    return preds_sql(["naive"]) + """,
mae AS (SELECT series, avg(abs(y_real - y_pred)) AS mae FROM preds WHERE split = 'test' GROUP BY series),
last AS (SELECT series, max(date) AS last_date, arg_max(demand / 1e6, date) AS prediction FROM mf GROUP BY series),
hz AS (SELECT last.*, CAST(unnest(range(1, 13)) AS INTEGER) AS h FROM last)
SELECT hz.series, hz.h, strftime(CAST(hz.last_date + to_months(hz.h) AS DATE), '%Y-%m') AS month,
       round(prediction, 1) + 0.0 AS prediction, round(prediction - mae * sqrt(h), 1) + 0.0 AS lower,
       round(prediction + mae * sqrt(h), 1) + 0.0 AS upper
FROM hz LEFT JOIN mae ON hz.series = mae.series"""


@register("export_table", sql=_export_sql())
def export_table_q(spark, sf_dir):
    from panelcast.plans.q_stats import error_band_q
    path = scratch_path(spark, "export") + "/forecast_table"
    K.export_table(error_band_q(spark, sf_dir), path)
    return spark.read.schema(_EXPORT_SCHEMA).option("header", True).csv(path)


# -- register file -> monthly silver series (CSV, select, geography, pivot, fill, validate)
_WORKS_SCHEMA = StructType([StructField(L.WORKS_HEADER[0], StringType()), StructField(L.WORKS_HEADER[1], StringType()),
                            StructField(L.WORKS_HEADER[2], StringType()), StructField(L.WORKS_HEADER[3], StringType()),
                            StructField(L.WORKS_HEADER[4], DoubleType()), StructField(L.WORKS_HEADER[5], StringType())])
_UNITS = P.PRIORITIES
_UNIT_COLS = [f"unit_{i + 1}" for i in range(len(_UNITS))]
WORKS_START = "1996-01-01"


@register("works_monthly", sql=f"""
WITH r AS (SELECT rg.r_name AS country, nullif(n.n_name, 'CANADA') AS state, CAST(o.o_orderdate AS DATE) AS d,
                  o.o_orderpriority AS unit, o.o_totalprice AS area
           FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
           JOIN region rg ON n.n_regionkey = rg.r_regionkey),
f AS (SELECT * FROM r WHERE country = 'AMERICA' AND state IS DISTINCT FROM 'BRAZIL' AND d IS NOT NULL AND unit IS NOT NULL),
p AS (SELECT CAST(date_trunc('month', d) AS DATE) AS date, {S.pivot_sums('unit', 'area', _UNITS, _UNIT_COLS, 2)}
      FROM f GROUP BY 1)
SELECT date, {', '.join(f'coalesce({c}, 0) AS {c}' for c in _UNIT_COLS)} FROM p WHERE date > DATE '{WORKS_START}'""")
def works_monthly_q(spark, sf_dir):
    """Register file to monthly silver: the full source flow of one landed file."""
    from panelcast.operators.monthly import monthly_pivot_filled
    from panelcast.operators.quality import validate_output
    path = L.land_works_register(spark, *(P.load(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region")))
    raw = FS.scan_csv_encoded(spark, path, _WORKS_SCHEMA)
    wanted = [L.WORKS_HEADER[i] for i in (0, 1, 2, 3, 4)] + ["Nome do município"]   # one column is absent
    sel = C.select_existing(raw, wanted)
    geo = C.geo_filter(sel, L.WORKS_HEADER[0], "AMERICA", L.WORKS_HEADER[1], "BRAZIL")
    typed = geo.withColumn(L.WORKS_HEADER[2], X.to_date(F.col(f"`{L.WORKS_HEADER[2]}`")))
    out = monthly_pivot_filled(typed, L.WORKS_HEADER[2], L.WORKS_HEADER[3], L.WORKS_HEADER[4], _UNITS,
                               WORKS_START, names=_UNIT_COLS, scale=2)
    validate_output(out, "works_monthly", min_rows=24, required=["date", _UNIT_COLS[0]], date_col="date",
                    recent_months=12, as_of="2002-01-01")
    return out
