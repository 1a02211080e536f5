"""Land driver-table data in the raw shapes the original sources deliver.

The reference ingests spreadsheets and API responses; here those raw shapes are
*derived from the driver tables by Spark* and written to the shared scratch
folder, so the decoders are exercised on data whose size grows with the tables:

- a performance sheet: merged year header, two-line month header, category and
  spec rows, an empty row, a text cell in a numeric column;
- a vehicles sheet: junk rows, a merged two-level block header, a residual row;
- per-region responses: a header row of labels inside every region file, with
  missing-value markers in the value column;
- a Latin-1 CSV with accented header names, and dated snapshot folders.

Only bounded layout facts reach the driver (the first and last month, i.e. the
number of sheet columns).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.functions.scalars import MONTH_ABBREVIATIONS, to_month
from panelcast.session import cut_lineage, scratch_path

# --- fixed values: header texts of the landed layouts ---------------------------
SPEC_HEADER = "Especificação / Specification"
SPEC_WORDS = ["especifica", "specification"]
NO_CATEGORY = "Sem Categoria"
SHEET_TITLE = "Monthly order book"
MEMO_LABEL = "Memo: all orders"
JUNK_CELL = "n/d"
REGION_LABELS = ["Nível Territorial (Código)", "Nível Territorial", "Unidade de Medida (Código)",
                 "Unidade de Medida", "Valor", "Mês (Código)", "Mês", "Variável", "Seção"]
# ---------------------------------------------------------------------------------


def status_label(c) -> F.Column:
    return F.concat(F.lit("Status "), c, F.lit(" (total)"))


def _month_bounds(df: DataFrame, month: str):
    r = df.agg(F.min(month).alias("lo"), F.max(month).alias("hi")).collect()[0]
    return r["lo"], r["hi"]


def month_header_cell(month_col: str) -> F.Column:
    pt = F.element_at(F.lit(MONTH_ABBREVIATIONS), F.month(month_col))
    return F.concat(F.initcap(pt), F.lit("\n"), F.date_format(month_col, "MMM"))


def _wide(cells: DataFrame, n_cols: int) -> DataFrame:
    """(row_idx, col_idx, text) -> row_idx, col_0 … col_{n-1} (one pivot, explicit values)."""
    out = cells.groupBy("row_idx").pivot("col_idx", list(range(n_cols))).agg(F.first("text"))
    return out.select("row_idx", *[F.col(str(i)).alias(f"col_{i}") for i in range(n_cols)])


def _write_sheet(sheet: DataFrame, path: str) -> str:
    # a sheet is one file (bounded by the sheet layout), like the xls it stands for
    sheet.coalesce(1).sortWithinPartitions("row_idx").write.mode("overwrite").option("header", False).csv(path)
    return path


def performance_cells(orders: DataFrame) -> tuple[DataFrame, int]:
    """Cells of the performance sheet built from order revenue by status and priority."""
    # one scan of the facts: status x priority x month totals (exact cents), checkpointed;
    # the coarser rows of the sheet are sums of these
    o = cut_lineage(
        orders.filter(F.col("o_orderdate").isNotNull())
        .groupBy("o_orderstatus", "o_orderpriority", to_month("o_orderdate").alias("month"))
        .agg(F.round(F.sum("o_totalprice"), 2).alias("o_totalprice")))
    lo, hi = _month_bounds(o, "month")
    n_months = (hi.year - lo.year) * 12 + hi.month - lo.month + 1
    col_idx = (F.months_between("month", F.lit(lo)).cast("int") + 1).alias("col_idx")

    def sums(keys, label, kind):
        g = o.groupBy(*keys, "month").agg(F.round(F.sum("o_totalprice"), 2).alias("v"))
        return g.select(label.alias("label"), F.lit(kind).alias("kind"),
                        (F.col("o_orderstatus") if "o_orderstatus" in keys else F.lit("")).alias("grp"),
                        (F.col("o_orderpriority") if "o_orderpriority" in keys else F.lit("")).alias("sub"),
                        "month", "v")

    vals = (sums([], F.lit(MEMO_LABEL), 0)
            .unionByName(sums(["o_orderstatus"], status_label(F.col("o_orderstatus")), 1))
            .unionByName(sums(["o_orderstatus", "o_orderpriority"], F.col("o_orderpriority"), 2)))
    # row layout: the memo row, then per status its total row, its spec rows and an empty row
    keys = vals.select("label", "kind", "grp", "sub").distinct()
    blanks = keys.filter(F.col("kind") == 1).select(F.lit(None).cast("string").alias("label"),
                                                     F.lit(3).alias("kind"), "grp", F.lit("").alias("sub"))
    layout = keys.unionByName(blanks)
    # the layout has one row per (status, priority): bounded by category domains
    order = Window.orderBy(F.when(F.col("kind") == 0, 0).otherwise(1), "grp", "kind", "sub")
    layout = layout.withColumn("row_idx", F.row_number().over(order) + F.lit(2))
    first = F.to_date(F.lit(lo))
    text = F.when((F.col("kind") == 0) & (F.col("month") == first), F.lit(JUNK_CELL)) \
            .otherwise(F.format_string("%.2f", F.col("v")))
    body = vals.join(layout.drop("label"), ["kind", "grp", "sub"]).select("row_idx", col_idx, text.alias("text"))
    labels = layout.select("row_idx", F.lit(0).alias("col_idx"), F.col("label").alias("text"))
    cal = o.sparkSession.range(n_months).select(
        (F.col("id") + 1).cast("int").alias("col_idx"),
        F.add_months(first, F.col("id").cast("int")).alias("month"))
    years = cal.select(F.lit(1).alias("row_idx"), "col_idx",
                       F.when((F.month("month") == 1) | (F.col("col_idx") == 1),
                              F.format_string("%d.0", F.year("month"))).alias("text"))
    months = cal.select(F.lit(2).alias("row_idx"), "col_idx", month_header_cell("month").alias("text"))
    spark = o.sparkSession
    heads = spark.createDataFrame([(0, 0, SHEET_TITLE), (1, 0, SPEC_HEADER), (2, 0, None)],
                                  "row_idx int, col_idx int, text string")
    allc = heads.unionByName(years).unionByName(months).unionByName(labels).unionByName(body)
    return allc, n_months + 1


def land_performance_sheet(spark: SparkSession, orders: DataFrame) -> tuple[str, int]:
    cells, n_cols = performance_cells(orders)
    path = scratch_path(spark, "performance") + "/performance_sheet"
    return _write_sheet(_wide(cells, n_cols), path), n_cols


# ---------------------------------------------------------------- vehicles sheet
VEHICLE_VARIABLES = ["F", "O"]


def land_vehicle_sheet(spark: SparkSession, lineitem: DataFrame, flags: list[str]) -> tuple[str, int]:
    """Shipped quantity per month: one block per return flag, one column per line status.

    Rows 0-2 are junk, row 3 holds block names on the first column of each
    block only, row 4 repeats the variable names, data starts at row 5. A pair of
    flag and status that isn't listed, a null one too, fails the query."""
    li = lineitem.filter(F.col("l_shipdate").isNotNull()).select(
        to_month("l_shipdate").alias("month"), "l_returnflag", "l_linestatus", "l_quantity")
    g = li.groupBy("month", "l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("v"))
    pos = {(f, s): 1 + i * len(VEHICLE_VARIABLES) + j
           for i, f in enumerate(flags) for j, s in enumerate(VEHICLE_VARIABLES)}
    n_cols = 1 + len(pos)
    col_idx = F.create_map(*[x for (f, s), c in pos.items()
                             for x in (F.lit(f"{f}|{s}"), F.lit(c))])
    # a total without a column fails the landing instead of vanishing from the sheet
    pair = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("NULL")) for c in ("l_returnflag", "l_linestatus")])
    unlisted = F.raise_error(F.concat(F.lit("vehicle sheet: block or variable not listed: "), pair)).cast("int")
    body = g.select("month", F.coalesce(F.element_at(col_idx, pair), unlisted).alias("col_idx"),
                    F.format_string("%.2f", "v").alias("text"))
    months = g.select("month").distinct()
    rows = months.withColumn("row_idx", F.row_number().over(Window.orderBy("month")) + F.lit(4))
    body = body.join(rows, "month").select("row_idx", "col_idx", "text")
    dates = rows.select("row_idx", F.lit(0).alias("col_idx"), F.date_format("month", "yyyy-MM-dd").alias("text"))
    head = [(0, 0, "Vehicle production"), (1, 0, "(units)"), (2, 0, None), (3, 0, None), (4, 0, None)]
    for (f, s), c in pos.items():
        head.append((3, c, f if s == VEHICLE_VARIABLES[0] else None))
        head.append((4, c, s))
    heads = spark.createDataFrame(head, "row_idx int, col_idx int, text string")
    path = scratch_path(spark, "vehicles") + "/vehicle_sheet"
    return _write_sheet(_wide(heads.unionByName(dates).unionByName(body), n_cols), path), n_cols


# ------------------------------------------------------------- region responses
def region_response_rows(orders: DataFrame, customer: DataFrame, nation: DataFrame,
                         region: DataFrame) -> DataFrame:
    """Per region: label header row (row 0) + one row per month, variable and section.

    Value markers by rule: section P reports '-' in January and '...' in December."""
    geo = F.broadcast(nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
                      .select("n_nationkey", "r_regionkey", "r_name"))
    # pre-aggregate orders to customer-month before the customer join
    om = (orders.filter(F.col("o_orderdate").isNotNull())
          .groupBy("o_custkey", "o_orderstatus", to_month("o_orderdate").alias("month"))
          .agg(F.sum("o_totalprice").alias("rev"), F.count(F.lit(1)).alias("cnt")))
    cm = om.join(customer.select("c_custkey", "c_nationkey"), om.o_custkey == customer.c_custkey) \
           .join(geo, F.col("c_nationkey") == geo.n_nationkey)
    agg = cm.groupBy("r_regionkey", "r_name", "o_orderstatus", "month").agg(
        F.round(F.sum("rev"), 2).alias("revenue"), F.sum("cnt").cast("double").alias("orders"))
    long = agg.unpivot(["r_regionkey", "r_name", "o_orderstatus", "month"], ["revenue", "orders"],
                       "variable", "v")
    p = F.col("o_orderstatus") == "P"
    text = (F.when(p & (F.month("month") == 1), F.lit("-"))
            .when(p & (F.month("month") == 12), F.lit("..."))
            .otherwise(F.format_string("%.2f", "v")))
    w = Window.partitionBy("r_regionkey").orderBy("month", "variable", "o_orderstatus")
    data = long.select(
        "r_regionkey", F.row_number().over(w).alias("row_idx"),
        F.col("r_regionkey").cast("string").alias("col_0"), F.col("r_name").alias("col_1"),
        F.lit("40").alias("col_2"), F.lit("BRL").alias("col_3"), text.alias("col_4"),
        F.date_format("month", "yyyyMM").alias("col_5"), F.date_format("month", "MMMM yyyy").alias("col_6"),
        F.col("variable").alias("col_7"), F.col("o_orderstatus").alias("col_8"))
    heads = region.select("r_regionkey", F.lit(0).alias("row_idx"),
                          *[F.lit(t).alias(f"col_{i}") for i, t in enumerate(REGION_LABELS)])
    return heads.unionByName(data)


def land_region_responses(spark: SparkSession, rows: DataFrame) -> tuple[list[str], int]:
    """One folder per region (``region=<key>``); returns the folders and the column count."""
    base = scratch_path(spark, "regions")
    rows.repartition("r_regionkey").sortWithinPartitions("r_regionkey", "row_idx") \
        .write.mode("overwrite").partitionBy("r_regionkey").option("header", False).csv(base)
    return [f"{base}/r_regionkey=*"], len(REGION_LABELS)


# ---------------------------------------------------------------- plain files
# fixed values: accented header of the landed customer file
ENCODED_NAMES = ["Código", "Nome do cliente", "País (código)", "Saldo (R$)", "Segmento de mercado"]


def land_encoded_csv(spark: SparkSession, customer: DataFrame) -> str:
    path = scratch_path(spark, "encoded") + "/customers_latin1"
    out = customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment").toDF(*ENCODED_NAMES)
    out.write.mode("overwrite").option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return path


def land_snapshots(spark: SparkSession, orders: DataFrame) -> str:
    """Orders landed as one folder per order year: ``orders_<year>``."""
    base = scratch_path(spark, "snapshots")
    o = orders.withColumn("snapshot", F.concat(F.lit("orders_"), F.year("o_orderdate").cast("string")))
    # each task writes its rows year by year (one open file at a time per task)
    o.sortWithinPartitions("snapshot").write.mode("overwrite").partitionBy("snapshot").parquet(base)
    return base


# ------------------------------------------------------------ works register
# --- fixed values: header of the landed register (Latin-1 CSV), in file order ---
WORKS_HEADER = ["Nome do pais", "Estado", "Data de início", "Unidade de medida", "Área total", "Situação"]
# ---------------------------------------------------------------------------------


def land_works_register(spark: SparkSession, orders: DataFrame, customer: DataFrame,
                        nation: DataFrame, region: DataFrame) -> str:
    """A register of dated records with country, state, unit and area, in Latin-1.

    Built from orders (date, priority as unit, price as area, status) and the
    customer's nation/region; one nation's records arrive without a state."""
    geo = F.broadcast(nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
                      .select("n_nationkey", "n_name", "r_name"))
    cust = customer.select("c_custkey", "c_nationkey").join(geo, F.col("c_nationkey") == geo.n_nationkey)
    rows = orders.join(cust, orders.o_custkey == cust.c_custkey).select(
        F.col("r_name"), F.nullif(F.col("n_name"), F.lit("CANADA")), F.col("o_orderdate").cast("date"),
        F.col("o_orderpriority"), F.col("o_totalprice"), F.col("o_orderstatus")).toDF(*WORKS_HEADER)
    path = scratch_path(spark, "works") + "/register_latin1"
    rows.write.mode("overwrite").option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return path
