"""Decoding of landed spreadsheet grids.

A landed grid is ``(file, row_idx, col_0 … col_n STRING)``: one row per sheet
row, the sheet's own row order kept in ``row_idx``. Cells are exploded to
``(file, row_idx, col_idx, cell)`` and stay distributed; only the header
*positions* (two row numbers per file) and the header map (one row per column)
are small, and they are joined back by key rather than collected. Every window
is partitioned by ``file`` (one sheet per group, bounded by the sheet size).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.scalars import clean_year, make_month, month_name_to_number, numeric_coerce, trim_text
from panelcast.session import cut_lineage

FILE = "file"


def grid_columns(grid: DataFrame) -> list[str]:
    return [c for c in grid.columns if c.startswith("col_")]


def cells(grid: DataFrame, first: int = 0) -> DataFrame:
    """Long cells ``(file, row_idx, col_idx, cell)`` for columns ``col_first…``."""
    cols = [c for c in grid_columns(grid) if int(c.split("_")[1]) >= first]
    long = grid.unpivot([FILE, "row_idx"], cols, "_name", "cell")
    return long.select(FILE, "row_idx", F.split("_name", "_").getItem(1).cast("int").alias("col_idx"), "cell")


def _contains_all(c: Column, words: list[str]) -> Column:
    low = F.lower(c)
    return reduce(lambda a, b: a & b, [low.contains(w) for w in words])


def grid_header_locate(grid: DataFrame, spec_words: list[str], month_word: str = "jan") -> DataFrame:
    """Per file: the month-header row and the spec-header row.

    Month row = first row whose col_1 contains ``month_word`` and that is not a
    spec row; spec row = last spec row before it, else the first one after it.
    Files where either is missing are reported with a NULL (callers raise)."""
    spec = _contains_all(F.col("col_0"), spec_words)
    month = F.lower(F.col("col_1")).contains(month_word) & ~F.coalesce(spec, F.lit(False))
    g = grid.select(FILE, "row_idx", F.coalesce(spec, F.lit(False)).alias("_spec"),
                    F.coalesce(month, F.lit(False)).alias("_month"))
    m = g.groupBy(FILE).agg(F.min(F.when(F.col("_month"), F.col("row_idx"))).alias("month_row"))
    s = g.join(m, FILE).groupBy(FILE, "month_row").agg(
        F.max(F.when(F.col("_spec") & (F.col("row_idx") < F.col("month_row")), F.col("row_idx"))).alias("_before"),
        F.min(F.when(F.col("_spec") & (F.col("row_idx") > F.col("month_row")), F.col("row_idx"))).alias("_after"))
    return s.select(FILE, "month_row", F.coalesce("_before", "_after").alias("spec_row"))


def require_headers(located: DataFrame) -> None:
    """Raise when a file has no month or spec header (a few rows reach the driver)."""
    bad = located.filter(F.col("month_row").isNull() | F.col("spec_row").isNull()).select(FILE).limit(20).collect()
    if bad:
        raise ValueError(f"header rows not found in: {[r[FILE] for r in bad]}")


def header_ffill(header_cells: DataFrame, value: str = "cell", out: str = "year_cell") -> DataFrame:
    """Carry a merged header cell to the right (last non-NULL over col_idx, per file)."""
    w = Window.partitionBy(FILE).orderBy("col_idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return header_cells.withColumn(out, F.last(F.col(value), ignorenulls=True).over(w))


def header_map(grid: DataFrame, located: DataFrame) -> DataFrame:
    """``(file, col_idx, date)`` for every data column whose year and month parse."""
    c = cells(grid, first=1)
    years = c.join(located.select(FILE, F.col("spec_row").alias("row_idx")), [FILE, "row_idx"]) \
             .select(FILE, "col_idx", "cell")
    years = header_ffill(years).select(FILE, "col_idx", clean_year("year_cell").alias("year"))
    months = c.join(located.select(FILE, F.col("month_row").alias("row_idx")), [FILE, "row_idx"]) \
              .select(FILE, "col_idx", month_name_to_number("cell").alias("month"))
    hm = years.join(months, [FILE, "col_idx"]).filter(F.col("year").isNotNull() & F.col("month").isNotNull())
    return hm.select(FILE, "col_idx", make_month("year", "month").alias("date"))


def category_ffill(rows: DataFrame, label: str, keywords: list[str], default: str,
                   order: str = "row_idx", out: str = "category") -> DataFrame:
    """Running section label: a row whose text contains a keyword starts a section
    (its trimmed text is the label); other rows carry the last one; before any
    section the default applies."""
    hit = reduce(lambda a, b: a | b, [F.col(label).contains(k) for k in keywords])
    w = Window.partitionBy(FILE).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn(out, F.coalesce(
        F.last(F.when(hit, trim_text(F.col(label))), ignorenulls=True).over(w), F.lit(default)))


def hierarchical_grid_to_long(grid: DataFrame, spec_words: list[str], keywords: list[str],
                              default: str, month_word: str = "jan", check: bool = True) -> DataFrame:
    """Whole-sheet decode to ``(file, category, spec, date, value)``.

    Rows after the month header with a non-NULL label are data rows; rows whose
    dated cells are all NULL are dropped; values are coerced (text -> NULL)."""
    located = grid_header_locate(grid, spec_words, month_word)
    if check:
        require_headers(located)
    hm = header_map(grid, located)
    rows = grid.join(located.select(FILE, "month_row"), FILE) \
               .filter((F.col("row_idx") > F.col("month_row")) & F.col("col_0").isNotNull()) \
               .select(FILE, "row_idx", F.col("col_0").alias("label"))
    rows = category_ffill(rows, "label", keywords, default)
    data = cells(grid, first=1).join(hm, [FILE, "col_idx"]).join(rows, [FILE, "row_idx"])
    keep = data.groupBy(FILE, "row_idx").agg(F.count("cell").alias("_n")).filter(F.col("_n") > 0)
    data = data.join(keep.select(FILE, "row_idx"), [FILE, "row_idx"], "left_semi")
    return data.select(FILE, "category", trim_text("label").alias("spec"), "date",
                       numeric_coerce("cell").alias("value"))


# ---------------------------------------------------------------- plain headers

def promote_header(grid: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The first row (lowest ``file``, ``row_idx``) supplies the column names and
    is dropped; header rows that other concatenated files embed are left for
    ``repeated_header_filter``."""
    first = grid.orderBy(FILE, "row_idx").limit(1).collect()
    if not first:
        raise ValueError("empty landed grid")
    cols = grid_columns(grid)
    names = [first[0][c] for c in cols]
    keep = list(keep or [])
    is_first = (F.col(FILE) == F.lit(first[0][FILE])) & (F.col("row_idx") == F.lit(first[0]["row_idx"]))
    return grid.filter(~is_first).select(
        *keep, *[F.col(c).alias(str(n)) for c, n in zip(cols, names) if n is not None])


def promote_headers(grid: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Every file's own first row names its columns: (keep, names).

    The columns are those any file has, in the order they first come; a file's cell goes
    under its own name wherever the file has it, and a file without a name has NULL there.
    Header rows are dropped, columns without a name too. A file that names two columns
    alike is an error. One header row for each file; only names reach the driver."""
    cols, keep = grid_columns(grid), list(keep or [])
    line = F.array(*[F.col(c) for c in cols])
    heads = cut_lineage(grid.groupBy(FILE).agg(F.min("row_idx").alias("_head"), F.min_by(line, "row_idx").alias("_names")))
    pairs = heads.select(FILE, F.posexplode("_names").alias("at", "name")).filter(F.col("name").isNotNull())
    twice = pairs.groupBy(FILE, "name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").first()
    if twice:
        raise ValueError(f"{twice[FILE]}: two columns named {twice['name']}")
    names = [r["name"] for r in pairs.groupBy("name").agg(F.min(F.struct(F.col(FILE), F.col("at"))).alias("first")).orderBy("first").collect()]
    if not names:
        raise ValueError("empty landed grid")
    places = pairs.groupBy(FILE).agg(F.map_from_entries(F.collect_list(F.struct("name", "at"))).alias("_at"))
    body = grid.withColumn("_line", line).join(heads.select(FILE, "_head"), FILE).filter(F.col("row_idx") > F.col("_head")).join(places, FILE)
    return body.select(*keep, *[F.get("_line", F.try_element_at("_at", F.lit(n))).alias(n) for n in names])


def block_header_map(grid: DataFrame, header_idx: int, variables: list[str],
                     first_name: str = "Date") -> DataFrame:
    """``(file, col_idx, name)`` of a two-level merged header, for every file by itself.

    Column 0 is ``first_name``. A block opens at a cell with text and covers one column
    for each variable, named by their position in the sheet. ``name`` is NULL for a
    column before the first block, or beyond a block with text in the row below;
    blank columns beyond a block are left out (sheets can differ in width)."""
    at = F.col("row_idx") - F.lit(header_idx)
    head = cells(grid.filter(at.between(0, 1))).groupBy(FILE, "col_idx").agg(
        F.max(F.when(at == 0, F.nullif(trim_text("cell"), F.lit("")))).alias("_top"),
        F.max(F.when(at == 1, F.nullif(trim_text("cell"), F.lit("")))).alias("_below"))
    block = F.when((F.col("col_idx") > 0) & F.col("_top").isNotNull(),
                   F.struct(F.col("_top").alias("text"), F.col("col_idx").alias("from")))
    opened = header_ffill(head.withColumn("_block", block), "_block", "_block")
    n = len(variables)
    covered = F.col("col_idx") - F.col("_block.from") < n
    variable = F.get(F.array(*[F.lit(v) for v in variables]), F.pmod(F.col("col_idx") - 1, F.lit(n)))
    named = F.when(F.col("col_idx") == 0, F.lit(first_name)).when(covered, F.concat_ws("_", "_block.text", variable))
    blank = (F.col("col_idx") > 0) & F.col("_block").isNotNull() & ~covered & F.col("_below").isNull()
    return opened.filter(~F.coalesce(blank, F.lit(False))).select(FILE, "col_idx", named.alias("name"))


def block_header_rename(grid: DataFrame, header_idx: int, variables: list[str],
                        first_name: str = "Date") -> DataFrame:
    """Rows below a two-level header under ``Block_Variable`` names.

    Every file is read by its own header; a file without one of the names has NULL
    there. The residual header row after the merged one is dropped. Only distinct
    column names reach the driver. A file with a column that no block names, or with
    the same block twice, is an error."""
    header = cut_lineage(block_header_map(grid, header_idx, variables, first_name))
    per_name = header.groupBy(FILE, "name").agg(F.count(F.lit(1)).alias("n"), F.min("col_idx").alias("at"))
    bad = per_name.filter(F.col("name").isNull() | (F.col("n") > 1)).limit(1).collect()
    if bad:
        raise ValueError(f"{bad[0][FILE]}: " + ("no block name for a column"
                         if bad[0]["name"] is None else f"two columns named {bad[0]['name']}"))
    order = per_name.groupBy("name").agg(F.min("at").alias("at")).orderBy("at", "name").collect()
    if not order:
        raise ValueError(f"no row {header_idx} in the landed grid")
    places = header.groupBy(FILE).agg(F.map_from_entries(F.collect_list(F.struct("name", "col_idx"))).alias("_at"))
    line = F.array(*[F.col(c) for c in grid_columns(grid)])
    body = grid.filter(F.col("row_idx") > header_idx + 1).withColumn("_line", line).join(places, FILE)
    return body.select(FILE, "row_idx", *[F.get("_line", F.try_element_at("_at", F.lit(r["name"]))).alias(r["name"])
                                          for r in order])


def skip_rows(grid: DataFrame, n: int) -> DataFrame:
    """Data rows of a sheet read with n skipped rows: the header (row n) and the
    residual header row after it (row n + 1) are not data."""
    return grid.filter(F.col("row_idx") > n + 1)
