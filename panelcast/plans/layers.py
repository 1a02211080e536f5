"""Medallion build: raw bronze copies, silver tables per source, the gold master table.

A bronze table is the landed source as it came, before any cleaning, all cells text; the
flows of landed sources read it back and clean from there.

Each silver table is validated before it is written; the gold build first
checks that every input table exists (reporting all missing ones at once),
reads them without the audit column, merges them on month, fills, validates
and writes gold. Writes are full refreshes, so a re-run after a failure is safe.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast import sinks as K
from panelcast.functions.scalars import parse_missing_marker, parse_yyyymm
from panelcast.operators.clean import rename_map, repeated_header_filter, variable_and_section_filter
from panelcast.operators.grid import promote_headers
from panelcast.operators.joins import left_merge_chain, require_tables
from panelcast.operators.monthly import monthly_pivot
from panelcast.operators.quality import validate_output
from panelcast.operators.windows import ffill_bfill
from panelcast.plans import panels as P
from panelcast.session import scratch_path

SILVER = ["orders_monthly", "shipments_by_flag", "shipment_prices", "revenue_by_priority", "order_counts"]


def build_silver(spark: SparkSession, sf_dir: str, as_of: str, base: str | None = None, layer: str = "silver") -> list[str]:
    """Validated silver tables in the database ``layer`` (one of its own for runs side by side)."""
    o, li = P.silver_sources(spark, sf_dir)
    qty, price, rev, cnt = P.features_from_silver(o, li)
    tables = dict(zip(SILVER, [o.select("series", "date", "revenue"), qty, price, rev, cnt]))
    base = base or scratch_path(spark, "silver")
    names = []
    for name, df in tables.items():
        validate_output(df, name, min_rows=12, required=[c for c in df.columns if c != "date"][:1],
                        date_col="date", recent_months=12, as_of=as_of)
        names.append(K.save_table(df, layer, name, path=f"{base}/{name}"))
    return names


def save_bronze(raw: DataFrame, table: str, layer: str = "bronze", base: str | None = None) -> DataFrame:
    """Store a landed source untouched, cells as text, and read it back."""
    spark = raw.sparkSession
    text = K.normalise_for_write(raw, string_cols=[c for c in raw.columns if c not in ("file", "row_idx")])
    K.save_table(text, layer, table, path=f"{base or scratch_path(spark, 'bronze')}/{table}")
    return K.read_table(spark, layer, table)


@dataclass
class SectorFlow:
    """Where a response by sectors has what: names of its columns as its header gives them."""
    code: str                       # region code; also the text of a repeated header row
    month: str                      # YYYYMM
    variable: str
    section: str
    value: str                      # numbers and missing-value markers
    keep_variable: str
    sections: list[str]
    names: list[str]                # of the section columns that come out


def build_sector_silver(responses: DataFrame, flow: SectorFlow, table: str, as_of: str, bronze: str = "bronze",
                        silver: str = "silver", base: str | None = None) -> DataFrame:
    """Landed responses to a monthly table with one column for each section: bronze copy,
    headers by name, one variable and its sections, markers to NULL, monthly pivot,
    validation, silver table. A section whose months are all markers sums to 0."""
    raw = save_bronze(responses, table, bronze, base)
    named = repeated_header_filter(promote_headers(raw), flow.code, flow.code)
    chosen = variable_and_section_filter(named, flow.variable, flow.keep_variable, flow.section, flow.sections)
    typed = chosen.select(F.col(f"`{flow.code}`").cast("int").alias("region_code"), parse_yyyymm(F.col(f"`{flow.month}`")).alias("date"),
                          F.col(f"`{flow.section}`").alias("section"), parse_missing_marker(F.col(f"`{flow.value}`")).alias("value"))
    out = monthly_pivot(typed, "date", "section", "value", flow.sections, keys=["region_code"], names=flow.names, scale=2)
    validate_output(out, table, min_rows=12, required=flow.names[:1], date_col="date", recent_months=12, as_of=as_of)
    spark = responses.sparkSession
    K.save_table(out, silver, table, path=f"{base or scratch_path(spark, 'silver')}/{table}")
    return K.read_table(spark, silver, table)


def build_gold(spark: SparkSession, as_of: str, base: str | None = None, layer: str = "gold", silver: str = "silver",
               rename: dict[str, str] | None = None) -> DataFrame:
    """The gold master table in the database ``layer`` from the tables of ``silver``; columns
    get their gold names by ``rename`` before validation."""
    require_tables(spark, [K.table_name(silver, t) for t in SILVER])
    anchor = K.read_table(spark, silver, "orders_monthly").withColumnRenamed("revenue", P.TARGET)
    feats = [K.read_table(spark, silver, t) for t in SILVER[1:]]
    gold = ffill_bfill(left_merge_chain(anchor, feats, keys=P.KEYS), P.FEATURE_COLS, keys=P.KEYS)
    gold = rename_map(gold, rename or {})
    target = (rename or {}).get(P.TARGET, P.TARGET)
    validate_output(gold, "master_panel", min_rows=60, required=["date", target], date_col="date",
                    recent_months=12, as_of=as_of)
    K.save_table(gold, layer, "master_panel", path=(base or scratch_path(spark, "gold")) + "/master_panel")
    return K.read_table(spark, layer, "master_panel")
