"""Projections, filters and predicates (cleaning steps of the silver layer).

Each operator is a thin, lazy DataFrame transformation; Catalyst pushes the
filters and the column pruning into the parquet scan.
"""

from __future__ import annotations

import logging
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

log = logging.getLogger(__name__)


def select_existing(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Keep the wanted columns that exist (in wanted order); warn about the rest."""
    have = set(df.columns)
    keep = [c for c in wanted if c in have]
    missing = [c for c in wanted if c not in have]
    if missing:
        log.warning("columns not found, skipped: %s", missing)
    return df.select(*[F.col(f"`{c}`") for c in keep])


def geo_filter(df: DataFrame, country_col: str, country: str,
               state_col: str, exclude_state: str, drop_country: bool = True) -> DataFrame:
    """``country = X`` and ``state <> Y`` where a NULL state is kept."""
    out = df.filter(F.col(f"`{country_col}`") == F.lit(country)) \
            .filter(~F.col(f"`{state_col}`").eqNullSafe(F.lit(exclude_state)))
    return out.drop(country_col) if drop_country else out


def date_open_filter(df: DataFrame, col: str, start, end=None, closed_start: bool = False) -> DataFrame:
    """``start < col < end`` (both ends open, end optional); ``closed_start`` gives ``>=``."""
    c = F.col(f"`{col}`")
    cond = (c >= F.lit(start)) if closed_start else (c > F.lit(start))
    if end is not None:
        cond = cond & (c < F.lit(end))
    return df.filter(cond)


def variable_and_section_filter(df: DataFrame, variable_col: str, variable: str,
                                section_col: str, sections: list[str]) -> DataFrame:
    return df.filter((F.col(f"`{variable_col}`") == F.lit(variable))
                     & F.col(f"`{section_col}`").isin(*sections))


def variable_filter(df: DataFrame, variable_col: str, variable: str) -> DataFrame:
    return df.filter(F.col(f"`{variable_col}`") == F.lit(variable))


def repeated_header_filter(df: DataFrame, col: str, header_text: str) -> DataFrame:
    """Drop header rows that a per-region concatenation embedded in the data.

    A NULL cell is kept (it is not a header row)."""
    return df.filter(~F.col(f"`{col}`").eqNullSafe(F.lit(header_text)))


def target_select(df: DataFrame, conditions: dict[str, str], date_col: str,
                  value_col: str, date_alias: str = "date", value_alias: str = "target",
                  keys: list[str] | None = None) -> DataFrame:
    """Two-key (or n-key) equality filter then ``(keys, date, target)``."""
    cond = reduce(lambda a, b: a & b,
                  [F.col(f"`{k}`") == F.lit(v) for k, v in conditions.items()])
    keys = keys or []
    return df.filter(cond).select(*[F.col(f"`{k}`") for k in keys],
                                  F.col(f"`{date_col}`").alias(date_alias),
                                  F.col(f"`{value_col}`").alias(value_alias))


def rename_map(df: DataFrame, mapping: dict[str, str], strict: bool = False) -> DataFrame:
    """Rename by dictionary; absent keys are ignored unless ``strict``."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    if strict and len(present) != len(mapping):
        raise ValueError(f"columns to rename not found: {sorted(set(mapping) - set(present))}")
    return df.withColumnsRenamed(present) if present else df


def drop_if_present(df: DataFrame, names: list[str]) -> DataFrame:
    names = [n for n in names if n in df.columns]
    return df.drop(*names) if names else df


def select_by_name_match(df: DataFrame, text: str, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns plus every column whose name contains ``text``; error if none."""
    hits = [c for c in df.columns if text in c and c not in (keep or [])]
    if not hits:
        raise ValueError(f"no column name contains {text!r}")
    return df.select(*[F.col(f"`{c}`") for c in (keep or []) + hits])


def row_sum_expr(cols: list[str]) -> Column:
    """Row-wise sum where NULL counts as 0 (all NULL -> 0)."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(f"`{c}`"), F.lit(0.0)) for c in cols])


def row_sum_skip_null(df: DataFrame, cols: list[str], out: str) -> DataFrame:
    return df.withColumn(out, row_sum_expr(cols))


def numeric_columns(df: DataFrame, exclude: list[str] | None = None) -> list[str]:
    """Names of numeric columns (schema only, nothing is computed)."""
    ex = set(exclude or [])
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in ex]


def fill_constant(df: DataFrame, value=0, subset: list[str] | None = None) -> DataFrame:
    return df.fillna(value, subset=subset) if subset else df.fillna(value)


def drop_any_null(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=subset)


def drop_null_key(df: DataFrame, key: str | list[str]) -> DataFrame:
    return df.dropna(how="any", subset=[key] if isinstance(key, str) else key)


def drop_all_null(df: DataFrame, subset: list[str]) -> DataFrame:
    return df.dropna(how="all", subset=subset)


def literal_tag(df: DataFrame, **tags) -> DataFrame:
    """Attach constant columns (e.g. a split label)."""
    return df.withColumns({k: F.lit(v) for k, v in tags.items()})


def snake_case(name: str) -> str:
    s = re.sub(r"[^0-9a-zA-Z]+", "_", name).strip("_").lower()
    return s or "col"
