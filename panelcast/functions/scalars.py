"""Scalar column functions.

All of them build JVM-side expressions, so they stay inside whole-stage
codegen. Strict parses (``parse_yyyymm``, ``parse_missing_marker``) raise under
ANSI mode on bad text, like the original parsers; lenient ones use ``try_*``.
"""

from __future__ import annotations

import math
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "MONTH_ABBREVIATIONS", "MISSING_MARKERS",
    "col_of", "parse_yyyymm", "parse_missing_marker", "numeric_coerce",
    "to_month", "to_date", "trim_text", "month_name_to_number", "clean_year",
    "make_month", "month_sin", "month_cos", "month_offset", "format_year_month",
    "round_half_up", "round_half_even", "human_scale", "contains_int",
    "startswith_int", "suffix_after_last_underscore", "nan_to_null",
]

# --- fixed values (must equal the source data conventions) -------------------
# Portuguese month abbreviations, January .. December.
MONTH_ABBREVIATIONS = ["jan", "fev", "mar", "abr", "mai", "jun",
                       "jul", "ago", "set", "out", "nov", "dez"]
# Text markers that stand for a missing value in the statistics tables.
MISSING_MARKERS = ["-", "..."]
# -----------------------------------------------------------------------------


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_yyyymm(c: str | Column) -> Column:
    """'202301' -> DATE 2023-01-01; malformed text raises (ANSI)."""
    return F.to_date(col_of(c), "yyyyMM")


def parse_missing_marker(c: str | Column) -> Column:
    """'-' / '...' -> NULL, anything else must parse as a number (raises otherwise)."""
    x = col_of(c)
    return F.when(x.isin(*MISSING_MARKERS), F.lit(None).cast("double")).otherwise(x.cast("double"))


def numeric_coerce(c: str | Column) -> Column:
    """To DOUBLE, failures -> NULL; NaN is normalised to NULL."""
    return nan_to_null(col_of(c).try_cast("double"))


def nan_to_null(c: str | Column) -> Column:
    x = col_of(c)
    return F.when(~F.isnan(x), x)


def to_month(c: str | Column) -> Column:
    """First day of the month as DATE (``trunc`` keeps the DATE type)."""
    return F.trunc(F.to_date(col_of(c)), "MM")


def to_date(c: str | Column) -> Column:
    return F.to_date(col_of(c))


def trim_text(c: str | Column) -> Column:
    """Without white space at both ends: blanks, tabs, line breaks, no-break spaces."""
    return F.regexp_replace(col_of(c), r"^[\s\u00a0]+|[\s\u00a0]+$", "")


def month_name_to_number(c: str | Column) -> Column:
    """First line of the cell, lower-cased and trimmed, as a month number 1..12."""
    first_line = trim_text(F.lower(F.split(col_of(c), "\n").getItem(0)))
    mapping = F.create_map(*chain.from_iterable(
        (F.lit(name), F.lit(i + 1)) for i, name in enumerate(MONTH_ABBREVIATIONS)))
    return F.try_element_at(mapping, first_line)


def clean_year(c: str | Column) -> Column:
    """'2024.0' -> 2024 (INT); anything that is not all digits after the strip -> NULL."""
    s = F.regexp_replace(F.trim(col_of(c).cast("string")), r"\.0", "")
    return F.when(s.rlike(r"^[0-9]+$"), s.try_cast("int"))


def make_month(year: str | Column, month: str | Column) -> Column:
    return F.make_date(col_of(year), col_of(month), F.lit(1))


def month_sin(date: str | Column) -> Column:
    return F.sin(F.lit(2 * math.pi) * F.month(col_of(date)) / F.lit(12.0))


def month_cos(date: str | Column) -> Column:
    return F.cos(F.lit(2 * math.pi) * F.month(col_of(date)) / F.lit(12.0))


def month_offset(date: str | Column, months: int | str | Column) -> Column:
    m = F.lit(months) if isinstance(months, int) else col_of(months)
    return F.add_months(col_of(date), m)


def format_year_month(date: str | Column) -> Column:
    return F.date_format(col_of(date), "yyyy-MM")


def round_half_up(c: str | Column, digits: int) -> Column:
    return F.round(col_of(c), digits)


def round_half_even(c: str | Column, digits: int) -> Column:
    """numpy's rounding (banker's)."""
    return F.bround(col_of(c), digits)


def human_scale(c: str | Column) -> Column:
    """1234 -> '1.2k', millions 'M', billions 'B'; below 1000 the integer part."""
    x = col_of(c).cast("double")
    return (F.when(x >= 1e9, F.format_string("%.1fB", x * 1e-9))
            .when(x >= 1e6, F.format_string("%.1fM", x * 1e-6))
            .when(x >= 1e3, F.format_string("%.1fk", x * 1e-3))
            .otherwise(x.cast("bigint").cast("string")))


def contains_int(c: str | Column, text: str) -> Column:
    return col_of(c).contains(text).cast("int")


def startswith_int(c: str | Column, prefix: str) -> Column:
    return col_of(c).startswith(prefix).cast("int")


def suffix_after_last_underscore(c: str | Column) -> Column:
    return F.element_at(F.split(col_of(c), "_"), -1)
