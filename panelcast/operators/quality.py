"""Output validation before a write: one aggregate pass, every failure reported."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def validation_report(df: DataFrame, min_rows: int = 12, required: list[str] | None = None,
                      date_col: str | None = "date", recent_months: int = 6, as_of=None) -> DataFrame:
    """Rows ``(check, col, passed)``: minimum rows, required columns present and not
    all NULL, newest date no older than ``recent_months`` before ``as_of``.

    ``as_of`` is a parameter (not ``now()``), so the report is reproducible."""
    required = list(required or [])
    present = [c for c in required if c in df.columns]
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.count(F.col(f"`{c}`")).alias(f"_c{i}") for i, c in enumerate(present)]
    has_date = bool(date_col) and date_col in df.columns and as_of is not None
    if has_date:
        aggs.append(F.max(F.to_date(F.col(date_col))).alias("_newest"))
    one = df.agg(*aggs)
    checks = [F.struct(F.lit("min_rows").alias("check"), F.lit(None).cast("string").alias("col"),
                       (F.col("_n") >= F.lit(min_rows)).alias("passed"))]
    for c in required:
        if c in present:
            i = present.index(c)
            checks.append(F.struct(F.lit("not_all_null").alias("check"), F.lit(c).alias("col"),
                                   (F.col(f"_c{i}") > 0).alias("passed")))
        else:
            checks.append(F.struct(F.lit("present").alias("check"), F.lit(c).alias("col"),
                                   F.lit(False).alias("passed")))
    if has_date:
        limit = F.add_months(F.to_date(F.lit(as_of)), -recent_months)
        checks.append(F.struct(F.lit("recent").alias("check"), F.lit(date_col).alias("col"),
                               F.coalesce(F.col("_newest") >= limit, F.lit(False)).alias("passed")))
    return one.select(F.inline(F.array(*checks)))


def validate_output(df: DataFrame, name: str, **kw) -> DataFrame:
    """Raise with every failed check at once; return the report when all pass."""
    report = validation_report(df, **kw)
    failed = report.filter(~F.col("passed")).collect()
    if failed:
        detail = "; ".join(f"{r['check']}({r['col'] or ''})" for r in failed)
        raise ValueError(f"[{name}] validation failed: {detail}")
    return report
