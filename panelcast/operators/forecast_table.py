"""Forecast tables: frozen last observations, horizon rows and error bands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.scalars import format_year_month


def freeze_last_row(df: DataFrame, cols: list[str], keys: list[str], date: str = "date") -> DataFrame:
    """Last observed value of each column per series (the row with the latest date)."""
    last = F.max_by(F.struct(*[F.col(c) for c in cols]), F.col(date))
    return (df.groupBy(*keys).agg(F.max(date).alias("last_date"), last.alias("_l"))
              .select(*keys, "last_date", *[F.col(f"_l.{c}").alias(c) for c in cols]))


def horizon_rows(last: DataFrame, horizon: int, date: str = "last_date") -> DataFrame:
    """One row per series and step h = 1..H with the future month."""
    return (last.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
                .withColumn("date", F.add_months(F.col(date), F.col("h"))))


def error_band(forecast: DataFrame, mae: DataFrame | float, keys: list[str] | None = None,
               prediction: str = "prediction", digits: int = 1) -> DataFrame:
    """prediction ± MAE·sqrt(h), months as ``yyyy-MM``, values rounded.

    ``mae`` is a number or a per-series table ``(keys, mae)`` (joined at
    series grain, one row per key)."""
    keys = list(keys or [])
    if isinstance(mae, (int, float)):
        f = forecast.withColumn("mae", F.lit(float(mae)))
    else:
        f = forecast.join(mae.select(*keys, "mae"), keys, "left")
    band = F.col("mae") * F.sqrt(F.col("h").cast("double"))
    p = F.col(prediction)
    return f.select(*keys, "h", format_year_month("date").alias("month"),
                    F.round(p, digits).alias("prediction"),
                    F.round(p - band, digits).alias("lower"),
                    F.round(p + band, digits).alias("upper"))
