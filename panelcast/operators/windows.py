"""Window operators over monthly panels.

Every window is ``partitionBy(keys).orderBy(date)``: rows of one series go to
one task, and a series is at monthly grain (a few hundred rows at most), so the
sort per task is tiny whatever the size of the raw facts. Operators that share
one ordering reuse a single window spec so Spark sorts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.operators.ranks import global_rank


def series_window(keys: list[str] | None, date: str = "date", descending: bool = False):
    order = F.col(date).desc() if descending else F.col(date).asc()
    w = Window.partitionBy(*keys) if keys else Window.partitionBy()
    return w.orderBy(order)


def lag_exprs(cols: list[str], lags: list[int], keys: list[str] | None, date: str = "date",
              name: str = "{col}_lag_{k}") -> dict[str, Column]:
    w = series_window(keys, date)
    return {name.format(col=c, k=k): F.lag(F.col(c), k).over(w) for c in cols for k in lags}


def lag_features(df: DataFrame, cols: list[str], lags: list[int], keys: list[str] | None = None,
                 date: str = "date", name: str = "{col}_lag_{k}") -> DataFrame:
    """``col_lag_k`` per column and lag; columns that are absent are skipped."""
    cols = [c for c in cols if c in df.columns]
    return df.withColumns(lag_exprs(cols, lags, keys, date, name))


def shifted_mean_exprs(col: str, windows: list[int], keys, date="date",
                       name: str = "{col}_ma{w}") -> dict[str, Column]:
    base = series_window(keys, date)
    out = {}
    for w in windows:
        frame = base.rowsBetween(-w, -1)
        # pandas rolling(w) needs w non-NULL values in the frame of the w previous rows.
        out[name.format(col=col, w=w)] = F.when(
            F.count(F.col(col)).over(frame) == F.lit(w), F.avg(F.col(col)).over(frame))
    return out


def shifted_rolling_mean(df: DataFrame, col: str, windows: list[int], keys=None, date="date",
                         name: str = "{col}_ma{w}") -> DataFrame:
    """Mean of the w *previous* rows (no look-ahead); NULL unless all w are present."""
    return df.withColumns(shifted_mean_exprs(col, windows, keys, date, name))


def ffill_bfill_exprs(cols: list[str], keys, date="date", backward: bool = True) -> dict[str, Column]:
    w = series_window(keys, date)
    past = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    future = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    out = {}
    for c in cols:
        filled = F.last(F.col(c), ignorenulls=True).over(past)
        if backward:
            filled = F.coalesce(filled, F.first(F.col(c), ignorenulls=True).over(future))
        out[c] = filled
    return out


def ffill_bfill(df: DataFrame, cols: list[str], keys=None, date="date",
                backward: bool = True) -> DataFrame:
    """Forward fill then backward fill in date order (backward fill can be turned off)."""
    return df.withColumns(ffill_bfill_exprs(cols, keys, date, backward))


def trend_index(df: DataFrame, keys=None, date="date", out="trend") -> DataFrame:
    """Number of the row in its series, from 0; without keys the whole table is one series,
    numbered over all partitions."""
    if not keys:
        ranked, _ = global_rank(df, [date], out)
        return ranked.withColumn(out, F.col(out) - F.lit(1))
    return df.withColumn(out, F.row_number().over(series_window(keys, date)) - F.lit(1))


def recency_weight(df: DataFrame, lam: float, keys=None, date="date", out="weight") -> DataFrame:
    """lambda ** age, newest row of each series weighs 1."""
    age = F.row_number().over(series_window(keys, date, descending=True)) - F.lit(1)
    return df.withColumn(out, F.pow(F.lit(float(lam)), age.cast("double")))


def last_n(df: DataFrame, n: int, keys=None, date="date") -> DataFrame:
    """Last n rows in date order per series."""
    rn = F.row_number().over(series_window(keys, date, descending=True))
    return df.withColumn("_rn", rn).filter(F.col("_rn") <= F.lit(n)).drop("_rn")


def sort_multi(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.orderBy(*[F.col(f"`{c}`") for c in cols])


def top_k(df: DataFrame, score: str, k: int, descending: bool = True) -> DataFrame:
    """Top k rows by a score (global; a bounded report); ties in the order of the other columns."""
    order = F.col(score).desc() if descending else F.col(score).asc()
    return df.orderBy(order, *[F.col(f"`{c}`") for c in df.columns if c != score]).limit(k)

