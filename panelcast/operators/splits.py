"""Temporal splits, checks and walk-forward folds as columns of one DataFrame.

A split is a label column, not a separate copy of the data; ``trainval`` is a
filter (``split != 'test'``). Folds are produced by exploding each trainval row
into the (bounded, K) folds it takes part in, so no fold is built on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SPLITS = ["train", "val", "test"]


def split_label(date: str, val_start, test_start):
    d = F.col(date)
    return (F.when(d < F.to_date(F.lit(val_start)), F.lit("train"))
            .when(d < F.to_date(F.lit(test_start)), F.lit("val"))
            .otherwise(F.lit("test")))


def temporal_split(df: DataFrame, val_start, test_start, date: str = "date",
                   out: str = "split") -> DataFrame:
    """train < val_start <= val < test_start <= test."""
    if str(val_start) >= str(test_start):
        raise ValueError(f"validation start {val_start} must come before test start {test_start}")
    return df.withColumn(out, split_label(date, val_start, test_start))


def split_checks(df: DataFrame, split: str = "split", date: str = "date") -> DataFrame:
    """Raise when a split is empty; return (split, n_rows, date_min, date_max).

    Only three tiny rows reach the driver."""
    prof = df.groupBy(split).agg(F.count(F.lit(1)).alias("n_rows"),
                                 F.min(date).alias("date_min"), F.max(date).alias("date_max"))
    seen = {r[split]: r["n_rows"] for r in prof.collect()}
    empty = [s for s in SPLITS if not seen.get(s)]
    if empty:
        raise ValueError(f"empty splits for the chosen dates: {empty}")
    return prof


def walk_forward_folds(df: DataFrame, n_folds: int, test_size: int, keys: list[str] | None = None,
                       date: str = "date", split: str | None = "split") -> DataFrame:
    """Expanding-window folds over trainval rows of each series.

    With n trainval rows, fold k (0-based) tests rows ``[n-(K-k)s, n-(K-k-1)s)``
    and trains on every earlier row. Output adds ``fold``, ``role`` ('train'/'test') and
    ``reason``; rows after a fold's test block are not part of it. A series with too few
    trainval rows for all folds takes part in none: it comes out as one row, its last
    one, with NULL fold and role and the reason, and the other series go on."""
    keys = list(keys or [])
    own = F.col(split) != F.lit("test") if split else F.lit(True)
    part = Window.partitionBy(*keys) if keys else Window.partitionBy()
    need = n_folds * test_size + 1
    # counted before the test rows go, so that a series of nothing else is noticed too
    tv = df.withColumns({"_n": F.count(F.when(own, F.lit(1))).over(part),
                         "_from_end": F.row_number().over(part.orderBy(F.col(date).desc()))})
    tv = tv.withColumn("reason", F.when(F.col("_n") < need, F.concat(
        F.lit("too short for the folds: "), F.col("_n").cast("string"),
        F.lit(f" trainval rows, {n_folds} folds of {test_size} need {need}"))))
    tv = tv.filter(F.when(F.col("reason").isNull(), own).otherwise(F.col("_from_end") == 1)) \
           .withColumn("_idx", F.row_number().over(part.orderBy(date)) - 1)
    k = F.col("fold")
    start = F.col("_n") - (F.lit(n_folds) - k) * F.lit(test_size)
    folds = F.when(F.col("reason").isNull(), F.sequence(F.lit(0), F.lit(n_folds - 1)))
    out = tv.withColumn("fold", F.explode_outer(folds)).withColumn("_start", start) \
            .filter(k.isNull() | (F.col("_idx") < F.col("_start") + F.lit(test_size)))
    role = F.when(k.isNotNull(), F.when(F.col("_idx") < F.col("_start"), F.lit("train")).otherwise(F.lit("test")))
    return out.withColumn("role", role).select(*df.columns, "fold", "role", "reason")


def fold_table(df: DataFrame, n_folds: int, test_size: int, keys: list[str], date: str = "date",
               split: str | None = "split") -> tuple[DataFrame, DataFrame]:
    """(rows of the folds, rejected series with their reason)."""
    out = walk_forward_folds(df, n_folds, test_size, keys, date, split)
    return out.filter(F.col("fold").isNotNull()).drop("reason"), out.filter(F.col("fold").isNull()).select(*keys, "reason")
