"""Leak-safe feature building and statistical feature selection.

The feature table is a single ``select`` over one window spec
(``partitionBy(keys).orderBy(date)``): lags, shifted rolling means, the cyclic
month and the trend index are computed in one sort per series. Selection steps
compute correlations with one aggregate pass and only bring *column names*
back to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.scalars import month_cos, month_sin
from panelcast.operators.clean import numeric_columns
from panelcast.operators.stats import corr_with_target, correlation_matrix
from panelcast.operators.windows import lag_exprs, series_window, shifted_mean_exprs


@dataclass
class FeatureParams:
    target: str = "demand"
    keys: list[str] = field(default_factory=lambda: ["series"])
    date: str = "date"
    target_lags: list[int] = field(default_factory=lambda: [1, 2, 3])
    macro_cols: list[str] = field(default_factory=lambda: ["qty_a", "price_mean", "rev_p1"])
    macro_lags: list[int] = field(default_factory=lambda: [1, 2, 3])
    windows: list[int] = field(default_factory=lambda: [3, 6, 12])

    def lag_name(self, k: int) -> str:
        return f"{self.target}_lag_{k}"

    def ma_name(self, w: int) -> str:
        return f"{self.target}_ma{w}"


def feature_exprs(df: DataFrame, p: FeatureParams) -> dict:
    exprs = {}
    exprs.update(lag_exprs([p.target], p.target_lags, p.keys, p.date, name=p.target + "_lag_{k}"))
    macro = [c for c in p.macro_cols if c in df.columns]
    exprs.update(lag_exprs(macro, p.macro_lags, p.keys, p.date))
    exprs.update(shifted_mean_exprs(p.target, p.windows, p.keys, p.date, name=p.target + "_ma{w}"))
    exprs["month_sin"] = month_sin(p.date)
    exprs["month_cos"] = month_cos(p.date)
    exprs["trend"] = F.row_number().over(series_window(p.keys, p.date)) - F.lit(1)
    return exprs


def feature_table(df: DataFrame, p: FeatureParams, drop_null: bool = True,
                  null_subset: list[str] | None = None) -> DataFrame:
    """Lags of target and macro columns, shifted rolling means, cyclic month, trend.

    The trend index is taken before the NULL drop; rows with any NULL (the
    warm-up months of the lags/means) are dropped afterwards."""
    out = df.withColumns(feature_exprs(df, p))
    return out.dropna(how="any", subset=null_subset) if drop_null else out


def rebuild_features(df: DataFrame, p: FeatureParams, saved_cols: list[str]) -> DataFrame:
    """Same feature build restricted to a saved column list; no re-selection.

    NULL rows are dropped over the saved columns only."""
    out = feature_table(df, p, drop_null=False)
    missing = [c for c in saved_cols if c not in out.columns]
    if missing:
        raise ValueError(f"saved feature columns missing from the current table: {missing}")
    keep = p.keys + [p.date, p.target] + saved_cols
    return out.select(*keep).dropna(how="any", subset=[p.target] + saved_cols)


def collinear_columns(df: DataFrame, target: str, threshold: float,
                      exclude: list[str] | None = None) -> DataFrame:
    """Columns j with |r(i, j)| > t for *any* earlier column i (i itself may be dropped).

    Constant columns have NULL r and are never dropped. Returns (column)."""
    cols = numeric_columns(df, exclude=[target] + list(exclude or []))
    cm = correlation_matrix(df, cols, upper_only=True)
    return (cm.filter(F.abs(F.col("corr")) > F.lit(threshold))
              .select(F.col("col_j").alias("column"), F.col("pos_j").alias("position")).distinct()
              .orderBy("position").select("column"))


def drop_collinear(df: DataFrame, target: str, threshold: float,
                   exclude: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    names = [r["column"] for r in collinear_columns(df, target, threshold, exclude).collect()]
    return df.drop(*names), names


def target_corr_table(df: DataFrame, p: FeatureParams, before, features: list[str] | None = None
                      ) -> DataFrame:
    """|corr(feature, target)| on rows dated before ``before`` (no test leakage)."""
    tv = df.filter(F.col(p.date) < F.lit(before))
    feats = features or [c for c in numeric_columns(df, exclude=[p.target] + p.keys) if c != p.date]
    return corr_with_target(tv, p.target, feats)


def filter_by_target_corr(df: DataFrame, p: FeatureParams, threshold: float, before,
                          features: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Keep features with |r| >= t (NULL r is dropped), ordered by |r| descending."""
    kept = target_corr_table(df, p, before, features).filter(
        F.col("corr_abs") >= F.lit(threshold))
    names = [r["feature"] for r in kept.orderBy(F.col("corr_abs").desc(), "feature").collect()]
    return df.select(*p.keys, p.date, p.target, *names), kept
