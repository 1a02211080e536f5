"""Registered queries: window operators and the feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.operators import features as FE
from panelcast.operators import windows as W
from panelcast.operators.monthly import exact_sum
from panelcast.plans import panels as P
from panelcast.plans import sqlgen as S
from panelcast.plans.oracle_panels import feature_names, features_cte, panel_ctes
from panelcast.plans.registry import register

FP = FE.FeatureParams()
LAMBDA = 0.95
LAST_N = 12


def master(spark, sf_dir):
    return P.master_panel(spark, sf_dir)


def rounded_features(df, p=FP):
    ma = [p.ma_name(w) for w in p.windows if p.ma_name(w) in df.columns]
    out = df.withColumns({c: F.round(c, 6) for c in ma})
    return out.withColumns({c: F.round(c, 12) for c in ("month_sin", "month_cos") if c in df.columns})


def _round_sql_cols(cols, p=FP):
    ma = {p.ma_name(w) for w in p.windows}
    out = []
    for c in cols:
        if c in ma:
            out.append(f"round({c}, 6) AS {c}")
        elif c in ("month_sin", "month_cos"):
            out.append(f"round({c}, 12) + 0.0 AS {c}")
        else:
            out.append(c)
    return ", ".join(out)


_MASTER_COLS = ["series", "date", "demand"] + P.FEATURE_COLS

# -- lag_features ------------------------------------------------------------
_LAG_COLS = [FP.lag_name(k) for k in FP.target_lags] + [
    f"{c}_lag_{k}" for c in FP.macro_cols for k in FP.macro_lags]


@register("lag_features", sql=panel_ctes() + ", " + features_cte(FP)
          + f" SELECT series, date, demand, {', '.join(_LAG_COLS)} FROM feat_raw")
def lag_features_q(spark, sf_dir):
    m = master(spark, sf_dir)
    out = W.lag_features(m, [FP.target], FP.target_lags, P.KEYS, name=FP.target + "_lag_{k}")
    out = W.lag_features(out, FP.macro_cols, FP.macro_lags, P.KEYS)
    return out.select("series", "date", "demand", *_LAG_COLS)


_MA_COLS = [FP.ma_name(w) for w in FP.windows]


@register("shifted_rolling_mean", sql=panel_ctes() + ", " + features_cte(FP)
          + f" SELECT series, date, demand, {_round_sql_cols(_MA_COLS)} FROM feat_raw")
def shifted_rolling_mean_q(spark, sf_dir):
    m = master(spark, sf_dir)
    out = W.shifted_rolling_mean(m, FP.target, FP.windows, P.KEYS, name=FP.target + "_ma{w}")
    return rounded_features(out.select("series", "date", "demand", *_MA_COLS))


@register("trend_index", sql=panel_ctes() + f"""
SELECT series, date, CAST(row_number() OVER {S.win(['series'])} - 1 AS INTEGER) AS trend FROM master""")
def trend_index_q(spark, sf_dir):
    return W.trend_index(P.target_panel(spark, sf_dir), P.KEYS).select("series", "date", "trend")


@register("trend_index_overall", sql=panel_ctes() + f"""
SELECT date, sum(demand) AS demand, CAST(row_number() OVER (ORDER BY date) - 1 AS INTEGER) AS trend FROM master GROUP BY date""")
def trend_index_overall_q(spark, sf_dir):
    """The trend of the national total, one series without a key."""
    total = P.target_panel(spark, sf_dir).groupBy("date").agg(exact_sum(F.col("demand"), 2).alias("demand"))
    return W.trend_index(total).select("date", "demand", "trend")


@register("recency_weight", sql=panel_ctes() + f"""
SELECT series, date, round(pow({LAMBDA}::DOUBLE, CAST(row_number() OVER {S.win(['series'], desc=True)} - 1 AS DOUBLE)), 12) AS weight
FROM master""")
def recency_weight_q(spark, sf_dir):
    out = W.recency_weight(P.target_panel(spark, sf_dir), LAMBDA, P.KEYS)
    return out.select("series", "date", F.round("weight", 12).alias("weight"))


@register("last_n", sql=panel_ctes() + f"""
SELECT series, date, demand FROM (
  SELECT series, date, demand, row_number() OVER {S.win(['series'], desc=True)} AS rn FROM master)
WHERE rn <= {LAST_N}""")
def last_n_q(spark, sf_dir):
    return W.last_n(P.target_panel(spark, sf_dir), LAST_N, P.KEYS).select("series", "date", "demand")


@register("sort_multi", sql=panel_ctes() + """
SELECT series, date, demand FROM master ORDER BY series, date, demand""")
def sort_multi_q(spark, sf_dir):
    return W.sort_multi(P.target_panel(spark, sf_dir), ["series", "date", "demand"]).select(
        "series", "date", "demand")


# -- feature_table: lags + means + cyclic month + trend, NULL warm-up rows dropped
_FEAT_COLS = _MASTER_COLS + feature_names(FP)


@register("feature_table", sql=panel_ctes() + ", " + features_cte(FP)
          + f" SELECT {_round_sql_cols(_FEAT_COLS)} FROM feat")
def feature_table_q(spark, sf_dir):
    return rounded_features(FE.feature_table(master(spark, sf_dir), FP))


@register("month_cyclic", sql=panel_ctes() + """
SELECT series, date, round(sin(2 * pi() * month(date) / 12.0), 12) + 0.0 AS month_sin,
       round(cos(2 * pi() * month(date) / 12.0), 12) + 0.0 AS month_cos FROM master""")
def month_cyclic_q(spark, sf_dir):
    from panelcast.functions.scalars import month_cos, month_sin
    m = P.target_panel(spark, sf_dir)
    return m.select("series", "date", F.round(month_sin("date"), 12).alias("month_sin"),
                    F.round(month_cos("date"), 12).alias("month_cos"))


# Rebuild with a saved column list: NULLs dropped over the saved columns only.
SAVED_COLS = [FP.lag_name(1), FP.lag_name(2), FP.ma_name(3), "month_sin", "trend"]


@register("rebuild_features", sql=panel_ctes() + ", " + features_cte(FP) + f"""
SELECT {_round_sql_cols(['series', 'date', 'demand'] + SAVED_COLS)} FROM feat_raw
WHERE demand IS NOT NULL AND {' AND '.join(c + ' IS NOT NULL' for c in SAVED_COLS)}""")
def rebuild_features_q(spark, sf_dir):
    return rounded_features(FE.rebuild_features(master(spark, sf_dir), FP, SAVED_COLS))
