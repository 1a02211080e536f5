"""Recursive multi-step forecast with a fitted panel model.

State is one row per series: the recent target history as ``ARRAY<DOUBLE>``,
the frozen external features, the trend base and the last month. Each step
builds the next feature row with array functions (lags = ``element_at(buf,-k)``,
shifted means = mean of ``slice(buf,-w,w)``), scores all series in one
``transform`` and appends the prediction to the buffer. Steps never shuffle the
data; the growing lineage is cut with a reliable checkpoint every few steps.
"""

from __future__ import annotations

import re

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.scalars import month_cos, month_sin
from panelcast.session import cut_lineage

CALENDAR = ("month_sin", "month_cos", "trend")


def classify_features(feature_cols: list[str], target: str):
    """Split features into target lags, target shifted means, calendar and externals (by name)."""
    lags, means, ext = {}, {}, []
    for c in feature_cols:
        m_lag = re.fullmatch(re.escape(target) + r"_lag_(\d+)", c)
        m_ma = re.fullmatch(re.escape(target) + r"_ma(\d+)", c)
        if m_lag:
            lags[c] = int(m_lag.group(1))
        elif m_ma:
            means[c] = int(m_ma.group(1))
        elif c not in CALENDAR:
            ext.append(c)
    return lags, means, ext


def initial_state(history: DataFrame, feature_cols: list[str], target: str, keys: list[str],
                  date: str = "date") -> DataFrame:
    """Per series: target history buffer (date order), last external values, trend base, last month."""
    lags, means, ext = classify_features(feature_cols, target)
    depth = max(list(lags.values()) + list(means.values()) + [1])
    from pyspark.sql import Window
    w = Window.partitionBy(*keys).orderBy(F.col(date).desc())
    ranked = history.withColumn("_age", F.row_number().over(w)) \
                    .withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    # only the last ``depth`` values enter the buffer: bounded by the longest lag/window
    recent = ranked.filter(F.col("_age") <= depth)
    hist = F.array_sort(F.collect_list(F.struct(F.col(date).alias("d"), F.col(target).alias("v"))))
    last = F.max_by(F.struct(*[F.col(c) for c in ext]), F.col(date)) if ext else F.lit(None)
    # the trend continues from the last observed trend value (it was numbered before
    # the warm-up rows were dropped), else from the row count
    trend_last = F.max("trend") if "trend" in history.columns else F.max("_n") - 1
    st = recent.groupBy(*keys).agg(
        hist.alias("_h"), F.max(date).alias("last_date"), trend_last.alias("_t"), last.alias("_ext"))
    st = st.select(*keys, F.transform("_h", lambda s: s["v"]).alias("buf"), "last_date",
                   F.col("_t").alias("trend_base"),
                   *[F.col(f"_ext.{c}").alias(c) for c in ext])
    return st


def step_features(state: DataFrame, h: int, feature_cols: list[str], target: str) -> DataFrame:
    lags, means, ext = classify_features(feature_cols, target)
    nxt = F.add_months("last_date", h)
    exprs = {}
    for c, k in lags.items():
        exprs[c] = F.try_element_at("buf", F.lit(-k))       # null before the series began
    for c, w in means.items():
        # a series shorter than the window averages what it has
        size = F.least(F.lit(w), F.size("buf"))
        win = F.slice("buf", -size, size)
        exprs[c] = F.when(size > 0, F.aggregate(win, F.lit(0.0), lambda a, x: a + x) / size)
    if "month_sin" in feature_cols:
        exprs["month_sin"] = month_sin(nxt)
    if "month_cos" in feature_cols:
        exprs["month_cos"] = month_cos(nxt)
    if "trend" in feature_cols:
        exprs["trend"] = F.col("trend_base") + F.lit(h)
    return state.withColumns(exprs).withColumn("date", nxt)


def first_step(history: DataFrame, feature_cols: list[str], target: str, keys: list[str], date: str = "date") -> DataFrame:
    """(keys, date, features) of the first forecast month of each series."""
    step = step_features(initial_state(history, feature_cols, target, keys, date), 1, feature_cols, target)
    return step.select(*keys, "date", *feature_cols)


def recursive_forecast(model: PipelineModel, history: DataFrame, feature_cols: list[str], target: str,
                       keys: list[str], horizon: int, date: str = "date",
                       checkpoint_every: int = 6) -> DataFrame:
    """Forecast rows ``(keys, h, date, prediction)`` for h = 1..horizon.

    The predictions ride along in the state row (``preds``), so the steps form
    one chain of projections over one row per series; the result is a single
    ``posexplode`` at the end, not a union of per-step frames."""
    state = initial_state(history, feature_cols, target, keys, date).withColumn(
        "preds", F.array().cast("array<double>"))
    carry = [c for c in state.columns if c not in keys]
    for h in range(1, horizon + 1):
        scored = model.transform(step_features(state, h, feature_cols, target))
        state = scored.select(*keys, *carry, F.col("y_pred").alias("_p")).withColumns({
            "buf": F.concat("buf", F.array("_p")), "preds": F.concat("preds", F.array("_p"))}).drop("_p")
        if h % checkpoint_every == 0 and h < horizon:
            state = cut_lineage(state)
    out = state.select(*keys, "last_date", F.posexplode("preds").alias("_i", "prediction"))
    return out.select(*keys, (F.col("_i") + 1).alias("h"),
                      F.add_months("last_date", F.col("_i") + 1).alias(date), "prediction")
