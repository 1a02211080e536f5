"""Seasonal ARIMA(X) per series with ``applyInPandas``.

Fitting is the two-stage least-squares (Hannan–Rissanen) estimator on the
differenced series: a long autoregression gives residual estimates, then the
AR, seasonal-AR, MA and seasonal-MA lags (plus exogenous columns) are fitted by
ordinary least squares. It is not the exact likelihood fit, so values differ
from a state-space fit; model choice uses AIC = n·log(σ²) + 2k.

Spark's role: each (series, order) pair is one group of the grid (the data of
a series is repeated once per candidate order, a fixed factor of 36), groups
are fitted in parallel in Python workers, and the best order per series is an
ordinary ``min_by`` aggregate. A group is one series' monthly history.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.session import ship_package

SEASON = 12
# Candidate orders: p in 0..2, d = 1, q in 0..2, seasonal P (sp) in 0..1, D (sd) = 1, Q (sq) in 0..1.
# (Spark column names are case-insensitive, so the seasonal orders are named sp/sd/sq.)
ORDER_GRID = [dict(p=p, d=1, q=q, sp=sp, sd=1, sq=sq)
              for p, q, sp, sq in itertools.product(range(3), range(3), range(2), range(2))]


def _diff_poly(d: int, D: int, s: int) -> np.ndarray:
    poly = np.array([1.0])
    for _ in range(d):
        poly = np.convolve(poly, [1.0, -1.0])
    for _ in range(D):
        sp = np.zeros(s + 1)
        sp[0], sp[s] = 1.0, -1.0
        poly = np.convolve(poly, sp)
    return poly


def _apply_poly(y: np.ndarray, poly: np.ndarray) -> np.ndarray:
    k = len(poly) - 1
    return np.array([poly @ y[t - np.arange(k + 1)] for t in range(k, len(y))])


def _lags(order: dict, s: int):
    """AR and MA lags of the expanded product of the short and the seasonal polynomial."""
    def product(short: int, seasons: int) -> list[int]:
        return [s * k + j for k in range(seasons + 1) for j in range(short + 1) if s * k + j]

    return product(order["p"], order["sp"]), product(order["q"], order["sq"])


def _usable_lag(n_obs: int, orders: list[dict], s: int = SEASON) -> int:
    """Longest lag of the grid that leaves enough rows; orders beyond it can't be fitted."""
    o = orders[0]
    n = n_obs - o["d"] - s * o["sd"]
    m = min(max(2 * s, 8), n // 3)
    lags = {max(sum(_lags(x, s), []) + [0]) for x in orders}
    return max((lag for lag in lags if n - m - lag >= 5), default=-1)


def fit(y: np.ndarray, order: dict, exog: np.ndarray | None = None, s: int = SEASON,
        longest: int = 0) -> dict | None:
    """Two-stage LS fit; returns coefficients, residual variance, AIC (None if too short).

    With ``longest`` the rows begin after that lag for every order, so that the AIC of
    different orders is taken over the same rows."""
    poly = _diff_poly(order["d"], order["sd"], s)
    z = _apply_poly(y, poly)
    xz = None if exog is None else np.column_stack([_apply_poly(exog[:, j], poly) for j in range(exog.shape[1])])
    ar, ma = _lags(order, s)
    n = len(z)
    m = min(max(2 * s, 8), n // 3)
    if len(y) <= len(poly) or n < 10 or m < 1:
        return None
    # stage 1: long autoregression for residual estimates
    X1 = np.column_stack([z[m - k: n - k] for k in range(1, m + 1)])
    b1, *_ = np.linalg.lstsq(X1, z[m:], rcond=None)
    e = np.zeros(n)
    e[m:] = z[m:] - X1 @ b1
    # stage 2: regression on AR lags of z, MA lags of e, exogenous terms
    start = m + max(ar + ma + [longest])
    if n - start < 5:
        return None
    cols = [z[start - k: n - k] for k in ar] + [e[start - k: n - k] for k in ma]
    if xz is not None:
        cols += [xz[start:, j] for j in range(xz.shape[1])]
    if xz is not None and len(cols) >= n - start:
        return None     # more columns than rows: any target would be met exactly
    X2 = np.column_stack(cols) if cols else np.zeros((n - start, 0))
    target = z[start:]
    beta = np.linalg.lstsq(X2, target, rcond=None)[0] if X2.shape[1] else np.zeros(0)
    resid = target - (X2 @ beta if X2.shape[1] else 0.0)
    sigma2 = float(np.mean(resid ** 2)) or 1e-300
    k = len(beta) + 1
    nobs = len(target)
    return dict(beta=beta, ar=ar, ma=ma, sigma2=sigma2, aic=nobs * np.log(sigma2) + 2 * k,
                nobs=nobs, e=e, z=z, poly=poly, n_exog=0 if xz is None else xz.shape[1])


def forecast(y: np.ndarray, model: dict, steps: int, exog_hist: np.ndarray | None = None,
             exog_future: np.ndarray | None = None) -> np.ndarray:
    """Forecast ``steps`` values of y (future shocks = 0), then undo the differencing."""
    poly, ar, ma, beta = model["poly"], model["ar"], model["ma"], model["beta"]
    z, e = list(model["z"]), list(model["e"])
    ylist = list(y)
    xz_f = None
    if model["n_exog"]:
        xfull = np.vstack([exog_hist, exog_future])
        xz_all = np.column_stack([_apply_poly(xfull[:, j], poly) for j in range(xfull.shape[1])])
        xz_f = xz_all[-steps:]
    out = []
    for h in range(steps):
        terms = [z[-k] for k in ar] + [e[-k] for k in ma]
        if xz_f is not None:
            terms += list(xz_f[h])
        zt = float(np.dot(beta, terms)) if len(beta) else 0.0
        z.append(zt)
        e.append(0.0)
        # y_t = z_t - sum_{j>=1} poly_j y_{t-j}
        yt = zt - sum(poly[j] * ylist[-j] for j in range(1, len(poly)))
        ylist.append(yt)
        out.append(yt)
    return np.array(out)


# ------------------------------------------------------------------ Spark plans

def arima_grid(train: DataFrame, keys: list[str], target: str, date: str = "date") -> DataFrame:
    """AIC of every candidate order per series; (keys, order_id, p, d, q, sp, sd, sq, aic).

    One group per series fits the whole grid on the same rows. Orders whose lags
    don't fit into the series have a NULL aic."""
    ship_package(train.sparkSession)
    names = list(ORDER_GRID[0])
    schema = ", ".join([f"{k} string" for k in keys] + ["order_id int"] + [f"{k} int" for k in names]
                       + ["aic double"])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        y = pdf.sort_values(date)["y"].to_numpy(float)
        usable = _usable_lag(len(y), ORDER_GRID)
        rows = []
        for i, o in enumerate(ORDER_GRID):
            fits = max(sum(_lags(o, SEASON), []) + [0]) <= usable
            m = fit(y, o, longest=usable) if fits else None
            rows.append({**{k: str(pdf[k].iloc[0]) for k in keys}, "order_id": i, **o, "aic": m["aic"] if m else np.nan})
        return pd.DataFrame(rows)

    rows = train.select(*keys, date, F.col(target).cast("double").alias("y"))
    out = rows.groupBy(*keys).applyInPandas(run, schema)
    return out.withColumn("aic", F.when(~F.isnan("aic"), F.col("aic")))


def best_orders(grid: DataFrame, keys: list[str]) -> DataFrame:
    names = list(ORDER_GRID[0])
    best = grid.filter(F.col("aic").isNotNull()).groupBy(*keys).agg(
        F.min_by(F.struct("order_id", *names), "aic").alias("_b"), F.min("aic").alias("aic"))
    return best.select(*keys, "_b.*", "aic")


def arima_forecast(panel: DataFrame, orders: DataFrame, keys: list[str], target: str,
                   exog: list[str] | None = None, split: str = "split", date: str = "date") -> DataFrame:
    """Per series: fit on train -> forecast val; refit on train+val -> forecast test.

    Exogenous columns (ARIMAX) use their observed values over the forecast
    period. Output: (keys, date, split, y_real, y_pred, resid_std, reason): a series
    too short for any order or for its exogenous columns, or without their values,
    keeps its rows, with a NULL prediction and the reason. History begins after the
    last row that lacks an exogenous value (the warm-up of lags)."""
    ship_package(panel.sparkSession)
    exog = list(exog or [])
    names = list(ORDER_GRID[0])
    data = panel.select(*keys, date, split, F.col(target).cast("double").alias("y"),
                        *[F.col(c).cast("double").alias(c) for c in exog]).join(orders.select(*keys, *names), keys, "left")
    schema = ", ".join([f"{k} string" for k in keys] + [f"{date} date", f"{split} string", "y_real double",
                                                      "y_pred double", "resid_std double", "reason string"])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(date).reset_index(drop=True)
        o = None if pdf[names].isna().any(axis=None) else {k: int(pdf[k].iloc[0]) for k in names}
        X = pdf[exog].to_numpy(float) if exog else None
        out = []
        for fit_splits, target_split in ((["train"], "val"), (["train", "val"], "test")):
            hist = pdf[pdf[split].isin(fit_splits)]
            fut = pdf[pdf[split] == target_split]
            if fut.empty:
                continue
            reason = "series too short for the model"
            if X is not None:
                gaps = hist.index[np.isnan(X[hist.index]).any(axis=1)]
                hist = hist.loc[gaps[-1] + 1:] if len(gaps) else hist
            if X is not None and np.isnan(X[fut.index]).any():
                m, reason = None, "exogenous values missing over the forecast period"
            else:
                m = fit(hist["y"].to_numpy(float), o, None if X is None else X[hist.index]) if o else None
                if m is None and o and X is not None and fit(hist["y"].to_numpy(float), o):
                    reason = f"series too short for {len(exog)} exogenous columns"
            pred = [None] * len(fut) if m is None else forecast(
                hist["y"].to_numpy(float), m, len(fut),
                None if X is None else X[hist.index], None if X is None else X[fut.index])
            for (_, r), p in zip(fut.iterrows(), pred):
                row = {k: str(r[k]) for k in keys}
                row.update({date: r[date], split: target_split, "y_real": float(r["y"]),
                            "y_pred": None if p is None else float(p),
                            "resid_std": None if m is None else float(np.sqrt(m["sigma2"])),
                            "reason": reason if m is None else None})
                out.append(row)
        cols = keys + [date, split, "y_real", "y_pred", "resid_std", "reason"]
        return pd.DataFrame(out, columns=cols)

    return data.groupBy(*keys).applyInPandas(run, schema)
