"""Model plans on a made-up seasonal panel: determinism and error below a naive forecast."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.operators import model as MD
from panelcast.operators import sarima as SA
from panelcast.operators.features import FeatureParams, feature_table
from panelcast.operators.recursive import classify_features, recursive_forecast
from panelcast.operators.splits import temporal_split


def seasonal_panel(spark, n=96, series=("a", "b")):
    rng = random.Random(7)
    rows = []
    for s_i, s in enumerate(series):
        for t in range(n):
            d = dt.date(2010 + t // 12, t % 12 + 1, 1)
            y = 100 + 5 * s_i + 0.3 * t + 20 * math.sin(2 * math.pi * (t % 12) / 12) + rng.gauss(0, 1)
            rows.append((s, d, y))
    return spark.createDataFrame(rows, "series string, date date, demand double")


def test_sarima_beats_naive(spark):
    y = np.array([100 + 0.3 * t + 20 * math.sin(2 * math.pi * (t % 12) / 12) for t in range(96)])
    m = SA.fit(y[:84], dict(p=1, d=1, q=0, sp=0, sd=1, sq=0))
    pred = SA.forecast(y[:84], m, 12)
    naive = np.repeat(y[83], 12)
    assert np.mean(np.abs(pred - y[84:])) < np.mean(np.abs(naive - y[84:]))


def test_arima_grid_and_forecast(spark):
    panel = temporal_split(seasonal_panel(spark), "2016-01-01", "2017-01-01")
    grid = SA.arima_grid(panel.filter("split = 'train'"), ["series"], "demand")
    assert grid.count() == 2 * len(SA.ORDER_GRID)
    best = SA.best_orders(grid, ["series"])
    out = SA.arima_forecast(panel, best, ["series"], "demand")
    assert out.filter("split = 'test'").count() == 2 * 12


def test_gbt_panel_fit_and_recursive_forecast(spark):
    p = FeatureParams(target="demand", keys=["series"], macro_cols=[], target_lags=[1, 2, 12], windows=[3])
    feat = temporal_split(feature_table(seasonal_panel(spark), p), "2016-01-01", "2017-01-01")
    cols = ["demand_lag_1", "demand_lag_2", "demand_lag_12", "demand_ma3", "month_sin", "month_cos", "trend"]
    spec = MD.TrainSpec(feature_cols=cols, weight="w")
    feat = feat.withColumn("w", F.lit(1.0))
    params = MD.TreeParams(max_iter=15, max_depth=3, step_size=0.3, subsampling_rate=1.0, feature_subset="all")
    m1 = MD.fit_boosted_trees(feat.filter("split != 'test'"), spec, params)
    m2 = MD.fit_boosted_trees(feat.filter("split != 'test'"), spec, params)
    p1 = [r["y_pred"] for r in m1.transform(feat).orderBy("series", "date").collect()]
    p2 = [r["y_pred"] for r in m2.transform(feat).orderBy("series", "date").collect()]
    assert p1 == p2                                             # seeded -> deterministic
    fc = recursive_forecast(m1, feat, cols, "demand", ["series"], 6)
    assert fc.count() == 12 and fc.filter(F.col("prediction").isNull()).count() == 0
    lags, means, ext = classify_features(cols, "demand")
    assert lags == {"demand_lag_1": 1, "demand_lag_2": 2, "demand_lag_12": 12} and means == {"demand_ma3": 3}
    assert ext == []
    imp, kept = MD.permutation_importance(m1, feat.filter("split = 'val'"), spec, repeats=3,
                                          protected=["demand_lag_1"])
    assert imp.count() == len(cols) and "demand_lag_1" in kept


def test_forecast_state_continues_trend(spark):
    from panelcast.operators.recursive import initial_state, step_features
    rows = [("s", dt.date(2020, m, 1), float(m), m + 11) for m in range(1, 7)]   # trend starts at 12
    hist = spark.createDataFrame(rows, "series string, date date, demand double, trend int")
    st = initial_state(hist, ["demand_lag_1", "demand_ma3", "trend"], "demand", ["series"])
    r = step_features(st, 1, ["demand_lag_1", "demand_ma3", "trend"], "demand").collect()[0]
    assert r["trend"] == 18 and r["demand_lag_1"] == 6.0 and r["demand_ma3"] == 5.0
    assert r["date"] == dt.date(2020, 7, 1)


def test_registered_model_queries_run_on_the_full_budgets():
    from panelcast.plans import q_model, training
    assert q_model.RP == training.RunParams()
    assert (q_model.RP.n_trials, q_model.RP.space.max_iter, q_model.RP.base_trees.max_iter, q_model.RP.repeats) == (50, (50, 600), 200, 50)


def test_gbt_beats_naive_and_search_and_folds(spark):
    from panelcast.operators.splits import walk_forward_folds
    p = FeatureParams(target="demand", keys=["series"], macro_cols=[], target_lags=[1, 12], windows=[3])
    feat = temporal_split(feature_table(seasonal_panel(spark), p), "2016-01-01", "2017-01-01")
    feat = feat.withColumn("w", F.lit(1.0))
    cols = ["demand_lag_1", "demand_lag_12", "demand_ma3", "month_sin", "month_cos", "trend"]
    spec = MD.TrainSpec(feature_cols=cols, weight="w")
    params = MD.TreeParams(max_iter=20, max_depth=3, step_size=0.3, subsampling_rate=1.0, feature_subset="all")
    m = MD.fit_boosted_trees(feat.filter("split != 'test'"), spec, params)
    test = m.transform(feat.filter("split = 'test'"))
    err = test.agg(F.avg(F.abs(F.col("demand") - F.col("y_pred"))).alias("gbt"),
                   F.avg(F.abs(F.col("demand") - F.col("demand_lag_1"))).alias("naive")).collect()[0]
    assert err["gbt"] < err["naive"]
    trials, best = MD.hyperparameter_search(feat, spec, MD.SearchSpace(max_iter=(3, 6)), 3, parallel=2)
    t = trials.orderBy("trial").collect()
    assert len(t) == 3 and all(a["best_so_far"] >= b["best_so_far"] for a, b in zip(t, t[1:]))
    assert 1 <= best.max_iter <= 6
    cv = MD.walk_forward_cv(walk_forward_folds(feat, 3, 6, ["series"]), spec, params, parallel=2)
    assert cv.count() == 3 and cv.filter(F.col("mape").isNull()).count() == 0


def test_folds_are_fitted_together_as_the_cores_allow(spark, monkeypatch):
    """Eight small fits start at once on four cores; four at a time never fill the barrier."""
    import threading
    from types import SimpleNamespace
    together = threading.Barrier(8)

    def fit(rows, *_):
        together.wait(timeout=60)
        return SimpleNamespace(stages=[SimpleNamespace(transform=lambda df: df.withColumn("y_pred", F.col("demand") * 1.5))])

    monkeypatch.setattr(MD, "fit_boosted_trees", fit)
    rows = [("s", dt.date(2010, 1 + i, 1), 2.0, 1.0, 1.0, k, role) for k in range(8) for i, role in enumerate(("train", "test"))]
    folds = spark.createDataFrame(rows, "series string, date date, demand double, x double, w double, fold int, role string")
    cv = MD.walk_forward_cv(folds, MD.TrainSpec(feature_cols=["x"], weight="w"), MD.TreeParams())
    assert [tuple(r) for r in cv.orderBy("fold").collect()] == [(k, 0.5) for k in range(8)]
    many = spark.range(64).repartition(64)
    assert MD.fits_at_once(many) == 4 and MD.fits_at_once(many.coalesce(1)) == 8


def test_more_cores_do_not_bring_more_fits_than_the_driver_can_clean_up_after():
    from types import SimpleNamespace as N
    rows = lambda cores, parts: N(sparkSession=N(sparkContext=N(defaultParallelism=cores)), rdd=N(getNumPartitions=lambda: parts))
    assert [MD.fits_at_once(rows(*x)) for x in ((2, 1), (4, 1), (12, 1), (600, 1), (600, 200))] == [4, 8, 8, 8, 6]


def test_order_choice_is_free_of_units_and_short_series_stay(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    walk = np.cumsum(rng.normal(size=90))
    rows = [(s, f"{1990 + i // 12}-{i % 12 + 1:02d}-01", float(v * u)) for s, u in (("a", 1.0), ("b", 1e6), ("c", 1e-6))
            for i, v in enumerate(walk)] + [("short", f"1990-{i + 1:02d}-01", float(i)) for i in range(8)]
    df = spark.createDataFrame(rows, "series string, d string, demand double").selectExpr(
        "series", "to_date(d) date", "demand", "CASE WHEN d < '1996-01-01' AND NOT (series = 'short' AND d >= '1990-06-01') THEN 'train' ELSE 'val' END split")
    best = SA.best_orders(SA.arima_grid(df.filter("split = 'train'"), ["series"], "demand"), ["series"])
    order = {r["series"]: r["order_id"] for r in best.collect()}
    assert order["a"] == order["b"] == order["c"] and "short" not in order
    out = SA.arima_forecast(df, best, ["series"], "demand").filter("series = 'short'").collect()
    assert len(out) == 3 and all(r["y_pred"] is None and r["reason"] for r in out)


def test_arimax_takes_every_selected_external_column(spark, sf_small, monkeypatch):
    from panelcast.plans import panels, q_model
    seen = {}
    monkeypatch.setattr(q_model, "_SHARED", {})
    monkeypatch.setattr(q_model, "_prepared", lambda *a: (None, ["demand_lag_1", "rev_p2", "qty_a", "trend", "qty_a_lag_2", "demand_ma3"]))
    monkeypatch.setattr(q_model, "_grid", lambda *a: None)
    monkeypatch.setattr(q_model.T, "cut_lineage", lambda df: df)
    monkeypatch.setattr(q_model.SA, "best_orders", lambda *a: None)
    monkeypatch.setattr(q_model.SA, "arima_forecast", lambda df, *a, exog: seen.update(exog=exog, cols=df.columns))
    q_model.seasonal_arimax_forecast_q(spark, sf_small)
    assert seen["exog"] == ["rev_p2", "qty_a", "qty_a_lag_2"] and set(seen["exog"]) <= set(seen["cols"])


def test_arimax_reports_series_too_short_for_its_columns(spark):
    import numpy as np
    rng = np.random.default_rng(5)
    ext = [f"x{j}" for j in range(6)]
    rows = [(s, f"{1990 + i // 12}-{i % 12 + 1:02d}-01", "train" if i < n else "val", float(rng.normal()),
             *(None if (i == 0 and j == 0) or (s == "gap" and i == n) else float(rng.normal()) for j in range(6)))
            for s, n in (("long", 90), ("short", 26), ("gap", 90)) for i in range(n + 3)]
    df = spark.createDataFrame(rows, "series string, d string, split string, demand double, " + ", ".join(f"{x} double" for x in ext)) \
              .withColumn("date", F.to_date("d"))
    orders = spark.createDataFrame([(s, 1, 1, 0, 0, 1, 0) for s in ("long", "short", "gap")], "series string, p int, d int, q int, sp int, sd int, sq int")
    out = SA.arima_forecast(df, orders, ["series"], "demand", exog=ext).collect()
    got = {s: {(r["y_pred"] is None, r["reason"]) for r in out if r["series"] == s} for s in ("long", "short", "gap")}
    assert len(out) == 9 and got["long"] == {(False, None)}
    assert got["short"] == {(True, "series too short for 6 exogenous columns")}
    assert got["gap"] == {(True, "exogenous values missing over the forecast period")}


def test_step_features_of_a_short_series(spark):
    from panelcast.operators.recursive import step_features
    state = spark.createDataFrame([("a", [5.0, 7.0], "2000-02-01"), ("b", [float(i) for i in range(40)], "2000-02-01")],
                                  "series string, buf array<double>, d string").selectExpr("series", "buf", "to_date(d) last_date")
    got = {r["series"]: r for r in step_features(state, 1, ["demand_lag_1", "demand_lag_3", "demand_ma3"], "demand").collect()}
    assert (got["a"]["demand_ma3"], got["a"]["demand_lag_1"], got["a"]["demand_lag_3"]) == (6.0, 7.0, None)
    assert (got["b"]["demand_ma3"], got["b"]["demand_lag_3"]) == (38.0, 37.0)
