"""Registered queries: fitted models, search, folds, importances, forecasts, sessions.

A fit cannot be written in SQL, so the queries that return fitted numbers are checked
by rows and by the tests; beside each stands a ``*_check`` query whose rows SQL can
tell: which rows, features, folds or months come out, and that the fitted numbers pass
a recomputation (the trees as a table, the session read again). They run on
``RunParams()``, the library's full budgets: 50 trials of 50 to 600 trees, 200 base
trees, 50 shuffles, on all rows. Queries of one application over the same unchanged
tables share one prepared frame, one fit and one search.
"""

from __future__ import annotations

import json
from dataclasses import asdict, replace

from pyspark.sql import functions as F

from panelcast.operators import compare as CP
from panelcast.operators import model as MD
from panelcast.operators import sarima as SA
from panelcast.operators import stats as ST
from panelcast.operators.features import feature_table
from panelcast.operators.forecast_table import error_band
from panelcast.operators.recursive import classify_features, first_step
from panelcast.operators.windows import top_k
from panelcast.plans import panels as P
from panelcast.plans import q_stats as QS
from panelcast.plans import sqlgen as S
from panelcast.plans import training as T
from panelcast.plans.oracle_panels import feature_names, features_cte, panel_ctes
from panelcast.plans.registry import register

RP = T.RunParams()
FP = T.FP
_SHARED: dict = {}


def _shared(spark, sf_dir, what, build):
    """``build()`` once for an application and the present state of the fact tables."""
    stamp = [P.load(spark, sf_dir, t).select(F.max("_metadata.file_modification_time")).first()[0] for t in ("orders", "lineitem")]
    key = (spark.sparkContext.applicationId, sf_dir, what, *stamp)
    if key not in _SHARED:
        for old in [k for k in _SHARED if k[2] == what]:
            del _SHARED[old]                     # one state of one table set at a time
        _SHARED[key] = build()
    return _SHARED[key]


def _prepared(spark, sf_dir):
    def build():
        df, cols = T.prepared_frame(spark, sf_dir, RP)
        return T.cut_lineage(df), cols
    return _shared(spark, sf_dir, "frame", build)


def _trained(spark, sf_dir):
    return _shared(spark, sf_dir, "fit", lambda: T.train_on(*_prepared(spark, sf_dir), RP, with_cv=False, with_search=False))


# SQL of the frame the models are trained on: features that survive both selections
_BASE = {c: c for c in P.FEATURE_COLS} | {f"{c}_lag_{k}": c for c in FP.macro_cols for k in FP.macro_lags}
_CANDIDATES = P.FEATURE_COLS + feature_names(FP)
_FRAME_SQL = (panel_ctes() + ", " + features_cte(FP) + f", mf AS (SELECT *, {QS.SPLIT_SQL} AS split FROM feat)"
              + f", up AS ({QS._corr_pairs_sql(P.FEATURE_COLS, [], 'master')})"
              + f", gone AS (SELECT DISTINCT col_j FROM up WHERE abs(corr) > {RP.collinear_t})"
              + f", tv AS (SELECT * FROM feat WHERE date < DATE '{T.TEST_START}'), ct AS ("
              + " UNION ALL ".join(f"SELECT '{c}' AS feature, '{_BASE.get(c, '')}' AS base, abs({S.pair_corr(c, P.TARGET)}) AS corr_abs FROM tv"
                                   for c in _CANDIDATES)
              + f"), chosen AS (SELECT feature FROM ct WHERE corr_abs >= {RP.target_corr_t} AND base NOT IN (SELECT col_j FROM gone))")


@register("fit_boosted_trees")
def fit_boosted_trees_q(spark, sf_dir):
    return _trained(spark, sf_dir).predictions


@register("fit_boosted_trees_check", sql=_FRAME_SQL + " SELECT series, date, split, demand AS y_real, TRUE AS agrees FROM mf")
def fit_boosted_trees_check_q(spark, sf_dir):
    """Every prediction again from the table of tree nodes, as one compiled expression and
    by joining rows with nodes level by level."""
    r = _trained(spark, sf_dir)
    nodes = T.cut_lineage(MD.tree_nodes(r.model))
    on = [*P.KEYS, "date"]
    by_expression = MD.score_by_expression(r.frame, nodes, r.feature_cols, "by_expression").select(*on, "by_expression")
    by_join = MD.score_by_join(r.frame, nodes, r.feature_cols, on, "by_join")
    both = r.predictions.join(by_expression, on).join(by_join, on)
    near = [F.abs(F.col(c) - F.col("y_pred")) <= 1e-9 * F.abs("y_pred") for c in ("by_expression", "by_join")]
    return both.select(*P.KEYS, "date", "split", "y_real", (near[0] & near[1]).alias("agrees"))


@register("gbt_metrics")
def gbt_metrics_q(spark, sf_dir):
    """R², MSE, MAE, MAPE per split of the panel GBT (regression_metrics on fitted predictions)."""
    return _trained(spark, sf_dir).metrics


@register("gbt_metrics_check", sql=_FRAME_SQL + " SELECT split, count(*) AS n_rows, TRUE AS explains FROM mf GROUP BY split")
def gbt_metrics_check_q(spark, sf_dir):
    """Rows of each split, and whether the errors keep their order: squared means, 0 <= MAE² <= MSE."""
    r = _trained(spark, sf_dir)
    rows = r.predictions.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.join(r.metrics, "split").select("split", "n_rows", (
        (F.col("mae") > 0) & (F.col("mae") * F.col("mae") <= F.col("mse") * 1.000001) & (F.col("r2") <= 1) & (F.col("mape") > 0)).alias("explains"))


def _searched(spark, sf_dir):
    def build():
        df, cols = _prepared(spark, sf_dir)
        return MD.hyperparameter_search(df, T.spec_for(cols, "w_train", RP), RP.space, RP.n_trials, seed=RP.seed, patience=RP.patience)
    return _shared(spark, sf_dir, "search", build)


@register("hyperparameter_search")
def hyperparameter_search_q(spark, sf_dir):
    return _searched(spark, sf_dir)[0]


#: Trials whose stopping is evaluated a second way by the check (the search itself runs all).
CHECK_TRIALS = 4


@register("hyperparameter_search_check", sql=_FRAME_SQL + f""", n AS (SELECT count(*) AS n_val FROM mf WHERE split = 'val')
SELECT CAST(unnest(range(0, {CHECK_TRIALS})) AS INTEGER) AS trial, n_val, TRUE AS in_space, TRUE AS same_error FROM n""")
def hyperparameter_search_check_q(spark, sf_dir):
    """The first trials: within the space, no more trees than rounds, and the error told for
    the trees used is that of a model fitted with just so many trees."""
    df, cols = _prepared(spark, sf_dir)
    spec = T.spec_for(cols, "w_train", RP)
    table, _ = MD.hyperparameter_search(df, spec, RP.space, CHECK_TRIALS, seed=RP.seed, patience=RP.patience)
    train = MD.fit_rows(df.filter(F.col("split") == "train"), spec, spec.weight)
    val = df.filter(F.col("split") == "val")
    n_val, rows = val.count(), []
    for r in table.collect():
        p = MD.TreeParams(**json.loads(r["params"]))
        inside = all(lo <= getattr(p, k) <= hi for k, (lo, hi) in asdict(RP.space).items() if k != "feature_subset")
        m = MD.fit_boosted_trees(train, spec, replace(p, max_iter=r["trees_used"]), RP.seed)
        again = ST.regression_metrics(m.transform(val), label=P.TARGET, digits=9).first()["mse"]
        rows.append((r["trial"], n_val, inside and r["trees_used"] <= p.max_iter, abs(again - r["val_mse"]) <= 1e-9 * again))
    return spark.createDataFrame(rows, "trial int, n_val long, in_space boolean, same_error boolean")


def _cv(spark, sf_dir):
    """The fold scores alone: no final model is fitted for them."""
    return _shared(spark, sf_dir, "cv", lambda: T.train_on(*_prepared(spark, sf_dir), RP, with_search=False, with_final=False))


@register("walk_forward_cv")
def walk_forward_cv_q(spark, sf_dir):
    return _cv(spark, sf_dir).cv


@register("walk_forward_cv_check", sql=_FRAME_SQL + f""",
n AS (SELECT series, count(*) AS n FROM mf WHERE split <> 'test' GROUP BY series),
ok AS (SELECT count(*) * {RP.fold_size} AS n_test FROM n WHERE n > {RP.n_folds * RP.fold_size})
SELECT CAST(unnest(range(0, {RP.n_folds})) AS INTEGER) AS fold, n_test, TRUE AS scored FROM ok""")
def walk_forward_cv_check_q(spark, sf_dir):
    """Every fold is scored on the test rows of all series long enough for it."""
    r = _cv(spark, sf_dir)
    from panelcast.operators.splits import fold_table
    rows, _ = fold_table(r.frame, RP.n_folds, RP.fold_size, P.KEYS)
    tested = rows.filter(F.col("role") == "test").groupBy("fold").agg(F.count(F.lit(1)).alias("n_test"))
    return tested.join(r.cv, "fold").select("fold", "n_test", ((F.col("mape") > 0) & ~F.isnan("mape")).alias("scored"))


def _importances(spark, sf_dir):
    r = _trained(spark, sf_dir)
    return MD.feature_importance(r.model, r.feature_cols, spark)


@register("feature_importance")
def feature_importance_q(spark, sf_dir):
    return _importances(spark, sf_dir)


@register("feature_importance_check", sql=_FRAME_SQL + " SELECT feature, TRUE AS share, CAST(1.0 AS DOUBLE) AS total FROM chosen")
def feature_importance_check_q(spark, sf_dir):
    """The features that both selections leave, each with a share of importance; shares add up to 1."""
    imp = T.cut_lineage(_importances(spark, sf_dir))
    total = imp.agg(F.round(F.sum("importance"), 6).alias("total"))
    return imp.join(F.broadcast(total)).select("feature", F.col("importance").between(0, 1).alias("share"), "total")


@register("top_k_importance")
def top_k_importance_q(spark, sf_dir):
    return top_k(_importances(spark, sf_dir), "importance", 5)


@register("top_k_importance_check", sql=_FRAME_SQL + """ SELECT least(5, count(*)) AS n_top, TRUE AS chosen, TRUE AS above_rest FROM chosen""")
def top_k_importance_check_q(spark, sf_dir):
    """Five features of the chosen ones, none of the others above them."""
    imp = T.cut_lineage(_importances(spark, sf_dir))
    top = top_k(imp, "importance", 5).select(F.col("feature").alias("_f"), F.col("importance").alias("_i"))
    marked = imp.join(top, F.col("feature") == F.col("_f"), "full")
    return marked.agg(F.count("_f").alias("n_top"), (F.count("feature") == F.count(F.lit(1))).alias("chosen"),
                      (F.min("_i") >= F.coalesce(F.max(F.when(F.col("_f").isNull(), F.col("importance"))), F.lit(0.0))).alias("above_rest"))


def _permuted(spark, sf_dir):
    return _shared(spark, sf_dir, "permuted", lambda: [T.cut_lineage(x) if i == 0 else x for i, x in enumerate(
        T.select_by_permutation(*_prepared(spark, sf_dir), RP))])


@register("permutation_importance")
def permutation_importance_q(spark, sf_dir):
    return _permuted(spark, sf_dir)[0]


@register("permutation_importance_check", sql=_FRAME_SQL + f""" SELECT feature, TRUE AS measured,
feature IN ({', '.join(repr(c) for c in T.PROTECTED)}) AS protected, TRUE AS rule_kept FROM chosen""")
def permutation_importance_check_q(spark, sf_dir):
    """Every chosen feature is measured; kept are those that cost accuracy, and the protected ones."""
    imp, kept = _permuted(spark, sf_dir)
    protected = F.col("feature").isin(T.PROTECTED)
    return imp.select("feature", (F.col("importance_mean").isNotNull() & (F.col("importance_std") >= 0)).alias("measured"),
                      protected.alias("protected"),
                      (F.col("feature").isin(kept) == ((F.col("importance_mean") > 0) | protected)).alias("rule_kept"))


def _forecast(spark, sf_dir):
    # the forecast refits on every row, so it needs the prepared frame, not the trainval model
    df, cols = _prepared(spark, sf_dir)
    return _shared(spark, sf_dir, "forecast", lambda: T.cut_lineage(T.forecast_from(df, cols, RP.base_trees, RP)))


@register("recursive_forecast")
def recursive_forecast_q(spark, sf_dir):
    return _forecast(spark, sf_dir)


@register("recursive_forecast_check", sql=_FRAME_SQL + f""",
last AS (SELECT series, max(date) AS d, min(demand) AS lo, max(demand) AS hi FROM mf GROUP BY series),
hz AS (SELECT series, d, CAST(unnest(range(1, {RP.horizon + 1})) AS INTEGER) AS h FROM last)
SELECT series, h, CAST(d + to_months(h) AS DATE) AS date, TRUE AS in_range FROM hz""")
def recursive_forecast_check_q(spark, sf_dir):
    """The months of the forecast; trees only give values between those they have seen (as
    far as boosting with small steps overshoots: a tenth of their spread)."""
    df, _ = _prepared(spark, sf_dir)
    seen = df.agg(F.min(P.TARGET).alias("lo"), F.max(P.TARGET).alias("hi"))
    slack = 0.1 * (F.col("hi") - F.col("lo"))
    return _forecast(spark, sf_dir).join(F.broadcast(seen)).select(
        *P.KEYS, "h", "date", F.col("prediction").between(F.col("lo") - slack, F.col("hi") + slack).alias("in_range"))


_STEP = [c for c in FP.macro_cols] + feature_names(FP)[:len(FP.target_lags)] + [FP.ma_name(w) for w in FP.windows]


def _step_sql():
    """First forecast row of each series: its own last months as lags and means, the last
    month's externals, the next month's calendar."""
    past = "row_number() OVER (PARTITION BY series ORDER BY date DESC)"
    lags = ", ".join(f"max(CASE WHEN age = {k} THEN demand END) AS {FP.lag_name(k)}" for k in FP.target_lags)
    means = ", ".join(f"round(avg(CASE WHEN age <= {w} THEN demand END), 4) AS {FP.ma_name(w)}" for w in FP.windows)
    ext = ", ".join(f"max(CASE WHEN age = 1 THEN {c} END) AS {c}" for c in FP.macro_cols)
    return _FRAME_SQL + f""", aged AS (SELECT *, {past} AS age FROM mf)
SELECT series, CAST(max(date) + to_months(1) AS DATE) AS date, {ext}, {lags}, {means},
       round(sin(2 * pi() * month(max(date) + to_months(1)) / 12.0), 9) + 0.0 AS month_sin,
       round(cos(2 * pi() * month(max(date) + to_months(1)) / 12.0), 9) + 0.0 AS month_cos,
       CAST(max(trend) + 1 AS INTEGER) AS trend FROM aged GROUP BY series"""


@register("forecast_first_step", sql=_step_sql())
def forecast_first_step_q(spark, sf_dir):
    """The feature rows the recursive forecast starts from, with every feature it can need."""
    cols = [*FP.macro_cols, *[FP.lag_name(k) for k in FP.target_lags], *[FP.ma_name(w) for w in FP.windows], "month_sin", "month_cos", "trend"]
    step = first_step(QS.model_frame(spark, sf_dir), cols, P.TARGET, P.KEYS)
    digits = {FP.ma_name(w): 4 for w in FP.windows} | {"month_sin": 9, "month_cos": 9}
    return step.select(*P.KEYS, "date", *[F.round(c, digits[c]).alias(c) if c in digits else F.col(c).cast("int").alias(c) if c == "trend" else F.col(c) for c in cols])


@register("model_error_band")
def model_error_band_q(spark, sf_dir):
    """Recursive GBT forecast with its band: prediction ± test MAE·sqrt(h) per series."""
    return _band(spark, sf_dir)


def _band(spark, sf_dir):
    r = _trained(spark, sf_dir)
    mae = r.predictions.filter(F.col("split") == "test").groupBy(*P.KEYS).agg(
        F.avg(F.abs(F.col("y_real") - F.col("y_pred"))).alias("mae"))
    return error_band(_forecast(spark, sf_dir), mae, P.KEYS)


@register("model_error_band_check", sql=_FRAME_SQL + f""",
last AS (SELECT series, max(date) AS d FROM mf GROUP BY series),
hz AS (SELECT series, d, CAST(unnest(range(1, {RP.horizon + 1})) AS INTEGER) AS h FROM last)
SELECT series, h, strftime(CAST(d + to_months(h) AS DATE), '%Y-%m') AS month, TRUE AS around, TRUE AS grows FROM hz""")
def model_error_band_check_q(spark, sf_dir):
    """The band lies around the prediction and widens with the square root of the step."""
    b = T.cut_lineage(_band(spark, sf_dir))
    one = b.filter(F.col("h") == 1).select(*P.KEYS, (F.col("upper") - F.col("prediction")).alias("_one"))
    half = F.col("upper") - F.col("prediction")
    return b.join(one, P.KEYS).select(*P.KEYS, "h", "month", ((F.col("lower") < F.col("prediction")) & (half > 0)).alias("around"),
                                      (F.abs(half - F.col("_one") * F.sqrt("h")) <= 0.2 * F.sqrt("h") + 0.2).alias("grows"))


def _arima_panel(spark, sf_dir):
    """The filled master panel (every month, not only those past the lag warm-up), split by date."""
    from panelcast.operators.splits import temporal_split
    return temporal_split(P.master_panel(spark, sf_dir), T.VAL_START, T.TEST_START)


_ARIMA_SQL = panel_ctes() + f", am AS (SELECT series, date, demand, {QS.SPLIT_SQL} AS split FROM master)"


def _grid(spark, sf_dir):
    df = _arima_panel(spark, sf_dir)
    return _shared(spark, sf_dir, "grid", lambda: T.cut_lineage(SA.arima_grid(df.filter(F.col("split") == "train"), P.KEYS, P.TARGET)))


@register("seasonal_arima_grid")
def seasonal_arima_grid_q(spark, sf_dir):
    return SA.best_orders(_grid(spark, sf_dir), P.KEYS)


@register("seasonal_arima_grid_check", sql=_ARIMA_SQL + f"""
SELECT series, CAST({len(SA.ORDER_GRID)} AS BIGINT) AS n_orders, TRUE AS lowest FROM am GROUP BY series""")
def seasonal_arima_grid_check_q(spark, sf_dir):
    """Every order of the grid is tried for every series, and the chosen one has the lowest AIC."""
    grid = _grid(spark, sf_dir)
    tried = grid.groupBy(*P.KEYS).agg(F.count(F.lit(1)).alias("n_orders"), F.min("aic").alias("_least"))
    best = SA.best_orders(grid, P.KEYS).select(*P.KEYS, "order_id", F.col("aic").alias("_aic"))
    own = grid.select(*P.KEYS, "order_id", F.col("aic").alias("_own"))
    return tried.join(best.join(own, [*P.KEYS, "order_id"]), P.KEYS).select(
        *P.KEYS, "n_orders", ((F.col("_least") == F.col("_aic")) & (F.col("_own") == F.col("_aic"))).alias("lowest"))


def _seasonal(spark, sf_dir):
    return _shared(spark, sf_dir, "seasonal", lambda: T.cut_lineage(SA.arima_forecast(
        _arima_panel(spark, sf_dir), SA.best_orders(_grid(spark, sf_dir), P.KEYS), P.KEYS, P.TARGET)))


@register("seasonal_arima_forecast")
def seasonal_arima_forecast_q(spark, sf_dir):
    return _seasonal(spark, sf_dir)


def _seasonal_x(spark, sf_dir):
    exog = classify_features(_prepared(spark, sf_dir)[1], P.TARGET)[2]
    best = SA.best_orders(_grid(spark, sf_dir), P.KEYS)
    return _shared(spark, sf_dir, "seasonal_x", lambda: T.cut_lineage(SA.arima_forecast(
        feature_table(_arima_panel(spark, sf_dir), FP, drop_null=False), best, P.KEYS, P.TARGET, exog=exog)))


@register("seasonal_arimax_forecast")
def seasonal_arimax_forecast_q(spark, sf_dir):
    """ARIMAX on every external column (neither target nor calendar) that selection keeps."""
    return _seasonal_x(spark, sf_dir)


_SEASONAL_SQL = _ARIMA_SQL + " SELECT series, date, split, demand AS y_real, TRUE AS told FROM am WHERE split <> 'train'"


def _told(df):
    """A prediction, or the reason why there is none."""
    return df.select(*P.KEYS, "date", "split", "y_real", (
        (F.col("y_pred").isNotNull() & F.col("reason").isNull() & (F.col("resid_std") >= 0))
        | (F.col("y_pred").isNull() & F.col("reason").isNotNull())).alias("told"))


@register("seasonal_arima_forecast_check", sql=_SEASONAL_SQL)
def seasonal_arima_forecast_check_q(spark, sf_dir):
    return _told(_seasonal(spark, sf_dir))


@register("seasonal_arimax_forecast_check", sql=_SEASONAL_SQL)
def seasonal_arimax_forecast_check_q(spark, sf_dir):
    return _told(_seasonal_x(spark, sf_dir))


# -- fitted models side by side ----------------------------------------------------

def _fitted(spark, sf_dir):
    """Predictions of the trees and both seasonal models on val and test."""
    trees = _trained(spark, sf_dir).predictions.filter(F.col("split") != "train")
    return {"trees": trees, "seasonal": _seasonal(spark, sf_dir), "seasonal_x": _seasonal_x(spark, sf_dir)}


def _aligned(models):
    return CP.align_predictions(models, [*P.KEYS, "date", "split"])


@register("fitted_model_comparison")
def fitted_model_comparison_q(spark, sf_dir):
    """Errors of the fitted models on the rows that all of them predict, the rows each lacks,
    and the winners by MAPE and by R² of every split."""
    return CP.compare_models(_aligned(_fitted(spark, sf_dir)))


@register("fitted_model_coverage", sql=_FRAME_SQL + f""",
am AS (SELECT series, date, {QS.SPLIT_SQL} AS split FROM master),
c AS (SELECT split, count(*) AS n_support FROM am WHERE split <> 'train' GROUP BY split),
t AS (SELECT split, count(*) AS n FROM mf WHERE split <> 'train' GROUP BY split)
SELECT m.model, c.split, c.n_support, CASE WHEN m.model = 'trees' THEN t.n ELSE c.n_support END AS n_predicted,
       CASE WHEN m.model = 'trees' THEN c.n_support - t.n ELSE 0 END AS n_missing, t.n AS n_common
FROM c JOIN t USING (split), (SELECT unnest(['trees', 'seasonal']) AS model) m""")
def fitted_model_coverage_q(spark, sf_dir):
    """Rows that the comparison of the trees with the seasonal model rests on: of all (series,
    month, split) that either predicts, those each lacks and those both have."""
    models = _fitted(spark, sf_dir)
    return CP.coverage(_aligned({n: models[n] for n in ("trees", "seasonal")}))


@register("fitted_model_winners")
def fitted_model_winners_q(spark, sf_dir):
    """The fitted model with the lowest MAPE and the one with the highest R² on the common rows of each split."""
    return CP.winners(CP.compare_models(_aligned(_fitted(spark, sf_dir))))


# -- sessions ------------------------------------------------------------------------

def _saved(spark, sf_dir):
    """A session with its forecast in a fresh folder: (folder, id, result, forecast)."""
    base = T.sessions_path(spark)
    r = _trained(spark, sf_dir)
    fc = _forecast(spark, sf_dir)
    return base, T.save_session(spark, r, base, fc), r, fc


@register("save_session")
def save_session_q(spark, sf_dir):
    return T.list_sessions(spark, _saved(spark, sf_dir)[0])


@register("save_session_check", sql=_FRAME_SQL + """, b AS (SELECT min(date) AS data_min, max(date) AS data_max FROM mf),
n AS (SELECT count(*) AS n_features FROM chosen), r AS (SELECT count(*) AS n_validation FROM mf)
SELECT data_min, data_max, n_features, n_validation, TRUE AS params_kept FROM b, n, r""")
def save_session_check_q(spark, sf_dir):
    """The manifest row: data range, features, stored rows, and the run parameters as they were."""
    base, sid, r, _ = _saved(spark, sf_dir)
    rows = T.load_validation(spark, base, sid).count()
    return T.list_sessions(spark, base).select("data_min", "data_max", F.size("feature_cols").cast("long").alias("n_features"), F.lit(rows).cast("long").alias("n_validation"),
                                               (F.col("run_params") == F.lit(r.params.to_json())).alias("params_kept"))


def _two_sessions(spark, sf_dir):
    base = T.sessions_path(spark)
    r = _trained(spark, sf_dir)
    return base, [T.save_session(spark, r, base) for _ in range(2)]


@register("list_sessions")
def list_sessions_q(spark, sf_dir):
    return T.list_sessions(spark, _two_sessions(spark, sf_dir)[0])


@register("list_sessions_check", sql=_FRAME_SQL + """, b AS (SELECT max(date) AS data_max FROM mf)
SELECT CAST(unnest(range(0, 2)) AS INTEGER) AS place, data_max, TRUE AS newest_first FROM b""")
def list_sessions_check_q(spark, sf_dir):
    base, ids = _two_sessions(spark, sf_dir)
    listed = [(i, r["session_id"] == ids[1 - i], r["data_max"]) for i, r in enumerate(T.list_sessions(spark, base).collect())]
    return spark.createDataFrame(listed, "place int, newest_first boolean, data_max date")


@register("load_session")
def load_session_q(spark, sf_dir):
    base, sid, *_ = _saved(spark, sf_dir)
    return T.load_session(spark, base, sid, sf_dir).predictions


@register("load_session_check", sql=_FRAME_SQL + " SELECT series, date, split, demand AS y_real, TRUE AS same FROM mf")
def load_session_check_q(spark, sf_dir):
    """Rows rebuilt from the current tables, predicted by the reloaded model, equal the stored ones."""
    base, sid, *_ = _saved(spark, sf_dir)
    now = T.load_session(spark, base, sid, sf_dir).predictions
    before = T.load_validation(spark, base, sid).select(*P.KEYS, "date", F.col("y_pred").alias("_before"))
    return now.join(before, [*P.KEYS, "date"], "full").select(*P.KEYS, "date", "split", "y_real", F.col("y_pred").eqNullSafe(F.col("_before")).alias("same"))


@register("session_forecast_check", sql=_FRAME_SQL + f""", last AS (SELECT series, max(date) AS d FROM mf GROUP BY series),
hz AS (SELECT series, d, CAST(unnest(range(1, {RP.horizon + 1})) AS INTEGER) AS h FROM last)
SELECT series, h, CAST(d + to_months(h) AS DATE) AS date, TRUE AS same FROM hz""")
def session_forecast_check_q(spark, sf_dir):
    """A forecast made from the reloaded session equals the stored one."""
    base, sid, *_ = _saved(spark, sf_dir)
    again = T.forecast(T.load_session(spark, base, sid, sf_dir))
    stored = T.load_forecast(spark, base, sid).select(*P.KEYS, "h", F.col("prediction").alias("_stored"))
    return again.join(stored, [*P.KEYS, "h"], "full").select(*P.KEYS, "h", "date", F.col("prediction").eqNullSafe(F.col("_stored")).alias("same"))
