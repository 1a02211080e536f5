"""Registered queries: correlations, selection, splits, folds, metrics, residual views.

Predictions here come from baseline forecasters that need no fitting (last
value, shifted 3-month mean, value three months back), so every metric and
residual view is checkable in SQL; the fitted-model variants live in
``q_model``. Revenue is expressed in millions in the model frame so squared
errors stay in a range where float sums are stable to the reported digits.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.operators import features as FE
from panelcast.operators import stats as ST
from panelcast.operators.forecast_table import error_band, freeze_last_row, horizon_rows
from panelcast.operators.splits import split_checks, temporal_split, walk_forward_folds
from panelcast.plans import panels as P
from panelcast.plans import sqlgen as S
from panelcast.plans.oracle_panels import feature_names, features_cte, panel_ctes
from panelcast.plans.q_windows import FP
from panelcast.plans.registry import register

VAL_START, TEST_START = "1999-01-01", "2000-08-01"
N_FOLDS, FOLD_SIZE = 8, 6
SCALE = 1e6
COLLINEAR_T, TARGET_CORR_T = 0.9, 0.05
BASELINES = {"naive": FP.lag_name(1), "ma3": FP.ma_name(3), "lag3": FP.lag_name(3)}
HORIZON = 12

# ---------------------------------------------------------------- Spark side


def model_frame(spark, sf_dir):
    """Feature table with the split label; every month the tables hold."""
    feat = FE.feature_table(P.master_panel(spark, sf_dir), FP)
    return temporal_split(feat, VAL_START, TEST_START)


def baseline_predictions(spark, sf_dir, models=None):
    mf = model_frame(spark, sf_dir)
    # one row per (row, model) from a single pass over the frame
    preds = F.array(*[F.struct(F.lit(m).alias("model"), (F.col(col) / F.lit(SCALE)).alias("y_pred"))
                      for m, col in BASELINES.items() if models is None or m in models])
    return mf.select("series", "date", "split", (F.col(FP.target) / F.lit(SCALE)).alias("y_real"),
                     F.inline(preds)).select("series", "date", "split", "model", "y_real", "y_pred")


# ------------------------------------------------------------------ SQL side

SPLIT_SQL = (f"CASE WHEN date < DATE '{VAL_START}' THEN 'train' "
             f"WHEN date < DATE '{TEST_START}' THEN 'val' ELSE 'test' END")
MF_SQL = (panel_ctes() + ", " + features_cte(FP)
          + f", mf AS (SELECT *, {SPLIT_SQL} AS split FROM feat)")


def preds_sql(models=None) -> str:
    parts = [f"SELECT series, date, split, '{m}' AS model, demand / 1e6 AS y_real, {c} / 1e6 AS y_pred FROM mf"
             for m, c in BASELINES.items() if models is None or m in models]
    return MF_SQL + ", preds AS (" + " UNION ALL ".join(parts) + ")"


def metrics_sql(group: list[str]) -> str:
    g = ", ".join(group)
    e = "(y_real - y_pred)"
    # "+ 0.0" turns a rounded -0.0 into 0.0 (Spark's round never yields -0.0)
    return (f"SELECT {g}, round(1 - sum({e} * {e}) / nullif(var_pop(y_real) * count(y_real), 0), 4) + 0.0 AS r2, "
            f"round(avg({e} * {e}), 4) + 0.0 AS mse, round(avg(abs({e})), 4) + 0.0 AS mae, "
            f"round(avg(abs({e}) / greatest(abs(y_real), {ST.MAPE_EPS!r})), 4) + 0.0 AS mape "
            f"FROM preds GROUP BY {g}")


# ------------------------------------------------------------ registrations

@register("temporal_split", sql=MF_SQL + " SELECT series, date, split FROM mf")
def temporal_split_q(spark, sf_dir):
    return model_frame(spark, sf_dir).select("series", "date", "split")


_PROFILE_SQL = MF_SQL + """ SELECT split, count(*) AS n_rows, min(date) AS date_min, max(date) AS date_max
FROM mf GROUP BY split"""


@register("split_profile", sql=_PROFILE_SQL)
def split_profile_q(spark, sf_dir):
    return ST.split_profile(model_frame(spark, sf_dir))


@register("split_checks", sql=_PROFILE_SQL)
def split_checks_q(spark, sf_dir):
    return split_checks(model_frame(spark, sf_dir))


_FOLDS_SQL = MF_SQL + f""",
tv AS (SELECT series, date, demand, demand_lag_1,
              row_number() OVER (PARTITION BY series ORDER BY date) - 1 AS idx,
              count(*) OVER (PARTITION BY series) AS n FROM mf WHERE split <> 'test'),
fx AS (SELECT tv.*, CAST(fi.fold AS INTEGER) AS fold, n - ({N_FOLDS} - fi.fold) * {FOLD_SIZE} AS start
       FROM tv JOIN (SELECT unnest(range(0, {N_FOLDS})) AS fold) fi ON TRUE),
folds AS (SELECT series, date, demand, demand_lag_1, fold,
                 CASE WHEN idx < start THEN 'train' ELSE 'test' END AS role, CAST(NULL AS VARCHAR) AS reason
          FROM fx WHERE idx < start + {FOLD_SIZE} AND n > {N_FOLDS * FOLD_SIZE}
          UNION ALL
          SELECT series, max(date), NULL, NULL, NULL, NULL, 'too short for the folds: ' || count(*) FILTER (split <> 'test')
                 || ' trainval rows, {N_FOLDS} folds of {FOLD_SIZE} need {N_FOLDS * FOLD_SIZE + 1}'
          FROM mf GROUP BY series HAVING count(*) FILTER (split <> 'test') <= {N_FOLDS * FOLD_SIZE})"""


def _folds(spark, sf_dir):
    return walk_forward_folds(model_frame(spark, sf_dir), N_FOLDS, FOLD_SIZE, P.KEYS)


@register("walk_forward_folds", sql=_FOLDS_SQL + " SELECT series, date, fold, role, reason FROM folds")
def walk_forward_folds_q(spark, sf_dir):
    return _folds(spark, sf_dir).select("series", "date", "fold", "role", "reason")


@register("fold_summary", sql=_FOLDS_SQL + f""",
fm AS (SELECT fold, avg(abs(demand - demand_lag_1) / greatest(abs(demand), {ST.MAPE_EPS!r})) AS mape
       FROM folds WHERE role = 'test' GROUP BY fold)
SELECT round(avg(mape), 6) AS mape_mean, round(stddev_pop(mape), 6) AS mape_std, count(mape) AS n_folds FROM fm""")
def fold_summary_q(spark, sf_dir):
    f = _folds(spark, sf_dir).filter(F.col("role") == "test")
    y, p = F.col(FP.target), F.col(FP.lag_name(1))
    per_fold = f.groupBy("fold").agg(
        F.avg(F.abs(y - p) / F.greatest(F.abs(y), F.lit(ST.MAPE_EPS))).alias("mape"))
    out = ST.fold_summary(per_fold, "mape")
    return out.withColumns({c: F.round(c, 6) for c in ("mape_mean", "mape_std")})


@register("regression_metrics", sql=preds_sql(["naive"]) + " " + metrics_sql(["split"]))
def regression_metrics_q(spark, sf_dir):
    return ST.regression_metrics(baseline_predictions(spark, sf_dir, ["naive"]), group=["split"])


def _comparison(spark, sf_dir):
    return ST.regression_metrics(baseline_predictions(spark, sf_dir), group=["model", "split"])


@register("model_comparison", sql=preds_sql() + " " + metrics_sql(["model", "split"]))
def model_comparison_q(spark, sf_dir):
    return _comparison(spark, sf_dir)


@register("best_by", sql=preds_sql() + f""", mc AS ({metrics_sql(['model', 'split'])})
SELECT split, arg_min(model, mape) AS best_low, arg_max(model, mape) AS best_high FROM mc GROUP BY split""")
def best_by_q(spark, sf_dir):
    return ST.best_by(_comparison(spark, sf_dir), "model", "mape", group=["split"])


@register("residuals", sql=MF_SQL + """
SELECT series, date, split, demand - demand_lag_1 AS residual FROM mf""")
def residuals_q(spark, sf_dir):
    mf = model_frame(spark, sf_dir)
    return mf.select("series", "date", "split", (F.col(FP.target) - F.col(FP.lag_name(1))).alias("residual"))


def _naive_resid(spark, sf_dir):
    pr = baseline_predictions(spark, sf_dir, ["naive"])
    return pr.withColumn("residual", F.col("y_real") - F.col("y_pred"))


_POS = ("CASE WHEN i = n THEN pow(0.5, 1.0 / n) WHEN i = 1 THEN 1.0 - pow(0.5, 1.0 / n) "
        "ELSE (i - 0.3175) / (n + 0.365) END")


@register("qq_points", sql=preds_sql(["naive"]) + f""",
r AS (SELECT series, split, y_real - y_pred AS ordered,
             row_number() OVER (PARTITION BY series, split ORDER BY y_real - y_pred) AS i,
             count(*) OVER (PARTITION BY series, split) AS n FROM preds),
pts AS (SELECT series, split, CAST(i AS INTEGER) AS i, ordered, {S.norm_ppf('(' + _POS + ')')} AS theoretical FROM r),
fit AS (SELECT series, split, regr_slope(ordered, theoretical) AS slope,
               regr_intercept(ordered, theoretical) AS intercept FROM pts GROUP BY series, split)
SELECT pts.series, pts.split, i, round(theoretical, 9) + 0.0 AS theoretical, round(ordered, 9) + 0.0 AS ordered,
       round(slope, 6) + 0.0 AS slope, round(intercept, 6) + 0.0 AS intercept
FROM pts JOIN fit ON pts.series = fit.series AND pts.split = fit.split""")
def qq_points_q(spark, sf_dir):
    # one Q-Q plot per series and split: every window group is one series' months
    out = ST.qq_points(_naive_resid(spark, sf_dir), "residual", group=["series", "split"])
    return out.select("series", "split", "i", F.round("theoretical", 9).alias("theoretical"),
                      F.round("ordered", 9).alias("ordered"), F.round("slope", 6).alias("slope"),
                      F.round("intercept", 6).alias("intercept"))


@register("qq_points_overall", sql=preds_sql(["naive"]) + f""",
r AS (SELECT y_real - y_pred AS ordered, row_number() OVER (ORDER BY y_real - y_pred) AS i, count(*) OVER () AS n FROM preds),
pts AS (SELECT CAST(i AS INTEGER) AS i, ordered, {S.norm_ppf('(' + _POS + ')')} AS theoretical FROM r),
fit AS (SELECT regr_slope(ordered, theoretical) AS slope, regr_intercept(ordered, theoretical) AS intercept FROM pts)
SELECT i, round(theoretical, 9) + 0.0 AS theoretical, round(ordered, 9) + 0.0 AS ordered,
       round(slope, 6) + 0.0 AS slope, round(intercept, 6) + 0.0 AS intercept FROM pts, fit""")
def qq_points_overall_q(spark, sf_dir):
    """One Q-Q plot of all residuals, ranked over all partitions."""
    out = ST.qq_points(_naive_resid(spark, sf_dir), "residual")
    return out.select("i", *[F.round(c, d).alias(c) for c, d in (("theoretical", 9), ("ordered", 9), ("slope", 6), ("intercept", 6))])


@register("histogram", sql=preds_sql(["naive"]) + """,
r AS (SELECT split, y_real - y_pred AS x FROM preds),
b AS (SELECT split, min(x) AS lo, max(x) AS hi FROM r GROUP BY split),
c AS (SELECT r.split, CAST(CASE WHEN b.hi = b.lo THEN 1 ELSE least(floor(10 * (r.x - b.lo) / (b.hi - b.lo)) + 1, 10) END AS INTEGER) AS bin,
             count(*) AS cnt FROM r JOIN b ON r.split = b.split GROUP BY 1, 2),
g AS (SELECT split, lo, hi, CAST(unnest(range(1, 11)) AS INTEGER) AS bin FROM b)
SELECT g.split, g.bin, round(g.lo + (g.bin - 1) * ((g.hi - g.lo) / 10.0), 9) + 0.0 AS lower,
       round(g.lo + g.bin * ((g.hi - g.lo) / 10.0), 9) + 0.0 AS upper, coalesce(c.cnt, 0) AS count
FROM g LEFT JOIN c ON g.split = c.split AND g.bin = c.bin""")
def histogram_q(spark, sf_dir):
    h = ST.histogram(_naive_resid(spark, sf_dir), "residual", 10, group=["split"])
    return h.withColumns({"lower": F.round("lower", 9), "upper": F.round("upper", 9)})


@register("value_bounds", sql=preds_sql(["naive"]) + """
SELECT split, least(min(y_real), min(y_pred)) AS lo, greatest(max(y_real), max(y_pred)) AS hi
FROM preds GROUP BY split""")
def value_bounds_q(spark, sf_dir):
    return ST.value_bounds(baseline_predictions(spark, sf_dir, ["naive"]), "y_real", "y_pred",
                           group=["split"])


# -- correlations -------------------------------------------------------------
_CORR_COLS = [P.TARGET] + P.FEATURE_COLS


def _corr_pairs_sql(cols, keys, src):
    k = "".join(f"{c}, " for c in keys)
    grp = f" GROUP BY {', '.join(keys)}" if keys else ""
    sel = []
    for i in range(len(cols)):
        for j in range(i + 1, len(cols)):
            sel.append(f"SELECT {k}'{cols[i]}' AS col_i, '{cols[j]}' AS col_j, {i} AS pos_i, {j} AS pos_j, "
                       f"{S.pair_corr(cols[i], cols[j])} AS corr FROM {src}{grp}")
    return " UNION ALL ".join(sel)


@register("correlation_matrix", sql=panel_ctes() + f""", up AS ({_corr_pairs_sql(_CORR_COLS, ['series'], 'master')})
SELECT series, col_i, col_j, CAST(pos_i AS INTEGER) AS pos_i, CAST(pos_j AS INTEGER) AS pos_j, round(corr, 6) + 0.0 AS corr FROM up
UNION ALL
SELECT series, col_j AS col_i, col_i AS col_j, CAST(pos_j AS INTEGER) AS pos_i, CAST(pos_i AS INTEGER) AS pos_j,
       round(corr, 6) + 0.0 AS corr FROM up""")
def correlation_matrix_q(spark, sf_dir):
    cm = ST.correlation_matrix(P.master_panel(spark, sf_dir), _CORR_COLS, keys=P.KEYS)
    return cm.withColumn("corr", F.round("corr", 6))


@register("corr_with_target", sql=panel_ctes() + " " + " UNION ALL ".join(
    f"SELECT series, '{c}' AS feature, round(abs({S.pair_corr(c, P.TARGET)}), 6) AS corr_abs "
    f"FROM master GROUP BY series" for c in P.FEATURE_COLS))
def corr_with_target_q(spark, sf_dir):
    ct = ST.corr_with_target(P.master_panel(spark, sf_dir), P.TARGET, P.FEATURE_COLS, keys=P.KEYS)
    return ct.withColumn("corr_abs", F.round("corr_abs", 6))


# The driver tables are synthetic and nearly uncorrelated, so the 0.9 default
# would select nothing; 0.5 exercises the rule that a column is dropped when any
# *earlier* column passes the bar, even one that is itself dropped.
COLLINEAR_T_DATA = 0.5


def _feature_list():
    return [c for c in P.FEATURE_COLS + feature_names(FP)]


@register("drop_collinear", sql=panel_ctes() + ", " + features_cte(FP)
          + f""", up AS ({_corr_pairs_sql(_feature_list(), [], 'feat')}),
gone AS (SELECT col_j FROM up WHERE abs(corr) > {COLLINEAR_T_DATA} GROUP BY col_j)
SELECT * FROM (""" + " UNION ALL ".join(f"SELECT '{c}' AS column, count({c}) AS n_values FROM feat" for c in _feature_list())
          + ') WHERE "column" NOT IN (SELECT col_j FROM gone)')
def drop_collinear_q(spark, sf_dir):
    feat = FE.feature_table(P.master_panel(spark, sf_dir), FP)
    kept, _ = FE.drop_collinear(feat.select(*P.KEYS, "date", P.TARGET, *_feature_list()),
                                P.TARGET, COLLINEAR_T_DATA, exclude=P.KEYS)
    cols = [c for c in _feature_list() if c in kept.columns]
    counts = kept.agg(*[F.count(c).alias(c) for c in cols])
    return counts.unpivot([], cols, "column", "n_values")


@register("filter_by_target_corr", sql=panel_ctes() + ", " + features_cte(FP)
          + ", tv AS (SELECT * FROM feat WHERE date < DATE '" + TEST_START + "'), ct AS ("
          + " UNION ALL ".join(f"SELECT '{c}' AS feature, abs({S.pair_corr(c, P.TARGET)}) AS corr_abs FROM tv"
                               for c in _feature_list())
          + f") SELECT feature, round(corr_abs, 6) AS corr_abs FROM ct WHERE corr_abs >= {TARGET_CORR_T}")
def filter_by_target_corr_q(spark, sf_dir):
    feat = FE.feature_table(P.master_panel(spark, sf_dir), FP)
    ct = FE.target_corr_table(feat, FP, TEST_START, _feature_list())
    return ct.filter(F.col("corr_abs") >= F.lit(TARGET_CORR_T)).withColumn("corr_abs", F.round("corr_abs", 6))


@register("top_bottom_corr", sql=panel_ctes() + ", " + features_cte(FP)
          + f", up AS ({_corr_pairs_sql(_feature_list(), [], 'feat')}), "
          + """nn AS (SELECT * FROM up WHERE corr IS NOT NULL),
t AS (SELECT col_i, col_j, round(corr, 6) + 0.0 AS corr, 'top' AS side FROM nn ORDER BY corr DESC, col_i, col_j LIMIT 15),
b AS (SELECT col_i, col_j, round(corr, 6) + 0.0 AS corr, 'bottom' AS side FROM nn ORDER BY corr ASC, col_i, col_j LIMIT 15)
SELECT * FROM t UNION ALL SELECT * FROM b""")
def top_bottom_corr_q(spark, sf_dir):
    feat = FE.feature_table(P.master_panel(spark, sf_dir), FP)
    cm = ST.correlation_matrix(feat, _feature_list(), upper_only=True).filter(F.col("corr").isNotNull())
    top = cm.orderBy(F.col("corr").desc(), "col_i", "col_j").limit(15).withColumn("side", F.lit("top"))
    bot = cm.orderBy(F.col("corr").asc(), "col_i", "col_j").limit(15).withColumn("side", F.lit("bottom"))
    return top.unionByName(bot).select("col_i", "col_j", F.round("corr", 6).alias("corr"), "side")


@register("null_profile", sql=panel_ctes(fill=False) + " SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100.0, 6) AS pct_null FROM merged"
    for c in ["series", "date", "demand"] + P.FEATURE_COLS) + ") WHERE pct_null > 0")
def null_profile_q(spark, sf_dir):
    np_ = ST.null_profile(P.master_panel(spark, sf_dir, fill=False))
    return np_.withColumn("pct_null", F.round("pct_null", 6))


# -- forecast tables ------------------------------------------------------------
_EXT = ["qty_a", "price_mean", "rev_p1"]


@register("freeze_last_row", sql=panel_ctes() + f"""
SELECT series, max(date) AS last_date, {', '.join(f'arg_max({c}, date) AS {c}' for c in _EXT)}
FROM master GROUP BY series""")
def freeze_last_row_q(spark, sf_dir):
    return freeze_last_row(P.master_panel(spark, sf_dir), _EXT, P.KEYS)


@register("error_band", sql=preds_sql(["naive"]) + f""",
mae AS (SELECT series, avg(abs(y_real - y_pred)) AS mae FROM preds WHERE split = 'test' GROUP BY series),
last AS (SELECT series, max(date) AS last_date, arg_max(demand / 1e6, date) AS prediction FROM mf GROUP BY series),
hz AS (SELECT last.*, CAST(unnest(range(1, {HORIZON + 1})) AS INTEGER) AS h FROM last)
SELECT hz.series, hz.h, strftime(CAST(hz.last_date + to_months(hz.h) AS DATE), '%Y-%m') AS month,
       round(prediction, 1) + 0.0 AS prediction, round(prediction - mae * sqrt(h), 1) + 0.0 AS lower,
       round(prediction + mae * sqrt(h), 1) + 0.0 AS upper
FROM hz LEFT JOIN mae ON hz.series = mae.series""")
def error_band_q(spark, sf_dir):
    pr = baseline_predictions(spark, sf_dir, ["naive"])
    mae = pr.filter(F.col("split") == "test").groupBy("series").agg(
        F.avg(F.abs(F.col("y_real") - F.col("y_pred"))).alias("mae"))
    mf = model_frame(spark, sf_dir).withColumn("prediction", F.col(FP.target) / F.lit(SCALE))
    last = freeze_last_row(mf, ["prediction"], P.KEYS)
    fc = horizon_rows(last, HORIZON)
    return error_band(fc, mae, P.KEYS)



@register("model_winners", sql=preds_sql() + f""", mc AS ({metrics_sql(['model', 'split'])})
SELECT split, arg_min(model, mape) AS best_mape_model, arg_max(model, r2) AS best_r2_model FROM mc GROUP BY split""")
def model_winners_q(spark, sf_dir):
    """Winner per split by MAPE (lowest) and by R² (highest) over the comparison table."""
    mc = _comparison(spark, sf_dir)
    by_mape = ST.best_by(mc, "model", "mape", group=["split"]).select("split", F.col("best_low").alias("best_mape_model"))
    by_r2 = ST.best_by(mc, "model", "r2", group=["split"]).select("split", F.col("best_high").alias("best_r2_model"))
    return by_mape.join(by_r2, "split")
