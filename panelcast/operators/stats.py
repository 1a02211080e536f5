"""Statistics over panels: correlations, NULL profile, error metrics, histograms, Q-Q.

Everything is one (or a few) aggregate passes with map-side partial
aggregation; per-series variants just add the keys to ``groupBy``.
Pearson correlations use pairwise-complete rows, and a constant column gives
NULL (pandas gives NaN) instead of an ANSI divide-by-zero error.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.operators.ranks import global_rank

def pair_moments(df: DataFrame, cols: list[str], pairs: list[tuple[int, int]],
                 keys: list[str] | None = None) -> DataFrame:
    """Pearson r for the given column-index pairs, one aggregate over a long form.

    Each row becomes one (pos_i, pos_j, x, y) entry per pair through a
    higher-order ``transform`` over a literal pair list (small generated code
    whatever the number of pairs); rows where either side is NULL are dropped
    (pairwise-complete), then ``groupBy(keys, pair)`` with map-side partial
    aggregation. Output: (keys, pos_i, pos_j, col_i, col_j, corr)."""
    keys = list(keys or [])
    vals = df.select(*keys, F.array(*[F.col(f"`{c}`").cast("double") for c in cols]).alias("_v"))
    prs = F.arrays_zip(F.lit([i for i, _ in pairs]).alias("i"), F.lit([j for _, j in pairs]).alias("j"))
    long = vals.select(*keys, F.inline(F.transform(prs, lambda p: F.struct(
        p["i"].alias("pos_i"), p["j"].alias("pos_j"),
        F.element_at("_v", p["i"] + 1).alias("x"), F.element_at("_v", p["j"] + 1).alias("y")))))
    long = long.filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    names = F.lit(list(cols))
    out = long.groupBy(*keys, "pos_i", "pos_j").agg(
        F.try_divide(F.covar_pop("x", "y"), F.stddev_pop("x") * F.stddev_pop("y")).alias("corr"))
    return out.select(*keys, F.element_at(names, F.col("pos_i") + 1).alias("col_i"),
                      F.element_at(names, F.col("pos_j") + 1).alias("col_j"),
                      "pos_i", "pos_j", "corr")


def correlation_matrix(df: DataFrame, cols: list[str], keys: list[str] | None = None,
                       upper_only: bool = False) -> DataFrame:
    """Long correlation matrix ``(keys, col_i, col_j, pos_i, pos_j, corr)``.

    ``pos_*`` are positions in ``cols``; ``upper_only`` keeps ``i < j``."""
    keys = list(keys or [])
    long = pair_moments(df, cols, list(combinations(range(len(cols)), 2)), keys)
    if upper_only:
        return long
    # both orientations from one pass (an explode, not a union that would recompute the input)
    both = F.array(F.struct("col_i", "col_j", "pos_i", "pos_j", "corr"),
                   F.struct(F.col("col_j").alias("col_i"), F.col("col_i").alias("col_j"),
                            F.col("pos_j").alias("pos_i"), F.col("pos_i").alias("pos_j"), "corr"))
    return long.select(*keys, F.inline(both))


def corr_with_target(df: DataFrame, target: str, features: list[str],
                     keys: list[str] | None = None) -> DataFrame:
    """``(keys, feature, corr_abs)`` sorted by |r| descending."""
    keys = list(keys or [])
    cols = list(features) + [target]
    t = len(features)
    long = pair_moments(df, cols, [(i, t) for i in range(t)], keys)
    return long.select(*keys, F.col("col_i").alias("feature"), F.abs("corr").alias("corr_abs")) \
               .orderBy(*keys, F.col("corr_abs").desc_nulls_last())


def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Percent NULL per column; only non-zero ones, highest first.

    One pass over a long form (column, is-NULL flag) built by a higher-order
    ``transform``, aggregated per column: the cost does not grow with extra
    chunks or joins when the table is wide."""
    cols = list(cols or df.columns)
    flags = df.select(F.array(*[F.col(f"`{c}`").isNull() for c in cols]).alias("_f"))
    long = flags.select(F.posexplode("_f").alias("_i", "_null"))
    out = long.groupBy("_i").agg((F.avg(F.col("_null").cast("double")) * F.lit(100.0)).alias("pct_null"))
    out = out.select(F.element_at(F.lit(cols), F.col("_i") + 1).alias("column"), "pct_null")
    return out.filter(F.col("pct_null") > 0).orderBy(F.col("pct_null").desc(), "column")


# Smallest positive double step used as the MAPE floor on |y| (numpy float64 eps).
MAPE_EPS = 2.220446049250313e-16


def regression_metrics(df: DataFrame, label: str = "y_real", prediction: str = "y_pred",
                       group: list[str] | None = None, digits: int = 4) -> DataFrame:
    """R², MSE, MAE, MAPE per group (e.g. split), rounded to ``digits``.

    R² = 1 - SSE/SST; MAPE is a fraction, |y| floored at a tiny epsilon."""
    y, p = F.col(label), F.col(prediction)
    err = y - p
    sse = F.sum(err * err)
    sst = F.var_pop(y) * F.count(y)
    metrics = {
        "r2": F.lit(1.0) - F.try_divide(sse, sst),
        "mse": F.avg(err * err),
        "mae": F.avg(F.abs(err)),
        "mape": F.avg(F.abs(err) / F.greatest(F.abs(y), F.lit(MAPE_EPS))),
    }
    g = list(group or [])
    out = (df.groupBy(*g) if g else df.groupBy()).agg(*[e.alias(n) for n, e in metrics.items()])
    return out.withColumns({n: F.round(n, digits) for n in metrics})


def fold_summary(fold_scores: DataFrame, score: str = "mape", group: list[str] | None = None) -> DataFrame:
    g = list(group or [])
    return (fold_scores.groupBy(*g) if g else fold_scores.groupBy()).agg(
        F.avg(score).alias(f"{score}_mean"), F.stddev_pop(score).alias(f"{score}_std"),
        F.count(score).alias("n_folds"))


def split_profile(df: DataFrame, split: str = "split", date: str = "date",
                  keys: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(keys or []), split).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(date).alias("date_min"), F.max(date).alias("date_max"))


def best_by(df: DataFrame, label: str, score: str, group: list[str] | None = None) -> DataFrame:
    """Label with the lowest and with the highest score (per group)."""
    g = list(group or [])
    return (df.groupBy(*g) if g else df.groupBy()).agg(
        F.min_by(label, score).alias("best_low"), F.max_by(label, score).alias("best_high"))


def histogram(df: DataFrame, col: str, bins: int, group: list[str] | None = None) -> DataFrame:
    """Equal-width bin counts between min and max; the max falls in the last bin.

    Every bin is emitted (empty ones with 0). The min/max row per group is
    joined back on the group key (one row per group, a proven bound)."""
    g = list(group or [])
    x = F.col(col)
    bounds = (df.groupBy(*g) if g else df.groupBy()).agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    jk = g if g else ["_one"]
    if not g:
        # a global aggregate is exactly one row: broadcast it instead of shuffling
        # every row to the single value of a constant join key
        bounds = F.broadcast(bounds.withColumn("_one", F.lit(1)))
        df = df.withColumn("_one", F.lit(1))
    b = df.filter(x.isNotNull()).join(bounds, jk).select(
        *jk, F.when(F.col("_hi") == F.col("_lo"), F.lit(1)).otherwise(
            F.least(F.width_bucket(x, F.col("_lo"), F.col("_hi"), F.lit(bins)), F.lit(bins))
        ).cast("int").alias("bin"))
    counts = b.groupBy(*jk, "bin").agg(F.count(F.lit(1)).alias("count"))
    grid = bounds.select(*jk, "_lo", "_hi", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    out = grid.join(counts, jk + ["bin"], "left").select(
        *g, "bin",
        (F.col("_lo") + (F.col("bin") - 1) * width).alias("lower"),
        (F.col("_lo") + F.col("bin") * width).alias("upper"),
        F.coalesce(F.col("count"), F.lit(0)).alias("count"))
    return out


def value_bounds(df: DataFrame, a: str, b: str, group: list[str] | None = None) -> DataFrame:
    g = list(group or [])
    return (df.groupBy(*g) if g else df.groupBy()).agg(
        F.least(F.min(a), F.min(b)).alias("lo"), F.greatest(F.max(a), F.max(b)).alias("hi"))


# --- fixed values: published coefficients of the inverse normal CDF ----------
# (Wichura 1988, algorithm AS 241, PPND16), in the order printed there.
_A = [3.387132872796366608, 133.14166789178437745, 1971.5909503065514427,
      13731.693765509461125, 45921.953931549871457, 67265.770927008700853,
      33430.575583588128105, 2509.0809287301226727]
_B = [1.0, 42.313330701600911252, 687.1870074920579083, 5394.1960214247511077,
      21213.794301586595867, 39307.89580009271061, 28729.085735721942674,
      5226.495278852545925]
_C = [1.42343711074968357734, 4.6303378461565452959, 5.7694972214606914055,
      3.64784832476320460504, 1.27045825245236838258, 0.24178072517745061177,
      0.0227238449892691845833, 7.7454501427834140764e-4]
_D = [1.0, 2.05319162663775882187, 1.6763848301838038494, 0.68976733498510000455,
      0.14810397642748007459, 0.0151986665636164571966, 5.475938084995344946e-4,
      1.05075007164441684324e-9]
_E = [6.6579046435011037772, 5.4637849111641143699, 1.7848265399172913358,
      0.29656057182850489123, 0.026532189526576123093, 0.0012426609473880784386,
      2.71155556874348757815e-5, 2.01033439929228813265e-7]
_F = [1.0, 0.59983220655588793769, 0.13692988092273580531, 0.0148753612908506148525,
      7.868691311456132591e-4, 1.8463183175100546818e-5, 1.4215117583164458887e-7,
      2.04426310338993978564e-15]


def _poly(coef: list[float], x: Column) -> Column:
    acc = F.lit(coef[-1])
    for c in reversed(coef[:-1]):
        acc = acc * x + F.lit(c)
    return acc


def norm_ppf(p: Column) -> Column:
    """Quantile of N(0,1) as a column expression (relative accuracy ~1e-16)."""
    q = p - F.lit(0.5)
    r_central = F.lit(0.180625) - q * q
    central = q * _poly(_A, r_central) / _poly(_B, r_central)
    r = F.sqrt(-F.log(F.least(p, F.lit(1.0) - p)))
    r1 = r - F.lit(1.6)
    r2 = r - F.lit(5.0)
    tail = F.when(r <= F.lit(5.0), _poly(_C, r1) / _poly(_D, r1)).otherwise(_poly(_E, r2) / _poly(_F, r2))
    tail = F.when(q < 0, -tail).otherwise(tail)
    return F.when(F.abs(q) <= F.lit(0.425), central).otherwise(tail)


def qq_points(df: DataFrame, value: str, group: list[str] | None = None) -> DataFrame:
    """Normal probability plot points (Filliben positions) and the fitted line.

    Output: (group, i, theoretical, ordered, slope, intercept). Without a group the values
    are ranked over all partitions, not in one task."""
    from pyspark.sql import Window
    g = list(group or [])
    there = df.filter(F.col(value).isNotNull()).select(*g, F.col(value).alias("ordered"))
    if g:
        w = Window.partitionBy(*g)
        ranked = there.select("*", F.row_number().over(w.orderBy("ordered")).alias("i"), F.count(F.lit(1)).over(w).alias("n"))
    else:
        ranked, n = global_rank(there, ["ordered"], "i")
        ranked = ranked.withColumn("n", F.lit(n))
    last = F.pow(F.lit(0.5), F.lit(1.0) / F.col("n"))
    pos = (F.when(F.col("i") == F.col("n"), last)
           .when(F.col("i") == 1, F.lit(1.0) - last)
           .otherwise((F.col("i") - F.lit(0.3175)) / (F.col("n") + F.lit(0.365))))
    pts = ranked.withColumn("theoretical", norm_ppf(pos))
    fit = pts.groupBy(*g).agg(
        F.regr_slope("ordered", "theoretical").alias("slope"),
        F.regr_intercept("ordered", "theoretical").alias("intercept"))
    both = pts.join(fit, g) if g else pts.join(F.broadcast(fit))        # one row
    return both.select(*g, "i", "theoretical", "ordered", "slope", "intercept")
