"""Statistics, splits, folds and validation."""

import datetime as dt
import math
import random
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.operators import stats as ST
from panelcast.operators.quality import validate_output, validation_report
from panelcast.operators.splits import fold_table, split_checks, temporal_split, walk_forward_folds


def months(n):
    return [dt.date(2020 + i // 12, i % 12 + 1, 1) for i in range(n)]


def test_pairwise_complete_corr_and_constant(spark):
    data = [(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, None, 5.0), (4.0, 8.2, 5.0)]
    df = spark.createDataFrame(data, "a double, b double, k double")
    cm = {(r["col_i"], r["col_j"]): r["corr"] for r in ST.correlation_matrix(df, ["a", "b", "k"]).collect()}
    x, y = np.array([1, 2, 4.0]), np.array([2, 4.1, 8.2])
    assert math.isclose(cm[("a", "b")], np.corrcoef(x, y)[0, 1], rel_tol=1e-12)
    assert cm[("a", "k")] is None and cm[("b", "a")] == cm[("a", "b")]


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 1)], "a int, b int")
    r = ST.null_profile(df).collect()
    assert [(x["column"], round(x["pct_null"], 4)) for x in r] == [("b", 66.6667)]


def test_regression_metrics_match_numpy(spark):
    rng = random.Random(1)
    y = [rng.uniform(50, 150) for _ in range(40)]
    p = [v + rng.gauss(0, 5) for v in y]
    df = spark.createDataFrame(list(zip(y, p)), "y_real double, y_pred double")
    m = ST.regression_metrics(df).collect()[0]
    ya, pa = np.array(y), np.array(p)
    assert m["mse"] == round(float(np.mean((ya - pa) ** 2)), 4)
    assert m["mae"] == round(float(np.mean(np.abs(ya - pa))), 4)
    assert m["mape"] == round(float(np.mean(np.abs(ya - pa) / np.abs(ya))), 4)
    r2 = 1 - np.sum((ya - pa) ** 2) / np.sum((ya - ya.mean()) ** 2)
    assert m["r2"] == round(float(r2), 4)


def test_histogram_max_in_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "x double")
    h = {r["bin"]: r["count"] for r in ST.histogram(df, "x", 5).collect()}
    assert sum(h.values()) == 11 and set(h) == {1, 2, 3, 4, 5} and h[5] == 3


def test_qq_points_positions(spark):
    df = spark.createDataFrame([(float(v),) for v in range(9)], "r double")
    pts = ST.qq_points(df, "r").orderBy("i").collect()
    n = 9
    last = 0.5 ** (1 / n)
    pos = [1 - last] + [(i - 0.3175) / (n + 0.365) for i in range(2, n)] + [last]
    for r, p in zip(pts, pos):
        assert math.isclose(r["theoretical"], NormalDist().inv_cdf(p), rel_tol=1e-12, abs_tol=1e-12)


def test_splits_and_checks(spark):
    df = spark.createDataFrame([(d, 1.0) for d in months(30)], "date date, y double")
    with pytest.raises(ValueError):
        temporal_split(df, "2021-06-01", "2021-01-01")
    s = temporal_split(df, "2021-01-01", "2021-07-01")
    c = {r["split"]: r["n_rows"] for r in split_checks(s).collect()}
    assert c == {"train": 12, "val": 6, "test": 12}
    with pytest.raises(ValueError):
        split_checks(temporal_split(df, "2019-01-01", "2021-07-01"))


def test_walk_forward_folds_expand_and_are_disjoint(spark):
    df = spark.createDataFrame([("s", d, 1.0) for d in months(30)], "series string, date date, y double")
    s = temporal_split(df, "2021-06-01", "2022-01-01")   # 24 trainval rows
    f = walk_forward_folds(s, 3, 4, ["series"])
    tests = {}
    for r in f.filter(F.col("role") == "test").collect():
        tests.setdefault(r["fold"], []).append(r["date"])
    assert [len(tests[k]) for k in range(3)] == [4, 4, 4]
    assert max(tests[0]) < min(tests[1]) and max(tests[1]) < min(tests[2])
    for k in range(3):
        tr = [r["date"] for r in f.filter((F.col("fold") == k) & (F.col("role") == "train")).collect()]
        assert max(tr) < min(tests[k]) and len(tr) == 24 - (3 - k) * 4


@pytest.mark.parametrize("n, last", [(12, "train"), (3, "train"), (3, "test")])
def test_short_series_come_out_rejected_and_the_others_go_on(spark, n, last):
    rows = [("long", d, "train") for d in months(24)] + [("short", d, last) for d in months(n)] + [(None, d, "train") for d in months(13)]
    s = spark.createDataFrame(rows, "series string, date date, split string")
    out = walk_forward_folds(s, 3, 4, ["series"])
    assert out.filter("series = 'long'").count() == 16 + 20 + 24
    assert out.filter("series is null and fold is not null").count() == 5 + 9 + 13      # 13 rows are just enough
    short = out.filter("series = 'short'").collect()
    own = n if last == "train" else 0
    assert [(r["date"], r["fold"], r["role"], r["reason"]) for r in short] == [
        (months(n)[-1], None, None, f"too short for the folds: {own} trainval rows, 3 folds of 4 need 13")]
    folds, rejected = fold_table(s, 3, 4, ["series"])
    assert folds.columns == ["series", "date", "split", "fold", "role"] and folds.filter("series = 'short'").count() == 0
    assert [r["series"] for r in rejected.collect()] == ["short"]
    assert walk_forward_folds(s.limit(0), 3, 4, ["series"]).count() == 0


def test_validate_output_reports_all(spark):
    df = spark.createDataFrame([(d, None) for d in months(3)], "date date, v double")
    rep = {(r["check"], r["col"]): r["passed"] for r in validation_report(
        df, min_rows=12, required=["v", "w"], recent_months=6, as_of="2030-01-01").collect()}
    assert rep == {("min_rows", None): False, ("not_all_null", "v"): False, ("present", "w"): False,
                   ("recent", "date"): False}
    with pytest.raises(ValueError, match="min_rows.*not_all_null.*present.*recent"):
        validate_output(df, "t", min_rows=12, required=["v", "w"], as_of="2030-01-01")
