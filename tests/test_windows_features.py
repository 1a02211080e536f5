"""Window operators, feature table leak-safety and selection rules."""

import datetime as dt
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelcast.operators import features as FE
from panelcast.operators import windows as W

D = dt.date


def months(n, start=2020):
    return [D(start + (i // 12), i % 12 + 1, 1) for i in range(n)]


@pytest.fixture
def series(spark):
    vals = [1.0, 2.0, None, 4.0, 5.0, 6.0]
    data = [("s", d, v) for d, v in zip(months(6), vals)]
    return spark.createDataFrame(data, "series string, date date, y double")


def test_lags_and_shifted_mean(series):
    out = W.lag_features(series, ["y"], [1], ["series"])
    out = W.shifted_rolling_mean(out, "y", [2], ["series"])
    r = {x["date"]: x for x in out.collect()}
    assert r[D(2020, 2, 1)]["y_lag_1"] == 1.0
    assert r[D(2020, 3, 1)]["y_ma2"] == 1.5            # mean of the two previous months
    assert r[D(2020, 4, 1)]["y_ma2"] is None           # previous window holds a NULL
    assert r[D(2020, 6, 1)]["y_ma2"] == 4.5


def test_ffill_bfill_and_switch(spark):
    data = [("s", d, v) for d, v in zip(months(4), [None, 2.0, None, 4.0])]
    df = spark.createDataFrame(data, "series string, date date, y double")
    full = [r["y"] for r in W.ffill_bfill(df, ["y"], ["series"]).orderBy("date").collect()]
    assert full == [2.0, 2.0, 2.0, 4.0]
    fwd = [r["y"] for r in W.ffill_bfill(df, ["y"], ["series"], backward=False).orderBy("date").collect()]
    assert fwd == [None, 2.0, 2.0, 4.0]


def test_trend_weights_last_n(series):
    t = [r["trend"] for r in W.trend_index(series, ["series"]).orderBy("date").collect()]
    assert t == list(range(6))
    w = [r["weight"] for r in W.recency_weight(series, 0.9, ["series"]).orderBy("date").collect()]
    assert w[-1] == 1.0 and all(0 < x <= 1 for x in w)
    assert math.isclose(w[0], 0.9 ** 5)
    assert W.last_n(series, 2, ["series"]).count() == 2


def test_collinearity_rule_any_earlier_column(spark):
    # b ~ a, c ~ b (so c is dropped even though b itself is dropped); k constant is kept
    data = [(float(i), float(i) * 2 + (0.01 if i % 2 else 0), float(i) * 3, 1.0, float(i % 3), 0.0)
            for i in range(20)]
    df = spark.createDataFrame(data, "a double, b double, c double, k double, z double, target double")
    _, dropped = FE.drop_collinear(df, "target", 0.9)
    assert dropped == ["b", "c"]


def test_target_filter_drops_constant_and_uses_trainval(spark):
    data = [("s", d, float(i), float(i) * 2, 1.0) for i, d in enumerate(months(24))]
    df = spark.createDataFrame(data, "series string, date date, demand double, f double, k double")
    p = FE.FeatureParams(keys=["series"])
    out, table = FE.filter_by_target_corr(df, p, 0.05, "2021-06-01", features=["f", "k"])
    assert "f" in out.columns and "k" not in out.columns


def test_rebuild_requires_saved_columns(spark, series):
    p = FE.FeatureParams(target="y", keys=["series"], macro_cols=[], target_lags=[1], windows=[2])
    with pytest.raises(ValueError):
        FE.rebuild_features(series, p, ["y_lag_1", "not_a_feature"])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=8, max_size=14),
       st.integers(min_value=3, max_value=7))
def test_features_never_look_ahead(spark, values, cut):
    """Changing rows at or after t never changes lag/shifted-mean features at t."""
    p = FE.FeatureParams(target="y", keys=["series"], macro_cols=[], target_lags=[1, 2], windows=[2, 3])
    ds = months(len(values))
    a = spark.createDataFrame([("s", d, v) for d, v in zip(ds, values)], "series string, date date, y double")
    changed = values[:cut] + [v + 1000.0 for v in values[cut:]]
    b = spark.createDataFrame([("s", d, v) for d, v in zip(ds, changed)], "series string, date date, y double")
    cols = ["y_lag_1", "y_lag_2", "y_ma2", "y_ma3"]
    fa = {r["date"]: tuple(r[c] for c in cols) for r in FE.feature_table(a, p, drop_null=False).collect()}
    fb = {r["date"]: tuple(r[c] for c in cols) for r in FE.feature_table(b, p, drop_null=False).collect()}
    for d in ds[:cut + 1]:
        assert fa[d] == fb[d]
