"""Gap, NULL and duplicate rules of the monthly operators and merge chains."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelcast.operators import monthly as MO
from panelcast.operators.joins import inner_merge_chain, left_merge_chain, union_tagged

D = dt.date


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.fixture
def daily(spark):
    data = [("a", D(2020, 1, 3), 1.0), ("a", D(2020, 1, 20), None), ("a", D(2020, 3, 5), 2.0),
            ("b", D(2020, 2, 1), 5.0), ("b", None, 7.0)]
    return spark.createDataFrame(data, "k string, d date, v double")


def test_monthly_sum_emits_gap_months_as_zero(daily):
    out = MO.monthly_sum(daily, "d", "v", keys=["k"])
    assert rows(out, "k", "date", "v") == [("a", D(2020, 1, 1), 1.0), ("a", D(2020, 2, 1), 0.0),
                                           ("a", D(2020, 3, 1), 2.0), ("b", D(2020, 2, 1), 5.0)]


def test_monthly_mean_gap_is_null_and_zero_fill_lowers(daily):
    m = {(r["k"], r["date"]): r["v"] for r in MO.monthly_mean(daily, "d", "v", keys=["k"]).collect()}
    assert m[("a", D(2020, 1, 1))] == 1.0 and m[("a", D(2020, 2, 1))] is None
    z = {(r["k"], r["date"]): r["v"] for r in MO.zero_fill_then_mean(daily, "d", "v", keys=["k"]).collect()}
    assert z[("a", D(2020, 1, 1))] == 0.5


def test_monthly_pivot_absent_null_allnull_zero(spark):
    data = [(D(2020, 1, 2), "x", 1.0), (D(2020, 1, 9), "y", None), (D(2020, 3, 1), "x", 2.0),
            (None, "x", 9.0), (D(2020, 3, 2), None, 9.0)]
    df = spark.createDataFrame(data, "d date, c string, v double")
    out = MO.monthly_pivot(df, "d", "c", "v", ["x", "y"])
    got = rows(out, "date", "x", "y")
    # no row for 2020-02 (pivots do not fill the calendar); (2020-03, y) absent -> NULL
    assert got == [(D(2020, 1, 1), 1.0, 0.0), (D(2020, 3, 1), 2.0, None)]


def test_two_period_union_keeps_both_calendars(spark):
    df = spark.createDataFrame([(D(2020, 1, 1), 1.0), (D(2020, 3, 1), 3.0), (D(2020, 6, 1), 6.0)],
                               "d date, v double")
    out = MO.two_period_mean_union(df, "d", "v", "2020-04-01")
    assert [r["date"] for r in out.orderBy("date").collect()] == [
        D(2020, 1, 1), D(2020, 2, 1), D(2020, 3, 1), D(2020, 6, 1)]


def test_left_chain_keeps_anchor_and_duplicates_multiply(spark):
    anchor = spark.createDataFrame([("s", D(2020, 1, 1), 1.0), ("s", D(2020, 2, 1), 2.0)],
                                   "series string, date date, y double")
    f1 = spark.createDataFrame([(D(2020, 1, 1), 10.0)], "date date, f1 double")
    f2 = spark.createDataFrame([("s", D(2020, 2, 1), 7), ("s", D(2020, 2, 1), 8)],
                               "series string, date date, f2 int")
    out = left_merge_chain(anchor, [f1, f2], keys=["series"])
    assert out.count() == 3  # the duplicated feature month multiplies the anchor row
    assert inner_merge_chain(anchor, [f1], keys=["series"]).count() == 1
    null_date = spark.createDataFrame([(None, 1.0)], "date date, f3 double")
    assert left_merge_chain(anchor, [null_date], keys=["series"]).filter("f3 is not null").count() == 0


def test_union_tagged(spark):
    a = spark.createDataFrame([(1,)], "x int")
    out = union_tagged({"train": a, "test": a})
    assert rows(out, "split", "x") == [("test", 1), ("train", 1)]


def test_monthly_pivot_filled_and_strict_month_code(spark):
    df = spark.createDataFrame([(D(2020, 1, 5), "m2", 1.0), (D(2020, 3, 5), "m3", 2.0), (D(2019, 12, 1), "m2", 9.0)],
                               "d date, u string, v double")
    out = MO.monthly_pivot_filled(df, "d", "u", "v", ["m2", "m3"], "2019-12-31")
    assert rows(out, "date", "m2", "m3") == [(D(2020, 1, 1), 1.0, 0.0), (D(2020, 3, 1), 0.0, 2.0)]
    from panelcast.functions.scalars import parse_yyyymm
    bad = spark.createDataFrame([("2023-1",)], "c string")
    with pytest.raises(Exception):
        bad.select(parse_yyyymm("c")).collect()


@settings(max_examples=5, deadline=None)
@given(st.sets(st.integers(0, 40), min_size=1, max_size=15), st.sets(st.integers(0, 40), max_size=15))
def test_left_chain_keeps_anchor_count_on_unique_dates(spark, anchor_m, feat_m):
    def month(i):
        return D(2020 + i // 12, i % 12 + 1, 1)
    anchor = spark.createDataFrame([("s", month(i), float(i)) for i in anchor_m], "series string, date date, y double")
    feat = spark.createDataFrame([(month(i), float(i)) for i in feat_m] or [(None, None)], "date date, f double")
    out = left_merge_chain(anchor, [feat], keys=["series"])
    assert out.count() == len(anchor_m)
    assert out.filter("f is not null").count() == len(anchor_m & feat_m)


def test_calendar_fill_keeps_null_keys_and_parts(spark):
    rows = [("a", dt.date(2020, 1, 5), 1.0), ("a", dt.date(2020, 4, 1), 2.0), (None, dt.date(2020, 2, 1), 3.0),
            (None, dt.date(2020, 3, 9), 4.0), ("a", None, 9.0)]
    df = spark.createDataFrame(rows, "k string, d date, v double")
    got = {(r["k"], r["date"].month): r["v"] for r in MO.monthly_sum(df, "d", "v", keys=["k"]).collect()}
    assert got == {("a", 1): 1.0, ("a", 2): 0.0, ("a", 3): 0.0, ("a", 4): 2.0, (None, 2): 3.0, (None, 3): 4.0}
    parts = MO.two_period_mean_union(df, "d", "v", "2020-02-15").collect()
    assert sorted((r["date"].month, r["v"]) for r in parts) == [(1, 1.0), (2, 3.0), (3, 4.0), (4, 2.0)]
    assert MO.monthly_sum(df.limit(0), "d", "v", keys=["k"]).count() == 0


def test_pivot_fails_on_a_category_that_is_not_listed(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), "x", 1.0), (dt.date(2020, 1, 1), "new", 2.0)], "d date, c string, v double")
    with pytest.raises(Exception, match="category not listed: new"):
        MO.monthly_pivot(df, "d", "c", "v", ["x"]).collect()
    assert MO.monthly_pivot(df, "d", "c", "v", ["x", "new"]).collect()[0]["new"] == 2.0
