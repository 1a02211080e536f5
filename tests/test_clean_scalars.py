"""Filters, projections and scalar functions."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelcast.functions import scalars as X
from panelcast.operators import clean as C


def test_geo_filter_keeps_null_state(spark):
    df = spark.createDataFrame([("BR", "SP", 1), ("BR", "EX", 2), ("BR", None, 3), ("AR", "SP", 4)],
                               "country string, state string, v int")
    out = C.geo_filter(df, "country", "BR", "state", "EX")
    assert sorted(r["v"] for r in out.collect()) == [1, 3]
    assert "country" not in out.columns


def test_date_open_filter_excludes_both_ends(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, d),) for d in (1, 2, 3)], "d date")
    out = C.date_open_filter(df, "d", dt.date(2020, 1, 1), dt.date(2020, 1, 3))
    assert [r["d"].day for r in out.collect()] == [2]
    closed = C.date_open_filter(df, "d", dt.date(2020, 1, 1), None, closed_start=True)
    assert closed.count() == 3


def test_rename_select_drop(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert C.rename_map(df, {"a": "x", "zz": "y"}).columns == ["x", "b"]
    with pytest.raises(ValueError):
        C.rename_map(df, {"zz": "y"}, strict=True)
    assert C.select_existing(df, ["b", "missing"]).columns == ["b"]
    assert C.drop_if_present(df, ["a", "missing"]).columns == ["b"]
    with pytest.raises(ValueError):
        C.select_by_name_match(df, "nothing")


def test_row_sum_and_null_drops(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (2.0, 3.0)], "a double, b double")
    s = [r["t"] for r in C.row_sum_skip_null(df, ["a", "b"], "t").collect()]
    assert s == [1.0, 0.0, 5.0]
    assert C.drop_any_null(df).count() == 1
    assert C.drop_all_null(df, ["a", "b"]).count() == 2
    assert C.drop_null_key(df, "a").count() == 2
    assert C.numeric_columns(df) == ["a", "b"]


def test_parsers(spark):
    df = spark.createDataFrame([("202301", "-", "1.5", "Fev\nFeb", "2024.0"),
                                ("199912", "...", "x", "dez", "abc")],
                               "code string, m string, n string, mon string, y string")
    r = df.select(X.parse_yyyymm("code").alias("d"), X.parse_missing_marker("m").alias("m"),
                  X.numeric_coerce("n").alias("n"), X.month_name_to_number("mon").alias("mon"),
                  X.clean_year("y").alias("y")).collect()
    assert r[0]["d"] == dt.date(2023, 1, 1) and r[0]["m"] is None and r[0]["n"] == 1.5
    assert r[0]["mon"] == 2 and r[1]["mon"] == 12 and r[0]["y"] == 2024 and r[1]["y"] is None
    assert r[1]["n"] is None


def test_strict_marker_raises_on_unknown_text(spark):
    df = spark.createDataFrame([("..",)], "m string")
    with pytest.raises(Exception):
        df.select(X.parse_missing_marker("m")).collect()


def test_human_scale_and_rounding(spark):
    df = spark.createDataFrame([(999.9,), (1234.0,), (2.5e6,), (3.1e9,)], "v double")
    got = [r[0] for r in df.select(X.human_scale("v")).collect()]
    assert got == ["999", "1.2k", "2.5M", "3.1B"]
    r = spark.createDataFrame([(2.125,)], "v double").select(
        X.round_half_up("v", 2).alias("u"), X.round_half_even("v", 2).alias("e")).collect()[0]
    assert (r["u"], r["e"]) == (2.13, 2.12)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.sampled_from(["x", "y", "z"]),
                          st.floats(min_value=-1e3, max_value=1e3, allow_nan=False)), min_size=1, max_size=20))
def test_melt_inverts_pivot(spark, cells):
    """melt of a pivot returns the non-empty (month, category, sum) cells."""
    from panelcast.operators.monthly import monthly_pivot
    data = [(dt.date(2020, 1, 1) + dt.timedelta(days=31 * m), c, v) for m, c, v in cells]
    df = spark.createDataFrame(data, "d date, c string, v double")
    wide = monthly_pivot(df, "d", "c", "v", ["x", "y", "z"])
    long = wide.unpivot(["date"], ["x", "y", "z"], "c", "v").filter(F.col("v").isNotNull())
    expect = df.groupBy(X.to_month("d").alias("date"), "c").agg(F.sum("v").alias("v"))
    a = sorted((r["date"], r["c"], round(r["v"], 6)) for r in long.collect())
    b = sorted((r["date"], r["c"], round(r["v"], 6)) for r in expect.collect())
    assert a == b


def test_trim_text_strips_all_white_space(spark):
    from panelcast.functions.scalars import trim_text
    df = spark.createDataFrame([("a\n",), ("\tb",), ("  c d \r\n",), (None,)], "t string")
    assert [r[0] for r in df.select(trim_text("t")).collect()] == ["a", "b", "c d", None]
