"""Global ranks, headers by name, versioned tables, exact sums."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from panelcast import sinks as K
from panelcast.operators import grid as G
from panelcast.operators import stats as ST
from panelcast.operators import windows as W
from panelcast.operators.monthly import monthly_mean, monthly_pivot, monthly_sum
from panelcast.operators.ranks import global_rank
from panelcast.session import scratch_path
from panelcast.sources import files as FS


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_global_rank_numbers_every_row_once_in_order(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(40)]), i) for i in range(500)]
    ranked, n = global_rank(spark.createDataFrame(rows, "v int, _at int").repartition(7), ["v"])
    got = sorted((r["rank"], r["v"], r["_at"]) for r in ranked.collect())
    assert n == 500 and [r[0] for r in got] == list(range(1, 501)) and ranked.columns == ["v", "_at", "rank"]
    assert [r[1] for r in got] == sorted((v for v, _ in rows), key=lambda v: (v is not None, v or 0))
    assert sorted(r[2] for r in got) == list(range(500))
    empty, n = global_rank(spark.createDataFrame([], "v int"), ["v"])
    assert n == 0 and empty.count() == 0


def test_trend_and_qq_without_keys_equal_the_keyed_ones(spark):
    rows = [("s", dt.date(2000 + i // 12, i % 12 + 1, 1), float((i * 37) % 101)) for i in range(90)]
    df = spark.createDataFrame(rows, "series string, date date, v double").repartition(5)
    free, keyed = W.trend_index(df), W.trend_index(df, ["series"])
    assert sorted(map(tuple, free.select("date", "trend").collect())) == sorted(map(tuple, keyed.select("date", "trend").collect()))
    qq, by = ST.qq_points(df, "v"), ST.qq_points(df, "v", group=["series"])
    cols = ["i", "theoretical", "ordered", "slope", "intercept"]
    for a, b in zip(sorted(map(tuple, qq.select(*cols).collect())), sorted(map(tuple, by.select(*cols).collect()))):
        assert a == pytest.approx(b, rel=1e-12)
    for out in (free, qq):
        assert "Window" not in plan(out)


def landed(spark, files, n):
    rows = [(f, i, *r) for f, lines in files.items() for i, r in enumerate(lines)]
    return spark.createDataFrame(rows, "file string, row_idx int, " + ", ".join(f"col_{i} string" for i in range(n)))


def test_headers_are_taken_from_every_file_by_name(spark):
    grid = landed(spark, {"a": [("code", "value", None), ("1", "5", "x")], "b": [("value", "code", "note"), ("6", "2", "n"), ("7", "3", None)],
                          "c": [("code", None, None), ("4", "lost", None)]}, 3)
    out = G.promote_headers(grid, keep=["file"])
    assert out.columns == ["file", "code", "value", "note"]
    assert sorted(map(tuple, out.collect())) == [("a", "1", "5", None), ("b", "2", "6", "n"), ("b", "3", "7", None), ("c", "4", None, None)]
    with pytest.raises(ValueError, match="d: two columns named code"):
        G.promote_headers(landed(spark, {"d": [("code", "code")]}, 2))
    with pytest.raises(ValueError, match="empty landed grid"):
        G.promote_headers(grid.limit(0))


def test_responses_are_read_in_splits(spark):
    base = scratch_path(spark, "t-response") + "/r=1"
    spark.range(4000).select("id", F.lit("x" * 100).alias("c")).coalesce(1).write.csv(base)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        whole, split = FS.scan_landed_grid(spark, base, 1), FS.region_union_scan(spark, [base], 1)
        assert whole.rdd.getNumPartitions() == 1 < split.rdd.getNumPartitions()
        assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, split.collect())) and split.count() == 4000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_failed_write_leaves_the_old_table_readable(spark):
    path = scratch_path(spark, "t-versions")
    K.save_table(spark.range(3).withColumnRenamed("id", "v"), "t_versions", "t", path=path)
    old = K.table_version(spark, "t_versions", "t")
    broken = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")).alias("v"))
    with pytest.raises(Exception, match="broken"):
        K.save_table(broken, "t_versions", "t", path=path)
    assert K.table_version(spark, "t_versions", "t") == old and K.read_table(spark, "t_versions", "t").count() == 3
    reader = K.read_table(spark, "t_versions", "t")
    K.save_table(spark.range(7).select(F.col("id").alias("w")), "t_versions", "t", path=path)        # another schema
    assert reader.count() == 3 and K.read_table(spark, "t_versions", "t").columns == ["w"]
    assert K.table_last_modified(spark, "t_versions", "t").first()[0] is not None
    assert K.remove_old_versions(spark, "t_versions", "t") == 2 and K.read_table(spark, "t_versions", "t").count() == 7


def test_a_table_can_be_rewritten_from_itself_and_two_runs_stay_apart(spark):
    for layer, n in (("t_run_a", 2), ("t_run_b", 5)):
        K.save_table(spark.range(n).withColumnRenamed("id", "v"), layer, "t", path=scratch_path(spark, layer))
    again = K.read_table(spark, "t_run_a", "t")
    K.save_table(again.union(again), "t_run_a", "t", path=scratch_path(spark, "t_run_a2"))
    assert (K.read_table(spark, "t_run_a", "t").count(), K.read_table(spark, "t_run_b", "t").count()) == (4, 5)


def test_sums_are_the_same_under_any_partitioning(spark):
    rng = random.Random(3)
    values = [round(rng.uniform(0, 1e12), 4) for _ in range(3000)] + [0.0001] * 7 + [None]
    exact = sum(Decimal(repr(v)) for v in values if v is not None)
    assert exact > 10 ** 13
    df = spark.createDataFrame([(dt.datetime(2001, 1, 1 + i % 28), "k", v) for i, v in enumerate(values)], "d timestamp, c string, v double")
    for parts in (1, 3, 17):
        dealt = df.repartition(parts)
        assert monthly_sum(dealt, "d", "v", scale=2).first()["v"] == float(round(exact, 2))
        assert monthly_mean(dealt, "d", "v", scale=2).first()["v"] == float(round(exact, 2)) / (len(values) - 1)
        assert monthly_pivot(dealt, "d", "c", "v", ["k"], scale=2).first()["k"] == float(round(exact, 2))
