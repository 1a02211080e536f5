"""Sources and sinks on small hand-made frames (files go to the shared scratch folder)."""

import datetime as dt
import math

import pytest
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from panelcast import sinks as K
from panelcast.session import scratch_path
from panelcast.sources import files as FS


def test_normalise_for_write(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 3.5)], "k int, v double")
    out = K.normalise_for_write(df, string_cols=["k"])
    rows = sorted((r["k"], r["v"]) for r in out.collect())
    assert rows == [("1", None), ("2", 3.5)]


def test_export_table_writes_every_row(spark):
    df = spark.range(5).repartition(3)
    for single in (False, True):
        path = K.export_table(df, scratch_path(spark, "t-export"), single_file=single)
        assert spark.read.option("header", True).csv(path).count() == 5


def test_latest_snapshot_reads_only_newest(spark):
    base = scratch_path(spark, "t-snap")
    for year in (2019, 2021, 2020):
        spark.createDataFrame([(year,)], "y int").write.parquet(f"{base}/book_{year}")
    out = FS.latest_snapshot(spark, f"{base}/book_*")
    assert [r["y"] for r in out.collect()] == [2021]
    with pytest.raises(FileNotFoundError):
        FS.latest_snapshot(spark, f"{base}/none_*")


def test_save_read_load_roundtrip(spark):
    df = spark.createDataFrame([(dt.date(2020, 2, 1), 2.0), (dt.date(2020, 1, 1), 1.0)], "date date, v double")
    name = K.save_table(df, "gold", "t_master", path=scratch_path(spark, "t-gold"))
    assert K.AUDIT_COL in spark.table(name).columns
    back = K.load_master(spark, "gold", "t_master")
    assert back.columns == ["date", "v"] and [r["v"] for r in back.collect()] == [1.0, 2.0]
    assert K.table_last_modified(spark, "gold", "t_master").collect()[0][0] is not None


def test_latin1_csv_roundtrip(spark):
    schema = StructType([StructField("Município", StringType()), StructField("Área total", DoubleType())])
    df = spark.createDataFrame([("São Paulo", 1.5), ("Goiânia", 2.25)], schema)
    path = scratch_path(spark, "t-latin1")
    df.write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    parts = sorted(__import__("glob").glob(f"{path.replace('file:', '')}/part-*.csv"))
    raw = b"".join(open(p, "rb").read() for p in parts)   # rows may land in several part files
    assert "São".encode("latin-1") in raw          # really single-byte encoded
    back = FS.scan_csv_encoded(spark, path, schema)
    got = sorted((r["Município"], r["Área total"]) for r in back.collect())
    assert got == [("Goiânia", 2.25), ("São Paulo", 1.5)] and not math.isnan(got[0][1])


@pytest.mark.parametrize("flag, status", [("X", "F"), ("A", "P"), (None, "F"), ("A", None)])
def test_vehicle_sheet_fails_on_an_unlisted_pair(spark, flag, status):
    from panelcast.sources import landing
    rows = [("A", "F", 1.0), ("N", "O", 2.0), (flag, status, 4.0)]
    li = spark.createDataFrame(rows, "l_returnflag string, l_linestatus string, l_quantity double") \
              .selectExpr("to_date('1998-01-05') l_shipdate", "*")
    with pytest.raises(Exception, match="block or variable not listed"):
        landing.land_vehicle_sheet(spark, li, ["A", "N", "R"])
    path, n = landing.land_vehicle_sheet(spark, li.filter("l_quantity < 3"), ["A", "N", "R"])
    assert n == 7 and any("1998-01-01" in list(r) for r in spark.read.csv(path).collect())
