"""Sinks and table access for the bronze / silver / gold layers.

A table is a name that points to one stored version. A write puts a complete new
version beside the others and then moves the name to it in one metastore step, so a
write that fails leaves the table as it was, and readers of the old version finish on
its files. Versions lie under ``path`` (the shared scratch folder in tests and checks)
or in the cluster's warehouse. Every write is a full refresh.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

AUDIT_COL = "ingestion_ts"
#: Property of a table: the folder of its stored version.
VERSION = "version_path"


def table_name(layer: str, table: str) -> str:
    return f"{layer}.{table}"


def save_table(df: DataFrame, layer: str, table: str, path: str | None = None) -> str:
    """Create the layer database if needed, add ``ingestion_ts``, store a new version and
    point the table to it."""
    spark = df.sparkSession
    name = table_name(layer, table)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    root = path or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + f"/{layer}.db/{table}"
    version = f"{root.rstrip('/')}/v-{uuid.uuid4().hex}"
    df.withColumn(AUDIT_COL, F.current_timestamp()).write.parquet(version)
    _drop_plain_table(spark, name)
    quoted = version.replace("`", "``")
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{VERSION}' = '{version}') AS SELECT * FROM parquet.`{quoted}`")
    return name


def _drop_plain_table(spark: SparkSession, name: str) -> None:
    """A table of an earlier kind gives way to the pointer."""
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType not in ("VIEW", "TEMPORARY"):
        spark.sql(f"DROP TABLE {name}")


def table_version(spark: SparkSession, layer: str, table: str) -> str:
    """The folder of the version a table points to."""
    return spark.sql(f"SHOW TBLPROPERTIES {table_name(layer, table)} ('{VERSION}')").first()["value"]


def remove_old_versions(spark: SparkSession, layer: str, table: str) -> int:
    """Delete the stored versions that the table no longer points to, when nothing reads
    them any more; how many."""
    current = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table_version(spark, layer, table))
    fs = current.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = [s.getPath() for s in fs.listStatus(current.getParent()) if s.getPath().getName().startswith("v-") and s.getPath().getName() != current.getName()]
    for p in old:
        fs.delete(p, True)
    return len(old)


def table_exists(spark: SparkSession, layer: str, table: str) -> bool:
    return spark.catalog.tableExists(table_name(layer, table))


def read_table(spark: SparkSession, layer: str, table: str, order_by: str | None = None) -> DataFrame:
    """The table without the audit column; stays lazy (the sort is optional)."""
    df = spark.table(table_name(layer, table))
    if AUDIT_COL in df.columns:
        df = df.drop(AUDIT_COL)
    return df.orderBy(order_by) if order_by else df


def load_master(spark: SparkSession, layer: str = "gold", table: str = "master_panel",
                date: str = "date") -> DataFrame:
    df = read_table(spark, layer, table)
    return df.withColumn(date, F.to_date(date)).orderBy(date)


def table_last_modified(spark: SparkSession, layer: str, table: str) -> DataFrame:
    """Time of the last write (max file modification time), or no row when absent."""
    if not table_exists(spark, layer, table):
        return spark.createDataFrame([], "last_modified timestamp")
    df = spark.read.parquet(table_version(spark, layer, table))
    return df.select(F.col("_metadata.file_modification_time").alias("t")).agg(
        F.max("t").alias("last_modified"))


def normalise_for_write(df: DataFrame, string_cols: list[str] | None = None) -> DataFrame:
    """Names to strings, mixed-typed columns to STRING, NaN -> NULL in float columns."""
    out = df.toDF(*[str(c) for c in df.columns])
    exprs = {}
    for f in out.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DoubleType, FloatType)):
            exprs[f.name] = F.when(~F.isnan(c), c)
        elif string_cols and f.name in string_cols and not isinstance(f.dataType, StringType):
            exprs[f.name] = c.cast("string")
    return out.withColumns(exprs) if exprs else out


def export_table(df: DataFrame, path: str, single_file: bool = False) -> str:
    """Write a result as CSV with a header, all rows whatever their number; one file
    per task, or a single file (written by one task) on request, for small reports."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
    return path
