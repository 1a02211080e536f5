"""File sources: encoded CSV, landed sheet grids, snapshots, per-region responses.

Readers always get an explicit schema (no inference job). The sheet identity of
a landed grid is the folder it was landed in, taken from ``_metadata``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

FILE = "file"


def scan_csv_encoded(spark: SparkSession, path: str, schema: StructType,
                     encoding: str = "ISO-8859-1", header: bool = True) -> DataFrame:
    """CSV with a header line in a single-byte encoding (accented names kept)."""
    return (spark.read.schema(schema).option("header", header).option("encoding", encoding)
            .option("enforceSchema", False).csv(path))


def grid_schema(n_cols: int) -> StructType:
    return StructType([StructField("row_idx", IntegerType(), False)]
                      + [StructField(f"col_{i}", StringType(), True) for i in range(n_cols)])


def _sheet_name() -> F.Column:
    # the landed folder of the file: .../<sheet>/part-....csv
    return F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]+$", 1)


def scan_landed_grid(spark: SparkSession, path: str | list[str], n_cols: int, line_breaks: bool = True) -> DataFrame:
    """Untyped sheet: ``(file, row_idx, col_0 … col_{n-1})``, all cells STRING.

    Quoted cells of a sheet may hold line breaks (two-line month headers); the reader then
    runs in multi-line mode, one sheet file per task. Files without such cells are read in
    splits of any size."""
    paths = [path] if isinstance(path, str) else list(path)
    df = (spark.read.schema(grid_schema(n_cols)).option("header", False)
          .option("multiLine", line_breaks).csv(paths))
    return df.select(_sheet_name().alias(FILE), *grid_schema(n_cols).fieldNames())


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob, from the file system listing (metadata only)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(path) or []
    return [st.getPath().toString() for st in found]


def latest_snapshot(spark: SparkSession, pattern: str, fmt: str = "parquet") -> DataFrame:
    """Rows of the snapshot (file or folder) with the greatest name matching a glob.

    The choice is made on the listing, so only the newest snapshot is read."""
    paths = glob_paths(spark, pattern)
    if not paths:
        raise FileNotFoundError(f"no snapshot matches {pattern}")
    newest = max(paths, key=lambda p: p.rstrip("/").rsplit("/", 1)[-1])
    return spark.read.format(fmt).load(newest)


def region_union_scan(spark: SparkSession, paths: list[str], n_cols: int) -> DataFrame:
    """One landed response per region, read as one multi-path scan (a union). Their cells
    hold no line breaks, so a large response is read by many tasks."""
    return scan_landed_grid(spark, paths, n_cols, line_breaks=False)


def last_modified(df_or_path, spark: SparkSession | None = None, fmt: str = "parquet") -> DataFrame:
    """Latest modification time among the files behind a path (one row)."""
    df = spark.read.format(fmt).load(df_or_path) if isinstance(df_or_path, str) else df_or_path
    return df.select(F.col("_metadata.file_modification_time").alias("t")).agg(
        F.max("t").alias("last_modified"))
