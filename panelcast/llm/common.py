"""Helpers shared by the training-data operators: stored intermediate tables,
files opened by URI inside tasks, and Arrow batch plumbing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.session import scratch_path, ship_package, table_path

LONG, STRING, BINARY, DOUBLE, BOOL = T.LongType(), T.StringType(), T.BinaryType(), T.DoubleType(), T.BooleanType()


def schema(**cols: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in cols.items()])


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def whole_text(column: str = "text"):
    """The text as it stands; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again: cuts lineage, survives lost
    executors, and gives the next plan real sizes."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_rows(df: DataFrame, out: T.StructType, make: Callable[[], Callable]) -> DataFrame:
    """``mapInArrow`` over rows of Python values. ``make()`` runs once per task and
    returns a function from one batch (dict of column lists) to rows (tuples)."""
    ship_package(df.sparkSession)
    names = out.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        arrow = arrow_schema(out)
        for batch in batches:
            for piece in slices(batch):
                rows = step(piece.to_pydict())
                cols = list(zip(*rows)) if rows else [[] for _ in names]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, arrow.types)], schema=arrow)

    return df.mapInArrow(run, out)


def arrow_schema(out: T.StructType) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(),
             "double": pa.float64(), "boolean": pa.bool_()}
    return pa.schema([pa.field(f.name, kinds[f.dataType.simpleString()]) for f in out.fields])


def slices(batch: pa.RecordBatch, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into zero-copy slices of about ``most`` bytes, so that Python
    objects exist for a few MB of text at a time however long the texts are."""
    n = batch.num_rows
    if batch.nbytes <= most or n <= 1:
        if n:
            yield batch
        return
    half = n // 2
    yield from slices(batch.slice(0, half), most)
    yield from slices(batch.slice(half), most)


_RESIDENT: dict = {}


def resident(key, build: Callable):
    """The one large model a worker process holds; building another lets go of it first,
    so stages that follow each other don't add up."""
    if key not in _RESIDENT:
        for old in _RESIDENT.values():
            getattr(old, "release", lambda: None)()
        _RESIDENT.clear()
        _RESIDENT[key] = build()
    return _RESIDENT[key]


def open_uri(uri: str):
    """(file system, path) of a folder or file named by URI or plain path."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def task_file(base: str, suffix: str) -> str:
    """A file name no other task attempt uses; only files named by a committed
    manifest row count, so what a failed attempt leaves is ignored."""
    import uuid

    from pyspark import TaskContext
    part = TaskContext.get().partitionId() if TaskContext.get() else 0
    return f"{base.rstrip('/')}/{part:06d}-{uuid.uuid4().hex}{suffix}"
