"""Session construction and the shared scratch folder.

Every write that cuts lineage or lands an intermediate file goes under the
folder the cluster names in ``spark.checkpoint.dir``. A folder is only made up
here when a local session has none (tests); on a cluster a missing one is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale; all are plain Spark SQL confs.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Monthly panels are narrow; the pivots and fills generate wide projections.
    "spark.sql.codegen.maxFields": "400",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "panelcast") -> SparkSession:
    builder = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
               # checkpoint files of DataFrames that are gone are removed from the shared folder
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    if master:
        # local runs: the driver JVM is the only executor
        builder = builder.master(master).config("spark.driver.memory", "16g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set one only when none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="panelcast-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for one landed artefact."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    base = base.rstrip("/")
    return f"{base}/panelcast/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss); never a local one."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors (once per application), so that functions
    run in tasks find it whatever the workers' path and working folder are."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.join(tempfile.mkdtemp(prefix="panelcast-ship-"), "panelcast.zip")
    with zipfile.ZipFile(name, "w") as z:
        for folder, _, files in os.walk(os.path.join(root, "panelcast")):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(name)
    _SHIPPED.add(app)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
