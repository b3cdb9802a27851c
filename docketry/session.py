"""Session helpers: worker import path, shared working tables, table reading."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKAGE_ROOT = str(Path(__file__).resolve().parent.parent)


BATCH_ROWS = 2000


def ship_package(spark: SparkSession) -> None:
    """Make the session fit for this package's Python workers.

    They must import it from where the driver found it (on a cluster without a
    common install, pass the package with ``--py-files`` as well), and they hold
    whole texts, so an Arrow batch has at most ``BATCH_ROWS`` rows.
    """
    held = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(held)) <= BATCH_ROWS:
        spark.conf.set(held, str(BATCH_ROWS))
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in parts:
        env["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *parts])


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster shares for checkpoints (``spark.checkpoint.dir``).

    Where the session names none: the warehouse on a cluster, a temporary folder in
    local mode, where driver and executors are one process.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            found = tempfile.mkdtemp(prefix="docketry-shared-")
        else:
            found = spark.conf.get("spark.sql.warehouse.dir")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def clear_shared(spark: SparkSession) -> None:
    """Delete this package's working tables; results that still read them must be written first."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/docketry")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def write_shared(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage: a lost executor costs a re-read, never a recompute
    of what came before.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/docketry/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def unused(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    name = f"__{stem}"
    while name in taken:
        name += "_"
    return name
