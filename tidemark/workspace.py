"""Where jobs may write intermediate and result data: always a folder that all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.merge import measured
from tidemark.tables import storage

#: bytes written by a step that is worth a look for shuffle files that it no longer needs
LARGE_STEP = 16 << 20
_CHECKPOINT_DIR = "spark.checkpoint.dir"
_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a single-process session (``local[...]``) may fall back to a folder of this machine; anywhere
    else executors could not see it, so a missing setting is an error.
    """
    configured = spark.conf.get(_CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[application] = tempfile.mkdtemp(prefix="tidemark-")
    return _LOCAL_ROOTS[application]


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; no two calls share one."""
    return f"{shared_root(spark)}/tidemark/{purpose}-{uuid.uuid4().hex[:12]}"


def release_shuffles(spark: SparkSession) -> None:
    """Shuffle files of finished steps leave the disks of the executors.

    Spark deletes them once the driver's collector finds that no plan refers to them, so it is asked to look.
    """
    gc.collect()  # frames of finished steps hold plans in the driver's JVM
    spark.sparkContext._jvm.System.gc()


@contextmanager
def staged(rows: DataFrame, purpose: str):
    """Rows written to the shared folder and read back, and their size in memory; deleted when left.

    The lineage ends here, and a lost executor costs a re-read instead of a recomputation.
    """
    spark, schema = rows.sparkSession, rows.schema
    folder = new_folder(spark, purpose)
    rows, size = measured(rows)
    rows.write.parquet(folder)
    del rows
    if storage.size(spark, folder) >= LARGE_STEP:
        release_shuffles(spark)
    try:
        yield spark.read.schema(schema).parquet(folder), size.get["bytes"]
    finally:
        storage.delete(spark, folder)
