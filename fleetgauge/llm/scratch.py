"""Tables that a job writes to the shared folder, so that a lost executor costs a re-read."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a folder of its own only in a local session that names none."""
    path = spark.conf.get(CHECKPOINT_DIR, None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_DIR} must name a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="fleetgauge-")
    spark.conf.set(CHECKPOINT_DIR, path)
    return path


class Scratch:
    """Written intermediate tables of one operator call."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str, free: bool = True) -> DataFrame:
        """Write ``df`` and read it back; with ``free``, the shuffle files of what led to it go."""
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        schema = df.schema
        del df
        if free:
            free_shuffles(self.spark)
        return self.spark.read.schema(schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark: SparkSession, wait: float = 0.0) -> None:
    """Let Spark's cleaner, which works beside the job, remove the shuffle files of frames no longer referenced."""
    gc.collect()
    spark._jvm.System.gc()
    time.sleep(wait)


#: Rows that travel to a Python worker together; whole texts make larger batches a matter of memory.
ARROW_ROWS = "1000"


def prepare(spark: SparkSession) -> None:
    """Bound what a Python worker gets at once, and let workers on this machine import the package."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
