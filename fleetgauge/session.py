"""Session defaults and the folder for frames that must outlive an executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_local_folders: dict[str, str] = {}


def local_session(cpus: str = "*", app: str = "fleetgauge", **conf: str) -> SparkSession:
    """Session for tests and benchmarks. On a cluster, use the session the cluster gives."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="fleetgauge-wh-"))
        .config(CHECKPOINT_DIR, tempfile.mkdtemp(prefix="fleetgauge-ck-"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; only a local session may go without one."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        app = spark.sparkContext.applicationId
        return _local_folders.setdefault(app, tempfile.mkdtemp(prefix="fleetgauge-ck-"))
    raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The lineage ends at the written files, so several jobs can use the frame and a lost
    executor costs a re-read, not a recomputation.
    """
    return _write(df, _path(df.sparkSession, name))


def _path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/fleetgauge/{name}-{uuid.uuid4().hex}"


def _write(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Staging:
    """Frames written for one job. When the job is over, their files make way for empty ones."""

    def __init__(self) -> None:
        self._kept: list[tuple[str, DataFrame]] = []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = _path(df.sparkSession, name)
        kept = _write(df, path)
        self._kept.append((path, kept))
        return kept

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_: object) -> None:
        for path, frame in self._kept:
            empty = frame.sparkSession.createDataFrame([], frame.schema).coalesce(1)
            empty.write.mode("overwrite").parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the time of a job."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# Split the reduce task of a hot join key even where that costs another shuffle.
JOB_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
