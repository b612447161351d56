"""KPIs written as SQL: one file per KPI, one directory per report.

A file holds one Spark SQL query over the source tables. ``:as_of`` is the run day and
``:now`` the run moment.
"""

from __future__ import annotations

import datetime as dt
import re
import threading
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.functions.time import AsOf
from fleetgauge.plans.kpi import DAY, KPI, MONTH, REPORT, Kpi
from fleetgauge.schemas import conform
from fleetgauge.sources.tables import Sources

FAMILY = "sql"
# File name prefixes that tell the grain
MONTHLY_PREFIX = "indic_mois"

_VIEWS = threading.Lock()


def run_sql(src: Sources, text: str, as_of: AsOf) -> DataFrame:
    """Result of a KPI query. Only the source tables it mentions are registered.

    The query is resolved when its frame is made, so the views go at once, and views of the
    session that have the same names are put back.
    """
    words = set(re.findall(r"\w+", text))
    names = [name for name in src.names if name in words]
    frames = {name: src[name] for name in names}
    args = {"as_of": as_of.day, "now": dt.datetime.combine(as_of.day, as_of.time)}
    with _VIEWS:
        views = {t.name for t in src.spark.catalog.listTables() if t.isTemporary}
        before = {name: src.spark.table(name) for name in names if name in views}
        try:
            for name, frame in frames.items():
                frame.createOrReplaceTempView(name)
            return src.spark.sql(text, args=args)
        finally:
            for name in names:
                src.spark.catalog.dropTempView(name)
            for name, frame in before.items():
                frame.createOrReplaceTempView(name)


def read_sql_file(spark: SparkSession, path: str) -> str:
    """UTF-8 text of a query file, local or on any file system Spark reads."""
    if "://" not in path:
        return Path(path).read_text(encoding="utf-8")
    return spark.read.text(path, wholetext=True).first().value


def run_sql_file(src: Sources, path: str, as_of: AsOf) -> DataFrame:
    return run_sql(src, read_sql_file(src.spark, path), as_of)


def _kpi(report: str, name: str, text: str) -> Kpi:
    grain = MONTH if name.startswith(MONTHLY_PREFIX) else DAY
    return Kpi(name, report, "", "", FAMILY, text, grain)


def report_from_directory(spark: SparkSession, directory: str) -> list[Kpi]:
    """KPIs of a report directory, by file name; the report id is the upper-cased directory name."""
    report = directory.rstrip("/").rsplit("/", 1)[-1].upper()
    if "://" not in directory and not directory.startswith("file:"):
        files = sorted(Path(directory).glob("*.sql"))
        return [_kpi(report, f.stem, f.read_text(encoding="utf-8")) for f in files]
    texts = spark.read.text(directory, wholetext=True, pathGlobFilter="*.sql")
    rows = texts.select(F.input_file_name().alias("path"), "value").orderBy("path").collect()
    return [_kpi(report, r.path.rsplit("/", 1)[-1].removesuffix(".sql"), r.value) for r in rows]


def reports_from_root(spark: SparkSession, root: str) -> list[Kpi]:
    """KPIs of every report directory under ``root``, by report."""
    root = root.rstrip("/")
    if "://" not in root and not root.startswith("file:"):
        directories = [str(d) for d in sorted(Path(root).iterdir()) if d.is_dir()]
    else:
        folder = spark._jvm.org.apache.hadoop.fs.Path(root)
        listed = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
        directories = sorted(str(f.getPath()) for f in listed if f.isDirectory())
    return [k for d in directories for k in report_from_directory(spark, d)]


def sql_kpis(src: Sources, as_of: AsOf, kpis: list[Kpi]) -> DataFrame:
    """Result rows of KPIs written as SQL; surplus columns are dropped."""
    frames = [
        conform(run_sql(src, k.spec, as_of)).withColumns({KPI: F.lit(k.name), REPORT: F.lit(k.report)}) for k in kpis
    ]
    return reduce(DataFrame.unionByName, frames)
