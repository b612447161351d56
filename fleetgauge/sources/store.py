"""The history: two dimensions, a daily and a monthly fact, and the run ledger.

Parquet tables in one database of the session's catalog. Facts are partitioned by date and report. What a run computes
for a report is first written to a folder of its own; then the catalog is told that this folder is the partition, which
is one step: readers see the rows of before or those of after, and a run cut short between can be repeated.

The ledger is a table of events that is only ever appended to. ``read`` gives each KPI's last one.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge import fixed_values as fv
from fleetgauge.functions.time import AsOf, months_before
from fleetgauge.schemas import KPI_DEF, KPI_EVENT, KPI_FACT, KPI_RUN, ORG_UNIT, STORED_FACT

UNITS, KPIS, DAILY, MONTHLY, RUNS = "org_unit", "kpi_def", "kpi_daily", "kpi_monthly", "kpi_run"

#: Ledger states, in the order in which a run goes through them; the last four end it.
STARTED, WRITTEN, DONE, EMPTY, FAILED, CLEARED = "started", "written", "done", "empty", "failed", "cleared"

#: Report and KPI of fact rows that were inserted without.
UNNAMED = "none"

#: Where the ids of a run begin that finds the next ones claimed by another: beyond all that one could use.
CLAIM_STEP = 1 << 32

_TABLES: dict[str, tuple[T.StructType, tuple[str, ...]]] = {
    UNITS: (ORG_UNIT, ()),
    KPIS: (KPI_DEF, ()),
    DAILY: (STORED_FACT, ("date", "report")),
    MONTHLY: (STORED_FACT, ("date", "report")),
    RUNS: (KPI_EVENT, ("month",)),
}


class HistoryStore:
    """Reads and maintains the history tables of ``database``."""

    def __init__(
        self,
        spark: SparkSession,
        database: str,
        daily_months: int = fv.DAILY_RETENTION_MONTHS,
        monthly_months: int = fv.MONTHLY_RETENTION_MONTHS,
        location: str | None = None,
    ):
        """``daily_months`` and ``monthly_months`` say how long each fact is kept.

        ``location``: folder of the database, when it is created here; by default one in the warehouse.
        """
        self.spark = spark
        self.database = database
        self.retention = {DAILY: daily_months, MONTHLY: monthly_months}
        self._location = location
        self._is_snapshot = False

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def create(self) -> HistoryStore:
        """Create what is missing."""
        at = f" LOCATION '{self._location}'" if self._location else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}{at}")
        for table, (schema, partitions) in _TABLES.items():
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            by = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
            # with a location, the catalog leaves files alone: this class removes those that are the database's own
            where = f"LOCATION '{self.folder}/{table}'"
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}) USING parquet {by} {where}")
        return self

    def drop(self) -> None:
        """Remove the database with all its tables and files."""
        path, files = self._file_system(self.folder)
        self.spark.sql(f"DROP DATABASE IF EXISTS {self.database} CASCADE")
        files.delete(path, True)

    def snapshot(self, database: str, location: str | None = None) -> HistoryStore:
        """A store of the same rows whose partitions are the files of this one; what either changes, the other keeps.

        It lasts as long as this store does not delete or replace what it holds.
        """
        copy = HistoryStore(self.spark, database, self.retention[DAILY], self.retention[MONTHLY], location).create()
        copy._is_snapshot = True
        for table in (UNITS, KPIS, RUNS):
            copy.insert(table, self._table(table))
        for table in (DAILY, MONTHLY):
            folder = F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/", 1).alias("folder")
            found = self._table(table).select("date", "report", folder).distinct().collect()  # one a partition
            for lo in range(0, len(found), 500):
                specs = [f"{self._spec(r.date, r.report)} LOCATION '{r.folder}'" for r in found[lo : lo + 500]]
                self.spark.sql(f"ALTER TABLE {copy.name(table)} ADD {' '.join(specs)}")
            self.spark.catalog.refreshTable(copy.name(table))
        return copy

    # ---- files -----------------------------------------------------------------------------
    @property
    def folder(self) -> str:
        return self.spark.catalog.getDatabase(self.database).locationUri.rstrip("/")

    def _file_system(self, path: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _is_own(self, folder: str) -> bool:
        inside = self._file_system(self.folder)[0].toUri().getPath() + "/"
        return self._file_system(folder)[0].toUri().getPath().startswith(inside)

    def _delete(self, folder: str) -> None:
        """Remove a folder, if it is the database's own: partitions of a snapshot need not be."""
        path, files = self._file_system(folder)
        if self._is_own(folder):
            files.delete(path, True)

    def _exists(self, folder: str) -> bool:
        path, files = self._file_system(folder)
        return files.exists(path)

    def claim(self, table: str, first: int) -> int:
        """The first of a range of ids that no other run will give out, ``first`` itself if it is free.

        A range is claimed by creating a file named after its first id, which succeeds for one run only. Claims stay:
        a run that has read the table before this one registers its labels must still find them taken.
        """
        while True:
            path, files = self._file_system(f"{self.folder}/claims/{table}/{first:019d}")
            try:
                files.create(path, False).close()
                return first
            except Py4JJavaError as error:
                if not files.exists(path):
                    raise error
            first += CLAIM_STEP

    # ---- tables ----------------------------------------------------------------------------
    def read(self, table: str) -> DataFrame:
        """The table as it is now: the facts' own columns; of the ledger, the last event of each KPI and period."""
        if table == RUNS:
            return self.last_events().select(*KPI_RUN.names)
        return self._table(table).select(*KPI_FACT.names) if table in (DAILY, MONTHLY) else self._table(table)

    def _table(self, table: str) -> DataFrame:
        self.spark.catalog.refreshTable(self.name(table))
        return self.spark.table(self.name(table))

    def insert(self, table: str, rows: DataFrame, mode: str = "append") -> None:
        """Write rows: ``append``, ``overwrite`` (the whole table) or ``fail`` (unless empty).

        Fact rows without report or KPI are stored as of none; ledger rows without event number as of now.
        """
        if mode not in ("append", "overwrite", "fail"):
            raise ValueError(f"no insert mode {mode!r}")
        if mode == "fail" and not self._table(table).isEmpty():
            raise ValueError(f"{self.name(table)} already has rows")
        rows = self._completed(table, rows)
        partitions = _TABLES[table][1]
        if table in (DAILY, MONTHLY):
            if mode == "overwrite":
                self.delete_partitions(table, self.partitions(table))
                mode = "append"
            elif self._is_snapshot:
                self._own_partitions(table, rows)
        if partitions:  # one file for each partition, or several for a large one
            rows = rows.hint("rebalance", *partitions)
        rows.write.insertInto(self.name(table), overwrite=mode == "overwrite")
        self.spark.catalog.refreshTable(self.name(table))

    def _own_partitions(self, table: str, rows: DataFrame) -> None:
        """Copy the partitions that ``rows`` go to, where their files belong to another store."""
        known = set(self.partitions(table))
        for r in rows.select("date", "report").distinct().collect():  # one a partition
            if (r.date, r.report) in known and not self._is_own(self.location(table, r.date, r.report)):
                self.publish(table, r.date, r.report, self.stage(table, self.stored(table, r.date, r.report)))

    def _completed(self, table: str, rows: DataFrame) -> DataFrame:
        schema = _TABLES[table][0]
        defaults = {
            "kpi": F.lit(UNNAMED),
            "report": F.lit(UNNAMED),
            "n_rows": F.lit(None).cast("long"),
            "location": F.lit(None).cast("string"),
            "seq": F.lit(time.time_ns()),
            "month": F.trunc("period", "MM") if table == RUNS else None,
        }
        missing = {c: defaults[c] for c in schema.names if c not in rows.columns and c in defaults}
        return rows.withColumns(missing).select(*schema.names)

    def partitions(self, table: str) -> list[tuple[dt.date, str]]:
        """Date and report of the partitions that the catalog lists."""
        listed = self.spark.sql(f"SHOW PARTITIONS {self.name(table)}").collect()
        unescape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        found = [dict(part.split("=", 1) for part in r.partition.split("/")) for r in listed]
        return sorted((dt.date.fromisoformat(p["date"]), unescape(p["report"])) for p in found)

    def dates(self, table: str) -> list[dt.date]:
        """Dates the catalog has a partition for."""
        return sorted({day for day, _ in self.partitions(table)})

    @staticmethod
    def _spec(day: dt.date, report: str) -> str:
        quoted = report.replace("\\", "\\\\").replace("'", "\\'")
        return f"PARTITION (date = DATE '{day}', report = '{quoted}')"

    def location(self, table: str, day: dt.date, report: str) -> str | None:
        """The folder that is now the partition, if there is one."""
        return self._folder_of(table, day, report) if (day, report) in self.partitions(table) else None

    def _folder_of(self, table: str, day: dt.date, report: str) -> str:
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)} {self._spec(day, report)}").collect()
        return next(r.data_type for r in described if r.col_name == "Location")

    def stored(self, table: str, day: dt.date, report: str | None = None) -> DataFrame:
        """The rows of one date, or one report's of it, with report and KPI."""
        rows = self._table(table).filter(F.col("date") == F.lit(day))
        return rows if report is None else rows.filter(F.col("report") == report)

    # ---- replacing what reports have ---------------------------------------------------------
    def stage(self, table: str, rows: DataFrame) -> str:
        """Write rows of one partition to a folder that no table knows yet."""
        partitions = _TABLES[table][1]
        folder = f"{self.folder}/staged/{table}/{uuid.uuid4().hex}"
        columns = [c for c in _TABLES[table][0].names if c not in partitions]
        self._completed(table, rows).select(*columns).write.parquet(folder)
        return folder

    def publish(self, table: str, day: dt.date, report: str, folder: str) -> None:
        """Make a staged folder the partition. Can be repeated; the folder that was the partition before goes."""
        before, spec = self.location(table, day, report), self._spec(day, report)
        if before is None:
            self.spark.sql(f"ALTER TABLE {self.name(table)} ADD IF NOT EXISTS {spec} LOCATION '{folder}'")
        else:
            self.spark.sql(f"ALTER TABLE {self.name(table)} {spec} SET LOCATION '{folder}'")
        self.spark.catalog.refreshTable(self.name(table))
        now = self.location(table, day, report)
        if before is not None and now is not None and before.rsplit("/", 1)[-1] != now.rsplit("/", 1)[-1]:
            self._delete(before)

    def merged(self, table: str, day: dt.date, report: str, rows: DataFrame, kpis: Iterable[str]) -> DataFrame:
        """``rows`` of a report, and the stored rows of its KPIs other than ``kpis``."""
        others = self.stored(table, day, report).filter(~F.col("kpi").isin(*kpis)) if kpis else self.stored(table, day, report)
        rows = self._completed(table, rows)
        return rows.unionByName(others.select(*rows.columns))

    def replace_date(self, table: str, day: dt.date, rows: DataFrame) -> None:
        """Make ``rows`` the whole content of one date, also when there are none."""
        rows = self._completed(table, rows)
        new = {r.report for r in rows.select("report").distinct().collect()}  # at most one a report
        for report in sorted(new | {r for d, r in self.partitions(table) if d == day}):
            self.publish(table, day, report, self.stage(table, rows.filter(F.col("report") == report)))

    # ---- deleting ----------------------------------------------------------------------------
    def delete_partitions(self, table: str, chosen: list[tuple[dt.date, str]]) -> None:
        for day, report in chosen:
            folder = self._folder_of(table, day, report)
            self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS {self._spec(day, report)}")
            self._delete(folder)
        self.spark.catalog.refreshTable(self.name(table))

    def delete_day(self, table: str, day: dt.date) -> None:
        self.delete_partitions(table, [p for p in self.partitions(table) if p[0] == day])

    def delete_month(self, table: str, year: int, month: int) -> None:
        """Drop one month of one year."""
        self.delete_partitions(table, [p for p in self.partitions(table) if (p[0].year, p[0].month) == (year, month)])

    def delete_yesterday(self, table: str, as_of: AsOf) -> None:
        self.delete_day(table, as_of.yesterday.day)

    def purge(self, as_of: AsOf, table: str) -> None:
        """Drop the partitions older than the table's retention."""
        first_kept = months_before(as_of.day, self.retention[table])
        self.delete_partitions(table, [p for p in self.partitions(table) if p[0] < first_kept])

    # ---- run ledger --------------------------------------------------------------------------
    def last_events(self) -> DataFrame:
        """The last event of each KPI, grain and period, but for those that were cleared."""
        newest = Window.partitionBy("report", "kpi", "grain", "period").orderBy(F.desc("seq"), "status")
        last = self._table(RUNS).withColumn("_place", F.row_number().over(newest))
        return last.filter((F.col("_place") == 1) & (F.col("status") != CLEARED)).drop("_place")

    def record(self, events: Iterable[tuple]) -> None:
        """Append events (report, kpi, grain, status, period, n_rows, location); a few for each KPI of a run."""
        seq = time.time_ns()
        rows = [(*e, seq, e[4].replace(day=1)) for e in events]
        if rows:
            self.spark.createDataFrame(rows, KPI_EVENT).coalesce(1).write.insertInto(self.name(RUNS))
            self.spark.catalog.refreshTable(self.name(RUNS))

    def record_runs(self, runs: list[tuple[str, str, str, str, dt.date]]) -> None:
        """Append (report, kpi, grain, status, period) events."""
        self.record((*r, None, None) for r in runs)

    def _of_period(self, grain: str, period: dt.date) -> DataFrame:
        return self.last_events().filter((F.col("grain") == grain) & (F.col("period") == F.lit(period)))

    def done(self, grain: str, period: dt.date) -> set[tuple[str, str]]:
        """(report, kpi) already run for a period; at most the size of the registry."""
        return {(r.report, r.kpi) for r in self._of_period(grain, period).filter(F.col("status") == DONE).collect()}

    def pending(self, registry: DataFrame, as_of: AsOf, grain: str) -> DataFrame:
        """Rows of ``registry`` (report, kpi, grain, ...) whose KPI has no run with rows in the current period.

        The ledger key has the report, so finishing one report does not skip another.
        """
        period = as_of.day if grain == "day" else as_of.this_month
        finished = self.last_events().filter((F.col("grain") == grain) & (F.col("status") == DONE))
        at = F.col("period") if grain == "day" else F.trunc("period", "MM")
        finished = finished.filter(at == F.lit(period)).select("report", "kpi")
        return registry.filter(F.col("grain") == grain).join(finished, ["report", "kpi"], "left_anti")

    def clear_runs(self, grain: str, period: dt.date, reports: set[str] | None = None) -> None:
        """Forget a period's runs, of some reports or of all."""
        known = self._of_period(grain, period).collect()  # at most the size of the registry
        self.record_runs([(r.report, r.kpi, grain, CLEARED, period) for r in known if reports is None or r.report in reports])

    def recover(self, table: str, grain: str, period: dt.date, day: dt.date) -> list[str]:
        """Finish what a run had written but not published; the reports that were.

        Such a report's staged rows were complete, so they become the partition, and its KPIs are noted as done.
        """
        cut = self._of_period(grain, period).filter(F.col("status") == WRITTEN).collect()
        folders = {r.report: r.location for r in cut if self._exists(r.location)}
        for report, folder in sorted(folders.items()):
            self.publish(table, day, report, folder)
        self.record(
            (r.report, r.kpi, grain, (DONE if r.n_rows else EMPTY) if r.report in folders else FAILED, period, r.n_rows, None)
            for r in cut
        )
        return sorted(folders)
