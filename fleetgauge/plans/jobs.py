"""The daily and the monthly job.

A run goes through the ledger states of the store: its KPIs are ``started``; each report's rows are written to a folder
of their own and its KPIs are ``written``; the folders become the partitions, and the KPIs are ``done`` or, without
rows, ``empty``. Only KPIs that are done are skipped next time. A run that was cut short is repeated by the next one,
which publishes what was written and computes the rest.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.functions.time import AsOf
from fleetgauge.operators import history
from fleetgauge.plans import monthly, registry
from fleetgauge.plans.kpi import DAY, MONTH, Kpi
from fleetgauge.schemas import STORED_FACT, ContractError
from fleetgauge.session import JOB_SETTINGS, Staging, settings, written
from fleetgauge.sources import store as st
from fleetgauge.sources.sql_kpis import reports_from_root
from fleetgauge.sources.store import HistoryStore
from fleetgauge.sources.tables import Keep, Sources

log = logging.getLogger(__name__)

Key = tuple[str, str]
Compute = Callable[[list[Kpi]], DataFrame]


@dataclass
class RunSummary:
    """What a job did: KPIs that gave rows, that gave none, that failed, and those skipped because they were done."""

    done: list[str] = field(default_factory=list)
    empty: list[str] = field(default_factory=list)
    failed: dict[str, str] = field(default_factory=dict)
    skipped: list[str] = field(default_factory=list)


def _key(k: Kpi) -> Key:
    return k.report, k.name


# ---- labels ----------------------------------------------------------------------------------
def _reports_with_new_labels(store: HistoryStore, rows: DataFrame) -> list[str]:
    """Reports that bring a unit or KPI label for the first time; on most days none does."""
    units = history.new_labels(rows.select("report", "maille").distinct(), store.read(st.UNITS), "maille")
    kpis = history.new_labels(rows.select("report", "indicateur").distinct(), store.read(st.KPIS), "indicateur")
    found = units.select("report").unionByName(kpis.select("report")).distinct()
    return sorted(r.report for r in found.collect())


def _after(store: HistoryStore, labels: DataFrame, table: str, id_column: str, label: str) -> Column | None:
    """What new ids of a dimension go on from: its largest id, unless another run has claimed those that follow.

    None, and no claim, if all labels are known.
    """
    known = store.read(table)
    if history.new_labels(labels.select(label).filter(F.col(label).isNotNull()), known, label).isEmpty():
        return None
    largest = known.agg(F.coalesce(F.max(id_column), F.lit(0))).first()[0]
    return F.lit(store.claim(table, largest + 1) - 1)


def register_labels(store: HistoryStore, rows: DataFrame, keep: Keep = written) -> None:
    """Append new unit and KPI labels, report by report in alphabetical order.

    The first report that brings a label keeps it. Each step reads the tables the step before has written; appended
    labels are known to a re-run, so it adds nothing twice. Ids are claimed before they are given out, so two runs at
    a time never give out one id; a label that both register has two, of which the smaller counts.
    """
    for report in _reports_with_new_labels(store, rows):
        labels = rows.filter(F.col("report") == report)
        after = _after(store, labels, st.UNITS, "id_maille", "maille")
        if after is not None:
            store.insert(st.UNITS, history.unit_upsert(store.read(st.UNITS), labels, keep, after))
        after = _after(store, labels, st.KPIS, "id_calc", "indicateur")
        if after is not None:
            kpis, units = store.read(st.KPIS), store.read(st.UNITS)
            store.insert(st.KPIS, history.kpi_upsert(kpis, units, labels, report, keep, after))


# ---- computing KPIs of which some may fail -----------------------------------------------------
def isolated(kpis: list[Kpi], compute: Compute, keep: Keep, failed: dict[Key, str]) -> list[DataFrame]:
    """The written rows of ``kpis``. A set that fails is halved until the KPIs that fail stand alone.

    So one bad KPI among n costs about 2 log2(n) further runs of ever fewer KPIs.
    """
    if not kpis:
        return []
    try:
        return [keep(compute(kpis), "rows")]
    except (ContractError, PySparkException, Py4JJavaError) as error:
        if len(kpis) == 1:
            log.error("KPI %s of %s: %s", kpis[0].name, kpis[0].report, str(error)[:500])
            failed[_key(kpis[0])] = str(error)
            return []
        log.warning("one of %d KPIs failed, trying halves: %s", len(kpis), str(error)[:200])
    half = len(kpis) // 2
    return isolated(kpis[:half], compute, keep, failed) + isolated(kpis[half:], compute, keep, failed)


def _counts(rows: DataFrame) -> dict[Key, int]:
    """Rows of each KPI; at most one entry for each of the registry."""
    return {(r.report, r.kpi): r.n for r in rows.groupBy("report", "kpi").agg(F.count("*").alias("n")).collect()}


@dataclass
class _Run:
    """One run of a grain: which table and period it writes, and under which day."""

    store: HistoryStore
    grain: str
    table: str
    period: dt.date
    day: dt.date

    def execute(
        self,
        given: list[Kpi],
        use_ledger: bool,
        compute: Compute,
        facts: Callable[[DataFrame, Keep], DataFrame],
        keep: Keep,
    ) -> RunSummary:
        """Compute the KPIs given that are not done, and replace their rows, and only theirs, in their reports."""
        summary = RunSummary()
        self.store.recover(self.table, self.grain, self.period, self.day)
        done = self.store.done(self.grain, self.period) if use_ledger else set()
        summary.skipped = [k.name for k in given if _key(k) in done]
        wanted = sorted((k for k in given if _key(k) not in done), key=lambda k: k.report)
        if not wanted:
            return summary
        self._record((k, st.STARTED, None, None) for k in wanted)
        failed: dict[Key, str] = {}
        frames = isolated(wanted, compute, keep, failed)
        self._record((k, st.FAILED, None, None) for k in wanted if _key(k) in failed)
        summary.failed = {k.name: failed[_key(k)] for k in wanted if _key(k) in failed}
        ran = [k for k in wanted if _key(k) not in failed]
        if ran:
            rows = reduce(DataFrame.unionByName, frames)
            counts = _counts(rows)
            self._replace(ran, keep(facts(rows, keep), "fact"), counts)
            summary.done = [k.name for k in given if k in ran and counts.get(_key(k))]
            summary.empty = [k.name for k in given if k in ran and not counts.get(_key(k))]
        return summary

    def _record(self, events) -> None:
        self.store.record((k.report, k.name, self.grain, status, self.period, n, at) for k, status, n, at in events)

    def _replace(self, ran: list[Kpi], fact: DataFrame, counts: dict[Key, int]) -> None:
        """Publish each report's rows: those of the KPIs that ran, and what is stored of the others."""
        store, of_report = self.store, {}
        for k in ran:
            of_report.setdefault(k.report, []).append(k)
        staged = {}
        for report, kpis in of_report.items():
            before = store.location(self.table, self.day, report)
            if before is None and not any(counts.get(_key(k)) for k in kpis):
                continue  # nothing there and nothing new
            staged[report] = self._staged(report, kpis, fact), before
        n_rows = lambda k: counts.get(_key(k), 0)
        self._record((k, st.WRITTEN, n_rows(k), staged[k.report][0]) for k in ran if k.report in staged)
        for report, (folder, before) in staged.items():
            if store.location(self.table, self.day, report) != before:  # another run was faster: add to what it has
                folder = self._staged(report, of_report[report], fact)
            store.publish(self.table, self.day, report, folder)
        self._record((k, st.DONE if n_rows(k) else st.EMPTY, n_rows(k), None) for k in ran)

    def _staged(self, report: str, kpis: list[Kpi], fact: DataFrame) -> str:
        rows = fact.filter(F.col("report") == report)
        return self.store.stage(self.table, self.store.merged(self.table, self.day, report, rows, [k.name for k in kpis]))


# ---- days --------------------------------------------------------------------------------------
def run_day(
    src: Sources,
    store: HistoryStore,
    as_of: AsOf,
    kpis: list[Kpi] | None = None,
    use_ledger: bool = True,
) -> RunSummary:
    """Compute the day's KPIs, register their labels and write the day's fact.

    Of the day's rows, exactly those of the KPIs that ran are replaced: other reports, other KPIs of a report, and KPIs
    that failed keep theirs. A KPI that gives no row has none afterwards, and is computed again next time, so that a
    source that fills up later is not missed.
    """
    store.create()
    store.purge(as_of, st.DAILY)
    given = [k for k in (registry.KPIS if kpis is None else kpis) if k.grain == DAY]
    run = _Run(store, DAY, st.DAILY, as_of.day, as_of.day)
    with settings(src.spark, JOB_SETTINGS), Staging() as staging:
        shared = src.sharing(staging.keep)  # blocks are kept once, however often a failing KPI makes halves

        def facts(rows: DataFrame, keep: Keep) -> DataFrame:
            register_labels(store, rows, keep)
            return history.stored_fact(rows, store.read(st.KPIS), store.read(st.UNITS), as_of.day)

        compute = lambda chosen: registry.run_reports(shared, as_of, chosen, staging.keep)
        return run.execute(given, use_ledger, compute, facts, staging.keep)


def run_one_report(src: Sources, store: HistoryStore, as_of: AsOf, report: str) -> RunSummary:
    """All daily KPIs of one report, for the run day."""
    return run_day(src, store, as_of, registry.kpis_of(report))


def purge_day(store: HistoryStore, as_of: AsOf) -> None:
    """Delete a day and forget that it was run, without computing it again."""
    store.create()
    store.clear_runs(DAY, as_of.day)
    store.delete_day(st.DAILY, as_of.day)


def recompute_day(src: Sources, store: HistoryStore, as_of: AsOf, kpis: list[Kpi] | None = None) -> RunSummary:
    """Compute a day again, whatever the ledger says. A KPI that fails keeps the rows it had."""
    return run_day(src, store, as_of, kpis, use_ledger=False)


def recompute_yesterday(src: Sources, store: HistoryStore, as_of: AsOf, kpis: list[Kpi] | None = None) -> RunSummary:
    return recompute_day(src, store, as_of.yesterday, kpis)


# ---- months ------------------------------------------------------------------------------------
def known_reports(store: HistoryStore) -> list[str]:
    """The built-in reports and all that have registered labels, such as reports of SQL files."""
    stored = store.read(st.KPIS).select(F.explode("rapports").alias("report")).distinct().collect()
    return sorted({*registry.reports(), *(r.report for r in stored)})


def run_month(
    store: HistoryStore,
    as_of: AsOf,
    reports: list[str] | None = None,
    use_ledger: bool = True,
    kpis: list[Kpi] | None = None,
) -> RunSummary:
    """Average the previous month and write it under its first day; for all known reports unless some are given.

    ``kpis``: monthly KPIs written as SQL; a report that has some is averaged by these, others by the built-in
    definition. A report without rows is tried again next time.
    """
    store.create()
    store.purge(as_of, st.MONTHLY)
    files = [k for k in kpis or [] if k.grain == MONTH]
    known = sorted({*known_reports(store), *(k.report for k in files)}) if reports is None else sorted(reports)
    src = monthly.history_sources(store)
    run = _Run(store, MONTH, st.MONTHLY, as_of.this_month, as_of.previous_month)
    with settings(store.spark, JOB_SETTINGS), Staging() as staging:
        compute = lambda chosen: reduce(DataFrame.unionByName, [monthly.compute(src, as_of, k) for k in chosen])
        facts = lambda rows, _: _once_a_month(store, as_of, rows, known)
        return run.execute(monthly.kpis_of(known, files), use_ledger, compute, facts, staging.keep)


def _once_a_month(store: HistoryStore, as_of: AsOf, rows: DataFrame, reports: list[str]) -> DataFrame:
    """``rows`` without KPIs that another report has averaged; of those in several reports run now, the first has them."""
    stored = store.stored(st.MONTHLY, as_of.previous_month).filter(~F.col("report").isin(*reports))
    first = rows.groupBy("id_calc").agg(F.min("report").alias("report"))
    rows = rows.join(stored.select("id_calc"), "id_calc", "left_anti").join(first, ["id_calc", "report"], "left_semi")
    return rows.select(*STORED_FACT.names)


def recompute_month(store: HistoryStore, as_of: AsOf, kpis: list[Kpi] | None = None) -> RunSummary:
    """Average the previous month again for every known report. One that fails keeps the rows it had."""
    return run_month(store, as_of, use_ledger=False, kpis=kpis)


# ---- all there is --------------------------------------------------------------------------------
def run_due(
    src: Sources, store: HistoryStore, as_of: AsOf, root: str | None = None, built_in: list[Kpi] | None = None
) -> tuple[RunSummary, RunSummary]:
    """The default run: the day, then the previous month, of every report that is due.

    The built-in KPIs (or those given) and those of the SQL files in the directories of ``root`` are one job: they share
    scans and kept blocks across reports, and one that fails takes no other with it.
    """
    files = reports_from_root(src.spark, root) if root else []
    day = run_day(src, store, as_of, [*(registry.KPIS if built_in is None else built_in), *files])
    return day, run_month(store, as_of, kpis=files)
