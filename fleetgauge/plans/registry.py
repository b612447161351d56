"""Every KPI, by report, and how a set of them becomes one frame."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fleetgauge.functions.time import AsOf
from fleetgauge.plans import campaigns, compliance, counts, os_mix, quality, support
from fleetgauge.plans.kpi import KPI, REPORT, Kpi
from fleetgauge.schemas import KPI_RESULT, conform
from fleetgauge.session import written
from fleetgauge.sources import sql_kpis
from fleetgauge.sources.tables import Keep, Sources

FAMILIES = {
    counts.FAMILY: counts.asset_counts,
    quality.FAMILY: quality.quality_kpis,
    compliance.TOTAL_FAMILY: compliance.total_kpi,
    compliance.FAMILY: compliance.element_kpis,
    support.FAMILY: support.support_kpis,
    os_mix.FAMILY: os_mix.os_mix_kpis,
    campaigns.TARGETED_FAMILY: campaigns.targeted_kpi,
    campaigns.FAMILY: campaigns.campaign_kpis,
    sql_kpis.FAMILY: sql_kpis.sql_kpis,
}

# families that read when hosts were last scanned
READ_SCANS = {
    counts.FAMILY, quality.FAMILY, compliance.TOTAL_FAMILY, compliance.FAMILY, support.FAMILY, campaigns.TARGETED_FAMILY, campaigns.FAMILY
}

KPIS: list[Kpi] = [*compliance.KPIS, *counts.KPIS, *quality.KPIS, *support.KPIS, *os_mix.KPIS, *campaigns.KPIS]
BY_NAME: dict[str, Kpi] = {k.name: k for k in [*KPIS, *quality.PARITY_KPIS]}

WITH_REPORT = T.StructType([*KPI_RESULT.fields, T.StructField(KPI, T.StringType()), T.StructField(REPORT, T.StringType())])


def reports() -> list[str]:
    """Report ids in the order they are run."""
    return sorted({k.report for k in KPIS})


def kpis_of(report: str) -> list[Kpi]:
    """KPIs of one report; the id compares without case."""
    found = [k for k in KPIS if k.report == report.upper()]
    if not found:
        raise KeyError(f"no report {report!r}")
    return found


def compute_with_report(src: Sources, as_of: AsOf, kpis: Iterable[Kpi]) -> DataFrame:
    """Result rows of ``kpis``, their report and KPI. KPIs of one family share a plan, across reports."""
    families: dict[str, list[Kpi]] = {}
    for k in kpis:
        families.setdefault(k.family, []).append(k)
    frames = [conform(FAMILIES[f](src, as_of, group), WITH_REPORT) for f, group in families.items()]
    return reduce(DataFrame.unionByName, frames)


def compute(src: Sources, as_of: AsOf, kpis: Iterable[Kpi]) -> DataFrame:
    """Result rows of ``kpis`` in the result contract."""
    return conform(compute_with_report(src, as_of, kpis))


def compute_one(src: Sources, as_of: AsOf, name: str) -> DataFrame:
    return compute(src, as_of, [BY_NAME[name]])


def run_reports(src: Sources, as_of: AsOf, kpis: Iterable[Kpi], keep: Keep = written) -> DataFrame:
    """Result rows, report and KPI of many KPIs. Blocks that several of them read are kept by ``keep``.

    Sources that keep blocks already go on with theirs.
    """
    kpis = list(kpis)
    shared = src if src.keeps_blocks else src.sharing(keep)
    families = {k.family for k in kpis}
    blocks = [
        *quality.shared_blocks(shared, as_of, [k for k in kpis if k.family == quality.FAMILY]),
        *compliance.shared_blocks(shared, as_of, kpis),
        *campaigns.shared_blocks(shared, as_of, kpis),
    ]
    if not blocks:
        return compute_with_report(src, as_of, kpis)
    if len(families & READ_SCANS) > 1:
        shared.keep_table("last_seen")
    shared.prepare(blocks + [lambda: os_mix.heavy_os(shared)] * (os_mix.FAMILY in families))
    return compute_with_report(shared, as_of, kpis)


def run_report(src: Sources, as_of: AsOf, report: str) -> DataFrame:
    """All daily KPIs of one report."""
    return conform(run_reports(src, as_of, kpis_of(report)))
