"""KPIs of month grain: what the monthly job averages, report by report.

Their sources are the history's own tables ``kpi_daily``, ``kpi_def`` and ``org_unit``. A result has at least
``id_calc``, ``id_maille`` and ``valeur``; label columns may stand beside them and are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge.functions.time import AsOf
from fleetgauge.operators import rollup
from fleetgauge.plans.kpi import KPI, MONTH, REPORT, Kpi
from fleetgauge.schemas import STORED_FACT, conform
from fleetgauge.sources import sql_kpis
from fleetgauge.sources.store import DAILY, KPIS, UNITS, HistoryStore
from fleetgauge.sources.tables import Sources

FAMILY = "monthly"

_RESULT = T.StructType([f for f in STORED_FACT.fields if f.name in ("id_calc", "id_maille", "valeur")])

#: Reports with a monthly definition of their own; all others have the plain averages of their KPIs.
DEFINED = {
    "R031": Kpi("R031", "R031", "", "", FAMILY, rollup.report_labelled, MONTH),
    "R035": Kpi("R035", "R035", "", "", FAMILY, rollup.report_regex, MONTH),
}


def kpi_of(report: str) -> Kpi:
    """The monthly KPI of a report; it is named after it."""
    return DEFINED.get(report) or Kpi(report, report, "", "", FAMILY, rollup.report_average, MONTH)


def kpis_of(reports: list[str], files: list[Kpi]) -> list[Kpi]:
    """The monthly KPIs of reports: their SQL files of month grain where they have some."""
    written = [k for k in files if k.grain == MONTH and k.report in reports]
    return written + [kpi_of(r) for r in reports if r not in {k.report for k in written}]


def history_sources(store: HistoryStore) -> Sources:
    """The tables that monthly KPIs read, as they are now."""
    return Sources.from_frames(store.spark, {t: store.read(t) for t in (DAILY, KPIS, UNITS)})


def compute(src: Sources, as_of: AsOf, kpi: Kpi) -> DataFrame:
    """Rows of the stored fact, under the first day of the previous month."""
    found = sql_kpis.run_sql(src, kpi.spec, as_of) if kpi.family == sql_kpis.FAMILY else kpi.spec(src, as_of, kpi.report)
    month = F.lit(as_of.previous_month.isoformat()).cast("date")
    named = conform(found, _RESULT).withColumns({KPI: F.lit(kpi.name), "date": month, REPORT: F.lit(kpi.report)})
    return named.na.drop(subset=_RESULT.names).select(*STORED_FACT.names)
