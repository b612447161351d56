"""Monthly averages of the daily fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge import fixed_values as fv
from fleetgauge.functions.time import AsOf
from fleetgauge.sources.tables import Sources


def of_report(report: str) -> Column:
    """KPI belongs to the report."""
    return F.array_contains("rapports", report)


def of_all_reports(wanted: list[str]) -> Column:
    """KPI belongs to every one of the reports."""
    return F.size(F.array_except(F.array(*[F.lit(r) for r in wanted]), F.col("rapports"))) == 0


def month_rows(daily: DataFrame, as_of: AsOf, match_year: bool = True) -> DataFrame:
    """Rows of the previous month. Date bounds prune the partitions of the fact.

    ``match_year=False`` takes that month of any year.
    """
    if not match_year:
        return daily.filter(F.month("date") == as_of.previous_month.month)
    first, after = as_of.previous_month, as_of.this_month
    return daily.filter((F.col("date") >= F.lit(first)) & (F.col("date") < F.lit(after)))


def _average(rows: DataFrame, as_of: AsOf, keys: list[str]) -> DataFrame:
    month = F.lit(as_of.previous_month.isoformat()).cast("date")
    return rows.groupBy(*keys).agg(F.avg("valeur").alias("valeur")).withColumn("date", month)


def monthly_of(daily: DataFrame, chosen: DataFrame, as_of: AsOf, match_year: bool = True) -> DataFrame:
    """Average of each chosen KPI per unit, dated the first of the previous month."""
    rows = month_rows(daily, as_of, match_year).join(chosen.select("id_calc"), "id_calc", "left_semi")
    return _average(rows, as_of, ["id_calc", "id_maille"])


def monthly_avg(daily: DataFrame, kpis: DataFrame, as_of: AsOf, report: str, match_year: bool = True) -> DataFrame:
    """The averages of one report."""
    return monthly_of(daily, kpis.filter(of_report(report)), as_of, match_year)


def monthly_all_reports(daily: DataFrame, kpis: DataFrame, as_of: AsOf) -> DataFrame:
    """The averages of every report at once."""
    per_report = kpis.select("id_calc", F.explode("rapports").alias("report"))
    rows = month_rows(daily, as_of).join(per_report, "id_calc", "inner")
    return _average(rows, as_of, ["report", "id_calc", "id_maille"])


def _labelled(daily: DataFrame, kpis: DataFrame, units: DataFrame, as_of: AsOf) -> DataFrame:
    """Averages first, labels after: only one row per KPI and unit meets the dimensions."""
    averages = monthly_of(daily, kpis, as_of)
    names = kpis.select("id_calc", F.col("label").alias("label_indicateur"))
    places = units.select("id_maille", F.col("label").alias("maille"))
    return (
        averages.join(names, "id_calc", "inner")
        .join(places, "id_maille", "left")
        .select("id_calc", "id_maille", "label_indicateur", "maille", "valeur", "date")
    )


def monthly_labelled(daily: DataFrame, kpis: DataFrame, units: DataFrame, as_of: AsOf, report: str) -> DataFrame:
    """Averages of one report with both labels."""
    return _labelled(daily, kpis.filter(of_report(report)), units, as_of)


def monthly_regex(
    daily: DataFrame, kpis: DataFrame, units: DataFrame, as_of: AsOf, pattern: str = fv.MONTHLY_OS_LABELS
) -> DataFrame:
    """Averages of the KPIs whose label matches ``pattern``, with both labels."""
    return _labelled(daily, kpis.filter(F.col("label").rlike(pattern)), units, as_of)


# ---- what the monthly job computes for a report: id_calc, id_maille, valeur, date -----------------
def report_average(src: Sources, as_of: AsOf, report: str) -> DataFrame:
    """The averages of the KPIs that belong to the report."""
    return monthly_avg(src.kpi_daily, src.kpi_def, as_of, report)


def report_labelled(src: Sources, as_of: AsOf, report: str) -> DataFrame:
    """The same with labels, for reports whose monthly rows are read by label; unlabelled units are kept."""
    return monthly_labelled(src.kpi_daily, src.kpi_def, src.org_unit, as_of, report)


def report_regex(src: Sources, as_of: AsOf, report: str) -> DataFrame:
    """The averages of the KPIs whose labels follow the report's pattern, whichever report they belong to."""
    return monthly_regex(src.kpi_daily, src.kpi_def, src.org_unit, as_of)
