"""Configuration compliance of managed assets seen in the 30-day window."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge import fixed_values as fv
from fleetgauge.functions.text import compliance_element
from fleetgauge.functions.time import AsOf, day_age
from fleetgauge.operators.org import org_dimension, org_weights, with_paths
from fleetgauge.plans.kpi import Kpi, Measure, result_rows
from fleetgauge.sources.tables import Sources

FAMILY, TOTAL_FAMILY = "compliance", "compliance_total"
REPORT, PARENT = "R014", "Nb postes total"

# measure -> statuses it counts; None counts an item once whatever its statuses
MEASURES: dict[str, tuple[str, ...] | None] = {
    "checked": None,
    "ok": (fv.STATUS_OK,),
    "ko": (fv.STATUS_KO,),
    "failed": fv.STATUS_FAILED,
}


def _org(src: Sources) -> DataFrame:
    return org_weights(org_dimension(src, fv.ORG_LEVELS_5), F.upper("id"), fv.ORG_LEVELS_5)


def seen_managed(src: Sources, as_of: AsOf) -> DataFrame:
    """Managed assets scanned in the 30-day window, one row per record."""
    return src.managed_assets.filter(day_age("lastscan", as_of) < fv.WINDOW_DAYS).select(
        "tag", F.upper("owner_id").alias("owner_key")
    )


def seen_by_owner(src: Sources, as_of: AsOf) -> DataFrame:
    """Managed assets scanned in the 30-day window: records per (tag, owner)."""

    def build() -> DataFrame:
        return seen_managed(src, as_of).groupBy("tag", "owner_key").agg(F.count(F.lit(1)).alias("records"))

    return src.block(f"seen_managed_{as_of.day}", build)


def compliance_elements(src: Sources, hosts: DataFrame | None = None) -> DataFrame:
    """Distinct (element, item, host) with the statuses reported for it; only ``hosts`` (a column ``tag``) if given."""
    reported = src.compliance
    if hosts is not None:
        reported = reported.join(hosts, reported.host == hosts.tag, "left_semi")
    return (
        reported.groupBy("item", "host")
        .agg(*[F.bool_or(F.col("status") == s).alias(f"is_{s}") for s in (fv.STATUS_OK, fv.STATUS_KO, *fv.STATUS_FAILED)])
        .withColumn("element", compliance_element("item"))
    )


def total_kpi(src: Sources, as_of: AsOf, kpis: list[Kpi]) -> DataFrame:
    """Distinct managed assets per unit; assets of unknown owners are left out."""
    assets = seen_by_owner(src, as_of).filter(F.col("owner_key").isNotNull())
    located = with_paths(assets, _org(src).drop("org_rows"), "owner_key", fv.ORG_LEVELS_5, how="inner")
    counts = located.groupBy("maille").agg(F.countDistinct("tag").alias("n"))
    return result_rows(counts, fv.UNIT_GROUP_5, [Measure(k, F.col("n")) for k in kpis])


def _tuples(measure: str) -> tuple[Column, Column]:
    """(value, rows) an (item, host) pair adds. Statuses are distinct, so each adds at most one."""
    statuses = MEASURES[measure]
    named = F.when(F.col("item").isNotNull(), 1).otherwise(0)
    if statuses is None:
        return named, F.lit(1)
    hits = [F.when(F.coalesce(f"is_{s}", F.lit(False)), 1).otherwise(0) for s in statuses]
    rows = sum(hits[1:], hits[0])
    if measure == "failed":
        # not applicable is counted by host, the others by item; a group of zeros is kept
        value = sum((h if s == "notapplicable" else h * named for s, h in zip(statuses, hits)), F.lit(0))
        return value, F.lit(1)
    return rows * named, rows


def element_kpis(src: Sources, as_of: AsOf, kpis: list[Kpi]) -> DataFrame:
    """Compliance measures per element and unit.

    Items of hosts that count are summed per (element, host), then per (element, owner), and
    only these sums meet the directories.
    """
    assets = seen_by_owner(src, as_of)
    pairs = compliance_elements(src, assets.select("tag"))
    for k in kpis:
        value, rows = _tuples(k.spec)
        pairs = pairs.withColumn(f"v_{k.spec}", value).withColumn(f"r_{k.spec}", rows)
    sums = [F.sum(f"{p}_{k.spec}").alias(f"{p}_{k.spec}") for k in kpis for p in "vr"]
    per_host = pairs.groupBy("element", "host").agg(*sums)

    joined = per_host.join(assets, per_host.host == assets.tag, "inner")
    per_owner = joined.groupBy("element", "owner_key").agg(
        *[F.sum(F.col(f"{p}_{k.spec}") * F.col("records")).alias(f"{p}_{k.spec}") for k in kpis for p in "vr"]
    )
    located = with_paths(per_owner, _org(src), "owner_key", fv.ORG_LEVELS_5, how="inner")
    wide = located.groupBy("element", "maille").agg(
        *[F.sum(F.col(f"{p}_{k.spec}") * F.col("org_rows")).alias(f"{p}_{k.spec}") for k in kpis for p in "vr"]
    )
    measures = [
        Measure(k, F.col(f"v_{k.spec}"), F.col(f"r_{k.spec}") > 0, F.concat("element", F.lit(k.indicateur))) for k in kpis
    ]
    return result_rows(wide, fv.UNIT_GROUP_5, measures)


def shared_blocks(src: Sources, as_of: AsOf, kpis: list[Kpi]) -> list[Callable[[], DataFrame]]:
    """Blocks that both families read, when both are needed."""
    if len({k.family for k in kpis} & {FAMILY, TOTAL_FAMILY}) < 2:
        return []
    return [lambda: seen_by_owner(src, as_of), lambda: org_dimension(src, fv.ORG_LEVELS_5)]


KPIS = [
    Kpi("compliance_total", REPORT, PARENT, PARENT, TOTAL_FAMILY),
    Kpi("compliance_checked", REPORT, "- Nb postes contrôlés", PARENT, FAMILY, "checked"),
    Kpi("compliance_ok", REPORT, "- Nb postes conformes", PARENT, FAMILY, "ok"),
    Kpi("compliance_ko", REPORT, "- Nb postes non conformes", PARENT, FAMILY, "ko"),
    Kpi("compliance_failed", REPORT, "- Nb postes en echec nonapplicable nondetecte", PARENT, FAMILY, "failed"),
]
