"""Distinct assets per unit, under conditions on the asset and on its last scan."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge import fixed_values as fv
from fleetgauge.functions.text import account_or_excluded, is_connected
from fleetgauge.functions.time import AsOf, day_age
from fleetgauge.operators.org import org_dimension, org_weights, with_paths
from fleetgauge.plans.kpi import Kpi, Measure, result_rows
from fleetgauge.sources.tables import Sources


@dataclass(frozen=True)
class CountSpec:
    """Which assets count. ``scan``: condition on the age of a scan; ``never``: no scan at all."""

    asset: Callable[[], Column] | None = None
    scan: Callable[[Column], Column] | None = None
    never: bool = False


def not_excluded() -> Column:
    """Owner is a personal account; an unknown owner is dropped."""
    return F.coalesce(account_or_excluded("owner_id") != fv.GENERIC_ACCOUNT, F.lit(False))


def connected() -> Column:
    return is_connected("network")


def asset_counts(src: Sources, as_of: AsOf, kpis: list[Kpi]) -> DataFrame:
    """All requested counts in one pass.

    Conditions become flags, or-ed per (tag, owner) before the first shuffle and per
    (unit, tag) before the last one. Any number of distinct counts then costs one two-step
    aggregation, where several ``count(distinct ...)`` would copy each row once per count.
    """
    specs: list[CountSpec] = [k.spec for k in kpis]
    true = F.lit(True)
    flags = [f"hit_{i}" for i in range(len(kpis))]

    rows = (
        src.assets.select(
            "tag",
            F.upper("owner_id").alias("owner_key"),
            *[(s.asset() if s.asset else true).alias(f) for s, f in zip(specs, flags, strict=True)],
        )
        .groupBy("tag", "owner_key")
        .agg(*[F.bool_or(f).alias(f) for f in flags])
    )

    scanned = [i for i, s in enumerate(specs) if s.scan or s.never]
    if scanned:
        age = day_age("lastscan", as_of)
        per_host = src.last_seen.groupBy(F.col("hostname").alias("scan_host")).agg(
            *[F.coalesce(F.bool_or(specs[i].scan(age)), F.lit(False)).alias(f"scan_{i}") for i in scanned if specs[i].scan],
            F.lit(True).alias("has_scan"),
        )
        how = "inner" if all(s.scan for s in specs) else "left_anti" if all(s.never for s in specs) else "left"
        rows = rows.join(per_host, rows.tag == per_host.scan_host, how)
        if how != "left_anti":
            for i in scanned:
                reached = F.col("scan_host").isNull() if specs[i].never else F.coalesce(f"scan_{i}", F.lit(False))
                rows = rows.withColumn(flags[i], F.col(flags[i]) & reached)
    any_hit = F.greatest(*flags) if len(flags) > 1 else F.col(flags[0])
    rows = rows.filter(any_hit).select("tag", "owner_key", *flags)

    org = org_weights(org_dimension(src), F.upper("id")).drop("org_rows")
    located = with_paths(rows, org, "owner_key", spread_by=["tag"])
    per_tag = located.groupBy("maille", "tag").agg(*[F.bool_or(f).alias(f) for f in flags])
    wide = per_tag.groupBy("maille").agg(
        *[F.count_if(F.col(f) & F.col("tag").isNotNull()).alias(f"n_{f}") for f in flags],
        *[F.bool_or(f).alias(f) for f in flags],
    )
    measures = [Measure(k, F.col(f"n_{f}"), F.col(f)) for k, f in zip(kpis, flags, strict=True)]
    return result_rows(wide, fv.UNIT_GROUP_6, measures)


def _younger(days: int) -> Callable[[Column], Column]:
    return lambda age: age < days


def _between(low: int, high: int) -> Callable[[Column], Column]:
    return lambda age: age.between(low, high)


def _older(days: int) -> Callable[[Column], Column]:
    return lambda age: age >= days


FAMILY = "counts"
R026, R039 = "R026", "R039"

KPIS = [
    Kpi("kpi_assets", R026, "Nb postes", "Nb postes", FAMILY, CountSpec()),
    Kpi(
        "assets_connected_30", R026, "Nb postes connectes 30 js", "Nb postes", FAMILY,
        CountSpec(asset=connected, scan=_younger(fv.WINDOW_DAYS)),
    ),
    Kpi("never_seen", R026, "Nb postes pas vus", "Nb postes", FAMILY, CountSpec(never=True)),
    Kpi(
        "exclude_generic_accounts", R026, "Nb postes utilisateur non exclu", "Nb postes", FAMILY,
        CountSpec(asset=not_excluded),
    ),
    Kpi("recency_0_7", R026, "Nb postes vus entre 1 et 7 jours", "Nb postes", FAMILY, CountSpec(scan=_younger(fv.FRESH_DAYS))),
    Kpi("recency_8_30", R026, "Nb postes vus entre 8 et 30 jours", "Nb postes", FAMILY, CountSpec(scan=_between(8, 30))),
    Kpi("recency_31_60", R026, "Nb postes vus entre 31 et 60 jours", "Nb postes", FAMILY, CountSpec(scan=_between(31, 60))),
    Kpi(
        "recency_61_plus", R026, "Nb postes vus il y a plus de 60 jours", "Nb postes", FAMILY,
        CountSpec(scan=_older(fv.STALE_DAYS)),
    ),
    Kpi("patching_assets", R039, "Patching", "Patching", FAMILY, CountSpec()),
    Kpi("assets_connected", R039, "Nb postes connectés", "Patching", FAMILY, CountSpec(asset=connected)),
]
