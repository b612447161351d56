"""Supported and unsupported operating systems, by patch state."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge import fixed_values as fv
from fleetgauge.functions.time import AsOf, elapsed_days
from fleetgauge.operators.org import org_dimension, org_weights, with_paths
from fleetgauge.plans.kpi import Kpi, Measure, result_rows
from fleetgauge.sources.tables import Sources

FAMILY, REPORT = "support", "R031"


@dataclass(frozen=True)
class SupportSpec:
    """``supported``: support ends after the run day, else before it. ``states``: None is any."""

    supported: bool
    states: tuple[int, ...] | None = None


def support_split(src: Sources, as_of: AsOf) -> DataFrame:
    """Assets on either side of their end of support; ending today is on neither."""
    dated = src.asset_support.filter(F.col("support_end").isNotNull() & (F.col("support_end") != as_of.today))
    return dated.withColumn("supported", F.col("support_end") > as_of.today)


def support_kpis(src: Sources, as_of: AsOf, kpis: list[Kpi]) -> DataFrame:
    """All requested counts in one pass.

    Scan rows and state rows per host multiply an asset's count, as the joins of separate
    queries would, but enter as counts: each host joins one row. The owner id compares
    case-sensitively here.
    """
    specs: list[SupportSpec] = [k.spec for k in kpis]
    assets = support_split(src, as_of)
    sides = {s.supported for s in specs}
    if len(sides) == 1:
        assets = assets.filter(F.col("supported") == next(iter(sides)))
    assets = assets.groupBy("tag", "owner_id", "supported").agg(F.count(F.lit(1)).alias("records"))

    seen = src.last_seen.filter(elapsed_days("lastscan", as_of) < fv.WINDOW_DAYS)
    seen = seen.groupBy(F.col("hostname").alias("scan_host")).agg(F.count(F.lit(1)).alias("scans"))
    rows = assets.join(seen, assets.tag == seen.scan_host, "inner")

    wanted = sorted({st for s in specs for st in s.states or ()})
    if wanted:
        states = src.patch_state.filter(F.col("state").isin(*wanted))
        states = states.groupBy(F.col("host").alias("state_host")).agg(
            *[F.count_if(F.col("state") == st).alias(f"state_{st}") for st in wanted]
        )
        how = "left" if any(s.states is None for s in specs) else "inner"
        rows = rows.join(states, rows.tag == states.state_host, how)

    sums = []
    for i, s in enumerate(specs):
        n = F.col("records") * F.col("scans")
        if s.states is not None:
            counts = [F.coalesce(f"state_{st}", F.lit(0)) for st in s.states]
            n = n * sum(counts[1:], counts[0])
        sums.append(F.sum(F.when(F.col("supported") == s.supported, n).otherwise(0)).alias(f"v_{i}"))
    per_owner = rows.groupBy("owner_id").agg(*sums)

    located = with_paths(per_owner, org_weights(org_dimension(src), F.col("id")), "owner_id")
    wide = located.groupBy("maille").agg(
        *[F.sum(F.col(f"v_{i}") * F.col("org_rows")).alias(f"v_{i}") for i in range(len(kpis))]
    )
    return result_rows(
        wide, fv.UNIT_GROUP_6, [Measure(k, F.col(f"v_{i}"), F.col(f"v_{i}") > 0) for i, k in enumerate(kpis)]
    )


# Indicator labels
_SUPPORTED, _UNSUPPORTED = "Nb postes os supporté", "Nb postes os non supporté"


def _kpi(name: str, label: str, parent: str, supported: bool, states: tuple[int, ...] | None = None) -> Kpi:
    return Kpi(name, REPORT, label, parent, FAMILY, SupportSpec(supported, states))


KPIS = [
    _kpi("support_all", _SUPPORTED, _SUPPORTED, True),
    _kpi("support_uptodate", _SUPPORTED + " a jour", _SUPPORTED, True, fv.STATE_UP_TO_DATE),
    _kpi("support_running", _SUPPORTED + " en cours", _SUPPORTED, True, fv.STATE_RUNNING),
    _kpi("support_error", _SUPPORTED + " en erreur", _SUPPORTED, True, fv.STATE_ERROR),
    _kpi("support_unseen", _SUPPORTED + " non vus", _SUPPORTED, True, fv.STATE_UNSEEN),
    _kpi("support_reboot", _SUPPORTED + " en attente de redémarrage", _SUPPORTED, True, fv.STATE_REBOOT),
    _kpi("unsupport_all", _UNSUPPORTED, _UNSUPPORTED, False),
    _kpi("unsupport_uptodate", _UNSUPPORTED + " a jour", _UNSUPPORTED, False, fv.STATE_UP_TO_DATE),
    _kpi("unsupport_running", _UNSUPPORTED + " en cours", "Nb postes", False, fv.STATE_RUNNING),
    _kpi("unsupport_error", _UNSUPPORTED + " en erreur", _UNSUPPORTED, False, fv.STATE_ERROR),
    _kpi("unsupport_unseen", _UNSUPPORTED + " non vus", _UNSUPPORTED, False, fv.STATE_UNSEEN),
    _kpi("unsupport_reboot", _UNSUPPORTED + " attente redémarrage", _UNSUPPORTED, False, fv.STATE_REBOOT),
]
