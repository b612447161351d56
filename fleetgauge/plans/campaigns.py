"""Patch campaigns: hosts targeted, patched and in total, per campaign milestone."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge import fixed_values as fv
from fleetgauge.functions.text import first_paren_code, is_connected
from fleetgauge.functions.time import AsOf, days_after_is_now
from fleetgauge.operators.org import org_dimension, org_weights, with_paths
from fleetgauge.operators.skew import HeavyKeys, heavy_keys
from fleetgauge.plans.kpi import Kpi, Measure, result_rows
from fleetgauge.sources.tables import Sources

FAMILY, TARGETED_FAMILY, REPORT = "campaigns", "campaigns_targeted", "R039"


@dataclass(frozen=True)
class CampaignSpec:
    """``state``: only this patch state. ``not_state``: any known state but this one."""

    state: int | None = None
    not_state: int | None = None
    connected: bool = False


def milestone(as_of: AsOf) -> Column:
    """Milestone a campaign group reaches now; the bare group in between, ``''`` for other groups."""
    result = None
    for mark, steps in fv.CAMPAIGN_MILESTONES:
        inner = None
        for days, label in steps:
            reached = days_after_is_now("start_date", days, as_of)
            inner = F.when(reached, label) if inner is None else inner.when(reached, label)
        group = F.col("grp").contains(mark)
        inner = inner.otherwise(mark)
        result = F.when(group, inner) if result is None else result.when(group, inner)
    return result.otherwise("")


def campaign_list(src: Sources, as_of: AsOf) -> DataFrame:
    """Workstation campaigns that started in the last 60 days, with their milestone."""
    first_day = F.date_sub(as_of.today, fv.CAMPAIGN_WINDOW_DAYS)
    return src.campaigns.filter((F.col("kind") == fv.CAMPAIGN_KIND) & (F.col("start_date") >= first_day)).select(
        "grp", "type", "start_date", milestone(as_of).alias("milestone"), "kind"
    )


def recent_hosts(src: Sources, as_of: AsOf) -> DataFrame:
    """Hosts scanned in the last 30 days."""
    first_day = F.date_sub(as_of.today, fv.CAMPAIGN_SCAN_DAYS)
    return src.last_seen.filter(F.col("lastscan").cast("date") >= first_day).select(F.col("hostname").alias("recent_host"))


def owner_or_department() -> Column:
    return F.coalesce("owner_id", "dept_id")


def campaign_membership(src: Sources, as_of: AsOf) -> DataFrame:
    """Campaign hosts in the register and scanned recently: owner, state, network, milestone."""
    hosts = src.campaign_hosts.filter(F.col("kind") == fv.CAMPAIGN_KIND).select("host", "grp", "type", "state")
    assets = src.assets_os.select("tag", owner_or_department().alias("owner"), "network")
    recent = recent_hosts(src, as_of)
    campaigns = campaign_list(src, as_of).select("grp", "type", "milestone")
    return (
        hosts.join(assets, hosts.host == assets.tag, "inner")
        .join(recent, F.col("tag") == recent.recent_host, "left_semi")
        .join(campaigns, ["grp", "type"], "inner")
        .select(
            F.concat("grp", F.lit(" - "), "type").alias("campaign"), "host", "state", "owner", "network", "milestone"
        )
    )


def _reported_campaigns(src: Sources, as_of: AsOf) -> DataFrame:
    """Campaigns per (group, type) and milestone, without those between two milestones."""
    between = [mark for mark, _ in fv.CAMPAIGN_MILESTONES]
    return (
        campaign_list(src, as_of)
        .filter(~F.col("milestone").isin(*between))
        .groupBy("grp", "type", "milestone")
        .agg(F.count(F.lit(1)).alias("campaign_rows"))
    )


def _org(src: Sources) -> DataFrame:
    return org_weights(org_dimension(src, code=first_paren_code), F.col("id"))


def _targets(src: Sources, as_of: AsOf) -> DataFrame:
    """Rows of reported campaigns, counted per host, label and state; hosts restricted to recent scans.

    Hosts that were not scanned go first, and hosts are reduced while the host still deals them
    out. A campaign may hold the whole fleet: the hosts of those that hold many are split by a
    second join key, for which these campaigns are repeated.
    """
    targeted = src.campaign_hosts.filter(F.col("kind") == fv.CAMPAIGN_KIND)
    recent = recent_hosts(src, as_of)
    targeted = targeted.join(recent, targeted.host == recent.recent_host, "left_semi")
    heavy = heavy_campaigns(src)
    reported = heavy.repeated(_reported_campaigns(src, as_of))
    counted = targeted.groupBy("host", "grp", "type", "state").agg(F.count(F.lit(1)).alias("rows"))
    return (
        heavy.split(counted, ["host"])
        .join(reported, ["grp", "type", "part"], "inner")
        .select(
            "host", F.concat("grp", F.lit(" - "), "type").alias("campaign"), "milestone", "state",
            (F.col("rows") * F.col("campaign_rows")).alias("targets"),
        )
    )


def heavy_campaigns(src: Sources) -> HeavyKeys:
    """Campaigns that hold many of the targeted hosts."""
    targeted = src.campaign_hosts.filter(F.col("kind") == fv.CAMPAIGN_KIND)
    return src.known("heavy_campaigns", lambda: heavy_keys(targeted, ["grp", "type"]))


def _members(src: Sources, as_of: AsOf) -> DataFrame:
    """Hosts of reported campaigns with each owner that the register has for them, counted per state and connection."""

    def build() -> DataFrame:
        hosts, recent = _targets(src, as_of), recent_hosts(src, as_of)
        register = src.assets_os.select(
            "tag", owner_or_department().alias("owner"), is_connected("network").alias("connected")
        )
        register = register.join(recent, register.tag == recent.recent_host, "left_semi")
        assets = register.groupBy("tag", "owner", "connected").agg(F.count(F.lit(1)).alias("records"))
        return hosts.join(assets, hosts.host == assets.tag, "inner").drop("tag")

    return src.block(f"campaign_members_{as_of.day}", build)


def _label(suffix: str) -> Column:
    """'group - type - milestone' and a suffix."""
    return F.concat("campaign", F.lit(" - "), "milestone", F.lit(suffix))


def campaign_kpis(src: Sources, as_of: AsOf, kpis: list[Kpi]) -> DataFrame:
    """Campaign counts by patch state; a campaign without any patched host keeps its zero."""
    specs: list[CampaignSpec] = [k.spec for k in kpis]

    def wanted(s: CampaignSpec) -> Column:
        return F.col("state") == s.state if s.state is not None else F.col("state") != s.not_state

    joined = _members(src, as_of)
    sums = []
    for i, s in enumerate(specs):
        selected = F.col("connected") if s.connected else F.lit(True)
        sums += [
            F.sum(F.when(selected & wanted(s), F.col("targets") * F.col("records")).otherwise(0)).alias(f"v_{i}"),
            F.bool_or(selected).alias(f"p_{i}"),
        ]
    per_owner = joined.groupBy("owner", "campaign", "milestone").agg(*sums)
    located = with_paths(per_owner, _org(src), "owner", how="inner")
    wide = located.groupBy("maille", "campaign", "milestone").agg(
        *[F.sum(F.col(f"v_{i}") * F.col("org_rows")).alias(f"v_{i}") for i in range(len(kpis))],
        *[F.bool_or(f"p_{i}").alias(f"p_{i}") for i in range(len(kpis))],
    )
    measures = [
        Measure(k, F.col(f"v_{i}"), F.col(f"p_{i}"), _label(k.indicateur), _label(k.indicateur_parent))
        for i, k in enumerate(kpis)
    ]
    return result_rows(wide, fv.UNIT_GROUP_6, measures)


def targeted_kpi(src: Sources, as_of: AsOf, kpis: list[Kpi]) -> DataFrame:
    """Distinct hosts per campaign milestone and unit."""
    joined = _members(src, as_of).select("host", "owner", "campaign", "milestone").distinct()
    located = with_paths(joined, _org(src).drop("org_rows"), "owner", how="inner")
    counts = located.groupBy("maille", "campaign", "milestone").agg(F.countDistinct("host").alias("n"))
    return result_rows(counts, fv.UNIT_GROUP_6, [Measure(k, F.col("n"), indicateur=_label(k.indicateur)) for k in kpis])


def shared_blocks(src: Sources, as_of: AsOf, kpis: list[Kpi]) -> list[Callable[[], DataFrame]]:
    """Blocks that both families read, when both are needed."""
    if len({k.family for k in kpis} & {FAMILY, TARGETED_FAMILY}) < 2:
        return []
    return [lambda: _members(src, as_of)]


_DONE, _TOTAL = fv.CAMPAIGN_DONE, fv.CAMPAIGN_NOT_TARGETED
KPIS = [
    Kpi("patch_targeted", REPORT, " -Patching", "Patching", TARGETED_FAMILY),
    Kpi("patch_success", REPORT, " -Poste", " -Total", FAMILY, CampaignSpec(state=_DONE)),
    Kpi("patch_total", REPORT, " -Total", " -Total", FAMILY, CampaignSpec(not_state=_TOTAL)),
    Kpi(
        "patch_success_connected", REPORT, " -Poste connectés", " -Total connectés", FAMILY,
        CampaignSpec(state=_DONE, connected=True),
    ),
    Kpi(
        "patch_total_connected", REPORT, " -Total connectés", " -Total connectés", FAMILY,
        CampaignSpec(not_state=_TOTAL, connected=True),
    ),
]
