"""Accuracy and freshness of register attributes.

Accurate: the attribute compares equal (code 1). Fresh: accurate, and the asset was seen
recently. Variants restrict to assets scanned in the 30-day window, or to connected ones.

Owner and unit columns come from the directories, which list an owner several times. All
sums are therefore taken per owner before the directories are joined: the joins move one
row per owner, not one per asset, and an owner of very many assets is reduced map-side.
Where the agent's user or the responsible is compared too, it is one row per owner and
such person; rows without an owner or user are then spread over tasks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge import fixed_values as fv
from fleetgauge.functions import accuracy as acc
from fleetgauge.functions.text import account_or_excluded, is_connected, is_personal_account, key_part, norm_key
from fleetgauge.functions.time import AsOf, day_age
from fleetgauge.operators.inventory import (
    Selection,
    agent_latest,
    directory_latest,
    latest_by_selection,
    per_selection,
    scans_by_host,
    unit_by_id,
)
from fleetgauge.operators.org import left_join_spread, org_dimension, org_single, org_weights, with_paths
from fleetgauge.plans.kpi import Kpi, Measure, result_rows
from fleetgauge.sources.tables import Sources

FAMILY = "quality"


@dataclass(frozen=True)
class QualitySpec:
    """``attribute`` with the asset selection.

    ``fresh_days``: also seen less than so many days ago. ``within_window``: only assets
    scanned in the 30-day window. ``connected``: only connected assets. ``min_age``: only
    assets whose normalised tag was scanned at least so many days ago. ``reparse_code``:
    read the responsible's sub-unit code as if it still were in parentheses.
    """

    attribute: str
    fresh_days: int | None = None
    within_window: bool = False
    connected: bool = False
    min_age: int | None = None
    reparse_code: bool = False


# ---- one row per asset (manufacturer, model, MAC, virtual, user, all of them) ---------------
# agent column -> its name beside the register's columns
_AGENT_ALIASES = {
    "manufacturer": "agent_manufacturer",
    "description": "agent_description",
    "is_virtual": "agent_virtual",
    "mac_list": "agent_macs",
    "top_user": "agent_user",
    "top_user_or_excluded": "agent_account",
}


@dataclass(frozen=True)
class _Single:
    """An attribute: register columns, agent columns and the code that compares them."""

    columns: tuple[str, ...]
    agent: tuple[str, ...]
    code: Callable[[], Column]
    model: bool = False


SINGLE = {
    "manufacturer": _Single(
        ("manufacturer",), ("manufacturer",), lambda: acc.text_code(F.col("agent_manufacturer"), F.col("manufacturer"))
    ),
    "model": _Single(
        (), ("description",), lambda: acc.text_code(F.col("agent_description"), F.col("model_number")), model=True
    ),
    "mac": _Single(("mac",), ("mac_list",), lambda: acc.list_code(F.col("agent_macs"), F.col("mac"))),
    "virtual": _Single(
        ("is_virtual",), ("is_virtual",), lambda: acc.virtual_code(F.col("agent_virtual"), F.col("is_virtual"))
    ),
    "user": _Single(
        (), ("top_user_or_excluded",), lambda: acc.user_code(F.col("agent_account"), account_or_excluded("owner_id"))
    ),
}
# all of these, plus the user entity, make an asset fresh as a whole
COMPOSITE = ("model", "manufacturer", "virtual")


def _parts(attribute: str) -> tuple[str, ...]:
    return COMPOSITE if attribute == "all" else (attribute,)


def _selection(spec: QualitySpec) -> Selection:
    return Selection(any(SINGLE[p].model for p in _parts(spec.attribute)), spec.within_window)


def _selections(specs: list[QualitySpec]) -> list[Selection]:
    return sorted({_selection(s) for s in specs})


def compared_assets(src: Sources, as_of: AsOf, specs: list[QualitySpec]) -> DataFrame:
    """Latest record per normalised tag and selection, with the latest agent record beside it."""
    return per_selection(_flagged_assets(src, as_of, specs), _selections(specs))


def _flagged_assets(src: Sources, as_of: AsOf, specs: list[QualitySpec]) -> DataFrame:
    """The same, a record of several selections once, with a flag for each."""
    attributes = sorted({p for s in specs for p in _parts(s.attribute)})
    columns = ["owner_id", *(c for a in attributes for c in SINGLE[a].columns)]
    if any(s.connected for s in specs):
        columns.append("network")
    with_scan = any(s.fresh_days for s in specs)
    assets = latest_by_selection(src, as_of, columns, _selections(specs), with_scan)
    wanted = {c for a in attributes for c in SINGLE[a].agent}
    if any(s.attribute == "all" for s in specs):
        wanted.add("top_user")
    agent = agent_latest(src, wanted).select("host", *[F.col(c).alias(_AGENT_ALIASES[c]) for c in sorted(wanted)])
    return assets.join(agent, assets.tag_key == agent.host, "left").drop("host")


def _single_kpis(src: Sources, as_of: AsOf, kpis: list[Kpi]) -> DataFrame:
    """KPIs that count one record per asset."""
    specs: list[QualitySpec] = [k.spec for k in kpis]
    rows = _flagged_assets(src, as_of, specs).withColumn("owner_key", F.upper("owner_id"))
    min_age = specs[0].min_age
    times = F.lit(1)
    if min_age is not None:
        old = src.last_seen.filter(day_age("lastscan", as_of) >= min_age)
        old = old.groupBy(F.col("hostname").alias("old_host")).agg(F.count(F.lit(1)).alias("old_scans"))
        rows = rows.join(old, rows.tag_key == old.old_host, "inner")
        times = F.col("old_scans")

    attributes = sorted({p for s in specs for p in _parts(s.attribute)})
    days = sorted({s.fresh_days for s in specs if s.fresh_days is not None})
    age = day_age("lastscan", as_of)
    flags = {f"equal_{a}": SINGLE[a].code() == fv.CODE_EQUAL for a in attributes}
    flags |= {f"seen_{d}": F.coalesce(age < d, F.lit(False)) for d in days}
    if any(s.connected for s in specs):
        flags["connected"] = is_connected("network")
    rows = rows.withColumns(flags)

    composite = any(s.attribute == "all" for s in specs)
    keys = ["owner_key", "agent_user"] if composite else ["owner_key"]
    aggregates = []
    for i, s in enumerate(specs):
        selected = [_selection(s).flag()] + ([F.col("connected")] if s.connected else [])
        equal = [F.col(f"equal_{p}") for p in _parts(s.attribute)]
        if s.fresh_days is not None:
            equal.append(F.col(f"seen_{s.fresh_days}"))
        hit = reduce(Column.__and__, [*selected, *equal])
        aggregates += [
            F.sum(F.when(hit, times).otherwise(0)).alias(f"v_{i}"),
            F.bool_or(reduce(Column.__and__, selected)).alias(f"p_{i}"),
        ]
    grouped = rows.groupBy(*keys).agg(*aggregates)

    org = org_dimension(src)
    same_entity = F.lit(True)
    if composite:
        units = unit_by_id(org)
        grouped = left_join_spread(grouped, units, "agent_user", "um_id", ["owner_key"])
        same_entity = acc.entity_code(F.col("top_um"), F.col("um")) == fv.CODE_EQUAL
    located = with_paths(grouped, org_single(org, F.upper("id")), "owner_key", spread_by=keys[1:])
    located = located.withColumn("org_rows_all", F.when(same_entity, F.col("org_rows")).otherwise(0))
    return _per_unit(located, kpis, ["org_rows_all" if s.attribute == "all" else "org_rows" for s in specs])


def _per_unit(located: DataFrame, kpis: list[Kpi], factors: list[str]) -> DataFrame:
    """Sum the KPIs' values per path, each times the directory rows in its factor column."""
    wide = located.groupBy("maille").agg(
        *[F.sum(F.col(f"v_{i}") * F.col(factor)).alias(f"v_{i}") for i, factor in enumerate(factors)],
        *[F.bool_or(f"p_{i}").alias(f"p_{i}") for i in range(len(kpis))],
    )
    measures = [Measure(k, F.col(f"v_{i}"), F.col(f"p_{i}")) for i, k in enumerate(kpis)]
    return result_rows(wide, fv.UNIT_GROUP_6, measures)


# ---- every register record (OS, entity, responsible, building, site) ------------------------
RECORDS = ("os", "entity", "responsible", "building", "site")
_LOCATION_TABLES = {"building": "loc_building", "site": "loc_site"}


def register_records(src: Sources, columns: dict[str, Column]) -> DataFrame:
    """Register records counted per (tag, owner, needed columns), so copies travel once."""
    return (
        src.assets.select("tag", F.upper("owner_id").alias("owner_key"), *[c.alias(n) for n, c in columns.items()])
        .groupBy("tag", "owner_key", *columns)
        .agg(F.count(F.lit(1)).alias("records"))
    )


def compared_records(src: Sources, as_of: AsOf, specs: list[QualitySpec]) -> DataFrame:
    """Register records with the scan, location, directory and agent columns ``specs`` need.

    What belongs to the raw tag is joined first, what belongs to the normalised tag second,
    so that two shuffles of the records serve all joins. Every right side has one row per key.
    """
    attributes = {s.attribute for s in specs}
    columns: dict[str, Column] = {}
    if "os" in attributes:
        columns["os"] = F.col("os")
    if "responsible" in attributes:
        columns |= {"resp_key": F.upper("resp_id"), "personal": is_personal_account("owner_id")}
    if any(s.connected for s in specs):
        columns["connected"] = is_connected("network")
    rows = register_records(src, columns)

    if any(s.fresh_days or s.within_window for s in specs):
        scans = scans_by_host(src, as_of).drop("lastscan")
        if all(s.within_window for s in specs):
            rows = rows.join(scans.filter("window_scans > 0"), rows.tag == scans.scan_host, "inner")
        else:
            rows = rows.join(scans, rows.tag == scans.scan_host, "left")
    for attribute, table in _LOCATION_TABLES.items():
        if attribute in attributes:
            right = F.count_if(acc.location_code(F.col("verdict")) == fv.CODE_EQUAL).alias(f"right_{attribute}")
            verdicts = src[table].groupBy(F.col("tag").alias(f"tag_{attribute}")).agg(right)
            rows = rows.join(verdicts, rows.tag == verdicts[f"tag_{attribute}"], "left")
    rows = rows.withColumn("tag_key", norm_key("tag"))
    if "os" in attributes:
        directory = directory_latest(src)
        rows = rows.join(directory, rows.tag_key == directory.computer, "left")
    if "entity" in attributes:
        agent = agent_latest(src, ["top_user"]).select("host", F.col("top_user").alias("agent_user"))
        rows = rows.join(agent, rows.tag_key == agent.host, "left")
    return rows


def _equal_rows(attribute: str) -> Column:
    """How many equal comparisons a register record enters; those on directory columns come later."""
    if attribute == "os":
        return F.when(acc.os_code(F.col("directory_os"), F.col("os")) == fv.CODE_EQUAL, F.col("records")).otherwise(0)
    if attribute in _LOCATION_TABLES:
        return F.col("records") * F.coalesce(f"right_{attribute}", F.lit(0))
    return F.col("records")


def _record_sums(rows: DataFrame, specs: list[QualitySpec], keys: list[str]) -> DataFrame:
    """Records with an equal comparison, times their scan rows, and presence per spec."""
    scanned = {c: F.coalesce(c, F.lit(0)) for c in ("fresh_scans", "window_scans") if c in rows.columns}
    attributes = sorted({s.attribute for s in specs})
    rows = rows.withColumns(scanned).withColumns({f"n_{a}": _equal_rows(a) for a in attributes})
    out = []
    for i, s in enumerate(specs):
        n, selected = F.col(f"n_{s.attribute}"), []
        if s.fresh_days is not None:
            n = n * F.col("fresh_scans")
        if s.within_window:
            n = n * F.col("window_scans")
            selected.append(F.col("window_scans") > 0)
        if s.connected:
            selected.append(F.col("connected"))
        present = reduce(Column.__and__, selected, F.lit(True))
        out += [F.sum(F.when(present, n).otherwise(0)).alias(f"v_{i}"), F.bool_or(present).alias(f"p_{i}")]
    return rows.groupBy(*keys).agg(*out)


def _record_kpis(src: Sources, as_of: AsOf, kpis: list[Kpi]) -> DataFrame:
    """KPIs that count every register record."""
    specs: list[QualitySpec] = [k.spec for k in kpis]
    attributes = {s.attribute for s in specs}
    keys = ["owner_key"]
    keys += ["agent_user"] if "entity" in attributes else []
    keys += ["resp_key", "personal"] if "responsible" in attributes else []
    sums = _record_sums(compared_records(src, as_of, specs), specs, keys)

    org = org_dimension(src)
    located = with_paths(sums, org_weights(org, F.upper("id"), keep=("um", "dum")), "owner_key", spread_by=keys[1:])
    equal: dict[str, Column] = {}
    if "entity" in attributes:
        units = unit_by_id(org)
        located = left_join_spread(located, units, "agent_user", "um_id", ["owner_key", "maille"])
        equal["entity"] = acc.entity_code(F.col("top_um"), F.col("um")) == fv.CODE_EQUAL
    if "responsible" in attributes:
        # joined on the sub-unit too: directory rows of the responsible that agree, as a count
        resp_dum = key_part(key_part("dum", "(", 2), ")", 1) if specs[0].reparse_code else F.col("dum")
        resp = org.groupBy(F.upper("id").alias("resp_id"), resp_dum.alias("resp_dum")).agg(
            F.count(F.lit(1)).alias("resp_rows")
        )
        located = located.join(resp, (located.resp_key == resp.resp_id) & (located.dum == resp.resp_dum), "left")
        equal["responsible"] = acc.responsible_code(F.col("personal"), F.col("dum"), F.col("resp_dum")) == fv.CODE_EQUAL
    factors = {"responsible": F.col("org_rows") * F.col("resp_rows")}
    located = located.withColumns(
        {f"rows_{a}": F.when(equal.get(a, F.lit(True)), factors.get(a, F.col("org_rows"))).otherwise(0) for a in attributes}
    )
    return _per_unit(located, kpis, [f"rows_{s.attribute}" for s in specs])


def quality_kpis(src: Sources, as_of: AsOf, kpis: list[Kpi]) -> DataFrame:
    """All requested KPIs: one pass for those on one record per asset, one for those on every record."""
    shared: dict[tuple, list[Kpi]] = {}
    for k in kpis:
        shared.setdefault((k.spec.attribute in RECORDS, k.spec.min_age, k.spec.reparse_code), []).append(k)
    frames = [
        (_record_kpis if key[0] else _single_kpis)(src, as_of, group) for key, group in shared.items()
    ]
    return reduce(DataFrame.unionByName, frames)


def shared_blocks(src: Sources, as_of: AsOf, kpis: list[Kpi]) -> list[Callable[[], DataFrame]]:
    """Blocks that both passes read, when both are needed."""
    if len({k.spec.attribute in RECORDS for k in kpis}) < 2:
        return []
    return [lambda: agent_latest(src), lambda: scans_by_host(src, as_of), lambda: org_dimension(src)]


# ---- registry -------------------------------------------------------------------------------
# Attribute -> word used in its indicator labels
ATTRIBUTE_LABELS = {
    "manufacturer": "fabricant",
    "model": "modele",
    "mac": "mac",
    "virtual": "virtual",
    "os": "os",
    "user": "utilisateur",
    "entity": "entite utilisateur",
    "responsible": "dum resp",
    "building": "batiment",
    "site": "nns",
}
WINDOWED = ("manufacturer", "model", "virtual", "entity")


def _kpi(name: str, label: str, spec: QualitySpec) -> Kpi:
    return Kpi(name, "R026", label, "Nb postes", FAMILY, spec)


def _registry() -> list[Kpi]:
    out = []
    for attribute, word in ATTRIBUTE_LABELS.items():
        out.append(_kpi(f"acc_{attribute}", f"Nb postes {word} juste", QualitySpec(attribute)))
        out.append(_kpi(f"fresh_{attribute}", f"Nb postes {word} frais", QualitySpec(attribute, fresh_days=fv.FRESH_DAYS)))
    for attribute in WINDOWED:
        word = ATTRIBUTE_LABELS[attribute]
        out.append(_kpi(f"acc30_{attribute}", f"Nb postes {word} juste 30 js", QualitySpec(attribute, within_window=True)))
        out.append(
            _kpi(
                f"acc30c_{attribute}",
                f"Nb postes {word} connectes juste 30 js",
                QualitySpec(attribute, within_window=True, connected=True),
            )
        )
    window = {"fresh_days": fv.WINDOW_DAYS, "within_window": True}
    out.append(_kpi("fresh_all", "Nb postes frais", QualitySpec("all", fresh_days=fv.FRESH_DAYS)))
    out.append(_kpi("fresh_all_30", "Nb postes frais 30 js", QualitySpec("all", **window)))
    out.append(_kpi("fresh_all_30c", "Nb postes frais connectes 30 js", QualitySpec("all", connected=True, **window)))
    return out


KPIS = _registry()

# Variants that keep an inconsistency of the original definitions, for comparing old figures.
PARITY_KPIS = [
    _kpi("fresh_all_parity", "Nb postes frais", QualitySpec("all", fresh_days=fv.FRESH_DAYS, min_age=fv.STALE_DAYS)),
    _kpi("acc_responsible_parity", "Nb postes dum resp juste", QualitySpec("responsible", reparse_code=True)),
    _kpi(
        "fresh_responsible_parity", "Nb postes dum resp frais",
        QualitySpec("responsible", fresh_days=fv.FRESH_DAYS, reparse_code=True),
    ),
    _kpi("acc30_virtual_parity", "Nb postes virtual juste 30 js", QualitySpec("virtual")),
    _kpi("acc30c_virtual_parity", "Nb postes virtual connectes juste 30 js", QualitySpec("virtual", connected=True)),
]
