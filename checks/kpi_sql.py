"""SQL counterparts of the KPIs: plain joins, filters and groups over whole tables."""

from __future__ import annotations

from checks.sql_text import PATH5, PATH6, TODAY, account, age, code, elapsed, path, result
from fleetgauge import fixed_values as fv
from fleetgauge.plans.kpi import Kpi
from fleetgauge.plans.quality import QualitySpec
from fleetgauge.plans.registry import BY_NAME

OWNER = "LEFT JOIN org6 u ON upper(u.id) = upper(a.owner_id)"
SCAN = "s ON s.hostname = a.tag"
CONNECTED = "coalesce(a.network, '') <> 'Hors RLE'"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# ---- counts --------------------------------------------------------------------------------
_COUNT_RESTS = {
    "kpi_assets": "",
    "patching_assets": "",
    "assets_connected": f"WHERE {CONNECTED}",
    "assets_connected_30": f"LEFT JOIN last_seen {SCAN} WHERE {age('s.lastscan')} < 31 AND {CONNECTED}",
    "never_seen": f"LEFT JOIN last_seen {SCAN} WHERE s.hostname IS NULL",
    "exclude_generic_accounts": f"WHERE {account('a.owner_id')} <> 'Exclu'",
    "recency_0_7": f"JOIN last_seen {SCAN} AND {age('s.lastscan')} < 8",
    "recency_8_30": f"JOIN last_seen {SCAN} AND {age('s.lastscan')} BETWEEN 8 AND 30",
    "recency_31_60": f"JOIN last_seen {SCAN} AND {age('s.lastscan')} BETWEEN 31 AND 60",
    "recency_61_plus": f"JOIN last_seen {SCAN} AND {age('s.lastscan')} >= 61",
}


def _counts(k: Kpi) -> str:
    rest = f"FROM assets a {OWNER} {_COUNT_RESTS[k.name]} GROUP BY {PATH6}"
    return result(_q(k.indicateur), _q(k.indicateur_parent), PATH6, fv.UNIT_GROUP_6, "count(DISTINCT a.tag)", rest)


# ---- quality -------------------------------------------------------------------------------
def _rated(reported: str, registered: str, equal: str) -> str:
    missing = f"{reported} IS NULL OR {registered} IS NULL OR trim({reported}) = '' OR trim({registered}) = ''"
    return f"CASE WHEN {missing} THEN 3 WHEN {equal} THEN 1 ELSE 2 END"


def _same_text(reported: str, registered: str) -> str:
    return _rated(reported, registered, f"trim(upper({reported})) = trim(upper({registered}))")


_REGISTERED_ACCOUNT = account("i.owner_id")
SINGLE_CODES = {
    "manufacturer": _same_text("m.manufacturer", "i.manufacturer"),
    "model": _same_text("m.description", "i.model_number"),
    "mac": _rated("m.mac_list", "i.mac", "m.mac_list LIKE concat('%', i.mac, '%')"),
    "virtual": "CASE WHEN coalesce(i.is_virtual, FALSE) = coalesce(m.is_virtual, FALSE) THEN 1 ELSE 2 END",
    "user": f"CASE WHEN m.top_account = 'Exclu' OR ({_REGISTERED_ACCOUNT}) = 'Exclu' THEN 4 "
    f"ELSE {_rated('m.top_account', f'({_REGISTERED_ACCOUNT})', f'm.top_account = ({_REGISTERED_ACCOUNT})')} END",
    "entity": "CASE WHEN t.um IS NULL OR u.um IS NULL THEN 3 WHEN t.um = u.um THEN 1 ELSE 2 END",
}


def asset_latest(model: bool, within: bool) -> str:
    joins = "LEFT JOIN last_seen s ON s.hostname = a.tag"
    columns = "s.lastscan"
    if model:
        joins += " JOIN (SELECT tag, min(model_number) AS model_number FROM asset_model GROUP BY tag) p ON p.tag = a.tag"
        columns += ", p.model_number"
    where = f"WHERE {age('s.lastscan')} < 31" if within else ""
    return (
        f"(SELECT trim(upper(a.tag)) AS tag_key, a.*, {columns} FROM assets a {joins} {where} "
        "QUALIFY row_number() OVER (PARTITION BY trim(upper(a.tag)) ORDER BY a.updated_on DESC NULLS FIRST, a.seq, a.tag) = 1)"
    )


def _single(k: Kpi) -> str:
    s: QualitySpec = k.spec
    parts = ["model", "manufacturer", "virtual", "entity"] if s.attribute == "all" else [s.attribute]
    hit = [f"({SINGLE_CODES[p]}) = 1" for p in parts]
    if s.fresh_days:
        hit.append(f"{age('i.lastscan')} < {s.fresh_days}")
    rest = (
        f"FROM {asset_latest('model' in parts, s.within_window)} i LEFT JOIN agent_last m ON m.host = i.tag_key "
        "LEFT JOIN org_one u ON u.owner_key = upper(i.owner_id) LEFT JOIN um_of_id t ON t.id = m.top_user "
    )
    if s.min_age:
        rest += f"JOIN last_seen o ON o.hostname = i.tag_key AND {age('o.lastscan')} >= {s.min_age} "
    if s.connected:
        rest += "WHERE coalesce(i.network, '') <> 'Hors RLE' "
    valeur = f"sum(CASE WHEN {' AND '.join(hit)} THEN 1 ELSE 0 END)"
    return result(_q(k.indicateur), _q(k.indicateur_parent), PATH6, fv.UNIT_GROUP_6, valeur, rest + f"GROUP BY {PATH6}")


_OS = "trim(upper(d.os))"
_SPELLINGS = [
    f"'{fv.OS_VENDOR_PREFIX}' || replace({_OS}, '{old}', '{new}')" for old, new in (fv.OS_SPELLINGS, fv.OS_SPELLINGS[::-1])
]
OS_CODE = _rated(
    "d.os",
    "a.os",
    f"trim(upper(a.os)) IN ({', '.join([_OS, *_SPELLINGS])})",
)


def responsible_code(dum: str) -> str:
    return f"if(length(a.owner_id) IN {fv.PERSONAL_ACCOUNT_LENGTHS}, {fv.CODE_NOT_APPLICABLE}, {_rated('u.dum', dum, f'u.dum = {dum}')})"


def _records(k: Kpi) -> str:
    s: QualitySpec = k.spec
    joins = {
        "os": "LEFT JOIN directory_last d ON d.computer = trim(upper(a.tag))",
        "entity": "LEFT JOIN agent_last m ON m.host = trim(upper(a.tag)) LEFT JOIN um_of_id t ON t.id = m.top_user",
        "responsible": "LEFT JOIN org6 r ON upper(r.id) = upper(a.resp_id)",
        "building": "LEFT JOIN loc_building l ON l.tag = a.tag",
        "site": "LEFT JOIN loc_site l ON l.tag = a.tag",
    }[s.attribute]
    dum = "split_part(split_part(r.dum, '(', 2), ')', 1)" if s.reparse_code else "r.dum"
    hit = {
        "os": f"({OS_CODE}) = 1",
        "entity": f"({SINGLE_CODES['entity']}) = 1",
        "responsible": f"({responsible_code(dum)}) = 1",
        "building": "l.verdict = 'Juste'",
        "site": "l.verdict = 'Juste'",
    }[s.attribute]
    where = []
    if s.fresh_days or s.within_window:
        joins += " LEFT JOIN last_seen s ON s.hostname = a.tag"
    if s.fresh_days:
        hit += f" AND {age('s.lastscan')} < {s.fresh_days}"
    if s.within_window:
        where.append(f"{age('s.lastscan')} < 31")
    if s.connected:
        where.append(CONNECTED)
    clause = "WHERE " + " AND ".join(where) if where else ""
    rest = f"FROM assets a {OWNER} {joins} {clause} GROUP BY {PATH6}"
    valeur = f"sum(CASE WHEN {hit} THEN 1 ELSE 0 END)"
    return result(_q(k.indicateur), _q(k.indicateur_parent), PATH6, fv.UNIT_GROUP_6, valeur, rest)


def _quality(k: Kpi) -> str:
    return _records(k) if k.spec.attribute in ("os", "entity", "responsible", "building", "site") else _single(k)


# ---- compliance ----------------------------------------------------------------------------
_MANAGED = (
    f"JOIN managed_assets c ON c.tag = e.host AND {age('c.lastscan')} < 31 JOIN org5 u ON upper(u.id) = upper(c.owner_id)"
)


def _compliance(k: Kpi) -> str:
    parent = _q(k.indicateur_parent)
    if k.name == "compliance_total":
        rest = (
            f"FROM managed_assets c JOIN org5 u ON upper(u.id) = upper(c.owner_id) WHERE {age('c.lastscan')} < 31 GROUP BY {PATH5}"
        )
        return result(_q(k.indicateur), parent, PATH5, fv.UNIT_GROUP_5, "count(DISTINCT c.tag)", rest)
    table, valeur = "elements", "count(e.item)"
    if k.spec == "checked":
        table = "(SELECT DISTINCT element, item, host FROM elements)"
    elif k.spec == "ok":
        table = "(SELECT * FROM elements WHERE status LIKE 'compliant')"
    elif k.spec == "ko":
        table = "(SELECT * FROM elements WHERE status LIKE 'noncompliant')"
    else:
        # a failed check without an item counts only where nothing applies
        valeur = f"count(*) FILTER (WHERE e.status IN {fv.STATUS_FAILED} AND (e.item IS NOT NULL OR e.status = 'notapplicable'))"
    rest = f"FROM {table} e {_MANAGED} GROUP BY e.element, {PATH5}"
    return result(f"e.element || {_q(k.indicateur)}", parent, PATH5, fv.UNIT_GROUP_5, valeur, rest)


# ---- support -------------------------------------------------------------------------------
_STATES = {"uptodate": "p.state = 3", "running": "p.state = 7", "error": "p.state = 2 OR p.state = 4", "unseen": "p.state = 8", "reboot": "p.state = 5"}


def _support(k: Kpi) -> str:
    side = "<" if k.name.startswith("un") else ">"
    kind = k.name.split("_")[1]
    state = "" if kind == "all" else "LEFT JOIN patch_state p ON p.host = a.tag"
    where = f"a.support_end {side} {TODAY} AND {elapsed('s.lastscan')} < 31"
    if kind != "all":
        where += f" AND ({_STATES[kind]})"
    rest = (
        f"FROM asset_support a LEFT JOIN last_seen s ON a.tag = s.hostname {state} "
        f"LEFT JOIN org6 u ON a.owner_id = u.id WHERE {where} GROUP BY {PATH6}"
    )
    return result(_q(k.indicateur), _q(k.indicateur_parent), PATH6, fv.UNIT_GROUP_6, "count(a.tag)", rest)


# ---- OS mix --------------------------------------------------------------------------------
PATH3 = (
    f"{code('t.um', fv.CODE_LAST_PAREN)} || '/' || {code('t.dum', fv.CODE_GREEDY_PAREN)} || '/' || {code('t.code_moa', fv.CODE_GREEDY_PAREN)}"
)
_UNITS = "trim(c.um) AS um, trim(c.dum) AS dum, trim(c.code_moa) AS code_moa"
_OS_ROWS = "FROM assets_os a LEFT JOIN people_all c ON a.owner_id = c.id LEFT JOIN os_ref f ON concat(a.os_name, ' ', a.os_build) = f.os_key"


def _os_mix(k: Kpi) -> str:
    inner = {
        "name": f"SELECT DISTINCT trim(a.tag) AS tag, trim(f.name) AS value, {_UNITS} {_OS_ROWS}",
        "licence": f"SELECT DISTINCT a.tag, f.name, f.edition AS value, {_UNITS} {_OS_ROWS}",
        "ltsc": f"SELECT DISTINCT a.tag, f.name, f.edition, {_UNITS} {_OS_ROWS} WHERE f.commercial_version LIKE '%LTSC%'",
        "support": f"SELECT DISTINCT a.tag, a.os_name, CASE e.protected WHEN 0 THEN 'non' WHEN 1 THEN '6 mois' WHEN 2 THEN 'oui' END AS value, {_UNITS} "
        "FROM assets_os a LEFT JOIN people_all c ON a.owner_id = c.id LEFT JOIN os_versions v ON v.os_key = a.os_name || ' ' || a.os_build "
        "LEFT JOIN os_protection e ON v.groupid = e.groupid",
    }[k.spec]
    label = _q(k.indicateur) if k.spec == "ltsc" else f"trim({_q(k.indicateur)} || coalesce(nullif(t.value, ''), 'inconnu'))"
    rest = f"FROM ({inner}) t GROUP BY ALL"
    return result(label, _q(k.indicateur_parent), PATH3, fv.UNIT_GROUP_3, "count(*)", rest)


# ---- campaigns -----------------------------------------------------------------------------
def _campaigns(k: Kpi) -> str:
    def label(suffix: str) -> str:
        return f"p.campaign || ' - ' || p.milestone || {_q(suffix)}"

    valeur = {
        "patch_targeted": "count(DISTINCT p.host)",
        "patch_success": "count(p.host) FILTER (WHERE p.state = 3)",
        "patch_total": "count(p.host) FILTER (WHERE p.state <> 2)",
        "patch_success_connected": "count(p.host) FILTER (WHERE p.state = 3)",
        "patch_total_connected": "count(p.host) FILTER (WHERE p.state <> 2)",
    }[k.name]
    where = "p.milestone NOT IN ('G3', 'G2')"
    if k.name.endswith("_connected"):
        where += " AND coalesce(p.network, '') <> 'Hors RLE'"
    parent = _q("Patching") if k.name == "patch_targeted" else label(k.indicateur_parent)
    rest = f"FROM org6_first u JOIN members p ON u.id = p.owner WHERE {where} GROUP BY {PATH6}, p.campaign, p.milestone"
    return result(label(k.indicateur), parent, PATH6, fv.UNIT_GROUP_6, valeur, rest)


_FAMILIES = {
    "counts": _counts,
    "quality": _quality,
    "compliance_total": _compliance,
    "compliance": _compliance,
    "support": _support,
    "os_mix": _os_mix,
    "campaigns_targeted": _campaigns,
    "campaigns": _campaigns,
}


def kpi_sql(name: str) -> str:
    """Query of one KPI, without its views."""
    k = BY_NAME[name]
    return _FAMILIES[k.family](k)


__all__ = ["asset_latest", "kpi_sql", "path"]
