"""Pieces of SQL shared by the counterparts: fixture views, directories, latest records."""

from __future__ import annotations

import re

from fleetgauge import fixed_values as fv
from fleetgauge.sources.fixtures import AS_OF, FIXTURE_SQL

TODAY = f"DATE '{AS_OF.day}'"
NOW = f"TIMESTAMP '{AS_OF.day} {AS_OF.time}'"


def _names(sql: str, known: dict[str, str]) -> list[str]:
    words = set(re.findall(r"[a-z_0-9]+", sql))
    return [n for n in known if n in words]


def _plain(sql: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", sql)


def code(column: str, pattern: str) -> str:
    return f"coalesce(regexp_extract({column}, '{pattern}', 1), '')"


def path(levels: tuple[str, ...], alias: str) -> str:
    return "concat(" + ", '/', ".join(f"{alias}.{level}" for level in levels) + ")"


PATH6 = path(fv.ORG_LEVELS_6, "u")
PATH5 = path(fv.ORG_LEVELS_5, "u")


def _org(levels: tuple[str, ...], pattern: str) -> str:
    codes = ", ".join(f"{code(level, pattern)} AS {level}" for level in levels)
    raw = ", ".join(levels)
    return f"""
SELECT DISTINCT id, {codes}
FROM (SELECT id, {raw} FROM people UNION ALL SELECT id, {raw} FROM departments) AS d
WHERE id IS NOT NULL AND trim(id) <> ''"""


def age(column: str) -> str:
    return f"({TODAY} - CAST({column} AS DATE))"


def elapsed(column: str) -> str:
    return f"date_part('day', {NOW} - CAST({column} AS TIMESTAMP))"


_GENERIC = "({c} LIKE '%-OP%' OR {c} LIKE '%AUTRE%' OR {c} LIKE '%-G%' OR {c} LIKE '%-PR%' OR {c} LIKE '%CSP%')"


def account(column: str) -> str:
    return f"CASE WHEN {_GENERIC.format(c=column)} THEN 'Exclu' ELSE upper({column}) END"


def first_of(rules: list[tuple[str, str]], default: str) -> str:
    """The value of the first condition that holds."""
    return "coalesce(" + "".join(f"if({condition}, '{value}', NULL), " for condition, value in rules) + f"{default})"


def element(item: str) -> str:
    return first_of([(f"contains({item}, '{mark}')", label) for mark, label in fv.COMPLIANCE_ELEMENTS], item)


def _milestone() -> str:
    """Steps that less than a day separates from now, then the bare group."""
    rules = []
    for mark, steps in fv.CAMPAIGN_MILESTONES:
        group = f"contains(grp, '{mark}')"
        near = "abs(epoch({now}) - epoch(start_date + INTERVAL {days} DAY)) < 86400"
        rules += [(f"{group} AND {near.format(now=NOW, days=days)}", label) for days, label in steps]
        rules.append((group, mark))
    return first_of(rules, "''")


_EXTENDED = ", ".join(f"('{product}', '{suffix}')" for product, suffix in fv.EXTENDED_SUPPORT.items())

_TOP_USER = "upper(split_part(top_user, '-', 1))"

VIEWS: dict[str, str] = {name: _plain(sql) for name, sql in FIXTURE_SQL.items()} | {
    "org6": _org(fv.ORG_LEVELS_6, fv.CODE_LAST_PAREN),
    "org5": _org(fv.ORG_LEVELS_5, fv.CODE_LAST_PAREN),
    "org6_first": _org(fv.ORG_LEVELS_6, fv.CODE_FIRST_PAREN),
    "org_one": """
SELECT upper(id) AS owner_key, direction, division, regroupement_unite, um, dum, code_moa FROM org6
QUALIFY row_number() OVER (PARTITION BY upper(id) ORDER BY direction, division, regroupement_unite, um, dum, code_moa) = 1""",
    "um_of_id": "SELECT id, min(um) AS um FROM org6 GROUP BY id",
    "agent_last": f"""
SELECT host, manufacturer, description, os, last_scan, {_TOP_USER} AS top_user, {account(_TOP_USER)} AS top_account,
       host LIKE '%-%' AS is_virtual,
       CASE WHEN mac_1 IS NULL OR mac_2 IS NULL THEN NULL ELSE mac_1 || '/' || mac_2 END AS mac_list
FROM agent_inventory
QUALIFY row_number() OVER (PARTITION BY host ORDER BY last_scan DESC NULLS FIRST, seq, seq2, mac_2 NULLS FIRST) = 1""",
    "directory_last": """
SELECT computer, os FROM directory_computer
QUALIFY row_number() OVER (PARTITION BY computer ORDER BY last_logon DESC NULLS FIRST, seq, seq2, os) = 1""",
    "elements": f"SELECT DISTINCT {element('item')} AS element, item, host, status FROM compliance",
    "campaign_milestones": f"""
SELECT grp, type, start_date, kind, {_milestone()} AS milestone
FROM campaigns WHERE kind = '{fv.CAMPAIGN_KIND}' AND {age('start_date')} <= {fv.CAMPAIGN_WINDOW_DAYS}""",
    "members": f"""
SELECT concat(grp, ' - ', type) AS campaign, host, state, owner, network, milestone
FROM (SELECT host, grp, type, state FROM campaign_hosts WHERE kind = '{fv.CAMPAIGN_KIND}') AS targeted
JOIN campaign_milestones USING (grp, type)
JOIN (SELECT tag AS host, coalesce(owner_id, dept_id) AS owner, network FROM assets_os) AS registered USING (host)
SEMI JOIN (SELECT hostname AS host FROM last_seen WHERE {age('lastscan')} <= {fv.CAMPAIGN_SCAN_DAYS}) AS recent USING (host)""",
    "os_versions": f"""
SELECT os_version.*, coalesce(commercial_name || suffix,
         regexp_replace(commercial_name, '{fv.OS_VENDOR_IN_NAME}', '') || ' ' || technical_version) AS os_key
FROM os_version LEFT JOIN (VALUES {_EXTENDED}) AS extended(product, suffix) ON product = groupid""",
}


def with_views(sql: str, extra: dict[str, str] | None = None, tables: tuple[str, ...] = ()) -> str:
    """Prefix ``sql`` with the views it needs, each after those it uses itself.

    ``tables``: names that exist as tables and need no view.
    """
    known = {n: v for n, v in (VIEWS | (extra or {})).items() if n not in tables}
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in _names(text, known):
            if name not in ordered and known[name] is not text:
                visit(known[name])
                if name not in ordered:
                    ordered.append(name)

    visit(sql)
    if not ordered:
        return sql
    ctes = ",\n".join(f"{n} AS ({known[n].strip()})" for n in ordered)
    return f"WITH {ctes}\n{sql.strip()}"


def result(indicateur: str, parent: str, maille: str, maille_parent: str, valeur: str, rest: str) -> str:
    """A KPI query in the result contract."""
    return (
        f"SELECT {indicateur} AS indicateur, {parent} AS indicateur_parent, {maille} AS maille, "
        f"'{maille_parent}' AS maille_parent, CAST({valeur} AS DOUBLE) AS valeur {rest}"
    )
