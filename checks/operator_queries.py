"""Registered queries of single operators, each with its SQL counterpart."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

import fleetgauge
from checks.kpi_sql import OS_CODE, PATH3, asset_latest as asset_latest_sql, kpi_sql
from checks.sql_text import PATH5, PATH6, TODAY, account, age, code, elapsed, element, path
from fleetgauge import fixed_values as fv
from fleetgauge.functions import accuracy, text, time
from fleetgauge.functions.time import AsOf
from fleetgauge.operators import dedupe, history, ids, inventory, maintenance, org, rollup
from fleetgauge.plans import campaigns, compliance, os_mix, registry, support
from fleetgauge.schemas import KPI_DEF, conform
from fleetgauge.session import written
from fleetgauge.sources import sql_kpis
from fleetgauge.sources.fixtures import AS_OF, HISTORY_AS_OF
from fleetgauge.sources.tables import Sources, scan_table

REPORTS = Path(fleetgauge.__file__).parent / "reports"
Build = Callable[[Sources], DataFrame]
QUERIES: dict[str, tuple[Build, str]] = {}


def register(name: str, sql: str) -> Callable[[Build], Build]:
    def keep(build: Build) -> Build:
        QUERIES[name] = (build, sql)
        return build

    return keep


def iso(c: Column | str) -> Column:
    """Dates leave as text, which every client reads alike."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c.cast("date"), "yyyy-MM-dd")


def iso_sql(c: str) -> str:
    return f"strftime(CAST({c} AS DATE), '%Y-%m-%d')"


def dated(df: DataFrame) -> DataFrame:
    return df.withColumn("date", iso("date"))


# ==== sources and table maintenance =========================================================
DAY = dt.date(2001, 7, 31)
LABELLED = f"indicateur, indicateur_parent, maille, maille_parent, {iso_sql('date')} AS date, valeur"
_FACT = f"SELECT {LABELLED} FROM kpi_daily_labelled"


@register("scan_table", "SELECT * FROM customer")
def _(src):
    return scan_table(src, "customer")


SEEN_SQL = """
SELECT concat('Vus le mois ', month(lastscan)) AS indicateur, 'Vus' AS indicateur_parent, coalesce(network, '') AS maille,
       'reseau' AS maille_parent, count(*) AS valeur
FROM assets JOIN last_seen ON hostname = tag WHERE CAST(lastscan AS DATE) < :as_of AND lastscan < :now
GROUP BY ALL"""


@register(
    "sql_text_kpi",
    SEEN_SQL.replace(":as_of", TODAY).replace(":now", "TIMESTAMP '2001-11-05 08:00:00'").replace("count(*)", "CAST(count(*) AS DOUBLE)"),
)
def _(src):
    return conform(sql_kpis.run_sql(src, SEEN_SQL, AS_OF))


@register("sql_file_kpi", kpi_sql("kpi_assets"))
def _(src):
    return conform(sql_kpis.run_sql_file(src, str(REPORTS / "r026" / "indic_jour_assets.sql"), AS_OF))


@register(
    "sql_report_directory",
    f"""SELECT 'Fin de support ' || CASE WHEN support_end < {TODAY} THEN 'passee' WHEN support_end > {TODAY} THEN 'future'
  WHEN support_end IS NULL THEN 'inconnue' ELSE 'du jour' END AS indicateur, 'Fin de support' AS indicateur_parent,
  coalesce(u.um, '') AS maille, 'groupes mailles um' AS maille_parent, CAST(count(*) AS DOUBLE) AS valeur
FROM asset_support a LEFT JOIN (SELECT id, min(um) AS um FROM people_all GROUP BY id) u ON u.id = a.owner_id GROUP BY ALL""",
)
def _(src):
    kpis = sql_kpis.report_from_directory(src.spark, str(REPORTS / "r031"))
    return registry.compute(src, AS_OF, kpis)


@register(
    "append_daily",
    f"{_FACT} UNION ALL SELECT indicateur, indicateur_parent, maille, maille_parent, '2001-08-02', valeur + 1 "
    "FROM kpi_daily_labelled WHERE date = DATE '2001-08-01'",
)
def _(src):
    fact = src.kpi_daily_labelled
    last = fact.filter(F.col("date") == F.lit(dt.date(2001, 8, 1)))
    rows = last.withColumn("date", F.lit(dt.date(2001, 8, 2))).withColumn("valeur", F.col("valeur") + 1)
    return dated(maintenance.append(fact, rows))


@register("delete_day", f"{_FACT} WHERE date <> DATE '{DAY}'")
def _(src):
    return dated(maintenance.delete_day(src.kpi_daily_labelled, DAY))


@register("delete_yesterday", f"{_FACT} WHERE date <> DATE '{DAY}'")
def _(src):
    return dated(maintenance.delete_yesterday(src.kpi_daily_labelled, AsOf(dt.date(2001, 8, 1))))


@register("delete_month", f"{_FACT} WHERE NOT (year(date) = 2001 AND month(date) = 7)")
def _(src):
    return dated(maintenance.delete_month(src.kpi_daily_labelled, 2001, 7))


@register("retention_daily", f"{_FACT} WHERE date >= DATE '{HISTORY_AS_OF.day}' - INTERVAL 2 MONTH")
def _(src):
    return dated(maintenance.retain_daily(src.kpi_daily_labelled, HISTORY_AS_OF))


_MONTHLY_SQL = """
SELECT indicateur, maille, strftime(date_trunc('month', date), '%Y-%m-%d') AS date, round(avg(valeur), 6) AS valeur
FROM kpi_daily_labelled GROUP BY ALL"""


def monthly_history(src: Sources) -> DataFrame:
    """Averages of every month there is, by label."""
    fact = src.kpi_daily_labelled
    return fact.groupBy("indicateur", "maille", F.trunc("date", "MM").alias("date")).agg(F.avg("valeur").alias("valeur"))


def rounded(df: DataFrame) -> DataFrame:
    return dated(df).withColumn("valeur", F.round("valeur", 6))


@register("retention_monthly", f"SELECT * FROM ({_MONTHLY_SQL}) WHERE date >= '2000-08-15'")
def _(src):
    return rounded(maintenance.retain_monthly(monthly_history(src), HISTORY_AS_OF))


@register(
    "recompute_day",
    f"{_FACT} WHERE date <> DATE '{DAY}' UNION ALL "
    "SELECT indicateur, indicateur_parent, maille, maille_parent, '2001-07-31', 10 * valeur FROM kpi_daily_labelled "
    f"WHERE date = DATE '{DAY}'",
)
def _(src):
    fact = src.kpi_daily_labelled
    again = fact.filter(F.col("date") == F.lit(DAY)).withColumn("valeur", F.col("valeur") * 10)
    return dated(maintenance.replace_day(fact, DAY, again))


@register(
    "recompute_month",
    f"SELECT * FROM ({_MONTHLY_SQL}) WHERE date <> '2001-07-01' UNION ALL "
    "SELECT indicateur, maille, '2001-07-01', max(valeur) FROM kpi_daily_labelled "
    "WHERE date BETWEEN DATE '2001-07-01' AND DATE '2001-07-31' GROUP BY ALL",
)
def _(src):
    month = HISTORY_AS_OF.previous_month
    again = rollup.month_rows(src.kpi_daily_labelled, HISTORY_AS_OF).groupBy("indicateur", "maille").agg(
        F.max("valeur").alias("valeur")
    ).withColumn("date", F.lit(month))
    return rounded(maintenance.replace_month(monthly_history(src), month, again))


def report_of(label: Column) -> Column:
    return F.when(label.rlike("orders (1|2)"), F.lit("R1")).otherwise(F.lit("R2"))


REPORT_SQL = "CASE WHEN regexp_matches(indicateur, 'orders (1|2)') THEN 'R1' ELSE 'R2' END"


def ledger(src: Sources, grain: str) -> DataFrame:
    """Runs that the daily history bears witness to."""
    period = F.col("date") if grain == "day" else F.trunc("date", "MM")
    return src.kpi_daily_labelled.select(
        report_of(F.col("indicateur")).alias("report"),
        F.col("indicateur").alias("kpi"),
        F.lit(grain).alias("grain"),
        F.lit("done").alias("status"),
        period.alias("period"),
    ).distinct()


def kpi_registry(src: Sources, grain: str) -> DataFrame:
    """Every KPI and unit pair stands for a KPI that may have been run."""
    return src.kpi_daily_labelled.select(
        report_of(F.col("indicateur")).alias("report"), F.col("indicateur").alias("kpi"), F.lit(grain).alias("grain"), "maille"
    ).distinct()


def _pending_sql(grain: str, condition: str) -> str:
    return f"""
SELECT DISTINCT {REPORT_SQL} AS report, indicateur AS kpi, '{grain}' AS grain, maille FROM kpi_daily_labelled
WHERE indicateur NOT IN (SELECT indicateur FROM kpi_daily_labelled WHERE {condition})"""


@register("ledger_pending_daily", _pending_sql("day", "date = DATE '1998-03-02'"))
def _(src):
    return maintenance.ledger_pending(kpi_registry(src, "day"), ledger(src, "day"), AsOf(dt.date(1998, 3, 2)), "day")


@register("ledger_pending_monthly", _pending_sql("month", "date BETWEEN DATE '2001-09-01' AND DATE '2001-09-30'"))
def _(src):
    as_of = AsOf(dt.date(2001, 9, 15))
    return maintenance.ledger_pending(kpi_registry(src, "month"), ledger(src, "month"), as_of, "month")


@register(
    "purge_day_only",
    f"SELECT DISTINCT {REPORT_SQL} AS report, indicateur AS kpi, 'day' AS grain, 'done' AS status, {iso_sql('date')} AS period "
    f"FROM kpi_daily_labelled WHERE date <> DATE '{DAY}'",
)
def _(src):
    kept = maintenance.delete_day(src.kpi_daily_labelled, DAY).select(F.col("date").alias("kept")).distinct()
    cleared = maintenance.clear_ledger(ledger(src, "day"), "day", DAY)
    return cleared.join(kept, cleared.period == kept.kept, "left_semi").withColumn("period", iso("period"))


@register("contract_project", "SELECT indicateur, indicateur_parent, maille, maille_parent, valeur FROM kpi_daily_labelled")
def _(src):
    return conform(src.kpi_daily_labelled)


def _report(name: str) -> Build:
    return lambda src: registry.run_report(src, AS_OF, name)


for _r in registry.reports():
    register(f"run_report_{_r.lower()}", " UNION ALL ".join(kpi_sql(k.name) for k in registry.kpis_of(_r)))(_report(_r))


@register(
    "run_report",
    " UNION ALL ".join(f"SELECT *, '{k.report}' AS report FROM ({kpi_sql(k.name)})" for k in registry.KPIS),
)
def _(src):
    return registry.run_reports(src, AS_OF, registry.KPIS).drop("kpi")


# ==== predicates ============================================================================
_UNION6 = "(SELECT * FROM people UNION ALL SELECT * FROM departments)"


@register("filter_blank_key", f"SELECT id, direction FROM {_UNION6} WHERE id IS NOT NULL AND trim(id) <> ''")
def _(src):
    return org.org_union(src).filter(~text.is_blank("id")).select("id", "direction")


@register("filter_state_codes", "SELECT host, state FROM patch_state WHERE state = 2 OR state = 4")
def _(src):
    return src.patch_state.filter(F.col("state").isin(*fv.STATE_ERROR))


@register("filter_connected", "SELECT tag, network FROM assets WHERE coalesce(network, '') <> 'Hors RLE'")
def _(src):
    return src.assets.filter(text.is_connected("network")).select("tag", "network")


_MILESTONES = f"SELECT grp, type, kind, milestone, {iso_sql('start_date')} AS start_date FROM campaign_milestones"


@register("filter_not_in", f"{_MILESTONES} WHERE milestone NOT IN ('G3', 'G2')")
def _(src):
    between = [mark for mark, _ in fv.CAMPAIGN_MILESTONES]
    listed = campaigns.campaign_list(src, AS_OF).filter(~F.col("milestone").isin(*between))
    return listed.withColumn("start_date", iso("start_date"))


@register(
    "classify_like",
    f"SELECT host, item, status, {element('item')} AS element FROM compliance",
)
def _(src):
    return src.compliance.withColumn("element", text.compliance_element("item"))


@register("filter_status", "SELECT item, host FROM compliance WHERE status LIKE 'compliant'")
def _(src):
    return src.compliance.filter(F.col("status") == fv.STATUS_OK).select("item", "host")


@register(
    "col_contains_col",
    "SELECT a.tag, a.mac, m.mac_list FROM assets a JOIN agent_last m ON m.host = trim(upper(a.tag)) WHERE m.mac_list LIKE concat('%', a.mac, '%')",
)
def _(src):
    agent = inventory.agent_latest(src).select("host", "mac_list")
    joined = src.assets.join(agent, text.norm_key("tag") == agent.host, "inner")
    return joined.filter(text.contains_column("mac_list", "mac")).select("tag", "mac", "mac_list")


@register("filter_regex", f"{_FACT} WHERE regexp_matches(indicateur, 'orders (1|5)')")
def _(src):
    return dated(src.kpi_daily_labelled.filter(F.col("indicateur").rlike("orders (1|5)")))


@register(
    "filter_recent_campaign",
    f"SELECT grp, type, {iso_sql('start_date')} AS start_date FROM campaigns WHERE kind = 'P' AND start_date >= {TODAY} - INTERVAL 60 DAY",
)
def _(src):
    return campaigns.campaign_list(src, AS_OF).select("grp", "type", iso("start_date").alias("start_date"))


@register(
    "support_split",
    f"""SELECT tag, owner_id, {iso_sql('support_end')} AS support_end, support_end > {TODAY} AS supported
FROM asset_support WHERE support_end < {TODAY} OR support_end > {TODAY}""",
)
def _(src):
    return support.support_split(src, AS_OF).withColumn("support_end", iso("support_end"))


# ==== joins =================================================================================
@register("join_inner_model", "SELECT a.tag, a.owner_id, p.model_number FROM assets a JOIN asset_model p ON p.tag = a.tag")
def _(src):
    models = src.asset_model.withColumnRenamed("tag", "model_tag")
    joined = src.assets.join(models, F.col("tag") == models.model_tag, "inner")
    return joined.select("tag", "owner_id", "model_number")


@register(
    "join_campaign",
    "SELECT r.host, r.grp, r.type, r.state, c.milestone FROM campaign_hosts r JOIN campaign_milestones c ON c.grp = r.grp AND c.type = r.type",
)
def _(src):
    listed = campaigns.campaign_list(src, AS_OF).select("grp", "type", "milestone")
    return src.campaign_hosts.drop("kind").join(listed, ["grp", "type"], "inner")


@register(
    "join_left_org",
    f"SELECT a.tag, upper(a.owner_id) AS owner_key, {PATH6} AS maille, count(*) AS org_rows "
    "FROM assets a LEFT JOIN org6 u ON upper(u.id) = upper(a.owner_id) GROUP BY ALL",
)
def _(src):
    rows = src.assets.select("tag", F.upper("owner_id").alias("owner_key"))
    weights = org.org_weights(org.org_dimension(src), F.upper("id"))
    located = org.with_paths(rows, weights, "owner_key", spread_by=["tag"])
    return located.groupBy("tag", "owner_key", "maille").agg(F.sum("org_rows").cast("long").alias("org_rows"))


@register(
    "join_case_insensitive",
    "SELECT a.host, a.seq, a.seq2, u.id, u.um FROM agent_inventory a JOIN org6 u ON upper(u.id) = upper(split_part(a.top_user, '-', 1))",
)
def _(src):
    dimension = org.org_dimension(src).select("id", "um")
    key = F.upper(text.key_part("top_user", "-", 1))
    return src.agent_inventory.join(dimension, key == F.upper("id"), "inner").select("host", "seq", "seq2", "id", "um")


@register(
    "join_os_key",
    "SELECT a.tag, a.os_name, a.os_build, f.name, f.edition, f.commercial_version FROM assets_os a LEFT JOIN os_ref f "
    "ON concat(a.os_name, ' ', a.os_build) = f.os_key",
)
def _(src):
    rows = os_mix.with_os_reference(src.assets_os.select("tag", "os_name", "os_build"), src)
    return rows.drop("os_key")


@register(
    "semi_recent_scan",
    f"SELECT w.tag, w.owner_id FROM assets_os w WHERE EXISTS (SELECT 1 FROM last_seen s WHERE s.hostname = w.tag "
    f"AND CAST(s.lastscan AS DATE) >= {TODAY} - INTERVAL 30 DAY)",
)
def _(src):
    recent = campaigns.recent_hosts(src, AS_OF)
    return src.assets_os.join(recent, F.col("tag") == recent.recent_host, "left_semi").select("tag", "owner_id")


@register("left_to_inner", "SELECT a.tag, a.owner_id, p.state FROM asset_support a LEFT JOIN patch_state p ON p.host = a.tag WHERE p.state = 3")
def _(src):
    joined = src.asset_support.join(src.patch_state, F.col("tag") == F.col("host"), "left")
    return joined.filter(F.col("state").isin(*fv.STATE_UP_TO_DATE)).select("tag", "owner_id", "state")


@register(
    "join_two_roles",
    "SELECT a.tag, a.seq, u.um AS owner_um, u.dum AS owner_dum, r.um AS resp_um, r.dum AS resp_dum FROM assets a "
    "LEFT JOIN org6 u ON upper(u.id) = upper(a.owner_id) LEFT JOIN org6 r ON upper(r.id) = upper(a.resp_id)",
)
def _(src):
    dimension = org.org_dimension(src)
    roles = {
        role: dimension.select(F.upper("id").alias(f"{role}_key"), F.col("um").alias(f"{role}_um"), F.col("dum").alias(f"{role}_dum"))
        for role in ("owner", "resp")
    }
    joined = src.assets
    for role, frame in roles.items():
        joined = joined.join(frame, F.upper(f"{role}_id") == frame[f"{role}_key"], "left")
    return joined.select("tag", "seq", "owner_um", "owner_dum", "resp_um", "resp_dum")


# ==== keys, latest records, ids =============================================================
@register(
    "latest_per_key",
    f"""SELECT host, {iso_sql('last_scan')} AS last_scan, seq, seq2 FROM agent_inventory
QUALIFY row_number() OVER (PARTITION BY host ORDER BY last_scan DESC NULLS FIRST, seq, seq2, mac_2 NULLS FIRST) = 1""",
)
def _(src):
    latest = dedupe.latest_per_key(src.agent_inventory, ["host"], "last_scan")
    return latest.select("host", iso("last_scan").alias("last_scan"), "seq", "seq2")


@register(
    "latest_per_norm_key",
    f"""SELECT trim(upper(tag)) AS tag_key, tag, owner_id, {iso_sql('updated_on')} AS updated_on, seq FROM assets
QUALIFY row_number() OVER (PARTITION BY trim(upper(tag)) ORDER BY updated_on DESC NULLS FIRST, seq, tag) = 1""",
)
def _(src):
    keyed = src.assets.withColumn("tag_key", text.norm_key("tag"))
    latest = dedupe.latest_per_key(keyed, ["tag_key"], "updated_on")
    return latest.select("tag_key", "tag", "owner_id", iso("updated_on").alias("updated_on"), "seq")


_LABELS_SQL = "SELECT DISTINCT c_name AS label, CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 2 END AS phase FROM customer"


@register(
    "assign_ids",
    f"""SELECT label, phase, 100 + row_number() OVER (ORDER BY phase, substr(md5(label), 1, 3), label) AS id FROM ({_LABELS_SQL})""",
)
def _(src):
    phase = F.when(F.col("c_mktsegment") == "BUILDING", 1).otherwise(2)
    labels = src.customer.select(F.col("c_name").alias("label"), phase.alias("phase")).distinct()
    return ids.assign_ids(labels, "id", F.lit(100))


@register("next_id", "SELECT CAST(coalesce(max(o_orderkey), 0) + 1 AS BIGINT) AS next_id FROM orders")
def _(src):
    return ids.next_id(src.orders, "o_orderkey")


@register("dedupe_first", "SELECT maille, min(maille_parent) AS maille_parent FROM kpi_daily_labelled GROUP BY maille")
def _(src):
    return history.dedupe_first(src.kpi_daily_labelled, "maille", ["maille_parent"])


# ==== organisation ==========================================================================
_CODES6 = ", ".join(f"{code(c, fv.CODE_LAST_PAREN)} AS {c}" for c in fv.ORG_LEVELS_6)


@register("org_union", f"SELECT id, {_CODES6} FROM {_UNION6}")
def _(src):
    return org.org_union(src).select("id", *[text.last_paren_code(c).alias(c) for c in fv.ORG_LEVELS_6])


@register("org_union_raw", f"SELECT * FROM {_UNION6}")
def _(src):
    return org.org_union(src)


@register("org_dimension", "SELECT * FROM org6")
def _(src):
    return org.org_dimension(src)


@register("org_dimension5", "SELECT * FROM org5")
def _(src):
    return org.org_dimension(src, fv.ORG_LEVELS_5)


@register("org_dimension_first", "SELECT * FROM org6_first")
def _(src):
    return org.org_dimension(src, code=text.first_paren_code)


def _code_query(name: str, pattern: str, extract: Callable[[str], Column]) -> None:
    @register(name, f"SELECT id, division, {code('division', pattern)} AS code FROM {_UNION6}")
    def _(src):
        return org.org_union(src).select("id", "division", extract("division").alias("code"))


_code_query("code_last_paren", fv.CODE_LAST_PAREN, text.last_paren_code)
_code_query("code_greedy_paren", fv.CODE_GREEDY_PAREN, text.greedy_paren_code)
_code_query("code_first_paren", fv.CODE_FIRST_PAREN, text.first_paren_code)


@register("org_path6", f"SELECT id, {path(fv.ORG_LEVELS_6, 'u')} AS maille FROM {_UNION6} u")
def _(src):
    return org.org_union(src).select("id", text.org_path(fv.ORG_LEVELS_6).alias("maille"))


@register("org_path5", f"SELECT u.id, {PATH5} AS maille FROM org5 u")
def _(src):
    return org.org_dimension(src, fv.ORG_LEVELS_5).select("id", text.org_path(fv.ORG_LEVELS_5).alias("maille"))


@register("org_path3", f"SELECT t.id, {PATH3} AS maille FROM people_all t")
def _(src):
    return src.people_all.select("id", os_mix.org_path3().alias("maille"))


# ==== scalar functions ======================================================================
@register("label_concat", "SELECT tag, network || ' - ' || owner_id || '- Nb postes' AS label FROM assets")
def _(src):
    return src.assets.select("tag", F.concat("network", F.lit(" - "), "owner_id", F.lit("- Nb postes")).alias("label"))


@register("norm_key", "SELECT tag, trim(upper(tag)) AS tag_key FROM assets")
def _(src):
    return src.assets.select("tag", text.norm_key("tag").alias("tag_key"))


@register(
    "split_part_key",
    "SELECT host, seq, seq2, upper(split_part(top_user, '-', 1)) AS user_key, split_part(top_user, '-', 2) AS suffix, split_part(top_user, '-', 3) AS beyond FROM agent_inventory",
)
def _(src):
    return src.agent_inventory.select(
        "host",
        "seq",
        "seq2",
        F.upper(text.key_part("top_user", "-", 1)).alias("user_key"),
        text.key_part("top_user", "-", 2).alias("suffix"),
        text.key_part("top_user", "-", 3).alias("beyond"),
    )


@register(
    "service_account",
    "SELECT tag, owner_id, CASE WHEN length(owner_id) = 6 OR length(owner_id) = 8 THEN 'PAS DE SERVICE' ELSE owner_id END AS service FROM assets",
)
def _(src):
    service = F.when(text.is_personal_account("owner_id"), fv.NOT_A_SERVICE_ACCOUNT).otherwise(F.col("owner_id"))
    return src.assets.select("tag", "owner_id", service.alias("service"))


@register("mac_list", "SELECT host, seq, seq2, CASE WHEN mac_1 IS NULL OR mac_2 IS NULL THEN NULL ELSE mac_1 || '/' || mac_2 END AS macs FROM agent_inventory")
def _(src):
    return src.agent_inventory.select("host", "seq", "seq2", text.joined_list("macs").alias("macs"))


@register(
    "os_equal_variants",
    f"SELECT a.tag, a.seq, d.os AS reported, a.os AS registered, {OS_CODE} AS code FROM assets a LEFT JOIN directory_last d ON d.computer = trim(upper(a.tag))",
)
def _(src):
    directory = inventory.directory_latest(src)
    joined = src.assets.join(directory, text.norm_key("tag") == directory.computer, "left")
    return joined.select(
        "tag",
        "seq",
        F.col("directory_os").alias("reported"),
        F.col("os").alias("registered"),
        accuracy.os_code(F.col("directory_os"), F.col("os")).alias("code"),
    )


_FULL_OS = "concat('Microsoft® Édition ', os_name, ' 2016 [', os_build, ']')"


def _duck_pattern(pattern: str) -> str:
    """The same pattern where word characters are ASCII only."""
    return pattern.removeprefix("(?U)").replace(r"[^\w", r"[^\p{L}\p{N}_")


_CLEAN_OS = _FULL_OS
for _pattern, _replacement in fv.OS_NAME_CLEANING:
    _CLEAN_OS = f"regexp_replace({_CLEAN_OS}, '{_duck_pattern(_pattern)}', '{_replacement}', 'g')"


def full_os() -> Column:
    return F.concat(F.lit("Microsoft® Édition "), "os_name", F.lit(" 2016 ["), "os_build", F.lit("]"))


@register("os_clean", f"SELECT tag, {_CLEAN_OS} AS cleaned FROM assets_os")
def _(src):
    return src.assets_os.select("tag", text.clean_os_name(full_os()).alias("cleaned"))


_PARTS = _duck_pattern(fv.OS_NAME_PARTS)


@register(
    "os_parts",
    "SELECT tag, " + ", ".join(f"trim(regexp_extract(cleaned, '{_PARTS}', {i})) AS part_{i}" for i in range(1, 5))
    + f" FROM (SELECT tag, {_CLEAN_OS} AS cleaned FROM assets_os)",
)
def _(src):
    cleaned = src.assets_os.select("tag", text.clean_os_name(full_os()).alias("cleaned"))
    return cleaned.select("tag", *[text.os_part("cleaned", i).alias(f"part_{i}") for i in range(1, 5)])


@register(
    "regex_replace_first",
    "SELECT tag, regexp_replace(concat('Microsoft® ', os_name, ' Microsoft ', os_build), 'Microsoft.? ', '') AS first_only FROM assets_os",
)
def _(src):
    full = F.concat(F.lit("Microsoft® "), "os_name", F.lit(" Microsoft "), "os_build")
    return src.assets_os.select("tag", text.replace_first(full, fv.OS_VENDOR_IN_NAME).alias("first_only"))


@register(
    "default_label",
    "SELECT a.tag, coalesce(nullif(f.edition, ''), 'inconnu') AS edition FROM assets_os a LEFT JOIN os_ref f ON concat(a.os_name, ' ', a.os_build) = f.os_key",
)
def _(src):
    rows = os_mix.with_os_reference(src.assets_os.select("tag", "os_name", "os_build"), src)
    return rows.select("tag", text.default_label("edition").alias("edition"))


@register("owner_fallback", "SELECT tag, coalesce(owner_id, dept_id) AS owner FROM assets_os")
def _(src):
    return src.assets_os.select("tag", campaigns.owner_or_department().alias("owner"))


@register(
    "case_nested",
    """SELECT a.tag, CASE e.protected WHEN 0 THEN 'non' WHEN 1 THEN '6 mois' WHEN 2 THEN 'oui' END AS support FROM assets_os a
LEFT JOIN os_versions v ON v.os_key = a.os_name || ' ' || a.os_build LEFT JOIN os_protection e ON e.groupid = v.groupid""",
)
def _(src):
    return os_mix.with_support_class(src.assets_os.select("tag", "os_name", "os_build"), src).select("tag", "support")


@register("day_age", f"SELECT hostname, CAST({age('lastscan')} AS INTEGER) AS age FROM last_seen")
def _(src):
    return src.last_seen.select("hostname", time.day_age("lastscan", AS_OF).alias("age"))


@register("elapsed_days", f"SELECT hostname, CAST({elapsed('lastscan')} AS INTEGER) AS days FROM last_seen")
def _(src):
    return src.last_seen.select("hostname", time.elapsed_days("lastscan", AS_OF).alias("days"))


@register("campaign_milestone", "SELECT grp, type, milestone FROM campaign_milestones")
def _(src):
    return campaigns.campaign_list(src, AS_OF).select("grp", "type", "milestone")


@register(
    "prev_month",
    "SELECT o_orderkey, strftime(date_trunc('month', CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH), '%Y-%m-%d') AS month FROM orders",
)
def _(src):
    return src.orders.select("o_orderkey", iso(time.previous_month("o_orderdate")).alias("month"))


@register("month_filter", f"{_FACT} WHERE month(date) = 7")
def _(src):
    return dated(rollup.month_rows(src.kpi_daily_labelled, HISTORY_AS_OF, match_year=False))


@register("esu_map", "SELECT groupid, commercial_name, technical_version, os_key FROM os_versions")
def _(src):
    return os_mix.os_version_keys(src)


# ==== shared blocks =========================================================================
_AGENT = f"a.host, a.manufacturer, a.description, a.os, {iso_sql('a.last_scan')} AS last_scan, a.top_user, a.top_account AS top_user_or_excluded, a.is_virtual, a.mac_list"


@register("agent_latest", f"SELECT {_AGENT} FROM agent_last a")
def _(src):
    return inventory.agent_latest(src).withColumn("last_scan", iso("last_scan"))


@register("agent_latest_um", f"SELECT {_AGENT}, t.um AS top_um FROM agent_last a LEFT JOIN um_of_id t ON t.id = a.top_user")
def _(src):
    return inventory.agent_latest_um(src, org.org_dimension(src)).withColumn("last_scan", iso("last_scan"))


@register(
    "asset_latest",
    f"""SELECT i.tag_key, i.tag, i.owner_id, i.manufacturer, i.mac, i.is_virtual, i.model_number, {iso_sql('i.lastscan')} AS lastscan, u.um, u.dum, {PATH6} AS maille
FROM {asset_latest_sql(True, True)} i LEFT JOIN org_one u ON u.owner_key = upper(i.owner_id)""",
)
def _(src):
    columns = ["owner_id", "manufacturer", "mac", "is_virtual"]
    rows = inventory.asset_latest(src, AS_OF, columns, inventory.Selection(model=True, window=True), with_scan=True)
    rows = rows.withColumn("owner_key", F.upper("owner_id"))
    located = org.with_paths(rows, org.org_single(org.org_dimension(src), F.upper("id")), "owner_key", spread_by=["tag"])
    return located.select(
        "tag_key", "tag", "owner_id", "manufacturer", "mac", "is_virtual", "model_number",
        iso("lastscan").alias("lastscan"), "um", "dum", "maille",
    )


@register(
    "seen_status",
    f"""SELECT a.tag, a.seq, CASE WHEN s.lastscan IS NULL THEN 'jamais vu' WHEN {age('s.lastscan')} < 8 THEN 'vu' ELSE 'pas vu' END AS seen_8,
  CASE WHEN s.lastscan IS NULL THEN 'jamais vu' WHEN {age('s.lastscan')} < 31 THEN 'vu' ELSE 'pas vu' END AS seen_31
FROM assets a LEFT JOIN last_seen s ON s.hostname = a.tag""",
)
def _(src):
    joined = src.assets.join(src.last_seen, F.col("tag") == F.col("hostname"), "left")
    days = time.day_age("lastscan", AS_OF)
    return joined.select(
        "tag",
        "seq",
        accuracy.seen_status(F.col("lastscan"), days).alias("seen_8"),
        accuracy.seen_status(F.col("lastscan"), days, fv.WINDOW_DAYS).alias("seen_31"),
    )


@register(
    "compliance_elements",
    "SELECT item, host, element, " + ", ".join(f"bool_or(status = '{s}') AS is_{s}" for s in (fv.STATUS_OK, fv.STATUS_KO, *fv.STATUS_FAILED))
    + " FROM elements GROUP BY ALL",
)
def _(src):
    return compliance.compliance_elements(src)


@register("campaign_list", _MILESTONES)
def _(src):
    return campaigns.campaign_list(src, AS_OF).withColumn("start_date", iso("start_date"))


@register("campaign_membership", "SELECT campaign, host, state, owner, network, milestone FROM members")
def _(src):
    return campaigns.campaign_membership(src, AS_OF)


def _attribute_codes_sql() -> str:
    from checks.kpi_sql import SINGLE_CODES

    parts = ", ".join(f"{SINGLE_CODES[a]} AS {a}" for a in ("manufacturer", "mac", "virtual", "user", "model"))
    return f"SELECT i.tag_key, {parts} FROM {asset_latest_sql(True, False)} i LEFT JOIN agent_last m ON m.host = i.tag_key"


@register("attribute_codes", _attribute_codes_sql())
def _(src):
    from fleetgauge.plans.quality import SINGLE, QualitySpec, compared_assets

    rows = compared_assets(src, AS_OF, [QualitySpec(a) for a in SINGLE])
    rows = rows.filter(F.col("selection") == inventory.Selection(model=True).label)
    return rows.select("tag_key", *[SINGLE[a].code().alias(a) for a in SINGLE])


# ==== history ===============================================================================
# Labels known before: three regions as units, one KPI.
def known_units(src: Sources) -> DataFrame:
    known = src.kpi_daily_labelled.filter(F.col("maille_parent").isin("AFRICA", "AMERICA", "ASIA"))
    labels = known.groupBy(F.col("maille_parent").alias("label")).agg(F.min("maille_parent"))
    return labels.select(F.length("label").cast("long").alias("id_maille"), "label", F.lit(0).cast("long").alias("id_parent"))


def known_kpis(src: Sources) -> DataFrame:
    known = src.kpi_daily_labelled.filter(F.col("indicateur") == "orders 1-URGENT").select("indicateur").distinct()
    return known.select(
        F.lit(7).cast("long").alias("id_calc"),
        F.col("indicateur").alias("label"),
        F.lit(0).cast("long").alias("id_parent"),
        F.lit(0).cast("long").alias("id_maille_groupe"),
        F.array(F.lit("R1")).alias("rapports"),
    )


def _numbered(label: str) -> str:
    return f"row_number() OVER (ORDER BY phase, substr(md5({label}), 1, 3), {label})"


def upsert_views(prefix: str, source: str, known: str, label: str, parent: str) -> dict[str, str]:
    """The steps of a label upsert as views: first, fresh, parents, all, numbered."""
    return {
        f"{prefix}_first": f"SELECT {label} AS label, min({parent}) AS parent FROM {source} GROUP BY 1",
        f"{prefix}_fresh": f"SELECT * FROM {prefix}_first WHERE label NOT IN (SELECT label FROM {known})",
        f"{prefix}_parents": f"SELECT DISTINCT parent AS label FROM {prefix}_fresh WHERE parent <> '' AND parent NOT IN (SELECT label FROM {known})",
        f"{prefix}_phases": f"SELECT label, 1 AS phase, NULL AS parent FROM {prefix}_parents UNION ALL "
        f"SELECT label, 2, parent FROM {prefix}_fresh WHERE label NOT IN (SELECT label FROM {prefix}_parents)",
    }


HISTORY_VIEWS: dict[str, str] = {
    "known_units": "SELECT DISTINCT CAST(length(maille_parent) AS BIGINT) AS id_maille, maille_parent AS label, CAST(0 AS BIGINT) AS id_parent "
    "FROM kpi_daily_labelled WHERE maille_parent IN ('AFRICA', 'AMERICA', 'ASIA')",
    "known_kpis": "SELECT DISTINCT CAST(7 AS BIGINT) AS id_calc, indicateur AS label, CAST(0 AS BIGINT) AS id_parent, CAST(0 AS BIGINT) AS id_maille_groupe, "
    "'R1' AS rapports FROM kpi_daily_labelled WHERE indicateur = 'orders 1-URGENT'",
    **upsert_views("nu", "kpi_daily_labelled", "known_units", "maille", "maille_parent"),
    "nu_ids": f"SELECT label, parent, (SELECT max(id_maille) FROM known_units) + {_numbered('label')} AS id_maille FROM nu_phases",
    "units": "SELECT id_maille, label, id_parent FROM known_units UNION ALL SELECT n.id_maille, n.label, coalesce(p.id_maille, k.id_maille, 0) "
    "FROM nu_ids n LEFT JOIN nu_ids p ON p.label = n.parent LEFT JOIN known_units k ON k.label = n.parent",
    **upsert_views("nk", "kpi_daily_labelled", "known_kpis", "indicateur", "indicateur_parent"),
    "nk_ids": f"SELECT label, parent, (SELECT max(id_calc) FROM known_kpis) + {_numbered('label')} AS id_calc FROM nk_phases",
    "nk_groups": "SELECT label, min(grp) AS grp FROM (SELECT indicateur AS label, min(maille_parent) AS grp FROM kpi_daily_labelled GROUP BY 1 "
    "UNION ALL SELECT indicateur_parent, min(maille_parent) FROM kpi_daily_labelled GROUP BY 1) GROUP BY label",
    "new_kpis": "SELECT n.id_calc, n.label, coalesce(p.id_calc, k.id_calc, 0) AS id_parent, coalesce(u.id_maille, 0) AS id_maille_groupe, 'R2' AS rapports "
    "FROM nk_ids n LEFT JOIN nk_ids p ON p.label = n.parent LEFT JOIN known_kpis k ON k.label = n.parent "
    "LEFT JOIN nk_groups g ON g.label = n.label LEFT JOIN units u ON u.label = g.grp",
    "kpis": "SELECT * FROM known_kpis UNION ALL SELECT * FROM new_kpis",
    "facts": "SELECT k.id_calc, u.id_maille, f.date, f.valeur, k.rapports, k.label AS label_indicateur, u.label AS maille "
    "FROM kpi_daily_labelled f JOIN kpis k ON k.label = f.indicateur JOIN units u ON u.label = f.maille",
}


def all_units(src: Sources) -> DataFrame:
    known = known_units(src)
    return written(known.unionByName(history.unit_upsert(known, src.kpi_daily_labelled)), "units")


def all_kpis(src: Sources, units: DataFrame | None = None) -> DataFrame:
    known = known_kpis(src)
    units = all_units(src) if units is None else units
    return written(known.unionByName(history.kpi_upsert(known, units, src.kpi_daily_labelled, "R2")), "kpis")


def as_text(kpis: DataFrame) -> DataFrame:
    """Reports as text: clients disagree on how an array looks."""
    return kpis.withColumn("rapports", F.array_join("rapports", ","))


@register("unit_upsert", "SELECT * FROM units WHERE label NOT IN (SELECT label FROM known_units)")
def _(src):
    return history.unit_upsert(known_units(src), src.kpi_daily_labelled)


@register("kpi_upsert", "SELECT * FROM new_kpis")
def _(src):
    return as_text(history.kpi_upsert(known_kpis(src), all_units(src), src.kpi_daily_labelled, "R2"))


@register(
    "new_labels",
    "SELECT DISTINCT maille, maille_parent FROM kpi_daily_labelled WHERE maille NOT IN (SELECT label FROM known_units)",
)
def _(src):
    incoming = src.kpi_daily_labelled.select("maille", "maille_parent").distinct()
    return history.new_labels(incoming, known_units(src), "maille")


# A root is its own parent: here every region reports for itself.
_ROOTS = "(SELECT maille, maille_parent FROM kpi_daily_labelled UNION ALL SELECT maille_parent, maille_parent FROM kpi_daily_labelled) AS roots"
ROOT_VIEWS = {
    **{k.replace("nu_", "ro_"): v.replace("nu_", "ro_") for k, v in upsert_views("nu", _ROOTS, "known_units", "maille", "maille_parent").items()},
    "ro_ids": f"SELECT label, parent, phase, (SELECT max(id_maille) FROM known_units) + {_numbered('label')} AS id_maille FROM ro_phases",
}


@register(
    "root_label",
    "SELECT n.id_maille, n.label, coalesce(p.id_maille, k.id_maille, 0) AS id_parent FROM ro_ids n "
    "LEFT JOIN ro_ids p ON p.label = n.parent LEFT JOIN known_units k ON k.label = n.parent",
)
def _(src):
    rows = src.kpi_daily_labelled.select("maille", "maille_parent")
    roots = rows.select(F.col("maille_parent").alias("maille"), "maille_parent")
    return history.unit_upsert(known_units(src), rows.unionByName(roots))


# Two reports share labels; the first one, in alphabetical order, keeps them.
SHARED_VIEWS = {
    "nothing": "SELECT CAST(0 AS BIGINT) AS id_calc, '' AS label WHERE FALSE",
    **upsert_views("s1", "(SELECT * FROM kpi_daily_labelled WHERE indicateur < 'orders 4') AS first_report", "nothing", "indicateur", "indicateur_parent"),
    "s1_ids": f"SELECT label, parent, {_numbered('label')} AS id_calc FROM s1_phases",
    **upsert_views("s2", "(SELECT * FROM kpi_daily_labelled WHERE indicateur > 'orders 2') AS second_report", "s1_ids", "indicateur", "indicateur_parent"),
    "s2_ids": f"SELECT label, parent, (SELECT max(id_calc) FROM s1_ids) + {_numbered('label')} AS id_calc FROM s2_phases",
    "s_ids": "SELECT *, 'R1' AS rapports FROM s1_ids UNION ALL SELECT *, 'R2' FROM s2_ids",
}


@register(
    "shared_label",
    "SELECT n.id_calc, n.label, coalesce(p.id_calc, 0) AS id_parent, n.rapports FROM s_ids n LEFT JOIN s_ids p ON p.label = n.parent",
)
def _(src):
    rows = src.kpi_daily_labelled
    empty = src.spark.createDataFrame([], KPI_DEF)
    units = known_units(src)
    first = written(history.kpi_upsert(empty, units, rows.filter(F.col("indicateur") < "orders 4"), "R1"), "kpis")
    second = history.kpi_upsert(first, units, rows.filter(F.col("indicateur") > "orders 2"), "R2")
    return as_text(first.unionByName(second).drop("id_maille_groupe"))


def ids_and_date(src: Sources) -> tuple[DataFrame, DataFrame, DataFrame]:
    units = all_units(src)
    kpis = all_kpis(src, units)
    return history.daily_fact(src.kpi_daily_labelled, kpis, units, F.col("date")), kpis, units


@register("daily_fact", f"SELECT id_calc, id_maille, {iso_sql('date')} AS date, valeur FROM facts")
def _(src):
    return dated(ids_and_date(src)[0])


@register(
    "fact_lookup",
    f"SELECT f.indicateur, f.maille, {iso_sql('f.date')} AS date, f.valeur, k.id_calc, u.id_maille FROM kpi_daily_labelled f "
    "LEFT JOIN known_kpis k ON k.label = f.indicateur LEFT JOIN units u ON u.label = f.maille",
)
def _(src):
    rows = history.fact_lookup(src.kpi_daily_labelled, known_kpis(src), all_units(src))
    return dated(rows).drop("indicateur_parent", "maille_parent")


@register(
    "fact_dropna",
    f"SELECT k.id_calc, u.id_maille, {iso_sql('f.date')} AS date, f.valeur FROM kpi_daily_labelled f "
    "JOIN known_kpis k ON k.label = f.indicateur JOIN units u ON u.label = f.maille",
)
def _(src):
    rows = history.fact_lookup(src.kpi_daily_labelled, known_kpis(src), all_units(src))
    return dated(history.fact_dropna(rows)).select("id_calc", "id_maille", "date", "valeur")


@register("kpi_of_report", "SELECT id_calc, label, id_parent, id_maille_groupe, rapports FROM kpis WHERE rapports = 'R2'")
def _(src):
    return as_text(all_kpis(src).filter(rollup.of_report("R2")).filter(rollup.of_all_reports(["R2"])))


_JULY = "date BETWEEN DATE '2001-07-01' AND DATE '2001-07-31'"
_AVERAGE = "'2001-07-01' AS date, round(avg(valeur), 6) AS valeur"


@register("monthly_avg", f"SELECT id_calc, id_maille, {_AVERAGE} FROM facts WHERE {_JULY} AND rapports = 'R2' GROUP BY ALL")
def _(src):
    daily, kpis, _ = ids_and_date(src)
    return rounded(rollup.monthly_avg(daily, kpis, HISTORY_AS_OF, "R2"))


@register("monthly_avg_any_year", f"SELECT id_calc, id_maille, {_AVERAGE} FROM facts WHERE month(date) = 7 AND rapports = 'R2' GROUP BY ALL")
def _(src):
    daily, kpis, _ = ids_and_date(src)
    return rounded(rollup.monthly_avg(daily, kpis, HISTORY_AS_OF, "R2", match_year=False))


@register("monthly_all_reports", f"SELECT rapports AS report, id_calc, id_maille, {_AVERAGE} FROM facts WHERE {_JULY} GROUP BY ALL")
def _(src):
    daily, kpis, _ = ids_and_date(src)
    return rounded(rollup.monthly_all_reports(daily, kpis, HISTORY_AS_OF))


@register(
    "monthly_labelled",
    f"SELECT id_calc, id_maille, label_indicateur, maille, {_AVERAGE} FROM facts WHERE {_JULY} AND rapports = 'R1' GROUP BY ALL",
)
def _(src):
    daily, kpis, units = ids_and_date(src)
    return rounded(rollup.monthly_labelled(daily, kpis, units, HISTORY_AS_OF, "R1"))


@register(
    "monthly_regex",
    f"SELECT id_calc, id_maille, label_indicateur, maille, {_AVERAGE} FROM facts WHERE {_JULY} AND regexp_matches(label_indicateur, 'orders (1|5)') GROUP BY ALL",
)
def _(src):
    daily, kpis, units = ids_and_date(src)
    return rounded(rollup.monthly_regex(daily, kpis, units, HISTORY_AS_OF, "orders (1|5)"))


EXTRA_VIEWS = {**HISTORY_VIEWS, **ROOT_VIEWS, **SHARED_VIEWS}
__all__ = ["EXTRA_VIEWS", "QUERIES", "account"]
