"""The inventory tables, derived from a star schema of orders, customers and parts.

Each entry is a query over ``{table}`` names that reads the same in Spark SQL and in other
engines. Cases planted on purpose: blank and shared accounts, ids in two directories, tags
in several spellings, unknown networks, nested parentheses, hosts with a dash, several
records per key, assets never scanned, operating systems missing from the reference.
"""

from __future__ import annotations

import datetime as dt
import re
import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.functions.time import AsOf
from fleetgauge.sources.tables import Sources

AS_OF = AsOf(dt.date(2001, 11, 5))
HISTORY_AS_OF = AsOf(dt.date(2001, 8, 15))

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

_TAG = "concat(CASE WHEN {k} % 2 = 0 THEN ' ws' ELSE 'WS' END, CASE WHEN {k} % 11 = 0 THEN '-' ELSE '' END, CAST({k} AS STRING))"
_HOST = "concat('WS', CASE WHEN {k} % 11 = 0 THEN '-' ELSE '' END, CAST({k} AS STRING))"
_OS_NAME = "concat('Windows ', CAST(10 + o_orderkey % 2 AS STRING), CASE WHEN o_orderkey % 3 = 0 THEN ' Entreprise' ELSE ' Pro' END)"
_OS_BUILD = "CASE WHEN o_orderkey % 4 = 2 THEN 'ESU Year 1' ELSE CAST(o_orderkey % 4 AS STRING) END"


def _tag(key: str) -> str:
    return _TAG.replace("{k}", key)


def _host(key: str) -> str:
    return _HOST.replace("{k}", key)


FIXTURE_SQL: dict[str, str] = {
    "people": """
SELECT CASE WHEN c_custkey % 41 = 0 THEN '  '
            WHEN c_custkey % 23 = 0 THEN concat('P', CAST(c_custkey AS STRING), '-OP')
            WHEN c_custkey % 29 = 0 THEN concat('P', CAST(c_custkey AS STRING), 'AUTRE')
            ELSE concat('P', CAST(c_custkey AS STRING)) END AS id,
       concat('Region ', r_name, ' (', r_name, ')') AS direction,
       concat('Division (old) ', n_name, ' (', n_name, ')') AS division,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE concat(c_mktsegment, ' (', substr(c_mktsegment, 1, 3), ')') END AS regroupement_unite,
       concat('Unit (U', CAST(c_nationkey % 4 AS STRING), ')') AS um,
       concat('Sub (D', CAST(c_custkey % 3 AS STRING), ')') AS dum,
       CASE WHEN c_custkey % 7 = 0 THEN 'none' ELSE concat('RC (', CAST(c_custkey % 2 AS STRING), ')') END AS code_moa
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "departments": """
SELECT CASE WHEN s_suppkey % 3 = 1 THEN concat('P', CAST(s_suppkey AS STRING)) ELSE concat('D', CAST(s_suppkey AS STRING)) END AS id,
       concat('Region ', r_name, ' (', r_name, ')') AS direction,
       concat('Dept ', n_name, ' (', n_name, ')') AS division,
       CAST(NULL AS STRING) AS regroupement_unite,
       concat('Unit (U', CAST(s_nationkey % 4 AS STRING), ')') AS um,
       'Sub' AS dum, 'RC (0)' AS code_moa
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "people_all": """
SELECT id, um, dum, code_moa FROM {people}
UNION ALL
SELECT id, um, dum, code_moa FROM {departments}""",
    "assets": f"""
SELECT {_tag("o_orderkey")} AS tag,
       CASE WHEN o_custkey % 23 = 0 THEN concat('P', CAST(o_custkey AS STRING), '-OP')
            WHEN o_custkey % 29 = 0 THEN concat('P', CAST(o_custkey AS STRING), 'AUTRE')
            WHEN o_orderkey % 3 = 0 THEN concat('p', CAST(o_custkey AS STRING))
            ELSE concat('P', CAST(o_custkey AS STRING)) END AS owner_id,
       concat('P', CAST((o_custkey + o_orderkey % 2) AS STRING)) AS resp_id,
       CASE o_orderstatus WHEN 'F' THEN 'Hors RLE' WHEN 'P' THEN NULL ELSE 'RLE' END AS network,
       CASE WHEN o_orderkey % 19 = 0 THEN ' ' ELSE substr(o_orderpriority, 1, 1) END AS manufacturer,
       concat('AA:', CAST(o_orderkey % 10 AS STRING)) AS mac,
       CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE 'MICROSOFT WINDOWS 10 ENTERPRISE' END AS os,
       CASE WHEN o_orderkey % 22 = 0 THEN TRUE WHEN o_orderkey % 17 = 0 THEN NULL ELSE FALSE END AS is_virtual,
       o_orderdate AS updated_on, 1 AS seq
FROM {{orders}}
UNION ALL
SELECT concat('Ws', CASE WHEN o_orderkey % 11 = 0 THEN '-' ELSE '' END, CAST(o_orderkey AS STRING)), concat('P', CAST(o_custkey AS STRING)),
       'P1', 'RLE', '9', 'AA:X', 'LINUX', FALSE, CASE WHEN o_orderkey % 26 = 0 THEN NULL ELSE o_orderdate END, 2
FROM {{orders}} WHERE o_orderpriority = '2-HIGH'""",
    "last_seen": f"""
SELECT {_tag("l_orderkey")} AS hostname, max(l_shipdate) AS lastscan
FROM {{lineitem}} GROUP BY l_orderkey""",
    "asset_model": f"""
SELECT {_host("l_orderkey")} AS tag, p_brand AS model_number
FROM (SELECT l_orderkey, min(l_partkey) AS first_part FROM {{lineitem}} GROUP BY l_orderkey) JOIN {{part}} ON first_part = p_partkey""",
    "agent_inventory": f"""
SELECT {_host("l_orderkey")} AS host,
       CAST(1 + l_partkey % 5 AS STRING) AS manufacturer,
       CASE WHEN l_partkey % 31 = 0 THEN ' ' ELSE concat(' ', p_brand) END AS description,
       concat('p', CAST(CASE WHEN l_partkey % 50 = 7 THEN o_custkey + 1 ELSE o_custkey END AS STRING), CASE WHEN l_partkey % 4 = 0 THEN '-ADM' ELSE '' END) AS top_user,
       concat('AA:', CAST(l_linenumber AS STRING)) AS mac_1,
       CASE WHEN l_suppkey % 8 = 0 THEN NULL ELSE concat('AA:', CAST(l_orderkey % 10 AS STRING)) END AS mac_2,
       CASE WHEN l_linenumber % 2 = 0 THEN 'Windows 10 Entreprise' ELSE 'Windows 10 Enterprise' END AS os,
       l_shipdate AS last_scan, l_linenumber AS seq, l_partkey AS seq2
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{part}} ON l_partkey = p_partkey""",
    "directory_computer": """
SELECT host AS computer, os, last_scan AS last_logon, seq, seq2 FROM {agent_inventory}""",
    "loc_building": f"""
SELECT {_tag("o_orderkey")} AS tag, CASE WHEN o_orderkey % 4 = 0 THEN 'Juste' ELSE 'Faux' END AS verdict FROM {{orders}}""",
    "loc_site": f"""
SELECT {_tag("o_orderkey")} AS tag, CASE WHEN o_orderkey % 5 = 0 THEN 'Juste' ELSE 'Faux' END AS verdict FROM {{orders}}""",
    "managed_assets": """
SELECT trim(upper(tag)) AS tag, owner_id, lastscan FROM {assets} JOIN {last_seen} ON tag = hostname""",
    "compliance": """
SELECT CASE l_partkey % 9 WHEN 0 THEN 'CI Chiffrement disque' WHEN 1 THEN 'CI Compte et groupe' WHEN 2 THEN 'CI Antivirus' WHEN 3 THEN 'CI Poste A'
            WHEN 4 THEN 'CI Poste B' WHEN 5 THEN 'CI Réseau' WHEN 6 THEN 'CI WSUS' WHEN 7 THEN 'CI SCCM' ELSE 'Other' END AS item,
       concat('WS', CAST(l_orderkey AS STRING)) AS host,
       CASE l_suppkey % 5 WHEN 0 THEN 'compliant' WHEN 1 THEN 'noncompliant' WHEN 2 THEN 'error' WHEN 3 THEN 'notapplicable' ELSE 'notdetected' END AS status
FROM {lineitem}""",
    "asset_support": """
SELECT concat('WS', CAST(o_orderkey AS STRING)) AS tag, concat('P', CAST(o_custkey AS STRING)) AS owner_id,
       CASE o_custkey % 4 WHEN 0 THEN DATE '2001-01-01' WHEN 1 THEN DATE '2001-11-05' WHEN 2 THEN NULL ELSE DATE '2003-01-01' END AS support_end
FROM {orders}""",
    "patch_state": """
SELECT concat(CASE o_orderpriority WHEN '3-MEDIUM' THEN 'XX' ELSE 'WS' END, CAST(o_orderkey AS STRING)) AS host,
       CAST(2 + o_orderkey % 7 AS INT) AS state
FROM {orders}""",
    "assets_os": f"""
SELECT concat('WS', CAST(o_orderkey AS STRING)) AS tag, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE concat('P', CAST(o_custkey AS STRING)) END AS owner_id,
       concat('P', CAST((o_custkey + 1) AS STRING)) AS resp_id,
       concat('D', CAST(o_custkey % 10 AS STRING)) AS dept_id, CASE o_orderstatus WHEN 'F' THEN 'Hors RLE' WHEN 'P' THEN NULL ELSE 'RLE' END AS network,
       {_OS_NAME} AS os_name, {_OS_BUILD} AS os_build
FROM {{orders}}""",
    "os_ref": f"""
SELECT DISTINCT concat({_OS_NAME}, ' ', CASE WHEN o_orderkey % 4 = 3 THEN 'preview' ELSE {_OS_BUILD} END) AS os_key,
       concat('Windows ', CAST(10 + o_orderkey % 2 AS STRING)) AS name,
       CASE WHEN o_orderkey % 3 = 0 THEN 'Entreprise' ELSE '' END AS edition,
       CASE WHEN o_orderkey % 4 = 0 THEN '21H2 LTSC' ELSE '22H2' END AS commercial_version
FROM {{orders}}""",
    "os_version": f"""
SELECT DISTINCT CASE WHEN o_orderkey % 4 = 2 THEN 'AF126CAE-171C-4329-B1AB-D70F55CA7EEA' ELSE concat('GRP-', CAST(o_orderkey % 4 AS STRING)) END AS groupid,
       concat(CASE o_orderkey % 4 WHEN 0 THEN 'Microsoft ' WHEN 1 THEN 'Microsoft® ' ELSE '' END, {_OS_NAME}) AS commercial_name,
       CASE WHEN o_orderkey % 4 = 3 THEN 'preview' ELSE CAST(o_orderkey % 4 AS STRING) END AS technical_version
FROM {{orders}}""",
    "os_protection": """
SELECT DISTINCT CASE WHEN o_orderkey % 4 = 2 THEN 'AF126CAE-171C-4329-B1AB-D70F55CA7EEA' ELSE concat('GRP-', CAST(o_orderkey % 4 AS STRING)) END AS groupid,
       CAST((o_orderkey % 4) % 3 AS INT) AS protected
FROM {orders}""",
    "campaigns": """
SELECT concat('G', CAST(1 + n % 3 AS STRING)) AS grp, concat('T', CAST(s_suppkey AS STRING)) AS type,
       CASE WHEN n % 8 = 7 THEN 'S' ELSE 'P' END AS kind,
       CASE WHEN n IN (16, 20) THEN DATE '2001-10-30'
            WHEN n % 6 = 0 THEN DATE '2001-11-01' WHEN n % 6 = 1 THEN DATE '2001-09-24'
            WHEN n % 6 = 2 THEN DATE '2001-10-08' WHEN n % 6 = 3 THEN DATE '2001-06-01'
            WHEN n % 6 = 4 THEN DATE '2001-09-10' ELSE DATE '2001-10-15' END AS start_date
FROM (SELECT s_suppkey, s_suppkey % 25 AS n FROM {supplier}) AS numbered""",
    "campaign_hosts": """
SELECT concat('WS', CAST(l_orderkey AS STRING)) AS host, concat('G', CAST(1 + (l_suppkey % 25) % 3 AS STRING)) AS grp,
       concat('T', CAST(l_suppkey AS STRING)) AS type, 'P' AS kind, CAST(1 + (l_orderkey % 7) % 4 AS INT) AS state
FROM {lineitem}""",
    "kpi_daily_labelled": """
SELECT concat('orders ', o_orderpriority) AS indicateur, 'orders' AS indicateur_parent, n_name AS maille, r_name AS maille_parent,
       CAST(o_orderdate AS DATE) AS date, CAST(count(*) AS DOUBLE) AS valeur
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
GROUP BY o_orderpriority, n_name, r_name, CAST(o_orderdate AS DATE)""",
}


def dependencies(sql: str) -> list[str]:
    """Table names a query refers to."""
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


_OPEN: weakref.WeakKeyDictionary[SparkSession, dict[str, Sources]] = weakref.WeakKeyDictionary()


def driver_sources(spark: SparkSession, sf_dir: str) -> Sources:
    """Inventory tables over the parquet files in ``sf_dir``, resolved once per session."""
    opened = _OPEN.setdefault(spark, {})
    if sf_dir not in opened:
        opened[sf_dir] = _open(spark, sf_dir)
    return opened[sf_dir]


def _open(spark: SparkSession, sf_dir: str) -> Sources:
    loaders = {t: (lambda t=t: spark.read.parquet(f"{sf_dir}/{t}.parquet")) for t in BASE_TABLES}

    def fixture(sources: Sources, name: str) -> DataFrame:
        sql = FIXTURE_SQL[name]
        df = spark.sql(sql, **{t: sources[t] for t in dependencies(sql)})
        if name == "agent_inventory":
            df = df.withColumn("macs", F.array("mac_1", "mac_2"))
        return df

    return Sources(spark, loaders, {n: (lambda sources, n=n: fixture(sources, n)) for n in FIXTURE_SQL})
