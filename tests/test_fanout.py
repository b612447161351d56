"""KPIs over small inventories where every table repeats its keys, against plain SQL.

The registered test data has one scan row per host, one verdict per tag and so on. Here
each of them repeats, keys are null or blank, and one owner and one tag hold a third of
all rows.
"""

from __future__ import annotations

import datetime as dt
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks.compare import rows_of
from checks.kpi_sql import kpi_sql
from checks.sql_text import with_views
from fleetgauge.plans.registry import BY_NAME, compute, kpis_of, run_reports
from fleetgauge.sources.fixtures import AS_OF
from fleetgauge.sources.tables import Sources

TODAY = dt.datetime(2001, 11, 5)
ESU = "AF126CAE-171C-4329-B1AB-D70F55CA7EEA"

SCHEMAS = {
    "people": "id string, direction string, division string, regroupement_unite string, um string, dum string, code_moa string",
    "departments": "id string, direction string, division string, regroupement_unite string, um string, dum string, code_moa string",
    "people_all": "id string, um string, dum string, code_moa string",
    "assets": "tag string, owner_id string, resp_id string, network string, manufacturer string, mac string, os string, is_virtual boolean, updated_on timestamp_ntz, seq int",
    "last_seen": "hostname string, lastscan timestamp_ntz",
    "asset_model": "tag string, model_number string",
    "agent_inventory": "host string, manufacturer string, description string, top_user string, mac_1 string, mac_2 string, macs array<string>, os string, last_scan timestamp_ntz, seq int, seq2 int",
    "directory_computer": "computer string, os string, last_logon timestamp_ntz, seq int, seq2 int",
    "loc_building": "tag string, verdict string",
    "loc_site": "tag string, verdict string",
    "managed_assets": "tag string, owner_id string, lastscan timestamp_ntz",
    "compliance": "item string, host string, status string",
    "asset_support": "tag string, owner_id string, support_end date",
    "patch_state": "host string, state int",
    "assets_os": "tag string, owner_id string, dept_id string, network string, os_name string, os_build string",
    "os_ref": "os_key string, name string, edition string, commercial_version string",
    "os_version": "groupid string, commercial_name string, technical_version string",
    "os_protection": "groupid string, protected int",
    "campaigns": "grp string, type string, kind string, start_date date",
    "campaign_hosts": "host string, grp string, type string, kind string, state int",
}


class Maker:
    """Random rows; ``hot`` returns its first choice a third of the time."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def hot(self, *choices):
        return choices[0] if self.r.random() < 1 / 3 else self.r.choice(choices)

    def owner(self):
        return self.hot("P1", "p1", "P2", "p3", "P3-OP", "AUTRE1", "P4", None, "  ", "ghost", "sixsix", "eightsix")

    def raw_tag(self):
        n = self.hot(1, *range(2, 25))
        return self.r.choice([f"ws{n}", f"WS{n}", f" Ws{n} ", f"WS-{n}", None if n == 7 else f"WS{n}"])

    def host(self):
        return f"WS{self.hot(1, *range(2, 25))}"

    def time(self, days=90):
        return self.r.choice([None, *[TODAY - dt.timedelta(days=self.r.randint(-2, days), hours=self.r.randint(-20, 20))] * 5])

    def level(self):
        return self.r.choice(["Name (A)", "Name (B)", "Two (X) (B)", "none", None])

    def people(self):
        return (self.owner(), *[self.level() for _ in range(6)])

    def network(self):
        return self.r.choice(["RLE", "Hors RLE", None])

    def asset(self, i):
        return (self.raw_tag(), self.owner(), self.owner(), self.network(), self.r.choice(["Dell", "dell ", "HP", " ", None]),
                self.r.choice(["AA", "BB", "", None]), self.r.choice(["MICROSOFT WINDOWS 10 ENTERPRISE", "LINUX", "", None]),
                self.r.choice([True, False, None]), self.time(), i)

    def agent(self, i):
        macs = [self.r.choice(["AA", "BB", None]) for _ in range(2)]
        return (self.host(), self.r.choice(["DELL", "HP", None]), self.r.choice(["M1", " m2", "", None]),
                self.r.choice(["p1-adm", "P2", "p4", "autre1", None, "P3-OP"]), *macs, macs,
                self.r.choice(["Windows 10 Entreprise", "linux", None]), self.time(), i, i)


def inventory(seed: int, unique_scans: bool) -> dict[str, list[tuple]]:
    m = Maker(seed)
    r = m.r
    scans = [(m.raw_tag(), m.time()) for _ in range(80)] + [(m.host(), m.time()) for _ in range(80)]
    if unique_scans:
        scans = list(dict(scans).items())
    statuses = ["compliant", "noncompliant", "error", "notapplicable", "notdetected", "other", None]
    people = [m.people() for _ in range(30)]
    departments = [m.people() for _ in range(10)]
    names = ["Windows 10 Pro", "Windows 11 Pro", None]
    return {
        "people": people,
        "departments": departments,
        "people_all": [(p[0], p[4], p[5], p[6]) for p in people + departments],
        "assets": [m.asset(i) for i in range(150)],
        "last_seen": scans,
        "asset_model": [(m.raw_tag(), r.choice(["M1", "M2", "", None])) for _ in range(60)],
        "agent_inventory": [m.agent(i) for i in range(120)],
        "directory_computer": [(m.host(), r.choice(["Windows 10 Entreprise", "linux", None]), m.time(), i, i) for i in range(80)],
        "loc_building": [(m.raw_tag(), r.choice(["Juste", "Faux", None])) for _ in range(80)],
        "loc_site": [(m.raw_tag(), r.choice(["Juste", "Faux", None])) for _ in range(80)],
        "managed_assets": [(m.host(), m.owner(), m.time(60)) for _ in range(80)],
        "compliance": [(r.choice(["CI Poste A", "CI Poste B", "WSUS", "Other", None]), m.host(), r.choice(statuses)) for _ in range(200)],
        "asset_support": [(m.host(), m.owner(), r.choice([dt.date(2001, 1, 1), TODAY.date(), dt.date(2003, 1, 1), None])) for _ in range(80)],
        "patch_state": [(m.host(), r.choice([2, 3, 4, 5, 7, 8, None])) for _ in range(60)],
        "assets_os": [(m.host(), m.owner(), r.choice(["P1", "D1", None]), m.network(), r.choice(names), r.choice(["0", "1", "ESU Year 1", None])) for _ in range(80)],
        "os_ref": [("Windows 10 Pro 0", "Windows 10", "Pro", "LTSC"), ("Windows 10 Pro 0", "Windows 10", "", "22H2"), ("Windows 11 Pro 1", " W11 ", None, "a LTSC b"), (" 1", None, "x", None)],
        "os_version": [("G", "Microsoft® Windows 10 Pro", "0"), (ESU, "Windows 11 Pro", "9"), ("H", "Microsoft Windows 11 Pro", "1"), ("H", None, "1")],
        "os_protection": [("G", 0), ("G", 1), (ESU, 2), ("H", 9)],
        "campaigns": [(r.choice(["G1", "G2", "G3", "xG2"]), r.choice(["T1", "T2"]), r.choice("PPPS"), TODAY.date() - dt.timedelta(days=r.choice([0, 21, 22, 28, 41, 42, 56, 60, 61, 90]))) for _ in range(25)],
        "campaign_hosts": [(m.host(), r.choice(["G1", "G2", "G3", "xG2"]), r.choice(["T1", "T2"]), r.choice("PPS"), r.choice([1, 2, 3, 4, None])) for _ in range(120)],
    }


SINGLES = [n for n, k in BY_NAME.items() if k.family == "quality" and k.spec.attribute in ("manufacturer", "model", "mac", "virtual", "user", "all")]
OTHERS = [n for n in BY_NAME if n not in SINGLES]


def check(spark, seed, names, unique_scans):
    import duckdb

    con = duckdb.connect()
    frames = {}
    for name, data in inventory(seed, unique_scans).items():
        frames[name] = spark.createDataFrame(data, SCHEMAS[name])
        columns = frames[name].columns
        rows = pa.table({c: pa.array([row[i] for row in data]) for i, c in enumerate(columns)})  # noqa: F841
        con.execute(f"CREATE TABLE {name} AS SELECT * FROM rows")
    src = Sources.from_frames(spark, frames)
    want = None
    for n in names:
        cur = con.execute(with_views(kpi_sql(n), tables=tuple(frames)))
        rows = rows_of([d[0] for d in cur.description], cur.fetchall())
        want = rows if want is None else want + rows
    df = compute(src, AS_OF, [BY_NAME[n] for n in names])
    got = rows_of(df.columns, [tuple(x) for x in df.collect()])
    assert got == want, (list((want - got).items())[:3], list((got - want).items())[:3])
    assert sum(want.values()) > 0


def groups(names):
    families = {}
    for n in names:
        k = BY_NAME[n]
        families.setdefault((k.family, n.endswith("parity")), []).append(n)
    return list(families.values())


@pytest.mark.parametrize("names", groups(OTHERS), ids=lambda names: names[0])
@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_keys(spark, seed, names):
    check(spark, seed, names, unique_scans=False)


@pytest.mark.parametrize("seed", [4, 5])
def test_latest_records(spark, seed):
    names = [n for n in SINGLES if not n.endswith("parity")]
    check(spark, seed, names, unique_scans=True)


def tied(spark):
    """Register and agent records of equal age, without a sequence to tell them apart."""
    frames = {}
    for name, data in inventory(6, unique_scans=True).items():
        df = spark.createDataFrame(data, SCHEMAS[name])
        if name == "assets":
            df = df.withColumn("updated_on", F.lit(TODAY).cast("timestamp_ntz"))
        if name == "agent_inventory":
            df = df.withColumn("last_scan", F.lit(TODAY).cast("timestamp_ntz"))
        frames[name] = df.drop("seq", "seq2")
    return Sources.from_frames(spark, frames)


def test_a_kpi_has_one_value_alone_and_in_company(spark):
    src = tied(spark)
    together = run_reports(src, AS_OF, kpis_of("R026")).collect()
    for name in ("acc_manufacturer", "acc_mac", "fresh_virtual", "acc_user", "acc30_model", "acc_entity", "fresh_all"):
        kpi = BY_NAME[name]
        alone = sorted((r.maille, r.valeur) for r in compute(src, AS_OF, [kpi]).collect())
        assert alone == sorted((r.maille, r.valeur) for r in together if r.indicateur == kpi.indicateur), name
        assert alone


def test_campaigns_of_one_label_count_together(spark):
    """Group and type that give the same label from other parts."""
    frames = {n: spark.createDataFrame(d, SCHEMAS[n]) for n, d in inventory(7, unique_scans=True).items()}
    day = TODAY.date() - dt.timedelta(days=42)
    frames["campaigns"] = spark.createDataFrame(
        [("G2 - b", "c", "P", day), ("G2", "b - c", "P", day)], SCHEMAS["campaigns"]
    )
    frames["campaign_hosts"] = spark.createDataFrame(
        [(f"WS{i}", *pair, "P", 3) for i in range(1, 25) for pair in (("G2 - b", "c"), ("G2", "b - c"))], SCHEMAS["campaign_hosts"]
    )
    src = Sources.from_frames(spark, frames)
    rows = compute(src, AS_OF, [BY_NAME["patch_success"]]).collect()
    assert rows and len({(r.indicateur, r.maille) for r in rows}) == len(rows)
