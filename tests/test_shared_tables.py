"""What several KPIs read is derived once, and rows that no KPI counts go before the large groupings."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetgauge.plans import os_mix
from fleetgauge.plans.registry import BY_NAME, compute, kpis_of, run_reports
from fleetgauge.session import written
from fleetgauge.sources.tables import Sources
from tests.test_fanout import AS_OF, SCHEMAS, inventory


def sources(spark, seed=3):
    """The small inventory, with the scans as a table derived from another one."""
    frames = {n: spark.createDataFrame(d, SCHEMAS[n]) for n, d in inventory(seed, unique_scans=True).items()}
    frames["scans"] = frames.pop("last_seen")
    derived = {"last_seen": lambda src: src.scans.groupBy("hostname", "lastscan").agg(F.count("*").alias("n")).drop("n")}
    return Sources(spark, {n: (lambda f=f: f) for n, f in frames.items()}, derived)


def together(src, report):
    kept = []

    def keep(df, name):
        kept.append(name)
        return written(df, name)

    return run_reports(src, AS_OF, kpis_of(report), keep), kept


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def rows(df):
    return sorted((r.indicateur or "", r.maille or "", r.valeur) for r in df.collect())


def same_as_alone(spark, df, names):
    got = rows(df)
    for name in names:
        kpi = BY_NAME[name]
        alone = rows(compute(sources(spark), AS_OF, [kpi]))
        assert alone and set(alone) <= set(got), name


def test_scans_are_derived_once(spark):
    df, kept = together(sources(spark), "R026")
    assert kept.count("table_last_seen") == 1
    same_as_alone(spark, df, ["recency_0_7", "fresh_manufacturer", "never_seen"])


def test_tables_that_are_stored_are_not_written_again(spark):
    plain = sources(spark)
    src = Sources.from_frames(spark, {n: plain[n] for n in plain.names})
    _, kept = together(src, "R026")
    assert "table_last_seen" not in kept


def test_both_campaign_families_read_the_members_once(spark):
    df, kept = together(sources(spark), "R039")
    assert sum(k.startswith("campaign_members") for k in kept) == 1
    same_as_alone(spark, df, ["patch_targeted", "patch_total", "patch_total_connected"])


def test_hosts_that_were_not_scanned_leave_before_the_groupings(spark):
    src = sources(spark)
    text = plan(compute(src, AS_OF, [BY_NAME["compliance_checked"]]))
    assert text.count("LeftSemi") == 1
    below = text[text.index("Join LeftSemi") :]
    assert "Aggregate [item" not in below and "Aggregate [item" in text
    text = plan(compute(src, AS_OF, [BY_NAME["patch_success"]]))
    below = text[text.index("Aggregate [host#") :]
    assert "Join LeftSemi" in below
    df, kept = together(src, "R014")
    assert sum(k.startswith("seen_managed") for k in kept) == 1
    same_as_alone(spark, df, ["compliance_total", "compliance_ok"])


def test_paths_and_labels_of_os_counts_are_made_for_sums(spark):
    text = plan(compute(sources(spark), AS_OF, os_mix.KPIS))
    exploded = text[text.index("Generate inline(array(struct(kpi") :]
    assert "regexp_extract" not in exploded and "regexp_extract" in text
    assert "nombre de postes" not in exploded
