from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from fleetgauge.functions.time import AsOf
from fleetgauge.operators import rollup
from fleetgauge.plans import jobs
from fleetgauge.plans.kpi import Kpi
from fleetgauge.plans.registry import BY_NAME, kpis_of, reports
from fleetgauge.schemas import KPI_FACT
from fleetgauge.session import shared_folder, written
from fleetgauge.sources import sql_kpis
from fleetgauge.sources import store as st
from fleetgauge.sources.fixtures import AS_OF, driver_sources
from fleetgauge.sources.store import HistoryStore
from tests.conftest import SF_DIR

KPIS = [BY_NAME[n] for n in ("kpi_assets", "recency_8_30", "support_all", "os_name")]


@pytest.fixture
def store(spark):
    return HistoryStore(spark, f"history_{uuid.uuid4().hex[:8]}").create()


@pytest.fixture(scope="module")
def src(spark):
    return driver_sources(spark, SF_DIR)


def content(store, table):
    df = store.read(table)
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_day_can_be_run_again(spark, src, store):
    summary = jobs.run_day(src, store, AS_OF, KPIS)
    assert sorted(summary.done) == sorted(k.name for k in KPIS) and not summary.failed
    before = {t: content(store, t) for t in (st.UNITS, st.KPIS, st.DAILY, st.RUNS)}
    assert before[st.DAILY]

    again = jobs.run_day(src, store, AS_OF, KPIS)
    assert again.done == [] and len(again.skipped) == len(KPIS)
    jobs.run_day(src, store, AS_OF, KPIS, use_ledger=False)
    jobs.recompute_day(src, store, AS_OF, KPIS)
    assert {t: content(store, t) for t in before} == before

    units, kpis = store.read(st.UNITS), store.read(st.KPIS)
    ids = sorted(r.id_maille for r in units.collect())
    assert ids == list(range(1, len(ids) + 1))
    for dimension, key in ((units, "id_maille"), (kpis, "id_calc")):
        known = dimension.select(F.col(key).alias("known"))
        assert dimension.filter("id_parent <> 0").join(known, F.col("id_parent") == F.col("known"), "left_anti").count() == 0
        assert dimension.select("label").distinct().count() == dimension.count()
    assert {r.label: r.rapports for r in kpis.collect()}["Nb postes"] == ["R026"]

    jobs.purge_day(store, AS_OF)
    assert content(store, st.DAILY) == [] and store.done("day", AS_OF.day) == set()


def test_a_run_of_one_report_keeps_the_others(spark, src, store):
    jobs.run_day(src, store, AS_OF, KPIS[:2])
    first = content(store, st.DAILY)
    jobs.run_day(src, store, AS_OF, KPIS[2:])
    both = content(store, st.DAILY)
    assert set(first) < set(both)
    jobs.run_day(src, store, AS_OF, KPIS[2:], use_ledger=False)
    assert content(store, st.DAILY) == both


def test_yesterday_and_one_report(spark, src, store):
    jobs.recompute_yesterday(src, store, AS_OF, KPIS[2:3])
    assert store.dates(st.DAILY) == [AS_OF.yesterday.day]
    summary = jobs.run_one_report(src, store, AS_OF, "r035")
    assert sorted(summary.done) == ["os_licence", "os_ltsc", "os_name", "os_support_class"]
    assert store.dates(st.DAILY) == [AS_OF.yesterday.day, AS_OF.day]


def test_a_broken_kpi_does_not_stop_the_report(spark, src, store):
    broken = Kpi("broken", "R026", "", "", sql_kpis.FAMILY, "SELECT 1 AS valeur")
    summary = jobs.run_day(src, store, AS_OF, [KPIS[0], broken])
    assert summary.done == ["kpi_assets"] and "indicateur" in summary.failed["broken"]
    runs = {(r.kpi, r.status) for r in store.read(st.RUNS).collect()}
    assert runs == {("kpi_assets", "done"), ("broken", "failed")}
    assert jobs.run_day(src, store, AS_OF, [KPIS[0], broken]).skipped == ["kpi_assets"]


def sql_kpi(name, report, labels, value="1.0", where="true"):
    rows = " UNION ALL ".join(
        f"SELECT '{x}' AS indicateur, '' AS indicateur_parent, tag AS maille, :as_of AS lastdate, '' AS maille_parent, "
        f"CAST({value} AS double) AS valeur FROM assets WHERE {where}"
        for x in labels
    )
    return Kpi(name, report, "", "", sql_kpis.FAMILY, rows)


def labels_of(store):
    named = store.read(st.DAILY).join(store.read(st.KPIS), "id_calc")
    return {r.label for r in named.select("label").distinct().collect()}


def test_a_label_that_is_no_longer_computed_goes(src, store):
    jobs.run_day(src, store, AS_OF, [sql_kpi("x", "R098", ["K a", "K b"]), sql_kpi("y", "R099", ["L"])])
    assert labels_of(store) == {"K a", "K b", "L"}
    jobs.run_day(src, store, AS_OF, [sql_kpi("x", "R098", ["K a"])], use_ledger=False)
    assert labels_of(store) == {"K a", "L"}


def test_recomputing_leaves_other_reports(src, store):
    jobs.run_day(src, store, AS_OF, [sql_kpi("x", "R098", ["K"]), sql_kpi("y", "R099", ["L"])])
    jobs.recompute_day(src, store, AS_OF, [sql_kpi("x", "R098", ["M"])])
    assert labels_of(store) == {"M", "L"}
    assert store.done("day", AS_OF.day) == {("R098", "x"), ("R099", "y")}


def test_an_empty_report_is_computed_again(src, store):
    empty = sql_kpi("x", "R098", ["K"], where="false")
    assert jobs.run_day(src, store, AS_OF, [empty]).done == []
    assert jobs.run_day(src, store, AS_OF, [sql_kpi("x", "R098", ["K"])]).done == ["x"]


def test_a_kpi_that_fails_while_running_takes_no_other_with_it(src, store):
    bad = sql_kpi("bad", "R098", ["B"], "1 / (length(tag) - length(tag))")
    summary = jobs.run_day(src, store, AS_OF, [sql_kpi("x", "R099", ["K"]), bad])
    assert summary.done == ["x"] and list(summary.failed) == ["bad"]
    assert labels_of(store) == {"K"}


def test_retention_is_a_parameter(spark, store):
    store.insert(st.DAILY, fact(spark, [(1, 1, 1.0, dt.date(2024, m, 1)) for m in (1, 2, 3)]))
    store.retention[st.DAILY] = 1
    store.purge(AsOf(dt.date(2024, 3, 2)), st.DAILY)
    assert dt.date(2024, 1, 1) not in store.dates(st.DAILY) and dt.date(2024, 3, 1) in store.dates(st.DAILY)


def fact(spark, data):
    return spark.createDataFrame(data, KPI_FACT)


def test_partitions_are_dropped_replaced_and_aged_out(spark, store):
    days = [dt.date(2023, 12, 31), dt.date(2024, 1, 1), dt.date(2024, 2, 29)]
    store.insert(st.DAILY, fact(spark, [(1, 1, 1.0, d) for d in days]))
    store.insert(st.DAILY, fact(spark, [(2, 1, 1.0, days[2])]))
    assert store.dates(st.DAILY) == days and store.read(st.DAILY).count() == 4
    store.replace_date(st.DAILY, days[2], fact(spark, [(3, 1, 5.0, days[2])]))
    assert [tuple(r) for r in store.read(st.DAILY).filter(F.col("date") == F.lit(days[2])).collect()] == [(3, 1, 5.0, days[2])]
    store.replace_date(st.DAILY, days[2], fact(spark, []))
    assert store.read(st.DAILY).count() == 2
    store.purge(AsOf(dt.date(2024, 3, 1)), st.DAILY)
    assert store.dates(st.DAILY) == days[1:]
    store.delete_yesterday(st.DAILY, AsOf(dt.date(2024, 1, 2)))
    store.delete_month(st.DAILY, 2024, 2)
    assert store.dates(st.DAILY) == []
    with pytest.raises(ValueError, match="already"):
        store.insert(st.UNITS, spark.createDataFrame([(1, "a", 0)], "id_maille bigint, label string, id_parent bigint"))
        store.insert(st.UNITS, store.read(st.UNITS), mode="fail")


def test_month_is_averaged_once_per_report(spark, store):
    as_of = AsOf(dt.date(2024, 3, 5))
    days = [(dt.date(2024, 2, d), float(d)) for d in range(1, 30)] + [(dt.date(2024, 3, 1), 99.0)]
    store.insert(st.DAILY, fact(spark, [(k, 1, v, d) for d, v in days for k in (1, 2, 3)]))
    kpis = [(1, "a", 0, 0, ["R014"]), (2, "b", 0, 0, ["R026", "R014"]), (3, "c", 0, 0, ["OTHER"])]
    store.insert(st.KPIS, spark.createDataFrame(kpis, store.read(st.KPIS).schema))
    assert jobs.run_month(store, as_of, ["R014"]).done == ["R014"]
    assert {(r.id_calc, r.valeur, r.date) for r in store.read(st.MONTHLY).collect()} == {(1, 15.0, dt.date(2024, 2, 1)), (2, 15.0, dt.date(2024, 2, 1))}
    summary = jobs.run_month(store, as_of, ["R014", "OTHER"])
    assert summary.skipped == ["R014"] and summary.done == ["OTHER"]
    assert store.read(st.MONTHLY).count() == 3
    summary = jobs.recompute_month(store, as_of)
    assert summary.done == ["OTHER", "R014", "R026"] and summary.empty == ["R031", "R035", "R039"]
    assert {r.id_calc for r in store.read(st.MONTHLY).collect()} == {1, 2, 3}


def test_month_reads_only_its_partitions(spark, store):
    days = [dt.date(2024, m, d) for m in (1, 2, 3) for d in (1, 2)]
    store.insert(st.DAILY, fact(spark, [(1, 1, 1.0, d) for d in days]))
    rows = rollup.month_rows(store.read(st.DAILY), AsOf(dt.date(2024, 3, 5)))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert rows.count() == 2


def test_sql_files(spark, src, tmp_path):
    report = tmp_path / "r099"
    report.mkdir()
    text = "SELECT 'i' AS indicateur, 'p' AS indicateur_parent, tag AS maille, :as_of AS lastdate, 'g' AS maille_parent, count(*) AS valeur FROM assets GROUP BY tag"
    (report / "indic_jour_x.sql").write_text(text, encoding="utf-8")
    (report / "indic_mois_x.sql").write_text("SELECT 1", encoding="utf-8")
    for directory in (str(report), report.as_uri()):
        kpis = sql_kpis.report_from_directory(spark, directory)
        assert [(k.report, k.name, k.grain) for k in kpis] == [("R099", "indic_jour_x", "day"), ("R099", "indic_mois_x", "month")]
    assert sql_kpis.sql_kpis(src, AS_OF, kpis[:1]).columns[-1] == "report"


def test_registry():
    assert len(kpis_of("r026")) == 39
    assert sum(len(kpis_of(r)) for r in reports()) == 67
    with pytest.raises(KeyError):
        kpis_of("r999")


def test_written_frames_end_their_lineage(spark):
    df = written(spark.range(10).withColumn("x", F.col("id") * 2), "test")
    assert len(df.inputFiles()) >= 1
    assert all(shared_folder(spark) in f for f in df.inputFiles())
    assert df.agg(F.sum("x")).first()[0] == 90
