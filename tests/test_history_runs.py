"""Runs that fail, find nothing, are cut short, or go on at the same time."""

from __future__ import annotations

import datetime as dt
import math
import uuid

import pytest
from pyspark.sql import functions as F

from fleetgauge.functions.time import AsOf
from fleetgauge.operators import history
from fleetgauge.plans import jobs
from fleetgauge.plans.kpi import Kpi
from fleetgauge.schemas import KPI_RESULT
from fleetgauge.session import written
from fleetgauge.sources import sql_kpis
from fleetgauge.sources import store as st
from fleetgauge.sources.store import HistoryStore
from fleetgauge.sources.tables import Sources

TODAY = AsOf(dt.date(2024, 3, 5))


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture
def store(spark):
    return HistoryStore(spark, f"runs_{uuid.uuid4().hex[:8]}").create()


@pytest.fixture(scope="module")
def src(spark):
    return Sources.from_frames(spark, {"hosts": spark.createDataFrame([("a", 1), ("b", 2)], "host string, n int")})


def kpi(name, report, label, value="n", where="true"):
    text = (
        f"SELECT '{label}' AS indicateur, '' AS indicateur_parent, host AS maille, '' AS maille_parent, {value} AS valeur "
        f"FROM hosts WHERE {where}"
    )
    return Kpi(name, report, "", "", sql_kpis.FAMILY, text)


A, B = kpi("a", "R1", "A"), kpi("b", "R1", "B", "n * 10")
BAD = kpi("b", "R1", "B", "1 / (n - n)")
NOTHING = kpi("e", "R1", "E", where="false")
OTHER = kpi("o", "R2", "O")


def rows(store, table=st.DAILY):
    named = store.spark.table(store.name(table)).join(store.read(st.KPIS).select("id_calc", "label"), "id_calc")
    named = named.join(store.read(st.UNITS).select("id_maille", F.col("label").alias("unit")), "id_maille")
    return sorted((r.report, r.kpi, r.label, r.unit, r.valeur) for r in named.collect())


def of(k, label, factor=1):
    return [(k.report, k.name, label, "a", 1.0 * factor), (k.report, k.name, label, "b", 2.0 * factor)]


def states(store):
    return {(r.report, r.kpi): r.status for r in store.read(st.RUNS).collect()}


def test_a_part_of_a_report_replaces_only_itself(src, store):
    jobs.run_day(src, store, TODAY, [A, B])
    both = of(A, "A") + of(B, "B", 10)
    assert rows(store) == both
    jobs.run_day(src, store, TODAY, [A], use_ledger=False)
    assert rows(store) == both
    assert sorted(jobs.run_day(src, store, TODAY, [A, B]).skipped) == ["a", "b"] and rows(store) == both


def test_a_failing_kpi_keeps_its_rows(src, store):
    jobs.run_day(src, store, TODAY, [A, B])
    summary = jobs.recompute_day(src, store, TODAY, [kpi("a", "R1", "A", "n * 3"), BAD])
    assert summary.done == ["a"] and list(summary.failed) == ["b"]
    assert rows(store) == of(A, "A", 3) + of(B, "B", 10)
    assert states(store) == {("R1", "a"): st.DONE, ("R1", "b"): st.FAILED}
    assert jobs.run_day(src, store, TODAY, [A, B]).done == ["b"]


def test_a_kpi_without_rows_is_empty_not_done(src, store):
    summary = jobs.run_day(src, store, TODAY, [A, NOTHING])
    assert (summary.done, summary.empty) == (["a"], ["e"])
    assert states(store) == {("R1", "a"): st.DONE, ("R1", "e"): st.EMPTY}
    again = jobs.run_day(src, store, TODAY, [A, kpi("e", "R1", "E")])
    assert (again.skipped, again.done) == (["a"], ["e"])
    jobs.recompute_day(src, store, TODAY, [NOTHING])  # what it had goes
    assert rows(store) == of(A, "A")


def test_an_empty_month_is_not_done(store):
    for _ in range(2):
        summary = jobs.run_month(store, TODAY)
        assert summary.done == summary.skipped == [] and len(summary.empty) == 5
    assert set(states(store).values()) == {st.EMPTY} and store.dates(st.MONTHLY) == []


def test_two_reports_of_one_label_count_once(src, store):
    jobs.run_day(src, store, TODAY, [A, kpi("x", "R2", "A", "n * 7"), OTHER])
    assert rows(store) == of(A, "A") + of(OTHER, "O")
    jobs.recompute_day(src, store, TODAY, [kpi("x", "R2", "A", "n * 7")])
    assert rows(store) == of(A, "A") + of(OTHER, "O")


# ---- cut short -------------------------------------------------------------------------------
class Cut(Exception):
    pass


STEPS = ["started", "labels", "stage", "written", "between", "done"]


@pytest.mark.parametrize("step", STEPS)
def test_a_run_that_was_cut_short_is_repeated(src, store, monkeypatch, step):
    """Stops after each step. What readers see is the day before or after; the next run ends as if nothing had been."""
    jobs.run_day(src, store, TODAY, [A, OTHER])
    before, again = rows(store), [kpi("a", "R1", "A", "n * 5"), kpi("o", "R2", "O", "n * 5"), kpi("n", "R1", "New")]
    record, publish, register, stage = store.record, store.publish, jobs.register_labels, store.stage

    def cut_after(name, do):
        def run(*args, **kw):
            result = do(*args, **kw)
            if step == name:
                raise Cut(step)
            return result

        return run

    def recorded(events):
        events = list(events)
        record(events)
        if events and events[0][3] == step:
            raise Cut(step)

    def one_published(*args):
        publish(*args)
        if step == "between":
            raise Cut(step)

    monkeypatch.setattr(store, "record", recorded)
    monkeypatch.setattr(store, "publish", one_published)
    monkeypatch.setattr(store, "stage", cut_after("stage", stage))
    monkeypatch.setattr(jobs, "register_labels", cut_after("labels", register))
    with pytest.raises(Cut):
        jobs.run_day(src, store, TODAY, again, use_ledger=False)
    after = of(A, "A", 5) + of(again[2], "New") + of(OTHER, "O", 5)
    for report in ("R1", "R2"):  # each report is as it was or as it will be
        seen = [r for r in rows(store) if r[0] == report]
        assert seen in ([r for r in before if r[0] == report], [r for r in after if r[0] == report])
    monkeypatch.undo()
    summary = jobs.run_day(src, store, TODAY, again)
    if step in ("written", "between", "done"):  # all was written: it is published, not computed again
        assert sorted(summary.skipped) == ["a", "n", "o"]
    assert rows(store) == after
    assert set(states(store).values()) == {st.DONE}
    units = [r.id_maille for r in store.read(st.UNITS).collect()]
    assert len(set(units)) == len(units)


def test_what_another_run_published_in_between_stays(src, store, monkeypatch):
    """Both start from one state of a report; the slower one adds to what the faster has."""
    jobs.run_day(src, store, TODAY, [A])
    record = store.record

    def recorded(events):
        events = list(events)
        record(events)
        if events and events[0][3] == st.WRITTEN:
            monkeypatch.undo()
            record([(*e[:3], st.STARTED, *e[4:]) for e in events])  # it has not got so far for the other to take over
            jobs.run_day(src, HistoryStore(store.spark, store.database), TODAY, [kpi("f", "R1", "F")])

    monkeypatch.setattr(store, "record", recorded)
    jobs.run_day(src, store, TODAY, [B])
    assert rows(store) == of(A, "A") + of(B, "B", 10) + of(kpi("f", "R1", "F"), "F")


# ---- many KPIs -------------------------------------------------------------------------------
@pytest.mark.parametrize("bad", [0, 40, 66])
def test_one_bad_kpi_costs_few_runs(spark, bad):
    """Halving finds it; the sets that are run get smaller."""
    kpis, sizes, failed = [kpi(f"k{i}", f"R{i % 5}", f"L{i}") for i in range(67)], [], {}

    def compute(chosen):
        sizes.append(len(chosen))
        if kpis[bad] in chosen:
            raise jobs.ContractError("bad")
        return chosen

    frames = jobs.isolated(kpis, compute, lambda found, _: found, failed)
    assert [k for found in frames for k in found] == [k for k in kpis if k is not kpis[bad]]
    assert list(failed) == [(kpis[bad].report, kpis[bad].name)]
    assert len(sizes) <= 2 * math.ceil(math.log2(67)) + 1 and sum(sizes) <= 4 * 67


def test_blocks_are_kept_once_while_halving(src, store, monkeypatch):
    built = []
    text = "SELECT 'x' AS indicateur, '' AS indicateur_parent, host AS maille, '' AS maille_parent, n AS valeur FROM hosts"
    real = jobs.registry.run_reports

    def run_reports(shared, as_of, kpis, keep):
        shared.block("hosts_block", lambda: built.append(1) or shared.hosts)
        return real(shared, as_of, kpis, keep)

    monkeypatch.setattr(jobs.registry, "run_reports", run_reports)
    good = [Kpi(f"g{i}", "R1", "", "", sql_kpis.FAMILY, text.replace("'x'", f"'x{i}'")) for i in range(3)]
    summary = jobs.run_day(src, store, TODAY, [*good, BAD])
    assert sorted(summary.done) == ["g0", "g1", "g2"] and list(summary.failed) == ["b"] and built == [1]


def test_all_reports_of_a_root(src, store, tmp_path):
    """Directories of SQL files and other KPIs are one job; month files are averaged by the monthly job."""
    for report, label in (("r1", "A"), ("r2", "O")):
        (tmp_path / report).mkdir()
        (tmp_path / report / "indic_jour_x.sql").write_text(kpi("", "", label).spec, encoding="utf-8")
    month = "SELECT id_calc, id_maille, max(valeur) AS valeur FROM kpi_daily WHERE trunc(date, 'MM') = add_months(trunc(:as_of, 'MM'), -1) GROUP BY ALL"
    (tmp_path / "r2" / "indic_mois_x.sql").write_text(month, encoding="utf-8")
    (tmp_path / "notes.txt").write_text("no report")
    for root in (str(tmp_path), tmp_path.as_uri()):
        found = sql_kpis.reports_from_root(src.spark, root)
        assert [(k.report, k.name, k.grain) for k in found] == [
            ("R1", "indic_jour_x", "day"), ("R2", "indic_jour_x", "day"), ("R2", "indic_mois_x", "month"),
        ]
    february = AsOf(dt.date(2024, 2, 10))
    day, _ = jobs.run_due(src, store, february, str(tmp_path), [B])
    assert sorted(day.done) == ["b", "indic_jour_x", "indic_jour_x"]

    day, averaged = jobs.run_due(src, store, TODAY, str(tmp_path), [B])
    assert len(day.done) == 3 and averaged.done == ["indic_mois_x", "R1"]
    assert [r[:3] for r in rows(store, st.MONTHLY)] == [
        ("R1", "R1", "A"), ("R1", "R1", "A"), ("R1", "R1", "B"), ("R1", "R1", "B"),
        ("R2", "indic_mois_x", "O"), ("R2", "indic_mois_x", "O"),
    ]


# ---- ids of runs at a time -------------------------------------------------------------------
def labels(spark, report, units):
    data = [("i" + report, "", u, "", 1.0, "k", report) for u in units]
    return written(spark.createDataFrame(data, [*KPI_RESULT.names, "kpi", "report"]), "labels")


def test_two_registrations_at_a_time_share_no_id(spark, store, monkeypatch):
    """The second run reads the dimension before the first has written its new labels."""
    jobs.register_labels(store, labels(spark, "R0", ["x", "y"]))
    upsert = history.unit_upsert

    def meanwhile(*args):
        monkeypatch.undo()
        jobs.register_labels(HistoryStore(spark, store.database), labels(spark, "R2", ["p", "q", "common"]))
        return upsert(*args)

    before = store.read(st.UNITS).count()
    monkeypatch.setattr(history, "unit_upsert", meanwhile)
    jobs.register_labels(store, labels(spark, "R1", ["m", "n", "common"]))
    units = store.read(st.UNITS).collect()
    ids = [r.id_maille for r in units]
    assert len(set(ids)) == len(ids) >= before + 5
    assert {r.label for r in units} == {"x", "y", "m", "n", "p", "q", "common"}
    jobs.register_labels(store, labels(spark, "R3", ["z"]))
    ids = [r.id_maille for r in store.read(st.UNITS).collect()]
    assert len(set(ids)) == len(ids)


def test_claims(store):
    assert [store.claim(st.UNITS, 1), store.claim(st.UNITS, 1), store.claim(st.KPIS, 1)] == [1, 1 + st.CLAIM_STEP, 1]


# ---- snapshots -------------------------------------------------------------------------------
def test_a_snapshot_and_its_source_do_not_disturb_each_other(src, store):
    jobs.run_day(src, store, TODAY, [A, OTHER])
    first = rows(store)
    copy = store.snapshot(f"runs_{uuid.uuid4().hex[:8]}")
    assert rows(copy) == first
    copy.insert(st.DAILY, copy.spark.table(copy.name(st.DAILY)).filter("report = 'R1'"))
    assert len(rows(copy)) == len(first) + 2 and rows(store) == first
    jobs.recompute_day(src, copy, TODAY, [kpi("a", "R1", "A", "n * 5")])
    copy.delete_partitions(st.DAILY, [(TODAY.day, "R2")])
    assert rows(copy) == of(A, "A", 5) and rows(store) == first
    copy.drop()
    assert rows(store) == first


def test_insert_modes(src, store):
    jobs.run_day(src, store, TODAY, [A, OTHER])
    daily = written(store.spark.table(store.name(st.DAILY)), "daily")
    store.insert(st.DAILY, daily.filter("report = 'R2'"), mode="overwrite")
    assert rows(store) == of(OTHER, "O") and store.partitions(st.DAILY) == [(TODAY.day, "R2")]
    with pytest.raises(ValueError, match="already"):
        store.insert(st.DAILY, daily, mode="fail")
    with pytest.raises(ValueError, match="mode"):
        store.insert(st.DAILY, daily, mode="replace")
    store.insert(st.MONTHLY, daily, mode="fail")
    assert len(rows(store, st.MONTHLY)) == 4


def test_report_ids_that_need_escaping(src, store):
    odd = [kpi("q", "R'1/ü=%", "Q"), kpi("s", "back\\slash", "S")]
    jobs.run_day(src, store, TODAY, odd)
    jobs.recompute_day(src, store, TODAY, odd[:1])
    assert {(r[0], r[2]) for r in rows(store)} == {("R'1/ü=%", "Q"), ("back\\slash", "S")}
    store.delete_day(st.DAILY, TODAY.day)
    assert store.partitions(st.DAILY) == []
