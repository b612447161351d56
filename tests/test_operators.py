from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from fleetgauge.functions.time import AsOf
from fleetgauge.operators import dedupe, history, ids, maintenance, org, rollup
from fleetgauge.schemas import KPI_DEF, KPI_FACT, KPI_RESULT, KPI_RUN, ORG_UNIT, ContractError, conform

DAY = dt.date(2024, 3, 1)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_missing_time_is_the_latest(spark):
    df = spark.createDataFrame(
        [("a", DAY, 1), ("a", None, 2), ("b", DAY, 2), ("b", DAY, 1), (None, DAY, 1), (None, DAY, 2)],
        "k string, ts date, seq int",
    )
    assert rows(dedupe.latest_per_key(df, ["k"], "ts")) == [(None, DAY, 1), ("a", None, 2), ("b", DAY, 1)]


def test_latest_keeps_one_row_per_key_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), F.current_date().alias("ts"), "id")
    plan = dedupe.latest_per_key(df, ["k"], "ts")._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle


def test_newest_first_orders_like_the_window(spark):
    times = [None, dt.datetime(2024, 1, 1), dt.datetime(1950, 1, 1), dt.datetime(2030, 5, 5, 1, 2, 3, 4)]
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], f"i int, ts {kind}")
        got = [r.i for r in df.orderBy(dedupe.newest_first(df, "ts")).collect()]
        assert got == [0, 3, 1, 2]
    with pytest.raises(TypeError):
        dedupe.newest_first(spark.createDataFrame([("x",)], "ts string"), "ts")


def test_ids_are_contiguous_and_ordered_by_phase(spark):
    labels = [(f"label {i}", 1 + i % 2) for i in range(500)]
    df = spark.createDataFrame(labels, "label string, phase int")
    got = {r.label: r.id for r in ids.assign_ids(df, "id", F.lit(10)).collect()}
    wanted = sorted(labels, key=lambda x: (x[1], hashlib.md5(x[0].encode()).hexdigest()[:3], x[0]))
    assert got == {label: 11 + i for i, (label, _) in enumerate(wanted)}
    again = {r.label: r.id for r in ids.assign_ids(df.repartition(7), "id", F.lit(10)).collect()}
    assert again == got


def test_next_id_of_an_empty_table(spark):
    assert ids.next_id(spark.createDataFrame([], ORG_UNIT), "id_maille").first().next_id == 1


def units(spark, data=()):
    return spark.createDataFrame(list(data), ORG_UNIT)


def labels(spark, data):
    return spark.createDataFrame(data, "maille string, maille_parent string")


def test_unit_upsert_on_an_empty_dimension(spark):
    incoming = labels(spark, [("a", "root"), ("b", "root"), ("a", "root"), ("root", "root"), (None, "root"), ("c", ""), ("d", None)])
    got = {r.label: (r.id_maille, r.id_parent) for r in history.unit_upsert(units(spark), incoming).collect()}
    assert got["root"] == (1, 0)
    assert sorted(i for i, _ in got.values()) == [1, 2, 3, 4, 5]
    assert got["a"][1] == got["b"][1] == 1
    assert got["c"][1] == got["d"][1] == 0


def test_unit_upsert_continues_ids_and_adds_nothing_twice(spark):
    known = units(spark, [(7, "root", 0), (9, "a", 7)])
    incoming = labels(spark, [("a", "other"), ("b", "root"), ("c", "new")])
    fresh = history.unit_upsert(known, incoming)
    got = {r.label: (r.id_maille, r.id_parent) for r in fresh.collect()}
    # "other" is the parent of a known label only, so it is not registered
    assert set(got) == {"b", "c", "new"}
    assert got["new"] == (10, 0)
    assert got["b"][1] == 7 and got["c"][1] == 10
    assert history.unit_upsert(known.unionByName(fresh), incoming).count() == 0


def test_a_child_that_is_a_parent_too_is_registered_once(spark):
    incoming = labels(spark, [("x", "y"), ("y", "z")])
    got = {r.label: (r.id_maille, r.id_parent) for r in history.unit_upsert(units(spark), incoming).collect()}
    assert len(got) == 3 and got["y"][1] == 0 and got["x"][1] == got["y"][0]


def kpi_rows(spark, data):
    return spark.createDataFrame(data, "indicateur string, indicateur_parent string, maille string, maille_parent string, valeur double")


def test_first_report_keeps_a_shared_label(spark):
    known = spark.createDataFrame([], KPI_DEF)
    group = units(spark, [(3, "group", 0)])
    first = history.kpi_upsert(known, group, kpi_rows(spark, [("k", "p", "u", "group", 1.0)]), "R1")
    second = history.kpi_upsert(known.unionByName(first), group, kpi_rows(spark, [("k", "q", "u", "group", 1.0), ("m", "k", "u", "none", 1.0)]), "R2")
    got = {r.label: r for r in first.unionByName(second).collect()}
    assert set(got) == {"p", "k", "m"}
    assert got["k"].rapports == ["R1"] and got["m"].rapports == ["R2"]
    assert got["m"].id_parent == got["k"].id_calc and got["k"].id_parent == got["p"].id_calc
    assert got["k"].id_maille_groupe == 3 and got["m"].id_maille_groupe == 0


def test_fact_takes_the_smallest_id_and_drops_unknown_labels(spark):
    kpis = spark.createDataFrame([(5, "k", 0, 0, ["R"]), (2, "k", 0, 0, ["R"])], KPI_DEF)
    result = kpi_rows(spark, [("k", "p", "u", "g", 4.0), ("x", "p", "u", "g", 1.0), ("k", "p", "v", "g", 1.0), ("k", "p", "u", "g", None)])
    fact = history.daily_fact(result, kpis, units(spark, [(1, "u", 0)]), DAY)
    assert rows(fact) == [(2, 1, 4.0, DAY)]
    assert fact.schema.simpleString() == KPI_FACT.simpleString()


def fact(spark, data):
    return spark.createDataFrame(data, KPI_FACT)


def test_monthly_average(spark):
    as_of = AsOf(dt.date(2024, 3, 31))
    daily = fact(spark, [(1, 1, 2.0, dt.date(2024, 2, 1)), (1, 1, 4.0, dt.date(2024, 2, 29)), (1, 1, 100.0, dt.date(2023, 2, 10)), (1, 1, 9.0, dt.date(2024, 3, 1)), (2, 1, 5.0, dt.date(2024, 2, 5))])
    kpis = spark.createDataFrame([(1, "nombre de postes avec OS x", 0, 0, ["R1", "R2"]), (2, "other", 0, 0, ["R2"])], KPI_DEF)
    february = dt.date(2024, 2, 1)
    assert rows(rollup.monthly_avg(daily, kpis, as_of, "R1")) == [(1, 1, 3.0, february)]
    assert rows(rollup.monthly_avg(daily, kpis, as_of, "R1", match_year=False)) == [(1, 1, pytest.approx(106 / 3), february)]
    every = rollup.monthly_all_reports(daily, kpis, as_of).select("report", "id_calc", "valeur")
    assert rows(every) == [("R1", 1, 3.0), ("R2", 1, 3.0), ("R2", 2, 5.0)]
    places = units(spark, [(1, "u", 0)])
    assert rows(rollup.monthly_regex(daily, kpis, places, as_of)) == [(1, 1, "nombre de postes avec OS x", "u", 3.0, february)]
    assert kpis.filter(rollup.of_all_reports(["R1", "R2"])).count() == 1


def test_deleting_and_ageing_out(spark):
    days = [dt.date(2023, 12, 31), dt.date(2024, 1, 1), dt.date(2024, 1, 31), dt.date(2024, 3, 1)]
    df = fact(spark, [(1, 1, 1.0, d) for d in days])

    def left(x):
        return [r.date for r in x.orderBy("date").collect()]

    assert left(maintenance.delete_day(df, days[1])) == [days[0], days[2], days[3]]
    assert left(maintenance.delete_month(df, 2023, 12)) == days[1:]
    assert left(maintenance.delete_month(df, 2024, 1)) == [days[0], days[3]]
    assert left(maintenance.retain_daily(df, AsOf(dt.date(2024, 3, 1)))) == days[1:]
    assert left(maintenance.delete_yesterday(df, AsOf(dt.date(2024, 2, 1)))) == [days[0], days[1], days[3]]
    replaced = maintenance.replace_day(df, days[3], fact(spark, [(2, 2, 2.0, days[3])]))
    assert rows(replaced.filter(F.col("date") == F.lit(days[3]))) == [(2, 2, 2.0, days[3])]


def test_ledger_key_has_the_report(spark):
    known = spark.createDataFrame([("R1", "k", "day"), ("R2", "k", "day"), ("R1", "R1", "month")], "report string, kpi string, grain string")
    runs = spark.createDataFrame([("R1", "k", "day", "done", DAY), ("R2", "k", "day", "failed", DAY), ("R1", "R1", "month", "done", dt.date(2024, 3, 1))], KPI_RUN)
    assert rows(maintenance.ledger_pending(known, runs, AsOf(DAY), "day")) == [("R2", "k", "day")]
    assert maintenance.ledger_pending(known, runs, AsOf(dt.date(2024, 3, 20)), "month").count() == 0
    assert maintenance.ledger_pending(known, runs, AsOf(dt.date(2024, 4, 1)), "month").count() == 1
    assert maintenance.clear_ledger(runs, "day", DAY).count() == 1


def test_contract(spark):
    good = kpi_rows(spark, [("i", "p", "u", "g", 1.0)]).withColumn("lastdate", F.current_date()).withColumn("valeur", F.lit(3))
    assert conform(good).schema.simpleString() == KPI_RESULT.simpleString()
    with pytest.raises(ContractError, match="maille_parent"):
        conform(good.drop("maille_parent"))
    with pytest.raises(ContractError, match="valeur"):
        conform(good.withColumn("valeur", F.lit("x")))
    with pytest.raises(ContractError, match="duplicated"):
        conform(good.select("*", F.col("maille").alias("maille")))


def test_paths_for_missing_and_repeated_owners(spark):
    directory = spark.createDataFrame([("A", "d1"), ("a", "d1"), ("A", "d2")], "id string, um string").withColumn("dum", F.lit("x")).withColumn("code_moa", F.lit(None).cast("string"))
    levels = ("um", "dum", "code_moa")
    weights = org.org_weights(directory, F.upper("id"), levels)
    owners = spark.createDataFrame([(f"t{i}", o) for i, o in enumerate(["A", None, None, "zz"])], "tag string, owner_key string")
    got = org.with_paths(owners, weights, "owner_key", levels, spread_by=["tag"]).select("tag", "maille", "org_rows")
    assert rows(got) == [("t0", "d1/x/", 2), ("t0", "d2/x/", 1), ("t1", "//", 1), ("t2", "//", 1), ("t3", "//", 1)]
    assert org.with_paths(owners, weights, "owner_key", levels, how="inner").count() == 2
