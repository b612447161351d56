"""Registered queries that go through a history store and the jobs, read back from its tables.

The history in the store is the whole labelled one with the days of a month summed up: a date for each month, two
reports, one KPI for each label. It is filled once for a session; each query works on a snapshot of its own.
"""

from __future__ import annotations

import datetime as dt
import uuid
import weakref
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.kpi_sql import kpi_sql
from checks.operator_queries import Build, dated, iso, register
from fleetgauge.functions.time import AsOf
from fleetgauge.operators import history
from fleetgauge.plans import jobs, registry
from fleetgauge.plans.kpi import MONTH, Kpi
from fleetgauge.schemas import STORED_FACT
from fleetgauge.session import shared_folder, written
from fleetgauge.sources import sql_kpis
from fleetgauge.sources import store as st
from fleetgauge.sources.fixtures import AS_OF
from fleetgauge.sources.store import HistoryStore
from fleetgauge.sources.tables import Sources

LABELS = ["indicateur", "indicateur_parent", "maille", "maille_parent"]
DAY = dt.date(2001, 7, 1)
TODAY = AsOf(dt.date(2001, 8, 1))
#: Keeps everything, for jobs whose purge is not what is looked at.
FOREVER = 1200


# ---- the store ---------------------------------------------------------------------------------
def report_of(label: Column) -> Column:
    return F.when(label.rlike("orders (1|2)"), F.lit("R1")).otherwise(F.lit("R2"))


def by_month(src: Sources) -> DataFrame:
    """The labelled history with one date a month."""
    keys = [*LABELS, F.trunc("date", "MM").alias("date")]
    return src.kpi_daily_labelled.groupBy(*keys).agg(F.sum("valeur").alias("valeur"))


HISTORY_SQL = """SELECT indicateur, indicateur_parent, maille, maille_parent, date_trunc('month', date) AS date, sum(valeur) AS valeur
FROM kpi_daily_labelled GROUP BY ALL"""


def new_store(spark: SparkSession) -> HistoryStore:
    name = f"check_{uuid.uuid4().hex[:12]}"
    return HistoryStore(spark, name, FOREVER, FOREVER, f"{shared_folder(spark)}/{name}").create()


def load(store: HistoryStore, rows: DataFrame) -> HistoryStore:
    """Register the labels of labelled rows with report and KPI, and store the rows as daily fact."""
    rows = written(rows, "labelled")
    jobs.register_labels(store, rows.select(*LABELS, "report").distinct())
    store.insert(st.DAILY, history.stored_fact(rows, store.read(st.KPIS), store.read(st.UNITS), F.col("date")))
    return store


_FILLED: weakref.WeakKeyDictionary[SparkSession, dict[str, HistoryStore]] = weakref.WeakKeyDictionary()


def filled(src: Sources) -> HistoryStore:
    """A store of the whole history, by month; the same for all queries over one set of tables."""
    known, key = _FILLED.setdefault(src.spark, {}), src.orders.inputFiles()[0]
    if key not in known:
        label = F.col("indicateur")
        known[key] = load(new_store(src.spark), by_month(src).withColumns({"report": report_of(label), "kpi": label}))
    return known[key]


def labelled(store: HistoryStore, table: str = st.DAILY) -> DataFrame:
    """A fact table with the labels of its ids and of their parents."""

    def names(dimension: str, key: str, name: str) -> DataFrame:
        rows = store.read(dimension)
        parents = rows.select(F.col(key).alias("of"), F.col("label").alias(f"{name}_parent"))
        return rows.join(parents, rows.id_parent == parents.of, "left").select(key, F.col("label").alias(name), f"{name}_parent")

    fact = store.read(table).join(names(st.KPIS, "id_calc", "indicateur"), "id_calc")
    fact = fact.join(names(st.UNITS, "id_maille", "maille"), "id_maille")
    return dated(fact.select(*LABELS, "date", "valeur"))


def stored(change: Callable[[HistoryStore], object], read: Callable[[HistoryStore], DataFrame] = labelled) -> Build:
    """What ``read`` gives of a snapshot of the history after ``change``; the snapshot is gone afterwards."""

    def build(src: Sources) -> DataFrame:
        name = f"check_{uuid.uuid4().hex[:12]}"
        store = filled(src).snapshot(name, f"{shared_folder(src.spark)}/{name}")
        try:
            change(store)
            return written(read(store), "read_back")
        finally:
            store.drop()

    return build


# ---- tables --------------------------------------------------------------------------------------
_FACT = f"SELECT * REPLACE (strftime(date, '%Y-%m-%d') AS date) FROM ({HISTORY_SQL})"
_AUGUST = f"SELECT * REPLACE ('2001-08-02' AS date, valeur + 1 AS valeur) FROM ({_FACT}) WHERE date = '2001-08-01'"


def _next_day(store: HistoryStore) -> DataFrame:
    """The rows of 1 August, changed, as those of the day after."""
    last = store.stored(st.DAILY, dt.date(2001, 8, 1))
    changed = last.withColumns({"date": F.lit(dt.date(2001, 8, 2)), "valeur": F.col("valeur") + 1})
    return written(changed, "next_day")


register("store_append", f"{_FACT} UNION ALL {_AUGUST}")(stored(lambda store: store.insert(st.DAILY, _next_day(store))))

register("store_overwrite", _AUGUST)(
    stored(lambda store: store.insert(st.DAILY, _next_day(store), mode="overwrite"))
)


def _insert_if_empty(store: HistoryStore) -> None:
    """The first insert meets an empty table, the second does not and is refused."""
    store.insert(st.MONTHLY, store.spark.table(store.name(st.DAILY)), mode="fail")
    try:
        store.insert(st.MONTHLY, _next_day(store), mode="fail")
    except ValueError:
        return
    raise AssertionError("a table with rows was inserted into")


register("store_insert_if_empty", _FACT)(stored(_insert_if_empty, lambda store: labelled(store, st.MONTHLY)))

register("store_delete_day", f"SELECT * FROM ({_FACT}) WHERE date <> '{DAY}'")(
    stored(lambda store: store.delete_day(st.DAILY, DAY))
)

register("store_delete_yesterday", f"SELECT * FROM ({_FACT}) WHERE date <> '{DAY}'")(
    stored(lambda store: store.delete_yesterday(st.DAILY, AsOf(dt.date(2001, 7, 2))))
)

register("store_delete_month", f"SELECT * FROM ({_FACT}) WHERE date <> '{DAY}'")(
    stored(lambda store: store.delete_month(st.DAILY, 2001, 7))
)


def _purge(table: str, months: int) -> Callable[[HistoryStore], None]:
    def change(store: HistoryStore) -> None:
        if table == st.MONTHLY:
            store.insert(st.MONTHLY, store.spark.table(store.name(st.DAILY)))
        store.retention[table] = months
        store.purge(TODAY, table)

    return change


register("store_retention_daily", f"SELECT * FROM ({_FACT}) WHERE date >= '2001-06-01'")(stored(_purge(st.DAILY, 2)))

register("store_retention_monthly", f"SELECT * FROM ({_FACT}) WHERE date >= '2000-08-01'")(
    stored(_purge(st.MONTHLY, 12), lambda store: labelled(store, st.MONTHLY))
)


# ---- the daily job ---------------------------------------------------------------------------------
PRIORITIES = ["orders 1-URGENT", "orders 2-HIGH", "orders 3-MEDIUM", "orders 4-NOT SPECIFIED", "orders 5-LOW"]
_TIMES_TEN = "SELECT {columns}, 10 * valeur AS valeur FROM history WHERE date = :as_of AND indicateur = '{label}'"


def tenfold(src: Sources, labels: list[str], bad: tuple[str, ...] = ()) -> tuple[Sources, list[Kpi]]:
    """One KPI for each label, ten times its value in the history; ``bad`` ones fail while they run."""

    def text(label: str) -> str:
        sql = _TIMES_TEN.format(columns=", ".join(LABELS), label=label)
        return sql.replace("10 *", "1 / (length(maille) - length(maille)) *") if label in bad else sql

    kpis = [Kpi(x, "R1" if x[7] in "12" else "R2", "", "", sql_kpis.FAMILY, text(x)) for x in labels]
    return Sources.from_frames(src.spark, {"history": by_month(src)}), kpis


def recomputed(labels: list[str], bad: tuple[str, ...] = ()) -> Build:
    """The daily fact after the job has computed KPIs of a day again, some of which may fail while running."""

    def build(src: Sources) -> DataFrame:
        def change(store: HistoryStore) -> None:
            summary = jobs.recompute_day(*_with_store(tenfold(src, labels, bad), store))
            if sorted(summary.failed) != sorted(bad):
                raise AssertionError(f"failed: {summary.failed}")

        return stored(change)(src)

    return build


def _with_store(of: tuple[Sources, list[Kpi]], store: HistoryStore) -> tuple[Sources, HistoryStore, AsOf, list[Kpi]]:
    return of[0], store, AsOf(DAY), of[1]


def _tenfold_sql(condition: str) -> str:
    return (
        f"SELECT * FROM ({_FACT}) WHERE NOT (date = '{DAY}' AND {condition}) UNION ALL "
        f"SELECT * REPLACE (10 * valeur AS valeur) FROM ({_FACT}) WHERE date = '{DAY}' AND {condition}"
    )


register("job_recompute_day", _tenfold_sql("TRUE"))(recomputed(PRIORITIES))

# one KPI of each report: the others of both keep their rows
register("job_recompute_some", _tenfold_sql(f"indicateur IN ('{PRIORITIES[0]}', '{PRIORITIES[3]}')"))(
    recomputed([PRIORITIES[0], PRIORITIES[3]])
)

# one of two KPIs of a report fails while running: its rows of before stay
register("job_recompute_failing", _tenfold_sql(f"indicateur = '{PRIORITIES[0]}'"))(
    recomputed(PRIORITIES[:2], bad=(PRIORITIES[1],))
)

_RUNS = """SELECT DISTINCT CASE WHEN regexp_matches(indicateur, 'orders (1|2)') THEN 'R1' ELSE 'R2' END AS report, indicateur AS kpi,
'day' AS grain, 'done' AS status, strftime(date_trunc('month', date), '%Y-%m-%d') AS period FROM kpi_daily_labelled"""


def _runs(src: Sources) -> DataFrame:
    """A run of each KPI on each day it has rows."""
    label = F.col("indicateur")
    runs = by_month(src).select(report_of(label).alias("report"), label.alias("kpi"), F.col("date").alias("period"))
    return runs.distinct().withColumns({"grain": F.lit("day"), "status": F.lit(st.DONE)})


def _ledger(store: HistoryStore) -> DataFrame:
    return store.read(st.RUNS).withColumn("period", iso("period"))


@register("job_purge_day", f"SELECT * FROM ({_RUNS}) WHERE period <> '{DAY}'")
def _(src):
    """Runs of the days that still have rows, after one was purged with its runs."""

    def change(store):
        store.insert(st.RUNS, _runs(src))
        jobs.purge_day(store, AsOf(DAY))

    def read(store):
        kept = store.read(st.DAILY).select(iso("date").alias("kept")).distinct()
        runs = _ledger(store)
        return runs.join(kept, runs.period == kept.kept, "left_semi")

    return stored(change, read)(src)


@register(
    "store_pending",
    "SELECT report, kpi, 'day' AS grain, period AS since FROM (SELECT report, kpi, min(period) AS period FROM "
    f"({_RUNS}) GROUP BY ALL) WHERE kpi NOT IN ('{PRIORITIES[0]}', '{PRIORITIES[4]}')",
)
def _(src):
    """KPIs that still have to be run on a day: of five, two are done, one is empty, one failed, one was cut short."""
    states = dict(zip(PRIORITIES, (st.DONE, st.EMPTY, st.FAILED, st.STARTED, st.DONE), strict=True))
    day = dt.date(2001, 8, 3)

    def change(store):
        store.insert(st.RUNS, _runs(src))
        store.record_runs([("R1" if k[7] in "12" else "R2", k, "day", state, day) for k, state in states.items()])

    def read(store):
        runs = store.read(st.RUNS)
        known = runs.filter(F.col("period") < F.lit(day)).groupBy("report", "kpi", "grain").agg(iso(F.min("period")).alias("since"))
        return store.pending(known, AsOf(day), "day")

    return stored(change, read)(src)


@register(
    "job_ledger",
    "SELECT DISTINCT CASE WHEN regexp_matches(indicateur, 'orders (1|2)') THEN 'R1' ELSE 'R2' END AS report, indicateur AS kpi, "
    f"'day' AS grain, CASE indicateur WHEN '{PRIORITIES[1]}' THEN 'empty' WHEN '{PRIORITIES[2]}' THEN 'failed' ELSE 'done' END AS status, "
    f"'{DAY}' AS period FROM kpi_daily_labelled",
)
def _(src):
    """The ledger after a day on which one KPI of a report gave no row and one of the other failed."""

    def change(store):
        history_src, kpis = tenfold(src, PRIORITIES, bad=(PRIORITIES[2],))
        kpis[1] = replace(kpis[1], spec=kpis[1].spec + " AND false")
        jobs.run_day(history_src, store, AsOf(DAY), kpis)

    return stored(change, _ledger)(src)


# ---- the monthly job -------------------------------------------------------------------------------
MONTH_COLUMNS = ["indicateur", "maille", "date", "valeur"]


def averages(store: HistoryStore) -> DataFrame:
    return labelled(store, st.MONTHLY).withColumn("valeur", F.round("valeur", 6)).select(*MONTH_COLUMNS)


# the history has one date a month, so a month's average is that date's value
_AVERAGE = f"SELECT indicateur, maille, date, round(valeur, 6) AS valeur FROM ({_FACT}) WHERE date = '{DAY}'"

register("job_month", _AVERAGE)(stored(lambda store: jobs.run_month(store, TODAY), averages))


@register(
    "job_recompute_month",
    f"SELECT indicateur, maille, date, round(CASE WHEN date = '{DAY}' THEN 2 * valeur ELSE valeur END, 6) AS valeur FROM ({_FACT})",
)
def _(src):
    """The month by SQL files of its reports, over averages of all months that were there before."""
    text = """SELECT d.id_calc, d.id_maille, 2 * max(d.valeur) AS valeur, max(k.label) AS label
        FROM kpi_daily d JOIN kpi_def k ON k.id_calc = d.id_calc
        WHERE array_contains(k.rapports, '{report}') AND trunc(d.date, 'MM') = add_months(trunc(:as_of, 'MM'), -1)
        GROUP BY d.id_calc, d.id_maille"""
    kpis = [Kpi("indic_mois_x", r, "", "", sql_kpis.FAMILY, text.format(report=r), MONTH) for r in ("R1", "R2")]

    def change(store):
        before = store.spark.table(store.name(st.DAILY)).withColumn("kpi", F.lit("indic_mois_x"))
        store.insert(st.MONTHLY, before.select(*STORED_FACT.names))
        jobs.recompute_month(store, TODAY, kpis)

    return stored(change, averages)(src)


def month_of(report: str, label: Callable[[], Column]) -> Build:
    """The monthly fact of one report, by the definition it has, over the history under other labels."""

    def build(src: Sources) -> DataFrame:
        rows = by_month(src).withColumn("indicateur", label())
        rows = rows.withColumns({"report": F.lit(report), "kpi": F.col("indicateur")})
        store = load(new_store(src.spark), rows)
        try:
            summary = jobs.run_month(store, TODAY, [report])
            if summary.done != [report]:
                raise AssertionError(f"{summary}")
            return written(averages(store), "read_back")
        finally:
            store.drop()

    return build


register("job_month_labelled", _AVERAGE)(month_of("R031", lambda: F.col("indicateur")))

_OS_LABEL = "nombre de postes avec OS "
register(
    "job_month_regex",
    f"SELECT replace(indicateur, 'orders ', '{_OS_LABEL}') AS indicateur, maille, date, valeur FROM ({_AVERAGE}) "
    "WHERE indicateur[8] IN ('1', '2', '3')",
)(
    # three of the five labels are such as the report's pattern asks for
    month_of(
        "R035",
        lambda: F.when(
            F.substring("indicateur", 8, 1).isin("1", "2", "3"),
            F.replace("indicateur", F.lit("orders "), F.lit(_OS_LABEL)),
        ).otherwise(F.col("indicateur")),
    )
)


# ---- all reports -----------------------------------------------------------------------------------
_REGISTER = "SELECT 'Registre' AS indicateur, '' AS indicateur_parent, coalesce(network, '') AS maille, 'reseau' AS maille_parent, count(*) AS valeur FROM assets GROUP BY ALL"
_SEEN = "SELECT 'Vus' AS indicateur, '' AS indicateur_parent, coalesce(network, '') AS maille, 'reseau' AS maille_parent, count(*) AS valeur FROM assets JOIN last_seen ON hostname = tag GROUP BY ALL"
_MONTH_FILE = "SELECT id_calc, id_maille, sum(valeur) AS valeur FROM kpi_daily WHERE trunc(date, 'MM') = add_months(trunc(:as_of, 'MM'), -1) GROUP BY ALL"
_BUILT_IN = ("kpi_assets", "compliance_total")


def save_text(spark: SparkSession, path: str, text: str) -> None:
    """A text file on whatever file system the path is on."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def _root(spark: SparkSession) -> str:
    """Two report directories of SQL files; one has a monthly file, too."""
    root = f"{shared_folder(spark)}/reports-{uuid.uuid4().hex}"
    save_text(spark, f"{root}/r098/indic_jour_registre.sql", _REGISTER)
    save_text(spark, f"{root}/r099/indic_jour_vus.sql", _SEEN)
    save_text(spark, f"{root}/r099/indic_mois_tout.sql", _MONTH_FILE)
    return root if "://" in root or root.startswith("file:") else f"file:{root}"


_DUE_PARTS = [_REGISTER, _SEEN, *[kpi_sql(n) for n in _BUILT_IN]]


@register("run_due", " UNION ALL ".join(f"SELECT indicateur, maille, CAST(valeur AS DOUBLE) AS valeur FROM ({x})" for x in _DUE_PARTS))
def _(src):
    """The default run of a day over two directories and built-in KPIs."""
    store = new_store(src.spark)
    try:
        built_in = [registry.BY_NAME[n] for n in _BUILT_IN]
        jobs.run_due(src, store, AS_OF, _root(src.spark), built_in)
        return written(labelled(store).select("indicateur", "maille", "valeur"), "read_back")
    finally:
        store.drop()


@register("run_due_month", f"SELECT indicateur, maille, valeur FROM ({_FACT}) WHERE date = '{DAY}'")
def _(src):
    """The month of a default run: the built-in reports are empty, the monthly file of a directory gives its rows."""

    def change(store):
        jobs.run_due(src, store, TODAY, _root(src.spark), [])

    return stored(change, lambda store: averages(store).select("indicateur", "maille", "valeur"))(src)
