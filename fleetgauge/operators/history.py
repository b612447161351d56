"""Registering labels and building the daily fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.operators.ids import assign_ids, max_id
from fleetgauge.schemas import KPI_DEF, KPI_FACT, ORG_UNIT, STORED_FACT
from fleetgauge.session import written
from fleetgauge.sources.tables import Keep

PARENT_PHASE, CHILD_PHASE = 1, 2


def label_ids(dimension: DataFrame, id_column: str) -> DataFrame:
    """One id per label: the smallest, should a label have been registered twice."""
    return dimension.groupBy("label").agg(F.min(id_column).alias(id_column))


def new_labels(incoming: DataFrame, existing: DataFrame, label: str) -> DataFrame:
    """Rows of ``incoming`` whose label is not registered yet."""
    known = existing.select(F.col("label").alias("known_label"))
    return incoming.join(known, incoming[label] == known.known_label, "left_anti")


def dedupe_first(rows: DataFrame, label: str, others: list[str]) -> DataFrame:
    """One row per label; the smallest of the other columns taken together."""
    first = F.min(F.struct(*others)).alias("first")
    return rows.filter(F.col(label).isNotNull()).groupBy(label).agg(first).select(label, "first.*")


def unregistered(
    incoming: DataFrame, existing: DataFrame, label: str, others: list[str], keep: Keep = written
) -> DataFrame:
    """One row per label that is not registered yet.

    Written once: the steps that follow read these few rows several times, and the KPI rows
    they come from only once.
    """
    return keep(new_labels(dedupe_first(incoming, label, others), existing, label), f"new_{label}")


def _phases(fresh: DataFrame, existing: DataFrame, label: str, parent: str, extra: list[str]) -> DataFrame:
    """New labels with their phase: unknown parents first, then the other new labels.

    A label that is its own parent, or both a parent and a child, is registered as a parent.
    """
    extras = [F.col(c) for c in extra]
    parents = new_labels(fresh.filter(F.length(parent) > 0), existing, parent)
    parents = parents.select(
        F.col(parent).alias("label"), F.lit(PARENT_PHASE).alias("phase"), F.lit(None).cast("string").alias("parent_label"), *extras
    )
    children = fresh.select(
        F.col(label).alias("label"), F.lit(CHILD_PHASE).alias("phase"), F.col(parent).alias("parent_label"), *extras
    )
    row = F.min(F.struct("phase", "parent_label", *extra)).alias("row")
    return parents.unionByName(children).groupBy("label").agg(row).select("label", "row.*")


def _with_parent_ids(numbered: DataFrame, existing: DataFrame, id_column: str) -> DataFrame:
    """Id of the parent label, 0 without one. Only labels that are parents enter the lookup."""
    columns = ["label", id_column]
    wanted = numbered.select(F.col("parent_label").alias("label")).filter(F.col("label").isNotNull()).distinct()
    known = existing.select(*columns).unionByName(numbered.select(*columns)).join(wanted, "label", "left_semi")
    ids = label_ids(known, id_column).select(F.col("label").alias("parent_of"), F.col(id_column).alias("id_parent"))
    joined = numbered.join(ids, numbered.parent_label == ids.parent_of, "left")
    return joined.withColumn("id_parent", F.coalesce("id_parent", F.lit(0)).cast("long"))


def unit_upsert(
    existing: DataFrame, incoming: DataFrame, keep: Keep = written, after: Column | None = None
) -> DataFrame:
    """Unit rows to append for the ``maille`` / ``maille_parent`` labels of a KPI result.

    Ids go on from ``after``, by default the largest there is.
    """
    fresh = unregistered(incoming, existing, "maille", ["maille_parent"], keep)
    labels = _phases(fresh, existing, "maille", "maille_parent", [])
    numbered = assign_ids(labels, "id_maille", max_id(existing, "id_maille") if after is None else after)
    return _with_parent_ids(numbered, existing, "id_maille").select(*ORG_UNIT.names)


def kpi_upsert(
    existing: DataFrame,
    units: DataFrame,
    incoming: DataFrame,
    report: str | Column,
    keep: Keep = written,
    after: Column | None = None,
) -> DataFrame:
    """KPI rows to append for the ``indicateur`` / ``indicateur_parent`` labels of a KPI result.

    A label that is already registered keeps its report; ``units`` gives the unit group's id. Ids go on from ``after``,
    by default the largest there is.
    """
    fresh = unregistered(incoming, existing, "indicateur", ["indicateur_parent", "maille_parent"], keep)
    labels = _phases(fresh, existing, "indicateur", "indicateur_parent", ["maille_parent"])
    numbered = assign_ids(labels, "id_calc", max_id(existing, "id_calc") if after is None else after)
    with_parents = _with_parent_ids(numbered, existing, "id_calc")
    groups = labels.select(F.col("maille_parent").alias("label")).distinct()
    group_ids = label_ids(units.join(groups, "label", "left_semi"), "id_maille").select(
        F.col("label").alias("group_label"), F.col("id_maille").alias("id_maille_groupe")
    )
    out = with_parents.join(group_ids, with_parents.maille_parent == group_ids.group_label, "left")
    report = F.lit(report) if isinstance(report, str) else report
    return out.select(
        "id_calc",
        "label",
        "id_parent",
        F.coalesce("id_maille_groupe", F.lit(0)).cast("long").alias("id_maille_groupe"),
        F.array(report).alias("rapports"),
    ).select(*KPI_DEF.names)


def fact_lookup(rows: DataFrame, kpis: DataFrame, units: DataFrame) -> DataFrame:
    """Attach the ids of both labels; unknown labels get null."""
    calc = label_ids(kpis, "id_calc").withColumnRenamed("label", "kpi_label")
    unit = label_ids(units, "id_maille").withColumnRenamed("label", "unit_label")
    return (
        rows.join(calc, rows.indicateur == calc.kpi_label, "left")
        .join(unit, rows.maille == unit.unit_label, "left")
        .drop("kpi_label", "unit_label")
    )


def fact_dropna(rows: DataFrame) -> DataFrame:
    """Only complete fact rows."""
    return rows.na.drop(subset=KPI_FACT.names)


def daily_fact(rows: DataFrame, kpis: DataFrame, units: DataFrame, day: dt.date | Column) -> DataFrame:
    """KPI result rows as fact rows of one day."""
    day = F.lit(day.isoformat()).cast("date") if isinstance(day, dt.date) else day
    with_ids = fact_lookup(rows, kpis, units).withColumn("date", day)
    return fact_dropna(with_ids.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in KPI_FACT.fields]))


def stored_fact(rows: DataFrame, kpis: DataFrame, units: DataFrame, day: dt.date | Column) -> DataFrame:
    """KPI result rows with report and KPI as rows of the stored fact.

    A label belongs to the report that registered it first. Rows that another report gives for it are left out: two
    reports of one label and unit would otherwise count twice in the monthly average.
    """
    day = F.lit(day.isoformat()).cast("date") if isinstance(day, dt.date) else day
    owners = kpis.groupBy("label").agg(F.min_by("rapports", "id_calc").alias("owners")).withColumnRenamed("label", "owned")
    mine = rows.join(owners, (rows.indicateur == owners.owned) & F.array_contains("owners", F.col("report")), "left_semi")
    with_ids = fact_lookup(mine, kpis, units).withColumn("date", day)
    return fact_dropna(with_ids.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in STORED_FACT.fields]))
