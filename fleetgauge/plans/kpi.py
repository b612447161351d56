"""What a KPI is, and how measures become result rows."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.fixed_values import RESULT_COLUMNS

DAY, MONTH = "day", "month"
REPORT, KPI = "report", "kpi"


@dataclass(frozen=True)
class Kpi:
    """A KPI: its report, labels, and the parameters its family builds it from."""

    name: str
    report: str
    indicateur: str
    indicateur_parent: str
    family: str
    spec: Any = None
    grain: str = DAY


@dataclass(frozen=True)
class Measure:
    """A KPI's value in a wide row, and whether the group exists for that KPI.

    ``present`` tells a zero that is kept from a group the KPI's own selection never had.
    """

    kpi: Kpi
    valeur: Column
    present: Column | None = None
    indicateur: Column | None = None
    indicateur_parent: Column | None = None


def result_rows(df: DataFrame, maille_parent: str, measures: list[Measure]) -> DataFrame:
    """Turn one wide row per group (with a ``maille`` column) into one row per KPI.

    The rows follow the result contract and carry the KPI's report and name besides.
    """
    true = F.lit(True)
    columns = [
        {
            RESULT_COLUMNS[0]: F.lit(m.kpi.indicateur) if m.indicateur is None else m.indicateur,
            RESULT_COLUMNS[1]: F.lit(m.kpi.indicateur_parent) if m.indicateur_parent is None else m.indicateur_parent,
            RESULT_COLUMNS[4]: m.valeur.cast("double"),
            KPI: F.lit(m.kpi.name),
            REPORT: F.lit(m.kpi.report),
        }
        for m in measures
    ]
    present = [true if m.present is None else m.present for m in measures]
    if len(measures) == 1:
        wide = df.filter(present[0]).select("maille", *[c.alias(n) for n, c in columns[0].items()])
    else:
        entries = [
            F.struct(*[c.alias(n) for n, c in named.items()], keep.alias("_keep"))
            for named, keep in zip(columns, present, strict=True)
        ]
        wide = df.select("maille", F.inline(F.array(*entries))).filter("_keep")
    return wide.select(
        RESULT_COLUMNS[0],
        RESULT_COLUMNS[1],
        RESULT_COLUMNS[2],
        F.lit(maille_parent).alias(RESULT_COLUMNS[3]),
        RESULT_COLUMNS[4],
        KPI,
        REPORT,
    )
