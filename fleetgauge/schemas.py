"""Schemas of the frames this package owns, and the check of a KPI result against them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge.fixed_values import RESULT_COLUMNS

KPI_RESULT = T.StructType(
    [T.StructField(name, T.StringType()) for name in RESULT_COLUMNS[:4]]
    + [T.StructField(RESULT_COLUMNS[4], T.DoubleType())]
)

ORG_UNIT = T.StructType(
    [
        T.StructField("id_maille", T.LongType()),
        T.StructField("label", T.StringType()),
        T.StructField("id_parent", T.LongType()),
    ]
)

KPI_DEF = T.StructType(
    [
        T.StructField("id_calc", T.LongType()),
        T.StructField("label", T.StringType()),
        T.StructField("id_parent", T.LongType()),
        T.StructField("id_maille_groupe", T.LongType()),
        T.StructField("rapports", T.ArrayType(T.StringType())),
    ]
)

KPI_FACT = T.StructType(
    [
        T.StructField("id_calc", T.LongType()),
        T.StructField("id_maille", T.LongType()),
        T.StructField("valeur", T.DoubleType()),
        T.StructField("date", T.DateType()),
    ]
)

KPI_RUN = T.StructType(
    [
        T.StructField("report", T.StringType()),
        T.StructField("kpi", T.StringType()),
        T.StructField("grain", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("period", T.DateType()),
    ]
)

#: A stored fact row also tells which KPI of which report it comes from.
STORED_FACT = T.StructType(
    [
        *[f for f in KPI_FACT.fields if f.name != "date"],
        T.StructField("kpi", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("report", T.StringType()),
    ]
)

#: What happened to a KPI's run: how many rows it gave, where they were staged, and a number that grows with time.
KPI_EVENT = T.StructType(
    [
        *KPI_RUN.fields,
        T.StructField("n_rows", T.LongType()),
        T.StructField("location", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("month", T.DateType()),
    ]
)


class ContractError(ValueError):
    """A KPI result lacks a required column or has one that cannot be cast."""


def conform(df: DataFrame, schema: T.StructType = KPI_RESULT) -> DataFrame:
    """Check ``df`` against ``schema`` and project it, dropping surplus columns.

    Runs on the analysed schema only, so a broken KPI fails before any task starts.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in present]
    if missing:
        raise ContractError(f"missing columns: {', '.join(missing)}")
    duplicated = sorted({c for c in df.columns if df.columns.count(c) > 1 and c in schema.names})
    if duplicated:
        raise ContractError(f"duplicated columns: {', '.join(duplicated)}")
    for field in schema.fields:
        if isinstance(field.dataType, T.DoubleType):
            ok = isinstance(present[field.name], T.NumericType)
        elif isinstance(field.dataType, T.LongType):
            ok = isinstance(present[field.name], T.IntegralType)
        else:
            ok = present[field.name] == field.dataType or isinstance(present[field.name], T.NullType)
        if not ok:
            raise ContractError(f"{field.name} is {present[field.name].simpleString()}, expected {field.dataType.simpleString()}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
