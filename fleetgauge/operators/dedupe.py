"""One row per key."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SEQUENCE_COLUMNS = ("seq", "seq2")


def tie_break(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Columns that order rows of equal age: the source's sequence, then everything else.

    Arrays and plain scalars can be ordered; a total order keeps re-runs identical.
    """
    skip = set(exclude)
    sequence = [c for c in _SEQUENCE_COLUMNS if c in df.columns]
    return sequence + [c for c in df.columns if c not in skip and c not in sequence]


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row of each key under ``order``.

    The rank filter lets Spark drop all but the first row per key in every map task before
    the shuffle (window group limit), so one key with very many rows moves one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def latest_per_key(df: DataFrame, keys: list[str], ts: str, ties: list[str] | None = None) -> DataFrame:
    """Latest row of each key; a null time counts as the latest."""
    ties = tie_break(df, exclude=[*keys, ts]) if ties is None else ties
    return first_per_key(df, keys, [F.desc_nulls_first(ts)] + [F.asc(c) for c in ties])


def tied_keys(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Keys of which several rows share the latest time and all sequence columns. Reads these columns only."""
    order = [F.desc_nulls_first(ts), *[F.asc(c) for c in _SEQUENCE_COLUMNS if c in df.columns]]
    place = F.rank().over(Window.partitionBy(*keys).orderBy(*order))
    latest = df.select(*keys, place.alias("_place")).filter(F.col("_place") == 1)
    return latest.groupBy(*keys).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > 1).select(*keys)


def latest_narrow(df: DataFrame, keys: list[str], ts: str, columns: list[str], tied: DataFrame | None) -> DataFrame:
    """Latest row of each key, with ``columns``: the same rows as ``latest_per_key`` finds by all columns of ``df``.

    The winner is found by time and sequence, and no other column is read for that. Only for ``tied`` keys (None: there
    are none), whose rows these do not tell apart, are all columns fetched.
    """
    sequence = [c for c in _SEQUENCE_COLUMNS if c in df.columns]
    wanted = list(dict.fromkeys([*keys, ts, *columns]))
    narrow = df.select(*dict.fromkeys([*wanted, *sequence]))
    if tied is None:
        return latest_per_key(narrow, keys, ts, sequence).select(*wanted)
    same = lambda left, right: reduce(Column.__and__, [left[k].eqNullSafe(right[k]) for k in keys])
    tied = tied.select(*keys)
    plain = latest_per_key(narrow.join(tied, same(narrow, tied), "left_anti"), keys, ts, sequence)
    full = latest_per_key(df.join(tied, same(df, tied), "left_semi"), keys, ts)
    return plain.select(*wanted).unionByName(full.select(*wanted))


def newest_first(df: DataFrame, ts: str) -> Column:
    """Sort key whose smallest value is the latest time, or a missing one."""
    kind = df.schema[ts].dataType
    if not isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise TypeError(f"{ts} is {kind.simpleString()}, expected a date or timestamp")
    return F.struct(F.col(ts).isNotNull().alias("known"), (F.lit("1970-01-01").cast(kind) - F.col(ts)).alias("since"))
