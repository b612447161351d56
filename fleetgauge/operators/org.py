"""Organisation: directories, their codes and the paths assets are counted under."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge import fixed_values as fv
from fleetgauge.functions.text import empty_path, is_blank, last_paren_code, org_path
from fleetgauge.sources.tables import Sources


def org_union(src: Sources, levels: tuple[str, ...] = fv.ORG_LEVELS_6) -> DataFrame:
    """People and department accounts, one below the other, raw."""
    columns = ["id", *levels]
    return src.people.select(*columns).unionByName(src.departments.select(*columns))


def org_dimension(
    src: Sources,
    levels: tuple[str, ...] = fv.ORG_LEVELS_6,
    code: Callable[[str], Column] = last_paren_code,
) -> DataFrame:
    """Distinct (id, level codes). An id listed under two paths keeps both rows."""

    def build() -> DataFrame:
        return (
            org_union(src, levels)
            .filter(~is_blank("id"))
            .select("id", *[code(level).alias(level) for level in levels])
            .distinct()
        )

    return src.block(f"org{len(levels)}_{code.__name__}", build)


def org_weights(
    org: DataFrame, key: Column, levels: tuple[str, ...] = fv.ORG_LEVELS_6, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Directory rows counted per key and path.

    Joining the count instead of the rows keeps the fan-out of an id listed several times
    without producing a pair for each listing.
    """
    return (
        org.select(key.alias("org_key"), org_path(levels).alias("maille"), *[F.col(c) for c in keep])
        .groupBy("org_key", "maille", *keep)
        .agg(F.count(F.lit(1)).alias("org_rows"))
    )


def org_single(org: DataFrame, key: Column, levels: tuple[str, ...] = fv.ORG_LEVELS_6) -> DataFrame:
    """One directory row per key (the smallest), for measures that keep one row per asset."""
    row = F.min(F.struct(*levels)).alias("row")
    return (
        org.groupBy(key.alias("org_key")).agg(row).select("org_key", "row.*")
        .select("org_key", org_path(levels).alias("maille"), *levels)
        .withColumn("org_rows", F.lit(1).cast("long"))
    )


def left_join_spread(rows: DataFrame, right: DataFrame, key: str, right_key: str, spread_by: Sequence[str]) -> DataFrame:
    """Left join on one key, without its right column.

    Rows without a key never match, yet would all hash to one task. A second join key, taken
    from the columns ``spread_by`` for them and 0 for everybody else, spreads them over all tasks.
    """
    spread = F.when(F.col(key).isNull(), F.xxhash64(*spread_by))
    rows = rows.withColumn("_spread", F.coalesce(spread, F.lit(0)))
    right = right.withColumn("_zero", F.pmod(F.xxhash64(right_key), F.lit(1)))
    on = (F.col(key) == F.col(right_key)) & (F.col("_spread") == F.col("_zero"))
    return rows.join(right, on, "left").drop(right_key, "_spread", "_zero")


def with_paths(
    rows: DataFrame,
    org: DataFrame,
    owner: str,
    levels: tuple[str, ...] = fv.ORG_LEVELS_6,
    how: str = "left",
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Join owner keys to paths; with a left join, unknown owners go to the empty path.

    ``spread_by``: columns that spread the rows without an owner. Frames already aggregated
    per owner do not need it.
    """
    if how == "left" and spread_by:
        joined = left_join_spread(rows, org, owner, "org_key", spread_by)
    else:
        joined = rows.join(org, F.col(owner) == F.col("org_key"), how).drop("org_key")
    if how == "left":
        joined = joined.withColumn("maille", F.coalesce("maille", F.lit(empty_path(levels))))
        if "org_rows" in org.columns:
            joined = joined.withColumn("org_rows", F.coalesce("org_rows", F.lit(1)))
    return joined
