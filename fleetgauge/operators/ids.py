"""Surrogate ids that continue from the largest known one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Labels are spread over 16^3 buckets by a digest: even sizes, no hot bucket, and the same
# bucket on every run, so a recomputed task assigns the same ids.
_BUCKET_DIGITS = 3


def max_id(df: DataFrame, column: str) -> Column:
    """Largest id as a scalar, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(column), F.lit(0)).cast("long").alias("max_id")).scalar()


def next_id(df: DataFrame, column: str) -> DataFrame:
    """One row: the id the next new label gets."""
    return df.agg((F.coalesce(F.max(column), F.lit(0)) + 1).cast("long").alias("next_id"))


def label_bucket(label: str) -> Column:
    return F.substring(F.md5(F.col(label)), 1, _BUCKET_DIGITS)


def assign_ids(labels: DataFrame, id_column: str, start: Column, phase: str = "phase", label: str = "label") -> DataFrame:
    """Add contiguous ids after ``start``, ordered by phase, then label bucket, then label.

    Numbering all labels in one window would put them into one task. Here each bucket is
    numbered on its own, and only the bucket sizes (at most 4096 per phase) are summed up
    in one task to give each bucket its offset.
    """
    bucketed = labels.withColumn("_bucket", label_bucket(label))
    within = Window.partitionBy(phase, "_bucket").orderBy(label)
    ranked = bucketed.withColumn("_rank", F.row_number().over(within))
    sizes = ranked.groupBy(phase, "_bucket").agg(F.max("_rank").alias("_size"))
    before = Window.orderBy("o_phase", "o_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col(phase).alias("o_phase"), F.col("_bucket").alias("o_bucket"), "_size").withColumn(
        "_offset", F.coalesce(F.sum("_size").over(before), F.lit(0))
    )
    numbered = ranked.join(offsets, (ranked[phase] == offsets.o_phase) & (ranked["_bucket"] == offsets.o_bucket), "inner")
    return numbered.withColumn(id_column, (start + F.col("_offset") + F.col("_rank")).cast("long")).drop(
        "_bucket", "_rank", "_size", "_offset", "o_phase", "o_bucket"
    )
