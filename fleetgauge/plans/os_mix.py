"""Assets by operating system name, edition, long-term branch and support class."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge import fixed_values as fv
from fleetgauge.functions.text import (
    concat_skip_nulls,
    default_label,
    extended_support_suffix,
    greedy_paren_code,
    last_paren_code,
    replace_first,
)
from fleetgauge.functions.time import AsOf
from fleetgauge.operators.org import with_paths
from fleetgauge.operators.skew import HeavyKeys, heavy_keys
from fleetgauge.plans.kpi import Kpi, Measure, result_rows
from fleetgauge.sources.tables import Sources

FAMILY, REPORT = "os_mix", "R035"


def org_path3() -> Column:
    """Three-level path: the first level's last parentheses, the others' widest ones."""
    return F.concat(
        last_paren_code("um"),
        F.lit(fv.PATH_SEPARATOR),
        greedy_paren_code("dum"),
        F.lit(fv.PATH_SEPARATOR),
        greedy_paren_code("code_moa"),
    )


def raw_units(src: Sources) -> DataFrame:
    """Distinct raw unit names per id."""
    return src.people_all.select(
        F.col("id").alias("org_key"), *[F.trim(c).alias(c) for c in fv.ORG_LEVELS_3]
    ).filter(F.col("org_key").isNotNull()).distinct()


def register_os(src: Sources) -> DataFrame:
    """Distinct (tag, owner, OS name, OS build) of the register."""
    return src.assets_os.select("tag", "owner_id", "os_name", "os_build").distinct()


def with_raw_units(rows: DataFrame, src: Sources) -> DataFrame:
    """Attach the owner's raw units; the id compares case-sensitively, unknown owners stay."""
    units = raw_units(src).withColumn("maille", F.lit(None).cast("string"))
    return with_paths(rows, units, "owner_id", fv.ORG_LEVELS_3, spread_by=["tag"]).drop("maille")


def with_os_reference(rows: DataFrame, src: Sources) -> DataFrame:
    """Attach the OS reference on 'name build', reading a missing part as empty."""
    ref = src.os_ref.select("os_key", "name", "edition", "commercial_version").distinct()
    key = concat_skip_nulls("os_name", F.lit(" "), "os_build")
    return rows.join(ref, key == ref.os_key, "left")


def os_version_keys(src: Sources) -> DataFrame:
    """OS reference with the 'name build' key, extended support included."""
    regular = F.concat(replace_first("commercial_name", fv.OS_VENDOR_IN_NAME), F.lit(" "), F.col("technical_version"))
    extended = F.concat(F.col("commercial_name"), extended_support_suffix("groupid"))
    return src.os_version.withColumn("os_key", F.when(extended_support_suffix("groupid").isNotNull(), extended).otherwise(regular))


def support_classes(src: Sources) -> DataFrame:
    """Distinct (OS key, support class)."""
    protection = src.os_protection.select(F.col("groupid").alias("protected_group"), "protected")
    classes = [F.lit(x) for pair in fv.SUPPORT_CLASSES.items() for x in pair]
    keys = os_version_keys(src)
    joined = keys.join(protection, keys.groupid == protection.protected_group, "left")
    return joined.select(
        F.col("os_key").alias("support_key"), F.element_at(F.create_map(*classes), F.col("protected")).alias("support")
    ).distinct()


def with_support_class(rows: DataFrame, src: Sources) -> DataFrame:
    classes = support_classes(src)
    key = F.concat("os_name", F.lit(" "), "os_build")
    return rows.join(classes, key == classes.support_key, "left")


def heavy_os(src: Sources) -> HeavyKeys:
    """Pairs of OS name and build that many hosts have."""
    return src.known("heavy_os", lambda: heavy_keys(src.assets_os, ["os_name", "os_build"]))


_REFERENCE, _SUPPORT = "reference", "support"


def with_os_attributes(rows: DataFrame, src: Sources, kinds: list[str]) -> DataFrame:
    """One row per entry of the OS reference and per support class, told apart by ``kind``.

    The few pairs of OS name and build are looked up, not the register; one OS may be on most
    hosts: the hosts of such a one are split by a second join key, for which its pair is repeated.
    """
    heavy = heavy_os(src)
    pairs = src.assets_os.select("os_name", "os_build").distinct()
    null = F.lit(None).cast("string")
    found = {
        _REFERENCE: lambda: with_os_reference(pairs, src).withColumn("support", null),
        _SUPPORT: lambda: with_support_class(pairs, src).withColumns(
            {c: null for c in ("name", "edition", "commercial_version")}
        ),
    }
    columns = ["name", "edition", "commercial_version", "support"]
    keys = [F.col("os_name").alias("pair_name"), F.col("os_build").alias("pair_build")]
    parts = [heavy.repeated(found[k](), "pair_part").select(*keys, "pair_part", F.lit(k).alias("kind"), *columns) for k in kinds]
    attributes = reduce(DataFrame.unionByName, parts)
    same = F.col("os_name").eqNullSafe(F.col("pair_name")) & F.col("os_build").eqNullSafe(F.col("pair_build"))
    rows = heavy.split(rows, ["tag", "owner_id"])
    joined = rows.join(attributes, same & (F.col("part") == F.col("pair_part")), "inner")
    return joined.drop("part", "pair_part", "pair_name", "pair_build")


def _label(kpi: Kpi) -> Column:
    """The label, by the attribute that the KPI tells apart."""
    if kpi.spec == "ltsc":
        return F.trim(F.lit(kpi.indicateur))
    value = F.col("first") if kpi.spec == "name" else F.col("second")
    return F.trim(F.concat(F.lit(kpi.indicateur), default_label(value)))


def _tuple(i: int, kpi: Kpi) -> Column:
    """What a KPI counts once: the tag with up to two attributes, and whether the row is one."""
    kind = F.col("kind") == (_SUPPORT if kpi.spec == "support" else _REFERENCE)
    tag, name, edition, support = (F.col(c) for c in ("tag", "name", "edition", "support"))
    tag, first, second, keep = {
        "name": (F.trim(tag), F.trim(name), F.lit(None), kind),
        "licence": (tag, name, edition, kind),
        "ltsc": (tag, name, edition, kind & F.col("commercial_version").contains(fv.LTSC_MARK)),
        "support": (tag, F.col("os_name"), support, kind),
    }[kpi.spec]
    return F.struct(
        F.lit(i).alias("kpi"),
        tag.alias("tag"),
        first.cast("string").alias("first"),
        second.cast("string").alias("second"),
        F.coalesce(keep, F.lit(False)).alias("keep"),
    )


def os_mix_kpis(src: Sources, as_of: AsOf, kpis: list[Kpi]) -> DataFrame:
    """Requested OS counts in one pass; each counts its own distinct tuples.

    Owners' units are attached before a host has a row per entry of the OS lists. Labels and
    paths follow from what is counted by and are made for the few sums, not for each host.
    """
    kinds = sorted({_SUPPORT if k.spec == "support" else _REFERENCE for k in kpis})
    rows = with_os_attributes(with_raw_units(register_os(src), src), src, kinds)
    entries = F.inline(F.array(*[_tuple(i, k) for i, k in enumerate(kpis)]))
    tuples = rows.select(*fv.ORG_LEVELS_3, entries).filter("keep").distinct()
    sums = tuples.groupBy("kpi", "first", "second", *fv.ORG_LEVELS_3).agg(F.count(F.lit(1)).alias("n"))
    label = reduce(lambda found, i: F.when(F.col("kpi") == i, _label(kpis[i])).otherwise(found), range(len(kpis)), F.lit(None))
    counts = sums.groupBy("kpi", label.alias("label"), org_path3().alias("maille")).agg(F.sum("n").alias("n"))
    measures = [Measure(k, F.col("n"), F.col("kpi") == i, indicateur=F.col("label")) for i, k in enumerate(kpis)]
    return result_rows(counts, fv.UNIT_GROUP_3, measures)


KPIS = [
    Kpi("os_name", REPORT, "nombre de postes avec OS ", "nombre de postes avec OS", FAMILY, "name"),
    Kpi("os_licence", REPORT, "nombre de postes avec licence ", "nombre de postes avec licence", FAMILY, "licence"),
    Kpi("os_ltsc", REPORT, "nombre de postes avec LTSC", "nombre de postes avec LTSC", FAMILY, "ltsc"),
    Kpi("os_support_class", REPORT, "nombre de postes avec support ", "nombre de postes avec support", FAMILY, "support"),
]
