"""Latest agent, directory and register records, and scans per host."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge import fixed_values as fv
from fleetgauge.functions.text import account_or_excluded, joined_list, key_part, norm_key
from fleetgauge.functions.time import AsOf, day_age
from fleetgauge.operators.dedupe import latest_narrow, latest_per_key, tie_break, tied_keys
from fleetgauge.sources.tables import Sources


# derived column -> agent columns it is made of
AGENT_COLUMNS = {
    "manufacturer": "manufacturer",
    "description": "description",
    "os": "os",
    "last_scan": "last_scan",
    "top_user": "top_user",
    "top_user_or_excluded": "top_user",
    "is_virtual": "host",
    "mac_list": "macs",
}


# register columns that KPIs read, in the order in which they break ties
REGISTER_COLUMNS = ("owner_id", "resp_id", "network", "manufacturer", "mac", "os", "is_virtual")


def agent_latest(src: Sources, columns: Iterable[str] = tuple(AGENT_COLUMNS)) -> DataFrame:
    """Latest agent record per host with the derived ``columns``.

    Ties between records of one scan are broken by all agent columns, whichever are asked for, so that a KPI has one
    value alone and in company; but where no host has any, as is measured once, the others are not read. A kept block
    has all columns.
    """
    columns = tuple(AGENT_COLUMNS) if src.keeps_blocks else tuple(sorted(set(columns)))
    return src.block(f"agent_latest_{'_'.join(columns)}", lambda: _agent_latest(src, columns))


def _agent_ties(src: Sources) -> DataFrame | None:
    """Hosts with several records of the latest scan and sequence, if there are any."""
    tied = tied_keys(src.agent_inventory, ["host"], "last_scan")
    return None if tied.isEmpty() else tied


def _agent_latest(src: Sources, columns: tuple[str, ...]) -> DataFrame:
    sequence = [c for c in ("seq", "seq2") if c in src.agent_inventory.columns]
    known = [c for c in AGENT_COLUMNS.values() if c in src.agent_inventory.columns]
    raw = src.agent_inventory.select(*dict.fromkeys(["host", "last_scan", *sequence, *known]))
    wanted = list(dict.fromkeys(AGENT_COLUMNS[c] for c in columns))
    if set(known) <= {*wanted, "host", "last_scan"}:
        latest = latest_per_key(raw, ["host"], "last_scan")
    else:
        latest = latest_narrow(raw, ["host"], "last_scan", wanted, src.known("agent_ties", lambda: _agent_ties(src)))
    user = F.upper(key_part("top_user", "-", 1))
    derived = {
        "top_user": user,
        "top_user_or_excluded": account_or_excluded(user),
        "is_virtual": F.coalesce(F.col("host").contains("-"), F.lit(False)),
        "mac_list": joined_list("macs"),
    }
    return latest.select("host", *[derived.get(c, F.col(c)).alias(c) for c in columns])


def unit_by_id(org: DataFrame) -> DataFrame:
    """One ``um`` per directory id (the smallest of an id listed several times)."""
    return org.groupBy("id").agg(F.min("um").alias("top_um")).withColumnRenamed("id", "um_id")


def agent_latest_um(src: Sources, org: DataFrame) -> DataFrame:
    """Latest agent record per host with its top user's ``um``; the id compares case-sensitively."""
    agent = agent_latest(src)
    units = unit_by_id(org)
    return agent.join(units, agent.top_user == units.um_id, "left").drop("um_id")


def directory_latest(src: Sources) -> DataFrame:
    """OS of the latest logon per directory computer."""
    latest = latest_per_key(src.directory_computer, ["computer"], "last_logon")
    return latest.select("computer", F.col("os").alias("directory_os"))


def scans_by_host(src: Sources, as_of: AsOf) -> DataFrame:
    """Scan rows per host: all, within the freshness threshold, within the 30-day window."""
    age = day_age("lastscan", as_of)

    def build() -> DataFrame:
        return src.last_seen.groupBy(F.col("hostname").alias("scan_host")).agg(
            F.max("lastscan").alias("lastscan"),
            F.count_if(age < fv.FRESH_DAYS).alias("fresh_scans"),
            F.count_if(age < fv.WINDOW_DAYS).alias("window_scans"),
        )

    return src.block(f"scans_{as_of.day}", build)


def models_by_tag(src: Sources) -> DataFrame:
    """One model number per tag."""
    return src.asset_model.groupBy(F.col("tag").alias("model_tag")).agg(F.min("model_number").alias("model_number"))


@dataclass(frozen=True, order=True)
class Selection:
    """Register records to choose from: with a known model, scanned in the 30-day window."""

    model: bool = False
    window: bool = False

    @property
    def label(self) -> str:
        return f"model={self.model} window={self.window}"

    def flag(self) -> Column:
        return F.col(f"`{self.label}`")

    def condition(self) -> Column:
        chosen = F.lit(True)
        if self.model:
            chosen = chosen & F.col("model_tag").isNotNull()
        if self.window:
            chosen = chosen & (F.coalesce("window_scans", F.lit(0)) > 0)
        return chosen


def latest_by_selection(
    src: Sources, as_of: AsOf, columns: list[str], selections: list[Selection], with_scan: bool = False
) -> DataFrame:
    """Register records that are the latest of their normalised tag in a selection, with a flag per selection.

    Scan and model belong to the raw tag. Where they are needed, records are first reduced to
    one per raw tag: the joins then meet each tag once however often it was copied, and reuse
    that partitioning. A normalised tag then has a row per spelling, and all selections share
    one order of these. Ties are broken by all register columns, whichever are asked for.
    """
    sequence = [c for c in ("seq", "seq2") if c in src.assets.columns]
    known = [c for c in REGISTER_COLUMNS if c in src.assets.columns]
    rows = src.assets.select(*dict.fromkeys(["tag", "updated_on", *known, *columns, *sequence]))
    ties = tie_break(rows, exclude=["updated_on"])
    of_tag = []
    models, windows = [s.model for s in selections], [s.window for s in selections]
    with_scan = with_scan or any(windows)
    if any(models) or with_scan:
        rows = latest_per_key(rows, ["tag"], "updated_on", ties)
    if any(models):
        known = models_by_tag(src)
        rows = rows.join(known, rows.tag == known.model_tag, "inner" if all(models) else "left")
        of_tag.append("model_number")
    if with_scan:
        scans = scans_by_host(src, as_of)
        if all(windows):
            rows = rows.join(scans.filter("window_scans > 0"), rows.tag == scans.scan_host, "inner")
        else:
            rows = rows.join(scans, rows.tag == scans.scan_host, "left")
        of_tag.append("lastscan")
    rows = rows.withColumn("tag_key", norm_key("tag"))
    payload = list(dict.fromkeys(["tag", *columns, *of_tag]))
    if not (any(models) or with_scan):  # one selection, of every record
        latest = latest_per_key(rows, ["tag_key"], "updated_on", ties)
        return latest.select("tag_key", *payload, F.lit(True).alias(selections[0].label))
    order = [F.desc_nulls_first("updated_on"), *[F.asc(c) for c in [*ties, *of_tag]]]
    so_far = Window.partitionBy("tag_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = [s.condition() & (F.count_if(s.condition()).over(so_far) == 1) for s in selections]
    flagged = rows.select("tag_key", *payload, *[c.alias(s.label) for c, s in zip(first, selections, strict=True)])
    return flagged.filter(reduce(Column.__or__, [s.flag() for s in selections]))


def per_selection(rows: DataFrame, selections: list[Selection]) -> DataFrame:
    """The rows of ``latest_by_selection`` once for each selection they are the latest of."""
    others = [c for c in rows.columns if c not in {s.label for s in selections}]
    if len(selections) == 1:
        return rows.filter(selections[0].flag()).select(*others, F.lit(selections[0].label).alias("selection"))
    entries = [F.when(s.flag(), F.lit(s.label)) for s in selections]
    return rows.select(*others, F.explode(F.array(*entries)).alias("selection")).filter(F.col("selection").isNotNull())


def asset_latest(
    src: Sources, as_of: AsOf, columns: list[str], selection: Selection = Selection(), with_scan: bool = False
) -> DataFrame:
    """Latest register record per normalised tag among the selected ones."""
    latest = latest_by_selection(src, as_of, columns, [selection], with_scan)
    return per_selection(latest, [selection]).drop("selection")
