"""One owner and one tag hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetgauge.operators.dedupe import latest_narrow, latest_per_key, tied_keys
from fleetgauge.operators.skew import heavy_keys
from fleetgauge.plans.registry import BY_NAME, compute
from fleetgauge.session import JOB_SETTINGS, settings
from fleetgauge.sources.fixtures import AS_OF
from fleetgauge.sources.tables import Sources

SMALL = {
    **JOB_SETTINGS,
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}


def inventory(spark, n=900_000):
    third = F.col("id") % 3 == 0
    people = spark.range(2_000).select(
        F.concat(F.lit("P"), "id").alias("id"),
        *[F.concat(F.lit("x ("), F.col("id") % 50, F.lit(")")).alias(c) for c in ("direction", "division", "regroupement_unite", "um", "dum", "code_moa")],
    )
    assets = spark.range(0, n, 1, 8).select(
        F.concat(F.lit("WS"), "id").alias("tag"),
        F.when(third, F.lit("P1")).when(F.col("id") % 3 == 1, F.concat(F.lit("P"), F.col("id") % 2_000)).alias("owner_id"),
        F.lit("RLE").alias("network"),
    )
    last_seen = assets.select(F.col("tag").alias("hostname"), F.lit("2001-11-01 00:00:00").cast("timestamp_ntz").alias("lastscan"))
    frames = {"people": people, "departments": people.limit(0), "assets": assets, "last_seen": last_seen}
    return Sources.from_frames(spark, frames), n


def test_hot_owner_is_split_and_missing_owners_are_spread(spark):
    with settings(spark, SMALL):
        src, n = inventory(spark)
        df = compute(src, AS_OF, [BY_NAME["kpi_assets"]])
        got = {r.maille: r.valeur for r in df.collect()}
        plan = df._jdf.queryExecution().executedPlan().toString()
    assert sum(got.values()) == n
    assert got["/////"] == n / 3
    assert got["1/1/1/1/1/1"] >= n / 3
    assert "skew=true" in plan


def test_sums_join_one_row_per_owner(spark):
    """What meets the directories has been summed up per owner."""
    with settings(spark, SMALL):
        src, _ = inventory(spark, 3_000)
        support = src.assets.select("tag", F.col("owner_id"), F.lit("2030-01-01").cast("date").alias("support_end"))
        src = Sources.from_frames(spark, {n: src[n] for n in ("people", "departments", "last_seen")} | {"asset_support": support})
        df = compute(src, AS_OF, [BY_NAME["support_all"]])
        assert sum(r.valeur for r in df.collect()) == 3_000
        plan = df._jdf.queryExecution().optimizedPlan().toString()
    last_join = plan.index("Join LeftOuter")
    assert "Aggregate [owner_id" in plan[last_join:]


def test_a_campaign_of_the_whole_fleet_is_spread(spark):
    """Hosts are reduced by host and split by a second key before campaigns are attached to them."""
    with settings(spark, SMALL):
        src, n = inventory(spark, 60_000)
        hosts = src.assets.select(F.col("tag").alias("host"), F.right(F.concat("tag", F.lit("G2")), F.lit(2)).alias("grp"), F.lit("T").alias("type"), F.lit("P").alias("kind"), F.lit(3).alias("state"))
        start = F.date_sub(AS_OF.today, 42).alias("start_date")
        campaigns = spark.range(1).select(F.concat(F.lit("G"), F.col("id") + 2).alias("grp"), F.lit("T").alias("type"), F.lit("P").alias("kind"), start)
        register = src.assets.select("tag", F.coalesce("owner_id", F.lit("P2")).alias("owner_id"), F.lit(None).cast("string").alias("dept_id"), "network")
        frames = {t: src[t] for t in ("people", "departments", "last_seen")}
        src = Sources.from_frames(spark, frames | {"campaign_hosts": hosts, "campaigns": campaigns, "assets_os": register})
        df = compute(src, AS_OF, [BY_NAME["patch_success"]])
        assert sum(r.valeur for r in df.collect()) == n
        plan = df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(host" in plan
    keys = [line for line in plan.splitlines() if "hashpartitioning(grp" in line]
    assert keys and all("part" in line for line in keys)


def test_sql_kpis_leave_the_session_as_it_was(spark):
    from fleetgauge.sources.sql_kpis import run_sql

    spark.range(7).createOrReplaceTempView("people")
    try:
        src, _ = inventory(spark, 30)
        df = run_sql(src, "SELECT count(*) AS n FROM people JOIN assets ON people.id = owner_id", AS_OF)
        assert spark.table("people").count() == 7
        assert not spark.catalog.tableExists("assets")
        assert df.first().n > 0
    finally:
        spark.catalog.dropTempView("people")


def test_heavy_keys_are_measured(spark):
    """Only what holds many rows is split, in proportion; keys may be null; the join is the plain one."""
    third = F.col("id") % 3 == 0
    rows = spark.range(30_000).select(
        "id",
        F.when(third, "hot").when(F.col("id") % 30 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 5_000)).alias("a"),
        F.when(third, 1).otherwise(F.col("id") % 7).alias("b"),
    )
    entries = rows.select("a", "b").distinct().withColumn("label", F.concat_ws("-", "a", "b"))
    heavy = heavy_keys(rows, ["a", "b"], spread=120)
    assert max(heavy.parts.values()) == 40 and len(heavy.parts) == 1
    repeated = heavy.repeated(entries)
    assert repeated.count() == entries.count() + 39
    split = heavy.split(rows, ["id"])
    assert split.filter("a = 'hot'").select("part").distinct().count() == 40
    assert split.filter("a <> 'hot' OR a IS NULL").select("part").distinct().collect()[0].part == 0
    on = lambda l, r, *more: [l.a.eqNullSafe(r.a), l.b == r.b, *more]
    got = split.join(repeated, on(split, repeated, split.part == repeated.part)).select("id", "label")
    wanted = rows.join(entries, on(rows, entries)).select("id", "label")
    assert got.count() == wanted.count() == 30_000 and got.exceptAll(wanted).isEmpty()
    nothing = heavy_keys(rows.limit(0), ["a", "b"])
    assert nothing.parts == {} and nothing.repeated(entries).count() == entries.count()


def test_latest_rows_are_found_without_the_columns_that_break_ties(spark):
    """The same rows as by all columns, ties and null times and keys included; only tied keys are read in full."""
    data = [(k, None if i % 5 == 0 else i % 4, i % 2, f"x{(i * 7) % 11}", f"y{(i * 5) % 13}") for i in range(200) for k in ("a", None, f"k{i % 30}")]
    df = spark.createDataFrame(data, "k string, t int, seq int, x string, y string")
    df = df.withColumn("ts", F.make_date(F.lit(2024), F.lit(1), F.col("t") + 1)).drop("t")
    for frame in (df, df.drop("seq"), df.withColumn("seq", F.monotonically_increasing_id())):
        frame = spark.createDataFrame(frame.collect(), frame.schema)
        tied = tied_keys(frame, ["k"], "ts")
        assert tied.isEmpty() == (frame.schema["seq"].dataType.typeName() == "long" if "seq" in frame.columns else False)
        wanted = latest_per_key(frame, ["k"], "ts").select("k", "ts", "y")
        got = latest_narrow(frame, ["k"], "ts", ["y"], None if tied.isEmpty() else tied)
        assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect()))
