"""Sharding by extendible hashing: only a bucket over the byte limit splits, on another bit of its rows' hash.

A row's hash is the first 60 bits of the MD5 of its key. Bytes are summed by hash prefix, a few bits longer than the
total asks for, and rolled up to every shorter prefix; a row's bucket is the shortest prefix of its hash that fits the
limit, which is what splitting buckets one bit at a time leads to. Prefixes that do not fit even so are looked at
again with more bits, and with them only their rows. The directory is the table of the longest prefixes with the depth
of their bucket; rows find their shard by joining it.

Rows that all bits cannot separate (one key many times) are dealt to overflow pages: salted by row, then cut by
running bytes, so that no task gets all of them. A row that alone exceeds the limit is a shard of its own and does not
fit.

Defined cases: a null text has no bytes, a null key is the empty string; no rows, no shards.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import Scratch

LIMIT_BYTES = 8 << 20
HASH_BITS = 60
#: Bits beyond those that equal shares would need.
MORE_BITS = 3


def assign(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = LIMIT_BYTES,
    hash_bits: int = HASH_BITS,
) -> DataFrame:
    """For every row: doc_id, n_bytes, shard (prefix bits, and page where there are some), shard_bytes, fits."""
    scratch = Scratch(docs.sparkSession, "shards")
    key = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    hashed = F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)).cast("long").alias("n_bytes"),
        F.shiftright(hashed, HASH_BITS - hash_bits).alias("hash"),
        F.monotonically_increasing_id().alias("row"),
    )
    rest = scratch.keep(rows, "rows")
    done: list[DataFrame] = []
    bits, turn = 0, 0
    while True:
        total, most = rest.agg(F.sum("n_bytes"), F.count("*")).first()
        if not most:
            break
        shares = math.ceil(math.log2(max(1, (total or 0) / limit)))
        bits = min(hash_bits, max(bits + MORE_BITS, shares + MORE_BITS))
        directory = scratch.keep(_directory(rest, bits, hash_bits, limit), f"directory{turn}")
        prefix = F.shiftright("hash", hash_bits - bits).alias("entry")
        found = rest.select("*", prefix).join(directory, "entry")
        done.append(
            found.where("depth is not null").select("doc_id", "n_bytes", _bits("entry", bits), "shard_bytes")
        )
        rest = found.where("depth is null").select("doc_id", "n_bytes", "hash", "row")
        if bits == hash_bits:
            done.append(_pages(rest, hash_bits, limit))
            break
        turn += 1
        rest = scratch.keep(rest, f"rest{turn}")
    if not done:
        done = [rows.select("doc_id", "n_bytes", F.lit("").alias("shard"), F.lit(0).cast("long").alias("shard_bytes"))]
    return reduce(DataFrame.unionByName, done).withColumn("fits", F.col("shard_bytes") <= limit)


def _directory(rows: DataFrame, bits: int, hash_bits: int, limit: int) -> DataFrame:
    """entry (a prefix of ``bits``) with the depth and bytes of its bucket, null where none fits."""
    entries = rows.groupBy(F.shiftright("hash", hash_bits - bits).alias("entry")).agg(F.sum("n_bytes").alias("n"))
    depth = F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("depth")
    every = entries.select("entry", "n", depth).withColumn("prefix", F.expr(f"shiftright(entry, {bits} - depth)"))
    buckets = every.groupBy("depth", "prefix").agg(F.sum("n").alias("bucket_bytes")).where(F.col("bucket_bytes") <= limit)
    fits = every.join(buckets, ["depth", "prefix"]).groupBy("entry")
    found = fits.agg(F.min(F.struct("depth", "bucket_bytes")).alias("b"))
    return entries.join(found, "entry", "left").select(
        "entry", F.col("b.depth").alias("depth"), F.col("b.bucket_bytes").alias("shard_bytes")
    )


def _bits(entry: str, bits: int) -> Column:
    """The bucket's prefix as a string of bits, empty for the bucket of all rows."""
    padded = F.lpad(F.conv(F.col(entry).cast("string"), 10, 2), max(1, bits), "0")
    return F.substring(padded, F.lit(1), F.col("depth")).alias("shard")


def _pages(rows: DataFrame, hash_bits: int, limit: int) -> DataFrame:
    """Rows of hashes that are alike in every bit, on pages that fit."""
    groups = rows.groupBy("hash").agg(F.sum("n_bytes").alias("total"), F.count("*").alias("n"))
    salts = F.greatest(F.ceil(F.col("total") / limit), F.ceil(F.col("n") / 100_000))
    rows = rows.join(groups, "hash").withColumn("salt", F.pmod(F.xxhash64("row"), salts))
    own = F.col("n_bytes") > limit // 2
    order = W.partitionBy("hash", "salt", own).orderBy("row").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n_bytes").over(order), F.lit(0))
    page = F.when(own, F.concat(F.lit("row"), "row")).otherwise(
        F.concat_ws("-", "salt", F.floor(before / F.lit(max(1, limit // 2))).cast("string"))
    )
    shard = F.concat(F.lpad(F.conv(F.col("hash").cast("string"), 10, 2), hash_bits, "0"), F.lit("/"), page)
    rows = rows.select("doc_id", "n_bytes", shard.alias("shard"))
    sizes = rows.groupBy("shard").agg(F.sum("n_bytes").alias("shard_bytes"))
    return rows.join(sizes, "shard").select("doc_id", "n_bytes", "shard", "shard_bytes")
