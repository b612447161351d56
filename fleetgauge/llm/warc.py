"""Content-addressed WARC archive: payload bytes once, exact record headers apart, records rebuilt by joins.

An archive is two tables. ``payloads`` has each different payload once, by its SHA-1 (base32, as WARC writes it) and,
since SHA-1 alone would not prove equality, its SHA-256. ``headers`` has every record's header as it stands in a WARC
file, with both digests. Of pages with one payload, the one of smallest id is the response that carries it; the others
are revisits that refer to it. Payloads below ``min_bytes`` are not shared: all of them are responses.

Rebuilding joins headers with payloads on both digests; both digests of what the join gives are compared with
the header's. What a record is and refers to is read from its header. Equal payloads are reduced before they are shuffled, and the join sees pages, not pairs of pages.

Defined cases: a null payload is empty; a null URL is left out of the header, and line breaks in one are escaped; a page without id comes after all others
and refers to a response without id only if no page of its payload has an id; rows that repeat the smallest id are all
responses.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch, free_shuffles

REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Header lines beside those of the standard, which allows for more.
PAGE_ID, REFERS_TO_PAGE, STRONG_DIGEST = "Page-ID", "Refers-To-Page-ID", "Payload-SHA256"
_DIGITS, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


@dataclass
class Archive:
    """The two tables of an archive."""

    headers: DataFrame
    payloads: DataFrame


def base32_sha1(data: Column) -> Column:
    """SHA-1 as 32 upper-case base32 digits: four for every five hexadecimal ones."""
    digest = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(digest, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*groups), _DIGITS, _BASE32)


def write(
    pages: DataFrame,
    scratch: Scratch,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = 0,
    date: dt.datetime | None = None,
) -> Archive:
    """Archive a record for every row of ``pages``, dated ``date`` (UTC), by default now."""
    date = date or dt.datetime.now(dt.UTC)
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit("")).cast("binary")
    pages = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"), payload.alias("payload")
    ).withColumns(
        {"sha1": base32_sha1(F.col("payload")), "sha256": F.sha2("payload", 256), "size": F.octet_length("payload")}
    )
    rows = pages.select("page_id", "url", "sha1", "sha256", "size")
    groups = rows.groupBy("sha1", "sha256").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
    small = F.col("size") < min_bytes
    first = F.col("page_id").eqNullSafe(F.col("first_id"))
    headers = rows.join(groups, ["sha1", "sha256"]).withColumn(
        "record_type", F.when(small | first, "response").otherwise("revisit")
    )
    headers = headers.withColumn("refers_to", F.when(F.col("record_type") == "revisit", F.col("first_id")))
    headers = scratch.keep(
        headers.select(
            "sha1", "sha256", "size", _header(date).alias("header")
        ),
        "headers",
    )
    once = pages.select("sha1", "sha256", "payload").groupBy("sha1", "sha256").agg(F.first("payload").alias("payload"))
    archive = Archive(headers, scratch.keep(once, "payloads"))
    del pages, rows, groups, once
    for _ in range(2):  # whoever reads the archive shuffles payloads again; those of the writing should be gone
        free_shuffles(scratch.spark, wait=0.7)
    return archive


def _record_id(page_id: Column, sha1: Column) -> Column:
    name = F.md5(F.concat_ws("/", page_id.cast("string"), sha1))
    parts = [F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _escaped(url: Column) -> Column:
    """A URL that stays on its line."""
    return F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _header(date: dt.datetime) -> Column:
    """A record's header lines, the empty line after them included."""
    revisit = F.col("record_type") == "revisit"
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value)
    length = F.when(revisit, F.lit(0)).otherwise(F.col("size")).cast("string")
    lines = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("sha1"))),
        line("WARC-Date", F.lit(date.strftime("%Y-%m-%dT%H:%M:%SZ"))),
        line("WARC-Target-URI", _escaped(F.col("url"))),  # concat_ws leaves out nulls
        line(PAGE_ID, F.col("page_id").cast("string")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        line(STRONG_DIGEST, F.col("sha256")),
        F.when(revisit, line("WARC-Profile", F.lit(REVISIT_PROFILE))),
        F.when(revisit, line("WARC-Refers-To", _record_id(F.col("refers_to"), F.col("sha1")))),
        F.when(revisit, line(REFERS_TO_PAGE, F.col("refers_to").cast("string"))),
        line("Content-Length", length),
    )
    return F.concat(lines, F.lit("\r\n\r\n")).cast("binary")


def _field(name: str) -> Column:
    """The value of a header line, null without one."""
    value = F.regexp_extract(F.col("header").cast("string"), f"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.nullif(value, F.lit(""))


def read(archive: Archive) -> DataFrame:
    """Every record: page_id, header, record_type, refers_to, payload (also of revisits), and whether it verifies.

    Ids and type are those that the header states. A record verifies if the payload that its digests led to has them,
    and the size, and if they are the header's.
    """
    records = archive.headers.join(archive.payloads, ["sha1", "sha256"])
    verified = (base32_sha1(F.col("payload")) == F.col("sha1")) & (F.octet_length("payload") == F.col("size"))
    verified &= F.sha2("payload", 256) == F.col("sha256")
    verified &= _field("WARC-Payload-Digest").eqNullSafe(F.concat(F.lit("sha1:"), "sha1"))
    verified &= _field(STRONG_DIGEST).eqNullSafe(F.col("sha256"))
    return records.select(
        _field(PAGE_ID).cast("long").alias("page_id"),
        "header",
        _field("WARC-Type").alias("record_type"),
        _field(REFERS_TO_PAGE).cast("long").alias("refers_to"),
        "sha1",
        "payload",
        verified.alias("verified"),
    )


def record_bytes() -> Column:
    """A record of ``read`` as it stands in a WARC file."""
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return F.concat("header", block, F.lit(b"\r\n\r\n"))
