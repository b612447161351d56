"""Suffix-array dedup: byte strings of a fixed length that start at two places or more.

Only equality of suffixes through their first ``window`` bytes matters, so suffixes are ordered no deeper, by
most-significant-digit passes, and a suffix that is alone after a pass leaves:

1. The first digit is the suffix's anchor: the gram of ``gram`` bytes in the window that hashes lowest. Neighbouring
   suffixes mostly share it, so they travel as one run. Runs whose gram stands nowhere else leave.
2. Runs of one gram are told apart by a digest of all that they cover. In runs that occur twice, every suffix repeats.
3. Suffixes in the other runs of a gram are ordered by digits of ``window / 5`` bytes, five passes in the task that
   holds the gram. A gram with more than ``windows.GROUP_BODIES`` different runs would not fit a task for any input;
   its suffixes are shuffled by the digest of all their bytes instead.

The groups that are left are exactly the repeated windows; every byte in one goes.

Defined cases: a null text is empty; texts shorter than the window keep all; a row that stands twice is two texts, and
each repeats the other; a null id is an id of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .arrays import BYTE_VALUES, Rolling, Texts, record_batch, text_chunks
from .scratch import Scratch
from .windows import (
    CUT_SCHEMA,
    GROUP_BODIES,
    RUN_SCHEMA,
    bodies_of,
    covered,
    cut_batch,
    cuts_from_windows,
    cuts_of,
    keyed,
    removed,
    run_rows,
    whole_groups,
    windows_of,
    with_spans,
)

WINDOW = 200
GRAM = 64
DIGITS = 5

RESULT_SCHEMA = "doc_id long, kept binary, n_bytes long, n_removed long, spans array<struct<start:int,end:int>>"
_RESULT = pa.schema(
    [("doc_id", pa.int64()), ("kept", pa.binary()), ("n_bytes", pa.int64()), ("n_removed", pa.int64())]
    + [("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]
)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    whole_chars: bool = False,
    group_bodies: int = GROUP_BODIES,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Each text without the bytes of strings of ``window`` bytes that also start elsewhere.

    Returns doc_id, kept (the bytes left), n_bytes, n_removed and spans (maximal removed stretches) for every row.
    ``whole_chars`` keeps a character of which only a part is covered, so that what is left is valid text. ``carry``
    names columns that come along as the struct ``carried``.
    """
    if window % DIGITS or not 0 < gram < window:
        raise ValueError(f"window must be a multiple of {DIGITS} and longer than the gram")
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffix-repeats")
    texts = keyed(docs, id_col, text_col)

    runs = scratch.keep(
        texts.select("k1", "k2", "text").mapInArrow(lambda it: run_rows(it, window, gram, _grams(gram)), RUN_SCHEMA),
        "runs",
    )
    grams = runs.groupBy("gram").agg(F.sum("times").alias("total")).where("total > 1").select("gram")
    runs = scratch.keep(runs.join(grams, "gram"), "shared")
    scratch.drop("runs")

    bodies = scratch.keep(
        runs.groupBy("gram", "body").agg(
            F.sum("times").alias("c"), F.min(F.struct("k1", "k2", "at", "n", "lead")).alias("one")
        ),
        "bodies",
    )
    several = bodies.groupBy("gram").agg(F.count("*").alias("d")).where("d > 1")
    unsure = bodies.join(several, "gram").select("one.k1", "one.k2", "one.at", "one.n", "gram", "body", "c", "d")
    unsure = scratch.keep(bodies_of(unsure, texts, _bytes_between, window), "unsure")

    few = unsure.where(F.col("d") <= group_bodies).repartition("gram").sortWithinPartitions("gram", "body")
    many = unsure.where(F.col("d") > group_bodies).select("gram", "body", "c", "n", "data")
    many = many.mapInArrow(
        lambda it: _window_rows(it, window), "gram long, body long, c long, place int, suffix long"
    )
    again = (
        many.groupBy("gram", "suffix")
        .agg(F.max("c").alias("c_most"), F.min("body").alias("low"), F.max("body").alias("high"))
        .where("c_most > 1 or low != high")
        .select("gram", "suffix")
    )
    found = many.where("c = 1").join(again, ["gram", "suffix"]).select("gram", "body", "place")
    cuts = few.select("gram", "body", "c", "n", "data").mapInArrow(lambda it: _radix(it, window), CUT_SCHEMA)
    cuts = cuts.unionByName(cuts_from_windows(found, window))
    cuts = bodies.where("c > 1").select("gram", "body", F.lit(None).cast("binary").alias("cuts")).unionByName(cuts)
    spans = runs.join(cuts, ["gram", "body"]).select("k1", "k2", "at", "n", "more", "cuts")
    spans = scratch.keep(spans, "spans")
    scratch.drop("shared", "bodies", "unsure")
    every = keyed(docs, id_col, text_col, all_columns=True)
    carried = F.struct(*(F.col(f"row.`{c}`") for c in carry)).alias("carried") if carry else F.lit(None).alias("carried")
    every = with_spans(every.select("k1", "k2", "doc_id", "text", carried), spans)
    schema = StructType.fromDDL(RESULT_SCHEMA)
    if carry:
        schema.add(every.schema["carried"])
    columns = ["doc_id", "text", "spans", *(["carried"] if carry else [])]
    return every.select(*columns).mapInArrow(lambda it: _cut(it, window, whole_chars), schema)


def _grams(gram: int):
    def items(texts: Texts):
        raw = texts.data.tobytes()
        if len(raw) < gram:
            return np.zeros(0, np.uint64), texts.offsets, None
        return Rolling(BYTE_VALUES[texts.data]).fixed(gram), texts.offsets, lambda a, b: raw[a:b]

    return items


def _bytes_between(texts: Texts):
    raw, offsets = texts.data.tobytes(), texts.offsets.tolist()
    return lambda text, a, b: raw[offsets[text] + a : offsets[text] + b]


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """gram, body, c, n, and the bytes of all rows one after another."""
    gram, body, c, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
    return gram, body, c, n.astype(np.int64), np.frombuffer(b"".join(batch.column(4).to_pylist()), dtype=np.uint8)


def _radix(batches, window: int):
    """Cuts of the runs, of which those of a gram come together, by passes over the digits of their suffixes."""
    width = window // DIGITS
    for batch in whole_groups(batches):
        gram, body, c, n, data = _columns(batch)
        once = np.append(True, (gram[1:] != gram[:-1]) | (body[1:] != body[:-1]))  # a row of docs may stand twice
        suffixes = windows_of(n, window)
        live = np.flatnonzero(once[suffixes.run])
        digits = Rolling(BYTE_VALUES[data]).fixed(width)
        group = gram[suffixes.run[live]].view(np.uint64)
        for digit in range(DIGITS):
            key = group * np.uint64(0x9E3779B97F4A7C15) ^ digits[suffixes.start[live] + digit * width]
            _, group, size = np.unique(key, return_inverse=True, return_counts=True)
            stay = (size[group] > 1) | (c[suffixes.run[live]] > 1)
            live, group = live[stay], group[stay].astype(np.uint64)
        live = live[c[suffixes.run[live]] == 1]
        if len(live):
            yield cut_batch(gram, body, cuts_of(suffixes.run[live], suffixes.place[live], window))


_WINDOW_ROWS = pa.schema(
    [("gram", pa.int64()), ("body", pa.int64()), ("c", pa.int64()), ("place", pa.int32()), ("suffix", pa.int64())]
)


def _window_rows(batches, window: int):
    for batch in batches:
        for lo in range(0, batch.num_rows, 2000):
            gram, body, c, n, data = _columns(batch.slice(lo, 2000))
            suffixes = windows_of(n, window)
            whole = Rolling(BYTE_VALUES[data]).fixed(window)[suffixes.start].view(np.int64)
            run = suffixes.run
            yield record_batch(_WINDOW_ROWS, [gram[run], body[run], c[run], suffixes.place.astype(np.int32), whole])


def _cut(batches, window: int, whole_chars: bool):
    for texts in text_chunks(batches):
        offsets = texts.offsets
        text, start, end = removed(texts.rows.column(1), window, offsets)
        if whole_chars and len(start):
            start, end = _whole_chars(texts.data, start, end)
            text, start, end = (x[end > start] for x in (text, start, end))
        kept = ~covered(start, end, len(texts.data))
        left = np.concatenate([[0], np.cumsum(kept)])[offsets]
        sizes = np.diff(offsets)
        spans = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(text, np.arange(len(texts) + 1)), type=pa.int32()),
            pa.StructArray.from_arrays(
                [pa.array((x - offsets[text]).astype(np.int32)) for x in (start, end)], ["start", "end"]
            ),
        )
        out = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(),
            len(texts),
            [None, pa.py_buffer(left.astype(np.int64).tobytes()), pa.py_buffer(texts.data[kept].tobytes())],
        )
        rows = record_batch(_RESULT, [texts.rows.column(0), out.cast(pa.binary()), sizes, sizes - np.diff(left), spans])
        if texts.rows.num_columns > 2:
            rows = rows.append_column("carried", texts.rows.column(2))
        yield rows


def _whole_chars(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches without the characters of which only a part is in them."""
    inner = (data & 0xC0) == 0x80
    start, end = start.copy(), end.copy()
    for _ in range(3):
        start += (start < end) & inner[np.minimum(start, len(data) - 1)]
        end -= (end > start) & (end < len(data)) & inner[np.minimum(end, len(data) - 1)]
    return start, end
