"""Substring dedup: an anchored join of word windows with all earlier documents, in place of a Relative Lempel-Ziv parse.

The reference of a document are the documents with smaller ids. It is indexed in blocks: a block is the stretch of
words under a run of neighbouring windows that share an anchor (see ``arrays.anchored_runs``), and the index has for
each block, and for each window within it, the smallest document that holds it.

No document is parsed greedily from left to right, and there is no list of longest factors with their sources: such a
parse needs the whole reference in one place, and windows across its factor boundaries would have to be looked up
besides. Instead all windows are looked up: the whole block under a run if a smaller document has it, else its windows
among blocks with the same anchor. Blocks of neighbouring runs overlap by all but one word of a window, so every window
lies whole in a block. The windows found, joined where they overlap, are the duplicate spans; other words are literals.
Hence a word goes exactly if a window over it starts in a smaller document.

Blocks of one anchor are compared in the task that holds the anchor. An anchor with more than
``windows.GROUP_BODIES`` different blocks is compared through a shuffle of its single windows instead.

Defined cases: a null text has no words; a null id is larger than any other; rows of one id are one document, whose
repetitions stay; texts shorter than the window keep all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import BYTE_VALUES, SPACED_WORDS, Rolling, Texts, Words, record_batch, split_words, text_chunks
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

WINDOW = 50
GRAM = 16

RESULT_SCHEMA = "doc_id long, kept string, n_words long, n_removed long, factors array<struct<start:int,end:int>>"
_RESULT = pa.schema(
    [("doc_id", pa.int64()), ("kept", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64())]
    + [("factors", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]
)


def remove_copied(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    group_bodies: int = GROUP_BODIES,
) -> DataFrame:
    """Each text without the words of windows of ``window`` words that also start in a document of smaller id.

    Returns doc_id, kept (the words left, joined by a space), n_words, n_removed and factors (the duplicate spans, in
    words) for every row.
    """
    if not 0 < gram < window:
        raise ValueError("the gram must be shorter than the window")
    scratch = Scratch(docs.sparkSession, "reference-parse")
    texts = keyed(docs, id_col, text_col)

    runs = scratch.keep(
        texts.select("k1", "k2", "text").mapInArrow(lambda it: run_rows(it, window, gram, _grams(gram)), RUN_SCHEMA),
        "runs",
    )
    anchors = runs.groupBy("gram").agg(F.min("k1").alias("lo"), F.max("k1").alias("hi")).where("lo < hi")
    runs = scratch.keep(runs.join(anchors.select("gram"), "gram"), "shared")
    scratch.drop("runs")

    blocks = scratch.keep(
        runs.groupBy("gram", "body").agg(
            F.min(F.struct("k1", "k2", "at", "n")).alias("one"), F.max("k1").alias("hi"), F.min("k1").alias("lo")
        ),
        "blocks",
    )
    several = blocks.groupBy("gram").agg(F.count("*").alias("d"), F.min("lo").alias("least")).where("d > 1")
    unsure = blocks.join(several, "gram").select("one.k1", "one.k2", "one.at", "one.n", "gram", "body", "lo", "d")
    unsure = scratch.keep(bodies_of(unsure, texts, _words_between, window), "unsure")

    few = unsure.where(F.col("d") <= group_bodies).repartition("gram").sortWithinPartitions("gram", "body")
    many = unsure.where(F.col("d") > group_bodies).select("gram", "body", "lo", "n", "data")
    many = many.mapInArrow(
        lambda it: _window_rows(it, window), "gram long, body long, lo long, place int, phrase long"
    )
    index = many.groupBy("gram", "phrase").agg(F.min("lo").alias("least"))
    found = many.join(index, ["gram", "phrase"]).where("least < lo").select("gram", "body", "place")
    cuts = few.select("gram", "body", "lo", "n", "data").mapInArrow(lambda it: _factors(it, window), CUT_SCHEMA)
    cuts = cuts.unionByName(cuts_from_windows(found, window))
    index = blocks.select("gram", "body", "lo", "hi").join(cuts, ["gram", "body"], "left")
    index = index.where("lo < hi or cuts is not null").select("gram", "body", "lo", "cuts")
    spans = runs.join(index, ["gram", "body"]).where("k1 > lo or cuts is not null")
    whole = F.when(F.col("k1") == F.col("lo"), F.col("cuts"))
    spans = scratch.keep(spans.select("k1", "k2", "at", "n", "more", whole.alias("cuts")), "spans")
    scratch.drop("shared", "blocks", "unsure")
    return with_spans(texts, spans).select("doc_id", "text", "spans").mapInArrow(
        lambda it: _parse(it, window), RESULT_SCHEMA
    )


def _hashed(texts: Texts) -> tuple[Words, np.ndarray]:
    words = split_words(texts.data, texts.offsets, SPACED_WORDS)
    return words, Rolling(BYTE_VALUES[texts.data]).slices(words.start, words.end)


def _grams(gram: int):
    def items(texts: Texts):
        words, hashes = _hashed(texts)
        if len(hashes) < gram:
            return np.zeros(0, np.uint64), words.first, None
        raw = hashes.tobytes()
        return Rolling(hashes).fixed(gram), words.first, lambda a, b: raw[8 * a : 8 * b]

    return items


def _words_between(texts: Texts):
    words, hashes = _hashed(texts)
    raw, first = hashes.tobytes(), words.first.tolist()
    return lambda text, a, b: raw[8 * (first[text] + a) : 8 * (first[text] + b)]


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """gram, body, lo, n, and the word hashes of all rows one after another."""
    gram, body, lo, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
    return gram, body, lo, n.astype(np.int64), np.frombuffer(b"".join(batch.column(4).to_pylist()), dtype=np.uint64)


def _factors(batches, window: int):
    """For each block, the factors that other blocks of its anchor have in smaller documents."""
    for batch in whole_groups(batches):
        gram, body, lo, n, hashes = _columns(batch)
        places = windows_of(n, window)
        phrase = Rolling(hashes).fixed(window)[places.start] ^ gram[places.run].view(np.uint64)
        order = np.lexsort((lo[places.run], phrase))
        head = np.append(True, phrase[order][1:] != phrase[order][:-1])
        least = lo[places.run[order]][np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
        copied = order[least < lo[places.run[order]]]
        if len(copied):
            yield cut_batch(gram, body, cuts_of(places.run[copied], places.place[copied], window))


_WINDOW_ROWS = pa.schema(
    [("gram", pa.int64()), ("body", pa.int64()), ("lo", pa.int64()), ("place", pa.int32()), ("phrase", pa.int64())]
)


def _window_rows(batches, window: int):
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            gram, body, lo, n, hashes = _columns(batch.slice(at, 2000))
            places = windows_of(n, window)
            phrase = Rolling(hashes).fixed(window)[places.start].view(np.int64)
            run = places.run
            yield record_batch(_WINDOW_ROWS, [gram[run], body[run], lo[run], places.place.astype(np.int32), phrase])


def _parse(batches, window: int):
    """The texts' duplicate spans, and their literal words."""
    for texts in text_chunks(batches):
        words = split_words(texts.data, texts.offsets, SPACED_WORDS)
        text, start, end = removed(texts.rows.column(1), window, words.first)
        kept = ~covered(start, end, len(words.start))
        left = np.concatenate([[0], np.cumsum(kept)])[words.first]
        sizes = np.diff(words.first)
        factors = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(text, np.arange(len(texts) + 1)), type=pa.int32()),
            pa.StructArray.from_arrays(
                [pa.array((x - words.first[text]).astype(np.int32)) for x in (start, end)], ["start", "end"]
            ),
        )
        yield record_batch(
            _RESULT,
            [
                texts.rows.column(0),
                _joined(texts.data, words.start[kept], words.end[kept], left),
                sizes,
                sizes - np.diff(left),
                factors,
            ],
        )


def _joined(data: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray) -> pa.Array:
    """The words of each text, joined by a space."""
    size = end - start + 1  # a word and the space after it
    out_start = np.concatenate([[0], np.cumsum(size)])
    out = data[np.minimum(np.arange(out_start[-1]) + np.repeat(start - out_start[:-1], size), max(0, len(data) - 1))]
    out[out_start[1:] - 1] = 0x20
    last = first[1:][first[1:] > first[:-1]]
    keep = np.ones(len(out), dtype=bool)
    keep[out_start[last] - 1] = False
    offsets = out_start[first] - np.concatenate([[0], np.cumsum(first[1:] > first[:-1])])
    return pa.LargeStringArray.from_buffers(
        len(first) - 1, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(out[keep].tobytes())
    ).cast(pa.string())
