"""Rows of window runs, which the two operators on repeated windows share.

A run is a stretch of neighbouring windows of one text that share an anchor, see ``arrays.anchored_runs``. Its row has
the anchor's hash (``gram``), a digest of all that its windows cover (``body``), the text's key, the first window
(``at``), the number of windows (``n``), the distance from the first window to the anchor (``lead``), and, where the
same run stands in the text again, the other places (``more``, int32).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import Texts, anchored_runs, merged, record_batch, text_chunks

#: A text without id has this key; it is no smaller than any other.
NO_ID = (1 << 63) - 1

RUN_SCHEMA = "gram long, body long, k1 long, k2 binary, at int, n int, lead int, times int, more binary"
_RUNS = pa.schema(
    [("gram", pa.int64()), ("body", pa.int64()), ("k1", pa.int64()), ("k2", pa.binary()), ("at", pa.int32())]
    + [("n", pa.int32()), ("lead", pa.int32()), ("times", pa.int32()), ("more", pa.binary())]
)


def keyed(docs: DataFrame, id_col: str, text_col: str, all_columns: bool = False) -> DataFrame:
    """doc_id, text, and as key the id with a digest of 128 bits of the text: rows of one id may differ in text.

    A null text has the empty digest, so it is not taken for an empty one.

    With ``all_columns``, the columns of ``docs`` as the struct ``row``, too.
    """
    row = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if all_columns else []
    doc_id = F.col(f"`{id_col}`").cast("long").alias("doc_id")
    texts = docs.select(doc_id, F.col(f"`{text_col}`").alias("text"), *row)
    key = (F.coalesce("doc_id", F.lit(NO_ID)).alias("k1"), F.coalesce(F.unhex(F.md5("text")), F.lit(b"")).alias("k2"))
    return texts.select(*key, *texts.columns)


def digest64(data: bytes) -> int:
    return int.from_bytes(blake2b(data, digest_size=8).digest(), "little", signed=True)


def run_rows(
    batches: Iterable[pa.RecordBatch],
    window: int,
    gram: int,
    items: Callable[[Texts], tuple[np.ndarray, np.ndarray, Callable[[int, int], bytes]]],
) -> Iterator[pa.RecordBatch]:
    """Run rows of the texts.

    ``items`` gives for some texts the hash of each gram, the texts' offsets in items, and a function from an item's
    start and end to bytes that determine the items between.
    """
    for texts in text_chunks(batches):
        hashes, offsets, between = items(texts)
        if offsets[-1] < window:
            continue
        runs = anchored_runs(hashes, offsets, window, gram)
        if not len(runs.at):
            continue
        ends = (runs.at + runs.count + window - 1).tolist()
        body = np.array([digest64(between(a, b)) for a, b in zip(runs.at.tolist(), ends, strict=True)], dtype=np.int64)
        grams = hashes[runs.anchor].view(np.int64)
        order = np.lexsort((runs.at, body, grams, runs.text))
        same = (np.diff(runs.text[order]) == 0) & (np.diff(grams[order]) == 0) & (np.diff(body[order]) == 0)
        head = np.flatnonzero(np.append(True, ~same))
        times = np.diff(np.append(head, len(order)))
        first, places = order[head], (runs.at - offsets[runs.text]).astype(np.int32)
        more = [
            places[order[h + 1 : h + t]].tobytes() if t > 1 else None
            for h, t in zip(head.tolist(), times.tolist(), strict=True)
        ]
        text = runs.text[first]
        yield record_batch(
            _RUNS,
            [
                grams[first],
                body[first],
                texts.column("k1")[text],
                texts.rows.column(texts.rows.schema.get_field_index("k2")).take(pa.array(text)),
                places[first],
                runs.count[first].astype(np.int32),
                (runs.anchor[first] - runs.at[first]).astype(np.int32),
                times.astype(np.int32),
                pa.array(more, type=pa.binary()),
            ],
        )


#: Run groups with more different bodies than a task compares in some 50 MB are compared through a shuffle of their
#: windows instead.
GROUP_BODIES = 8192


def bodies_of(
    bodies: DataFrame, docs: DataFrame, pack: Callable[[Texts], Callable[[int, int, int], bytes]], window: int
) -> DataFrame:
    """The items of each run in ``bodies`` (k1, k2, at, n, ...), as bytes in the column ``data``.

    Texts are read once: a text's runs travel to it as one list. ``pack`` gives for some texts a function from a
    text's index and a start and end in items to bytes.
    """
    rest = [c for c in bodies.columns if c not in ("k1", "k2", "at")]
    asked = bodies.groupBy("k1", "k2").agg(F.collect_list(F.struct("at", *rest)).alias("asked"))
    joined = docs.select("k1", "k2", "text").join(asked, ["k1", "k2"]).select("text", "asked")
    schema = bodies.select(*rest).schema.add("data", "binary")
    fields = pa.schema(
        [(f.name, pa.int64() if f.dataType.typeName() == "long" else pa.int32()) for f in schema.fields[:-1]]
        + [("data", pa.binary())]
    )

    def read(batches):
        for texts in text_chunks(batches):
            between = pack(texts)
            asked = texts.rows.column(0)
            runs = asked.flatten()
            text = np.repeat(np.arange(len(texts)), asked.value_lengths().to_numpy(zero_copy_only=False))
            at, n = (runs.field(name).to_numpy(zero_copy_only=False) for name in ("at", "n"))
            data = [
                between(t, a, a + k + window - 1) for t, a, k in zip(text.tolist(), at.tolist(), n.tolist(), strict=True)
            ]
            yield record_batch(fields, [*(runs.field(c) for c in rest), pa.array(data, type=pa.binary())])

    return joined.mapInArrow(read, schema)


def whole_groups(batches: Iterable[pa.RecordBatch], by: str = "gram") -> Iterator[pa.RecordBatch]:
    """The rows, which come sorted by ``by``, in batches that split no group."""
    rest = None
    for batch in batches:
        if rest is not None:
            batch = pa.concat_batches([rest, batch])
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(by)).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield batch.slice(0, cut)
        rest = batch.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest


@dataclass
class Windows:
    """All windows of some runs: the run of each, its place in the run, and its first item among all items."""

    run: np.ndarray
    place: np.ndarray
    start: np.ndarray


def windows_of(n: np.ndarray, window: int) -> Windows:
    """Windows of runs whose items stand one after another."""
    first = np.concatenate([[0], np.cumsum(n + window - 1)])[:-1]
    run = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    return Windows(run, place, first[run] + place)


def cuts_of(run: np.ndarray, place: np.ndarray, window: int) -> dict[int, bytes]:
    """For each run, the union of its windows given, as int32 pairs of start and end relative to the run."""
    out = {}
    order = np.lexsort((place, run))
    run, place = run[order], place[order]
    head = np.flatnonzero(np.append(True, run[1:] != run[:-1])) if len(run) else []
    for a, b in zip(head, np.append(head[1:], len(run)), strict=True):
        start, end = merged(place[a:b], place[a:b] + window)
        out[int(run[a])] = np.column_stack([start, end]).astype(np.int32).tobytes()
    return out


CUT_SCHEMA = "gram long, body long, cuts binary"
_CUTS = pa.schema([("gram", pa.int64()), ("body", pa.int64()), ("cuts", pa.binary())])


def cut_batch(gram: np.ndarray, body: np.ndarray, cuts: dict[int, bytes]) -> pa.RecordBatch:
    which = np.fromiter(cuts, dtype=np.int64, count=len(cuts))
    return record_batch(_CUTS, [gram[which], body[which], pa.array(list(cuts.values()), type=pa.binary())])


def cuts_from_windows(found: DataFrame, window: int) -> DataFrame:
    """Rows (gram, body, place) of single windows as one row per run."""

    def read(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            places = batch.column(2)
            run = np.repeat(np.arange(batch.num_rows), places.value_lengths().to_numpy(zero_copy_only=False))
            cuts = cuts_of(run, places.flatten().to_numpy().astype(np.int64), window)
            yield cut_batch(batch.column(0).to_numpy(), batch.column(1).to_numpy(), cuts)

    return found.groupBy("gram", "body").agg(F.collect_set("place").alias("places")).mapInArrow(read, CUT_SCHEMA)


def with_spans(docs: DataFrame, cuts: DataFrame) -> DataFrame:
    """Every row of ``docs`` with the list of its rows in ``cuts`` (k1, k2, at, n, more, cuts).

    Copies of a row of docs have one key and bring the same cuts, which each gets once.
    """
    spans = cuts.groupBy("k1", "k2").agg(F.collect_set(F.struct("at", "n", "more", "cuts")).alias("spans"))
    return docs.join(spans, ["k1", "k2"], "left")


def removed(spans: pa.ListArray, window: int, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal stretches that the texts' spans cover: text, and start and end in items of all texts."""
    text = np.repeat(
        np.arange(len(spans)), np.nan_to_num(spans.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    )
    rows = spans.flatten()
    at, n = (rows.field(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in ("at", "n"))
    more, cuts = rows.field("more"), rows.field("cuts")
    plain = more.is_null().to_numpy(zero_copy_only=False) & cuts.is_null().to_numpy(zero_copy_only=False)
    texts, starts, ends = [text[plain]], [at[plain]], [at[plain] + n[plain] + window - 1]
    for i in np.flatnonzero(~plain).tolist():
        places, pairs = at[i : i + 1], np.array([[0, n[i] + window - 1]])
        if more[i].is_valid:
            places = np.append(places, np.frombuffer(more[i].as_py(), dtype=np.int32))
        if cuts[i].is_valid:
            pairs = np.frombuffer(cuts[i].as_py(), dtype=np.int32).reshape(-1, 2)
        starts.append((places[:, None] + pairs[:, 0]).ravel())
        ends.append((places[:, None] + pairs[:, 1]).ravel())
        texts.append(np.full(len(starts[-1]), text[i]))
    text = np.concatenate(texts)
    shift = offsets[text] + text  # a gap of one between texts keeps their stretches apart
    start, end = merged(np.concatenate(starts) + shift, np.concatenate(ends) + shift)
    text = np.searchsorted(offsets[:-1] + np.arange(len(offsets) - 1), start, side="right") - 1
    return text, start - text, end - text


def covered(start: np.ndarray, end: np.ndarray, total: int) -> np.ndarray:
    """A flag for each item that one of the disjoint stretches covers."""
    marks = np.zeros(total + 1, dtype=np.int8)
    marks[start] += 1
    marks[end] -= 1
    return np.cumsum(marks[:-1], dtype=np.int8).astype(bool)
