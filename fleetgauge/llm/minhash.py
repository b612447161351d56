"""MinHash near-dedup with fast similarity sketches.

A sketch has ``bands * rows`` coordinates. In each round every shingle is hashed to one coordinate and a value there; a
coordinate keeps the smallest value of the first round that reached it. After as many rounds as there are coordinates,
a further round for each puts all shingles into that one, so every coordinate is filled, and sketches of sets with any
number of shingles agree in a coordinate with the probability of their Jaccard similarity, concentrated like that of
independent ones. Bands of coordinates are bucket keys: at 32 bands of 4, a pair at 0.8 meets in no bucket with
probability 5e-8; at 26 bands of 5, a pair at 0.85 with 3e-7.

Texts of equal shingle sets are one class and enter once. First each class of a bucket is compared with the bucket's
first one, on the full sets; in a group of near copies that links nearly all. What is left to find are links between
other classes of a bucket that are not connected yet. Buckets of three or more classes and several components are
compared within themselves, and of buckets with the same classes one. So a class travels at most once for each of its
bands; only a bucket of more than ``BLOCK`` classes is dealt to cells of two blocks, in which a class travels once for
every block of the bucket. No pair is a row. In a cell, pairs of different components whose sketches agree in enough
coordinates (``MARGIN`` standard deviations below the similarity asked for: one true pair in ten million falls short)
are checked on the full sets, until they are connected. So the components are those of all links. Keys that many
classes share (a band, a root) are measured by a sketch and split; rows of one text are not, in the last join, which
carries no texts.

Defined cases: a null or blank text has no shingles, links with nothing and is kept; with fewer words than a shingle
the whole sequence is the one shingle; a row without id belongs to the component of the texts it links with and is
kept if none of them has an id; rows of one id and equal shingles share one result.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import HeavyKeys, heavy_keys
from .arrays import BYTE_VALUES, LOWER, SPACED_WORDS, Rolling, Texts, mix, record_batch, split_words, text_chunks
from .components import components
from .scratch import Scratch
from .windows import keyed, whole_groups

SHINGLE = 5
SIMILARITY = 80
BANDS = 32
ROWS = 4
BLOCK = 1024
MARGIN = 5.5
#: Pairs checked before a cell looks again at which are still unconnected.
PAIRS = 4096

SKETCH_SCHEMA = "k1 long, k2 binary, doc_id long, n long, node binary, bands array<long>"
_SKETCH = pa.schema(
    [("k1", pa.int64()), ("k2", pa.binary()), ("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.binary())]
    + [("bands", pa.list_(pa.int64()))]
)


def shingle_sets(texts: Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts' different shingles as ascending hashes, and where each text's start."""
    words = split_words(texts.data, texts.offsets, SPACED_WORDS)
    hashes = Rolling(BYTE_VALUES[LOWER[texts.data]]).slices(words.start, words.end)
    rolling = Rolling(hashes)
    count = np.diff(words.first)
    n = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    text = np.repeat(np.arange(len(texts)), n)
    start = words.first[text] + np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    shingles = rolling.slices(start, np.minimum(start + size, words.first[text + 1]))
    order = np.lexsort((shingles, text))
    shingles, text = shingles[order], text[order]
    new = np.append(True, (shingles[1:] != shingles[:-1]) | (text[1:] != text[:-1]))[: len(text)]
    shingles, text = shingles[new], text[new]
    return shingles, np.searchsorted(text, np.arange(len(texts) + 1))


def sketches(shingles: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """One sketch of ``size`` coordinates for each set; sets without shingles have none that means anything."""
    n = len(first) - 1
    empty = np.iinfo(np.uint64).max
    out = np.full(n * size, empty, dtype=np.uint64)
    owner = np.repeat(np.arange(n), np.diff(first))
    for turn in range(2 * size):
        hashed = mix(shingles ^ mix(np.array([turn + 1], dtype=np.uint64)))
        if turn < size:
            place = ((hashed >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        else:
            place = np.int64(turn - size)
        np.minimum.at(out, owner * size + place, np.uint64(turn << 54) | (mix(hashed) >> np.uint64(10)))
        open_ = (out.reshape(n, size) == empty).any(axis=1)
        stay = open_[owner]
        if not stay.any():
            break
        shingles, owner = shingles[stay], owner[stay]
    return out.reshape(n, size)


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), (len(sketch), bands)).copy()
    for row in range(rows):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) ^ sketch[:, row::rows][:, :bands])
    return keys.view(np.int64)


def _sketched(shingle: int, bands: int, rows: int):
    def run(batches):
        for texts in text_chunks(batches):
            shingles, first = shingle_sets(texts, shingle)
            sizes = np.diff(first)
            keys = band_keys(sketches(shingles, first, bands * rows), bands, rows)
            raw, some = shingles.tobytes(), sizes > 0
            nodes = [
                blake2b(raw[8 * a : 8 * b], digest_size=16).digest() if b > a else None
                for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)
            ]
            lists = pa.ListArray.from_arrays(
                np.append(0, np.cumsum(some * bands)).astype(np.int32), pa.array(keys[some].ravel())
            )
            yield record_batch(_SKETCH, [*texts.rows.columns, sizes, pa.array(nodes, type=pa.binary()), lists])

    return run


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    similarity: int = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """For every row: doc_id, n_shingles, component_id (smallest id reachable by links) and kept.

    Texts are linked if 100 times the intersection is at least ``similarity`` times the union of their shingle sets.
    """
    return _resolved(docs, id_col, text_col, shingle, similarity, bands, rows).drop("k1", "k2", "one")


def keep_first(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    similarity: int = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns; of rows of equal id and text, one.

    Of a component without ids, the row whose text has the smallest digest is kept.
    """
    found = _resolved(docs, id_col, text_col, shingle, similarity, bands, rows)
    nameless = F.col("component_id").isNull() & (F.col("k2") != F.col("one.k2"))
    gone = found.where(~F.col("kept") | nameless).select("k1", "k2").distinct()
    key = keyed(docs, id_col, text_col, all_columns=True)
    return key.dropDuplicates(["k1", "k2"]).join(gone, ["k1", "k2"], "left_anti").select("row.*")


def _resolved(docs, id_col, text_col, shingle, similarity, bands, rows) -> DataFrame:
    scratch = Scratch(docs.sparkSession, "minhash")
    texts = keyed(docs, id_col, text_col)
    all_rows = scratch.keep(
        texts.select("k1", "k2", "doc_id", "text").mapInArrow(_sketched(shingle, bands, rows), SKETCH_SCHEMA), "rows"
    )
    classes = scratch.keep(
        all_rows.where("n > 0")
        .groupBy("node")
        .agg(F.min(F.struct("k1", "k2")).alias("one"), F.first("n").alias("n"), F.first("bands").alias("bands")),
        "classes",
    )
    every = classes.select(F.explode("bands").alias("key"), "node", "n")
    hot = heavy_keys(every, ["key"])
    first = every.groupBy("key").agg(F.min(F.struct("node", "n")).alias("c"), F.count("*").alias("size"))
    pairs = _split_join(every, first.where("size > 1"), hot).where("node != c.node")
    pairs = pairs.select("node", "n", F.col("c.node").alias("other"), F.col("c.n").alias("m")).distinct()
    pairs = scratch.keep(pairs, "pairs")
    nodes = pairs.select("node").unionByName(pairs.select(F.col("other").alias("node"))).distinct()
    shared = classes.join(nodes, "node")
    sets = scratch.keep(_sets(texts, shared.select("node", "one.k1", "one.k2"), shingle), "sets")
    links = scratch.keep(_checked(pairs, sets, similarity), "links")
    found = scratch.keep(components(links, scratch, "first"), "components", free=False)
    more = _within_buckets(shared.select("node", "bands"), found, sets, hot, similarity, bands * rows)
    more = scratch.keep(more, "more")
    if not more.isEmpty():
        joined = found.where("node != component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        found = components(joined.unionByName(more), scratch, "last")
    named = (
        all_rows.where("n > 0")
        .groupBy("node")
        .agg(F.min("doc_id").alias("least"), F.min(F.struct("k1", "k2")).alias("one"))
        .join(found.withColumnRenamed("component", "root"), "node", "left")
    )
    named = named.select("node", F.coalesce("root", "node").alias("root"), "least", "one")
    named = scratch.keep(named, "named", free=False)
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"), F.min("one").alias("one"))
    named = _split_join(named.drop("one"), ids, heavy_keys(named, ["root"])).select("node", "component_id", "one")
    return all_rows.join(named, "node", "left").select(
        "k1",
        "k2",
        "doc_id",
        "one",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("component_id").eqNullSafe(F.col("doc_id"))).otherwise(True).alias("kept"),
    )


def _sets(texts: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """node and its shingles as bytes, for the classes in buckets."""
    schema = pa.schema([("node", pa.binary()), ("shingles", pa.binary())])

    def run(batches):
        for chunk in text_chunks(batches):
            shingles, first = shingle_sets(chunk, shingle)
            raw, cuts = shingles.tobytes(), (8 * first).tolist()
            sets = [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield record_batch(schema, [chunk.rows.column(0), pa.array(sets, type=pa.binary())])

    asked = texts.select("k1", "k2", "text").join(nodes, ["k1", "k2"]).select("node", "text")
    # a row of docs may stand twice
    return asked.mapInArrow(run, "node binary, shingles binary").dropDuplicates(["node"])


def _checked(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs (node, n, other, m) that are linked, as a and b."""
    pairs = pairs.where(100 * F.least("n", "m") >= similarity * F.greatest("n", "m"))
    left = sets.select("node", F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("other"), F.col("shingles").alias("y"))
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches):
        for batch in batches:
            linked = [
                _linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), similarity)
                for x, y in zip(batch.column(2), batch.column(3), strict=True)
            ]
            kept = pa.array(linked, type=pa.bool_())
            yield record_batch(schema, [batch.column(0).filter(kept), batch.column(1).filter(kept)])

    joined = pairs.join(left, "node").join(right, "other").select("node", "other", "x", "y")
    return joined.mapInArrow(run, "a binary, b binary")


def _linked(x: np.ndarray, y: np.ndarray, similarity: int) -> bool:
    """Whether two sets, as ascending hashes, are similar enough."""
    both = np.count_nonzero(y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x)
    return bool(100 * both >= similarity * (len(x) + len(y) - both))


def _split_join(rows: DataFrame, entries: DataFrame, heavy: HeavyKeys) -> DataFrame:
    """``rows`` with the entry of their key, of which there is one at most; rows of heavy keys are dealt by node."""
    if not heavy.parts:
        return rows.join(entries, list(heavy.keys))
    return heavy.split(rows, ["node"]).join(heavy.repeated(entries), [*heavy.keys, "part"]).drop("part")


def _open_buckets(members: DataFrame) -> DataFrame:
    """(key, blocks) of the buckets of ``members`` (key, node, component) that may hold links not seen yet.

    A pair was compared with the bucket's first, and members of one component need no link. Of buckets with the same
    members, told by two 64-bit sums of their digests and their number, the one of the least key.
    """
    which = F.xxhash64("component")
    buckets = members.groupBy("key").agg(
        F.count("*").alias("size"),
        F.min(which).alias("low"),
        F.max(which).alias("high"),
        F.bit_xor(F.xxhash64("node")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit("again"), "node")).alias("y"),
    )
    several = buckets.where("size > 2 and low != high")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")
    return several.groupBy("size", "x", "y").agg(F.min("key").alias("key")).select("key", blocks)


def _cells(shared: DataFrame, found: DataFrame, hot: HeavyKeys) -> DataFrame:
    """(cell, node, component, block): the classes of open buckets, in cells of at most two blocks."""
    members = shared.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    members = members.select(F.explode("bands").alias("key"), "node", "component")
    members = _split_join(members, _open_buckets(members), hot)
    members = members.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    at = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("at")
    cell = F.xxhash64("key", F.least("block", "at"), F.greatest("block", "at")).alias("cell")
    return members.select("key", "node", "component", "block", at).select(cell, "node", "component", "block")


def _within_buckets(
    shared: DataFrame, found: DataFrame, sets: DataFrame, hot: HeavyKeys, similarity: int, size: int
) -> DataFrame:
    """Links (a, b) between the components in each bucket, enough to connect what all would."""
    cells = _cells(shared, found, hot).join(sets, "node").repartition("cell").sortWithinPartitions("cell")
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches):
        for batch in whole_groups(batches, "cell"):
            cell = batch.column(0).to_numpy()
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(4)]
            first = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
            marks = sketches(np.concatenate(sets), first, size).astype(np.uint8)
            heads = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
            for lo, hi in zip(heads.tolist(), np.append(heads[1:], len(cell)).tolist(), strict=True):
                left, right = _links_in(batch.slice(lo, hi - lo), sets[lo:hi], marks[lo:hi], similarity)
                node = batch.column(1)
                ends = [node.take(pa.array([lo + i for i in side], pa.int64())) for side in (left, right)]
                yield record_batch(schema, ends)

    return cells.select("cell", "node", "component", "block", "shingles").mapInArrow(run, "a binary, b binary")


def _links_in(
    part: pa.RecordBatch, sets: list[np.ndarray], marks: np.ndarray, similarity: int
) -> tuple[list[int], list[int]]:
    """Links between members of a cell (cell, node, component, block) that connect components."""
    n, size = np.array([len(x) for x in sets]), marks.shape[1]
    block = part.column(3).to_numpy()
    several = block.min() != block.max()
    root = np.unique(np.array(part.column(2).to_pylist(), dtype=object), return_inverse=True)[1]
    share = similarity / 100
    least = size * (share - MARGIN * np.sqrt(share * (1 - share) / size))
    rows, columns = [], []
    for i in range(len(n)):
        later = slice(i + 1, None)
        good = (root[later] != root[i]) & (100 * np.minimum(n[later], n[i]) >= similarity * np.maximum(n[later], n[i]))
        if several:
            good &= block[later] != block[i]  # pairs of one block have a cell of their own
        j = np.flatnonzero(good) + i + 1
        j = j[(marks[j] == marks[i]).sum(axis=1) >= least]
        rows.append(np.full(len(j), i))
        columns.append(j)
    rows, columns = np.concatenate(rows), np.concatenate(columns)
    left, right = [], []
    while len(rows):
        for i, j in zip(rows[:PAIRS].tolist(), columns[:PAIRS].tolist(), strict=True):
            if root[i] != root[j] and _linked(sets[i], sets[j], similarity):
                left.append(i)
                right.append(j)
                root[root == root[j]] = root[i]
        rows, columns = rows[PAIRS:], columns[PAIRS:]
        still = root[rows] != root[columns]
        rows, columns = rows[still], columns[still]
    return left, right
