"""Benchmark decontamination: exact phrases and proximity matches from a distributed positional inverted index.

The index is a written table. Its rows are blocks of neighbouring documents (about half a megabyte of text); a block has its
documents' ids and lengths and, for each term of the test items, the ascending list of places where the term stands.
Term frequencies over the whole corpus come from the index. A test window is looked up in a block from its rarest term
on: the list of places, less the term's offset in the window, gives candidate starts; the lists of the other terms,
rarer ones first, are intersected with it, each less its own offset, until all terms agree, which makes the match exact.
A window of which a block lacks a term costs nothing there.

A proximity match of an item: its ``NEAR_TERMS`` rarest different terms stand in one document within ``NEAR_SPAN``
words of the rarest of them. It is reported beside the exact matches and decides nothing.

Test items are taken in groups of at most ``GROUP_BYTES`` of text, so that what travels to the tasks is bounded; each
group has an index of its own terms.

Defined cases: a null text has no words; an item without words or without id matches nothing; an item of fewer words
than a window is one window; items that stand twice count once; a document without words is not contaminated.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import ALNUM_WORDS, BYTE_VALUES, LOWER, Rolling, record_batch, split_words, text_chunks
from .scratch import Scratch

WINDOW = 13
NEAR_TERMS = 3
NEAR_SPAN = 25
GROUP_BYTES = 4 << 20

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

INDEX_SCHEMA = "doc_ids array<long>, keys array<long>, firsts array<int>, terms array<int>, heads array<int>, places array<int>"
_INDEX = pa.schema(
    [(name, pa.list_(pa.int64())) for name in ("doc_ids", "keys")]
    + [(name, pa.list_(pa.int32())) for name in ("firsts", "terms", "heads", "places")]
)
MATCH_SCHEMA = "doc_id long, key long, n_words long, hits array<int>, items array<long>, near array<long>"
_MATCH = pa.schema(
    [("doc_id", pa.int64()), ("key", pa.int64()), ("n_words", pa.int64()), ("hits", pa.list_(pa.int32()))]
    + [("items", pa.list_(pa.int64())), ("near", pa.list_(pa.int64()))]
)


@dataclass
class TestWindows:
    """Windows of a group of items: term numbers, each window's item, and the terms' hashes."""

    hashes: np.ndarray
    terms: list[np.ndarray]
    items: np.ndarray
    item_terms: dict[int, np.ndarray]


def match(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """For every row of ``docs``: doc_id, n_words, hits (numbers of hit words), items and near (item ids)."""
    return _matched(docs, items, id_col, text_col, item_col, item_text_col, window, group_bytes).drop("key")


def is_contaminated() -> Column:
    """Whether a row of ``match`` has hit words that are a twentieth of its words or more."""
    return (F.size("hits") > 0) & (20 * F.size("hits") >= F.col("n_words"))


def decontaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns."""
    found = _matched(docs, items, id_col, text_col, item_col, item_text_col, window, group_bytes)
    gone = found.where(is_contaminated()).select("key").distinct()
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    key = F.xxhash64(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")).alias("key")
    return docs.select(key, row).join(gone, "key", "left_anti").select("row.*")


def _matched(docs, items, id_col, text_col, item_col, item_text_col, window, group_bytes) -> DataFrame:
    scratch = Scratch(docs.sparkSession, "phrase-index")
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    texts = texts.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")
    tests = items.select(
        F.col(f"`{item_col}`").cast("long").alias("item"), F.col(f"`{item_text_col}`").alias("text")
    ).where("item is not null and length(text) > 0")
    n_bytes = tests.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    groups = int(n_bytes // group_bytes) + 1
    found = []
    for i in range(groups):
        group = tests.where(F.pmod(F.xxhash64("item"), F.lit(groups)) == i).distinct()
        windows = _test_windows([(r.item, r.text) for r in group.toLocalIterator()], window)
        index = scratch.keep(build_index(texts, windows.hashes), f"index{i}")
        found.append(look_up(index, windows))
    if groups == 1:
        return found[0]
    # every group has each row; rows of one id and text are alike
    merged = reduce(DataFrame.unionByName, found).groupBy("doc_id", "key").agg(
        (F.count("*") / groups).cast("int").alias("copies"),
        F.max("n_words").alias("n_words"),
        *(F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c) for c in ("hits", "items", "near")),
    )
    each = F.explode(F.sequence(F.lit(1), "copies")).alias("copy")
    return merged.select("doc_id", "key", "n_words", "hits", "items", "near", each).drop("copy")


def _test_windows(rows: list[tuple[int, str]], window: int) -> TestWindows:
    known: dict[bytes, int] = {}
    terms, items, item_terms = [], [], {}
    for item, text in sorted(rows):
        words = WORD.findall(text.encode().translate(bytes(LOWER)))
        numbers = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)
        if len(numbers):
            size = min(window, len(numbers))
            terms += [numbers[i : i + size] for i in range(len(numbers) - size + 1)]
            items += [item] * (len(numbers) - size + 1)
            item_terms[item] = np.unique(np.append(item_terms.get(item, numbers[:0]), numbers))
    data = np.frombuffer(b"".join(known), dtype=np.uint8)
    ends = np.cumsum([len(w) for w in known], dtype=np.int64)
    starts = np.append(0, ends)[: len(ends)]
    hashes = Rolling(BYTE_VALUES[data]).slices(starts, ends)
    return TestWindows(hashes, terms, np.array(items, dtype=np.int64), item_terms)


def build_index(texts: DataFrame, hashes: np.ndarray) -> DataFrame:
    """Positional postings of the terms with these hashes, by block of documents (doc_id, key, text)."""
    order = np.argsort(hashes)
    ordered = hashes[order]

    def blocks(batches):
        for block in text_chunks(batches):
            words = split_words(block.data, block.offsets, ALNUM_WORDS)
            seen = Rolling(BYTE_VALUES[LOWER[block.data]]).slices(words.start, words.end)
            slot = np.minimum(np.searchsorted(ordered, seen), max(0, len(ordered) - 1))
            places = np.flatnonzero(ordered[slot] == seen) if len(ordered) else np.zeros(0, np.int64)
            terms = order[slot[places]] if len(ordered) else places
            by_term = np.argsort(terms, kind="stable")
            terms, places = terms[by_term], places[by_term]
            heads = np.flatnonzero(np.append(True, terms[1:] != terms[:-1])) if len(terms) else terms
            lists = [words.first, terms[heads], np.append(heads, len(terms)), places]
            yield record_batch(
                _INDEX, [*map(_one_list, block.rows.columns), *(_one_list(pa.array(x.astype(np.int32))) for x in lists)]
            )

    return texts.mapInArrow(blocks, INDEX_SCHEMA)


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays([0, len(values)], values)


def term_counts(index: DataFrame, n_terms: int) -> np.ndarray:
    """How often each term stands in the corpus."""
    sizes = F.expr("zip_with(terms, sequence(1, size(terms)), (t, i) -> struct(t, heads[i] - heads[i - 1] as n))")
    counts = np.zeros(n_terms, dtype=np.int64)
    lists = index.where("size(terms) > 0").select(F.explode(sizes).alias("x"))
    for row in lists.groupBy("x.t").agg(F.sum("x.n").alias("n")).toLocalIterator():
        counts[row.t] = row.n
    return counts


def look_up(index: DataFrame, windows: TestWindows) -> DataFrame:
    """Exact and proximity matches in every document of the index."""
    counts = term_counts(index, len(windows.hashes))
    order = [np.argsort(counts[t], kind="stable") for t in windows.terms]
    width = max(map(len, windows.terms), default=1)
    padded = np.full((len(windows.terms), width), len(windows.hashes))
    for i, t in enumerate(windows.terms):
        padded[i, : len(t)] = t
    rare = {item: t[np.argsort(counts[t], kind="stable")[:NEAR_TERMS]] for item, t in windows.item_terms.items()}
    n_terms, terms, items = len(windows.hashes), windows.terms, windows.items.tolist()

    def rows(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column(0)[i].values
                firsts, present, heads, places = (
                    batch.column(k)[i].values.to_numpy(zero_copy_only=False).astype(np.int64) for k in range(2, 6)
                )
                cuts = zip(present.tolist(), heads[:-1].tolist(), heads[1:].tolist(), strict=True)
                lists = {t: places[a:b] for t, a, b in cuts}
                there = np.zeros(n_terms + 1, dtype=bool)
                there[present] = there[n_terms] = True
                hit = np.zeros(firsts[-1], dtype=bool)
                of_doc: list[set] = [set() for _ in ids]
                for w in np.flatnonzero(there[padded].all(axis=1)).tolist():
                    size = len(terms[w])
                    start = _intersect(lists, terms[w], order[w])
                    doc = np.searchsorted(firsts, start, side="right") - 1
                    inside = (start >= 0) & (start + size <= firsts[np.minimum(doc + 1, len(firsts) - 1)])
                    for s, d in zip(start[inside].tolist(), doc[inside].tolist(), strict=True):
                        hit[s : s + size] = True
                        of_doc[d].add(items[w])
                near: list[set] = [set() for _ in ids]
                for item, few in rare.items():
                    if there[few].all():
                        for d in _near([lists[t] for t in few.tolist()], firsts).tolist():
                            near[d].add(item)
                hits = np.flatnonzero(hit)
                cut = np.searchsorted(hits, firsts)
                inner = hits - np.repeat(firsts[:-1], np.diff(cut))
                yield record_batch(
                    _MATCH,
                    [
                        ids,
                        batch.column(1)[i].values,
                        np.diff(firsts),
                        pa.ListArray.from_arrays(cut.astype(np.int32), pa.array(inner.astype(np.int32))),
                        [sorted(x) for x in of_doc],
                        [sorted(x) for x in near],
                    ],
                )

    return index.mapInArrow(rows, MATCH_SCHEMA)


def _intersect(lists: dict[int, np.ndarray], terms: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Starts at which each term stands at its offset: lists less their offsets, rarest term first."""
    start = lists[int(terms[order[0]])] - order[0]
    for k in order[1:].tolist():
        if not len(start):
            break
        places = lists[int(terms[k])]
        at = np.searchsorted(places, start + k)
        start = start[places[np.minimum(at, len(places) - 1)] == start + k]
    return start


def _near(lists: list[np.ndarray], firsts: np.ndarray) -> np.ndarray:
    """Documents in which a place of the first list has one of each other list within the span."""
    place = lists[0]
    doc = np.searchsorted(firsts, place, side="right") - 1
    for other in lists[1:]:
        low = np.maximum(place - NEAR_SPAN, firsts[doc])
        high = np.minimum(place + NEAR_SPAN, firsts[doc + 1] - 1)
        ok = np.searchsorted(other, low) < np.searchsorted(other, high, side="right")
        place, doc = place[ok], doc[ok]
    return np.unique(doc)
