"""Texts as byte arrays inside a task: bounded chunks, words, rolling hashes, window minima."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes that a task looks at together; one longer text is a chunk of its own.
CHUNK_BYTES = 1 << 19

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_GROWN: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits after which every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A fixed 64-bit value for each byte.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER))


def _powers(base: int, n: int) -> np.ndarray:
    have = _GROWN.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, CHUNK_BYTES + 1), base, dtype=np.uint64)
        have[0] = 1
        _GROWN[base] = have = np.multiply.accumulate(have)
    return have[:n]


class Rolling:
    """Hashes of any slice of a sequence of 64-bit values, from prefix sums."""

    def __init__(self, values: np.ndarray) -> None:
        self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * _powers(_MULTIPLIER, len(values)), out=self.sums[1:])
        self.back = _powers(_INVERSE, len(values) + 1)

    def fixed(self, length: int) -> np.ndarray:
        """Hash of every slice of ``length`` values, by start."""
        n = len(self.sums) - length
        return mix((self.sums[length:] - self.sums[:n]) * self.back[:n])

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the slices, their lengths included."""
        raw = (self.sums[end] - self.sums[start]) * self.back[start]
        return mix(raw ^ mix((end - start).astype(np.uint64)))


@dataclass
class Texts:
    """Some rows: their other columns, and their texts one after another."""

    rows: pa.RecordBatch
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def column(self, name: str) -> np.ndarray:
        return self.rows.column(self.rows.schema.get_field_index(name)).to_numpy(zero_copy_only=False)

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def text_chunks(batches: Iterable[pa.RecordBatch], name: str = "text", limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The batches' rows in order, at most ``limit`` text bytes at a time; a null text is empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(name)
        column = batch.column(at)
        whole = pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string()
        column = pc.fill_null(column.cast(whole), b"" if pa.types.is_binary(column.type) else "")
        rest = batch.remove_column(at)
        _, offsets, data = column.buffers()
        offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
        lo = 0
        while lo < len(column):
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
            part = offsets[lo : hi + 1]
            yield Texts(rest.slice(lo, hi - lo), data[part[0] : part[-1]], part - part[0])
            lo = hi
    pa.default_memory_pool().release_unused()


def byte_table(in_word) -> np.ndarray:
    """A flag for each byte."""
    return np.array([bool(in_word(b)) for b in range(256)])


#: Words of letters, digits and anything outside ASCII.
ALNUM_WORDS = byte_table(lambda b: b >= 0x80 or chr(b).isalnum())
#: Words between white space.
SPACED_WORDS = byte_table(lambda b: b not in (0x20, *range(0x09, 0x0E)))
#: A-Z as a-z.
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)


@dataclass
class Words:
    """Words of some texts: where each starts and ends, and each text's first."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def text_of(self) -> np.ndarray:
        """The index of each word's text."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def split_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> Words:
    """Maximal runs of bytes in ``table``, none across two texts."""
    inside = table[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[inner - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    return Words(start, end, np.searchsorted(start, offsets))


def window_minima(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` hashes, the place of its smallest, the leftmost of equal ones.

    Compares 31 bits of a hash, so that hash and place fit one integer; which place is chosen depends on the
    window's hashes alone.
    """
    n = len(hashes)
    keys = ((hashes >> np.uint64(33)) << np.uint64(32)).astype(np.int64) | np.arange(n)
    padded = np.concatenate([keys, np.full(-n % width, np.iinfo(np.int64).max)]).reshape(-1, width)
    left = np.minimum.accumulate(padded, axis=1).ravel()
    right = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - width + 1
    return np.minimum(right[:count], left[width - 1 : width - 1 + count]) & 0xFFFFFFFF


@dataclass
class Runs:
    """Neighbouring windows of one text that share an anchor: first window, number of windows, anchor, text."""

    at: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    text: np.ndarray


def anchored_runs(hashes: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> Runs:
    """All windows of ``window`` items, in runs that share the place of their smallest gram.

    ``hashes`` has the hash of each gram of ``gram`` items. Equal windows choose the same gram at the same distance,
    so they are found by comparing only runs of equal grams.
    """
    total = int(offsets[-1])
    count = total - window + 1
    none = np.zeros(0, np.int64)
    if count <= 0:
        return Runs(none, none, none, none)
    anchor = window_minima(hashes, window - gram + 1)[:count]
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:count]
    whole = np.arange(count) + window <= offsets[text + 1]
    new = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])))
    sums = np.concatenate([[0], np.cumsum(whole)])
    size = sums[np.append(new[1:], count)] - sums[new]
    new, size = new[size > 0], size[size > 0]
    return Runs(new, size, anchor[new], text[new])


def record_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open intervals as maximal disjoint ones, in order."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.append(True, start[1:] > reach[:-1]))
    return start[new], reach[np.append(new[1:] - 1, len(start) - 1)]
