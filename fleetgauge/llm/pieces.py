"""SentencePiece encoding and decoding: distinct sampled segmentations by Gumbel top-k without replacement.

A text is encoded as SentencePiece does it: a space goes in front, and pieces of the model's vocabulary cover the
text; a character that no piece covers becomes byte pieces. Pieces weigh by their rank in the vocabulary, as 1 / rank;
models whose scores are log probabilities keep these. All segmentations of a text form a lattice. No piece has a space
but in front, so the lattice of a text is the lattices of its words one after another, and these are built once for
equal words of a pass; a worker keeps those of words it meets again soon.

The ``k`` samples are what an A-star search over the lattice, perturbed by Gumbel noise, emits first. The search space
is split as it goes: the segmentation emitted, and for each of its words the set of those that agree with it before
that word and leave it there; a set of a word is split into those of its steps when its turn comes. A set's priority is the maximum of its Gumbel noise, drawn given
the priority of the set it was split from; the next segmentation is drawn in the set of highest priority, at random in
proportion to the weights. So the samples are distinct, and in the order of their perturbed log probabilities. The
priority left over after the last sample is the threshold; a sample's inclusion score is the probability that it
exceeds the threshold, 1 - exp(-exp(log_prob - threshold)).

All random numbers are hashes of the row's key, the sample's number and the place, so a row has the same samples
wherever and whenever it is computed.

Defined cases: a null text is empty; an empty text has one segmentation, the empty one, with probability 1; a text with
fewer segmentations than ``k`` gives all of them; a literal U+2581 becomes byte pieces, so that decoding gives it back;
rows of one id draw the same numbers, so equal rows have equal samples.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .arrays import BYTE_VALUES, Rolling, Texts, mix, record_batch, text_chunks

K = 2
#: Samples are numbered in eight bits of what their random numbers are made of.
MOST_SAMPLES = 256
#: Text bytes of one pass; its lattices and samples are some hundred times that.
PASS_BYTES = 1 << 17
#: Characters of the words whose lattices a worker keeps; the other words' are built for each pass.
KEPT_CHARS = 1 << 19
#: Words that a worker remembers to have met, to keep those that it meets again.
MET_WORDS = 1 << 17
SPACE_MARK = "▁".encode()
#: What a byte piece weighs, as a share of the last piece of the vocabulary.
BYTE_SHARE = 0.1

NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


@dataclass
class Vocabulary:
    """Pieces as bytes (a space where the model has U+2581), which of them cover text, and their log weights."""

    surface: list[bytes]
    log_weight: np.ndarray
    byte_ids: np.ndarray
    byte_log_weight: float

    def __post_init__(self) -> None:
        usable = np.flatnonzero(np.isfinite(self.log_weight)).tolist()
        known = {self.surface[i].decode(): i for i in usable}
        starts = {text[:n] for text in known for n in range(1, len(text))}
        keys = [*known, *sorted(starts - known.keys())]
        data = [key.encode() for key in keys]
        ends = np.cumsum([len(x) for x in data], dtype=np.int64)
        values = BYTE_VALUES[np.frombuffer(b"".join(data), dtype=np.uint8)]
        #: Pieces that cover text, and their starts, by hash; ``ids`` has a piece's id, -1 for what is only a start.
        self.index = pd.Index(Rolling(values).slices(np.append(0, ends)[: len(ends)], ends))
        self.ids = np.array([known.get(key, -1) for key in keys], dtype=np.int64)
        self.goes_on = np.array([key in starts for key in keys], dtype=bool)
        self.sizes = np.array([len(x) for x in self.surface], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.data = np.frombuffer(b"".join(self.surface), dtype=np.uint8)


def _fields(data: bytes):
    """Field number and value of a protocol-buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = varint() if key & 7 == 2 else 4 if key & 7 == 5 else 8
            yield key >> 3, data[at : at + size]
            at += size


@lru_cache(maxsize=2)
def load(path: str) -> Vocabulary:
    """The vocabulary of a model file. A model with log probabilities is a unigram model (type 1)."""
    with open(path, "rb") as file:
        model = file.read()
    pieces, unigram = [], True
    for field, value in _fields(model):
        if field == 1:
            piece = dict(_fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            pieces.append((piece.get(1, b""), score, piece.get(3, NORMAL)))
        elif field == 2:
            unigram = dict(_fields(value)).get(3, 1) == 1
    return vocabulary(pieces, unigram)


def vocabulary(pieces: list[tuple[bytes, float, int]], unigram: bool) -> Vocabulary:
    """From pieces with their scores and kinds. Without log probabilities a piece weighs 1 / rank by its score.

    Left out: runs of spaces, which other kinds of model reserve, and pieces with the mark inside.
    """
    surface = [p.replace(SPACE_MARK, b" ") for p, _, _ in pieces]
    covers = [
        kind in (NORMAL, USER) and len(s) > 0 and b" " not in s[1:] for s, (_, _, kind) in zip(surface, pieces, strict=True)
    ]
    scores = np.array([score for _, score, _ in pieces])
    weight = np.full(len(pieces), -np.inf)
    usable = np.flatnonzero(covers)
    if unigram:
        weight[usable] = scores[usable]
    else:
        ranked = usable[np.argsort(-scores[usable], kind="stable")]
        total = np.log(np.sum(1.0 / np.arange(1, len(ranked) + 1)))
        weight[ranked] = -np.log(np.arange(1, len(ranked) + 1)) - total
    byte_ids = np.full(256, -1, dtype=np.int64)
    for i, (piece, _, kind) in enumerate(pieces):
        if kind == BYTE:
            byte_ids[int(piece[3:-1], 16)] = i
            surface[i] = bytes([int(piece[3:-1], 16)])
    if (byte_ids < 0).any():
        raise ValueError("the model has no byte pieces, so not every text could be encoded")
    least = weight[usable].min() if len(usable) else 0.0
    return Vocabulary(surface, weight, byte_ids, float(least + np.log(BYTE_SHARE)))


@dataclass
class Lattice:
    """Lattices of different words, one after another.

    Nodes are the words' characters: ``node_at`` is a node's place in its word, in bytes, ``char`` its first byte in
    ``data``, ``size`` its bytes. Its edges start at ``head``, ``options`` of them, longer ones first. An edge leaves
    ``source`` and reaches ``target`` (-1 at the word's end), with its piece (-1 for byte pieces) and log probability;
    ``cumulative`` is the probability of the node's edges up to it, 1 for the last.
    """

    data: np.ndarray
    char: np.ndarray
    size: np.ndarray
    node_at: np.ndarray
    head: np.ndarray
    options: np.ndarray
    source: np.ndarray
    target: np.ndarray
    piece: np.ndarray
    log_p: np.ndarray
    cumulative: np.ndarray


def lattice(data: np.ndarray, word_start: np.ndarray, word_end: np.ndarray, vocab: Vocabulary) -> tuple[Lattice, np.ndarray]:
    """Lattices of the words given by their places in ``data``, and each word's first node."""
    size = word_end - word_start
    first = np.concatenate([[0], np.cumsum(size)])
    own = data[np.arange(first[-1]) + np.repeat(word_start - first[:-1], size)]
    char = np.flatnonzero((own & 0xC0) != 0x80)
    n_nodes = len(char)
    start = np.searchsorted(char, first)
    char = np.append(char, len(own))
    word = np.repeat(np.arange(len(size)), np.diff(start))
    rest = start[word + 1] - np.arange(n_nodes)  # characters to the word's end
    source, nth, size, piece, score, n_options = _edges(own, char, rest, vocab)

    # log mass of the rest of the word, from its last character on
    small = rest.max(initial=0) < 1 << 16
    node = np.argsort(rest.astype(np.uint16) if small else rest, kind="stable")
    options = n_options[node]
    head = np.cumsum(options) - options
    by_node = np.empty(n_nodes, np.int64)
    by_node[node] = head
    place = by_node[source] + n_options[source] - 1 - nth  # longer ones first
    put = lambda x: _scattered(x, place)
    source, size, piece, score = put(source), put(size), put(piece), put(score)
    target = source + size
    mass = np.zeros(n_nodes + 1)
    ends = rest[source] == size
    inner = np.where(ends, n_nodes, target)  # at a word's end nothing follows
    cuts = np.searchsorted(rest[node], np.arange(1, rest.max(initial=0) + 2))
    bounds = np.append(head, len(source))
    log_p = np.empty(len(source))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if a == b:
            continue
        lo, hi = bounds[a], bounds[b]
        edge = score[lo:hi] + mass[inner[lo:hi]]
        heads = head[a:b] - lo
        top = np.maximum.reduceat(edge, heads)
        total = top + np.log(np.add.reduceat(np.exp(edge - np.repeat(top, options[a:b])), heads))
        mass[node[a:b]] = total
        log_p[lo:hi] = edge - np.repeat(total, options[a:b])
    cumulative = np.exp(log_p)
    more, nth = head[options > 1], 1
    left = options[options > 1]
    while len(more):
        cumulative[more + nth] += cumulative[more + nth - 1]
        nth += 1
        more, left = more[left > nth], left[left > nth]
    cumulative[bounds[1:] - 1] = 1.0
    target[ends] = -1
    node_at = char[:-1] - char[start[word]]
    lat = Lattice(own, char[:-1], np.diff(char), node_at, by_node, n_options, source, target, piece, log_p, cumulative)
    return lat, start[:-1]


class Lattices:
    """Lattices of words, of which those met in two passes not far apart are kept from one pass to the next, up to a bound."""

    def __init__(self, vocab: Vocabulary, kept_chars: int = KEPT_CHARS) -> None:
        self.vocab, self.kept_chars = vocab, kept_chars
        none, small = np.zeros(0, np.int64), np.zeros(0, np.int32)
        #: Hashes of the words kept, in ascending order, and their first nodes.
        self.known, self.first = np.zeros(0, np.uint64), none
        #: For each remainder, the hash last met; a word's is forgotten when another takes its place.
        self.met = np.zeros(MET_WORDS, np.uint64)
        empty = (np.zeros(0, np.uint8), none, small, small, small, small, small, small, small, np.zeros(0), np.zeros(0))
        self.all = Lattice(*empty)
        self.bytes = self.nodes = self.edges = 0

    def of(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The first node of each of the different words, whose hashes ascend; valid until the next call."""
        at = np.searchsorted(self.known, hashes)
        old = at < len(self.known)
        old[old] = self.known[at[old]] == hashes[old]
        found = np.full(len(hashes), -1, dtype=np.int64)
        found[old] = self.first[at[old]]
        new = np.flatnonzero(~old)
        if self.nodes < self.kept_chars:
            slot = hashes[new] % np.uint64(MET_WORDS)
            again = self.met[slot] == hashes[new]
            self.met[slot] = hashes[new]
            self._keep(data, start, end, hashes, new[again], at, found)
            new = new[found[new] < 0]
        if len(new):
            lat, first = lattice(data, start[new], end[new], self.vocab)
            found[new] = first + self.nodes
            self._add(lat)
        return found

    def _keep(self, data, start, end, hashes, chosen, at, found) -> None:
        """Keep the words ``chosen``, which belong at ``at`` among those known, unless they are too many."""
        if not len(chosen):
            return
        lat, first = lattice(data, start[chosen], end[chosen], self.vocab)
        if self.nodes + len(lat.char) > self.kept_chars:
            self.kept_chars = self.nodes
            return
        found[chosen] = first + self.nodes
        self._add(lat)
        self.known = np.insert(self.known, at[chosen], hashes[chosen])
        self.first = np.insert(self.first, at[chosen], found[chosen])
        self.bytes += len(lat.data)
        self.nodes += len(lat.char)
        self.edges += len(lat.source)

    def _add(self, lat: Lattice) -> None:
        """Put lattices behind those that are kept."""
        by_edge = ("source", "target", "piece", "log_p", "cumulative")
        shift = {"char": self.bytes, "head": self.edges, "source": self.nodes}
        for name, array in vars(lat).items():
            at = self.bytes if name == "data" else self.edges if name in by_edge else self.nodes
            if name == "target":
                array = np.where(array >= 0, array + self.nodes, -1)
            kept = getattr(self.all, name)
            if len(kept) < at + len(array):
                grown = np.empty((at + len(array)) * 3 // 2, kept.dtype)
                grown[:at] = kept[:at]
                setattr(self.all, name, grown)
                kept = grown
            kept[at : at + len(array)] = array + shift[name] if name in shift else array


def _scattered(values: np.ndarray, place: np.ndarray) -> np.ndarray:
    out = np.empty_like(values)
    out[place] = values
    return out


def _edges(own: np.ndarray, char: np.ndarray, rest: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, ...]:
    """Of all edges the source, how many shorter ones leave it, characters, piece and score; and each node's number of them.

    A node goes on to longer pieces while some piece starts so. A character that no piece covers has an edge, too.
    """
    rolling = Rolling(BYTE_VALUES[own])
    node = np.arange(len(rest))
    options = np.ones(len(rest), dtype=np.int64)
    sources, numbers, sizes, pieces = [], [], [], []
    length = 0
    while len(node):
        length += 1
        node = node[rest[node] >= length]
        slot = vocab.index.get_indexer(rolling.slices(char[node], char[node + length]))
        some = slot >= 0
        piece = np.full(len(node), -1)
        piece[some] = vocab.ids[slot[some]]
        full = piece >= 0
        if length == 1:
            sources.append(node)
            pieces.append(piece)
            numbers.append(np.zeros(len(node), np.int64))
        else:
            sources.append(node[full])
            pieces.append(piece[full])
            numbers.append(options[sources[-1]])
            options[sources[-1]] += 1
        sizes.append(np.full(len(sources[-1]), length))
        node = node[some][vocab.goes_on[slot[some]]]
    none = np.zeros(0, np.int64)
    source, nth, size, piece = (np.concatenate([none, *x]) for x in (sources, numbers, sizes, pieces))
    n_bytes = char[source + size] - char[source]
    score = np.where(piece >= 0, vocab.log_weight[piece], vocab.byte_log_weight * n_bytes)
    return source, nth, size, piece, score, options


def uniform(seed: np.ndarray, sample: int, use: int, place: np.ndarray | int, path: int = 0) -> np.ndarray:
    """Numbers strictly between 0 and 1, given by seed, sample, use, place and path, each in bits of its own."""
    if max(sample, path) >= MOST_SAMPLES:
        raise ValueError(f"fewer than {MOST_SAMPLES} samples, not {max(sample, path)}")
    number = np.atleast_1d(np.asarray(place, dtype=np.uint64)) | np.uint64(path << 56 | sample << 48 | use << 44)
    x = mix(seed + number * np.uint64(0x9E3779B97F4A7C15))
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _walk(lat: Lattice, node: np.ndarray, seed: np.ndarray, sample: int, place: np.ndarray) -> tuple[np.ndarray, ...]:
    """Random steps from each node to the end of its word: in order of the starts, which start, and the edge.

    ``place`` is that of the node's word in the text. A start at -1 takes no step.
    """
    turn = np.zeros(len(node), dtype=np.int64)
    walker = np.flatnonzero(node >= 0)
    at = node[walker]
    steps = []
    while len(walker):
        u = uniform(seed[walker], sample, 0, place[walker] + lat.node_at[at])
        edge = lat.head[at].astype(np.int64)
        late = np.flatnonzero(lat.cumulative[edge] < u)
        while len(late):
            edge[late] += 1
            late = late[lat.cumulative[edge[late]] < u[late]]
        steps.append((walker, edge))
        turn[walker] += 1
        at = lat.target[edge]
        on = at >= 0
        walker, at = walker[on], at[on]
    first = np.concatenate([[0], np.cumsum(turn)])
    edges = np.empty(first[-1], np.int64)
    for nth, (who, edge) in enumerate(steps):
        edges[first[who] + nth] = edge
    return np.repeat(np.arange(len(node)), turn), edges


@dataclass
class Paths:
    """Segmentations of texts, one after another.

    ``text`` lists the texts, ``first`` their first steps, ``log_prob`` and ``score`` their segmentations'; ``word`` and
    ``edge`` are the steps'. The segmentations that agree with a path before a word and leave it in that word are a
    set: ``set_first`` has each text's first set, ``set_step`` a set's first step, ``mass`` its log probability and
    ``value`` its priority, none for words that are shared with an earlier path.
    """

    text: np.ndarray
    first: np.ndarray
    log_prob: np.ndarray
    score: np.ndarray
    word: np.ndarray
    edge: np.ndarray
    set_first: np.ndarray
    set_step: np.ndarray
    before: np.ndarray
    value: np.ndarray


@dataclass
class Sets:
    """Sets that leave a path at a step: by an edge of ``node`` that is not among the bits in ``taken``.

    ``before`` is the log probability of the path's steps before it, ``value`` the set's priority.
    """

    text: np.ndarray
    path: np.ndarray
    step: np.ndarray
    word: np.ndarray
    node: np.ndarray
    taken: np.ndarray
    before: np.ndarray
    value: np.ndarray


def _priority(mass: np.ndarray, below: np.ndarray, u: np.ndarray) -> np.ndarray:
    """The largest Gumbel noise over a set of that log mass, given that it is less than ``below``."""
    value = np.full(len(mass), -np.inf)
    some = np.flatnonzero(np.isfinite(mass))
    mass = mass[some]
    value[some] = mass - np.log(np.exp(mass - below[some]) - np.log(u[some]))
    return value


def _parts(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of ``n``: each member's group, and its place in the group."""
    group = np.repeat(np.arange(len(n)), n)
    return group, np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)


@lru_cache(maxsize=1)
def _kept(model_file: str) -> Lattices:
    """The lattices that a worker process keeps for all its tasks."""
    return Lattices(load(model_file))


class Sampler:
    """Samples of the segmentations of some texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, seed: np.ndarray, lattices: Lattices) -> None:
        """Every text that is not empty starts with a space."""
        self.seed, self.n = seed, len(offsets) - 1
        start = np.flatnonzero(data == 0x20)
        end = np.append(start[1:], len(data))[: len(start)]
        words = Rolling(BYTE_VALUES[data]).slices(start, end)
        words, one, kind = np.unique(words, return_index=True, return_inverse=True)
        self.start = lattices.of(data, start[one], end[one], words)[kind]
        self.lat, self.vocab = lattices.all, lattices.vocab
        self.first_word = np.searchsorted(start, offsets)
        self.text = np.repeat(np.arange(self.n), np.diff(self.first_word))
        self.place = start - offsets[self.text]
        none, real = np.zeros(0, np.int64), np.zeros(0)
        self.sets = Sets(none, none, none, none, none, none, real, real)

    def _finish(self, text, first, score, word, edge, shared, sample) -> Paths:
        """Paths with the priorities of the sets beside their words; a text's first ``shared`` words have none."""
        log_p = self.lat.log_p[edge]
        of = np.repeat(np.arange(len(text)), np.diff(first))
        set_step = np.flatnonzero(np.append(True, (word[1:] != word[:-1]))[: len(word)])
        set_text = of[set_step]
        set_first = np.searchsorted(set_text, np.arange(len(text) + 1))
        per_word = np.add.reduceat(log_p, set_step) if len(set_step) else log_p
        sums = np.concatenate([[0.0], np.cumsum(per_word)])
        before = sums[:-1] - sums[set_first[set_text]]
        log_prob = np.zeros(len(text))
        some = np.flatnonzero(np.diff(set_first))
        if len(some):
            log_prob[some] = np.add.reduceat(per_word, set_first[some])
        own = np.flatnonzero((np.arange(len(set_step)) - set_first[set_text] >= shared[set_text]) & (per_word < 0))
        u = uniform(self.seed[text[set_text[own]]], sample, 1, self.place[word[set_step[own]]])
        with np.errstate(divide="ignore"):
            mass = before[own] + np.log(-np.expm1(per_word[own]))
        value = np.full(len(set_step), -np.inf)
        value[own] = _priority(mass, score[set_text[own]], u)
        return Paths(text, first, log_prob, score, word, edge, set_first, set_step, before, value)

    def samples(self, k: int) -> tuple[list[Paths], np.ndarray]:
        """Paths of the first, second, ... samples, and each text's threshold."""
        word, edge = _walk(self.lat, self.start, self.seed[self.text], 0, self.place)
        score = -np.log(-np.log(uniform(self.seed, 0, 2, 0)))
        first = np.searchsorted(self.text[word], np.arange(self.n + 1))
        none = np.zeros(self.n, np.int64)
        paths = [self._finish(np.arange(self.n), first, score, word, edge, none, 0)]
        for sample in range(1, k):
            paths.append(self._next(paths, sample))
        return paths, self._open(paths, k)

    def _open(self, paths: list[Paths], sample: int) -> np.ndarray:
        """Each text's highest priority. A set of a word that has it is split into the sets of the word's steps."""
        best = np.full(self.n, -np.inf)
        np.maximum.at(best, self.sets.text, self.sets.value)
        for r, p in enumerate(paths):
            of = np.repeat(np.arange(len(p.text)), np.diff(p.set_first))
            top = np.full(len(p.text), -np.inf)
            np.maximum.at(top, of, p.value)
            chosen = np.flatnonzero((p.value == top[of]) & (p.value > best[p.text[of]]))
            best[p.text] = np.maximum(best[p.text], top)
            if len(chosen):
                self._split(r, p, chosen, p.text[of[chosen]], sample)
        return best

    def _split(self, r: int, p: Paths, chosen: np.ndarray, text: np.ndarray, sample: int) -> None:
        """Sets of words become sets of their steps: one, drawn by mass, keeps the priority; the others have less."""
        lat = self.lat
        step = p.set_step[chosen]
        group, inner = _parts(np.append(p.set_step, len(p.edge))[chosen + 1] - step)
        steps = step[group] + inner
        edge = p.edge[steps]
        log_p, node = lat.log_p[edge], lat.source[edge].astype(np.int64)
        sums = np.concatenate([[0.0], np.cumsum(log_p)])
        first = np.flatnonzero(inner == 0)
        before = p.before[chosen][group] + sums[:-1] - sums[first][group]
        with np.errstate(divide="ignore"):
            mass = np.where(lat.options[node] > 1, before + np.log(-np.expm1(log_p)), -np.inf)
        seed, place = self.seed[text[group]], self.place[p.word[steps]] + lat.node_at[node]
        # the largest of independent noises belongs to a step with the probability of its share of the mass
        noise = np.where(np.isfinite(mass), mass - np.log(-np.log(uniform(seed, sample, 5, place, r))), -np.inf)
        winner = noise == np.maximum.reduceat(noise, first)[group]
        top = p.value[chosen][group]
        value = np.where(winner, top, _priority(mass, top, uniform(seed, sample, 8, place, r)))
        p.value[chosen] = -np.inf
        some = np.isfinite(value)
        taken = np.int64(1) << (edge - lat.head[node]).astype(np.int64)
        added = (text[group], np.full(len(steps), r), steps, p.word[steps], node, taken, before, value)
        self.sets = Sets(*(np.append(old, new[some]) for old, new in zip(vars(self.sets).values(), added, strict=True)))

    def _next(self, paths: list[Paths], sample: int) -> Paths:
        """Each text's next segmentation: a random one of the set of highest priority."""
        lat = self.lat
        best = self._open(paths, sample)
        at = np.flatnonzero((self.sets.value == best[self.sets.text]) & np.isfinite(self.sets.value))
        at = at[np.argsort(self.sets.text[at], kind="stable")]
        text, path, step, word, node, taken, before, score = (x[at] for x in vars(self.sets).values())
        # the step that leaves the path: an edge not taken yet
        option = np.arange(lat.options[node].max(initial=1))
        there = option < lat.options[node][:, None]
        p_edge = np.exp(lat.log_p[np.where(there, lat.head[node][:, None] + option, 0)])
        weight = np.where(there & (taken[:, None] >> option & 1 == 0), p_edge, 0.0)
        sums = np.cumsum(weight, axis=1)
        u = uniform(self.seed[text], sample, 3, 0)
        chosen = (sums <= u[:, None] * sums[:, -1:]).sum(axis=1)
        # what is left of the set that it was in
        weight[np.arange(len(text)), chosen] = 0.0
        with np.errstate(divide="ignore"):
            left = before + np.log(weight.sum(axis=1))
        self.sets.value[at] = _priority(left, score, uniform(self.seed[text], sample, 4, 0))
        self.sets.taken[at] |= np.int64(1) << chosen
        # the rest: of the word, then of the words after it
        turn = lat.head[node] + chosen
        walks, nth = _parts(self.first_word[text + 1] - word)
        words = word[walks] + nth
        starts = np.where(nth == 0, lat.target[turn][walks], self.start[words])
        walker, tail = _walk(lat, starts, self.seed[text[walks]], sample, self.place[words])
        n_tail = np.bincount(walks[walker], minlength=len(text))
        head = np.zeros(len(text), np.int64)
        for r, p in enumerate(paths):
            mine = np.flatnonzero(path == r)
            head[mine] = step[mine] - p.first[np.searchsorted(p.text, text[mine])]
        first = np.concatenate([[0], np.cumsum(head + 1 + n_tail)])
        group, inner = _parts(n_tail)
        after = (first[:-1] + head + 1)[group] + inner
        new_word, new_edge = np.empty((2, first[-1]), np.int64)
        new_word[after], new_edge[after] = words[walker], tail
        new_word[first[:-1] + head], new_edge[first[:-1] + head] = word, turn
        for r, p in enumerate(paths):
            mine = np.flatnonzero(path == r)
            group, inner = _parts(head[mine])
            source, to = (step[mine] - head[mine])[group] + inner, first[:-1][mine][group] + inner
            new_word[to], new_edge[to] = p.word[source], p.edge[source]
        out = self._finish(text, first, score, new_word, new_edge, word - self.first_word[text] + 1, sample)
        self._beside(out, len(paths), text, word, first[:-1] + head + 1, sample)
        return out

    def _beside(self, p: Paths, r: int, text: np.ndarray, word: np.ndarray, step: np.ndarray, sample: int) -> None:
        """Sets of the steps that end the word in which a path left its model."""
        lat = self.lat
        nth = word - self.first_word[text]
        ends = np.append(p.set_step, len(p.edge))[p.set_first[:-1] + nth + 1]
        group, inner = _parts(ends - step)
        steps = step[group] + inner
        edge = p.edge[steps]
        node, log_p = lat.source[edge].astype(np.int64), lat.log_p[edge]
        first = p.set_step[p.set_first[:-1] + nth]
        sums = np.concatenate([[0.0], np.cumsum(lat.log_p[p.edge])])
        before = p.before[p.set_first[:-1] + nth][group] + sums[steps] - sums[first][group]
        with np.errstate(divide="ignore"):
            mass = np.where(lat.options[node] > 1, before + np.log(-np.expm1(log_p)), -np.inf)
        place = self.place[p.word[steps]] + lat.node_at[node]
        value = _priority(mass, p.score[group], uniform(self.seed[text[group]], sample, 11, place))
        some = np.isfinite(value)
        taken = np.int64(1) << (edge - lat.head[node]).astype(np.int64)
        added = (text[group], np.full(len(steps), r), steps, p.word[steps], node, taken, before, value)
        self.sets = Sets(*(np.append(old, new[some]) for old, new in zip(vars(self.sets).values(), added, strict=True)))

    def ids(self, p: Paths) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of the paths, one after another, and each path's first."""
        lat = self.lat
        piece = lat.piece[p.edge].astype(np.int64)
        bare = np.flatnonzero(piece < 0)
        if not len(bare):
            return piece, p.first
        node = lat.source[p.edge[bare]]
        n_bytes = lat.size[node].astype(np.int64)
        count = np.ones(len(piece), dtype=np.int64)
        count[bare] = n_bytes
        cuts = np.concatenate([[0], np.cumsum(count)])
        out = np.repeat(piece, count)
        inner = np.arange(n_bytes.sum()) - np.repeat(np.cumsum(n_bytes) - n_bytes, n_bytes)
        byte = lat.data[np.repeat(lat.char[node], n_bytes) + inner]
        out[np.repeat(cuts[bare], n_bytes) + inner] = self.vocab.byte_ids[byte]
        return out, cuts[p.first]


def spell(ids: np.ndarray, first: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The texts of id sequences as bytes one after another, the space in front left out, and where each starts."""
    size = vocab.sizes[ids]
    cuts = np.concatenate([[0], np.cumsum(size)])
    out = vocab.data[np.arange(cuts[-1]) + np.repeat(vocab.starts[ids] - cuts[:-1], size)]
    start = cuts[first]
    some = start[1:] > start[:-1]
    front = start[:-1][some]
    keep = np.ones(len(out), dtype=bool)
    keep[front[out[front] == 0x20]] = False
    return out[keep], np.concatenate([[0], np.cumsum(keep)])[start]


SAMPLE_SCHEMA = (
    "doc_id long, sample int, pieces array<int>, n_pieces long, log_prob double, score double, inclusion double, "
    "round_trip boolean"
)
_SAMPLE = pa.schema(
    [("doc_id", pa.int64()), ("sample", pa.int32()), ("pieces", pa.list_(pa.int32())), ("n_pieces", pa.int64())]
    + [(name, pa.float64()) for name in ("log_prob", "score", "inclusion")]
    + [("round_trip", pa.bool_())]
)


def encode(
    docs: DataFrame, model_file: str, k: int = K, id_col: str = "doc_id", text_col: str = "text", seed: int = 0
) -> DataFrame:
    """Up to ``k`` rows for every row: doc_id, sample (from 1), pieces, n_pieces, log_prob, score, inclusion, round_trip.

    ``model_file`` has the same path on every machine. ``round_trip`` says whether the pieces decode to the text.
    """
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    texts = texts.select("doc_id", F.xxhash64("doc_id", F.lit(seed)).alias("seed"), "text")

    def run(batches):
        lattices = _kept(model_file)
        for chunk in text_chunks(batches, limit=PASS_BYTES):
            yield from sampled(chunk, lattices, k)

    return texts.mapInArrow(run, SAMPLE_SCHEMA)


def _spaced(chunk: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a space in front of those that are not empty."""
    some = np.flatnonzero(np.diff(chunk.offsets))
    data = np.insert(chunk.data, chunk.offsets[some], 0x20)
    return data, chunk.offsets + np.searchsorted(some, np.arange(len(chunk.offsets)))


def sampled(chunk: Texts, lattices: Lattices, k: int):
    """Sample rows of some texts (doc_id, seed)."""
    data, offsets = _spaced(chunk)
    sampler, vocab = Sampler(data, offsets, chunk.column("seed").view(np.uint64), lattices), lattices.vocab
    paths, threshold = sampler.samples(k)
    for sample, p in enumerate(paths, 1):
        ids, first = sampler.ids(p)
        spelled, starts = spell(ids, first, vocab)
        whole = len(p.text) == len(chunk) and np.array_equal(spelled, chunk.data)
        same = np.array(
            [whole or spelled[a:b].tobytes() == chunk.text(t) for t, a, b in zip(p.text, starts[:-1], starts[1:], strict=True)],
            dtype=bool,
        )
        with np.errstate(over="ignore"):
            inclusion = -np.expm1(-np.exp(p.log_prob - threshold[p.text]))
        yield record_batch(
            _SAMPLE,
            [
                chunk.rows.column(0).take(pa.array(p.text)),
                np.full(len(p.text), sample, np.int32),
                pa.ListArray.from_arrays(first.astype(np.int32), pa.array(ids.astype(np.int32))),
                np.diff(first),
                p.log_prob,
                p.score,
                inclusion,
                same,
            ],
        )


def decode(rows: DataFrame, model_file: str, pieces_col: str = "pieces") -> DataFrame:
    """``rows`` with the column ``decoded``; null pieces give an empty text, invalid bytes the replacement character."""
    schema = StructType([*rows.schema.fields, StructField("decoded", StringType())])

    def run(batches):
        vocab = load(model_file)
        for batch in batches:
            at = batch.schema.get_field_index(pieces_col)
            lists = batch.column(at)
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.float64))
            first = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))])
            data, starts = spell(ids, first, vocab)
            raw = data.tobytes()
            texts = [raw[a:b].decode(errors="replace") for a, b in zip(starts[:-1], starts[1:], strict=True)]
            yield batch.append_column("decoded", pa.array(texts, type=pa.string()))

    return rows.mapInArrow(run, schema)
