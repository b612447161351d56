"""License scans: an exact set-similarity join of text blocks with license templates.

A block is a stretch of words of a text, every half stretch, across line breaks: so every half stretch of words in a
row is within a block, such as a notice wrapped over several lines. Its length follows from the templates: each is
looked for in blocks of at least twice its own length, of ``BLOCK_WORDS`` words or that doubled as often as it takes.
So whole license texts are found as well as short notices, whose words are not collected over pages. A template
is found in a block that has at least ``threshold`` of the template's different words and all its names: words that
stand consecutively and tell its license from others of like wording, each name in one of its forms. A name belongs to
the block that has its first word. The join looks at few blocks:

* words are ordered by their frequency in the whole corpus, rare ones first;
* prefix filter: a block and a template of ``size`` words, ``need`` of them asked for, share a word among the
  template's first ``size - need + 1`` and among as many as the block can miss;
* length filter: the block has ``need`` words of the templates' vocabulary;
* positional filter: behind the shared word both have enough words left to reach ``need``.

What passes is checked on the full sets, so the result is exact. Phrases, a plainer kind of label, are counted where
their words stand consecutively.

Defined cases: a null text is empty; a text without words has no labels and score 0; rows of one id are told apart by
their texts; templates without words are left out.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import ALNUM_WORDS, BYTE_VALUES, LOWER, Rolling, record_batch, split_words, text_chunks

BLOCK_WORDS = 100
THRESHOLD = 0.8

# Phrases and templates, each with its label; after a template's text its names, each as a list of forms.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
TEMPLATES = (
    ("mit", "Released under the MIT License", ("mit license",)),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction",
        ("deal in the software",),
    ),
    (
        "apache-2",
        "Licensed under the Apache License, Version 2.0",
        ("apache license",),
        ("version 2", "license 2", "v 2", "v2"),
    ),
    (
        "gpl-3",
        "This work is licensed under the GNU General Public License, version 3",
        ("gnu general public license",),
        ("version 3", "license 3", "v 3", "v3"),
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    (
        "mpl-2",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        ("mozilla public license",),
        ("version 2", "license 2", "v 2", "v2"),
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
)
FULL_TEXTS = (
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS '
        "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
        "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
        "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        ("deal in the software",),
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND "
        'CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
        "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
        "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
        "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
        "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
        "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE "
        'SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
        "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
        "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
        ("distribute this software",),
    ),
)

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

_SCAN = pa.schema(
    [("doc_id", pa.int64()), ("key", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64())]
    + [("first_word", pa.int64()), ("last_word", pa.int64()), ("base", pa.list_(pa.int32()))]
    + [("blocks", pa.list_(pa.list_(pa.int32())))]
)
SCAN_SCHEMA = (
    "doc_id long, key long, n_words long, n_base long, first_word long, last_word long, base array<int>, "
    "blocks array<array<int>>"
)


def split(text: str) -> list[bytes]:
    """A text's words, A-Z in lower case."""
    return WORD.findall(text.encode().translate(bytes(LOWER)))


def hash_words(words: Sequence[bytes]) -> np.ndarray:
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    return Rolling(BYTE_VALUES[data]).slices(np.append(0, ends)[: len(ends)], ends)


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: Sequence[tuple[str, str]] = PHRASES,
    templates: Sequence[tuple] = TEMPLATES + FULL_TEXTS,
    threshold: float = THRESHOLD,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """For every row: doc_id, n_words, n_base, first_word, last_word, base_labels and labels (arrays), score.

    ``score`` is the largest share of a template's words in one block among the templates found, 1 with a phrase.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    texts = texts.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")
    sets = [
        (label, sorted(set(split(text))), [[tuple(split(form)) for form in name] for name in names])
        for label, text, *names in templates
    ]
    sets = [x for x in sets if x[1]]
    vocabulary = sorted({w for _, words, _ in sets for w in words})
    forms = sorted({form for *_, names in sets for name in names for form in name})
    lengths = [_block_length(len(split(text)), block_words) for _, text, *_ in templates if split(text)]
    levels = sorted(set(lengths))
    rank = _ranks(texts, vocabulary)
    rank_of_form = {form: len(vocabulary) + i for i, form in enumerate(forms)}
    rank_of_level = {length: len(vocabulary) + len(forms) + i for i, length in enumerate(levels)}
    rows = []
    for t, (label, words, names) in enumerate(sets):
        ranks = sorted(rank[w] for w in words)
        need = math.ceil(threshold * len(ranks) - 1e-9)
        named = [[rank_of_form[form] for form in name] for name in names] + [[rank_of_level[lengths[t]]]]
        prefix = enumerate(ranks[: len(ranks) - need + 1])
        rows += [(r, t, label, i, len(ranks), need, ranks, named) for i, r in prefix]
    index = spark.createDataFrame(
        rows, "rank int, t int, label string, i int, size int, need int, ranks array<int>, names array<array<int>>"
    )

    least = min((r[5] for r in rows), default=0)
    asked = []  # for each length of blocks: its mark, the words one of which a block needs, and how many it needs
    for length in levels:
        of_level = [r for r in rows if lengths[r[1]] == length]
        first_ranks = np.array(sorted({r[0] for r in of_level}), dtype=np.int64)
        asked.append((length, rank_of_level[length], first_ranks, min(r[5] for r in of_level)))
    order = np.array([rank[w] for w in vocabulary], dtype=np.int64)
    found = _scanned(texts, phrases, vocabulary, forms, order, asked)

    blocks = found.where("size(blocks) > 0").select("doc_id", "key", F.explode("blocks").alias("block"))
    starts = F.slice("block", F.lit(1), F.size("block") - F.lit(least - 1))
    pairs = blocks.select("doc_id", "key", "block", F.posexplode(starts).alias("j", "rank")).join(index, "rank")
    behind = F.least(F.col("size") - 1 - F.col("i"), F.size("block") - 1 - F.col("j"))
    pairs = pairs.where((F.size("block") >= F.col("need")) & (behind + 1 >= F.col("need")))
    pairs = pairs.where(F.forall("names", lambda forms: F.arrays_overlap("block", forms)))
    shared = F.size(F.array_intersect("block", "ranks"))
    pairs = pairs.select("doc_id", "key", "label", "size", "need", shared.alias("shared")).where("shared >= need")
    matches = pairs.groupBy("doc_id", "key").agg(
        F.collect_set("label").alias("matched"), F.max(F.col("shared") / F.col("size")).alias("share")
    )
    base = F.array(*[F.lit(label) for _, label in phrases]) if phrases else F.array().cast("array<string>")
    named = F.array_sort(F.array_distinct(F.transform("base", lambda i: F.get(base, i))))
    none = F.array().cast("array<string>")
    return (
        found.drop("blocks")
        .alias("f")
        .join(
            matches.alias("m"),
            F.col("f.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("f.key") == F.col("m.key")),
            "left",
        )
        .select(
            "f.doc_id", "n_words", "n_base", "first_word", "last_word", named.alias("base_labels"), "matched", "share"
        )
        .select(
            *("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"),
            F.array_sort(F.array_union("base_labels", F.coalesce("matched", none))).alias("labels"),
            F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
        )
    )


def _block_length(words: int, block_words: int) -> int:
    """``block_words``, doubled until it holds a template of so many words twice."""
    while block_words < 2 * words:
        block_words *= 2
    return block_words


def _ranks(texts: DataFrame, vocabulary: list[bytes]) -> dict[bytes, int]:
    """Each word's place in the order of frequency in the corpus, the rarest at 0."""
    hashes = hash_words(vocabulary)
    order = np.argsort(hashes)
    ordered = hashes[order]

    def count(batches):
        total = np.zeros(len(vocabulary), dtype=np.int64)
        for texts in text_chunks(batches):
            words = split_words(texts.data, texts.offsets, ALNUM_WORDS)
            seen = Rolling(BYTE_VALUES[LOWER[texts.data]]).slices(words.start, words.end)
            slot = np.minimum(np.searchsorted(ordered, seen), len(ordered) - 1)
            total += np.bincount(order[slot[ordered[slot] == seen]], minlength=len(total))
        yield pa.RecordBatch.from_pydict({"word": np.arange(len(total)), "n": total})

    counts = dict.fromkeys(range(len(vocabulary)), 0)
    if vocabulary:
        rows = texts.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
        counts |= {r.word: r.n for r in rows.collect()}  # a row for each word of the templates
    ordered_words = sorted(counts, key=lambda i: (counts[i], vocabulary[i]))
    return {vocabulary[i]: place for place, i in enumerate(ordered_words)}


def _places(seen: np.ndarray, first: np.ndarray, phrases: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Where the phrases stand whole in a text, in order, and which phrase it is."""
    where, which = [], []
    for p, phrase in enumerate(phrases):
        at = np.flatnonzero(seen[: max(0, len(seen) - len(phrase) + 1)] == phrase[0])
        for k in range(1, len(phrase)):
            at = at[seen[at + k] == phrase[k]]
        text = np.searchsorted(first, at, side="right") - 1
        where.append(at[at + len(phrase) <= first[text + 1]])
        which.append(np.full(len(where[-1]), p))
    where, which = np.concatenate([*where, []]).astype(np.int64), np.concatenate([*which, []]).astype(np.int64)
    by_place = np.argsort(where, kind="stable")
    return where[by_place], which[by_place]


def _scanned(texts, phrases, vocabulary, forms, ranks, asked) -> DataFrame:
    """Phrase places of every text, and the blocks of each length that pass the filters on a block alone."""
    by_hash = np.argsort(hash_words(vocabulary))
    hashes, ranks = hash_words(vocabulary)[by_hash], ranks[by_hash]
    n_ranks = len(vocabulary)
    phrase_hashes = [hash_words(split(phrase)) for phrase, _ in phrases]
    form_hashes = [hash_words(form) for form in forms]

    def rows(batches):
        for chunk in text_chunks(batches):
            words = split_words(chunk.data, chunk.offsets, ALNUM_WORDS)
            seen = Rolling(BYTE_VALUES[LOWER[chunk.data]]).slices(words.start, words.end)
            n = len(chunk)
            # phrases
            where, which = _places(seen, words.first, phrase_hashes)
            cut = np.searchsorted(where, words.first)
            some = cut[1:] > cut[:-1]
            first, last = np.zeros(n, np.int64), np.zeros(n, np.int64)
            first[some] = where[cut[:-1][some]] - words.first[:-1][some]
            last[some] = where[cut[1:][some] - 1] - words.first[:-1][some]
            # what templates are made of: where it stands in which text
            slot = np.minimum(np.searchsorted(hashes, seen), max(0, len(hashes) - 1))
            known = np.flatnonzero(hashes[slot] == seen) if len(hashes) else np.zeros(0, np.int64)
            word_rank = ranks[slot[known]]
            at, form = _places(seen, words.first, form_hashes)
            known, word_rank = np.append(known, at), np.append(word_rank, n_ranks + form)
            text = np.searchsorted(words.first, known, side="right") - 1
            place = known - words.first[text]
            found = [_blocks(text, place, word_rank, *level) for level in asked]
            empty = np.zeros(0, np.int64)
            text, size, word_rank = (np.concatenate([empty, *(f[i] for f in found)]) for i in range(3))
            ends = np.append(0, np.cumsum(size))
            order = np.argsort(text, kind="stable")
            lists = pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(word_rank.astype(np.int32)))
            blocks = pa.ListArray.from_arrays(
                np.searchsorted(text[order], np.arange(n + 1)).astype(np.int32), lists.take(pa.array(order))
            )
            yield record_batch(
                _SCAN,
                [
                    *chunk.rows.columns,
                    np.diff(words.first),
                    np.diff(cut),
                    pa.array(first, mask=~some),
                    pa.array(last, mask=~some),
                    pa.ListArray.from_arrays(cut.astype(np.int32), pa.array(which.astype(np.int32))),
                    blocks,
                ],
            )

    return texts.mapInArrow(rows, SCAN_SCHEMA)


def _blocks(text: np.ndarray, place: np.ndarray, rank: np.ndarray, length: int, mark: int, first_ranks: np.ndarray, least: int):
    """Text, size and ranks of the blocks of one length that hold ``least`` different ranks, one of ``first_ranks``.

    A block's ranks rise and end with the mark of its length.
    """
    half = length // 2
    stretch = place // half
    both = [np.append(x, x[stretch > 0]) for x in (text, rank)]
    block = np.append(stretch, stretch[stretch > 0] - 1)
    order = np.lexsort((both[1], block, both[0]))
    text, rank, block = both[0][order], both[1][order], block[order]
    new = np.append(True, (np.diff(text) != 0) | (np.diff(block) != 0))[: len(text)]
    once = new | np.append(True, np.diff(rank) != 0)[: len(text)]
    text, rank, new = text[once], rank[once], new[once]
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, len(text)))
    good = size >= least
    if len(head):
        good &= np.logical_or.reduceat(np.isin(rank, first_ranks), head)
    ends = np.cumsum(size[good])
    return text[head[good]], size[good] + 1, np.insert(rank[np.repeat(good, size)], ends, mark)
