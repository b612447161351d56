"""Toxicity scores: gradient-boosted trees over dense features of whole texts, with isotonic calibration.

Features: densities of lexicon entries of two strengths, the sum of their weights, second-person words and how near
lexicon entries stand to them, capitals, punctuation, and obfuscated words (letters mixed with digits or signs, or one
letter drawn out). The lexicon is learned: entries are words and word starts of 4, 5 and 6 bytes, weighted by the log
odds of toxic against other training texts; a short list of insults is always in it. Training rows see a lexicon of the other half of the rows, so that the
trees do not learn to trust entries that only a row's own copies support. Trees are fitted to three quarters of the
rows, the calibration to the rest.

Training takes at most about ``MAX_TRAINING`` labelled rows, chosen by hash; everything else sees all rows. Scores
depend on the text alone.

Defined cases: a null text is empty and gets a score like any other; rows without a label, or with one that is neither
0 nor 1, are not trained on, and of rows of one id and text one is; without labelled rows of both kinds every score is
the share of toxic ones, 0 without any.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import ALNUM_WORDS, BYTE_VALUES, LOWER, Rolling, record_batch, split_words, text_chunks
from .scratch import Scratch

MAX_TRAINING = 20_000
LEXICON_SIZE = 5_000
LEXICON_ROWS = 4
LEXICON_WEIGHT = 1.5
STRONG_WEIGHT = 3.0
STARTS = (4, 5, 6)
NEAR_WORDS = 8

# Second-person words.
SECOND_PERSON = (
    *("you", "your", "yours", "yourself", "u", "ur"),
    *("du", "dich", "dir", "dein", "deine", "ihr", "euch", "euer"),
    *("tu", "toi", "te", "ton", "ta", "tes", "vous", "votre", "vos"),
    *("tú", "ti", "usted", "ustedes", "vosotros", "vuestro"),
)

# Insults that every lexicon has, and their weight.
SEED_LEXICON = (
    *("idiot", "moron", "stupid", "dumb", "loser", "scum", "trash", "pathetic", "worthless", "disgusting", "clown"),
    *("jerk", "creep", "fool", "vermin", "filth"),
    *("dumm", "trottel", "arschloch", "abschaum", "depp"),
    *("imbécile", "connard", "crétin", "ordure"),
    *("estúpido", "imbécil", "escoria", "basura"),
)
SEED_WEIGHT = 4.0

#: The column that ``with_score`` adds.
SCORE = "toxicity_score"

FEATURES = (
    *("strong_density", "any_density", "start_density", "weight_density", "strong_count", "any_count"),
    *("second_person", "near_second_person", "capitals", "shouted", "punctuation", "exclamation"),
    *("mixed_words", "drawn_out", "length"),
)


@dataclass
class Lexicon:
    """Hashes of entries in ascending order, and their weights."""

    hashes: np.ndarray
    weights: np.ndarray

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """Each hash's weight, 0 for what is no entry."""
        if not len(self.hashes):
            return np.zeros(len(hashes))
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.weights[at], 0.0)


def fold(doc_id: Column) -> Column:
    """The remainder that says whether a row is held out (0)."""
    return F.crc32(doc_id.cast("string")) % 5


def score(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    label_id_col: str = "doc_id",
    max_training: int = MAX_TRAINING,
    trees: int = 20,
    depth: int = 4,
) -> DataFrame:
    """For every row: doc_id, held_out, score and predicted."""
    scored = with_row(docs, labels, id_col, text_col, label_col, label_id_col, max_training, trees, depth)
    doc_id = F.col(f"row.`{id_col}`").cast("long")
    return scored.select(
        doc_id.alias("doc_id"),
        F.coalesce(fold(doc_id) == 0, F.lit(False)).alias("held_out"),
        F.col(SCORE).alias("score"),
        (F.col(SCORE) >= 0.5).cast("int").alias("predicted"),
    )


def with_score(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    label_id_col: str = "doc_id",
    max_training: int = MAX_TRAINING,
    trees: int = 20,
    depth: int = 4,
) -> DataFrame:
    """``docs``, all columns, with the column ``SCORE``; a column of that name in ``docs`` gives way to it."""
    scored = with_row(docs, labels, id_col, text_col, label_col, label_id_col, max_training, trees, depth)
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c.lower() != SCORE]
    return scored.select(*kept, SCORE)


def with_row(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    label_id_col: str = "doc_id",
    max_training: int = MAX_TRAINING,
    trees: int = 20,
    depth: int = 4,
) -> DataFrame:
    """Each row of ``docs`` as the struct ``row``, and its ``SCORE``: so no column of the input can clash."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    model = _train(texts, _labelled(labels, label_id_col, label_col), max_training, trees, depth, scratch)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(f"`{text_col}`").alias("text"))
    return model.apply(features(rows, model.lexicon)).select("row", F.col("score").alias(SCORE))


def _labelled(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    rows = labels.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("y")
    )
    rows = rows.where((fold(F.col("doc_id")) != 0) & F.col("y").isin(0, 1))
    return rows.groupBy("doc_id").agg(F.max("y").alias("y"))


@dataclass
class Model:
    """A lexicon, trees and a calibration; without trees, one score for all."""

    lexicon: Lexicon
    trees: object
    calibration: object
    share: float

    def apply(self, rows: DataFrame) -> DataFrame:
        if self.trees is None:
            return rows.withColumn("score", F.lit(self.share))
        scored = _raw(self.trees, rows)
        if self.calibration is None:
            return scored.withColumnRenamed("raw", "score")
        scored = self.calibration.transform(scored)
        return scored.withColumn("score", F.least(F.greatest("calibrated", F.lit(0.0)), F.lit(1.0)))


def _raw(trees, rows: DataFrame) -> DataFrame:
    scored = trees.transform(rows.withColumn("features", array_to_vector("x")))
    return scored.withColumn("raw", F.get(vector_to_array("probability"), F.lit(1)))


def _train(texts, labelled, max_training, trees, depth, scratch) -> Model:
    n = labelled.count()
    step = 1 << 20
    sampled = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(step)) < step * min(1.0, max_training / max(1, n)))
    # at most about max_training rows of two numbers
    rows = texts.join(F.broadcast(sampled), "doc_id").withColumn("key", F.xxhash64("text"))
    # one id may have any number of texts, so texts are counted, and bounded, too
    n_texts = rows.select("doc_id", "key").distinct().count()
    if n_texts > max_training:
        rows = rows.where(F.pmod(F.xxhash64("key", "doc_id"), F.lit(step)) < step * (max_training / n_texts))
    rows = rows.groupBy("doc_id", "key").agg(F.first("text").alias("text"), F.max("y").alias("y"))
    rows = scratch.keep(rows, "training")
    half = F.pmod(fold(F.col("doc_id")), F.lit(2))
    counts = rows.groupBy(half.alias("half"), "y").agg(F.count("*").alias("n")).collect()  # four rows at most
    by_half = [{r.y: r.n for r in counts if r.half == i} for i in (0, 1)]
    sizes = {y: sum(part.get(y, 0) for part in by_half) for y in {r.y for r in counts}}
    share = sizes.get(1, 0) / max(1, sum(sizes.values()))
    empty = Lexicon(np.zeros(0, np.uint64), np.zeros(0))
    if len(sizes) < 2:
        return Model(empty, None, None, share)
    halves = [rows.where(half == i) for i in (0, 1)]
    marked = scratch.keep(entries(rows.withColumn("half", half)), "entries")
    lexicons = [_lexicon(marked.where(F.col("half") == 1 - i), by_half[1 - i]) for i in (0, 1)]
    seen = [features(part, lexicon) for part, lexicon in zip(halves, lexicons, strict=True)]
    known = scratch.keep(seen[0].unionByName(seen[1]).select("doc_id", "x", F.col("y").cast("double").alias("y")), "features")
    for_calibration = F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(4)) == 0
    fitted, held = known.where(~for_calibration), known.where(for_calibration)
    if fitted.select("y").distinct().count() < 2:
        fitted = known
    fit = GBTClassifier(
        featuresCol="features", labelCol="y", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=7, cacheNodeIds=False
    ).fit(fitted.withColumn("features", array_to_vector("x")))
    calibration = None
    if held.select("y").distinct().count() == 2:
        calibration = IsotonicRegression(
            featuresCol="raw", labelCol="y", predictionCol="calibrated", isotonic=True
        ).fit(_raw(fit, held).select("raw", "y"))
    return Model(_lexicon(marked, sizes), fit, calibration, share)


_ENTRIES = pa.schema([("entry", pa.int64()), ("half", pa.int64()), ("y", pa.int64()), ("n", pa.int64())])


def entries(rows: DataFrame) -> DataFrame:
    """How many training rows (text, y, half) have each word or word start."""

    def run(batches):
        for texts in text_chunks(batches):
            words = split_words(texts.data, texts.offsets, ALNUM_WORDS)
            text = words.text_of()
            found, owner = [], []
            for hashes, which in _entry_hashes(texts.data, words):
                found.append(hashes)
                owner.append(text[which])
            found, owner = np.concatenate(found), np.concatenate(owner)
            order = np.lexsort((found, owner))
            found, owner = found[order], owner[order]
            new = np.append(True, (found[1:] != found[:-1]) | (owner[1:] != owner[:-1]))[: len(found)]
            found, owner = found[new].view(np.int64), owner[new]
            half, y = texts.column("half").astype(np.int64)[owner], texts.column("y").astype(np.int64)[owner]
            yield record_batch(_ENTRIES, [found, half, y, np.ones(len(found), np.int64)])

    each = rows.select("half", "y", "text").mapInArrow(run, "entry long, half long, y long, n long")
    return each.groupBy("entry", "half").agg(F.sum("y").alias("toxic"), F.sum("n").alias("n")).where("toxic > 1")


def _lexicon(marked: DataFrame, sizes: dict[int, int]) -> Lexicon:
    """At most ``LEXICON_SIZE`` entries, those that speak for toxic texts most often and most clearly.

    ``sizes`` has the number of training rows of each label.
    """
    sums = marked.groupBy("entry").agg(*(F.sum(c).alias(c) for c in ("toxic", "n")))
    other = F.col("n") - F.col("toxic")
    weight = F.log((F.col("toxic") + 0.5) / (sizes.get(1, 0) + 1)) - F.log((other + 0.5) / (sizes.get(0, 0) + 1))
    best = (
        sums.withColumn("weight", weight)
        .where((F.col("weight") >= LEXICON_WEIGHT) & (F.col("toxic") >= LEXICON_ROWS))
        .orderBy(F.desc(F.col("weight") * F.col("toxic")), "entry")
        .limit(LEXICON_SIZE)
        .select("entry", "weight")
        .collect()
    )
    best.sort(key=lambda r: r.entry % (1 << 64))
    hashes = np.array([r.entry for r in best], dtype=np.int64).view(np.uint64)
    return seeded(Lexicon(hashes, np.array([r.weight for r in best], dtype=np.float64)))


def seeded(lexicon: Lexicon) -> Lexicon:
    """The lexicon with the fixed entries; a larger learned weight stays."""
    seeds = _hash_of(SEED_LEXICON)
    hashes = np.union1d(lexicon.hashes, seeds)
    return Lexicon(hashes, np.maximum(lexicon.of(hashes), np.where(np.isin(hashes, seeds), SEED_WEIGHT, 0.0)))


def _entry_hashes(data: np.ndarray, words) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the words, and of their starts, each with the words they belong to."""
    rolling = Rolling(BYTE_VALUES[LOWER[data]])
    out = [(rolling.slices(words.start, words.end), np.arange(len(words.start)))]
    for size in STARTS:
        longer = np.flatnonzero(words.end - words.start > size)
        # a start is no word of the same bytes
        out.append((~rolling.slices(words.start[longer], words.start[longer] + size), longer))
    return out


def _hash_of(words: tuple[str, ...]) -> np.ndarray:
    data = [w.encode() for w in words]
    ends = np.cumsum([len(w) for w in data])
    values = BYTE_VALUES[np.frombuffer(b"".join(data), dtype=np.uint8)]
    return np.sort(Rolling(values).slices(np.append(0, ends[:-1]), ends))


_UPPER = np.array([0x41 <= b <= 0x5A for b in range(256)])
_LETTER = np.array([chr(b).isalpha() or b >= 0x80 for b in range(256)])
_DIGIT = np.array([0x30 <= b <= 0x39 for b in range(256)])
_SPACE = np.array([b <= 0x20 for b in range(256)])
_LOUD = np.array([b in b"!?" for b in range(256)])
_SIGNS = np.array([b in b"@$*#!" for b in range(256)])


def features(texts: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``texts`` with the features of its column ``text`` as the column ``x``."""

    def run(text: pa.Array) -> pa.Array:
        second = _hash_of(SECOND_PERSON)
        batch = pa.RecordBatch.from_arrays([text], names=["text"])
        parts = [_features_of(c.data, c.offsets, lexicon, second) for c in text_chunks([batch])]
        x = np.concatenate([np.zeros((0, len(FEATURES))), *parts])
        offsets = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
        return pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))

    return texts.withColumn("x", F.arrow_udf(run, "array<double>")("text"))


def _features_of(data: np.ndarray, offsets: np.ndarray, lexicon: Lexicon, second: np.ndarray) -> np.ndarray:
    words = split_words(data, offsets, ALNUM_WORDS)
    n_words = np.diff(words.first).astype(np.float64)
    sums = lambda flags, cuts: np.diff(np.concatenate([[0], np.cumsum(flags)])[cuts]).astype(np.float64)
    per_word = lambda flags: sums(flags, words.first)
    per_byte = lambda flags: sums(flags, offsets)
    (whole, _), *starts = _entry_hashes(data, words)
    weight = lexicon.of(whole)
    start_weight = np.zeros(len(whole))
    for hashes, which in starts:
        start_weight[which] = np.maximum(start_weight[which], lexicon.of(hashes))
    best = np.maximum(weight, start_weight)
    person = np.zeros(len(whole), dtype=bool)
    if len(whole):
        person = second[np.minimum(np.searchsorted(second, whole), len(second) - 1)] == whole
    # distance to the nearest second-person word, within the text
    near = np.zeros(len(whole), dtype=bool)
    at = np.flatnonzero(person)
    if len(at):
        text = words.text_of()
        place = np.arange(len(whole))
        slot = np.searchsorted(at, place)
        for other in (at[np.maximum(slot - 1, 0)], at[np.minimum(slot, len(at) - 1)]):
            near |= (np.abs(other - place) <= NEAR_WORDS) & (text[other] == text)
    of_word = lambda table: np.diff(
        np.concatenate([[0], np.cumsum(table[data])])[np.stack([words.start, words.end])], axis=0
    )[0]
    size, upper, digits = words.end - words.start, of_word(_UPPER), of_word(_DIGIT)
    last = np.minimum(words.end, max(0, len(data) - 1))
    signed = _SIGNS[data[last]] & _LETTER[data[np.minimum(last + 1, max(0, len(data) - 1))]] if len(data) else size > 0
    same = np.zeros(len(data), dtype=np.int64)
    same[2:] = (data[2:] == data[1:-1]) & (data[2:] == data[:-2]) & _LETTER[data[2:]]
    drawn = np.diff(np.concatenate([[0], np.cumsum(same)])[np.stack([words.start, words.end])], axis=0)[0] > 0
    letters, visible = per_byte(_LETTER[data]), per_byte(~_SPACE[data])
    share = lambda part, of: part / np.maximum(of, 1.0)
    strong, some = best >= STRONG_WEIGHT, best > 0
    return np.column_stack(
        [
            share(per_word(strong), n_words),
            share(per_word(some), n_words),
            share(per_word(start_weight > 0), n_words),
            share(per_word(best), n_words),
            np.log1p(per_word(strong)),
            np.log1p(per_word(some)),
            share(per_word(person), n_words),
            share(per_word(some & near), n_words),
            share(per_byte(_UPPER[data]), letters),
            share(per_word((upper == size) & (size > 1)), n_words),
            share(per_byte(~(_LETTER | _DIGIT | _SPACE)[data]), visible),
            share(per_byte(_LOUD[data]), visible),
            share(per_word(((digits > 0) & (digits < size)) | signed), n_words),
            share(per_word(drawn), n_words),
            np.log1p(n_words),
        ]
    )
