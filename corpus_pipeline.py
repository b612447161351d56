"""The corpus pipeline: stages that take documents and hand on what they keep.

Every stage handles null texts, ids and labels, empty tables, repeated rows and extra columns as its operator defines.
All but the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.llm import minhash, phrase_index, pieces, suffix_repeats, toxicity
from fleetgauge.llm.queries import PIECE_MODEL, table
from fleetgauge.llm.scratch import Scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    scored = toxicity.with_row(docs, table(spark, sf_dir, "labels"))
    return scored.where(F.col(toxicity.SCORE) < 0.5).select(*(F.col(f"row.`{c}`") for c in docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of smallest id."""
    return minhash.keep_first(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its text without strings of 200 bytes that stand elsewhere, whole characters only.

    A null text becomes empty; ``n_chars`` follows the text. All columns keep their types.
    """
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    cut = suffix_repeats.remove_repeats(docs, whole_chars=True, carry=others)
    text = F.col("kept").cast("string")
    values = {"text": text} | {f.name: F.length(text).cast(f.dataType) for f in docs.schema if f.name == "n_chars"}
    return cut.select(*(values[c].alias(c) if c in values else F.col(f"carried.`{c}`") for c in docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words stand in passages of the benchmark."""
    return phrase_index.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Distinct sampled segmentations of every document, as piece ids."""
    return pieces.encode(docs, PIECE_MODEL)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode),
]

#: The stages train a classifier and draw samples, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
