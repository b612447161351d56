"""Registered queries of the corpus operators: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    dimension_scan,
    hard_negatives,
    licences,
    minhash,
    neighbours,
    phrase_index,
    pieces,
    reference_parse,
    shards,
    suffix_repeats,
    toxicity,
    warc,
    whitening,
)
from .scratch import Scratch, prepare

#: Where the tokenizer's files lie on every machine.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrase_index.match(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        phrase_index.is_contaminated().alias("contaminated"),
    )


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reference_parse.remove_copied(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(table(spark, sf_dir, "documents"))
    return found.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")})


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign(table(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neighbours.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", "component_id", "kept")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.write(table(spark, sf_dir, "pages"), Scratch(spark, "warc"))
    records = warc.read(archive)
    return records.select(
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        warc.base32_sha1(F.col("payload")).alias("payload_digest"),
        "record_type",
        "refers_to",
        "verified",
    )


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, similarity=85, bands=26, rows=5)


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimension_scan.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors, F.col("vec_id") % 50 == 0, label=label)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    operators = (
        *(op1_toxicity, op2_suffix_dedup, op3_decontamination, op4_substring_dedup, op5_license_scan),
        *(op6_sharding, op7_sentencepiece, op8_embedding_dedup, op9_warc, op10_minhash),
        *(op11_nearest_neighbours, op12_hard_negatives, op13_whitening),
    )
    return {f.__name__: f for f in operators}


def oracle_sql() -> dict[str, str]:
    from .sql import ORACLE_SQL

    return ORACLE_SQL
