"""The corpus pipeline: quality rules, exact and near duplicates, mixing of sources, packing into sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areaprice.checks.session import ensure_shared_folder
from areaprice.llm import exact_dedup, mixing, packing, quality, simhash
from areaprice.llm.catalog import vocabulary
from areaprice.scratch import scratch_path

# Mixing draws documents and cuts them by seeded hashes, and packing needs a tokenizer: SQL can't express these.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    ensure_shared_folder(spark)
    return quality.keep_good(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with the same text but for the case of A-Z, that with the largest id."""
    ensure_shared_folder(spark)
    return exact_dedup.drop_exact(docs, keep="largest")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of close fingerprints, that with the smallest id."""
    ensure_shared_folder(spark)
    return simhash.drop_near(docs, shingle=4, max_bits=4)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often and as far as the mix takes them."""
    ensure_shared_folder(spark)
    return mixing.mixed_rows(docs, mixing.mix(docs), computed={"n_chars": lambda text: F.char_length(text).cast("long")})


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their ids and their places in the packed sequences."""
    ensure_shared_folder(spark)
    pieces = packing.tokenized_pieces(docs.select("doc_id", "text"), vocabulary("byte_bpe_50k.json"))
    return packing.pack(pieces.select("row.doc_id", "piece", "start", "length", "ids", "ids_crc32"))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_duplicates),
    ("simhash_near_dedup", near_duplicates),
    ("source_mixing", source_mixing),
    ("best_fit_packing", sequence_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written as Parquet and read back by the next."""
    ensure_shared_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        path = scratch_path(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
