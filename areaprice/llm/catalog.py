"""One query per corpus operator over the whole ``documents`` table, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chunks, exact_dedup, language, maxent, mixing, packing, pii, quality, repeats, resampling, simhash, spelling, token_counts
from .oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file of this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_simhash_near_dedup(spark, sf_dir):
    found = simhash.near_components(documents(spark, sf_dir).select("doc_id", "text"), shingle=4, max_bits=4)
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("row.doc_id", digits.alias("fingerprint"), "component_id")


@query
def op2_best_fit_packing(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    pieces = packing.tokenized_pieces(docs, vocabulary("byte_bpe_50k.json"), end_id=2, capacity=1024, keep_ids=False)
    digest = pieces.select("row.doc_id", "piece", "start", "length", "ids_crc32")
    return packing.pack(digest, capacity=1024)


@query
def op3_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir)
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    docs = docs.select("doc_id", "text", "lang", (F.crc32(id_text.cast("binary")) % 3 == 1).alias("held_out"))
    model = language.learn(docs.where(~F.col("held_out")))
    return language.predict(docs.drop("lang"), model).select("row.doc_id", "row.held_out", "lang_pred", "score")


@query
def op4_personal_data(spark, sf_dir):
    found = pii.find_personal_data(documents(spark, sf_dir).select("doc_id", "text"))
    base = [kind.name for kind in pii.KINDS if kind.base]
    counts = [F.size(pii.of_kinds([name])).cast("long").alias(f"n_{name}") for name in base]
    return found.select(
        "row.doc_id",
        *counts,
        F.sha2(pii.span_text(pii.of_kinds(base)), 256).alias("base_sha256"),
        pii.span_text(F.col("spans")).alias("spans"),
    )


@query
def op5_quality_rules(spark, sf_dir):
    found = quality.judged(documents(spark, sf_dir).select("doc_id", "lang", "text"))
    return found.select("row.doc_id", *quality.COUNTS, "base_failed", "kept")


@query
def op6_token_counts(spark, sf_dir):
    counted = token_counts.token_counts(documents(spark, sf_dir).select("doc_id", "text"), vocabulary("piece_bpe_32k.model"))
    return counted.select("row.doc_id", "n_words", "n_tokens")


@query
def op7_suffix_array_dedup(spark, sf_dir):
    cut = repeats.drop_repeats(documents(spark, sf_dir).select("doc_id", "text"), length=400, shorter=200)
    return cut.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "n_repeated")


@query
def op8_exact_dedup(spark, sf_dir):
    groups = exact_dedup.exact_groups(documents(spark, sf_dir), keep="largest")
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query
def op9_source_mixing(spark, sf_dir):
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


@query
def op10_substring_dedup(spark, sf_dir):
    cut = chunks.dedup_substrings(documents(spark, sf_dir).select("doc_id", "text"))
    return cut.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_spelling_variants(spark, sf_dir):
    words = spelling.word_counts(documents(spark, sf_dir), min_chars=7, min_count=2, damage=31)
    return spelling.spelling_groups(words, factor=10).select("word", "form", "root", "n", "n_near", "form_n")


@query
def op12_importance_resampling(spark, sf_dir):
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text")
    drawn = resampling.resample(documents(spark, sf_dir).select("doc_id", "text"), target, percent=10, seed=2024)
    return drawn.select("row.doc_id", "n_features", "weight", "score", "rank")


@query
def op13_lm_scoring(spark, sf_dir):
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    learned = F.crc32(id_text.cast("binary")) % 7 != 2
    scored = maxent.lm_scores(documents(spark, sf_dir).select("doc_id", "text"), learned)
    return scored.select("row.doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
