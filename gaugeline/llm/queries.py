"""The operators applied to their whole tables, by registered name."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from gaugeline.llm import (
    byte_bpe, chunk_dedup, compression_bands, dart_minhash, heap_bpe, periodic_runs, preference, prefix_trie,
    pseudo_likelihood, simple8b, source_schedule, spherical_caps, toxicity_mil,
)
from gaugeline.llm.tables import documents


def op1_spherical_caps(spark: SparkSession, folder: str) -> DataFrame:
    return spherical_caps.similarity_join(spark.read.parquet(f"{folder}/embeddings.parquet"))


def op2_dart_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return dart_minhash.near_duplicates(documents(spark, folder))


def op3_pseudo_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return pseudo_likelihood.score(docs, *pseudo_likelihood.fit(docs))


def op4_chunk_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = chunk_dedup.remove_repeats(documents(spark, folder).select("doc_id", "text"))
    return found.select("doc_id", "n_chunks", "n_removed", "removed_words", "removed_spans", "first_docs",
                        F.sha2("clean_text", 256).alias("clean_sha256"))


def op5_preference(spark: SparkSession, folder: str) -> DataFrame:
    return preference.format_pairs(preference.sibling_pairs(spark.read.parquet(f"{folder}/conversations.parquet"))).select(
        "pair_id", "n_prompt_turns", "prompt", "chosen", "rejected", F.to_json("chosen_spans").alias("chosen_spans"), F.to_json("rejected_spans").alias("rejected_spans"))


def op6_source_schedule(spark: SparkSession, folder: str) -> DataFrame:
    return source_schedule.taken_words(documents(spark, folder))


def op7_compression_bands(spark: SparkSession, folder: str) -> DataFrame:
    return compression_bands.judge(documents(spark, folder))


def op8_toxicity_mil(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    model = toxicity_mil.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return toxicity_mil.score(docs, model)


def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.round_trip(documents(spark, folder), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op10_simple8b(spark: SparkSession, folder: str) -> DataFrame:
    return simple8b.digests(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.collapse(periodic_runs.planted(documents(spark, folder))))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = spark.read.parquet(f"{folder}/conversations.parquet")
    return prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.paths(turns))).drop("turn_id")


def op13_heap_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return heap_bpe.round_trip(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {f.__name__: f for f in (
    op1_spherical_caps, op2_dart_minhash, op3_pseudo_likelihood, op4_chunk_dedup, op5_preference, op6_source_schedule,
    op7_compression_bands, op8_toxicity_mil, op9_byte_bpe, op10_simple8b, op11_periodic_runs, op12_prefix_trie,
    op13_heap_bpe)} | {"pipeline": corpus_pipeline.run}
