"""From raw documents to token ids: five stages, each written before the next reads it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeline.llm import byte_bpe, chunk_dedup, dart_minhash, source_schedule, toxicity_mil
from gaugeline.llm.tables import discard, documents, unused, written


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the toxicity model accepts."""
    return toxicity_mil.accepted(docs, toxicity_mil.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the smallest doc_id. Rows that repeat it stay if their
    texts differ; of rows with its doc_id and text the one smallest by the other columns, in their order, stays,
    maps by their JSON. Rows without doc_id stay."""
    kept = dart_minhash.near_duplicates(docs).where("kept and doc_id is not null").select("doc_id").distinct()
    chosen = docs.join(kept, "doc_id", "left_semi")
    text, rank = unused(docs, "text_digest", "row_rank")
    others = [_ordered(docs, c) for c in docs.columns if c not in ("doc_id", "text")]
    # Both the join and the ranks go by doc_id: the texts are dealt once and are no key.
    own = Window.partitionBy("doc_id", text).orderBy(*others, F.lit(0))
    chosen = chosen.withColumn(text, F.sha2(F.col("text").cast("string"), 256)).withColumn(rank, F.row_number().over(own)).where(F.col(rank) == 1)
    names = [f"`{c}`" for c in docs.columns]
    return chosen.select(*names).unionByName(docs.where("doc_id is null"))


def _ordered(docs: DataFrame, column: str) -> Column:
    kind = docs.schema[column].dataType.simpleString()
    whole = F.to_json(F.struct(f"`{column}`")) if "map<" in kind or "variant" in kind else F.col(f"`{column}`")
    return whole.asc_nulls_first()


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that an earlier one has; ``n_chars`` follows the text."""
    rest, = unused(docs, "other_columns")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    # The others go as one column, which no column of the operator's own can clash with.
    clean = chunk_dedup.remove_repeats(docs.select("doc_id", "text", F.struct(*[f"`{c}`" for c in others]).alias(rest)))
    column = {c: F.col(rest)[c] for c in others} | {"doc_id": F.col("doc_id"), "text": F.col("clean_text")}
    if "n_chars" in others:
        column["n_chars"] = F.coalesce(F.length("clean_text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
    return clean.select(*[column[c].alias(c) for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return source_schedule.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the texts' ids and of the decoded bytes."""
    return byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES = [
    ("toxicity", toxicity), ("near duplicates", near_duplicates), ("repeated passages", repeated_passages),
    ("mixing", mixing), ("tokens", tokens),
]

#: SQL cannot train the first stage's model, nor cut content-defined chunks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other. A stage's table is deleted when the next one is written; the last stays."""
    docs, old = documents(spark, sf_dir), []
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"), new := [])
        discard(spark, old)
        old = new
    return docs
