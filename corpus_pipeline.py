"""The corpus pipeline: toxic documents go, near duplicates go, repeated passages go, the rest is packed.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read
again as the next stage's `docs`. All but the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.llm import ngram_join, packing, substrings, toxicity
from civiclake.session import BATCHES, tune
from civiclake.sources.scratch import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the limit go; the field learns from the labels outside the held-out third.

    Rows with a null id or text stay: nothing is known of them that a score could rest on.
    """
    tune(spark, BATCHES)
    field = toxicity.train(toxicity.training_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    judged = F.col("doc_id").isNotNull() & F.col("text").isNotNull()
    rest = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("rest")
    scored = toxicity.score(docs.where(judged).select(rest, "text"), field, key="rest", with_text=True)
    kept = scored.where(F.col("score") < toxicity.TOXIC).select(*("text" if c == "text" else F.col(f"rest.`{c}`") for c in docs.columns))
    return kept.union(docs.where(~judged))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays, the one with the smallest id.

    Rows that repeat both id and text are one document. Rows with a null id or without words stay.
    """
    tune(spark, BATCHES)
    groups = ngram_join.near_duplicates(docs)
    kept = groups.where("doc_id = component_id").select(F.col("doc_id").alias("id"), F.col("version").alias("v"))
    named = docs.where("doc_id is not null").withColumn("v", F.xxhash64("text"))
    one = named.join(kept, (named["doc_id"] == kept["id"]) & (named["v"] == kept["v"]), "left_semi").dropDuplicates(["doc_id", "v"])
    return one.select(*(F.col(f"`{c}`") for c in docs.columns)).union(docs.where("doc_id is null"))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in 50-word windows that an earlier document has are removed; `n_chars` follows the text.

    Documents that lose all their words go; those that had none before stay.
    """
    tune(spark, BATCHES)
    cut = substrings.dedup_texts(docs, drop_emptied=True)
    return cut.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))).select(
        *(F.col(f"`{c}`").cast(docs.schema[c].dataType) for c in docs.columns)
    )


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    tune(spark, BATCHES)
    return packing.pack(
        docs,
        public_tokenizers.path("byte_bpe_50k.json"),
        ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"),
        pattern=public_tokenizers.PATTERN,
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("substring dedup", cut_repeated_passages),
    ("packing", pack),
]

#: The first stage learns its decisions, so SQL cannot state the result.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
