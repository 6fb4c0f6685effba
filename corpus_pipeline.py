"""From raw documents to segmented training text, in five stages.

Each stage takes all that the one before it kept and returns the columns of
``documents``; the last returns pieces.  Every stage defines its result for null
and empty texts, repeated rows and empty tables as its operator does; columns
beside ``doc_id``, ``text`` and ``source`` pass through unread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm import exact_dedup, minhash, mixing, pieces, toxicity
from palimpsest.llm.queries import MODEL, TOXIC, toxicity_index
from palimpsest.session import materialized

SHINGLE_WORDS, SIMILARITY, SEGMENTATIONS = 5, 80, 2
#: Words of an output shard, a few megabytes of text: the next stage has a task for each.  The driver holds a quota for every
#: (source, shard), so tables of many terabytes take larger shards.
SHARD_WORDS = 1_000_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold."""
    return toxicity.accepted_rows(docs, toxicity_index(spark, docs, sf_dir), TOXIC)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (but for white space) the row with the smallest id."""
    return exact_dedup.kept_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates."""
    return minhash.kept_rows(docs, size=SHINGLE_WORDS, share=SIMILARITY)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every drawn copy, in shards."""
    return mixing.mix(docs, shard_words=SHARD_WORDS).select(*[F.col(f"`{c}`") for c in docs.columns])


def segment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, the ids of the best segmentation and of the second best, their scores."""
    rows = pieces.encode(docs.select("doc_id", "source", "lang", "text"), "text", pieces.load(MODEL), SEGMENTATIONS)
    of = lambda i, name: F.try_element_at("nbest", F.lit(i))[name]
    return rows.select("doc_id", "source", "lang", of(1, "ids").alias("ids"), of(1, "score").alias("score"),
                       of(2, "ids").alias("second_ids"), of(2, "score").alias("second_score"))


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("near dedup", drop_near_copies), ("mixing", mix_sources),
          ("pieces", segment)]

#: SQL expresses neither the neighbours' votes nor the segmentation; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialized(docs)
    return docs
