"""A training corpus from raw documents: toxic texts go, one of each group of near copies stays,
benchmark leaks go, sources are mixed to their targets, and the rest is dealt to shards.

Defined cases of every stage: a null or empty text is ordinary, no copy of another, clean, and of size 0
(mixing takes such documents in whole passes and below its thresholds like others); rows without id stay through the first
three stages; equal rows are copies of each other, of which one stays; rows that share an id are one
document for the near duplicates; a null source is a source of its own; further columns pass through,
and where one is called ``shard`` or ``virtual_slot`` the new ones get an underscore; without labels of both
kinds every score is the share of toxic ones; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxlake.llm import decontamination, mixing, neardup, sharding, toxicity
from voxlake.llm.common import Scratch, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression-distance model does not reject; it learns from the labels of this input."""
    return toxicity.keep_ordinary(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component at a similarity of 0.8 by 5-word shingles."""
    return neardup.keep_one(docs, n=5, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item, exact or edited."""
    return decontamination.decontaminate_documents(spark, docs, sf_dir)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: sources weigh 3, 1, 2 and share 150 % of all words, at most twice their own."""
    return mixing.mix_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their virtual slot and shard."""
    return sharding.shard_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: SQL can't express zstandard, Smith-Waterman and similarity components; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written to the shared folder and read again by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), str(k))
        if k:
            scratch.drop(str(k - 1))
    return docs
