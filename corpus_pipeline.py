"""A corpus pipeline: toxicity, near duplicates, benchmark decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fanpulse.llm import decontaminate, hilbert_shards, jaccard_join, mixing, toxicity
from fanpulse.llm.common import bounded_batches, scratch_path, table

TOXIC_FROM = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under ``TOXIC_FROM``; the lexicon is learned from the labelled rows."""
    bounded_batches(spark)
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~toxicity.held_out()))
    return toxicity.score(docs, lexicon, score_col="__score").where(F.col("__score") < TOXIC_FROM).select(*docs.columns)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of linked documents."""
    return jaccard_join.representatives(docs).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' words taken to the sources' targets: a row per document and run over its source."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and slot along the Hilbert curve."""
    return hilbert_shards.shard_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", one_of_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Hash draws, learned weights and Jaccard components have no SQL form: tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = scratch_path(spark, f"stage-{name}")
            out.write.parquet(path)
            out = spark.read.parquet(path)
        docs = out
    return docs
