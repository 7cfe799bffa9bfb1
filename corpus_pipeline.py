"""From raw documents to packed training sequences: five stages, each calling one operator.

Every stage works on all rows that its predecessor kept and returns the columns of ``documents``; the
last one returns a row per packed piece. Null and empty texts are judged like others (the quality
model gives them a score), stay without words, are one near-duplicate group, and pack as a separator alone.
An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfold.llm import decontamination, packing, quality, secrets, simhash
from docfold.llm.common import ready, table
from docfold.session import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the quality threshold go."""
    ready(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that with the smallest doc_id."""
    ready(spark)
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of the benchmark occurs go."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The characters of secrets become asterisks, so that lengths stay; all documents stay."""
    ready(spark)
    return secrets.mask_secrets(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset.

    ``packing.sequences`` gives the training sequences of these rows.
    """
    ready(spark)
    pieces = packing.tokenized(docs, added_tokens=True)
    return packing.place(pieces.withColumn("ids_crc32", F.crc32("ids")))


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: No stage but decontamination and masking by pattern can be said in SQL, so the rows can't.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each one's result is a written table that the next one reads."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
