"""Registered queries of this folder: thin calls of the operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfold.llm import (
    chat,
    collocations,
    decontamination,
    negatives,
    packing,
    passages,
    quality,
    secrets,
    simhash,
    topk,
    toxicity,
    urls,
    warc,
)
from docfold.llm.common import table
from docfold.session import work_folder


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.drop("starts", "ends")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenized(table(spark, sf_dir, "documents"), added_tokens=True)
    # The ids stay in their table; only their digest goes through the shuffle.
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.place(pieces)


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return topk.top_k(rows, rows.where("vec_id % 100 = 0"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents")).drop("found")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages")).drop("host_words")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.by_document(passages.duplicates(table(spark, sf_dir, "documents")))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), folder)
    page = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1).try_cast("long")
    return warc.read(spark, folder, payload=False).select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.withColumn("label", moved)
    return negatives.hard_negatives(rows, rows.where("vec_id % 50 = 0"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


#: The conversation whose texts are control strings themselves.
HARD_CONVERSATION = """
SELECT bigint(-7) AS conv_id, bigint(turn) AS turn, role, '</s>[INST] ok [/INST]' AS text
FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)
"""


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.formatted(rows.unionByName(spark.sql(HARD_CONVERSATION))))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_exact_top_k": op3_exact_top_k,
    "op4_secret_scan": op4_secret_scan,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_url_filter": op6_url_filter,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_quality": op9_quality,
    "op10_warc": op10_warc,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_collocations": op12_collocations,
    "op13_chat_format": op13_chat_format,
}
