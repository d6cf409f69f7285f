"""The registered queries of this package: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from censusloom.llm import bpe, html, hyperplanes, langid, oracle, partenum, quality, resampling, ring, simhash, substring, token_count, turns, winnow


#: Rows of a batch that goes to a task's Python worker: some megabytes of texts.
ARROW_ROWS = 2_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    # Tasks import this package too, also when only the driver's path has it.
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (known, root) if x)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).decisions()


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.edited_likeness(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnow.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), each_row=True)
    joined = F.concat_ws(",", "items")
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(joined, 256).alias("items_sha256"), "contaminated")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_text(table(spark, sf_dir, "pages"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law "rows": shard sizes differ by one row at most. Null texts have size 1 and the checksum of no bytes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    placed = ring.shard(rows, "doc_id", [F.col("doc_id"), F.col("text_crc32"), F.col("size")])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("_shard").alias("shard"),
        F.col("_slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_count.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_language(table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.jaccard_components(table(spark, sf_dir, "documents"))


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperplanes.near_duplicates(table(spark, sf_dir, "embeddings"))


def op12_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repair(turns.damage(table(spark, sf_dir, "conversations")))


_QUERIES = (
    op1_quality, op2_substring_dedup, op3_simhash, op4_decontamination, op5_html_text, op6_byte_bpe, op7_sharding, op8_token_counts, op9_language,
    op10_jaccard_join, op11_embedding_dedup, op12_target_resampling, op13_conversation_repair,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
