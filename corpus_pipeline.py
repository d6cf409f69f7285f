"""The corpus pipeline: documents in, token ids out.

Each stage takes (spark, docs, sf_dir) and works on all documents that the stage before has kept. All stages but the
last return the columns of documents; the last returns a row of token ids for each document that is left. Rows that
repeat a key stay apart unless a stage drops them; empty tables pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from censusloom.llm import bpe, partenum, quality, substring, winnow
from censusloom.llm.queries import table
from censusloom.plans.storage import settle


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling rejects go."""
    return quality.resample(docs, table(spark, sf_dir, "labels")).keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked texts one row stays: that with the least doc_id and, of its rows in the group, the least text.

    A shared doc_id alone links nothing. Rows without a doc_id or without words are linked with nothing and stay.
    """
    return partenum.first_of_groups(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words within repeated passages go from the texts; n_chars follows."""
    return substring.remove_repeats(docs, replace=True)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too much of the benchmark go."""
    found = winnow.overlaps(docs, table(spark, sf_dir, "benchmark"))
    hit = settle(found.where("contaminated").select(F.col("doc_id").alias("_hit"), F.col("tag").alias("_tag")), "contaminated")
    return docs.join(hit, F.col("doc_id").eqNullSafe(F.col("_hit")) & (winnow.text_tag(F.col("text")) == F.col("_tag")), "left_anti")


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document that is left, and the digests of the ids and of the bytes they decode to."""
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ids=True)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("byte-level BPE", byte_bpe),
]

#: SQL can express neither the classifier nor the tokenizer; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
