"""Corpus pipeline: quality, toxicity, near-duplicates, benchmark passages, packing.

Each stage works on all rows that its predecessor kept and, but for the last,
returns rows with the columns of ``documents``.  Models are learnt from the
stage's input and ``labels``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinolytics.llm.common import stored
from kinolytics.llm.decontam import decontaminate
from kinolytics.llm.packing import pack
from kinolytics.llm.quality import fit_quality, keep_good
from kinolytics.llm.near_text import keep_first
from kinolytics.llm.toxicity import fit_toxicity, keep_clean


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.  Null texts have no terms and are judged like any other; null ids stay or go by their text; an empty table stays empty."""
    return keep_good(docs, fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), threshold=0.3)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain finds toxic go.  Null texts have no words and stay; an empty table stays empty."""
    return keep_clean(docs, fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (shingles of five words, similarity 0.8 or more), the document of the smallest id stays.
    Texts without words, null ones too, are copies of each other; rows of a null id stay; an empty table stays empty."""
    return keep_first(docs, width=5, similarity=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go.  Null texts have no words and stay, whatever their id; an empty table stays empty."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), remove="documents", width=10)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.  Null texts are the end id alone; an empty table gives no rows."""
    pieces = pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), capacity=1024, end_id=0)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality", quality), ("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("packing", packing)]

#: The stages learn models and tokenise, which SQL cannot express; tests hold each stage against plain code (tests/llm/test_pipeline.py).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read by the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, spark)
    return docs
