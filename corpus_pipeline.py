"""A corpus pipeline: quality rules, language, near-duplicates, packing.

Each stage gets the documents that the one before it kept. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import hilbert_packing, language_crf, quality_rules, simhash_anchors
from tidemark.llm.frames import kept

#: Least mean probability of a text's language.
LEAST_SCORE = 0.35


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.passing(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognized; rejected are those without a letter and those of no
    clear language. A model that learned no language rejects nothing."""
    model = language_crf.fit(docs.filter(F.crc32(F.col("doc_id").cast("string")) % 4 != 2))
    if not model.languages:
        return docs
    found = language_crf.label(docs.withColumn("_row", F.struct("*")), model, keep=["_row"])
    return found.filter((F.col("lang_pred") != language_crf.UNKNOWN)
                        & (F.col("score") >= LEAST_SCORE)).select("_row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-copies, the one with the smallest id. Of rows with that id one
    stays, and of a group without any id one. Rows are told apart by a written number, so what has
    the id of another text, or none, is judged by its own text."""
    rows = kept(docs.select(F.struct("*").alias("_doc"), "text", F.struct(
        F.col("doc_id").isNull().alias("unnamed"), "doc_id",
        F.monotonically_increasing_id().alias("row")).alias("_id")), "pipeline-rows")
    groups = simhash_anchors.near_duplicates(rows, id="_id", words=4, distance=4)
    stay = groups.filter("_id.row = component_id.row").select(F.col("_id.row").alias("stays"))
    return rows.join(stay, F.col("_id.row") == F.col("stays"), "left_semi").select("_doc.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens."""
    pieces = hilbert_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


STAGES = [("quality", quality), ("language", language), ("near_copies", near_copies),
          ("packing", packing)]

#: No SQL can express the language model, the 64-bit XXH64 or the tokenizer; tests/llm compares the
#: stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
