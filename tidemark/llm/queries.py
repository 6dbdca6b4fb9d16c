"""The operators applied to the given tables, one query each."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (byte_bpe, conversation_repair, cross_entropy, hilbert_packing,
                          html_main_text, jump_shards, language_crf, prefix_trie, projection_dedup,
                          quality_rules, simhash_anchors, token_files, toxicity_kn)
from tidemark.llm.frames import kept
from tidemark.llm.oracles import ORACLES
from tidemark.session import new_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(divisor: int) -> Column:
    """CRC-32 of the document id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string")) % divisor


def op1_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_crf.fit(docs.filter(_remainder(4) != 2))
    held_out = F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out")
    found = language_crf.label(docs, model, keep=["doc_id"])
    first = ["doc_id", held_out, "lang_pred", "score"]
    return found.select(*first, *[c for c in found.columns if c not in ("doc_id", *first[2:])])


def op2_toxicity_kn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity_kn.fit(docs, labels.filter(_remainder(5) != 0))
    held_out = F.coalesce(_remainder(5) == 0, F.lit(False)).alias("held_out")
    found = toxicity_kn.score(docs, model, keep=["doc_id"])
    first = ["doc_id", held_out, "score", "predicted"]
    return found.select(*first, *[c for c in found.columns if c not in ("doc_id", *first[2:])])


def op3_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = _table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"), F.lit("key").alias("law"))
    return jump_shards.assign(rows, "doc_id", 16)


def op4_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = hilbert_packing.pack(_table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def op5_projection_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # blocks small enough that large labels of the check tables have many
    return projection_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), block=256)


def op6_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the documents labelled as of good quality. Background: all documents."""
    docs = _table(spark, sf_dir, "documents")
    good = (_table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id").distinct()
            .withColumn("good", F.lit(True)))
    # labels grow with the documents: never broadcast, so that every size has the same plan
    marked = docs.select("doc_id", "text").join(good.hint("merge"), "doc_id", "left")
    models = cross_entropy.fit(marked, "good")
    return cross_entropy.score(marked, models, keep=["doc_id"], same=True)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.score(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(_table(spark, sf_dir, "documents"),
                            public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                            public_tokenizers.PATTERN, keep=["doc_id"])


def op9_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_anchors.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-files")
    token_files.write(_table(spark, sf_dir, "documents"), folder,
                      public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with the contract's faults; rows not ``present`` only name their conversation."""
    names = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *names)) % 20
    role, text = (F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" ")))
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
        .alias("text"), (kind != 0).alias("present"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
        .alias("copy"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(_table(spark, sf_dir, "conversations"))
    return conversation_repair.report(conversation_repair.repair(rows, present="present")).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        "repaired_sha256")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The contract's conversations, each with the opening of the first of its hundred, from numbered
    turns; and the ids of all of them, as some have no turn then."""
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", "n", (F.col("conv_id") - F.col("conv_id") % 100).alias("leader"),
        (F.crc32(F.col("conv_id").cast("string")) % 6).alias("h"))
    leaders = convs.filter("conv_id = leader").select("leader", F.col("n").alias("n_leader"))
    # hashes of a conversation's name and the number of its leader's turns: one row for each
    known = kept(convs.join(leaders, "leader", "left").select(
        "conv_id", "leader", "h", F.least("h", F.coalesce("n_leader", F.lit(0))).alias("opened")),
        "trie-convs")
    openings = turns.filter("conv_id % 100 = 0 and place < 5").withColumnRenamed(
        "conv_id", "leader")
    turn = ["place", "t1", "t2", "chars"]
    first = known.filter("opened > 0").join(openings, "leader").filter("place < h").select(
        "conv_id", *turn)
    rest = turns.join(known, "conv_id").filter("place >= h").select(
        "conv_id", (F.col("place") - F.col("h") + F.col("opened")).alias("place"), *turn[1:])
    return first.unionByName(rest), known.select("conv_id")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, convs = rebuilt(prefix_trie.numbered(_table(spark, sf_dir, "conversations")))
    return prefix_trie.with_digests(prefix_trie.build(turns, convs)).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256")


def op13_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main_text.extract(_table(spark, sf_dir, "pages"), keep=["page_id", "url"])


QUERIES = {f.__name__: f for f in (
    op1_language_crf, op2_toxicity_kn, op3_jump_shards, op4_curve_packing, op5_projection_dedup,
    op6_cross_entropy, op7_quality_rules, op8_byte_bpe, op9_simhash_anchors, op10_token_files,
    op11_conversation_repair, op12_prefix_trie, op13_html_main_text)}
__all__ = ["ORACLES", "QUERIES"]
