"""The registered queries on the smallest tables, and the pipeline stage by stage."""

from __future__ import annotations

import os
from collections import Counter

import pytest

import corpus_pipeline
from __spark_entry__ import SMALLEST, oracle_sql, queries
from tidemark.llm import language_crf
from tidemark.llm.queries import QUERIES
from tools.check import compare, database
from tests.llm.test_pairs import plain_fingerprint, plain_vectors, roots
from tests.llm.test_rowwise import plain_quality

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALLEST), reason="needs the given tables")


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries())


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n in oracle_sql()))
def test_query_equals_its_sql(spark, name):
    assert compare(QUERIES[name](spark, SMALLEST), database(SMALLEST), oracle_sql()[name]) == ""


@pytest.mark.parametrize("name", ["op1_language_crf", "op2_toxicity_kn", "op6_cross_entropy"])
def test_model_queries_score_every_document(spark, name):
    docs = spark.read.parquet(f"{SMALLEST}/documents.parquet")
    found = QUERIES[name](spark, SMALLEST)
    assert sorted(r[0] for r in found.select("doc_id").collect()) == sorted(
        r[0] for r in docs.select("doc_id").collect())


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{SMALLEST}/documents.parquet")
    found = QUERIES["op1_language_crf"](spark, SMALLEST).filter("held_out").join(docs, "doc_id")
    right = Counter(r["lang"] == r["lang_pred"] for r in found.collect())
    assert right[True] / sum(right.values()) > 0.9


def test_simhash_query(spark):
    docs = spark.read.parquet(f"{SMALLEST}/documents.parquet").collect()
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in docs}
    ids = sorted(prints)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:]
             if (prints[a] ^ prints[b]).bit_count() <= 4]
    found = QUERIES["op9_simhash_anchors"](spark, SMALLEST).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == roots(ids, links)


def test_vector_query(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"])
            for r in spark.read.parquet(f"{SMALLEST}/embeddings.parquet").collect()]
    links = [(rows[a][0], rows[b][0]) for a, b in plain_vectors(rows, 0.93)]
    found = QUERIES["op5_projection_dedup"](spark, SMALLEST).collect()
    assert {r["vec_id"]: r["component_id"] for r in found} == roots([r[0] for r in rows], links)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALLEST}/documents.parquet")
    stages, now = dict(corpus_pipeline.STAGES), docs
    assert list(stages) == ["quality", "language", "near_copies", "packing"]
    kept = corpus_pipeline.quality(spark, now, SMALLEST)
    assert kept.columns == docs.columns
    good = {r["doc_id"] for r in kept.collect()}
    assert all(not plain_quality(r["text"])[-1] for r in docs.collect() if r["doc_id"] in good)
    passed = corpus_pipeline.language(spark, kept, SMALLEST)
    assert passed.columns == docs.columns and passed.count() > 0.98 * len(good)
    single = corpus_pipeline.near_copies(spark, passed, SMALLEST)
    assert single.columns == docs.columns
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in passed.collect()}
    ids = sorted(prints)
    groups = roots(ids, [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:]
                         if (prints[a] ^ prints[b]).bit_count() <= 4])
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(set(groups.values()))
    packed = corpus_pipeline.packing(spark, single, SMALLEST)
    assert {r["doc_id"] for r in packed.collect()} == set(groups.values())


def test_pipeline_takes_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    words = "the house by the river was old and nobody in the town knew who had built it".split()
    text = " ".join(words)
    rows = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, text, None, None, None),
            (3, None, None, None, None), (4, "", "en", "s", 0), (None, text, "en", "s", 1),
            (None, " ".join(words[::-1]), "en", "s", 1)]
    for given, expected in ((rows, [1, None]), ([], [])):
        docs = spark.createDataFrame(given, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, "")
            assert docs.columns == [f.split()[0] for f in schema.split(", ")]
        assert sorted((r["doc_id"] for r in docs.collect()), key=str) == expected
        assert corpus_pipeline.packing(spark, docs, "").select("doc_id").distinct().count() == len(expected)


def test_near_copies_judges_rows_not_ids(spark):
    words = "the house by the river was old and nobody in the town knew who had built it".split()
    texts = [" ".join(words[i:] + words[:i][::-1] + [f"word{i}"] * 5) for i in range(8)]
    prints = [plain_fingerprint(t) for t in texts]
    assert all((a ^ b).bit_count() > 4 for i, a in enumerate(prints) for b in prints[i + 1:])
    rows = [(None, t) for t in texts[:4]] + [(None, texts[0]), (3, texts[4]), (7, texts[4]),
                                             (7, texts[5]), (9, texts[6]), (9, texts[6]),
                                             (None, texts[6]), (None, texts[7])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = corpus_pipeline.near_copies(spark, docs, "").collect()
    assert Counter((r["doc_id"], r["text"]) for r in found) == Counter(
        [(None, t) for t in texts[:4]] + [(3, texts[4]), (7, texts[5]), (9, texts[6]),
                                          (None, texts[7])])

def test_a_model_without_languages_rejects_nothing(spark):
    assert language_crf.UNKNOWN == "und"
    docs = spark.createDataFrame([(1, "some text here", None)], "doc_id long, text string, lang string")
    assert corpus_pipeline.language(spark, docs, "").count() == 1


@pytest.mark.parametrize("name, columns", [
    ("op1_language_crf", ["doc_id", "held_out", "lang_pred", "score"]),
    ("op2_toxicity_kn", ["doc_id", "held_out", "score", "predicted"])])
def test_columns_of_the_contract_come_first(spark, name, columns):
    assert QUERIES[name](spark, SMALLEST).columns[:4] == columns
