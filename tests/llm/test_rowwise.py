"""Operators that treat each text by itself, against libraries and plain Python."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import groupby

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import (
    byte_bpe,
    cross_entropy,
    hilbert_packing,
    jump_shards,
    language_crf,
    quality_rules,
    token_files,
    toxicity_kn,
)
from tidemark.llm.pieces import LibraryTokenizer

WORD, BYTE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, shard string, score string, ids string, kept string, row long"

#: Nulls, empty and long texts, repeated rows, odd characters, clashing column names.
TEXTS = [None, "", " ", "\n\n", "That it.", "It's the   end\r\n\tof 12½ things, isn't it?",
         "ÉÈ ñandú Straße ΑΣ İstanbul é ’quoted’ 中文字 🙂🙂  x​",
         "the end " * 3000, "x" * 5000, "ab " * 40 + "\n" + "ab " * 40, "<|endoftext|> 's 'S ''s"]
ROWS = [(i, t, "s", "1.5", "x", "k", 7) for i, t in enumerate(TEXTS)]
ROWS += [ROWS[5], ROWS[7], (None, "no id", "s", None, None, None, None), (3, "other", *ROWS[3][2:])]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def random_texts(count: int, letters: str) -> list[str]:
    rng = random.Random(3)
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(count)]


@pytest.mark.parametrize("file", [WORD, BYTE])
def test_pieces_give_the_ids_of_whole_texts(file):
    texts = random_texts(4000, "aab'sre vlmtd  \n\t\r.!12½²é ÉΣσİñ ’́\u0085\x1c中Ⅷ٣🙂　")
    texts += random_texts(4000, "ab's'r'e 'v'l'm't'd  \n.1A") + [t or "" for t in TEXTS]
    coder = LibraryTokenizer(file)
    coder.cache.most = 3000  # so that pieces are forgotten meanwhile
    for first in range(0, len(texts), 700):
        group = texts[first:first + 700]
        ids, counts = coder.encode(group)
        ends = np.cumsum(counts)
        for text, end, n in zip(group, ends, counts):
            expected = coder.library.encode(text, add_special_tokens=False).ids
            assert ids[end - n:end].tolist() == expected, text


def own_encoding() -> tiktoken.Encoding:
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def test_byte_bpe_is_tiktokens(spark, docs, none):
    library = own_encoding()
    coder = byte_bpe.byte_bpe(RANKS, public_tokenizers.PATTERN)
    texts = random_texts(3000, "ab's the'ing \n\té中🙂½") + ["ab" * 900, "é" * 700, "a" * 4000]
    ids, counts = coder.encode(texts)
    ends = np.cumsum(counts)
    for text, end, n in zip(texts, ends, counts):
        assert ids[end - n:end].tolist() == library.encode_ordinary(text)
        assert coder.decode(ids[end - n:end]).tobytes().decode() == text

    encoded = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    assert sorted(encoded.columns) == sorted(docs.columns)  # ids replaced the column of that name
    back = byte_bpe.decode(encoded, RANKS, public_tokenizers.PATTERN)
    for row in back.collect():
        assert np.frombuffer(row["ids"], "<u4").tolist() == library.encode_ordinary(row["text"] or "")
        assert row["data"].decode() == (row["text"] or "")
    found = byte_bpe.digests(docs, RANKS, public_tokenizers.PATTERN, keep=["text"]).collect()
    assert len(found) == len(ROWS)
    for row in found:
        ids = np.array(library.encode_ordinary(row["text"] or ""), "<u4").tobytes()
        assert (row["n_tokens"], row["ids_sha256"], row["decoded_sha256"]) == (
            len(ids) // 4, hashlib.sha256(ids).hexdigest(),
            hashlib.sha256((row["text"] or "").encode()).hexdigest())
    assert byte_bpe.digests(none, RANKS, public_tokenizers.PATTERN).count() == 0


def test_token_files_round_trip(spark, docs, none, tmp_path):
    token_files.write(docs, f"{tmp_path}/files", BYTE)
    found = token_files.read(spark, f"{tmp_path}/files").orderBy("start").collect()
    library, start = Tokenizer.from_file(BYTE), 0
    library.encode_special_tokens = True
    ids_of = {t: library.encode(t or "", add_special_tokens=False).ids + [2]
              for t in {r[1] for r in ROWS}}
    assert [r["doc_id"] for r in found] == [None, *sorted(r[0] for r in ROWS if r[0] is not None)]
    texts: dict = {}
    for row in ROWS:
        texts.setdefault(row[0], []).append(ids_of[row[1]])
    for row in found:
        ids = np.frombuffer(row["ids"], "<u4").tolist()
        assert row["start"] == start and row["n_tokens"] == len(ids)
        texts[row["doc_id"]].remove(ids)
        start += len(ids)
    token_files.write(none, f"{tmp_path}/none", BYTE)
    assert token_files.read(spark, f"{tmp_path}/none").count() == 0


def test_code_is_reversible_and_damage_is_seen(spark, docs, tmp_path):
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 9, 500)
    ranks = (rng.integers(0, 1 << 32, counts.sum(), dtype=np.uint64)
             >> rng.integers(0, 32, counts.sum(), dtype=np.uint64)).astype(np.uint32)
    control, data = token_files.code(ranks, counts)
    assert (token_files.uncode(control, data, counts) == ranks).all()
    token_files.write(docs, f"{tmp_path}/files", BYTE)
    blocks = spark.read.parquet(f"{tmp_path}/files/blocks").withColumn("check", F.col("check") + 1)
    blocks.write.parquet(f"{tmp_path}/bad/blocks")
    spark.read.parquet(f"{tmp_path}/files/vocabulary").write.parquet(f"{tmp_path}/bad/vocabulary")
    with pytest.raises(Exception, match="damaged"):
        token_files.read(spark, f"{tmp_path}/bad").collect()


@pytest.mark.parametrize("length", [16, 4096])
def test_packing_covers_every_id_once(spark, docs, none, length):
    pieces = hilbert_packing.pack(docs, WORD, length=length)
    rows = pieces.collect()
    library = Tokenizer.from_file(WORD)
    library.encode_special_tokens = True
    expected = Counter()
    for row in ROWS:
        expected[(row[0], *library.encode(row[1] or "", add_special_tokens=False).ids, 2)] += 1
    # pieces of a document lie one after the other in the stream
    stream, got, held = sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])), Counter(), []
    for row in stream:
        ids = np.frombuffer(row["ids"], "<u4").tolist()
        assert len(ids) == row["length"] > 0 and row["start"] == len(held)
        held += ids
        if len(held) == row["doc_tokens"]:
            got[(row["doc_id"], *held)] += 1
            held = []
    assert got == expected and not held
    sizes = Counter()
    for row in stream:
        assert row["offset"] == sizes[row["sequence_id"]]
        sizes[row["sequence_id"]] += row["length"]
    short = [n for n in sizes.values() if n != length]
    assert all(n & (n - 1) == 0 and n < length for n in short)
    whole = {r["sequence_id"]: r for r in hilbert_packing.sequences(pieces).collect()}
    assert {k: len(v["ids"]) // 4 for k, v in whole.items()} == dict(sizes)
    assert hilbert_packing.pack(none, WORD).count() == 0


def test_hilbert_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = hilbert_packing.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def test_like_documents_come_next_to_each_other(spark):
    rng = random.Random(0)
    topics = [["apple", "pear", "plum", "fig"], ["engine", "wheel", "brake", "gear"]]
    rows = [(i, " ".join(rng.choice(topics[i % 2]) for _ in range(200))) for i in range(60)]
    pieces = hilbert_packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), WORD)
    order = [r["doc_id"] % 2 for r in pieces.orderBy("sequence_id", "offset").collect()
             if r["start"] == 0]
    assert sum(a != b for a, b in zip(order, order[1:])) <= 6


def plain_jump(key: int, shards: int) -> int:
    shard, ahead = -1, 0
    while ahead < shards:
        shard, key = ahead, (key * 2862933555777941757 + 1) % (1 << 64)
        ahead = int((shard + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return shard


def test_jump_shards(spark, docs, none):
    keys = np.random.default_rng(2).integers(0, 1 << 64, 3000, dtype=np.uint64)
    assert jump_shards.jump_hash(keys, 16).tolist() == [plain_jump(int(k), 16) for k in keys]
    many = spark.range(5000).selectExpr("id % 4000 as doc_id", "'x' as shard", "id as row")
    for table, count in ((many, 5000), (docs, len(ROWS)), (none, 0)):
        rows = jump_shards.assign(table, "doc_id", 16).collect()
        assert len(rows) == count
        slots: dict = {}
        shards: dict = {}
        for row in rows:
            slots.setdefault(row["shard"], []).append(row["slot"])
            assert row["grown_shard"] in (row["shard"], 16)
            assert shards.setdefault(row["doc_id"], row["shard"]) == row["shard"]
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [r["count"] for r in jump_shards.assign(many, "doc_id", 16).groupBy("shard").count().collect()]
    assert len(sizes) == 16 and min(sizes) > 200


def plain_quality(text: str | None) -> tuple:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1
               for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    base = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered), base)


def test_quality_counts(spark, docs, none):
    rng = random.Random(5)
    more = [" ".join(rng.choice("ab c** d| e\n".split(" ")) for _ in range(rng.randrange(60)))
            for _ in range(300)] + ["- a...\n- a...\n# b" * 5, "w " * 20000]
    table = docs.select("doc_id", "text", "kept").unionAll(spark.createDataFrame(
        [(i, t, "k") for i, t in enumerate(more)], "doc_id long, text string, kept string"))
    rows = quality_rules.score(table).collect()
    assert len(rows) == len(ROWS) + len(more)
    for row in rows:
        assert tuple(row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                      "n_repeat_words", "base_failed")) == plain_quality(row["text"])
        assert row["kept"] == (not row["base_failed"] and not row["failed_rules"])
    assert quality_rules.score(none).count() == 0
    clean = "The house by the river was old, and nobody in the town knew who had built it first."
    junk = " ".join(f"word{i}***" for i in range(30))
    texts = [(1, clean, "a"), (2, junk, "b"), (3, None, "c"), (4, "Short.", "d")]
    kept = quality_rules.passing(spark.createDataFrame(texts, "doc_id long, text string, kept string"))
    assert [tuple(r) for r in kept.collect()] == [(1, clean, "a")]


def test_marginals_are_those_of_one_pass():
    rng = np.random.default_rng(0)
    lengths = np.array([1, 5, 64, 65, 300, 2])
    scores, moves = rng.normal(size=(lengths.sum(), 3)) * 2, rng.normal(size=(3, 3))
    found, begin = language_crf.marginals(scores, lengths, moves), 0
    for n in lengths:
        x, ahead, behind = np.exp(scores[begin:begin + n]), [], [np.ones(3)]
        for i in range(n):
            state = x[0] if i == 0 else (ahead[-1] @ np.exp(moves)) * x[i]
            ahead.append(state / state.sum())
        for i in range(n - 1, 0, -1):
            state = np.exp(moves) @ (x[i] * behind[-1])
            behind.append(state / state.sum())
        expected = np.array(ahead) * np.array(behind[::-1])
        assert np.allclose(found[begin:begin + n], expected / expected.sum(1, keepdims=True))
        begin += n


ENGLISH = "the house and the river that was with this thing of the old town by which they went"
GERMAN = "der fluss und das haus nicht mit einer stadt die sich auch noch über den weg schon"


def mixed_docs(spark, count: int = 60):
    rng = random.Random(1)
    words = {"en": ENGLISH.split(), "de": GERMAN.split()}
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(30)), lang)
            for i in range(count) for lang in [("en", "de")[i % 2]]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_language_of_words_and_texts(spark, docs, none):
    learned = mixed_docs(spark)
    model = language_crf.fit(learned)
    found = language_crf.label(learned, model).collect()
    assert all(r["lang_pred"] == r["lang"] and 0 <= r["score"] <= 1 for r in found)
    assert model.transitions[0, 0] > model.transitions[0, 1]
    switched = spark.createDataFrame([(1, f"{ENGLISH}. {GERMAN}")], "doc_id long, text string")
    runs = language_crf.spans(switched, model).first()["spans"]
    assert [r["lang"] for r in runs] == ["en", "de"]
    assert runs[0]["end"] <= len(ENGLISH) < runs[1]["begin"]
    odd = language_crf.label(docs, model).collect()
    assert len(odd) == len(ROWS)
    for row in odd:
        letters = any(c.isalpha() for c in row["text"] or "")
        assert (row["lang_pred"] == "und") == (not letters) and (letters or row["score"] == 0)
    assert language_crf.label(none, model).count() == 0
    empty = language_crf.fit(learned.filter("false"))
    assert {r["lang_pred"] for r in language_crf.label(learned, empty).collect()} == {"und"}


def test_toxicity(spark, docs, none):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(ENGLISH.split()) + rng.choice(["", "s", "ing"]) for _ in range(40)]
        if i % 4 == 0:
            words[rng.randrange(40)] = rng.choice(["idiot", "scumbag", "moronic"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity_kn.fit(table, marks.filter("doc_id % 5 <> 0"))
    found = {r["doc_id"]: r for r in toxicity_kn.score(table, model).collect()}
    held = [(found[i]["predicted"], toxic) for i, toxic in labels if i % 5 == 0]
    assert sum(a == b for a, b in held) / len(held) > 0.95
    odd = toxicity_kn.score(docs, model).collect()
    assert len(odd) == len(ROWS)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in odd)
    assert all(r["log_ratio"] == 0 for r in odd if not any(c.isalpha() for c in r["text"] or ""))
    assert toxicity_kn.score(none, model).count() == 0
    one_class = toxicity_kn.fit(table, marks.filter("toxic = 0"))
    assert {r["score"] for r in toxicity_kn.score(table, one_class).collect()} == {0.5}


def plain_toxicity(texts: list[str], toxic: list[int]):
    """Log-probabilities of a word after another in both classes, by dictionaries and formulas."""
    order, shared_order, margin, rare = (toxicity_kn.ORDER, toxicity_kn.SHARED, toxicity_kn.MARGIN,
                                         toxicity_kn.RARE)
    words, pairs = [Counter(), Counter()], [Counter(), Counter()]
    for text, c in zip(texts, toxic):
        of = re.findall("[a-z]+", text.lower())
        words[c].update(set(of))
        pairs[c].update(set(zip([""] + of, of)))
    grams = {size: [Counter(), Counter()] for size in range(1, order + 1)}
    for c in (0, 1):
        for word, n in words[c].items():
            marked = f"\x02{word}\x03"
            for size in grams:
                for i in range(1, len(marked)):
                    if i - size + 1 >= 0:
                        grams[size][c][marked[i - size + 1:i + 1]] += n

    def standing_out(counts, key, context_of):
        """For ``key``: own part and remaining part in both classes, shared and remaining part."""
        same = {k for c in counts for k in c if context_of(k) == context_of(key)}
        totals = [sum(c[k] for k in same) for c in counts]
        own = {}
        for k in same:
            for c in (0, 1):
                expected = totals[c] * (counts[0][k] + counts[1][k]) / sum(totals)
                own[k, c] = max(counts[c][k] - expected - margin * expected ** 0.5 - 1, 0)
        left = {k: counts[0][k] + counts[1][k] - own[k, 0] - own[k, 1] for k in same}
        all_left = max(sum(left.values()), 1)
        common = {k: max(v - rare, 0) / all_left for k, v in left.items()}
        parts = []
        for c in (0, 1):
            total = max(totals[c], 1)
            parts.append((own.get((key, c), 0) / total, 1 - sum(own[k, c] for k in same) / total))
        return parts, common.get(key, 0), 1 - sum(common.values())

    def spelled(word, c):
        marked, log = f"\x02{word}\x03", 0.0
        for i in range(1, len(marked)):
            p = 1 / (len(set("".join(grams[1][0])) | set("".join(grams[1][1]))) + 1)
            for size in range(1, min(order, i + 1) + 1):
                gram = marked[i - size + 1:i + 1]
                every = set(grams[size][0]) | set(grams[size][1])
                if size < order:
                    longer = set(grams[size + 1][0]) | set(grams[size + 1][1])
                    counts = Counter(g[1:] for g in longer)
                    counts.update({g: 1 for g in every if g[0] == "\x02"})
                else:
                    counts = grams[size][0] + grams[size][1]
                once, twice = (list(counts.values()).count(x) for x in (1, 2))
                discount = once / (once + 2 * twice) if once and twice else 0.5
                after = [n for g, n in counts.items() if g[:-1] == gram[:-1]]
                if after:
                    p = (max(counts[gram] - discount, 0) + discount * len(after) * p) / sum(after)
            for size in range(shared_order + 1, min(order, i + 1) + 1):
                gram = marked[i - size + 1:i + 1]
                if any(g[:-1] == gram[:-1] for c2 in grams[size] for g in c2):
                    own, rest = standing_out(grams[size], gram, lambda g: g[:-1])[0][c]
                    p = own + rest * p
            log += math.log(p)
        return log

    def probability(before, word, c):
        parts, common, rest = standing_out(words, word, lambda w: 0)
        p = parts[c][0] + parts[c][1] * (common + rest * math.exp(spelled(word, c)))
        if any((before, w) in pairs[k] for k in (0, 1) for w in set(words[0]) | set(words[1])):
            parts, common, rest = standing_out(pairs, (before, word), lambda x: x[0])
            p = parts[c][0] + parts[c][1] * (common + rest * p)
        return math.log(p)

    return probability


def test_toxicity_counts_like_plain_ones(spark):
    rng = random.Random(5)
    texts, toxic = [], []
    for i in range(120):
        words = [rng.choice("the old house was big and red go die now slowly".split())
                 for _ in range(12)]
        toxic.append(i % 3 == 0)
        texts.append(" ".join(words + (["die", "slowlyest"] if toxic[-1] else ["go", "slower"])))
    toxic = [int(t) for t in toxic]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    marks = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    model = toxicity_kn.fit(table, marks)
    draw = {r["doc_id"]: r["draw"] for r in marks.selectExpr(
        "doc_id", "pmod(xxhash64(doc_id, 11), 3) draw").collect()}
    counted = [i for i in range(120) if draw[i] != 0]
    plain = plain_toxicity([texts[i] for i in counted], [toxic[i] for i in counted])
    assert len(model.words.grams) and len(model.pairs.grams) and len(model.letters[0].grams)
    for text in ("go die slowly", "die go slower", "house now slowlyest unseen", "big slowlyes"):
        pieces, whole = toxicity_kn.word_pieces([text])
        before, keys = toxicity_kn._with_before(pieces)
        of = text.split()
        found = model.of_pairs(before, keys, model.of_words(keys, model.spelling(of)))
        wanted = [[plain(b, w, c) for c in (0, 1)] for b, w in zip([""] + of, of)]
        np.testing.assert_allclose(found, wanted, rtol=1e-5)


def test_toxicity_knows_the_order_of_words(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        words = [rng.choice(ENGLISH.split()) for _ in range(30)]
        at = rng.randrange(30)
        words[at:at] = ["go", "die"] if i % 3 == 0 else ["die", "go"]
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 3 == 0)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity_kn.fit(table, marks.filter("doc_id % 5 <> 0"))
    found = toxicity_kn.score(table.filter("doc_id % 5 = 0"), model).collect()
    assert sum(r["predicted"] == (r["doc_id"] % 3 == 0) for r in found) / len(found) > 0.9


def test_toxicity_of_contradicting_and_repeated_labels(spark):
    rows = [(i % 40, f"{'idiot' if i % 2 else 'friend'} the house {i % 7}") for i in range(80)]
    table = spark.createDataFrame(rows + [(None, "idiot")], "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 2)) for i in range(40)] * 2 + [(4, 1), (6, None)],
                                  "doc_id long, toxic int").union(
        spark.createDataFrame([(None, 1)], "doc_id long, toxic int"))
    first, again = (toxicity_kn.score(t, toxicity_kn.fit(t, marks)).select("doc_id", "score")
                    for t in (table, table.repartition(5)))
    assert sorted(first.collect(), key=str) == sorted(again.collect(), key=str)


def test_levels_are_distributions():
    none = np.zeros(0, np.uint64)
    spelled = ["ab", "abb", "ba"]
    pieces, _ = toxicity_kn.word_pieces(spelled)
    model = toxicity_kn.Model(spelled, pieces.keys(), np.array([[3.0, 80.0], [0.0, 4.0], [60.0, 0.0]]),
                              none, none, np.zeros((0, 2)), none, np.zeros((0, 2)))
    every = [""]
    for _ in range(9):
        every = sorted({*every, *(w + c for w in every for c in "ab" if len(w) < 9)})
    pieces, _ = toxicity_kn.word_pieces(every[1:])
    logs = model.of_words(pieces.keys(), model.spelling(every[1:]))
    total = np.exp(logs).sum(0)
    assert (total < 1.0001).all() and (total > 0.9).all()  # the rest: longer words, other letters


def test_cross_entropy_is_that_of_plain_counts(spark, docs, none):
    rows = [(i, t, i % 2 == 0) for i, t in enumerate(
        [ENGLISH, GERMAN, ENGLISH[:40], GERMAN * 3, None, "", "1 2 3", ENGLISH + " " + GERMAN])]
    table = spark.createDataFrame(rows, "doc_id long, text string, good boolean").repartition(4)
    target, background = cross_entropy.fit(table, "good")

    def words_of(text):
        return re.findall(r"[^\W\d_]+", (text or "").lower())

    def counts(texts):
        one, before, two = Counter(), Counter(), Counter()
        for text in texts:
            words = words_of(text)
            for a, b in zip([None, *words], words):
                one[b] += 1
                before[a] += 1
                two[a, b] += 1
        return one, before, two, sum(one.values())

    all_counts = counts([r[1] for r in rows])
    of = {"target": counts([r[1] for r in rows if r[2]]), "background": all_counts}
    scale = {"target": 1.0, "background": of["target"][3] / all_counts[3]}
    size = len(all_counts[0])

    def loss(kind, text):
        one, before, two, total = of[kind]
        s, out, words = scale[kind], 0.0, words_of(text)
        for a, b in zip([None, *words], words):
            alone = (one[b] * s + 0.5) / (total * s + 0.5 * size)
            out -= np.log((two[a, b] * s + 20 * alone) / (before[a] * s + 20))
        return out / len(words)

    for same in (False, True):
        found = cross_entropy.score(table, (target, background), same=same).collect()
        assert len(found) == len(rows)
        for row in found:
            if not words_of(row["text"]):
                assert row["n_words"] == 0 and row["difference"] is None
                continue
            assert row["n_words"] == len(words_of(row["text"]))
            expected = [loss(k, row["text"]) for k in ("target", "background")]
            assert np.allclose([row["target_loss"], row["background_loss"]], expected, rtol=1e-9)
            assert np.isclose(row["difference"], expected[0] - expected[1], atol=1e-9)
    assert cross_entropy.score(docs, (target, background)).count() == len(ROWS)
    nothing = cross_entropy.fit(none.selectExpr("text", "true as good"), "good")
    assert cross_entropy.score(none, nothing).count() == 0


@pytest.mark.parametrize("alike", [False, True])
def test_cross_entropy_rows_add_up_if_sort_keys_are_alike(monkeypatch, alike):
    """Rows are sorted by the first bits of keys; here all pairs have the same ones."""
    if alike:
        monkeypatch.setattr(cross_entropy, "_mixed", lambda word, before: np.zeros(len(word), np.int64))
    monkeypatch.setattr(cross_entropy, "BLOCK_CHARS", 20)
    texts = ["a b a b c a b", "", "b a b a", "c", "don't stop 'sea' 12 x9", "d e " * 12, "1 2"]
    of, before, word = cross_entropy.pairs_of(texts)
    plain = [re.findall("[a-z]+", t.replace("don't", "don t")) for t in texts]
    plain[4] = ["don", "stop", "sea", "x"]
    assert np.bincount(of, minlength=len(texts)).tolist() == [len(p) for p in plain]
    expected, found, lasts = Counter(zip(of.tolist(), before.tolist(), word.tolist())), Counter(), []
    *rows, n_words = cross_entropy._rows_of(texts)
    for text, b, w, n, last in zip(*map(np.ndarray.tolist, rows), strict=True):
        found[text, b, w] += n
        lasts += [(text, w)] if last else []
    assert found == expected and n_words.tolist() == [len(p) for p in plain]
    assert lasts == [(t, int(word[of == t][-1])) for t in range(len(texts)) if plain[t]]
    part, of_pair, place = np.array([1, 1, 1, 1, 2, 2, 3]), np.array([5, 6, 5, 6, 5, 6, 5]), np.full(7, -1)
    order = cross_entropy._pairs_together(part, of_pair, place)
    pairs = list(zip(part[order].tolist(), of_pair[order].tolist()))
    assert len([p for p, _ in groupby(pairs)]) == len(set(pairs)) == 5


def test_cross_entropy_keeps_every_pair_apart(spark):
    """More distinct words and pairs than 2^18 and 2^20: each pair was seen once or twice."""
    rng = np.random.default_rng(5)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    words = ["".join(w) for w in letters[rng.integers(0, 26, (300_000, 6))]]
    words = list(dict.fromkeys(words))
    turns = [[words[i] for i in rng.permutation(len(words))] for _ in range(4)]
    texts = [" ".join(w[i:i + 3000]) for w in turns for i in range(0, len(w), 3000)]
    texts.append("never before seen")
    table = spark.createDataFrame([(i, t, i % 3 == 0) for i, t in enumerate(texts)],
                                  "doc_id long, text string, good boolean").repartition(4)
    sides = [(Counter(), Counter(), Counter()) for _ in range(2)]
    for i, t in enumerate(texts[:-1]):
        w = t.split()
        for one, before, two in sides[:1 + (i % 3 == 0)]:
            one.update(w)
            before.update([None, *w[:-1]])
            two.update(zip([None, *w[:-1]], w))
    assert len(sides[0][2]) > 1 << 20 and len(sides[0][0]) > 1 << 18
    totals = [sum(s[0].values()) for s in sides]
    size = len(sides[0][0])
    models = cross_entropy.fit(table.filter(f"doc_id < {len(texts) - 1}"), "good")
    found = {r["doc_id"]: r for r in cross_entropy.score(table, models, keep=["doc_id"]).collect()}
    assert len(found) == len(texts)
    for i in (0, 1, len(texts) // 2, len(texts) - 2, len(texts) - 1):
        w = texts[i].split()
        assert found[i]["n_words"] == len(w)
        for (one, before, two), total, s, name in zip(sides, totals, (totals[1] / totals[0], 1.0),
                                                      ("background_loss", "target_loss")):
            p = [(two[a, b] * s + 20 * (one[b] * s + 0.5) / (total * s + 0.5 * size))
                 / (before[a] * s + 20) for a, b in zip([None, *w[:-1]], w)]
            assert np.isclose(found[i][name], -np.log(p).mean(), rtol=1e-9)


@pytest.mark.parametrize("share", [0.004, 0.03, 0.3])
def test_cross_entropy_of_frequent_words_and_pairs(spark, monkeypatch, share):
    """Words and pairs of all frequencies: of frequent pairs, of frequent words, and of neither."""
    monkeypatch.setattr(cross_entropy, "SHARE", share)
    rng = random.Random(7)
    letters = "abcdefghijklmnopqrst"
    texts = [" ".join(letters[min(int(rng.expovariate(0.35)), 19)] * 2
                      for _ in range(rng.randrange(60))) for _ in range(150)] + ["aa aa"] * 100
    table = spark.createDataFrame([(i, t, i % 3 == 0) for i, t in enumerate(texts)],
                                  "doc_id long, text string, good boolean").repartition(4)
    sides = [(Counter(), Counter(), Counter()) for _ in range(2)]
    for i, t in enumerate(texts):
        w = t.split()
        for one, before, two in sides[:1 + (i % 3 == 0)]:
            one.update(w)
            before.update([None, *w[:-1]] if w else [])
            two.update(zip([None, *w[:-1]], w))
    totals = [sum(s[0].values()) for s in sides]
    models = cross_entropy.fit(table, "good")
    for row in cross_entropy.score(table, models, keep=["doc_id"], same=True).collect():
        w = texts[row["doc_id"]].split()
        assert row["n_words"] == len(w)
        for (one, before, two), total, s, name in zip(sides, totals, (totals[1] / totals[0], 1.0),
                                                      ("background_loss", "target_loss")):
            p = [(two[a, b] * s + 20 * (one[b] * s + 0.5) / (total * s + 0.5 * len(sides[0][0])))
                 / (before[a] * s + 20) for a, b in zip([None, *w[:-1]], w)]
            assert not w or np.isclose(row[name], -np.log(p).mean(), rtol=1e-9)


def test_checksums_of_contract(spark):
    row = spark.createDataFrame([(12,)], "doc_id long").select(
        F.crc32(F.col("doc_id").cast("string")).alias("c")).first()
    assert row["c"] == zlib.crc32(b"12")
