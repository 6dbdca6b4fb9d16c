"""The prefix trie against a plain trie of all prefixes."""

from __future__ import annotations

import hashlib
import os
import random
import zlib

import pytest

from __spark_entry__ import SMALLEST
from tidemark.llm import prefix_trie
from tidemark.llm.prefix_trie import ZFastTrie, fattest
from tidemark.llm.queries import QUERIES, rebuilt

SCHEMA = "conv_id long, turn long, role string, text string, place string, ends int"


def in_order(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn, role or "", text or ""))
    return {c: [t[1:] for t in sorted(m, key=lambda t: (t[0] is not None, t[0] or 0))]
            for c, m in convs.items()}


def plain_rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + own[h:]
    return out


def plain_trie(convs):
    members, ended, texts = {}, {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ended.setdefault(tuple(turns), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    out = []
    for node in sorted(members, key=len, reverse=True):
        mine = children.get(node, [])
        leaves = sum(texts[m][0] for m in mine) or 1
        saved = sum(texts[m][1] for m in mine)
        if node:
            saved += (len(members[node]) - 1) * len(node[-1][1])
        texts[node] = leaves, saved
        ids = ",".join(str(c) for c in sorted(ended.get(node, [])))
        out.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None,
                    len(members[node]), len(mine), leaves, saved,
                    hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out, key=str)


def found_in(df):
    return sorted((tuple(r) for r in df.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256").collect()), key=str)


def random_conversations(rng, count):
    turns = [("user", "a"), ("assistant", "b"), ("user", "cc"), (None, "x"), ("tool", None)]
    rows = []
    for c in range(count):
        if rows and rng.random() < 0.4:  # a copy, or a continuation of an earlier one
            other = rng.choice([r[0] for r in rows])
            mine = [r[1:] for r in rows if r[0] == other][:rng.randrange(1, 30)]
        else:
            mine = [(t, *rng.choice(turns)) for t in range(rng.randrange(1, 7))]
        mine += [(50 + t, *rng.choice(turns)) for t in range(rng.choice([0, 0, 1, 3]))]
        rows += [(c, t, *m[1:]) for t, m in enumerate(mine)]
    return rows


@pytest.mark.parametrize("block, batch, tasks", [(4096, 1024, 6), (3, 2, 12), (1, 1, 2)])
def test_trie_equals_the_plain_one(spark, block, batch, tasks):
    rng = random.Random(block)
    rows = random_conversations(rng, 120) + [(None, 1, "user", "nobody's")]
    rows += [(900 + c, t, "user", f"t{t}") for c in range(3) for t in range(8)]
    rows += [(1000, t, "user", f"u{t}") for t in range(20)]
    rng.shuffle(rows)
    spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(5)
        turns = prefix_trie.numbered(df)
        if batch == 2:
            found = found_in(prefix_trie.with_digests(prefix_trie.build(
                turns, block=block, batch_rows=batch)))
            assert found == plain_trie(in_order(rows))
        turns, convs = rebuilt(turns)
        found = found_in(prefix_trie.with_digests(prefix_trie.build(turns, convs, block, batch)))
        assert found == plain_trie(plain_rebuilt(in_order(rows)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_conversations_without_turns(spark):
    convs = spark.createDataFrame([(4,), (2,)], "conv_id long")
    none = spark.createDataFrame([], SCHEMA)
    turns = prefix_trie.numbered(none)
    assert found_in(prefix_trie.with_digests(prefix_trie.build(turns, convs))) == plain_trie(
        {2: [], 4: []})
    assert found_in(prefix_trie.with_digests(prefix_trie.build(turns))) == []


def test_very_long_texts_and_null_turns(spark):
    rows = [(1, None, "user", "x" * 2_000_000), (1, 1, "assistant", "y"),
            (2, None, "user", "x" * 2_000_000), (2, 5, "assistant", "z"), (3, 0, None, None)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    found = found_in(prefix_trie.with_digests(prefix_trie.build(prefix_trie.numbered(df))))
    assert found == plain_trie(in_order(rows))


def test_fat_binary_search():
    for low in range(40):
        for high in range(low + 1, 41):
            best = max(range(low + 1, high + 1), key=lambda n: n & -n)
            assert fattest(low, high) == best
    rng = random.Random(1)
    trie, words = ZFastTrie(b""), []
    for _ in range(300):
        words.append("".join(rng.choice("ab") for _ in range(rng.randrange(12))).encode())
    for start in range(0, 300, 20):
        batch = words[start:start + 20]
        trie.insert([([w[:d] for d in range(len(w) + 1)], 0, w) for w in batch])
        for w in words[:start + 20]:
            node, edge, shared = trie.locate([w[:d] for d in range(len(w) + 1)])
            assert edge == -1 and trie.extent[node] == shared == len(w) and w in trie.ends[node]


@pytest.mark.skipif(not os.path.isdir(SMALLEST), reason="needs the given tables")
def test_trie_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALLEST}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert found_in(QUERIES["op12_prefix_trie"](spark, SMALLEST)) == plain_trie(
        plain_rebuilt(in_order(rows)))
