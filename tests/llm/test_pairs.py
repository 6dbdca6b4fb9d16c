"""Near-duplicate operators against brute force."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from tidemark.llm import projection_dedup, simhash_anchors
from tidemark.llm.components import components


def roots(nodes, links):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(0)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    links += [(1000 + i, 1001 + i) for i in range(150)]  # a long chain
    links += [(2000, 2000 + i) for i in range(1, 200)]  # a star
    table = spark.createDataFrame(links, "a long, b long")
    found = {r["node"]: r["component"] for r in components(table).collect()}
    nodes = {n for link in links if link[0] != link[1] for n in link}
    assert found == roots(nodes, [x for x in links if x[0] != x[1]])
    assert components(table.filter("false")).count() == 0


def plain_fingerprint(text, words=4):
    parts = (text or "").encode().lower().split()
    width = min(words, len(parts))
    hashes = [xxhash.xxh64_intdigest(b" ".join(parts[i:i + width]), 42)
              for i in range(len(parts) - width + 1)] if parts else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_anchors_find_all_pairs_within_distance():
    rng = np.random.default_rng(0)
    prints = rng.integers(0, 1 << 64, 4000, dtype=np.uint64)
    for distance in range(9):
        near = prints.copy()
        for row in range(len(near)):
            for bit in rng.choice(64, rng.integers(0, distance + 1), replace=False):
                near[row] ^= np.uint64(1) << np.uint64(bit)
        met = np.zeros(len(prints), bool)
        for block in simhash_anchors.blocks(distance):
            row, anchor, home = block.anchors(prints)
            assert home.sum() == len(prints)
            at = np.empty(len(prints), np.int64)
            at[row[home]] = anchor[home]
            visitor, visited, _ = block.anchors(near)
            met[visitor[visited == at[visitor]]] = True
        assert met.all()


@pytest.mark.parametrize("side", [simhash_anchors.SIDE_ROWS, 5])
def test_simhash_near_duplicates(spark, monkeypatch, side):
    monkeypatch.setattr(simhash_anchors, "SIDE_ROWS", side)  # 5: crowded anchors are split
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [None, "", " \n", "One", "one two", "A b C", "ÀB c d"]
    for _ in range(25):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(20, 400))]
        for _ in range(rng.randrange(1, 8)):
            copy = list(words)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += [texts[-1]] * 30 + [" ".join(vocabulary * 40)]
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)] + [(9, texts[9], "x", "y")]
    schema = "doc_id long, text string, fingerprint string, component_id string"
    found = simhash_anchors.near_duplicates(spark.createDataFrame(rows, schema).repartition(3)).collect()
    prints = {i: plain_fingerprint(t) for i, t in enumerate(texts)}
    links = [(a, b) for a, b in combinations(prints, 2)
             if (prints[a] ^ prints[b]).bit_count() <= 4]
    expected = roots(prints, links)
    assert len(found) == len(rows)
    for row in found:
        assert row["fingerprint"] == f"{prints[row['doc_id']]:016x}"
        assert row["component_id"] == expected[row["doc_id"]]
    empty = spark.createDataFrame([], schema)
    assert simhash_anchors.near_duplicates(empty).count() == 0
    nameless = spark.createDataFrame([(None, "a b c d e"), (None, "a b c d e"), (4, "a b c d e")],
                                     "doc_id long, text string")
    assert [r["component_id"] for r in simhash_anchors.near_duplicates(nameless).collect()] == [4] * 3


def plain_vectors(rows, threshold):
    good = {}
    for place, (_, vector, label) in enumerate(rows):
        if label is None or vector is None or any(x is None for x in vector):
            continue
        x = np.array(vector, float)
        if len(x) and np.isfinite(x).all() and x.any():
            good[place] = x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max())
    links = [(a, b) for a, b in combinations(good, 2)
             if rows[a][2] == rows[b][2] and len(good[a]) == len(good[b])
             and good[a] @ good[b] >= threshold]
    return links


@pytest.mark.parametrize("block", [projection_dedup.BLOCK, 24])
def test_vectors(spark, block):
    rng = np.random.default_rng(3)
    rows = []
    for group in range(12):
        center = rng.normal(size=16)
        for _ in range(rng.integers(1, 25)):
            near = center + rng.normal(size=16) * rng.choice([0.0, 0.02, 0.1, 0.2])
            rows.append([len(rows), near.astype(np.float32).tolist(), int(group % 2)])
    dense = rng.normal(size=16)  # a component of more vectors than a block of 24
    for _ in range(80):
        near = dense + rng.normal(size=16) * 0.05
        rows.append([len(rows), near.astype(np.float32).tolist(), 7])
    rows += [[len(rows) + i, v, l] for i, (v, l) in enumerate([
        (None, 1), ([], 1), ([0.0] * 16, 1), ([float("nan")] * 16, 1), ([1.0, None], 1),
        ([float("inf")] + [1.0] * 15, 1), ([1.0] * 16, None), ([1.0] * 16, 1), ([2.0] * 16, 1),
        ([1.0, 1.0], 1), ([1e-30, 1e-30], 1), (rows[0][1], 1), (rows[0][1], 0), (rows[0][1], 0)])]
    table = spark.createDataFrame([(*r, 5) for r in rows],
                                  "vec_id long, embedding array<float>, label int, n_links int")
    found = {r["vec_id"]: r for r in projection_dedup.near_duplicates(
        table.repartition(3), block=block).collect()}
    links = plain_vectors(rows, 0.93)
    expected = roots([r[0] for r in rows], links)
    counts = np.bincount(np.array(links).ravel(), minlength=len(rows))
    assert len(found) == len(rows)
    for i in expected:
        assert found[i]["component_id"] == expected[i]
        assert found[i]["n_links"] == counts[i]
        assert found[i]["kept"] == (expected[i] == i)
    assert projection_dedup.near_duplicates(table.filter("false")).count() == 0


def test_repeated_vectors(spark):
    table = spark.createDataFrame([(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [0.0, 1.0], 0)],
                                  "vec_id long, embedding array<double>, label int")
    found = sorted(tuple(r) for r in projection_dedup.near_duplicates(table).collect())
    assert found == [(1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True)]


def test_passes_keep_recall():
    assert projection_dedup.passes_needed(100, 0.93) == 1
    few, many = (projection_dedup.passes_needed(n, 0.93) for n in (10_000, 10_000_000))
    assert 1 < few < many < 200


def _concentrated(rng, count, cosine, dim=64):
    """Vectors of one label whose cosine is ``cosine`` on average, as embeddings mostly are."""
    center = np.eye(dim)[0] * np.sqrt(cosine)
    return center + rng.normal(size=(count, dim)) * np.sqrt((1 - cosine) / dim)


def test_vectors_that_share_a_direction(spark):
    """A label of 60 blocks: every pair above the threshold is found, by passes or in full."""
    rng = np.random.default_rng(8)
    vectors = _concentrated(rng, 1440, 0.8)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    noise = rng.normal(size=unit.shape)
    noise -= (noise * unit).sum(1, keepdims=True) * unit
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    both = np.concatenate([unit, 0.935 * unit + np.sqrt(1 - 0.935 ** 2) * noise])
    table = spark.createDataFrame([(i, v, 1) for i, v in enumerate(both.tolist())],
                                  "vec_id long, embedding array<double>, label int")
    near = np.triu(both @ both.T >= 0.93, 1)
    counts = near.sum(0) + near.sum(1)
    found = projection_dedup.near_duplicates(table.repartition(3), block=48).collect()
    assert [r["n_links"] for r in sorted(found)] == counts.tolist()


def test_passes_follow_from_the_vectors():
    rng = np.random.default_rng(9)
    units = []
    for cosine in (0.0, 0.8):
        x = _concentrated(rng, 4000, cosine)
        units.append(x / np.linalg.norm(x, axis=1, keepdims=True))
    wide, narrow = (projection_dedup.passes_measured(u, 400_000, 0.93) for u in units)
    assert projection_dedup.passes_needed(400_000, 0.93) < wide < narrow


def test_passes_find_planted_pairs(spark, monkeypatch):
    """The windows alone: with the means taken off, no planted pair is missed."""
    rng = np.random.default_rng(10)
    unit = _concentrated(rng, 600, 0.8, 16)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    both = np.concatenate([unit, unit + rng.normal(size=unit.shape) * 0.005])
    table = spark.createDataFrame([(i, v, 1) for i, v in enumerate(both.tolist())],
                                  "vec_id long, embedding array<double>, label int")
    monkeypatch.setattr(projection_dedup, "_passes", lambda *_: 12)
    found = projection_dedup.near_duplicates(table, block=24, threshold=0.995).collect()
    unit = both / np.linalg.norm(both, axis=1, keepdims=True)
    near = np.triu(unit @ unit.T >= 0.995, 1)
    assert [r["n_links"] for r in sorted(found)] == (near.sum(0) + near.sum(1)).tolist()


def test_vectors_pass_by_turns_and_leave_little_on_disk(spark, monkeypatch):
    """What all passes need at once, their keys and windows, was there until the session ended."""
    import pathlib

    rng = np.random.default_rng(5)
    some = rng.normal(size=(300, 8))
    both = np.concatenate([some, some + 0.02 * rng.normal(size=some.shape)])
    both /= np.linalg.norm(both, axis=1, keepdims=True)
    table = spark.createDataFrame([(i, v, 1) for i, v in enumerate(both.tolist())],
                                  "vec_id long, embedding array<double>, label int")
    folder = pathlib.Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")) / "tidemark"
    before = set(folder.iterdir()) if folder.exists() else set()
    for name in ("KEY_ROWS", "WINDOW_ROWS"):
        monkeypatch.setattr(projection_dedup, name, 1)
    found = projection_dedup.near_duplicates(table, block=24).collect()
    left = {p.name.rpartition("-")[0] for p in set(folder.iterdir()) - before}
    near = np.triu(both @ both.T >= 0.93, 1)
    assert [r["n_links"] for r in sorted(found)] == (near.sum(0) + near.sum(1)).tolist()
    assert "vector-passes" in left and "vector-results" in left
    assert not left & {"vectors", "vector-keys", "vector-ranks", "vector-blocks",
                       "vectors-of-passes"}
