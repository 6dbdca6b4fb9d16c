"""Prefix trie of conversations, built as z-fast tries.

A node of depth d is a distinct sequence of the first d turns (role and text) of some conversation.
Prefixes are known by 128-bit hashes: the exclusive or of a hash of each turn with its place, so that
those of a conversation can be summed in parts and in any order.

Conversations are range-sorted by their sequences of turns. Each task builds the compacted trie of its
share: a hash table maps the prefix of two-fattest length within a compacted node's edge (its handle)
to the node, a conversation's exit node is located by fat binary search over its prefix lengths, and
conversations are inserted in batches, all of a batch being located before any is inserted. Edges are
then expanded into one row for each depth. Only prefixes of the first and last conversation of a share
can lie in other shares, too: their sums are added up, less what neighbouring shares both counted,
which is one chain of prefixes at each bound. A prefix that a third of all conversations share thus
spans many tasks.

A conversation is taken in blocks of turns, the trie of a block hanging below the prefix that leads to
it. Blocks that one conversation alone reaches are expanded without a trie. So a conversation of any
length spans tasks, and an array has no more than ``block`` turns.

Turns are taken by ``turn`` (null first); turns of one number in the order of their hashes. A null role
or text counts as empty. Rows without a ``conv_id`` belong to no conversation and are left out. Equal
conversations are members of the same nodes. Columns other than the four are not read. An empty table
gives no node, not even a root.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.digests import streamed_sha256
from tidemark.llm.frames import kept
from tidemark.session import new_folder

#: Turns of a conversation that one array holds.
BLOCK_TURNS = 4096
#: Conversations that are located before any of them is inserted.
BATCH = 1024

_HASHES = ["h1", "h2"]


def numbered(conversations: DataFrame) -> DataFrame:
    """Hashes ``t1``, ``t2`` and code points ``chars`` of every turn, and its ``place`` from 0.

    Turns are range-sorted, numbered inside each task, and moved on by the turns that their
    conversation has in earlier tasks: only the first and last conversation of a task can have any.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id is not null").select(
        "conv_id", "turn", F.xxhash64(role, text).alias("t1"),
        F.xxhash64(F.lit(1), role, text).alias("t2"),
        F.char_length(text).cast("bigint").alias("chars"),
        F.monotonically_increasing_id().alias("row"))
    order = ["conv_id", "turn", "t1", "t2", "row"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", "t1", "t2", "chars")
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in rows.schema],
                           T.StructField("place", T.LongType()),
                           T.StructField("slice", T.IntegerType()),
                           T.StructField("total", T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, last, had, first_had = TaskContext.get().partitionId(), None, None, 0, None
        kind = None
        for batch in batches:
            count = batch.num_rows
            if not count:
                continue
            ids = batch.column(0)
            kind = ids.type
            new = np.zeros(count, bool)
            new[1:] = pc.not_equal(ids.slice(1), ids.slice(0, count - 1)).to_numpy(
                zero_copy_only=False)
            new[0] = last is None or ids[0].as_py() != last
            if first is None:
                first = ids[0].as_py()
            place = np.arange(count)
            starts = np.flatnonzero(new)
            if first_had is None and len(starts) and (last is not None or len(starts) > 1):
                first_had = had + int(starts[0] if last is not None else starts[1])
            since = np.maximum.accumulate(np.where(new, place, -1))
            place = np.where(since < 0, place + had, place - since)
            had, last = int(place[-1]) + 1, ids[count - 1].as_py()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(place), pa.array(np.full(count, part, np.int32)),
                 pa.nulls(count, pa.int64())], schema.names)
        if first is not None:
            ends = [(first, had)] if first_had is None else [(first, first_had), (last, had)]
            empty = pa.nulls(len(ends), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([e[0] for e in ends], kind), empty, empty, empty, empty,
                 pa.array([part] * len(ends), pa.int32()),
                 pa.array([e[1] for e in ends], pa.int64())], schema.names)

    rows = kept(rows.mapInArrow(number, schema), "trie-turns")
    # two rows for each task of the sort at most
    before = F.sum("total").over(Window.partitionBy("conv_id").orderBy("slice").rowsBetween(
        Window.unboundedPreceding, -1))
    carried = (rows.filter("total is not null").select("conv_id", "slice", before.alias("before"))
               .filter("before is not null"))
    return (rows.filter("total is null").join(F.broadcast(carried), ["conv_id", "slice"], "left")
            .select("conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("place"),
                    "t1", "t2", "chars"))


def fattest(low: int, high: int) -> int:
    """The number in (low, high] that the highest power of two divides."""
    return high & -(1 << ((low ^ high).bit_length() - 1))


class ZFastTrie:
    """The compacted trie of sequences given by the hashes of all their prefixes."""

    def __init__(self, root: bytes):
        self.extent, self.name, self.parent = [0], [0], [-1]
        self.key = [root]  # hash of the extent
        self.path: list[list[bytes]] = [[root]]  # prefixes of a sequence through the node
        self.owner, self.ends = [-1], [[]]
        self.handles: dict[bytes, int] = {}
        self.heads: dict[bytes, int] = {}  # by the first prefix on the edge
        self._changed: dict[int, int] = {}
        self._batch = 0

    def locate(self, prefixes: list[bytes], node: int = 0) -> tuple[int, int, int]:
        """The deepest node whose extent begins the sequence, the node on whose edge the sequence
        leaves the trie (-1 if it leaves at a node), and how many turns both share."""
        size = len(prefixes) - 1
        low, high = self.extent[node], size
        while low < high:
            middle = fattest(low, high)
            found = self.handles.get(prefixes[middle])
            if found is None:
                high = middle - 1
                continue
            extent = self.extent[found]
            if extent <= size and prefixes[extent] == self.key[found]:
                low, node = extent, found
            else:
                return self.parent[found], found, self._shared(prefixes, found, middle)
        # it leaves the trie here, or on the edge that begins with its next turn, above the handle
        found = self.heads.get(prefixes[low + 1], -1) if low < size else -1
        return node, found, low if found < 0 else self._shared(prefixes, found, low + 1)

    def _shared(self, prefixes: list[bytes], node: int, least: int) -> int:
        path = self.path[node]
        most = min(self.extent[node], len(prefixes) - 1)
        while least < most:
            middle = (least + most + 1) // 2
            if prefixes[middle] == path[middle]:
                least = middle
            else:
                most = middle - 1
        return least

    def _add(self, parent: int, extent: int, prefixes: list[bytes], owner: int) -> int:
        node = len(self.extent)
        self.extent.append(extent)
        self.name.append(self.extent[parent])
        self.parent.append(parent)
        self.key.append(prefixes[extent])
        self.path.append(prefixes)
        self.owner.append(owner)
        self.ends.append([])
        self._enter(node)
        return node

    def _enter(self, node: int) -> None:
        low, path = self.name[node], self.path[node]
        self.handles[path[fattest(low, self.extent[node])]] = node
        self.heads[path[low + 1]] = node

    def insert(self, batch: list[tuple[list[bytes], int, object]]) -> list[int]:
        """Insert sequences as (prefixes, owner, what ends there); returns the node of each."""
        self._batch += 1
        places = [self.locate(prefixes) for prefixes, _, _ in batch]
        nodes = []
        for (prefixes, owner, ending), place in zip(batch, places, strict=True):
            node, edge, shared = place
            if self._batch in (self._changed.get(node), self._changed.get(edge)):
                # an earlier one of the batch was inserted here: go on from where it was located
                node, edge, shared = self.locate(prefixes, node)
            size = len(prefixes) - 1
            if edge >= 0:
                node = self._split(edge, shared)
            if shared < size:
                self._changed[node] = self._batch
                node = self._add(node, size, prefixes, owner)
            self.ends[node].append(ending)
            nodes.append(node)
        return nodes

    def _split(self, node: int, extent: int) -> int:
        path, low = self.path[node], self.name[node]
        del self.handles[path[fattest(low, self.extent[node])]]
        upper = self._add(self.parent[node], extent, path, self.owner[node])
        self.parent[node], self.name[node] = upper, extent
        self._enter(node)
        self._changed[node] = self._changed[upper] = self._batch
        self._changed[self.parent[upper]] = self._batch
        return upper


def _joined(first: np.ndarray, second: np.ndarray) -> list[bytes]:
    data = np.stack([first, second], 1).astype(np.int64).tobytes()
    return [data[i:i + 16] for i in range(0, len(data), 16)]


def _halves(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


_SUMS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]


def _share_schema(conv: T.DataType) -> T.StructType:
    longs = ["depth", "h1", "h2", "p1", "p2", *_SUMS]
    return T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("slice", T.IntegerType()),
        T.StructField("conv_id", conv), T.StructField("parent_conv_id", conv),
        *[T.StructField(c, T.LongType()) for c in longs],
        T.StructField("ends", T.ArrayType(conv)),
        *[T.StructField(c, T.ArrayType(T.LongType()))
          for c in ("first", "first_chars", "last", "last_chars", "below")]])


class _Share:
    """One task's rows of a level: sequences, sorted, with their roots."""

    def __init__(self, table: pa.Table, batch_rows: int):
        self.convs = table.column("conv_id").to_pylist()
        seq = table.column("seq").combine_chunks()
        items = seq.flatten()
        self.sizes = pc.list_value_length(seq).to_numpy(zero_copy_only=False).astype(np.int64)
        high = np.cumsum(self.sizes)
        self.starts = high - self.sizes
        self.chars = items.field("chars").to_numpy(zero_copy_only=False).astype(np.int64)
        self.roots = [table.column(c).to_numpy() for c in ("r1", "r2")]
        lanes = []
        for root, name in zip(self.roots, ("x1", "x2"), strict=True):
            # prefixes of each sequence, its root first
            x = items.field(name).to_numpy(zero_copy_only=False)
            run = np.concatenate([[0], np.bitwise_xor.accumulate(x)]) if len(x) else np.zeros(1, int)
            at = np.repeat(np.arange(len(self.sizes)), self.sizes + 1)
            place = np.arange(len(at)) - (self.starts + np.arange(len(self.sizes)))[at]
            lanes.append(run[self.starts[at] + place] ^ run[self.starts[at]] ^ root[at])
        self.keys = _joined(*lanes)
        self.bases = table.column("base").to_numpy()
        self.tops = table.column("top").to_pylist()
        self.more = table.column("more").to_numpy(zero_copy_only=False).astype(bool)
        self.below = np.stack([table.column(c).to_numpy() for c in
                               ("b_children", "b_leaves", "b_saved")], 1)
        self.batch_rows = batch_rows
        self.run = np.concatenate([[0], np.cumsum(self.chars)])

    def prefixes(self, row: int) -> list[bytes]:
        start = self.starts[row] + row
        return self.keys[start:start + self.sizes[row] + 1]

    def tries(self) -> Iterator[tuple[int, int]]:
        """First and last row of each root."""
        changes = np.flatnonzero((np.diff(self.roots[0]) != 0) | (np.diff(self.roots[1]) != 0)) + 1
        bounds = [0, *changes.tolist(), len(self.convs)]
        yield from zip(bounds[:-1], bounds[1:], strict=True)

    def rows(self, low: int, high: int, outer: bool) -> dict[str, list]:
        """The expanded nodes of the trie of rows low to high. ``outer``: it may go on elsewhere."""
        first = self.prefixes(low)
        trie = ZFastTrie(first[0])
        batch, members = [], []
        for row in range(low, high):
            prefixes = self.prefixes(row)
            if row > low and prefixes[-1] == members[-1][0]:
                members[-1][1].append(row)
                continue
            members.append((prefixes[-1], [row]))
            batch.append((prefixes, row, members[-1][1]))
            if len(batch) == self.batch_rows:
                trie.insert(batch)
                batch = []
        trie.insert(batch)
        count = len(trie.extent)
        extent, name = np.array(trie.extent), np.array(trie.name)
        cnt, leaves, saved = (np.zeros(count, np.int64) for _ in range(3))
        children, final = np.zeros(count, np.int64), np.zeros(count, np.int64)
        lowest: list = [None] * count
        ends: list[list] = [[] for _ in range(count)]
        spread = [False] * count
        owner = np.array(trie.owner)
        start = np.where(owner < 0, 0, self.starts[owner])
        for node in np.argsort(-extent, kind="stable").tolist():
            for rows in trie.ends[node]:
                cnt[node] += len(rows)
                least = min(self.convs[r] for r in rows)
                if lowest[node] is None or least < lowest[node]:
                    lowest[node] = least
                ends[node] += [self.convs[r] for r in rows if not self.more[r]]
                on = next((r for r in rows if self.more[r]), None)
                if on is not None:
                    final[node] = 1
                    children[node] += self.below[on, 0]
                    leaves[node] += self.below[on, 1]
                    saved[node] += self.below[on, 2]
            if not children[node]:
                leaves[node] = 1
            parent = trie.parent[node]
            if parent >= 0:
                edge = self.run[start[node] + extent[node]] - self.run[start[node] + name[node]]
                saved[node] += (cnt[node] - 1) * edge
                cnt[parent] += cnt[node]
                children[parent] += 1
                leaves[parent] += leaves[node]
                saved[parent] += saved[node]
                if lowest[parent] is None or lowest[node] < lowest[parent]:
                    lowest[parent] = lowest[node]
        if self.bases[low]:
            lowest[0] = self.tops[low]
        for row, edge in ((low, low == 0), (high - 1, high == len(self.convs))):
            if outer and edge:
                node = trie.locate(self.prefixes(row))[0]
                while node >= 0:
                    spread[node], node = True, trie.parent[node]
        spread[0] = True
        # expand the edges: one row for each depth of a node; the root has one
        lengths = extent - name
        lengths[0] = 1
        of = np.repeat(np.arange(count), lengths)
        step = np.arange(len(of)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        depth = name[of] + 1 + step
        depth[0] = 0
        bottom = depth == extent[of]
        top = step == 0
        spent = self.run[start[of] + np.maximum(depth - 1, 0)] - self.run[start[of] + name[of]]
        spent[0] = 0
        above = np.array(trie.parent)[of]
        spine = np.array(spread)
        low_of = np.array(lowest + [None], object)[:-1]
        open_parent = top & (above >= 0) & spine[above]
        keyed = spine[of] | open_parent
        keys = [trie.path[n][d] if k else b"\0" * 16
                for n, d, k in zip(of.tolist(), depth.tolist(), keyed.tolist(), strict=True)]
        parents = [trie.path[n][d - 1] if k and d else b"\0" * 16
                   for n, d, k in zip(of.tolist(), depth.tolist(), keyed.tolist(), strict=True)]
        (h1, h2), (p1, p2) = _halves(keys), _halves(parents)
        kinds = np.where(spine[of], "spine", np.where(open_parent, "open", "node"))
        return {
            "kind": kinds.tolist(), "conv_id": low_of[of].tolist(),
            "parent_conv_id": np.where(
                keyed, None, np.where(top, low_of[above], low_of[of])).tolist(),
            "depth": depth + self.bases[low], "h1": h1, "h2": h2, "p1": p1, "p2": p2,
            "n_convs": cnt[of], "n_children": np.where(bottom, children[of], 1),
            "n_leaves": leaves[of], "saved_tokens": saved[of] - (cnt[of] - 1) * spent,
            "ends": [ends[n] if b else [] for n, b in zip(of.tolist(), bottom.tolist(),
                                                          strict=True)]}

    def edges(self) -> dict[str, list]:
        """The first and last sequence, for the bounds to the neighbouring shares."""
        out = {}
        for name, row in (("first", 0), ("last", len(self.convs) - 1)):
            halves = _halves(self.prefixes(row))
            out[name] = [np.stack(halves, 1).ravel().tolist()]
            out[f"{name}_chars"] = [self.chars[
                self.starts[row]:self.starts[row] + self.sizes[row]].tolist()]
        out["below"] = [[int(self.more[-1]), *self.below[-1].tolist()]]
        return out


def _shares(rows: DataFrame, batch_rows: int) -> DataFrame:
    """Nodes of each task's trie: finished ones, those with an open parent, and the spine."""
    order = ["r1", "r2", "seq", "more", "conv_id"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = _share_schema(rows.schema["conv_id"].dataType)
    arrow = to_arrow_schema(schema)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        share, number = _Share(pa.Table.from_batches(held), batch_rows), \
            TaskContext.get().partitionId()
        del held

        def batch(columns: dict) -> pa.RecordBatch:
            count = len(next(iter(columns.values())))
            columns["slice"] = np.full(count, number, np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], f.type) if f.name in columns
                 else pa.nulls(count, f.type) for f in arrow], schema=arrow)

        for low, high in share.tries():
            yield batch(share.rows(low, high, low == 0 or high == len(share.convs)))
        yield batch({"kind": ["bound"], **share.edges()})

    folder = new_folder(rows.sparkSession, "trie-shares")
    rows.mapInArrow(apply, schema).write.partitionBy("kind").option(
        "compression", "zstd").parquet(folder)
    return rows.sparkSession.read.schema(schema).parquet(folder)


def _corrections(bounds: DataFrame) -> DataFrame:
    """What two neighbouring shares both counted, as sums to add to the prefixes they share."""
    after = Window.orderBy("slice")  # one row for each task of the sort
    pairs = bounds.select("slice", "last", "last_chars", "below",
                          F.lead("first").over(after).alias("next")).filter("next is not null")
    schema = T.StructType([T.StructField(c, T.LongType()) for c in (*_HASHES, *_SUMS)])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                last, first = (np.array(row[c], np.int64).reshape(-1, 2) for c in ("last", "next"))
                most = min(len(last), len(first))
                apart = np.flatnonzero((last[:most] != first[:most]).any(1))
                count = int(apart[0]) if len(apart) else most  # prefixes in both, the root first
                if not count:
                    continue
                chars = np.array([0, *row["last_chars"][:count - 1]], np.int64)
                children, leaves = np.full(count, -1), np.zeros(count, np.int64)
                saved = np.cumsum(chars[::-1])[::-1]
                children[-1] = 0
                if len(last) == count:  # the last conversation's sequence ends at the deepest
                    more, *below = row["below"]
                    leaves[:] = -below[1] if more else -1
                    children[-1] = -below[0] if more else 0
                    saved = saved - (below[2] if more else 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a) for a in (last[:count, 0], last[:count, 1],
                                           np.zeros(count, np.int64), children, leaves, saved)],
                    schema.names)

    return pairs.mapInArrow(apply, schema)


@dataclass(frozen=True)
class Trie:
    """``nodes``: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, the four sums, the
    hash ``h1``, ``h2`` and ``ends``, the members that end there in ascending order. Where ``ends`` is
    null they are in ``split``, in several rows: ``h1``, ``h2``, ``part``, ``ends``."""

    nodes: DataFrame
    split: DataFrame


def _level(rows: DataFrame, base: int, batch_rows: int) -> tuple[Trie, DataFrame]:
    """The nodes of all tries of a level, and their roots, which are nodes of the level above."""
    found = _shares(rows, batch_rows)
    spine = found.filter("kind = 'spine'")
    zero = F.lit(None)
    conv = spine.schema["conv_id"].dataType
    extra = _corrections(found.filter("kind = 'bound'")).select(
        zero.cast(conv).alias("conv_id"), zero.cast("bigint").alias("depth"),
        zero.cast("bigint").alias("p1"), zero.cast("bigint").alias("p2"), *_HASHES, *_SUMS)
    merged = kept(
        spine.select("conv_id", "depth", "p1", "p2", *_HASHES, *_SUMS).unionByName(extra)
        .groupBy(*_HASHES).agg(*[F.min(c).alias(c) for c in ("conv_id", "depth", "p1", "p2")],
                               *[F.sum(c).alias(c) for c in _SUMS]), "trie-spine")
    names = merged.select(F.col("h1").alias("p1"), F.col("h2").alias("p2"),
                          F.col("conv_id").alias("parent"))
    # a parent in each share of its own, so that the children of one node stay spread over tasks
    here = spine.select("slice", F.col("h1").alias("p1"), F.col("h2").alias("p2")).join(
        names, ["p1", "p2"])
    columns = ["conv_id", "depth", "parent_conv_id", *_SUMS, *_HASHES, "ends"]
    opened = found.filter("kind = 'open'").drop("parent_conv_id").join(
        here, ["slice", "p1", "p2"]).withColumnRenamed("parent", "parent_conv_id")
    inner = merged.filter(F.col("depth") > base).join(names, ["p1", "p2"]).withColumnRenamed(
        "parent", "parent_conv_id")
    empty = F.lit(None).cast(found.schema["ends"].dataType).alias("ends")
    nodes = (found.filter("kind = 'node'").select(*columns)
             .unionByName(opened.select(*columns))
             .unionByName(inner.select(*columns[:-1], empty)))
    split = spine.filter((F.size("ends") > 0)).select(*_HASHES, F.col("slice").alias("part"),
                                                      "ends")
    return Trie(nodes, split), merged.filter(F.col("depth") == base)


def _blocks(turns: DataFrame, convs: DataFrame, block: int) -> DataFrame:
    """Each conversation's turns in arrays of ``block``; one without turns has an empty array."""
    item = F.struct("place", "t1", "t2", F.xxhash64("t1", "t2", "place").alias("x1"),
                    F.xxhash64(F.lit(1), "t1", "t2", "place").alias("x2"), "chars")
    rows = turns.select("conv_id", F.expr(f"place div {block}").alias("block"),
                        item.alias("item"))
    rows = rows.unionByName(convs.select(
        "conv_id", F.lit(0).cast("bigint").alias("block"),
        F.lit(None).cast(rows.schema["item"].dataType).alias("item")))
    packed = rows.groupBy("conv_id", "block").agg(F.collect_list("item").alias("items"),
                                                  F.bit_xor("item.x1").alias("s1"),
                                                  F.bit_xor("item.x2").alias("s2"))
    return packed.withColumn("seq", F.transform(
        F.sort_array("items"), lambda i: i.dropFields("place"))).drop("items")


def build(turns: DataFrame, convs: DataFrame | None = None, block: int = BLOCK_TURNS,
          batch_rows: int = BATCH) -> Trie:
    """The trie of conversations whose turns are numbered as by :func:`numbered`. ``convs`` names the
    conversations, without which those that have no turn are not known."""
    if convs is None:
        convs = turns.select("conv_id").distinct()
    blocks = kept(_blocks(turns, convs, block), "trie-blocks")
    size = F.size("seq")
    zeros = {c: F.lit(0).cast("bigint") for c in ("r1", "r2")}
    short = blocks.filter((F.col("block") == 0) & (size < block)).withColumns(
        {**zeros, "more": F.lit(False), "top": F.lit(None).cast(blocks.schema["conv_id"].dataType)})
    # of conversations of several blocks: the prefix that leads to each, and whether it goes on
    chain = Window.partitionBy("conv_id").orderBy("block")
    earlier = chain.rowsBetween(Window.unboundedPreceding, -1)
    narrow = blocks.filter((F.col("block") > 0) | (size == block)).select(
        "conv_id", "block", "s1", "s2", (size == block).alias("full"),
        *[F.coalesce(F.bit_xor(f"s{i}").over(earlier), F.lit(0)).alias(f"r{i}") for i in (1, 2)],
        F.lead("block").over(chain).isNotNull().alias("more"))
    shared = narrow.groupBy("block", "r1", "r2").agg((F.count(F.lit(1)) > 1).alias("shared"))
    # the smallest member of a prefix that ends a block, also of those that end there
    tops = narrow.filter("full").groupBy(
        (F.col("block") + 1).alias("block"), F.col("r1").bitwiseXOR(F.col("s1")).alias("r1"),
        F.col("r2").bitwiseXOR(F.col("s2")).alias("r2")).agg(F.min("conv_id").alias("top"))
    narrow = kept(narrow.drop("s1", "s2", "full").join(shared, ["block", "r1", "r2"])
                  .join(tops, ["block", "r1", "r2"], "left"), "trie-chains")
    long = blocks.join(narrow, ["conv_id", "block"])
    deepest = narrow.filter("shared").agg(F.max("block")).first()[0] or 0
    solo = long.filter("not shared and block > 0")
    conv = blocks.schema["conv_id"].dataType
    start = F.col("block") * block
    alone = solo.filter(size > 0).select(
        "conv_id", "more", "top", (start + 1).alias("begin"), (start + size).alias("end"),
        F.explode(F.sequence(start + 1, start + size)).alias("depth"))
    ends = (F.col("depth") == F.col("end")) & ~F.col("more")
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    parts = [Trie(alone.select(
        "conv_id", "depth", F.when(F.col("depth") == F.col("begin"), F.col("top"))
        .otherwise(F.col("conv_id")).alias("parent_conv_id"), one.alias("n_convs"),
        F.when(ends, none).otherwise(one).alias("n_children"), one.alias("n_leaves"),
        none.alias("saved_tokens"), none.alias("h1"), none.alias("h2"),
        F.when(ends, F.array("conv_id")).otherwise(F.array().cast(T.ArrayType(conv)))
        .alias("ends")), None)]
    roots = None
    for level in range(int(deepest), -1, -1):
        rows = long.filter(f"block = {level}" + (" and shared" if level else "")).drop("shared")
        if not level:
            rows = rows.unionByName(short)
        rows = rows.withColumns({"n1": F.col("r1").bitwiseXOR(F.coalesce("s1", none)),
                                 "n2": F.col("r2").bitwiseXOR(F.coalesce("s2", none)),
                                 "base": F.lit(level * block).cast("bigint")})
        below = {"b_children": 1, "b_leaves": 1, "b_saved": 0}
        if roots is not None:
            rows = rows.join(roots, ["n1", "n2"], "left")
        else:
            rows = rows.withColumns({c: F.lit(None).cast("bigint") for c in below})
        # a block below that no other conversation reaches has one child, one leaf and no saving
        rows = rows.withColumns({c: F.when(F.col("more"), F.coalesce(c, F.lit(v).cast("bigint")))
                                 .otherwise(none) for c, v in below.items()})
        trie, top = _level(rows.select("r1", "r2", "seq", "more", "conv_id", "top", "base", *below),
                           level * block, batch_rows)
        parts.append(trie)
        roots = top.select(F.col("h1").alias("n1"), F.col("h2").alias("n2"),
                           F.col("n_children").alias("b_children"),
                           F.col("n_leaves").alias("b_leaves"),
                           F.col("saved_tokens").alias("b_saved"))
    empty = F.lit(None).cast(T.ArrayType(conv)).alias("ends")
    root = top.select("conv_id", none.alias("depth"), F.lit(None).cast(conv).alias("parent_conv_id"),
                      *_SUMS, *_HASHES, empty)
    tries = [p for p in parts if p.split is not None]
    return Trie(reduce(DataFrame.unionByName, [p.nodes for p in parts]).unionByName(root),
                reduce(DataFrame.unionByName, [t.split for t in tries]))


def with_digests(trie: Trie) -> DataFrame:
    """The nodes with ``ends_sha256``, the hash of the members that end there, joined by commas."""
    ids = F.array_join(F.transform("ends", lambda c: c.cast("string")), ",")
    key = F.concat_ws(":", *_HASHES)
    split = streamed_sha256(trie.split.select(key.alias("_key"), "part", ids.alias("ids")), ",")
    whole = trie.nodes.filter("ends is not null").withColumn("ends_sha256", F.sha2(ids, 256))
    rest = trie.nodes.filter("ends is null").withColumn("_key", key).join(split, "_key", "left")
    return whole.drop("ends").unionByName(rest.withColumn(
        "ends_sha256", F.coalesce("sha256", F.sha2(F.lit(""), 256))).drop(
            "ends", "_key", "sha256"))
