"""Byte-level BPE by ranks, on padded matrices, and its decoding.

A text is split by the tokenizer's pattern. The distinct pieces of a batch are laid out by length
as rows of a matrix of token ids. In each round every row merges its leftmost pair of lowest rank;
pairs are looked up in a hash table of arrays, and rows are compacted. Rows without a pair that can
merge leave the matrix. Pieces of more than ``LONGEST`` bytes, whose many rounds would cost the
square of their length, are merged with a heap instead, by the same order of merges.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm import words
from tidemark.llm.frames import binaries, chunks, with_results
from tidemark.llm.pieces import PieceCache, ranges

LONGEST = 256
_NONE = np.int64(1) << np.int64(40)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Rank of a pair of ids, by open addressing in arrays; the rank is the id of the merged pair."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        self.bits = max(4, int(len(keys) * 2).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, _NONE, np.int64)
        mask, place, left = (1 << self.bits) - 1, self._place(keys), np.arange(len(keys))
        self.probes = 0
        while len(left):
            self.probes += 1
            empty = self.keys[place[left]] == -1
            self.keys[place[left[empty]]] = keys[left[empty]]  # of equal places the last one stays
            done = self.keys[place[left]] == keys[left]
            self.ranks[place[left[done]]] = ranks[left[done]]
            left = left[~done]
            place[left] = (place[left] + 1) & mask
        self.mask = mask

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        shape, keys = left.shape, (left.astype(np.int64) << 32 | right).ravel()
        place = self._place(keys)
        found = np.full(len(keys), _NONE, np.int64)
        hit = self.keys[place] == keys
        found[hit] = self.ranks[place[hit]]
        open_ = np.flatnonzero(~hit & (self.keys[place] != -1))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            place[open_] = (place[open_] + 1) & self.mask
            at = self.keys[place[open_]]
            hit = at == keys[open_]
            found[open_[hit]] = self.ranks[place[open_[hit]]]
            open_ = open_[~hit & (at != -1)]
        return found.reshape(shape)


class ByteBpe:
    """Encoder and decoder for the ranks in ``file`` (base64 of the bytes, then the rank, a line
    each) and a pattern that cuts the text into pieces."""

    def __init__(self, file: str, pattern: str) -> None:
        import regex
        with open(file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = [(ranks[t[:cut]] << 32 | ranks[t[cut:]], rank) for t, rank in ranks.items()
                 for cut in range(1, len(t)) if t[:cut] in ranks and t[cut:] in ranks]
        self.pairs = PairTable(*(np.array(x, np.int64) for x in zip(*pairs)))
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.firsts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.cache = PieceCache(self.encode_pieces)

    def _merge_rows(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of equal length, one piece each: the merged ids row after row, and their counts."""
        count, width = rows.shape
        out = np.zeros((count, width), np.int64)
        size = np.full(count, width)
        where, length = np.arange(count), np.full(count, width)
        rank = self.pairs(rows[:, :-1], rows[:, 1:]) if width > 1 else np.zeros((count, 0), np.int64)
        while rank.shape[1]:
            best = rank.argmin(1)  # the leftmost of the lowest
            low = rank[np.arange(len(rank)), best]
            done = low == _NONE
            if done.any():
                out[where[done], : rows.shape[1]] = rows[done]
                size[where[done]] = length[done]
                rows, rank, where, length, best, low = (
                    x[~done] for x in (rows, rank, where, length, best, low))
                if not len(rows):
                    return out[np.arange(width) < size[:, None]], size
            some = np.arange(len(rows))
            column = np.arange(rows.shape[1] - 1)
            rows[some, best] = low
            rows = np.where(column <= best[:, None], rows[:, :-1], rows[:, 1:])
            column = column[:-1]
            rank = np.where(column <= best[:, None], rank[:, :-1], rank[:, 1:])
            length = length - 1
            for side, ok in ((best - 1, best > 0), (best, best < length - 1)):
                at = np.flatnonzero(ok)
                if len(at):
                    rank[at, side[at]] = self.pairs(rows[at, side[at]], rows[at, side[at] + 1])
        out[where, : rows.shape[1]] = rows
        size[where] = length
        return out[np.arange(width) < size[:, None]], size

    def _merge_long(self, piece: bytes) -> list[int]:
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        token = [piece[i:i + 1] for i in range(len(piece))]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(r, i, 1, 1) for i in range(len(ids) - 1)
                if (r := self.ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, left, a, b = heapq.heappop(heap)
            right = after[left] if token[left] else len(ids)
            if right >= len(ids) or (len(token[left]), len(token[right])) != (a, b):
                continue
            token[left] += token[right]
            token[right], ids[left] = b"", rank
            after[left] = after[right]
            if after[left] < len(ids):
                before[after[left]] = left
            for i in (before[left], left):
                if i >= 0 and after[i] < len(ids):
                    x, y = token[i], token[after[i]]
                    if (r := self.ranks.get(x + y)) is not None:
                        heapq.heappush(heap, (r, i, len(x), len(y)))
        return [i for i, t in zip(ids, token) if t]

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces one after the other, and their counts."""
        raw = [p.encode() for p in pieces]
        size = np.array([len(r) for r in raw], np.int64)
        first = np.cumsum(size) - size
        data = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        counts, parts, order = np.zeros(len(raw), np.int64), [], []
        for width in np.unique(size[size <= LONGEST]).tolist():
            of_width = np.flatnonzero(size == width)
            for at in np.array_split(of_width, -(-len(of_width) * max(width, 1) // 2_000_000)):
                merged, counts[at] = self._merge_rows(data[first[at][:, None] + np.arange(width)])
                parts.append(merged)
                order.append(at)
        for at in np.flatnonzero(size > LONGEST).tolist():
            merged = np.array(self._merge_long(raw[at]), np.int64)
            counts[at] = len(merged)
            parts.append(merged)
            order.append(np.array([at]))
        if not order:
            return np.zeros(0, np.int64), counts
        order = np.concatenate(order)
        begins = np.zeros(len(raw), np.int64)
        begins[order] = np.cumsum(counts[order]) - counts[order]
        return np.concatenate(parts)[ranges(begins, counts)], counts

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and their number for each text."""
        points, bounds = words.code_points(texts)
        good = words.steady_texts(points, bounds)
        pieces = words.split(points, bounds, spaced=True, digits=False)
        if not good.all():  # these texts' pieces by the pattern itself
            own = good[pieces.text]
            start, end, text = pieces.start[own], pieces.end[own], pieces.text[own]
            found = [(bounds[i] + m.start(), bounds[i] + m.end(), i) for i in np.flatnonzero(~good)
                     for m in self.pattern.finditer(texts[i])]
            more = np.array(found, np.int64).reshape(-1, 3)
            start, end, text = (np.concatenate([x, y]) for x, y in zip((start, end, text), more.T))
            order = np.argsort(start, kind="stable")
            pieces = words.Pieces(points, start[order], end[order], text[order])
        ids, count = self.cache.lookup(pieces, "".join(texts))
        return ids, np.bincount(pieces.text, weights=count, minlength=len(texts)).astype(np.int64)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that the ids stand for."""
        ids = ids.astype(np.int64)
        return self.bytes[ranges(self.firsts[ids], self.sizes[ids])]


@functools.cache
def byte_bpe(file: str, pattern: str) -> ByteBpe:
    """One for each worker, file and pattern; its cache serves all tasks of the worker."""
    return ByteBpe(file, pattern)


def encode(df: DataFrame, file: str, pattern: str, text: str = "text", ids: str = "ids",
           keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with the ids of each whole text, little-endian unsigned
    32-bit integers in a binary column. A null text is as an empty one: no ids. A column of the
    name ``ids`` is replaced. Rows are neither joined nor dropped, and repeated rows stay."""
    def make():
        coder = byte_bpe(file, pattern)

        def of(texts):
            parts = [coder.encode(group) for _, group in chunks(texts)]
            data = np.concatenate([p[0] for p in parts]).astype("<u4")
            return [binaries(data, 4 * np.concatenate([p[1] for p in parts]))]
        return of

    return with_results(df, text, f"`{ids}` binary", make, keep)


def decode(df: DataFrame, file: str, pattern: str, ids: str = "ids", data: str = "data",
           keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with the bytes that the ids stand for, in a binary column.
    Null ids give no bytes; an id that the file does not hold is an error."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    keep = [c for c in (df.columns if keep is None else keep) if c != data]
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{ids}`").alias("_ids_to_decode"))
    schema = T.StructType([rows.schema[c] for c in keep] + [T.StructField(data, T.BinaryType())])

    def apply(batches):
        coder = byte_bpe(file, pattern)
        for batch in batches:
            out = [coder.decode(np.frombuffer(x or b"", "<u4")).tobytes()
                   for x in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(keep))), pa.array(out, pa.binary())],
                [*keep, data])

    return rows.mapInArrow(apply, schema)


def digests(df: DataFrame, file: str, pattern: str, text: str = "text",
            keep: list[str] | None = None) -> DataFrame:
    """``df`` (or ``keep``) with the number of ids, the SHA-256 of the ids and the SHA-256 of the
    bytes decoded from them, for tables whose ids need not be kept: encodes and decodes in one go,
    so that neither ids nor bytes leave the task. Null and empty texts have 0 ids."""
    def make():
        coder = byte_bpe(file, pattern)

        def of(texts):
            counts, of_ids, of_bytes = [], [], []
            for _, group in chunks(texts):
                ids, count = coder.encode(group)
                raw = memoryview(ids.astype("<u4")).cast("B")
                back = memoryview(coder.decode(ids))
                size = np.zeros(len(ids) + 1, np.int64)
                np.cumsum(coder.sizes[ids.astype(np.int64)], out=size[1:])
                ends = np.cumsum(count)
                for a, b in zip((ends - count).tolist(), ends.tolist()):
                    of_ids.append(hashlib.sha256(raw[4 * a:4 * b]).hexdigest())
                    of_bytes.append(hashlib.sha256(back[size[a]:size[b]]).hexdigest())
                counts.append(count)
            return [pa.array(np.concatenate(counts)), pa.array(of_ids, pa.string()),
                    pa.array(of_bytes, pa.string())]
        return of

    return with_results(df, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", make,
                        keep)

