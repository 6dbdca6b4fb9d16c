"""Packing documents into sequences of tokens along a space-filling curve.

Each document becomes a vector of hashed token counts, which a random matrix takes to a few
dimensions. Its place on a Hilbert curve through them is its sort key, so that documents with like
words come next to each other. All tokens of all documents, in the order of the curve, form one
stream that is cut every ``length`` tokens. Only the last, shorter rest is not full; it is cut into
sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.frames import binaries, chunks, kept, slices, with_results
from tidemark.llm.pieces import library_tokenizer, ranges

#: Buckets of the hashed vectors; dimensions of the curve and bits of each; tokens in a part.
BUCKETS, DIMENSIONS, BITS, PART_TOKENS = 1024, 4, 12, 4_000_000


@functools.cache
def _projection() -> np.ndarray:
    return np.random.default_rng(17).standard_normal((BUCKETS, DIMENSIONS))


def hashed_vectors(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each document the square roots of its hashed token counts, as a unit vector."""
    owner = np.repeat(np.arange(len(counts)), counts)
    bucket = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(54)).astype(np.int64)
    found = np.bincount(owner * BUCKETS + bucket % BUCKETS, minlength=len(counts) * BUCKETS)
    vectors = np.sqrt(found.reshape(len(counts), BUCKETS))
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def grid(vectors: np.ndarray) -> np.ndarray:
    """Cells of the projected vectors, 0 to 2**BITS - 1 in each dimension. A projection of a unit
    vector is near a standard normal value; its logistic spreads it over the grid."""
    spread = 1 / (1 + np.exp(-1.7 * (vectors @ _projection())))
    return np.minimum((spread * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Distances along the Hilbert curve: the axes are turned into the curve's transposed index
    level by level (exchange or invert the lower bits), then Gray-decoded and interleaved."""
    x = [cells[:, d].copy() for d in range(cells.shape[1])]
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for d in range(len(x)):
            set_ = (x[d] & level) != 0
            swap = np.where(set_, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(set_, x[0] ^ low, x[0] ^ swap)
            if d:
                x[d] ^= swap
        level >>= 1
    for d in range(1, len(x)):
        x[d] ^= x[d - 1]
    turn, level = np.zeros_like(x[0]), 1 << (bits - 1)
    while level > 1:
        turn ^= np.where((x[-1] & level) != 0, level - 1, 0)
        level >>= 1
    x = [v ^ turn for v in x]
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for v in x:
            key = (key << 1) | (v >> bit & 1)
    return key


def pack(df: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", length: int = 4096,
         end_id: int = 2) -> DataFrame:
    """Pieces of documents in sequences: ``id``, ``start`` and ``length`` of the piece in its
    document, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``, ``sequence_id``, ``offset``
    of the piece in its sequence, and ``curve``, the document's key.

    A document is the ids of its whole text by the tokenizers file, then ``end_id``; a null or empty
    text is only that. Every id lies in exactly one piece. Documents with one key, such as copies,
    follow each other by id; repeated rows are packed as often as they come. An empty table gives
    no piece. Columns but ``id`` and ``text`` are not read.

    The ids are written once as tokenized and once in curve order. Ranges of the curve are cut by
    key, id and row, so a key that many documents share spans several tasks; the driver only holds
    one number for each range. Which sequence a token comes to depends on no range.
    """
    width = library_tokenizer(tokenizer).type

    def make():
        coder = library_tokenizer(tokenizer)

        def of(texts):
            ids, counts, keys = [], [], []
            for _, group in chunks(texts):
                some, count = coder.encode(group)
                ids.append(np.insert(some, np.cumsum(count), end_id).astype(width))
                counts.append(count + 1)
                keys.append(hilbert_keys(grid(hashed_vectors(some, count))))
            ids, counts = np.concatenate(ids), np.concatenate(counts)
            return [pa.array(np.concatenate(keys)), pa.array(counts),
                    binaries(ids, ids.itemsize * counts)]
        return of

    rows = df.select(F.col(f"`{id}`").alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))
    tokens = kept(with_results(rows, "text", "curve long, doc_tokens long, ids binary", make, ["doc"])
                  .withColumn("row", F.monotonically_increasing_id()), "packing-ids")
    total = tokens.agg(F.sum("doc_tokens")).first()[0] or 0
    parts = max(1, -(-total // PART_TOKENS))
    schema = T.StructType([*tokens.schema.fields, T.StructField("part", T.IntegerType()),
                           T.StructField("before", T.LongType())])
    ordered = kept(tokens.repartitionByRange(parts, "curve", "doc", "row")
                   .sortWithinPartitions("curve", "doc", "row").mapInArrow(_places, schema),
                   "packing-order")
    sums = {r["part"]: r["tokens"] for r in
            ordered.groupBy("part").agg(F.sum("doc_tokens").alias("tokens")).collect()}
    first, seen = {}, 0
    for part in sorted(sums):
        first[part], seen = seen, seen + sums[part]
    pieces = T.StructType([
        T.StructField(id, tokens.schema["doc"].dataType), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()), T.StructField("curve", T.LongType())])
    return ordered.select("doc", "curve", "doc_tokens", "ids", "part", "before").mapInArrow(
        _cutter(first, total, length, width, pieces.names), pieces)


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id``, ``length`` and ``ids`` of each sequence, put together from its pieces."""
    held = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return (pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), held.alias("held"))
            .select("sequence_id", "length", F.expr(
                "aggregate(held, X'', (all, piece) -> concat(all, piece.ids))").alias("ids")))


def cuts(total: int, length: int) -> np.ndarray:
    """Where the shorter sequences behind the full ones begin, and the end of the stream."""
    at = total // length * length
    out = [at]
    for power in range(length.bit_length(), -1, -1):
        if total % length >> power & 1:
            out.append(out[-1] + (1 << power))
    return np.array(out, np.int64)


def _places(batches):
    part, seen = TaskContext.get().partitionId(), 0
    for batch in batches:
        count = batch.column(batch.schema.get_field_index("doc_tokens")).to_numpy()
        ends = seen + np.cumsum(count)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(count), part, np.int32)), pa.array(ends - count)],
            [*batch.schema.names, "part", "before"])
        seen = int(ends[-1]) if len(ends) else seen


def _cutter(first: dict[int, int], total: int, length: int, width: str, names: list[str]):
    full, tail = total // length, cuts(total, length)

    def sequence(at):
        return np.where(at < full * length, at // length,
                        full + np.searchsorted(tail, at, "right") - 1)

    def begin(number):
        return np.where(number < full, number * length,
                        tail[np.clip(number - full, 0, len(tail) - 1)])

    def apply(batches):
        for whole in batches:
            for batch in slices(whole, 3):
                count = batch.column(2).to_numpy()
                begins = (np.array([first[p] for p in batch.column(4).to_pylist()], np.int64)
                          + batch.column(5).to_numpy())
                low, high = sequence(begins), sequence(begins + count - 1)
                row = np.repeat(np.arange(len(count)), high - low + 1)
                number = ranges(low, high - low + 1)
                start = np.maximum(begins[row], begin(number))
                stop = np.minimum((begins + count)[row], begin(number + 1))
                ids = np.frombuffer(b"".join(batch.column(3).to_pylist()), width).astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), pa.array(start - begins[row]),
                     pa.array(stop - start), binaries(ids, 4 * (stop - start)),
                     pa.array(count[row]), pa.array(number), pa.array(start - begin(number)),
                     batch.column(1).take(pa.array(row))], names)
    return apply
