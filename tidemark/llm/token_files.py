"""Files of token ids in a byte-aligned code of variable length, with separate control bytes.

Ids are replaced by their rank by frequency over all documents, so that frequent ids take one
byte. The bytes of the ranks (1 to 4 each, lowest first) lie one after the other. Apart from them,
a control byte holds the lengths of four ranks, two bits each, lowest first; each document begins
with a control byte of its own. Numpy decodes a whole block by a table from control bytes to
lengths.

Layout of a folder: ``blocks`` (Parquet; one row for each block of neighbouring documents: part,
block, ids and token counts of its documents, tokens of the block and of the blocks before it in the
part, control bytes, data bytes, CRC-32 of both) and
``vocabulary`` (Parquet; rank, token, count). Rows, files and parts are in ascending order of the
document id, null first. Repeated rows are written as often as they come, one after the other.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.frames import binaries, chunks, slices, with_results
from tidemark.llm.pieces import library_tokenizer, ranges
from tidemark.session import new_folder
from tidemark.sources.storage import Storage

#: Tokens in a block, unless one document alone is longer, and in a part.
BLOCK_TOKENS, PART_TOKENS = 100_000, 4_000_000

#: Lengths of the four ranks of each control byte.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1).astype(np.uint8)


def code(ranks: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Control bytes and data bytes of documents with ``counts`` ranks each."""
    ranks = ranks.astype("<u4", copy=False)
    length = np.ones(len(ranks), np.uint8)
    widest = 1
    for bits in (8, 16, 24):
        longer = ranks >= 1 << bits
        if longer.any():
            length += longer
            widest += 1
    data = ranks.view(np.uint8).reshape(-1, 4)[:, :widest][np.arange(widest) < length[:, None]]
    groups = -(-counts // 4)
    slots = np.zeros(4 * int(groups.sum()), np.uint8)
    slots[ranges(4 * (np.cumsum(groups) - groups), counts)] = length - 1
    slots = slots.reshape(-1, 4)
    return slots[:, 0] | slots[:, 1] << 2 | slots[:, 2] << 4 | slots[:, 3] << 6, data


def uncode(control: np.ndarray, data: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The ranks of documents with ``counts`` ranks each."""
    groups = -(-counts // 4)
    length = LENGTHS[control].ravel()[ranges(4 * (np.cumsum(groups) - groups), counts)]
    first = np.cumsum(length, dtype=np.int64) - length
    data = np.append(data, np.zeros(3, np.uint8))
    value = data[first].astype(np.uint32)
    for byte in (1, 2, 3):
        more = np.flatnonzero(length > byte)
        value[more] |= data[first[more] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return value


def write(df: DataFrame, folder: str, tokenizer: str, id: str = "doc_id", text: str = "text",
          end_id: int = 2) -> None:
    """Encode every whole text with the tokenizers file, close it with ``end_id``, and write the
    ids to ``folder``. A null or empty text has only ``end_id``; an empty table gives empty files.
    Columns but ``id`` and ``text`` are not read. The ids are tokenized once, into a table of the
    shared folder that is removed at the end; counts cover all documents.
    """
    spark, width = df.sparkSession, library_tokenizer(tokenizer).type

    def make():
        coder = library_tokenizer(tokenizer)

        def of(texts):
            ids, counts = [], []
            for _, group in chunks(texts):
                some, count = coder.encode(group)
                ids.append(np.insert(some, np.cumsum(count), end_id).astype(width))
                counts.append(count + 1)
            ids, counts = np.concatenate(ids), np.concatenate(counts)
            return [pa.array(counts), binaries(ids, ids.itemsize * counts)]
        return of

    staged = new_folder(spark, "token-ids")
    rows = df.select(F.col(f"`{id}`").alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))
    (with_results(rows, "text", "n_tokens long, ids binary", make, ["doc"])
     .withColumn("row", F.monotonically_increasing_id())
     .write.option("compression", "zstd").parquet(staged))
    rows = spark.read.parquet(staged)

    counted = rows.select("ids").mapInArrow(_counter(width), "token long, times long")
    counted = counted.groupBy("token").agg(F.sum("times").alias("times")).toPandas()  # <= vocabulary
    counted = counted.sort_values(["times", "token"], ascending=[False, True]).astype("int64")
    order = counted["token"].to_numpy()
    rank = np.zeros(int(order.max(initial=0)) + 1, np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    counted["rank"] = np.arange(len(order))
    (spark.createDataFrame(counted, "token long, times long, rank long")
     .coalesce(1).write.parquet(f"{folder}/vocabulary"))

    parts = max(1, -(-int(counted["times"].sum()) // PART_TOKENS))
    blocks = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()),
        T.StructField("docs", T.ArrayType(rows.schema["doc"].dataType)),
        T.StructField("counts", T.ArrayType(T.LongType())), T.StructField("tokens", T.LongType()),
        T.StructField("before", T.LongType()), T.StructField("control", T.BinaryType()),
        T.StructField("data", T.BinaryType()), T.StructField("check", T.LongType())])
    (rows.repartitionByRange(parts, "doc", "row").sortWithinPartitions("doc", "row")
     .select("doc", "n_tokens", "ids").mapInArrow(_blocks(rank, width, blocks.names), blocks)
     .write.option("compression", "zstd").parquet(f"{folder}/blocks"))
    Storage(spark).remove(staged, whole_folder=True)


def read(spark: SparkSession, folder: str, id: str = "doc_id") -> DataFrame:
    """The documents of ``folder``: id, ``start`` (ids of all documents before it), ``n_tokens``
    and ``ids`` (little-endian unsigned 32-bit). A block that does not fit its CRC-32 is an error.
    """
    blocks = spark.read.parquet(f"{folder}/blocks")
    vocabulary = spark.read.parquet(f"{folder}/vocabulary").select("rank", "token").toPandas()
    tokens = np.zeros(len(vocabulary), "<u4")
    tokens[vocabulary["rank"].to_numpy()] = vocabulary["token"].to_numpy()

    sums = blocks.groupBy("part").agg(F.sum("tokens").alias("tokens")).collect()  # a row a file
    first, seen = {}, 0
    for row in sorted(sums):
        first[row["part"]], seen = seen, seen + row["tokens"]
    schema = T.StructType([
        T.StructField(id, blocks.schema["docs"].dataType.elementType),
        T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType())])
    return blocks.select("part", "before", "docs", "counts", "control", "data", "check").mapInArrow(
        _decoder(tokens, first, schema.names), schema)


def _counter(width: str):
    def apply(batches):
        for batch in batches:
            for rows in slices(batch, 0):
                times = np.bincount(np.frombuffer(b"".join(rows.column(0).to_pylist()), width))
                seen = np.flatnonzero(times)
                yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(times[seen])],
                                                 ["token", "times"])
    return apply


def _blocks(rank: np.ndarray, width: str, names: list[str]):
    def apply(batches):
        part, block, before, held = TaskContext.get().partitionId(), 0, 0, []

        def made(kind):
            nonlocal block, before, held
            docs, counts = [h[0] for h in held], np.array([h[1] for h in held], np.int64)
            ids = np.frombuffer(b"".join(h[2] for h in held), width)
            control, data = (x.tobytes() for x in code(rank[ids], counts))
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()),
                 pa.array([docs], pa.list_(kind)), pa.array([counts.tolist()], pa.list_(pa.int64())),
                 pa.array([len(ids)], pa.int64()), pa.array([before], pa.int64()),
                 pa.array([control], pa.binary()), pa.array([data], pa.binary()),
                 pa.array([zlib.crc32(data, zlib.crc32(control))], pa.int64())], names)
            block, before, held = block + 1, before + len(ids), []
            return row

        tokens = 0
        for batch in batches:
            kind = batch.column(0).type
            for doc in zip(*(c.to_pylist() for c in batch.columns)):
                if held and tokens + doc[1] > BLOCK_TOKENS:
                    yield made(kind)
                    tokens = 0
                held.append(doc)
                tokens += doc[1]
        if held:
            yield made(kind)
    return apply


def _decoder(tokens: np.ndarray, first: dict[int, int], names: list[str]):
    def apply(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                part, before, docs, counts, control, data, check = (c[row].as_py()
                                                                    for c in batch.columns)
                if zlib.crc32(data, zlib.crc32(control)) != check:
                    raise ValueError(f"a block of part {part}, {before} ids from its begin, is damaged")
                counts = np.array(counts, np.int64)
                ids = tokens[uncode(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8),
                                    counts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, batch.column(2).type.value_type),
                     pa.array(first[part] + before + np.cumsum(counts) - counts), pa.array(counts),
                     binaries(ids, 4 * counts)], names)
    return apply
