"""SimHash near-duplicates by covering codes: an exact join of fingerprints within a few bits.

The 64 bits fall into three blocks. If two fingerprints differ in at most ``distance`` bits, then
in some block they differ in at most that block's tolerance, because the tolerances plus one add up
to more than the distance. Each block has a covering code as its anchors: the binary Golay code of
length 23 (every word is within 3 bits of exactly one of 4,096 code words) for two blocks, all words
for the third. A fingerprint is at home at the anchor within the covering radius, and visits every
anchor within the radius plus the tolerance. So of two near fingerprints each one visits the home
of the other in some block; the homes and visitors of an anchor are compared.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components, joined
from tidemark.llm.frames import chunks, kept, with_results
from tidemark.llm.pieces import ranges

#: Homes and visitors of an anchor that one task compares; beyond them the anchor is split.
SIDE_ROWS = 16_384
#: Pairs of fingerprints that are compared in one step.
STEP_PAIRS = 2_000_000

#: Fixed value: generator polynomial of the Golay code, x^11+x^9+x^7+x^6+x^5+x+1.
GOLAY = 0b101011100011


@dataclass(frozen=True)
class Block:
    """``length`` bits from bit ``first``; ``golay``: anchors are the Golay code, else all words."""

    first: int
    length: int
    golay: bool
    tolerance: int

    @functools.cached_property
    def _syndromes(self) -> np.ndarray:
        """Remainder by the generator of each half word, low 12 and high 11 bits."""
        unit = [1]
        for _ in range(22):
            unit.append(unit[-1] << 1 ^ (GOLAY if unit[-1] & 1 << 10 else 0))
        table = np.zeros((2, 4096), np.int64)
        for half, shift in ((0, 0), (1, 12)):
            for bit in range(12 - half):
                set_ = np.arange(4096) >> bit & 1 == 1
                table[half, set_] ^= unit[bit + shift]
        return table

    def _syndrome(self, word: np.ndarray) -> np.ndarray:
        if not self.golay:
            return np.zeros(len(word), np.int64)
        return self._syndromes[0, word & 4095] ^ self._syndromes[1, word >> 12]

    @functools.cached_property
    def _errors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bit patterns up to radius plus tolerance, those within the radius first for each
        syndrome; the first and number of patterns, and whether a pattern is within the radius."""
        radius = 3 if self.golay else 0
        sets = [(w, sum(1 << b for b in bits)) for w in range(radius + self.tolerance + 1)
                for bits in combinations(range(self.length), w)]
        weight, pattern = np.array(sets, np.int64).T
        syndrome = self._syndrome(pattern)
        order = np.lexsort((weight, syndrome))
        count = np.bincount(syndrome, minlength=2048 if self.golay else 1)
        return pattern[order], np.cumsum(count) - count, count, weight[order] <= radius

    def anchors(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The places in ``prints``, the anchor each is at, and whether it is at home there."""
        word = (prints >> np.uint64(self.first)).astype(np.int64) & (1 << self.length) - 1
        pattern, first, count, near = self._errors
        syndrome = self._syndrome(word)
        row = np.repeat(np.arange(len(word)), count[syndrome])
        at = ranges(first[syndrome], count[syndrome])
        return row, word[row] ^ pattern[at], near[at]


@functools.cache
def blocks(distance: int) -> tuple[Block, ...]:
    """Tolerances plus one add up to ``distance`` + 1 at least."""
    more = max(0, distance - 2)
    tolerance = [more // 2 + more % 2, more // 2, 0]
    if tolerance[0] > 3:
        raise ValueError("anchors are made for distances up to 8")
    return (Block(0, 23, True, tolerance[0]), Block(23, 23, True, tolerance[1]),
            Block(46, 18, False, tolerance[2]))


def fingerprint(texts: list[str], words: int) -> np.ndarray:
    """Fingerprints of texts: A-Z is lower-cased, words lie between ASCII white space, each
    shingle's 64-bit XXH64 (seed 42) votes on every bit, and a bit is set by more than half."""
    from xxhash import xxh64_intdigest
    hashes, counts = [], np.zeros(len(texts), np.int64)
    for place, text in enumerate(texts):
        parts = text.encode().lower().split()
        if not parts:
            continue
        line, width = b" ".join(parts), min(words, len(parts))
        ends = np.cumsum([len(p) + 1 for p in parts]) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        spans = zip(starts[:len(parts) - width + 1].tolist(), ends[width - 1:].tolist())
        hashes += [xxh64_intdigest(line[a:b], 42) for a, b in spans]
        counts[place] = len(parts) - width + 1
    out = np.zeros(len(texts), np.uint64)
    filled = np.flatnonzero(counts)
    if len(filled):
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        first = (np.cumsum(counts) - counts)[filled]
        votes = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
        packed = np.packbits(2 * votes > counts[filled, None], axis=1, bitorder="little")
        out[filled] = packed.view("<u8").ravel()
    return out


def fingerprints(df: DataFrame, text: str = "text", words: int = 4,
                 keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with the 64-bit ``fingerprint`` of each whole text as a
    signed long. A text of fewer words is one shingle; a null text, or one without words, has 0."""
    def make():
        return lambda texts: [pa.array(np.concatenate(
            [fingerprint(group, words) for _, group in chunks(texts)]).view(np.int64))]
    return with_results(df, text, "fingerprint long", make, keep)


def near_fingerprints(prints: DataFrame, distance: int) -> DataFrame:
    """``node`` and ``component`` for all fingerprints of the column ``fingerprint`` that differ
    in at most ``distance`` bits from another one. Links within an anchor are reduced to a
    spanning forest in the task that finds them, so no list of pairs leaves it."""
    def cells(batches):
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for number, block in enumerate(blocks(distance)):
                row, anchor, home = block.anchors(values)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor << 2 | number), pa.array(values[row].view(np.int64)),
                     pa.array(home)], ["cell", "print", "home"])

    distinct = prints.select("fingerprint").filter("fingerprint is not null").distinct()
    placed = kept(distinct.mapInArrow(cells, "cell long, print long, home boolean"), "anchors")
    crowded = (placed.groupBy("cell").agg(F.count("*").alias("n"), F.sum(F.col("home").cast("int"))
                                          .alias("h"))
               .select("cell", F.ceil(F.col("h") / SIDE_ROWS).alias("home_parts"),
                       F.ceil(F.col("n") / SIDE_ROWS).alias("visit_parts"))
               .filter("visit_parts > 1"))
    salt = F.xxhash64("print", F.lit(7))
    split = placed.join(crowded, "cell")  # every part of the homes meets every part of the visitors
    homes = split.filter("home").select(
        "cell", F.pmod(salt, F.col("home_parts")).alias("i"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("visit_parts") - 1)).alias("j"), "print",
        F.lit(True).alias("home"))
    visits = split.select(
        "cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("home_parts") - 1)).alias("i"),
        F.pmod(salt, F.col("visit_parts")).alias("j"), "print", F.lit(False).alias("home"))
    none = F.lit(0).cast("long")
    alone = placed.join(crowded, "cell", "left_anti")
    alone = alone.select("cell", none.alias("i"), none.alias("j"), "print", "home")
    # a home at an anchor is among its visitors too
    every = alone.unionAll(homes).unionAll(visits)
    links = (every.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
             .mapInArrow(_linker(distance), "a long, b long"))
    return components(links)


def _linker(distance: int):
    def links(cell, values, home):
        """Links of a spanning forest of each cell; rows of a cell lie next to each other."""
        new = np.flatnonzero(np.append(True, (cell[:, 1:] != cell[:, :-1]).any(0)))
        first = np.repeat(new, np.diff(np.append(new, len(values))))
        count = np.repeat(np.diff(np.append(new, len(values))), np.diff(np.append(new, len(values))))
        roots, at = np.arange(len(values)), np.flatnonzero(home)
        stops = np.cumsum(count[at])
        begin = 0
        while begin < len(at):
            done = stops[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(stops, done + STEP_PAIRS, "right")))
            some = at[begin:end]
            x = np.repeat(some, count[some])
            y = ranges(first[some], count[some])
            near = np.bitwise_count(values[x] ^ values[y]) <= distance
            joined(roots, x[near], y[near])
            begin = end
        far = values[roots] != values
        return pa.RecordBatch.from_arrays(
            [pa.array(values[far].view(np.int64)), pa.array(values[roots[far]].view(np.int64))],
            ["a", "b"])

    def apply(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cell = np.stack([batch.column(i).to_numpy() for i in range(3)])
            values = batch.column(3).to_numpy().view(np.uint64)
            home = batch.column(4).to_numpy(zero_copy_only=False)
            if held:
                cell = np.concatenate([held[0], cell], axis=1)
                values, home = np.append(held[1], values), np.append(held[2], home)
            last = int(np.flatnonzero((cell == cell[:, -1:]).all(0))[0])  # it may go on in the next
            if last:
                yield links(cell[:, :last], values[:last], home[:last])
            held = cell[:, last:], values[last:], home[last:]
        if held:
            yield links(*held)
    return apply


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text", words: int = 4,
                    distance: int = 4) -> DataFrame:
    """``id``, ``fingerprint`` (16 lower-case hexadecimal digits) and ``component_id``, the
    smallest id of all documents that links reach from this one, for every row of ``df``.

    Texts with one fingerprint meet once, however many they are, and are joined back at the end.
    Texts without words (null, empty) share fingerprint zero and so one component. Repeated rows
    stay repeated. A null id never is the smallest; a component of null ids has a null
    ``component_id``. An empty table gives no row. Other columns are not read.
    """
    rows = df.select(F.col(f"`{id}`").alias("_id"), F.col(f"`{text}`").cast("string").alias("_text"))
    prints = kept(fingerprints(rows, "_text", words, ["_id"]), "fingerprints")
    of_print = prints.groupBy("fingerprint").agg(F.min("_id").alias("least"))
    found = near_fingerprints(prints, distance).withColumnRenamed("node", "fingerprint")
    of_print = kept(of_print.join(found, "fingerprint", "left").select(
        "fingerprint", "least", F.coalesce("component", "fingerprint").alias("component")),
        "print-components")
    # written, so that the join deals out plain rows and a large component can be split
    least = kept(of_print.groupBy("component").agg(F.min("least").alias("component_id")), "least")
    of_print = of_print.join(least, "component").select("fingerprint", "component_id")
    return prints.join(of_print, "fingerprint").select(
        F.col("_id").alias(id), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id")
